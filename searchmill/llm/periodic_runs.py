"""Periodic runs of words, found tile by tile at the scale of their period.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and
at least max(`LEAST`, `TIMES` x q) words that no neighbouring word extends keeping the period.

1. The periods are split into octaves: 1 to 15, then B to 2B - 1 for B = 16, 32, ... Boundaries
   are B words apart (8 in the first octave). A run's stretch of words that equal the word q on is
   at least 2q long, so it holds a whole block of B words from some boundary on, and that block
   occurs again q words on. Block hashes say at which boundaries a block does occur again among
   the octave's periods; they only sort out, as equal blocks have equal hashes.
2. At each boundary left, Z-functions of the words from the boundary on, and of the words before
   it backwards, say for all periods of the octave how far the words agree to the right and to
   the left. That gives a fragment: the boundary's part of a run, at most some B words long.
   Fragments of a period that touch are one. Those inside a fragment of a divisor of their period
   aren't of smallest period and go; boundaries inside a run of smaller period are skipped, as
   all they could find are its multiples.
3. A document of up to `TILE` words is one tile for all octaves. A longer one is exploded into
   overlapping tiles: of `TILE` words for the octaves up to a sixteenth of that, and for each
   octave beyond into tiles of 16 B words. Tiles are dealt out and solved on their own. Neighbours
   share a quarter of a tile, 4 B words or more, so a run that passes through both has a fragment in
   each, and the two touch.
4. Fragments are shuffled by document and period and stitched where they touch.

Words are numbers within their document, given out by a dictionary of the words themselves, so
equal numbers are equal words. One pass over the documents writes their fragments, the tiles of the
long ones, and for documents without either the end result; only the others' texts are read
again. Rows are numbered by task and place in that pass; what follows reads its written result.

Null and empty texts and those of white space have no words and no runs. Rows that are equal, or
have the same or a null doc_id, are documents like any other. A very long text is split into
words a slice at a time; of its tiles, only those of the last octaves are as long as it is. An
empty table gives an empty result. All columns besides the text are passed on as a struct, whatever
their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchmill.llm.tables import written
from searchmill.llm.windows import U64, Hasher, in_pieces, mix
from searchmill.llm.words import word_slices

LEAST = 24
TIMES = 3
TILE = 1 << 18
FIRST = 8
"""Words between the boundaries of the first octave, whose periods are up to twice that."""

DONE, HELD, FRAGMENT, PIECE = range(4)
"""Rows of the first pass: a document without fragments, one with them, a fragment, a tile."""


def z_function(s: list[int]) -> list[int]:
    """For each place, how many items from there on equal the first ones."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        same = min(right - i, z[i - left]) if i < right else 0
        while i + same < n and s[same] == s[i + same]:
            same += 1
        z[i] = same
        if i + same > right:
            left, right = i, i + same
    return z


def octaves(n: int) -> list[int]:
    """Distances of boundaries for the periods that fit a stretch of `n` words."""
    out, size = [], FIRST
    while (size if size > FIRST else 1) * TIMES <= n:
        out.append(size)
        size *= 2
    return out


def _periods(size: int) -> tuple[int, int]:
    return (size if size > FIRST else 1), 2 * size


def boundary_fragments(x: np.ndarray, grams: np.ndarray, size: int, skip: np.ndarray):
    """(period, from, to) of the stretches around the boundaries where x[i] == x[i + period].

    `skip` tells for each boundary whether it can be left out.
    """
    low, high = _periods(size)
    n = len(x)
    count = max((n - size - low) // size + 1, 0)
    at = np.arange(count) * size
    wide = np.zeros(count * size + high, U64)  # zeros: what isn't a block may hit, and is no block
    wide[: min(len(grams), len(wide))] = grams[: len(wide)]
    again = np.zeros(count, bool)
    live = np.flatnonzero(~skip[:count])
    step = max((1 << 20) // high, 1)
    shifts = np.arange(low, high)
    for a in range(0, len(live), step):
        some = live[a : a + step]
        again[some] = (wide[at[some, None] + shifts] == grams[at[some], None]).any(1)
    found = []
    for c in at[again].tolist():
        left = min(size, c)
        ahead = z_function(x[c : c + 4 * size].tolist())
        backwards = x[c - left : c + high][::-1].tolist()
        behind = z_function(x[c - left : c][::-1].tolist() + [-1] + backwards)
        for period in range(low, min(high, len(ahead))):
            if ahead[period] >= size:
                back = behind[left + 1 + len(backwards) - left - period] if left else 0
                found.append((period, c - back, c + ahead[period]))
    return np.array(found, np.int64).reshape(-1, 3)


def joined(found: np.ndarray) -> np.ndarray:
    """(period, from, to) with those of a period that overlap or touch made one."""
    if not len(found):
        return found
    found = found[np.lexsort((found[:, 1], found[:, 0]))]
    period, start, end = found.T
    far = int(end.max()) + 1
    reach = np.maximum.accumulate(end + period * far) - period * far  # of the same period so far
    new = np.ones(len(found), bool)
    new[1:] = (period[1:] != period[:-1]) | (start[1:] > reach[:-1])
    begin = np.flatnonzero(new)
    return np.stack((period[begin], start[begin], np.maximum.reduceat(end, begin)), 1)


def not_of_divisors(found: np.ndarray, known: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Which stretches don't lie in a stretch of a proper divisor of their period; `part` numbers
    the documents by place."""
    stays = np.ones(len(found), bool)
    if not len(found) or not len(known):
        return stays
    known = known[np.argsort(part[known[:, 1]], kind="stable")]
    parts = part[known[:, 1]]
    here = part[found[:, 1]]
    low, high = np.searchsorted(parts, here, "left"), np.searchsorted(parts, here, "right")
    before = np.concatenate(([0], np.cumsum(high - low)))
    a = 0
    while a < len(found):
        b = max(int(np.searchsorted(before, before[a] + (1 << 20), "right")) - 1, a + 1)
        times = (high - low)[a:b]
        f = np.repeat(np.arange(a, b), times)
        k = np.arange(len(f)) + np.repeat(low[a:b] - (before[a:b] - before[a]), times)
        inside = (
            (known[k, 0] < found[f, 0])
            & (found[f, 0] % known[k, 0] == 0)
            & (known[k, 1] <= found[f, 1])
            & (known[k, 2] + known[k, 0] >= found[f, 2] + found[f, 0])
        )
        stays[f[inside]] = False
        a = b
    return stays


def solve(x: np.ndarray, ends: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """For each octave, (period, from, to): where x[i] == x[i + period], in stretches as long as
    they go, of smallest period if they are some 24 words long.

    `x` has documents up to `ends`, the longest first, without words in common.
    """
    values = mix(x.astype(U64) + U64(1))
    hasher = Hasher(values)
    lengths = np.diff(np.concatenate(([0], ends)))
    part = np.repeat(np.arange(len(ends)), lengths)
    known = np.empty((0, 3), np.int64)
    out = []
    for size in sizes:
        low, _ = _periods(size)
        n = int(np.concatenate(([0], ends))[np.count_nonzero(lengths >= TIMES * low)])
        # Boundaries inside a stretch of smaller period, up to the farthest word they look at.
        edge = np.zeros(n // size + 2, np.int64)
        if size > FIRST:
            first = -(-known[:, 1] // size)
            last = (known[:, 2] + known[:, 0] - 3 * size) // size
            ok = (last >= first) & (first < len(edge) - 1)
            np.add.at(edge, first[ok], 1)
            np.add.at(edge, np.minimum(last[ok] + 1, len(edge) - 1), -1)
        found = np.empty((0, 3), np.int64)
        if n >= size + low:
            found = boundary_fragments(x[:n], hasher.grams(size)[: n - size + 1], size, np.cumsum(edge) > 0)
        found = joined(found)
        found = found[not_of_divisors(found, np.concatenate((known, found)), part)]
        known = np.concatenate((known, found))
        out.append(found)
    return out


def _long_enough(found: np.ndarray) -> np.ndarray:
    period, start, end = found.T
    return end + period - start >= np.maximum(LEAST, TIMES * period)


def tiles(n: int, tile: int) -> list[tuple[int, int, int]]:
    """(octave, from, to) of a document of `n` words; octave 0: all that are small for a tile."""
    spans = [(0, tile)] + [(size, 16 * size) for size in octaves(n) if size * 16 > tile]
    out = []
    for size, width in spans:
        at = 0
        while True:
            out.append((size, at, min(at + width, n)))
            if at + width >= n:
                break
            at += width - width // 4
    return out


def tile_fragments(x: np.ndarray, octave: int, at: int, n: int, tile: int) -> np.ndarray:
    """(period, from, to) of a tile from word `at` of a document of `n` words, in its words."""
    sizes = octaves(len(x))
    sizes = [s for s in sizes if (s <= octave if octave else 16 * s <= tile)]
    found = solve(x, np.array([len(x)]), sizes)
    found = np.concatenate([f for s, f in zip(sizes, found, strict=True) if octave in (0, s)] or [np.empty((0, 3), np.int64)])
    period, start, end = found.T
    goes_on = (start == 0) & (at > 0) | (end + period == len(x)) & (at + len(x) < n)
    found = found[goes_on | _long_enough(found)]
    return found + np.array([0, at, at])


def _numbered(text: bytes):
    """(numbers of the words, how many different ones)."""
    known: dict[bytes, int] = {}
    parts = [
        np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words))
        for words in word_slices(text)
    ]
    return (np.concatenate(parts) if parts else np.empty(0, np.int32)), len(known)


def _nulls(n: int, schema: pa.Schema, **given) -> pa.RecordBatch:
    arrays = [given[f.name] if f.name in given else pa.nulls(n, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _first_pass(tile: int, with_text: bool):
    """Rows of documents, fragments and tiles."""

    def run(batches):
        task = TaskContext.get().partitionId()
        met = 0
        for batch in in_pieces(batches, 1):
            other = batch.column(0)
            schema = pa.schema(
                [("kind", pa.int32()), ("task", pa.int64()), ("nth", pa.int64()), ("other", other.type)]
                + [("n_words", pa.int64()), ("text", pa.string()), ("sha", pa.string()), ("period", pa.int64())]
                + [("low", pa.int64()), ("high", pa.int64()), ("octave", pa.int64()), ("at", pa.int64())]
                + [("ids", pa.binary())]
            )
            texts = [b"" if t is None else t for t in batch.column(1).cast(pa.binary()).to_pylist()]
            numbers, n_words, base = [], np.zeros(len(texts), np.int64), 0
            for k, text in enumerate(texts):
                ids, different = _numbered(text)
                n_words[k] = len(ids)
                numbers.append(ids.astype(np.int64) + base)
                base += different
            whole = np.flatnonzero(n_words <= tile)
            whole = whole[np.argsort(-n_words[whole], kind="stable")]
            x = np.concatenate([numbers[k] for k in whole] or [np.empty(0, np.int64)])
            ends = np.cumsum(n_words[whole])
            found = solve(x, ends, octaves(int(n_words[whole].max(initial=0))))
            found = np.concatenate(found or [np.empty((0, 3), np.int64)])
            found = found[_long_enough(found)]
            place = np.searchsorted(ends, found[:, 1], "right")
            doc = whole[place]
            start = (ends - n_words[whole])[place] if len(place) else place
            held = n_words > tile
            held[doc] = True
            shas, kept = [], []
            for text, wait in zip(texts, held, strict=True):
                if wait:
                    shas.append(None)
                    kept.append(text)
                else:
                    parts = [b" ".join(words) for words in word_slices(text)]
                    plain = b" ".join(p for p in parts if p)
                    shas.append(hashlib.sha256(plain).hexdigest())
                    kept.append(plain if with_text else None)
            yield _nulls(
                len(texts), schema,
                kind=pa.array(np.where(held, HELD, DONE), pa.int32()),
                task=pa.array(np.full(len(texts), task), pa.int64()),
                nth=pa.array(met + np.arange(len(texts)), pa.int64()),
                other=other, n_words=pa.array(n_words), sha=pa.array(shas, pa.string()),
                text=pa.array(kept, pa.binary()).cast(pa.string()),
            )
            if len(found):
                yield _nulls(
                    len(found), schema,
                    kind=pa.array(np.full(len(found), FRAGMENT), pa.int32()),
                    task=pa.array(np.full(len(found), task), pa.int64()),
                    nth=pa.array(met + doc, pa.int64()),
                    period=pa.array(found[:, 0]), low=pa.array(found[:, 1] - start), high=pa.array(found[:, 2] - start),
                )
            for k in np.flatnonzero(n_words > tile).tolist():
                for octave, a, b in tiles(int(n_words[k]), tile):
                    yield _nulls(
                        1, schema,
                        kind=pa.array([PIECE], pa.int32()), task=pa.array([task], pa.int64()),
                        nth=pa.array([met + k], pa.int64()), n_words=pa.array(n_words[k : k + 1]),
                        octave=pa.array([octave], pa.int64()), at=pa.array([a], pa.int64()),
                        ids=pa.array([numbers[k][a:b].astype("<i4").tobytes()], pa.binary()),
                    )
            met += len(texts)

    return run


def _solved(tile: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                x = np.frombuffer(row["ids"], "<i4").astype(np.int64)
                found = tile_fragments(x, row["octave"], row["at"], row["n_words"], tile)
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row[c]), pa.int64()) for c in ("task", "nth")]
                    + [pa.array(found[:, c]) for c in range(3)],
                    ["task", "nth", "period", "low", "high"],
                )

    return run


def stitched(fragments: DataFrame) -> DataFrame:
    """(task, nth, start, period, length) of the runs that the documents' fragments make up."""
    so_far = Window.partitionBy("task", "nth", "period").orderBy("low", "high")
    reach = F.max("high").over(so_far.rowsBetween(Window.unboundedPreceding, -1))
    islands = fragments.withColumn("new", F.when(F.col("low") > reach, 1).otherwise(0)).withColumn(
        "island", F.sum("new").over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    )
    runs = islands.groupBy("task", "nth", "period", "island").agg(
        F.min("low").alias("start"), (F.max("high") - F.min("low") + F.col("period")).alias("length")
    )
    return runs.where(F.col("length") >= F.greatest(F.lit(LEAST), TIMES * F.col("period"))).select(
        "task", "nth", "start", "period", "length"
    )


def _collapsed(with_text: bool):
    """Text and hash without the words after the first period of each run."""

    def run(batches):
        for batch in in_pieces(batches, 1):
            shas, kept = [], []
            for text, runs, n in zip(
                batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(),
                batch.column(3).to_pylist(), strict=True,
            ):
                edge = np.zeros(n + 1, np.int64)
                for r in runs:
                    edge[r["start"] + r["period"]] += 1
                    edge[r["start"] + r["length"]] -= 1
                stays = np.cumsum(edge) == 0
                digest, parts, at = hashlib.sha256(), [], 0
                for words in word_slices(text):
                    some = b" ".join(w for w, ok in zip(words, stays[at : at + len(words)].tolist(), strict=True) if ok)
                    at += len(words)
                    if some:
                        digest.update(b" " + some if parts else some)
                        parts.append(some if with_text or not parts else b"")
                shas.append(digest.hexdigest())
                kept.append(b" ".join(parts) if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(3), batch.column(2),
                    pa.array(kept, pa.binary()).cast(pa.string()), pa.array(shas, pa.string()),
                ],
                ["other", "n_words", "runs", "kept", "kept_sha256"],
            )

    return run


RUNS = T.ArrayType(
    T.StructType([T.StructField(c, T.LongType()) for c in ("start", "period", "length")])
)


def periodic_runs(docs: DataFrame, text: str = "text", tile: int = TILE, with_text: bool = True) -> DataFrame:
    """(other, n_words, runs, kept, kept_sha256) for each row of `docs`.

    `other` is a struct of all columns but the text; `runs` are (start, period, length) in words, by
    start, then period; `kept` is the text without the words that come after a run's first period,
    joined by one space (null unless `with_text`), and `kept_sha256` its hash.
    """
    other = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("other")
    slim = docs.select(other, F.col(f"`{text}`").cast("string").alias("text"))
    before = T.StructType().add("kind", T.IntegerType()).add("task", T.LongType()).add("nth", T.LongType())
    others = T.StructField("other", slim.schema["other"].dataType)  # null in rows of other kinds
    schema = T.StructType([*before, others, T.StructField("n_words", T.LongType())])
    schema = schema.add("text", T.StringType()).add("sha", T.StringType())
    for name in ("period", "low", "high", "octave", "at"):
        schema = schema.add(name, T.LongType())
    schema = schema.add("ids", T.BinaryType())
    passed = written(slim.mapInArrow(_first_pass(tile, with_text), schema), "tiles", "zstd")
    pieces = passed.where(F.col("kind") == PIECE).select("task", "nth", "n_words", "octave", "at", "ids")
    solved = pieces.repartition("task", "nth", "octave", "at").mapInArrow(
        _solved(tile), "task long, nth long, period long, low long, high long"
    )
    direct = passed.where(F.col("kind") == FRAGMENT).select("task", "nth", "period", "low", "high")
    runs = stitched(direct.unionByName(solved)).groupBy("task", "nth").agg(
        F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs")
    )
    held = passed.where(F.col("kind") == HELD).select("task", "nth", "other", "text", "n_words")
    none = F.array().cast(RUNS)
    result = T.StructType([others, T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS)])
    result = result.add("kept", T.StringType()).add("kept_sha256", T.StringType())
    collapsed = (
        held.join(runs, ["task", "nth"], "left")
        .select("other", "text", F.coalesce("runs", none).alias("runs"), "n_words")
        .mapInArrow(_collapsed(with_text), result)
    )
    done = passed.where(F.col("kind") == DONE).select(
        "other", "n_words", none.alias("runs"), F.col("text").alias("kept"), F.col("sha").alias("kept_sha256")
    )
    return done.unionByName(collapsed)


def planted(docs: DataFrame) -> DataFrame:
    """`docs`, the texts of a tenth of which go on periodically from some word on, by their doc_id."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = docs.select(
        "doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"),
        F.when(
            h % 10 == 0, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
        ).otherwise(F.array().cast("array<string>")).alias("words"),
    ).withColumn("n", F.size("words"))
    a = F.expr("cast(pmod(g, greatest(n, 1)) as int)")
    placed = words.withColumn("a", a).withColumn("p", F.expr("cast(1 + (n - a) div (3 + pmod(g, 8)) as int)"))
    head = F.expr("slice(words, 1, a)")
    tail = F.expr("slice(flatten(array_repeat(slice(words, a + 1, p), cast(ceil((n - a) / p) as int))), 1, n - a)")
    text = F.when(F.col("n") > 0, F.array_join(F.concat(head, tail), " ")).otherwise(F.col("text"))
    return placed.select("doc_id", text.alias("text"))


def digest(docs: DataFrame) -> DataFrame:
    found = periodic_runs(planted(docs), with_text=False)
    # The greatest exact quotient first: compared by products, as both are below 2^31.
    best = F.expr(
        """array_sort(runs, (x, y) -> CASE
            WHEN x.length * y.period > y.length * x.period THEN -1
            WHEN x.length * y.period < y.length * x.period THEN 1
            WHEN x.start < y.start THEN -1 WHEN x.start > y.start THEN 1
            WHEN x.period < y.period THEN -1 WHEN x.period > y.period THEN 1 ELSE 0 END)"""
    )
    listed = F.expr(
        "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    )
    first = F.get(best, F.lit(0))
    return found.select(
        F.col("other.doc_id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), first.alias("first"),
        F.sha2(listed, 256).alias("runs_sha256"), F.col("kept_sha256").alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", "first.start", "first.length", "first.period",
        F.expr("(1000 * first.length) div first.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
