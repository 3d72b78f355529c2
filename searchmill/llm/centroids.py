"""k-means over integer vectors with Shallot's bounded search; equal to a full scan, ties included.

Components become integers, floor(scale * x), and centroids stay integers (floor of the mean), so
all distances are exact. Each round is one pass over the vectors' table, written to the shared
folder with what the next round needs to know of each vector: its nearest and second-nearest
centroid, an upper bound of the distance to the one and a lower bound of that to all others.

In the next round the bounds are widened by what the centroids moved. If they still don't overlap,
the vector stays. If they don't after the distance to its centroid is computed anew, it stays too.
Else the distance to the remembered second is computed, and the search starts at the closer of
the two. That one's neighbours are scanned in ascending order of their distance to it. A neighbour
farther than the vector's own distance to the start plus its distance to the second best so far
can't be one of the best two, nor can those after it; the ball shrinks as better ones are found.
What is left is compared in integers. Bounds are floats, rounded to the safe side.

Every pass also adds up its vectors per centroid, a row per task and centroid; these rows are
summed by Spark, and `k` sums come to the driver. `k` centroids go to all tasks. No other number
grows with the input.

Kept are vectors of exactly `dims` components, none null, NaN or infinite; others, empty and null
ones too, have no row in the result. Repeated rows, and rows with equal or null ids, are vectors
like any other. The first centroids are those of the smallest hashes of the id (null ids last,
ties by the components), fewer than `k` where there are fewer vectors. An empty table gives an
empty result. A centroid without vectors stays where it is. Columns besides the id and the vector
are ignored. Components beyond 2^26 in size after scaling fail the job, as their squared distances
don't fit 64 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchmill.llm.tables import written
from searchmill.llm.windows import release

DIMS = 64
SCALE = 256
K = 40
ROUNDS = 5
SEED = 2
LARGEST = 1 << 26
UP, DOWN = 1 + 1e-12, 1 - 1e-12

STATE = "vec_id {kind}, vector binary, cluster int, second int, upper double, lower double, n long, sums array<long>"


def distances(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Squared distances; `centroid` one for all or one for each."""
    apart = vectors - centroid
    return np.einsum("ij,ij->i", apart, apart)


class Search:
    """The centroids of a round, their neighbours by distance, and how far they moved."""

    def __init__(self, centroids: np.ndarray, moved: np.ndarray | None):
        self.centroids = centroids
        self.moved = moved
        k = len(centroids)
        square = np.array([distances(centroids, c) for c in centroids]).reshape(k, k)
        self.order = np.argsort(square, axis=1, kind="stable")
        self.between = np.sqrt(np.take_along_axis(square, self.order, 1)) * DOWN

    def nearest(self, vectors, cluster, second, upper, lower):
        """(cluster, second, upper, lower) after this round; all arrays are changed in place."""
        k = len(self.centroids)
        if k == 1:
            cluster[:], second[:], lower[:] = 0, 0, np.inf
            upper[:] = np.sqrt(distances(vectors, self.centroids[0])) * UP
            return cluster, second, upper, lower
        if self.moved is None:
            cluster[:], second[:] = 0, 1
            rest = np.arange(len(vectors))
        else:
            most = np.argmax(self.moved)
            others = np.full(k, self.moved[most])  # the farthest move of another centroid
            others[most] = np.delete(self.moved, most).max()
            upper[:] = (upper + self.moved[cluster]) * UP
            lower[:] = np.maximum(lower - others[cluster], 0) * DOWN
            rest = np.flatnonzero(upper >= lower)
        mine = distances(vectors[rest], self.centroids[cluster[rest]])
        upper[rest] = np.sqrt(mine) * UP
        if self.moved is not None:
            open_ = upper[rest] >= lower[rest]
            rest, mine = rest[open_], mine[open_]
        if len(rest):
            found = self._scan(vectors[rest], cluster[rest], mine, second[rest])
            cluster[rest], square, second[rest], square2 = found
            upper[rest], lower[rest] = np.sqrt(square) * UP, np.sqrt(square2) * DOWN
        return cluster, second, upper, lower

    def _scan(self, vectors, first, square, second):
        square2 = distances(vectors, self.centroids[second])
        swap = (square2 < square) | ((square2 == square) & (second < first))
        first, second = np.where(swap, second, first), np.where(swap, first, second)
        square, square2 = np.where(swap, square2, square), np.where(swap, square, square2)
        start, known = first.copy(), second.copy()
        to_start = np.sqrt(square) * UP
        by_start = np.argsort(start, kind="stable")
        cut = np.flatnonzero(np.diff(start[by_start])) + 1
        for live in np.split(by_start, cut):
            at = start[live[0]]
            for j, between in zip(self.order[at], self.between[at], strict=True):
                live = live[between <= to_start[live] + np.sqrt(square2[live]) * UP]
                if not len(live):
                    break
                if j == at:
                    continue
                new = live[known[live] != j]
                got = distances(vectors[new], self.centroids[j])
                best = (got < square[new]) | ((got == square[new]) & (j < first[new]))
                next_best = ~best & (got < square2[new])
                x = new[best]
                second[x], square2[x] = first[x], square[x]
                first[x], square[x] = j, got[best]
                x = new[next_best]
                second[x], square2[x] = j, got[next_best]
        return first, square, second, square2


def _vectors(column, dims: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), "<i4")
    return raw.reshape(-1, dims).astype(np.int64)


def _scaled(scale: int, dims: int):
    """Integer vectors of (vec_id, array of doubles)."""

    def run(batches):
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            whole = np.floor(scale * flat.astype(np.float64))
            if len(whole) and np.abs(whole).max() > LARGEST:
                raise ValueError(f"a component is beyond {LARGEST} after scaling by {scale}")
            raw = whole.astype("<i4").reshape(-1, dims)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([row.tobytes() for row in raw], pa.binary())],
                ["vec_id", "vector"],
            )

    return run


def _round(search: Search, dims: int, last: bool):
    """The vectors with their new state, then the sums of this task per centroid; in the last round
    (vec_id, cluster, distance)."""

    def run(batches):
        k = len(search.centroids)
        sums, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            vectors = _vectors(batch.column(1), dims)
            if search.moved is None:
                cluster, second = np.zeros(rows, np.int32), np.zeros(rows, np.int32)
                upper, lower = np.zeros(rows), np.zeros(rows)
            else:
                cluster, second, upper, lower = (batch.column(c).to_numpy().copy() for c in range(2, 6))
            search.nearest(vectors, cluster, second, upper, lower)
            if last:
                square = distances(vectors, search.centroids[cluster])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(cluster), pa.array(square)], ["vec_id", "cluster", "distance"]
                )
                continue
            order = np.argsort(cluster, kind="stable")
            begin = np.flatnonzero(np.diff(cluster[order], prepend=-1))
            met = cluster[order][begin]
            sums[met] += np.add.reduceat(vectors[order], begin, axis=0)
            n += np.bincount(cluster, minlength=k)
            yield _state(
                batch.column(0), batch.column(1), cluster, second, upper, lower,
                pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.list_(pa.int64())),
            )
        some = np.flatnonzero(n)
        if not last and len(some):
            none = np.zeros(len(some))
            kind = batch.column(0).type
            yield _state(
                pa.nulls(len(some), kind), pa.nulls(len(some), pa.binary()), some.astype(np.int32),
                some.astype(np.int32), none, none, pa.array(n[some]),
                pa.array(sums[some].tolist(), pa.list_(pa.int64())),
            )
        release()

    return run


def _state(vec_id, vector, cluster, second, upper, lower, n, sums) -> pa.RecordBatch:
    arrays = [vec_id, vector, *map(pa.array, (cluster, second, upper, lower)), n, sums]
    return pa.RecordBatch.from_arrays(
        arrays, ["vec_id", "vector", "cluster", "second", "upper", "lower", "n", "sums"]
    )


def integer_vectors(
    vectors: DataFrame, vec_id: str, column: str, dims: int = DIMS, scale: int = SCALE
) -> DataFrame:
    """(vec_id, vector) of the rows with `dims` finite components, as 32-bit integers."""
    values = F.col(column).cast("array<double>")
    fine = F.forall(
        values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    kind = vectors.schema[vec_id].dataType.simpleString()
    kept = vectors.where((F.size(values) == dims) & fine).select(F.col(vec_id).alias("vec_id"), values.alias("values"))
    return kept.mapInArrow(_scaled(scale, dims), f"vec_id {kind}, vector binary")


def first_centroids(kept: DataFrame, k: int, seed: int, dims: int) -> np.ndarray:
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(place.asc_nulls_last(), "vector").limit(k).select("vector").collect()
    return np.array([np.frombuffer(r["vector"], "<i4") for r in rows], np.int64).reshape(-1, dims)


def moved_centroids(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The floor of the mean of each centroid's vectors, from the sums that its tasks left."""
    dims = centroids.shape[1]
    totals = state.where("n IS NOT NULL").groupBy("cluster").agg(
        F.sum("n").alias("n"),
        F.array(*[F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(dims)]).alias("sums"),
    )
    out = centroids.copy()
    for row in totals.collect():  # at most k rows
        out[row["cluster"]] = [int(x) // int(row["n"]) for x in row["sums"]]
    return out


def cluster_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", column: str = "embedding",
    k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of each kept vector, the final integer centroids).

    The distance is the squared one to its centroid. Each of the rounds assigns all vectors, then
    moves the centroids; the result is assigned once more.
    """
    kind = vectors.schema[vec_id].dataType.simpleString()
    kept = written(integer_vectors(vectors, vec_id, column, dims, scale), "vectors", "zstd")
    centroids = first_centroids(kept, k, seed, dims)
    if not len(centroids):
        return kept.selectExpr("vec_id", "0 AS cluster", "0L AS distance"), centroids
    state, moved = kept, None
    for number in range(rounds):
        search = Search(centroids, moved)
        state = written(
            state.mapInArrow(_round(search, dims, False), STATE.format(kind=kind)), f"round-{number}", "zstd"
        )
        new = moved_centroids(state, centroids)
        moved = np.sqrt(distances(new, centroids)) * UP
        centroids = new
        state = state.where("n IS NULL")
    last = state.mapInArrow(
        _round(Search(centroids, moved), dims, True), f"vec_id {kind}, cluster int, distance long"
    )
    return written(last, "clusters"), centroids


def digest(vectors: DataFrame) -> DataFrame:
    found, centroids = cluster_vectors(vectors)
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    inertia = sum(int(r["d"]) for r in sums)
    rows = [
        (
            r["cluster"], int(r["d"]), inertia,
            hashlib.sha256(",".join(map(str, centroids[r["cluster"]].tolist())).encode()).hexdigest(),
        )
        for r in sums
    ]
    known = found.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    # At most one row for each centroid.
    return found.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
