"""The operators as queries over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchmill.llm import (
    centroids,
    decontamination,
    ngram_join,
    packing,
    periodic_runs,
    quality,
    simhash,
    substring_dedup,
    suffix_dedup,
    text_prints,
    token_files,
)
from searchmill.llm.perspectives import rotate_perspectives
from searchmill.llm.tables import read_table
from searchmill.llm.url_filter import LEAST, RULES, Z, filter_urls

TOKENIZER = "byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


_LETTERS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_LOWER = """translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op3_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from every participant's side."""
    return rotate_perspectives(read_table(spark, sf_dir, "conversations"))


SQL["op3_perspectives"] = """
WITH t AS (
    SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text
    FROM conversations
), placed AS (
    SELECT *, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(speaker), encode(text)) - 1 AS position
    FROM t
), people AS (
    SELECT DISTINCT conv_id AS c, speaker AS perspective FROM t WHERE speaker <> 'system'
), seen AS (
    SELECT conv_id, perspective, position, turn, text,
        CASE WHEN speaker = perspective THEN 'assistant'
             WHEN speaker = 'system' THEN 'system' ELSE 'user' END AS role,
        CASE WHEN speaker NOT IN (perspective, 'system') THEN speaker END AS name
    FROM placed JOIN people ON conv_id IS NOT DISTINCT FROM c
), rendered AS (
    SELECT conv_id, perspective, position, turn, role, name,
        '<|' || role || '|>' || coalesce(' ' || name, '') || chr(10) || text || '<|end|>' || chr(10)
            AS rendered
    FROM seen
), started AS (
    SELECT *, CAST(coalesce(sum(length(rendered)) OVER (
        PARTITION BY conv_id, perspective ORDER BY position
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
    FROM rendered
)
SELECT *,
    CASE WHEN role = 'assistant' THEN start + 14 END AS mask_start,
    CASE WHEN role = 'assistant' THEN start + length(rendered) - 1 END AS mask_end
FROM started
"""


@query
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return ngram_join.similar_documents(read_table(spark, sf_dir, "documents"))


SQL["op4_ngram_join"] = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, {_LETTERS}) AS ws FROM documents
), grams AS (
    SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(ws) - 4, 1) + 1), lambda i:
        array_to_string(ws[i:i+4], ' '))) AS g
    FROM docs WHERE len(ws) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM grams a JOIN grams b USING (g)
    WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM common JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
    WHERE c * 5 >= 4 * (s.n + t.n - c)
), reach AS (
    SELECT x AS a, x AS b FROM links UNION SELECT a, y FROM reach JOIN links ON b = x
), classes AS (SELECT a, min(b) AS class_id FROM reach GROUP BY a),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n, 0) AS n_links
FROM docs LEFT JOIN classes ON a = doc_id LEFT JOIN counts ON x = doc_id
"""


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document."""
    return quality.digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op6_text_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, their edited texts and their neighbours."""
    return text_prints.digest(read_table(spark, sf_dir, "documents"))


@query
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL. The pages have no outcomes of their own: `labels.quality` of the same
    number stands for them."""
    labels = read_table(spark, sf_dir, "labels")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    judged = filter_urls(read_table(spark, sf_dir, "pages"), outcomes)
    return judged.select("page_id", "host", "path", "rule", "verdict", "n_labelled")


def _rules_sql() -> str:
    fits = [
        (
            len(host + path),
            f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}'))",
            host + path,
            verdict,
        )
        for verdict, host, path in RULES
    ]
    fits.sort(key=lambda x: -x[0])
    rule = " ".join(f"WHEN {test} THEN '{name}'" for _, test, name, _ in fits)
    said = " ".join(f"WHEN {test} THEN '{verdict}'" for _, test, _, verdict in fits)
    return f"CASE {rule} END AS rule, CASE {said} END AS said"


def _level_sql(level: str, keys: str, known: str) -> str:
    on = " AND ".join(f"k.{x} = p.{x}" for x in keys.split(", "))
    return f"""
{level}_g AS (
    SELECT {keys}, sum(good) AS good, sum(n) AS n, max(prior) AS prior FROM {known} GROUP BY ALL
), {level}_s AS (
    SELECT 1 / least(greatest(coalesce(
        sum((good / n - prior) ** 2 * n - prior * (1 - prior))
        / nullif(sum(prior * (1 - prior) * (n - 1)), 0), 0), 0.001), 0.999) - 1 AS s
    FROM {level}_g WHERE n > 0
), {level}_p AS (
    SELECT {keys}, prior * s + good AS a, (1 - prior) * s + n - good AS b FROM {level}_g, {level}_s
), {level}_k AS (
    SELECT k.* EXCLUDE (prior), a / (a + b) AS prior, a, b FROM
    (SELECT host, domain, suffix, good, n, prior FROM {known}) k JOIN {level}_p p ON {on}
)"""


SQL["op7_url_filter"] = f"""
WITH parts AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3)
        ELSE '' END AS rest
    FROM pages
), hosts AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts
), counts AS (
    SELECT host, coalesce(sum(CAST(quality AS DOUBLE)), 0) AS good, count(quality) AS n
    FROM hosts LEFT JOIN labels ON page_id = doc_id GROUP BY host
), known AS (
    SELECT host, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain,
        string_split(host, '.')[-1] AS suffix, good, n,
        (SELECT coalesce(sum(good) / nullif(sum(n), 0), 0.5) FROM counts) AS prior
    FROM counts
), {_level_sql("s", "suffix", "known")}, {_level_sql("d", "suffix, domain", "s_k")},
{_level_sql("h", "suffix, domain, host", "d_k")}, judged AS (
    SELECT page_id, host, path, {_rules_sql()} FROM hosts
)
SELECT page_id, j.host, path, rule, n AS n_labelled, coalesce(said, CASE WHEN
    greatest(prior - {Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 0) >= {LEAST}
    THEN 'allow' ELSE 'block' END) AS verdict
FROM judged j JOIN h_k ON j.host = h_k.host
"""


def _covered_sql(listed: str, n_units: str, unit: str, key: str, n: str, joined: str, digest: str) -> str:
    """SQL of op1 and op9: units of a document, and the key of the window from each unit on."""
    return f"""
WITH listed AS ({listed}), flat AS (
    SELECT doc_id, unnest({unit}) AS u, unnest(range(1, {n_units} + 1)) AS i,
        unnest(list_transform(range(1, {n_units} + 1), lambda i:
            CASE WHEN i + 49 <= {n_units} THEN {key} END)) AS key
    FROM listed
), judged AS (
    SELECT doc_id, u, i, key IS NOT NULL AND min(doc_id) OVER (PARTITION BY key) < doc_id AS dup
    FROM flat
), covered AS (
    SELECT *, bool_or(dup) OVER (PARTITION BY doc_id ORDER BY i
        ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
    FROM judged
), edges AS (
    SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS first
    FROM covered
), counted AS (
    SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS n_removed, count(*) FILTER (first)
        AS n_spans, string_agg(u, '{joined}' ORDER BY i) FILTER (NOT gone) AS kept
    FROM edges GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n, 0) AS {n}, coalesce(n_removed, 0) AS n_removed,
    coalesce(n_spans, 0) AS n_spans, {digest} AS kept_sha256
FROM documents d LEFT JOIN counted USING (doc_id)
"""


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without passages of 50 words that start in an earlier one."""
    return substring_dedup.digest(read_table(spark, sf_dir, "documents"))


SQL["op1_substring_dedup"] = _covered_sql(
    r"SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS us FROM documents",
    "len(us)",
    "us",
    "md5(array_to_string(us[i:i+49], ' '))",
    "n_words",
    " ",
    "sha256(coalesce(kept, ''))",
)


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    return decontamination.digest(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )


SQL["op2_decontamination"] = f"""
WITH items AS (
    SELECT item_id, regexp_extract_all({_LOWER}, {_LETTERS}) AS ws FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, least(len(ws), 10) AS n,
        unnest(list_transform(range(1, greatest(len(ws) - 9, 1) + 1), lambda i:
            array_to_string(ws[i:i+least(len(ws), 10)-1], ' '))) AS w
    FROM items WHERE len(ws) > 0
), sizes AS (SELECT DISTINCT n FROM item_windows), keys AS (SELECT DISTINCT n, w FROM item_windows),
docs AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, {_LETTERS}) AS ws FROM documents
), windows AS (
    SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) AS i,
        unnest(list_transform(range(1, len(ws) - n + 2), lambda i: array_to_string(ws[i:i+n-1], ' '))) AS w
    FROM docs, sizes
), hits AS (
    SELECT doc_id, i, n, w FROM windows JOIN keys USING (n, w)
), words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), pairs AS (
    SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits JOIN item_windows USING (n, w)
), listed AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM pairs GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without strings of 50 bytes that start in an earlier one."""
    return suffix_dedup.digest(read_table(spark, sf_dir, "documents"))


SQL["op9_suffix_dedup"] = _covered_sql(
    "SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents",
    "length(h) // 2",
    "regexp_extract_all(h, '..')",
    "md5(substr(h, 2 * i - 1, 100))",
    "n_bytes",
    "",
    "sha256(unhex(coalesce(kept, '')))",
)


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 ids."""
    return packing.digest(read_table(spark, sf_dir, "documents"), TOKENIZER)


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token files, read back."""
    return token_files.digest(read_table(spark, sf_dir, "documents"), TOKENIZER)


@query
def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.digest(read_table(spark, sf_dir, "documents"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, a tenth of which are made periodic, and what is left without them."""
    return periodic_runs.digest(read_table(spark, sf_dir, "documents"))


# All valid runs have 16 words or more in a row that equal those a period on.
SQL["op12_periodic_runs"] = r"""
WITH crc_table AS (
    SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda a, b: xor(a >> 1, 3988292384 * (a & 1)))) AS t
), listed AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
        xor(list_reduce(list_prepend(4294967295,
            list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
            lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h
    FROM documents, crc_table
), scaled AS (
    SELECT *, len(ws) AS n, (h // 10) % greatest(len(ws), 1) AS a FROM listed
), docs AS (
    SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
        ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END])
        ELSE ws END AS ws
    FROM scaled
), grams AS (
    SELECT doc_id, n, unnest(range(n - 15)) AS i,
        unnest(list_transform(range(n - 15), lambda i: array_to_string(ws[i+1:i+16], ' '))) AS g
    FROM docs WHERE n >= 24
), pairs AS (
    SELECT x.doc_id, y.i - x.i AS q, x.i FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.g = y.g
    WHERE y.i > x.i AND 3 * (y.i - x.i) <= x.n
), islands AS (
    SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs
), stretches AS (
    SELECT doc_id, q, min(i) AS s, count(*) + 15 + q AS l FROM islands GROUP BY doc_id, q, island
), runs AS (
    SELECT doc_id, s, l, min(q) AS q FROM stretches WHERE l >= greatest(24, 3 * q) GROUP BY doc_id, s, l
), best AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY l / q DESC, s, q) AS place FROM runs
), counted AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS listed,
        max(s) FILTER (place = 1) AS start, max(l) FILTER (place = 1) AS length, max(q) FILTER (place = 1) AS period
    FROM best GROUP BY doc_id
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs
), words AS (
    SELECT doc_id, unnest(ws) AS w, unnest(range(n)) AS i FROM docs
), kept AS (
    SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS kept FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
    sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM docs LEFT JOIN counted USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after five rounds of k-means."""
    return centroids.digest(read_table(spark, sf_dir, "embeddings"))


def _means_sql(rounds: int) -> str:
    """The rounds a0, c1, a1, ...: vectors by nearest centroid, then the centroids that follow."""
    out = []
    for r in range(rounds + 1):
        out.append(f"""
a{r} AS MATERIALIZED (
    SELECT r, any_value(vec_id) AS vec_id, any_value(v.p) AS p, arg_min(c, d * 64 + c) AS c, min(d) AS d
    FROM (SELECT r, vec_id, v.p, c, list_sum(list_transform(list_zip(v.p, m.p),
        lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT AS d FROM v, c{r} m) v
    GROUP BY r
)""")
        if r < rounds:
            out.append(f"""
m{r + 1} AS (
    SELECT c, i, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n
    FROM (SELECT c, unnest(p) AS x, unnest(range(64)) AS i FROM a{r}) GROUP BY c, i
), c{r + 1} AS MATERIALIZED (
    SELECT c, list(((s - (((s % n) + n) % n)) // n)::BIGINT ORDER BY i) AS p FROM m{r + 1} GROUP BY c
    UNION ALL SELECT c, p FROM c{r} ANTI JOIN m{r + 1} USING (c)
)""")
    return ",".join(out)


SQL["op13_centroids"] = f"""
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS p
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
    SELECT c, p FROM (SELECT p, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c FROM v) WHERE c < 40
), {_means_sql(5)}, sums AS (
    SELECT c, sum(d)::BIGINT AS cluster_inertia FROM a5 GROUP BY c
)
SELECT vec_id, c::INTEGER AS cluster, d::BIGINT AS distance, cluster_inertia,
    (SELECT sum(d)::BIGINT FROM a5) AS inertia, sha256(array_to_string(c5.p, ',')) AS centroid_sha256
FROM a5 JOIN sums USING (c) JOIN c5 USING (c)
"""
