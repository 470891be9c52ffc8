"""The registered queries of this subpackage: each applies one operator to its whole table and returns its full result.

op5, op9, op11 and op12 have SQL. The others can't be put into SQL that the other engine runs (it has no CRC-32, no seeded 64-bit hash and no way to train a
model), so tests/llm holds each against a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import Scratch
from . import ann, audit, exact, hilbert, html, lm, materialise, mixing, neardup, negatives, packing, quality, toxicity


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = Scratch(spark, "shards").at
    records = materialise.with_records(materialise.materialised(_read(spark, sf_dir, "documents"), folder), folder)
    return records.select("doc_id", "start", "n_ids", "slot", "shard", "position", F.crc32("record").alias("record_crc32"))


def op2_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hilbert.assign(_read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


def op3_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_read(spark, sf_dir, "embeddings"), "vec_id % 100 = 0", k=10)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = toxicity.train(docs, _read(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return toxicity.scores(docs, model).select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"), "sentence_start", "sentence_end", "sentence_score")


def op5_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_read(spark, sf_dir, "documents"), percent=85)


def op6_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "repeats")


def op7_shortest_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_read(spark, sf_dir, "documents"))


def op8_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_read(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(_read(spark, sf_dir, "documents"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = html.extract(_read(spark, sf_dir, "pages"), "page_id", "html", "url")
    return rows.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op11_pivot_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(_read(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", label)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op13_quality_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return quality.judged(docs, quality.train(docs, _read(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_training_order, op2_hilbert_shards, op3_kmeans_tree, op4_toxicity, op5_hyperminhash, op6_water_filling, op7_shortest_pack, op8_log_bilinear, op9_fingerprints, op10_main_text, op11_pivot_negatives, op12_filter_audit, op13_quality_ratio)
}
ORACLES: dict[str, str] = {
    "op5_hyperminhash": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
                                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
            FROM words
        ), single AS (
            SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
        ), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM single a JOIN single b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
        ), reach AS (
            SELECT doc_id, doc_id AS other FROM sets
            UNION
            SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
        )
        SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.other) AS component_id, s.doc_id = min(r.other) AS kept
        FROM sets s JOIN reach r USING (doc_id) GROUP BY s.doc_id, len(s.s)
    """,
    "op9_fingerprints": r"""
        WITH texts AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
        groups AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM texts JOIN groups USING (t)
    """,
    "op11_pivot_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(c AS DOUBLE)) FOR c IN embedding] AS x
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
        ), s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
        ), p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
        WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) QUALIFY row_number() OVER w <= 3
    """,
    "op12_filter_audit": r"""
        WITH d AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), m AS (
            SELECT doc_id, part, CAST(len(w) < 50 AS INTEGER) + 2 * CAST(100 * len(list_distinct(w)) < 65 * len(w) AS INTEGER)
                + 4 * CAST(100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t) AS INTEGER) + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INTEGER)
                + 16 * CAST(doc_id > min(doc_id) OVER (PARTITION BY t) AS INTEGER) AS mask
            FROM d
        ), l AS (
            SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
        ), c AS (
            SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask
        ), f AS (
            SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS f(name, bit)
        ), o AS (
            SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
            FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
        ), s AS (
            SELECT filter_order, k AS step, bits[k] AS bit, coalesce(list_sum(bits[1:k - 1]), 0) AS before FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS k)
        ), r AS (
            SELECT part, filter_order, CAST(step AS INTEGER) AS step, bit,
                coalesce(sum(n) FILTER (mask & CAST(before AS INTEGER) = 0 AND mask & bit = 0), 0) AS kept, coalesce(sum(n) FILTER (mask & CAST(before AS INTEGER) = 0 AND mask & bit > 0), 0) AS removed,
                coalesce(sum(n) FILTER (mask & CAST(before AS INTEGER) > 0 AND mask & bit > 0), 0) AS redundant, coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
                coalesce(sum(good) FILTER (mask & CAST(before AS INTEGER) = 0 AND mask & bit > 0), 0) AS good_lost, coalesce(sum(toxic) FILTER (mask & CAST(before AS INTEGER) = 0 AND mask & bit > 0), 0) AS toxic_lost
            FROM s, c GROUP BY part, filter_order, step, bit, before
        )
        SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
            CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
        FROM r
    """,
}
