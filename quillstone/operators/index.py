"""The searchable index and its manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_article, first_of, haystack, iso_date, nz


def index_rows(records: DataFrame) -> DataFrame:
    """Records as index rows, with the family to partition by and the haystack that searches read."""
    d, x = (lambda k: F.col("dates")[k]), (lambda k: nz(F.col("extra")[k]))
    iso = [iso_date(d(k)) for k in ("final_publishing_date", "publication_final_answer", "submission_date")]
    plain = ("authority", "qa_id", "joint_id", "legal_act", "topic", "status", "source_url", "question", "background", "answer")
    rows = records.select(
        "family", *plain[:4], clean_article(F.col("article")).alias("article"), *plain[4:6], first_of(*iso).alias("date"), x("delisted").alias("delisted"), x("archived").alias("archived"),
        F.substring(nz(F.col("retrieved_at")), 1, 10).alias("mirrored"), "source_url", "file", *plain[7:],
    )
    return with_haystack(rows)


def with_haystack(rows: DataFrame) -> DataFrame:
    return rows.withColumn("hay", haystack(*[F.col(c) for c in ("qa_id", "joint_id", "article", "topic", "question", "background", "answer")]))


def manifest(rows: DataFrame) -> DataFrame:
    """Per family: records, acts and authorities (distinct, sorted, joined by |)."""
    some = lambda c: F.array_join(F.array_sort(F.collect_set(F.nullif(F.col(c), F.lit("")))), "|")
    return rows.groupBy("family").agg(F.count(F.lit(1)).alias("count"), some("legal_act").alias("acts"), some("authority").alias("authorities"))


def family_totals(rows: DataFrame) -> DataFrame:
    """Records by family, and of all families."""
    return rows.rollup("family").agg(F.count(F.lit(1)).alias("count"), F.grouping("family").alias("_all")).select(F.when(F.col("_all") == 1, "all").otherwise(F.col("family")).alias("family"), "count")


def repeated_ids(rows: DataFrame, column: str, key: str) -> DataFrame:
    """Values of a column that several records have: how many, and their keys in order."""
    keys = F.transform(F.array_sort(F.collect_list(key)), lambda x: x.cast("string"))
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"), F.array_join(keys, " ").alias("keys")).where("n > 1")


def oldest_verified(state: DataFrame) -> DataFrame:
    """The day the longest unverified active record was verified; '' if there is none. Tombstones, whose time stands still, don't count."""
    alive = state.where(~F.startswith(nz(F.col("hash")), F.lit("delisted:")))
    return alive.agg(nz(F.substring(F.min(F.nullif(F.col("verified_at"), F.lit(""))), 1, 10)).alias("oldest_verified"))


def manifest_meta(rows: DataFrame, state: DataFrame, last_full_sweep: str) -> DataFrame:
    """One row: total (records of all families), last_full_sweep, oldest_verified."""
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    return total.join(oldest_verified(state)).select("total", F.lit(last_full_sweep).alias("last_full_sweep"), "oldest_verified")  # one row and one row


def write_index(rows: DataFrame, path: str) -> None:
    """Index rows as JSON per family; what an earlier build left goes."""
    rows.drop("hay").write.mode("overwrite").partitionBy("family").json(path)


def write_search_table(rows: DataFrame, path: str) -> None:
    """Index rows with their haystack as Parquet per family, for searches that read no text twice and only the families asked for."""
    rows.write.mode("overwrite").partitionBy("family").parquet(path)


def write_manifest(rows: DataFrame, path: str) -> None:
    manifest(rows).coalesce(1).write.mode("overwrite").json(path)
