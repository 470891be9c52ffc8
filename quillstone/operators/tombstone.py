"""Marking what has vanished, only where a run is sure to have seen everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import delisted_hash


def active(state: DataFrame) -> DataFrame:
    """Known keys that aren't marked as gone, with their authority."""
    return state.where(~F.startswith(F.col("hash"), F.lit("delisted:"))).withColumn("authority", F.split_part("key", F.lit(":"), F.lit(1)))


def vanished(state: DataFrame, seen: DataFrame, complete: DataFrame) -> DataFrame:
    """complete: authority, complete, errors. Active keys not seen, of authorities that were complete and without error.

    An authority that a run didn't select has no row in complete, and so loses nothing.
    """
    sure = complete.where("complete AND errors = 0").select("authority")
    return active(state).join(F.broadcast(sure), "authority", "left_semi").join(seen.select("key").distinct(), "key", "left_anti")


def split_gone(missing: DataFrame, archive: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(moved to the archive, gone without trace). archive: authority, slug."""
    rows = missing.withColumn("slug", F.regexp_replace("key", "^[^:]*:", ""))
    return rows.join(archive, ["authority", "slug"], "left_semi"), rows.join(archive, ["authority", "slug"], "left_anti")


def brake(known: Column, gone: Column, allow: bool = False) -> Column:
    """Too many have gone to be believed: more than a fifth, and more than five."""
    return F.lit(False) if allow else gone > F.greatest(F.lit(5).cast("long"), F.floor(known / 5).cast("long"))


def tombstones(state: DataFrame, seen: DataFrame, archive: DataFrame, complete: DataFrame, allow_mass: bool = False) -> DataFrame:
    """(key, authority, field, blocked): archived rows are marked always, delisted ones unless their authority's brake holds."""
    missing = vanished(state, seen, complete)
    archived, gone = split_gone(missing, archive)
    known = active(state).groupBy("authority").agg(F.count(F.lit(1)).alias("known"))
    n = gone.groupBy("authority").agg(F.count(F.lit(1)).alias("gone")).join(known, "authority")
    n = n.select("authority", brake(F.col("known"), F.col("gone"), allow_mass).alias("blocked"))  # a row per authority
    gone = gone.join(F.broadcast(n), "authority").select("key", "authority", F.lit("delisted").alias("field"), "blocked")
    return archived.select("key", "authority", F.lit("archived").alias("field"), F.lit(False).alias("blocked")).unionByName(gone)


def marked(extra: Column, field: Column | str, day: str) -> Column:
    """extra with x_<field> set, unless a mark of either kind is there: the first mark stays."""
    field = F.lit(field) if isinstance(field, str) else field
    has = F.map_contains_key(extra, "archived") | F.map_contains_key(extra, "delisted")
    return F.when(has, extra).otherwise(F.map_concat(extra, F.create_map(field, F.lit(day))))


def apply_marks(records: DataFrame, marks: DataFrame, day: str) -> DataFrame:
    rows = records.join(marks.where("NOT blocked").select("key", "field"), "key", "left")
    return rows.withColumn("extra", F.when(F.col("field").isNull(), F.col("extra")).otherwise(marked(F.col("extra"), F.col("field"), day))).drop("field")


def buried(state: DataFrame, marks: DataFrame) -> DataFrame:
    """State with the marked keys' hashes as tombstones, which no content's hash can equal, so a return is seen as a change."""
    rows = state.join(marks.where("NOT blocked").select("key", F.lit(True).alias("_gone")), "key", "left")
    return rows.withColumn("hash", F.when(F.col("_gone"), delisted_hash(F.col("hash"))).otherwise(F.col("hash"))).drop("_gone")
