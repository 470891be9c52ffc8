"""Joining what the register and a page say, and writing only what changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import act_ref, first_of, nz


def put_if_absent(old: Column, new: Column) -> Column:
    """old with those entries of new whose key it lacks and whose value isn't missing."""
    more = F.map_filter(new, lambda k, v: (nz(v) != "") & ~F.map_contains_key(old, k))
    return F.map_concat(old, more)


def merged(discovered: DataFrame, pages: DataFrame) -> DataFrame:
    """Register rows and page records by key. The register is believed on joint id, status, act and who answered, the page on article and topic.

    Where the page names another act than the register, the page's own words are kept aside.
    """
    r = discovered.select("key", *[F.col(c).alias(f"r_{c}") for c in ("joint_id", "status", "legal_act_raw", "article", "topic", "answered_by", "date_submission", "date_publication") if c in discovered.columns])
    rows = pages.join(r, "key")
    page_act, act = nz(F.col("legal_act_raw")), nz(F.col("r_legal_act_raw"))
    differs = (page_act != "") & (act != "") & (act_ref(page_act) != act_ref(act))
    lone = F.create_map(F.lit("portal_legal_act"), page_act)
    extra = F.coalesce("extra", F.create_map().cast("map<string,string>"))
    extra = F.when(differs, F.map_concat(F.map_filter(extra, lambda k, _: k != "portal_legal_act"), lone)).otherwise(extra)
    if "answered_by" in discovered.columns:
        by = nz(F.col("r_answered_by"))
        extra = F.when(by != "", F.map_concat(F.map_filter(extra, lambda k, _: k != "answered_by"), F.create_map(F.lit("answered_by"), by))).otherwise(extra)
    given = F.create_map(F.lit("submission_to_esas"), F.col("r_date_submission"), F.lit("publication_final_answer"), F.col("r_date_publication"))
    dates = put_if_absent(F.coalesce("dates", F.create_map().cast("map<string,string>")), given)
    new = {
        "joint_id": first_of(F.col("r_joint_id"), F.col("joint_id")),
        "status": first_of(F.col("r_status"), F.col("status")),
        "article": first_of(F.col("article"), F.col("r_article")),
        "topic": first_of(F.col("topic"), F.col("r_topic")),
        "legal_act_raw": first_of(act, page_act),
        "extra": extra,
        "dates": dates,
    }
    return rows.withColumns(new).drop(*[c for c in rows.columns if c.startswith("r_")])


def with_status(rows: DataFrame, required: str) -> DataFrame:
    """Rows whose status holds the required word; to be asked for after presence is noted, so that the others stay seen."""
    return rows.where(F.contains(F.lower(nz(F.col("status"))), F.lit(required.lower()))) if required else rows


def changed(records: DataFrame, state: DataFrame, stored: DataFrame, full: bool = False) -> DataFrame:
    """records: key, content_hash and more. Those whose hash isn't the state's, or that aren't stored; all of them if full."""
    rows = records.join(state.select("key", F.col("hash").alias("_hash")), "key", "left")
    rows = rows.join(stored.select("key").distinct().withColumn("_stored", F.lit(True)), "key", "left")
    differs = ~F.col("_hash").eqNullSafe(F.col("content_hash")) | F.col("_stored").isNull()
    return rows.where(F.lit(full) | differs).drop("_hash", "_stored")


def upserted(old: DataFrame, new: DataFrame, key: str = "key") -> DataFrame:
    """old with the rows of new in place of those of the same key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def next_state(state: DataFrame, fetched: DataFrame, now: str) -> DataFrame:
    """State after a run: fetched rows (key, content_hash) get their hash, and all of them the time; others stay."""
    new = fetched.select("key", F.col("content_hash").alias("hash"), F.lit(now).alias("verified_at"))
    return upserted(state.select("key", "hash", "verified_at"), new)
