"""Which records a run fetches: all that must be, and the longest unverified within a shared budget."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import nz


@dataclass(frozen=True)
class RunMode:
    sweep: bool
    stale_before: str
    window_start: str
    budget: int


def run_mode(last_full_sweep: str, now: str, full: bool = False, sweep: bool = False, verify_after_days: int = 7, window_days: int = 14, sweep_after_days: int = 31, budget: int = 600) -> RunMode:
    """A sweep is due if asked for, never done, or done too long ago. now: an ISO timestamp, second precision."""
    at = datetime.fromisoformat(now.replace("Z", "+00:00"))
    due = not last_full_sweep or last_full_sweep[:10] < (at - timedelta(days=sweep_after_days)).date().isoformat()
    stale = (at - timedelta(days=verify_after_days)).isoformat(timespec="seconds").replace("+00:00", now[19:] or "")
    return RunMode(full or sweep or due, stale, (at - timedelta(days=window_days)).date().isoformat(), budget)


def in_window(published: Column, start: str) -> Column:
    """ISO dates compare as strings; a missing one is before all."""
    return nz(published) >= F.lit(start)


def is_stale(verified_at: Column, before: str) -> Column:
    return nz(verified_at) <= F.lit(before)


def with_state(candidates: DataFrame, state: DataFrame) -> DataFrame:
    return candidates.join(state.select("key", "hash", "verified_at"), "key", "left")


def select_fetches(candidates: DataFrame, state: DataFrame, mode: RunMode) -> DataFrame:
    """candidates: source_seq (order of sources), key, in_window. Adds must; rows neither due nor within the budget are left out.

    The budget is one queue over all sources: by source, then by how long ago a row was verified, then by key.
    """
    rows = with_state(candidates, state)
    new = F.col("hash").isNull() | F.startswith(F.col("hash"), F.lit("delisted:"))
    rows = rows.withColumn("must", F.lit(mode.sweep) | new | F.coalesce(F.col("in_window"), F.lit(False)))
    must = rows.where("must")
    queue = rows.where(~F.col("must") & is_stale(F.col("verified_at"), mode.stale_before))
    # the first rows in order, picked by each task for itself and then merged: no task sorts the whole queue
    take = queue.orderBy("source_seq", nz(F.col("verified_at")), "key").limit(mode.budget)
    return must.unionByName(take)


def queue_places(candidates: DataFrame, state: DataFrame, mode: RunMode) -> DataFrame:
    """The rows of the shared queue within the budget, with their place in it."""
    rows = with_state(candidates, state).where(F.col("hash").isNotNull() & ~F.startswith(F.col("hash"), F.lit("delisted:")) & ~F.coalesce(F.col("in_window"), F.lit(False)))
    head = rows.where(is_stale(F.col("verified_at"), mode.stale_before)).orderBy("source_seq", nz(F.col("verified_at")), "key").limit(mode.budget)
    return head.withColumn("place", F.row_number().over(Window.orderBy("source_seq", nz(F.col("verified_at")), "key")))


def limit_per_source(rows: DataFrame, limit: int, source: str, *order: str | Column) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(source).orderBy(*order))).where(F.col("_n") <= limit).drop("_n")


def limited(chosen: DataFrame, limit: int) -> DataFrame:
    """The first rows of each source in the order in which they'd be fetched: those that must be, then the longest unverified."""
    return limit_per_source(chosen, limit, "source_seq", F.col("must").desc(), F.when(F.col("must"), "").otherwise(nz(F.col("verified_at"))), F.col("key"))


def first_that_parses(candidates: DataFrame, pages: DataFrame) -> DataFrame:
    """candidates: key, urls (best first). The record of the first address that has a page without an error: one row per key."""
    tries = candidates.select("key", F.posexplode("urls").alias("ord", "url"))
    hits = tries.join(pages.where(nz(F.col("error")) == "").withColumnRenamed("source_url", "url"), "url")
    fields = [c for c in pages.columns if c not in ("source_url", "error")]
    best = hits.groupBy("key").agg(F.min_by(F.struct("url", "ord", *fields), "ord").alias("r"))
    return best.select("key", "r.*")
