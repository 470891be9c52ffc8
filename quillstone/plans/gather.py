"""What a run needs from the portals and the register, asked for as the settings say: a listing and its window by their facets, counts beforehand, register rows from raw answers.

A part that can't be had is noted as failed, and the run concludes nothing from it. The archive is asked for only if something has vanished.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import select
from ..schemas import REGISTER_ROW
from ..scratch import Scratch
from ..sources import portal, register
from .config import Config
from .mirror import AUTHORITIES, Landed

#: Asks one address and returns its text: what to post (None: get) and headers follow.
Ask = Callable[[str, str | None, dict[str, str]], str]


def _ask_by(spark: SparkSession, fetch: portal.Fetch, url: str) -> str | None:
    """One address's text, None if it can't be had."""
    row = fetch(spark.createDataFrame([(url,)], "url string")).select("body", "error").first()
    return row["body"] if row is not None and row["error"] is None else None


def listed(spark: SparkSession, base: str, facets: portal.Facets, fetch: portal.Fetch, scratch: Scratch, max_pages: int) -> tuple[DataFrame, bool]:
    """(url of all entries of a listing, whether it failed)."""
    none = spark.createDataFrame([], "url string")
    try:
        links, asked = portal.walk_by_waves(spark.createDataFrame([(facets.status, facets.listing(base))], "source string, address string"), fetch, scratch, max_pages=max_pages)
    except register.ListingTruncated:
        return none, True
    # a page that can't be had twice is no empty page
    lost = asked.groupBy("page_no").agg(F.bool_and(F.col("error").isNotNull()).alias("lost")).where("lost")
    return links.select(F.concat(F.lit(base), "link").alias("url")), not lost.isEmpty()


def register_rows(spark: SparkSession, config: Config, service: str | None, key: str, ask: Ask | None, scratch: Scratch) -> tuple[DataFrame, bool]:
    """(register rows, whether the register failed); none are needed where no joint act is set."""
    none = spark.createDataFrame([], REGISTER_ROW)
    if not config.joint_acts or service is None or ask is None:
        return none, bool(config.joint_acts)
    try:
        model, body = register.ask_register(service, key, ask)
        rows, bad = register.read_answers(scratch.cut(spark.createDataFrame([(1, body)], "result int, body string")), list(model.columns))
        if not bad.isEmpty():
            return none, True
        return scratch.cut(rows.drop("result", "i")), False
    except (OSError, LookupError, TypeError, json.JSONDecodeError):
        return none, True


def gather(spark: SparkSession, config: Config, base: str, fetch: portal.Fetch, now: str, last_full_sweep: str, work: str, service: str | None = None, key: str = "", ask: Ask | None = None, authorities: tuple[str, ...] = AUTHORITIES, full: bool = False, sweep: bool = False) -> Landed:
    """base: the portal's address; fetch: from addresses to responses; service, key, ask: the register's service, its published report, and what asks it. work: a folder for the answers, which go with the session."""
    scratch = Scratch(spark, "gather", work)
    sub = lambda name: Scratch(spark, name, work)
    none = spark.createDataFrame([], "url string")
    rows, register_failed = register_rows(spark, config, service, key, ask, scratch)
    acts = tuple(config.listing_act_ids)
    if not acts or "eba" not in authorities:
        return Landed(rows, none, none, none, register_failed=register_failed, fetch=fetch)
    mode = select.run_mode(last_full_sweep, now, full, sweep, config.verify_after_days, config.window_days, config.sweep_after_days, config.daily_verify_budget)
    final = portal.Facets("final", acts)
    announced = portal.tab_numbers(_ask_by(spark, fetch, final.counts(base)) or "").get("final")
    too_long = announced is not None and not portal.fits(announced, config.max_pages)
    listing, failed = (none, False) if too_long else listed(spark, base, final, fetch, sub("final"), config.max_pages)
    window, window_announced = none, None
    if not mode.sweep and not failed and not too_long:
        recent = portal.Facets("final", acts, date.fromisoformat(mode.window_start))
        window_announced = portal.tab_numbers(_ask_by(spark, fetch, recent.counts(base)) or "").get("final")
        window, lost = listed(spark, base, recent, fetch, sub("window"), config.max_pages)
        window = none if lost else window  # without it only new and stale records are asked for
    archive = lambda: listed(spark, base, portal.Facets("archive", acts), fetch, sub("archive"), config.max_pages)
    return Landed(rows, listing, archive, window, announced=announced, window_announced=window_announced, register_failed=register_failed, listing_failed=failed, fetch=fetch)
