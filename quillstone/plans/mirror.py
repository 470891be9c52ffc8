"""A whole run: discover, select, fetch, parse, merge, write what changed, mark what vanished.

Everything up to the commit is a plan over scratch tables; nothing is written in place, so a run that fails leaves the old state as it was. Each step's table is written
once, and what the run counts is observed on those writes: no step is read again to be counted.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from itertools import count

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.html import parse_pages
from ..functions.text import act_family, finalised, nz, url_slug
from ..operators import merge, runs, select, tombstone
from ..schemas import COUNTERS, RECORD, STATE
from ..scratch import Scratch
from ..sources import corpus, portal, register
from ..sources.store import Store, Version, bucket
from .config import Config

AUTHORITIES = ("eba", "eiopa", "esma")
#: Tables of a mirror's store: records by family, the state of their keys by bucket.
TABLES = {"records": (f"key STRING, {RECORD}", "family"), "state": (f"{STATE}, bucket STRING", "bucket")}


@dataclass
class Landed:
    """register: register rows. listing, archive: (url). window: (url) published lately. pages: (authority, url, html), or fetch, which answers addresses when they are needed.

    announced: how many the listing says it has. archive may be a function that returns it and whether it failed; it is called only if something has vanished.
    """

    register: DataFrame
    listing: DataFrame
    archive: DataFrame | Callable[[], tuple[DataFrame, bool]]
    window: DataFrame
    pages: DataFrame | None = None
    announced: int | None = None
    window_announced: int | None = None
    register_failed: bool = False
    listing_failed: bool = False
    archive_failed: bool = False
    fetch: portal.Fetch | None = None


@dataclass
class Run:
    """What a run found: tables for the commit, a row of counters per authority, and whether all went well."""

    records: DataFrame
    state: DataFrame
    marks: DataFrame
    totals: DataFrame
    ok: bool
    last_full_sweep: str
    run: DataFrame | None = None  # the run log's row; none for a limited run
    changed: DataFrame | None = None  # the records that the run writes: new, changed and marked ones
    verified: DataFrame | None = None  # the state's rows that it changes
    scratch: Scratch | None = None


Watched = tuple[Observation, tuple[str, ...]]


@dataclass
class Counts:
    """Counters by authority, observed on the writes of a run's steps. The authorities are few, so each has a metric of its own."""

    authorities: tuple[str, ...]
    n: dict[str, dict[str, int]] = field(default_factory=dict)
    names: count = field(default_factory=count)

    def __post_init__(self) -> None:
        self.n = {a: dict.fromkeys(COUNTERS, 0) for a in self.authorities}

    def watched(self, df: DataFrame, **conditions: Column) -> tuple[DataFrame, Watched]:
        """df with the numbers of rows, by authority, that conditions hold for."""
        seen = Observation(f"step {next(self.names)}")
        metrics = [F.count_if((F.col("authority") == a) & c).alias(f"{name} {a}") for name, c in conditions.items() for a in self.authorities]
        return df.observe(seen, *metrics), (seen, tuple(conditions))

    def note(self, watched: Watched, /, **counters: str) -> dict[str, dict[str, int]]:
        """Adds what was observed of a table that has been written: counters (names) by conditions (values). Returns the numbers by condition and authority."""
        numbers = watched[0].get  # without metrics where the plan turned out to be empty
        got = {c: {a: numbers.get(f"{c} {a}") or 0 for a in self.authorities} for c in watched[1]}
        for counter, condition in counters.items():
            for a, value in got[condition].items():
                self.n[a][counter] += value
        return got

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(a, *(c[k] for k in COUNTERS)) for a, c in sorted(self.n.items()) if any(c.values())]
        return spark.createDataFrame(rows, "authority string, " + ", ".join(f"{c} long" for c in COUNTERS))


def key_of(authority: Column, url: Column) -> Column:
    return F.concat(authority, F.lit(":"), url_slug(url))


SAID = ("joint_id", "status", "legal_act_raw", "article", "topic", "answered_by", "date_submission", "date_publication")


def joint_entries(rows: DataFrame, config: Config, mode: select.RunMode, authorities: tuple[str, ...]) -> DataFrame:
    """Register rows of all joint acts, in their order, with repaired links; one without an address has the url ''."""
    out = None
    for seq, act in enumerate(config.joint_acts.values()):
        mine = register.repair_links(register.filter_register(rows, act.register_act, list(act.statuses), list(authorities)))
        link, urls = nz(F.col("link")), F.concat(F.array("link"), "link_alts")
        mine = mine.select(F.lit(seq).alias("source_seq"), "authority", key_of(F.col("authority"), link).alias("key"), link.alias("url"), urls.alias("urls"), select.in_window(F.col("date_publication"), mode.window_start).alias("in_window"), F.lit(act.act_ref).alias("default_ref"), *[nz(F.col(c)).alias(c) for c in SAID])
        out = mine if out is None else out.unionByName(mine)
    return out


def listed_entries(listing: DataFrame, window: DataFrame, config: Config) -> DataFrame:
    """Entries of the one listing, after all joint acts: a row per address."""
    fresh = window.select(url_slug(F.col("url")).alias("slug")).distinct().withColumn("in_window", F.lit(True))
    rows = listing.select("url").distinct().withColumn("slug", url_slug(F.col("url"))).join(fresh, "slug", "left")
    return rows.select(F.lit(len(config.joint_acts)).alias("source_seq"), F.lit("eba").alias("authority"), F.concat(F.lit("eba:"), "slug").alias("key"), "url", F.array("url").alias("urls"), F.coalesce("in_window", F.lit(False)).alias("in_window"), F.lit(config.default_act_ref).alias("default_ref"), *[F.lit("").alias(c) for c in SAID])


def candidates(entries: DataFrame) -> DataFrame:
    """One row per key: that of the first source that names it, so a record in two acts belongs to the first, and one that the register names isn't the listing's."""
    rest = [c for c in entries.columns if c not in ("key", "url")]
    first = F.min_by(F.struct(*rest), F.struct("source_seq", "url"))
    return entries.where("url <> ''").groupBy("key").agg(first.alias("r")).select("key", "r.*")


def mirror_run(landed: Landed, records: DataFrame, state: DataFrame, last_full_sweep: str, config: Config, now: str, work: str, authorities: tuple[str, ...] = AUTHORITIES, limit_per_source: int = 0, full: bool = False, sweep: bool = False, allow_mass_delisting: bool = False) -> Run:
    """records: the stored ones (with key). The result's tables replace the stored ones when the caller commits them, as commit() does. work: a shared folder for the run's steps, which go when nothing reads them any more, at the latest with the session."""
    spark = records.sparkSession
    mode = select.run_mode(last_full_sweep, now, full, sweep, config.verify_after_days, config.window_days, config.sweep_after_days, config.daily_verify_budget)
    n = landed.window.select(url_slug(F.col("url"))).distinct().count()
    if n > config.window_max or (landed.window_announced is not None and n > 1.5 * landed.window_announced + 3):
        landed = replace(landed, window=landed.window.where("false"))  # not to be believed
    # a listing that can't be read to its end within the page budget isn't begun
    too_long = landed.announced is not None and "eba" in authorities and not portal.fits(landed.announced, config.max_pages)
    if too_long or landed.listing_failed or "eba" not in authorities:
        landed = replace(landed, listing=landed.listing.where("false"), window=landed.window.where("false"))
    scratch, counts = Scratch(spark, "mirror", work), Counts(authorities)

    def keep(df: DataFrame, **conditions: Column) -> tuple[DataFrame, Watched | None]:
        """A step's result, written once, and what was seen of it."""
        if not conditions:
            return scratch.cut(df), None
        df, seen = counts.watched(df, **conditions)
        return scratch.cut(df), seen

    entries = listed_entries(landed.listing, landed.window, config)
    if config.joint_acts:
        entries = joint_entries(landed.register, config, mode, authorities).unionByName(entries)
    of_listing = F.col("source_seq") == len(config.joint_acts)
    entries, seen = keep(entries, there=F.col("url") != "", lost=F.col("url") == "", listed=of_listing)
    got = counts.note(seen, enumerated="there", errors="lost")
    listed = sum(got["listed"].values())
    found, _ = keep(candidates(entries))
    chosen = select.select_fetches(found, state, mode)
    if limit_per_source:
        chosen = select.limited(chosen, limit_per_source)
    chosen, seen = keep(chosen, chosen=F.lit(True))
    asked = counts.note(seen)["chosen"]
    parse = lambda pages: parse_pages(pages.withColumnRenamed("body", "html"), config.joint_formats).withColumn("url", F.col("source_url"))
    if landed.fetch is not None:
        served, _ = portal.first_answers(chosen.select("key", "authority", "urls"), landed.fetch, parse, Scratch(spark, "pages", work))
    else:
        pages = landed.pages.join(chosen.select("authority", F.explode("urls").alias("url")).distinct(), ["authority", "url"], "left_semi")
        parsed, _ = keep(parse(pages).drop("url"))
        served = select.first_that_parses(chosen, parsed)
    said = chosen.select("key", *SAID)
    rows, _ = keep(merge.merged(said, served.withColumn("source_url", F.col("url"))))
    rows = rows.join(chosen.select("key", "source_seq", "default_ref"), "key")
    act = finalised(F.col("legal_act_raw"), F.lit(""), "", config.act_labels)
    by_default = finalised(F.lit(""), F.lit(""), F.col("default_ref"), config.act_labels)
    rows = rows.withColumn("act", F.when(nz(F.col("legal_act_raw")) == "", by_default).otherwise(act))
    rows = rows.withColumns({"legal_act": F.col("act.legal_act"), "legal_act_ref": F.col("act.legal_act_ref"), "slug": F.regexp_replace("key", "^[^:]*:", ""), "retrieved_at": F.lit(now)})
    rows = rows.withColumn("family", act_family(F.col("legal_act")))
    rows, _ = keep(rows.drop("act"))
    # what was fetched and has the status asked for is seen and checked; what was chosen and not fetched is an error
    status = F.contains(F.lower(nz(F.col("status"))), F.lit(config.require_status.lower())) if config.require_status else F.lit(True)
    is_wanted = ~of_listing | status
    rows, seen = keep(rows.withColumn("content_hash", corpus.content_hash()), fetched=F.lit(True), wanted=is_wanted)
    fetched = counts.note(seen, seen="wanted", checked="wanted")["fetched"]
    for a in authorities:
        counts.n[a]["errors"] += asked[a] - fetched[a]
    wanted = rows.where(is_wanted)
    new, seen = keep(merge.changed(wanted, state, records, full), written=F.lit(True))
    counts.note(seen, written="written")
    short = landed.announced is not None and "eba" in authorities and not limit_per_source and listed < 0.95 * landed.announced
    if "eba" in authorities:
        counts.n["eba"]["errors"] += bool(landed.listing_failed or too_long or short)
    if landed.register_failed:
        for a in authorities:
            counts.n[a]["errors"] += 1
    done = spark.createDataFrame([(a, not limit_per_source and not c["errors"], c["errors"]) for a, c in counts.n.items()], "authority string, complete boolean, errors long")
    archive, archive_failed = landed.archive, landed.archive_failed
    if callable(archive):
        gone = tombstone.vanished(state, found.select("key"), done).where("authority = 'eba'")
        archive, archive_failed = (spark.createDataFrame([], "url string"), False) if gone.isEmpty() else archive()
    archive = archive.select(F.lit("eba").alias("authority"), url_slug(F.col("url")).alias("slug")).distinct()
    marks = tombstone.tombstones(state, found.select("key"), archive, done, allow_mass_delisting)
    field_ = lambda name: (F.col("field") == name) & ~F.col("blocked")
    marks, seen = keep(marks, archived=field_("archived"), delisted=field_("delisted"), blocked=F.col("blocked"))
    written_marks, got = marks, counts.note(seen)
    if archive_failed and any(x.get("eba") for x in got.values()):
        # what is missing can't be told apart, so nothing is concluded
        counts.n["eba"]["errors"] += 1
        marks = marks.where("authority <> 'eba'")
        got = {k: v | {"eba": 0} for k, v in got.items()}
    for a in authorities:
        counts.n[a]["archived"] += got["archived"][a]
        counts.n[a]["delisted"] += got["delisted"][a]
        counts.n[a]["errors"] += bool(got["blocked"][a])
    totals = counts.table(spark)
    ok = not any(c["errors"] for c in counts.n.values())
    columns = [c for c in records.columns if c in new.columns]
    marked = tombstone.apply_marks(records.join(marks.where("NOT blocked").select("key"), "key", "left_semi"), marks, now[:10])
    changed = marked.join(new.select("key"), "key", "left_anti").unionByName(new.select(*columns), allowMissingColumns=True)
    stored = merge.upserted(records, changed)
    checked = wanted.select("key", F.col("content_hash").alias("hash"), F.lit(now).alias("verified_at"))
    buried = tombstone.buried(state.join(marks.where("NOT blocked").select("key"), "key", "left_semi").select("key", "hash", "verified_at"), marks)
    verified, _ = keep(buried.join(checked.select("key"), "key", "left_anti").unionByName(checked))
    next_ = merge.upserted(state.select("key", "hash", "verified_at"), verified)
    everyone = set(authorities) >= set(AUTHORITIES)
    scratch.drop_all_but(new, written_marks, verified)
    row = None
    if not limit_per_source:
        row = runs.run_row(totals, next_, now, mode.sweep, authorities, full)
        row = spark.createDataFrame(row.collect(), row.schema)  # one row, which outlives the steps
    return Run(stored, next_, marks, totals, ok, runs.sweep_watermark(last_full_sweep, now[:10], mode.sweep, ok, bool(limit_per_source), everyone), row, changed, verified, scratch)


def open_store(spark: SparkSession, path: str) -> Store:
    """The store of a mirror's records and state."""
    return Store(spark, path, TABLES)


def commit(store: Store, run: Run, base: Version | None = None) -> Version:
    """A run's records and state as the store's next version: only families and buckets that it changed are written. The run's steps go."""
    version = store.commit({"records": run.changed, "state": run.verified.withColumn("bucket", bucket("key"))}, base=base)
    run.scratch.drop_all_but()
    return version
