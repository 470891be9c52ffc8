"""A portal's listings: addresses by facets, walks that ask for no page they needn't, and a data source that turns filters into facets.

There are two ways to walk. ``walk_by_waves`` walks many listings side by side as Spark jobs: a wave asks each listing that hasn't ended for its next page, by any
function from addresses to responses (``fetch.fetched`` over HTTP, ``recorded`` over a landed table). ``spark.read.format("qa_listing")`` walks a host's listings
within one task, so that the host's spacing holds, and asks only for the statuses, acts and days that the query's filters name.

A listing ends after two pages in a row without a new link. Before a page counts as such it is asked for once more, past caches. A listing that hasn't ended within its page
budget is an error, not a short listing.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThanOrEqual, In, InputPartition

from ..functions.text import nz
from ..scratch import Scratch
from .fetch import Policy, get
from .register import ListingTruncated

Fetch = Callable[[DataFrame], DataFrame]
# Where a tab's listing and the counts of all tabs lie below the portal's address, the links they hold, and what marks a tab's count.
TABS = {"final": "/single-rule-book-qa/search", "archive": "/single-rule-book-qa/archive"}
COUNTS = "/qa-search-count"
HREF = r'href="(/single-rule-book-qa/qna/view/publicId/[^"]+)"'
COUNT = re.compile(r"#view-count-(\w+)")
#: What the data source says about an entry of a listing, and about a tab.
LISTING = "status string, act int, published date, page_no int, link string"
TAB_COUNTS = "act int, published date, status string, n int"
STALE_PAGES, PAGE_SIZE = 2, 20


@dataclass(frozen=True)
class Facets:
    """What a listing is narrowed to: acts by their numbers (none: all), the first day of publication, and the tab."""

    status: str = "final"
    acts: tuple[int, ...] = ()
    since: date | None = None

    def query(self) -> str:
        acts = [f"qa_legal_act%5B%5D={a}" for a in self.acts]
        return "&".join([*acts, *([f"qa_final_publishing_date_start={self.since:%d%%2F%m%%2F%Y}"] if self.since else [])])

    def listing(self, base: str) -> str:
        """The listing's address, up to the number of a page (from 0)."""
        return f"{base}{TABS[self.status]}?{self.query()}&page="

    def counts(self, base: str) -> str:
        return f"{base}{COUNTS}?{self.query()}"


def fits(announced: int, max_pages: int) -> bool:
    """Whether a listing of so many entries can be read to its end within the page budget."""
    return -(-announced // PAGE_SIZE) <= max_pages


def past_caches(url: str, now: int | None = None) -> str:
    return f"{url}{'&' if '?' in url else '?'}cachebust={int(time.time()) if now is None else now}"


# --- many listings side by side ---------------------------------------------------------------------------------------------------------


def recorded(responses: DataFrame) -> Fetch:
    """Answers addresses from a landed table (url, body), one row per url; one that it doesn't have is an error."""

    def fetch(requests: DataFrame) -> DataFrame:
        found = responses.select("url", F.col("body"), F.lit(True).alias("_there"))
        rows = requests.select("url").join(found, "url", "left")
        return rows.select("url", F.when(F.col("_there"), 200).cast("int").alias("status"), "body", F.when(F.col("_there").isNull(), "not recorded").alias("error"))

    return fetch


class Grown:
    """A table that grows by waves: one folder each, so a wave that runs again replaces its own rows, and a reader needs no list of them."""

    def __init__(self, spark: SparkSession, at: str, schema: str | T.StructType):
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.spark, self.at, self.schema, self.waves = spark, at, schema, 0
        self.whole = T.StructType([*schema.fields, T.StructField("wave", T.IntegerType())])

    def add(self, rows: DataFrame, wave: int) -> DataFrame:
        """Writes a wave; its rows, read back."""
        path = f"{self.at}/wave={wave}"
        rows.write.mode("overwrite").parquet(path)
        self.waves += 1
        return self.spark.read.schema(self.schema).parquet(path)

    def read(self) -> DataFrame:
        """All rows, with their wave."""
        if not self.waves:
            return self.spark.createDataFrame([], self.whole)
        return self.spark.read.schema(self.whole).parquet(self.at)


def walk_by_waves(listings: DataFrame, fetch: Fetch, scratch: Scratch, href: str = HREF, max_pages: int = 600, retry: Callable[[Column], Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """listings: source, address (up to the page's number). (links: source, page_no, link; asked: source, page_no, again, url, error, n_new).

    Wave k asks for page k of the listings that haven't ended, and once more for those where it held no new link. What was seen stays in a table, so no list of links is
    held by the driver; it knows how many listings go on. retry makes the second address from the first (default: past caches). An error is a page without links.
    Raises ListingTruncated if a listing goes on after max_pages.
    """
    spark = listings.sparkSession
    again = retry or (lambda url: F.concat(url, F.lit(f"&cachebust={int(time.time())}")))
    links = Grown(spark, f"{scratch.at}/links", "source string, page_no int, link string")
    asked = Grown(spark, f"{scratch.at}/asked", "source string, page_no int, again boolean, url string, error string, n_new long")
    active = scratch.cut(listings.select(F.col("source").cast("string").alias("source"), "address", F.lit(0).alias("stale")))

    def answers(requests: DataFrame, page: int, second: bool) -> tuple[DataFrame, DataFrame]:
        """requests: source, url. (their new links, what was asked); an address is asked for once, whoever names it."""
        got = scratch.cut(fetch(requests.select("url").distinct()).select("url", "body", "error"))
        rows = requests.join(got, "url", "left")
        found = rows.select("source", F.explode(F.array_distinct(F.regexp_extract_all(nz(F.col("body")), F.lit(href), F.lit(1)))).alias("link"))
        fresh = scratch.cut(found.join(links.read().select("source", "link"), ["source", "link"], "left_anti"))
        n = fresh.groupBy("source").agg(F.count(F.lit(1)).alias("n_new"))
        told = rows.join(n, "source", "left").select("source", F.lit(page).alias("page_no"), F.lit(second).alias("again"), "url", "error", F.coalesce("n_new", F.lit(0)).alias("n_new"))
        return fresh.select("source", F.lit(page).alias("page_no"), "link"), asked.add(told, 2 * page + second)

    for page in range(max_pages):
        fresh, told = answers(active.select("source", F.concat("address", F.lit(str(page))).alias("url")), page, second=False)
        barren = told.where("n_new = 0").select("source", again(F.col("url")).alias("url"))
        if not barren.isEmpty():
            more, retold = answers(barren, page, second=True)
            fresh, told = fresh.unionByName(more), told.unionByName(retold)
        links.add(fresh, page)
        n = told.groupBy("source").agg(F.max("n_new").alias("n"))
        stale = F.when(F.col("n") > 0, 0).otherwise(F.col("stale") + 1)
        active = scratch.cut(active.join(n, "source").withColumn("stale", stale).where(F.col("stale") < STALE_PAGES).drop("n"))
        scratch.drop_all_but(active)
        if active.isEmpty():
            return links.read().drop("wave"), asked.read().drop("wave")
    raise ListingTruncated(f"listings go on after {max_pages} pages")


def first_answers(candidates: DataFrame, fetch: Fetch, parse: Callable[[DataFrame], DataFrame], scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """candidates: key, urls (best first; and authority). (answers: key, url, ord and the parsed fields; asked: wave, url, error).

    parse turns url, body (and authority) into a row per url with error, '' if all went well. Wave k asks for the k-th address of those keys that no
    earlier one served, so a second address costs a request only where the first failed, and an address that several keys name is asked for once.
    """
    spark = candidates.sparkSession
    by = ["authority", "url"] if "authority" in candidates.columns else ["url"]
    open_ = scratch.cut(candidates.select("key", "urls", *by[:-1]).where(F.size("urls") > 0))
    got: Grown | None = None
    answers = Grown(spark, f"{scratch.at}/answers", T.StructType([open_.schema["key"], T.StructField("url", T.StringType()), T.StructField("ord", T.IntegerType()), *[open_.schema[c] for c in by[:-1]]]))
    wave = 0
    while not open_.isEmpty():
        wanted = open_.select("key", *by[:-1], F.get("urls", F.lit(wave)).alias("url"))
        fresh = wanted.select(*by).distinct()
        fresh = scratch.cut(fresh.join(got.read().select(*by), by, "left_anti") if got else fresh)
        bodies = fetch(fresh.select("url").distinct()).select("url", "body", F.col("error").alias("_failed"))
        bodies = scratch.cut(fresh.join(bodies, "url", "left"))
        parsed = parse(bodies.where("_failed IS NULL").drop("_failed"))
        failed = bodies.where("_failed IS NOT NULL").select(*by, F.col("_failed").alias("error"))
        parsed = parsed.unionByName(failed, allowMissingColumns=True)
        got = got or Grown(spark, f"{scratch.at}/got", T.StructType([T.StructField(f.name, f.dataType) for f in parsed.schema.fields]))
        got.add(parsed, wave)
        served = got.read().where(nz(F.col("error")) == "").select(*by)
        answers.add(wanted.join(served, by, "left_semi").select("key", "url", F.lit(wave).alias("ord"), *by[:-1]), wave)
        wave += 1
        more = open_.where(F.size("urls") > wave).join(answers.read().select("key"), "key", "left_anti")
        open_ = scratch.cut(more)
        scratch.drop_all_but(open_)
    if got is None:
        nothing = parse(open_.select(*by[:-1], F.lit("").alias("url"), F.lit("").alias("body")))
        return answers.read().drop("wave").join(nothing.drop("error"), by), nothing.select(F.lit(0).alias("wave"), "url", "error")
    return answers.read().drop("wave").join(got.read().drop("error", "wave"), by), got.read().select("wave", "url", "error")


# --- one host's listings in a task ------------------------------------------------------------------------------------------------------


def pages_of(address: str, ask: Callable[[str], str], max_pages: int, href: str = HREF) -> Iterator[tuple[int, str]]:
    """(page, link) of one listing, new links only, in order; asks as it is read."""
    seen: set[str] = set()
    stale = 0
    for page in range(max_pages):
        new = set(re.findall(href, ask(f"{address}{page}"))) - seen
        if not new:
            new = set(re.findall(href, ask(past_caches(f"{address}{page}")))) - seen
        if not new:
            stale += 1
            if stale == STALE_PAGES:
                return
            continue
        stale = 0
        seen |= new
        yield from ((page, link) for link in sorted(new))
    raise ListingTruncated(f"{address} goes on after {max_pages} pages")


def tab_numbers(body: str) -> dict[str, int]:
    """Counts by tab from the counting address's answer, an array of commands; {} if it is anything else."""
    try:
        found = {}
        for command in json.loads(body):
            tab, n = COUNT.search(str(command.get("selector", ""))), re.search(r"\d+", str(command.get("data", "")))
            if tab and n:
                found[tab[1]] = int(n[0])
        return found
    except (ValueError, AttributeError, TypeError):
        return {}


class Asker:
    """Asks one host, spaced and with retries; a failed second try past caches is an empty page, any other failure an error."""

    def __init__(self, policy: Policy, headers: dict[str, str] | None = None):
        self.policy, self.headers, self.last = policy, headers or {}, float("-inf")

    def __call__(self, url: str) -> str:
        time.sleep(max(0.0, self.policy.delay - (time.monotonic() - self.last)))
        status, body, error = get(url, None, self.headers, self.policy)
        self.last = time.monotonic()
        if error is not None:
            if "cachebust=" in url:
                return ""
            raise OSError(f"{url}: {error} (status {status})")
        return body or ""


@dataclass
class Host(InputPartition):
    """The walks of one host."""

    base: str
    walks: tuple[Facets, ...]


class ListingSource(DataSource):
    """spark.read.format("qa_listing"): the entries of a portal's listings, or (option table = "counts") how many each tab has.

    Options: base, addresses of portals with commas between; acts, the acts' numbers if no filter names any; delay, tries and first_wait, seconds
    and number of the policy; max_pages. Filters on status (=, in), act (=, in) and published (>=) become facets; without one on published the listings are whole. published says which
    day a row was asked since, not when it was published, which a listing doesn't tell.
    """

    @classmethod
    def name(cls) -> str:
        return "qa_listing"

    def schema(self) -> str:
        return TAB_COUNTS if self.options.get("table") == "counts" else LISTING

    def reader(self, schema):  # noqa: ANN001, ANN201, ARG002
        return ListingReader(dict(self.options))


class ListingReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options
        self.counts = options.get("table") == "counts"
        self.statuses: tuple[str, ...] = tuple(TABS)
        self.acts: tuple[int, ...] | None = tuple(int(a) for a in options["acts"].split(",")) if options.get("acts") else None
        self.since: date | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Narrows statuses, acts and the first day. Spark checks all but the day again, which the portal alone can tell."""
        for f in filters:
            column, values = f.attribute if hasattr(f, "attribute") else (), None
            if isinstance(f, EqualTo):
                values = (f.value,)
            elif isinstance(f, In):
                values = tuple(f.value)
            if column == ("published",) and isinstance(f, GreaterThanOrEqual):
                self.since = max(filter(None, (self.since, f.value)))
                continue
            if column == ("status",) and values is not None:
                self.statuses = tuple(s for s in self.statuses if s in values)
            elif column == ("act",) and values is not None:
                self.acts = tuple(a for a in self.acts if a in values) if self.acts is not None else tuple(sorted(set(values)))
            yield f

    def partitions(self) -> list[Host]:
        acts = [()] if self.acts is None else [(a,) for a in self.acts]
        statuses = ("final",) if self.counts else self.statuses
        walks = tuple(Facets(s, a, self.since) for s in statuses for a in acts)
        hosts = [b.strip().rstrip("/") for b in self.options["base"].split(",") if b.strip()]
        return [Host(b, walks) for b in dict.fromkeys(hosts)]

    def read(self, partition: Host) -> Iterator[tuple]:
        o = self.options
        policy = Policy()
        policy = replace(policy, delay=float(o.get("delay", policy.delay)), tries=int(o.get("tries", policy.tries)), first_wait=float(o.get("first_wait", policy.first_wait)))
        ask = Asker(policy, {"X-Requested-With": "XMLHttpRequest"} if self.counts else None)
        for walk in partition.walks:
            act = walk.acts[0] if walk.acts else None
            if self.counts:
                for status, n in sorted(self._numbers(ask, walk.counts(partition.base)).items()):
                    yield act, walk.since, status, n
            else:
                for page, link in pages_of(walk.listing(partition.base), ask, int(o.get("max_pages", 600))):
                    yield walk.status, act, walk.since, page, partition.base + link

    @staticmethod
    def _numbers(ask: Asker, url: str) -> dict[str, int]:
        try:
            return tab_numbers(ask(url))
        except OSError:
            return {}  # counts only check what else is known; without them nothing stops


def register_sources(spark: SparkSession) -> None:
    """Makes the formats of this module known to a session, and lets filters reach them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ListingSource)
