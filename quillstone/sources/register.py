"""The register and the listings as landed raw tables: compressed results, link repair, page walks, counts, addresses.

Pages and answers are landed first, and these functions start from there; what is asked of the register's service is made here, and sent by whoever calls.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass, replace
from urllib.parse import parse_qsl, urlencode

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import candidate_links, ceil_div, epoch_ms_date, first_integer, nz, strip


def loose_column(columns: list[str], *needles: str) -> str:
    """The first column whose name holds all needles, whatever their case."""
    for c in columns:
        if all(n.lower() in c.lower() for n in needles):
            return c
    raise LookupError(f"no column holds {needles} among {columns}")


def widest_entity(entities: DataFrame) -> DataFrame:
    """entities: name, properties. The one with the most properties (the first by name of several)."""
    return entities.agg(F.max_by("name", F.struct(F.size("properties"), F.col("name"))).alias("name"))


def carried_cells(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Cells (result, i, col, name, value) of compressed results.

    rows: result, i, r (bit set: as in the row before), n (bit set: null), c (cells present: v, whole), desc (a column's col, name, dict). A repeat is looked
    at before a null, and repeats carry nulls too. A present cell is numbered by the present columns before it; no loop over columns.
    dictionary: dict, idx, value; it gives a word for a whole number of a column with a dict. A result's rows
    of one column form one window.
    """
    cells = rows.select("*", F.inline("desc")).drop("desc")
    bit = lambda mask: F.expr(f"shiftright({mask}, col) & 1")
    cells = cells.withColumns({"repeat": bit("r") == 1, "is_null": bit("n") == 1})
    at = F.expr("bit_count(~(r | n) & (shiftleft(1L, col) - 1)) + 1")
    own = F.when(~F.col("repeat") & ~F.col("is_null"), F.try_element_at("c", at.cast("int")))
    over = Window.partitionBy("result", "col").orderBy("i")
    cells = cells.withColumn("own", own).withColumn("run", F.sum(F.when(F.col("repeat"), 0).otherwise(1)).over(over))
    # a repeat in a result's first row repeats nothing
    value = F.when(F.col("run") > 0, F.first("own", ignorenulls=False).over(Window.partitionBy("result", "col", "run").orderBy("i")))
    cells = cells.select("result", "i", "col", "name", "dict", value.alias("value"))
    cells = cells.withColumn("idx", F.when(F.col("dict").isNotNull() & F.col("value.whole"), F.col("value.v")))
    words = dictionary.select(F.col("dict").alias("_d"), F.col("idx").cast("string").alias("_i"), F.col("value").alias("word"))
    cells = cells.join(words, (F.col("dict") == F.col("_d")) & (F.col("idx") == F.col("_i")), "left")
    return cells.select("result", "i", "col", "name", F.coalesce("word", F.col("value.v")).alias("value"))


def decode_cells(rows: DataFrame, desc: DataFrame, dictionary: DataFrame) -> DataFrame:
    """carried_cells() of results that share their columns. rows: result (may be left out if there is one), i, r, n, c (strings). desc: col, name, dict, a row per column."""
    by = ["result"] if "result" in rows.columns else []
    columns = [F.struct(F.lit(r["col"]).cast("int").alias("col"), F.lit(r["name"]).alias("name"), F.lit(r["dict"]).cast("string").alias("dict")) for r in desc.orderBy("col").collect()]
    cells = F.transform("c", lambda v: F.struct(v.alias("v"), F.lit(True).alias("whole")))
    rows = rows.select((F.col("result") if by else F.lit(0)).alias("result"), "i", "r", "n", cells.alias("c"), F.array(*columns).alias("desc"))
    return carried_cells(rows, dictionary).select(*by, "i", "col", "name", "value")


def answers_of(raw: DataFrame) -> DataFrame:
    """raw: result, body (an answer's JSON). result, error ('' if it can be read), ds (the data set), rows, desc (what the first row says about the columns)."""
    rows = raw.select("result", F.try_parse_json("body").alias("answer"))
    rows = rows.withColumn("ds", F.try_variant_get("answer", "$.results[0].result.data.dsr.DS[0]", "variant"))
    rows = rows.withColumn("rows", F.try_variant_get("ds", "$.PH[0].DM0", "array<variant>"))
    rows = rows.withColumn("desc", F.try_variant_get(F.get("rows", F.lit(0)), "$.S", "array<struct<N:string,DN:string>>"))
    error = F.when(F.col("answer").isNull(), "no JSON").when(F.col("ds").isNull(), "no result set").when(F.col("desc").isNull(), "no descriptor").otherwise("")
    return rows.select("result", error.alias("error"), "ds", "rows", "desc")


def _bits(k: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), k)


def decoded_answers(raw: DataFrame, columns: list[str]) -> DataFrame:
    """result, i and a column per name, of the answers in raw that can be read; columns: names in the order asked for. A number without a word in its dictionary is an error.

    As carried_cells(), but a row stays one row: answers are shuffled as they came, each with its dictionary beside it, and all columns are carried in one window over an
    answer's rows (MOST_ROWS at most).
    """
    # no filter: it would be pushed below the parsing, and each of its conditions would parse again
    found = answers_of(raw.repartition("result")).withColumn("words", F.try_variant_get("ds", "$.ValueDicts", "map<string,array<string>>"))
    dicts = F.slice(F.transform("desc", lambda s: s["DN"]), 1, len(columns))
    kind = lambda v: F.schema_of_variant(v)
    plain = lambda v: F.try_variant_get(v, "$", "double").cast("decimal(38,0)").cast("string")
    number = lambda path: F.coalesce(F.try_variant_get("x", path, "long"), F.lit(0).cast("long"))
    rows = found.select("result", dicts.alias("dicts"), "words", F.posexplode(F.when((F.col("error") == "") & (F.size("desc") > 0), F.col("rows"))).alias("i", "x"))
    cells = [F.try_variant_get("x", "$.C", f"array<{t}>").alias(n) for n, t in (("c", "variant"), ("texts", "string"))]
    rows = rows.select("result", "i", number("$.R").alias("r"), number("$.Ø").alias("n"), *cells, "dicts", "words")
    # one step over all columns, another for their words: eleven expressions of this length would outgrow what Spark compiles at once
    at = lambda k: F.bit_count(F.bitwise_not(F.col("r").bitwiseOR(F.col("n"))).bitwiseAND(_bits(k) - 1))
    there = lambda k: F.when(F.col("n").bitwiseAND(_bits(k)) == 0, at(k))
    own = lambda _, k: F.when(F.col("r").bitwiseAND(_bits(k)) == 0, F.struct(F.get("c", there(k)).alias("cell"), F.get("texts", there(k)).alias("text")))
    rows = rows.select("result", "i", "dicts", "words", F.transform("dicts", own).alias("own"))

    def said(own: Column, dict_: Column) -> Column:
        """A number's word; else the text, without exponents (only a text with a point can be of such a number)."""
        cell, text, words = own["cell"], own["text"], F.try_element_at("words", dict_)
        at = text.try_cast("int")
        word = F.when((at >= 0) & (at < F.size(words)), F.coalesce(F.get(words, at), text)).otherwise(F.raise_error(F.concat(F.lit("a dictionary of the register has no word "), text)))
        value = F.when(dict_.isNotNull() & (kind(cell) == "BIGINT"), word).when(F.contains(text, F.lit(".")) & kind(cell).isin("DOUBLE", "FLOAT"), plain(cell)).otherwise(text)
        return F.when(own.isNotNull(), F.struct(value.alias("v")))

    rows = rows.select("result", "i", F.zip_with("own", "dicts", said).alias("own"))
    rows = rows.select("result", "i", *[F.get("own", F.lit(k)).alias(f"own{k}") for k in range(len(columns))])
    # a repeat in an answer's first row repeats nothing
    over = Window.partitionBy("result").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.select("result", "i", *[F.last(f"own{k}", ignorenulls=True).over(over)["v"].alias(c) for k, c in enumerate(columns)])


def read_answers(raw: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(register rows of the answers in raw, with result and i; result and error of those that can't be read, after which no run may believe the register complete)."""
    decoded = decoded_answers(raw, columns)
    return register_rows(decoded, keep=("result", "i")), answers_of(raw).where("error <> ''").select("result", "error")


# --- what is asked of the register's service --------------------------------------------------------------------------------------------

#: Rows that one answer holds at most.
MOST_ROWS = 30_000


@dataclass(frozen=True)
class Model:
    """What the service calls the register: its model, data set and report, and the table's name and columns."""

    number: int
    data_set: str | None
    report: str | None
    table: str = ""
    columns: tuple[str, ...] = ()


def model_of(exploration: str) -> Model:
    """From the answer that describes the published report."""
    said = json.loads(exploration)
    first = said["models"][0]
    return Model(first["id"], first.get("dbName"), ((said.get("exploration") or {}).get("report") or {}).get("objectId"))


def schema_request(model: Model) -> str:
    """The model's number under both names that the service has had for it."""
    return json.dumps({"userPreferredLocale": "en-US", "modelIds": [model.number], "models": [model.number]})


def with_table(model: Model, schema: str) -> Model:
    """The model with its table: the entity with the most columns, the first of several; the others only help with dates."""
    entities = json.loads(schema)["schemas"][0]["schema"]["Entities"]
    widest = max(entities, key=lambda e: len(e.get("Properties") or ()))
    return replace(model, table=widest["Name"], columns=tuple(p["Name"] for p in widest.get("Properties") or ()))


def rows_request(model: Model, most: int = MOST_ROWS) -> str:
    """Asks for all columns of the table, in order."""
    asked = [{"Name": f"t.{c}", "Column": {"Property": c, "Expression": {"SourceRef": {"Source": "t"}}}} for c in model.columns]
    shape = {"Version": 1, "Primary": {"Groupings": [{"Projections": [*range(len(asked))]}]}, "DataReduction": {"DataVolume": 4, "Primary": {"Window": {"Count": most}}}}
    select = {"Version": 2, "From": [{"Name": "t", "Entity": model.table, "Type": 0}], "Select": asked}
    command = {"SemanticQueryDataShapeCommand": {"Query": select, "Binding": shape}}
    context = {"DatasetId": model.data_set, "Sources": [{"ReportId": model.report}]}
    return json.dumps({"version": "1.0.0", "modelId": model.number, "cancelQueries": [], "queries": [{"QueryId": "", "Query": {"Commands": [command]}, "ApplicationContext": context}]})


def ask_register(base: str, key: str, ask: Callable[[str, str | None, dict[str, str]], str]) -> tuple[Model, str]:
    """(model, the answer with all rows) of the service at base, for the published report of a key. ask: an address, what to post (None: get) and headers to the answer's text."""
    headers = {"X-PowerBI-ResourceKey": key}
    model = model_of(ask(f"{base}/public/reports/{key}/modelsAndExploration?preferReadOnlySession=true", None, headers))
    model = with_table(model, ask(f"{base}/public/reports/conceptualschema", schema_request(model), headers))
    return model, ask(f"{base}/public/reports/querydata?synchronous=true", rows_request(model), headers)


# What the names of the register's columns hold, whatever their case.
REGISTER_COLUMNS = {
    "joint_id": ("joint", "id"),
    "authority": ("receiving esa",),
    "native_id": ("id at the esa",),
    "link": ("link to the answer",),
    "status": ("status",),
    "legal_act_raw": ("legal act",),
    "article": ("article",),
    "topic": ("topic",),
    "answered_by": ("answered by",),
    "date_submission": ("submission",),
    "date_publication": ("publication",),
}


def register_rows(decoded: DataFrame, needles: dict[str, tuple[str, ...]] = REGISTER_COLUMNS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Decoded columns of a result, found by parts of their names, as register rows: strings, dates from milliseconds or as they are, '' for what is missing. keep: columns to keep as they are."""
    names = [c for c in decoded.columns if c not in keep]

    def field(name: str, parts: tuple[str, ...]) -> Column:
        found = "`" + loose_column(names, *parts).replace("`", "``") + "`"
        text = F.col(found).cast("string")
        if name.startswith("date_"):
            return nz(F.when(F.rlike(text, F.lit(r"^-?\d{9,}$")), epoch_ms_date(text.cast("long"))).otherwise(text))
        return F.lower(strip(nz(text))) if name == "authority" else strip(nz(text))

    rows = decoded.select(*keep, *[field(k, v).alias(k) for k, v in needles.items()])
    return rows.withColumn("link_alts", F.array().cast("array<string>"))


def decode_rows(rows: DataFrame, desc: DataFrame, dictionary: DataFrame, names: list[str]) -> DataFrame:
    """A row per i with a column per name."""
    return decode_cells(rows, desc, dictionary).groupBy("i").pivot("name", names).agg(F.first("value"))


def filter_register(rows: DataFrame, act: str, statuses: list[str], authorities: list[str]) -> DataFrame:
    """By act (part of its name), status (none given: all) and authority."""
    keep = F.contains(F.lower(nz(F.col("legal_act_raw"))), F.lit(act.lower())) & F.col("authority").isin(authorities)
    if statuses:
        keep &= F.lower(nz(F.col("status"))).isin([s.lower() for s in statuses])
    return rows.where(keep)


def repair_links(rows: DataFrame) -> DataFrame:
    """A link that isn't one becomes the first candidate, the others go to link_alts; without any it is '' and the row stays."""
    bad = ~F.startswith(nz(F.col("link")), F.lit("http"))
    found = candidate_links(F.col("authority"), F.col("native_id"), F.col("link"), F.col("joint_id"))
    rows = rows.withColumn("_c", found)
    return rows.withColumns({"link_alts": F.when(bad, F.slice("_c", 2, 10)).otherwise(F.array().cast("array<string>")), "link": F.when(bad, nz(F.try_element_at("_c", F.lit(1)))).otherwise(F.col("link"))}).drop("_c")


def split_unreachable(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with an address, rows without, which count as errors of their authority)."""
    return rows.where(nz(F.col("link")) != ""), rows.where(nz(F.col("link")) == "")


def listing_links(pages: DataFrame, href: str) -> DataFrame:
    """pages: source, page_no, html (and retry_html, a second read). (source, page_no, link), distinct on a page; null for a page without.

    A second read counts, in place of the first, only for a page whose first read has no link that earlier pages' first reads don't have.
    """
    links_in = lambda c: F.array_distinct(F.regexp_extract_all(nz(F.col(c)), F.lit(href), F.lit(1)))
    if "retry_html" not in pages.columns:
        return pages.select("source", "page_no", F.explode_outer(links_in("html")).alias("link"))
    rows = pages.select("source", "page_no", links_in("html").alias("links"), F.when(F.col("retry_html").isNotNull(), links_in("retry_html")).alias("again"))
    fresh = rows.select("source", "page_no", F.explode("links").alias("link")).groupBy("source", "link").agg(F.min("page_no").alias("page_no"))
    fresh = fresh.select("source", "page_no").distinct().withColumn("fresh", F.lit(True))
    rows = rows.join(fresh, ["source", "page_no"], "left")
    read = F.when(F.col("fresh").isNull() & F.col("again").isNotNull(), F.col("again")).otherwise(F.col("links"))
    return rows.select("source", "page_no", F.explode_outer(read).alias("link"))


def walk(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """links: source, page_no, link (null for a page without). (links the walk yields, (source, cutoff) of all sources).

    A page is stale if all its links were on earlier ones; the first two stale pages in a row end a walk. A null cutoff: the pages ran out first.
    """
    first = links.where("link IS NOT NULL").groupBy("source", "link").agg(F.min("page_no").alias("page_no"))
    fresh = first.groupBy("source", "page_no").agg(F.count(F.lit(1)).alias("n"))
    pages = links.select("source", "page_no").distinct().join(fresh, ["source", "page_no"], "left").fillna(0, ["n"])
    before = F.lag("n", 1, 1).over(Window.partitionBy("source").orderBy("page_no"))
    cutoff = pages.withColumn("before", before).groupBy("source").agg(F.min(F.when((F.col("n") == 0) & (F.col("before") == 0), F.col("page_no"))).alias("cutoff"))
    got = first.join(cutoff, "source").where("cutoff IS NULL OR page_no < cutoff").select("source", "page_no", "link")
    return got, cutoff


class ListingTruncated(RuntimeError):
    """The pages ran out before two stale ones."""


def complete_walk(links: DataFrame) -> DataFrame:
    got, cutoff = walk(links)
    cut = [r["source"] for r in cutoff.where("cutoff IS NULL").collect()]  # a row per source
    if cut:
        raise ListingTruncated(f"the pages of {cut} end before the listing does")
    return got


def tab_counts(raw: DataFrame) -> DataFrame:
    """raw: body, a JSON array of commands. (tab, n); bodies that aren't such arrays give nothing."""
    command = "array<struct<command:string,method:string,selector:string,data:string>>"
    rows = raw.select(F.explode(F.from_json("body", command)).alias("c"))
    tab = F.regexp_extract(F.col("c.selector"), r"#view-count-(\w+)", 1)
    return rows.select(tab.alias("tab"), first_integer(F.col("c.data")).try_cast("long").alias("n")).where("tab <> '' AND n IS NOT NULL")


def page_budget_ok(announced: Column, max_pages: int, page_size: int = 20) -> Column:
    return ceil_div(announced, page_size) <= max_pages


def discovery_ok(listed: Column, announced: Column) -> Column:
    return listed >= 0.95 * announced


def window_plausible(n: Column, announced: Column, cap: int = 250) -> Column:
    return (n <= 1.5 * announced + 3) & (n <= cap)


def read_params(query: str, acts: set[str], authorities: set[str]) -> dict:
    """A search page's address as parameters: unknown acts and authorities and malformed dates are ignored."""
    p = dict(parse_qsl(query.lstrip("?")))
    day = lambda k: p.get(k, "") if re.fullmatch(r"\d{4}-\d{2}-\d{2}", p.get(k, "")) else ""
    return {"q": p.get("q", ""), "acts": sorted(set(p.get("act", "").split(",")) & acts), "authority": p["auth"] if p.get("auth") in authorities else "", "date_from": day("from"), "date_to": day("to")}


def to_params(q: str = "", acts: list[str] = (), authority: str = "", date_from: str = "", date_to: str = "") -> str:
    pairs = {"q": q, "act": ",".join(sorted(acts)), "auth": authority, "from": date_from, "to": date_to}
    return urlencode({k: v for k, v in pairs.items() if v})
