"""Registered queries over what portals and the register's service answer, recorded in tables that Spark makes of the driver's."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import html as pages_html
from ..functions import text as T
from ..scratch import Scratch
from ..sources import ordered, portal, register
from ..sources.store import Store
from ..streaming import keyed
from .catalogue import _t, query
from .config import config_of

# --- the register's answers -------------------------------------------------------------------------------------------------------------

ANSWER_COLUMNS = {
    "joint Q&A ID": None, "Receiving ESA": "D0", "Q&A ID at the ESA": None, "Date of submission": None, "Date of publication": None, "Status": "D1", "Legal act": "D2", "Article": None, "Topic ": None,
    "Link to the answer": None, "Answered by": None,
}
WORDS = {"D0": ("EBA", "ESMA", "EIOPA"), "D1": ("Final", "Rejected"), "D2": ("DORA", "MiCA", "CRR")}


#: Rows that come sorted by what they are grouped by are collected one group after another; by hash, each row of all but the first 128 groups would be a list of its own, sorted anew.
BY_SORT = {"spark.sql.execution.useObjectHashAggregateExec": "false"}


def answers(spark: SparkSession, d: str) -> DataFrame:
    """result, body: line items as answers of the register's service, a hundred orders each; what repeats or is null is left out of a row, as the service does."""
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_returnflag")
    order = Window.partitionBy("result").orderBy(*keys)
    day = F.unix_date(F.col("l_shipdate").cast("date")).alias("day")
    rows = _t(spark, d, "lineitem").select(F.expr("l_orderkey div 100").alias("result"), *keys, day)
    # windows see only what the values are made of; a row's values are the ones before if what makes them is
    seen = (*keys, "day")
    rows = rows.select("result", *seen, F.row_number().over(order).alias("seq"), *[F.lag(k).over(order).alias(f"_{k}") for k in seen])

    def made(at: str) -> list[Column]:
        key, part, supp, number, quantity, day, flag = (F.col(f"{at}{k}") for k in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "day", "l_returnflag"))
        return [key, supp % 3, part, day, F.when(quantity >= 10, day), number % 2, part % 3, flag, F.when(part % 2 == 1, True), key, F.when(supp % 5 != 0, True)]

    of, before = made(""), made("_")
    rows = rows.withColumns({f"same{k}": (F.col("seq") > 1) & v.eqNullSafe(w) for k, (v, w) in enumerate(zip(of, before, strict=True))})

    def words(name: str) -> Column:
        """Every other answer has its words the other way round."""
        there = F.array(*[F.lit(w) for w in WORDS[name]])
        return F.when(F.col("result") % 2 == 0, there).otherwise(F.reverse(there))

    one = lambda c, name: F.element_at(F.array(*[F.lit(w) for w in WORDS[name]]), (c + 1).cast("int"))
    place = lambda c, name: (F.array_position(words(name), one(c, name)) - 1).cast("string")
    ms = lambda c: (c.cast("long") * 86_400_000).cast("string")
    quoted = lambda start: F.concat(F.lit(f'"{start}'), F.col("l_orderkey").cast("string"), F.lit('"'))
    text = F.to_json(F.array("l_returnflag"))
    shown = [
        quoted("DORA"), place(of[1], "D0"), of[2].cast("string"), ms(of[3]), ms(of[4] + 30), place(of[5], "D1"), place(of[6], "D2"), F.substr(text, F.lit(2), F.length(text) - 2),
        F.lit(json.dumps('a "topic" \\ é', ensure_ascii=False)), quoted("http://x/"), F.lit('"EC"'),
    ]
    cells = [F.when(~F.col(f"same{k}") & v.isNotNull(), shown[k]) for k, v in enumerate(of)]
    mask = lambda bits: sum((F.when(b, F.lit(1 << k)).otherwise(F.lit(0)) for k, b in enumerate(bits)), F.lit(0))
    number = lambda name, m: F.when(m > 0, F.concat(F.lit(f',"{name}":'), m.cast("string"))).otherwise("")
    desc = ",".join('{"N":"G%d"%s}' % (k, f',"DN":"{dn}"' if dn else "") for k, dn in enumerate(ANSWER_COLUMNS.values()))
    row = F.concat(
        F.lit("{"), F.when(F.col("seq") == 1, f'"S":[{desc}],').otherwise(""), F.lit('"C":['), F.concat_ws(",", *cells), F.lit("]"),
        number("R", mask([F.col(f"same{k}") for k in range(len(of))])), number("Ø", mask([~F.col(f"same{k}") & v.isNull() for k, v in enumerate(of)])), F.lit("}"),
    )
    rows = rows.select("result", "seq", row.alias("row")).groupBy("result").agg(F.sort_array(F.collect_list(F.struct("seq", "row"))).alias("rows"))
    dictionary = F.to_json(F.struct(*[words(n).alias(n) for n in WORDS]))
    body = F.concat(F.lit('{"results":[{"result":{"data":{"dsr":{"DS":[{"ValueDicts":'), dictionary, F.lit(',"PH":[{"DM0":['), F.array_join(F.col("rows.row"), ","), F.lit("]}]}]}}}}]}"))
    return rows.select("result", body.alias("body"))


@query("""SELECT l_orderkey // 100 AS result, 'DORA' || CAST(l_orderkey AS VARCHAR) AS joint_id, ['eba', 'esma', 'eiopa'][1 + l_suppkey % 3] AS authority, CAST(l_partkey AS VARCHAR) AS native_id, 'http://x/' || CAST(l_orderkey AS VARCHAR) AS link,
 ['Final', 'Rejected'][1 + l_linenumber % 2] AS status, ['DORA', 'MiCA', 'CRR'][1 + l_partkey % 3] AS legal_act_raw, l_returnflag AS article, CASE WHEN l_partkey % 2 = 1 THEN 'a "topic" ' || chr(92) || ' é' ELSE '' END AS topic,
 CASE WHEN l_suppkey % 5 <> 0 THEN 'EC' ELSE '' END AS answered_by, strftime(l_shipdate, '%Y-%m-%d') AS date_submission, CASE WHEN l_quantity >= 10 THEN strftime(CAST(l_shipdate AS DATE) + INTERVAL 30 DAY, '%Y-%m-%d') ELSE '' END AS date_publication FROM lineitem""")
def register_answers(spark, d):
    """Register rows from the JSON of the service's answers."""
    raw = Scratch(spark, "answers").cut(answers(spark, d), settings=BY_SORT)
    return register.read_answers(raw, list(ANSWER_COLUMNS))[0].drop("i", "link_alts")


# --- listings and pages by waves ----------------------------------------------------------------------------------------------------------

LISTED = """listed AS (SELECT 'act' || CAST(o_custkey % 6 AS VARCHAR) AS source, CAST((row_number() OVER (PARTITION BY o_custkey % 6 ORDER BY o_orderkey) - 1) // 20 AS INTEGER) AS page_no,
 '/single-rule-book-qa/qna/view/publicId/' || CAST(o_orderkey * 7919 % 23 AS VARCHAR) AS link FROM orders), listing AS (SELECT source, page_no, list_distinct(list(link)) AS links FROM listed WHERE page_no < 30 GROUP BY source, page_no)"""


def listings(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(source, address; recorded answers). Orders as listings of six acts, 20 entries a page, few different ones, so pages go stale; every third page is empty unless caches are passed."""
    orders = _t(spark, d, "orders").select(F.concat(F.lit("act"), (F.col("o_custkey") % 6).cast("string")).alias("source"), "o_orderkey")
    at = F.row_number().over(Window.partitionBy("source").orderBy("o_orderkey")) - 1
    rows = orders.select("source", F.floor(at / 20).cast("int").alias("page_no"), (F.col("o_orderkey") * 7919 % 23).cast("string").alias("id")).where("page_no < 30")
    link = F.concat(F.lit('<a href="/single-rule-book-qa/qna/view/publicId/'), F.col("id"), F.lit('">x</a>'))
    bodies = rows.groupBy("source", "page_no").agg(F.array_join(F.sort_array(F.collect_list(link)), "\n").alias("body"))
    address = lambda s: F.concat(F.lit("http://portal/"), s, F.lit("?page="))
    url = F.concat(address(F.col("source")), F.col("page_no").cast("string"))
    first = bodies.select(url.alias("url"), F.when(F.col("page_no") % 3 == 2, "").otherwise(F.col("body")).alias("body"))
    again = bodies.select(F.concat(url, F.lit("&again=1")).alias("url"), "body")
    return rows.select("source").distinct().select("source", address(F.col("source")).alias("address")), first.unionByName(again)


@query(f"""WITH RECURSIVE {LISTED}, walk(source, page_no, stale, seen, n_first, n_again) AS (
 SELECT DISTINCT source, -1, 0, CAST([] AS VARCHAR[]), 1, 0 FROM listing
 UNION ALL
 SELECT source, page_no + 1, CASE WHEN len(fresh) + len(more) = 0 THEN stale + 1 ELSE 0 END, list_concat(seen, list_concat(fresh, more)), len(fresh), len(more) FROM (
  SELECT source, page_no, stale, seen, fresh, CASE WHEN len(fresh) = 0 THEN [x FOR x IN links IF NOT list_contains(seen, x)] ELSE CAST([] AS VARCHAR[]) END AS more FROM (
   SELECT w.*, coalesce(l.links, []) AS links, CASE WHEN (w.page_no + 1) % 3 = 2 THEN CAST([] AS VARCHAR[]) ELSE [x FOR x IN coalesce(l.links, []) IF NOT list_contains(w.seen, x)] END AS fresh
   FROM walk w LEFT JOIN listing l ON l.source = w.source AND l.page_no = w.page_no + 1 WHERE w.stale < 2)))
 SELECT source, CAST(page_no AS INTEGER) AS page_no, FALSE AS again, CAST(n_first AS BIGINT) AS n_new FROM walk WHERE page_no >= 0
 UNION ALL SELECT source, CAST(page_no AS INTEGER), TRUE, CAST(n_again AS BIGINT) FROM walk WHERE page_no >= 0 AND n_first = 0""")
def listing_waves(spark, d):
    """Which pages a walk by waves asks for, which of them twice, and the new links of each."""
    scratch = Scratch(spark, "listing")
    sources, responses = listings(spark, d)
    asked = portal.walk_by_waves(sources, portal.recorded(scratch.cut(responses)), Scratch(spark, "walk"), retry=lambda url: F.concat(url, F.lit("&again=1")))[1]
    return asked.select("source", "page_no", "again", "n_new")


@query("""WITH c AS (SELECT page_id AS key, unnest([page_id + 2, page_id, page_id // 2]) AS url, unnest([0, 1, 2]) AS ord FROM pages),
 ok AS (SELECT page_id AS url FROM pages WHERE page_id % 3 <> 0 AND page_id % 5 <> 1), served AS (SELECT key, min(ord) AS ord FROM c JOIN ok USING (url) GROUP BY key)
 SELECT CAST(c.url AS VARCHAR) AS url, min(c.ord) AS wave, bool_or(ok.url IS NOT NULL) AS served FROM c LEFT JOIN served USING (key) LEFT JOIN ok ON ok.url = c.url WHERE c.ord <= coalesce(served.ord, 2) GROUP BY c.url""")
def page_waves(spark, d):
    """Which addresses are asked for, in which wave, when further ones are asked for only after the first failed: some pages aren't there, some can't be read."""
    pages = _t(spark, d, "pages")
    responses = pages.where("page_id % 3 <> 0").select(F.col("page_id").cast("string").alias("url"), F.when(F.col("page_id") % 5 == 1, "").otherwise(F.col("html")).alias("body"))
    urls = F.array(*[x.cast("string") for x in (F.col("page_id") + 2, F.col("page_id"), F.expr("page_id div 2"))])
    parse = lambda rows: rows.select("url", F.char_length("body").alias("n"), F.when(F.col("body") == "", "nothing on the page").otherwise("").alias("error"))
    asked = portal.first_answers(pages.select(F.col("page_id").alias("key"), urls.alias("urls")), portal.recorded(responses), parse, Scratch(spark, "pages"))[1]
    return asked.select("url", "wave", (F.col("error") == "").alias("served"))


# --- what a second run writes -------------------------------------------------------------------------------------------------------------


@query("""WITH d AS (SELECT doc_id, source FROM documents), c AS (SELECT doc_id, CASE WHEN doc_id % 90 = 5 THEN 'moved' ELSE source END AS family, source FROM d WHERE doc_id % 45 = 5 AND source IN ('src2', 'src7')),
 t AS (SELECT family AS part FROM c UNION SELECT source FROM c), n AS (SELECT coalesce(c.family, d.source) AS part, count(*) AS rows FROM d LEFT JOIN c USING (doc_id) GROUP BY 1)
 SELECT part, rows, CAST(CASE WHEN part IN (SELECT part FROM t) THEN 2 ELSE 1 END AS BIGINT) AS version FROM n""")
def delta_parts(spark, d):
    """Which families a second commit writes: some records of two families change, and some of these move into a third."""
    schema = "key STRING, family STRING, hash STRING"
    store = Store(spark, Scratch(spark, "store").at, {"records": (schema, "family")})
    rows = _t(spark, d, "documents").select("doc_id", F.col("doc_id").cast("string").alias("key"), F.col("source").alias("family"), F.sha1(F.col("text")).alias("hash"))
    store.commit({"records": rows})
    changed = rows.where("doc_id % 45 = 5 AND family IN ('src2', 'src7')").withColumns({"hash": F.lit("changed"), "family": F.when(F.col("doc_id") % 90 == 5, "moved").otherwise(F.col("family"))})
    return store.manifest("records", store.commit({"records": changed}))


@query("""SELECT CAST(p_partkey AS VARCHAR) AS key, 'https://x/' || ['eba', 'eiopa', 'esma'][1 + p_partkey % 3] || '/q-12-' || CAST(p_partkey AS VARCHAR) AS url, ['eba', 'eiopa', 'esma'][1 + p_partkey % 3] AS authority,
 CASE p_partkey % 3 WHEN 0 THEN '2020_' || CAST(p_partkey AS VARCHAR) WHEN 1 THEN 'mica-' || CAST(p_partkey AS VARCHAR) ELSE 'q-12-' || CAST(p_partkey AS VARCHAR) END AS qa_id,
 CASE WHEN p_partkey % 3 = 1 THEN 'MICA' || lpad(regexp_extract(CAST(p_partkey AS VARCHAR), '^\\d{1,4}'), 4, '0') ELSE '' END AS joint_id,
 p_brand AS legal_act_raw, CAST(p_size AS VARCHAR) AS article, p_type AS topic, 'Final ' || p_brand AS status, p_name || ' ?' AS question, CASE WHEN p_partkey % 3 = 1 THEN 'because of ' || p_name ELSE '' END AS background, '- ' || p_type || chr(10) || chr(10) || 'end' AS answer,
 '12/03/2021' AS submitted, '' AS institution, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS VARCHAR) ELSE '' END AS size FROM part""")
def dialect_fields(spark, d):
    """Fields of pages in the markup of all three dialects, with a configured joint id, private fields and a field of no known name."""
    k, key = F.col("p_partkey") % 3, F.col("p_partkey").cast("string")
    authority = F.when(k == 0, "eba").when(k == 1, "eiopa").otherwise("esma")
    put = lambda shape, **values: F.concat(*[values[x[1:-1]] if x.startswith("{") else F.lit(x) for x in re.split(r"(\{\w+\})", shape) if x])
    of = {"key": key, "act": F.col("p_brand"), "article": F.col("p_size").cast("string"), "topic": F.col("p_type"), "status": F.concat(F.lit("Final "), "p_brand"), "name": F.col("p_name"), "size": F.col("p_size").cast("string")}
    listed = put(
        '<html><dl class="x metadata"><dt>Question ID:</dt><dd>2020_{key}</dd><dt>Legal act</dt><dd>{act}</dd><dt>Article</dt><dd><p>{article}</p></dd><dt>Topic</dt><dd>{topic}</dd><dt>Status</dt><dd>{status}</dd>'
        "<dt>Date of submission</dt><dd>12/03/2021</dd><dt>Name of institution / submitter</dt><dd>Some bank</dd><dt>Part size</dt><dd>{size}</dd><dt>Question</dt><dd><p>{name}  ?</p></dd>"
        "<dt>Final answer</dt><dd><ul><li>{topic}</li></ul><p>end</p></dd></dl></html>", **of)  # fmt: skip
    headed = put(
        "<article><p>Question ID: <b>mica-{key}</b></p><p>Regulation Reference: <b>{act}</b></p><p>Article: <b>{article}</b></p><p>Topic: <b>{topic}</b></p><p>Status: <b>{status}</b></p><p>Date of submission: <b>12/03/2021</b></p>"
        "<h2>Question</h2><p>{name} ?</p><h3>Background of the question</h3><div><p>because of {name}</p></div><h2>EIOPA answer</h2><ul><li>{topic}</li></ul><p>end</p><h2>Contact</h2><p>us</p></article>", **of)  # fmt: skip
    boxed = put(
        '<div class="field--name-field-qa-subject-matter"><span>Subject</span><div class="field__item">{topic}</div></div><div class="field--name-field-qa-level1">{act}</div><div class="field--name-field-article"><div class="field__item">{article}</div></div>'
        '<div class="additionalinfo"><div>Status: {status}</div><div>Date of submission: 12/03/2021</div></div><details><p>{name} ?</p></details><details></details><details><ul><li>{topic}</li></ul><p>end</p></details>', **of)  # fmt: skip
    html = F.when(k == 0, listed).when(k == 1, headed).otherwise(boxed)
    rows = _t(spark, d, "part").select(authority.alias("authority"), F.concat(F.lit("https://x/"), authority, F.lit("/q-12-"), key).alias("url"), html.alias("html"))
    settings = config_of({"acts": {"2023/1114": {"label": "MiCA", "joint_id_format": "%s%04d"}}})
    got = pages_html.parse_pages(rows, settings.joint_formats)
    some = lambda column, name: T.nz(F.col(column)[name]).alias({"date_of_submission": "submitted", "name_of_institution_submitter": "institution", "part_size": "size"}[name])
    return got.select(
        F.regexp_extract("source_url", r"(\d+)$", 1).alias("key"), F.col("source_url").alias("url"), "authority", "qa_id", "joint_id", "legal_act_raw", "article", "topic", "status", "question", "background", "answer",
        some("dates", "date_of_submission"), some("extra", "name_of_institution_submitter"), some("extra", "part_size"),
    )


@query("SELECT source AS family, lang || '-' || CAST(doc_id AS VARCHAR) AS file, row_number() OVER (ORDER BY source, lang || '-' || CAST(doc_id AS VARCHAR)) - 1 AS position FROM documents")
def ordered_files(spark, d):
    """Where records stand when the files of an ordered index are read one after another, as their list says."""
    path = Scratch(spark, "ordered").at
    rows = _t(spark, d, "documents").select(F.col("source").alias("family"), F.concat_ws("-", "lang", F.col("doc_id").cast("string")).alias("file"))
    ordered.write_ordered(rows, path, ["family", "file"], rows_per_file=500)
    return ordered.positions(spark, path).select("family", "file", "position")


@query("""WITH e AS (SELECT CAST(user_id AS VARCHAR) AS key, sha1(event_type || CAST(event_id AS VARCHAR)) AS hash, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS verified_at FROM events)
 SELECT key, hash, verified_at FROM e QUALIFY row_number() OVER (PARTITION BY key ORDER BY verified_at DESC, hash DESC) = 1""")
def stream_state(spark, d):
    """The state that a stream keeps by key after several batches, whose rows come out of order."""
    scratch = Scratch(spark, "stream")
    events = _t(spark, d, "events").select(F.col("user_id").cast("string").alias("key"), F.sha1(F.concat("event_type", F.col("event_id").cast("string"))).alias("content_hash"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("retrieved_at"))
    events.repartition(3, "content_hash").write.parquet(f"{scratch.at}/landed")
    landed = spark.readStream.schema(keyed.LANDED).option("maxFilesPerTrigger", 1).parquet(f"{scratch.at}/landed")
    keyed.run(landed, f"{scratch.at}/checkpoint", f"{scratch.at}/out").awaitTermination()
    return keyed.read_state(spark, f"{scratch.at}/checkpoint")
