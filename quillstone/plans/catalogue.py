"""The registered queries, each an operator of the engine over whole driver tables, and what they should return as SQL for another engine.

Documents and labels stand in for records, pages for raw HTML, events for logs, orders for dated rows, customers and nations for dimensions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as pages_html
from ..functions import text as T
from ..operators import index, merge, runs, select, tombstone
from ..schemas import COUNTERS, RECORD, REGISTER_ROW
from ..scratch import Scratch
from ..session import shared_dir
from ..sources import corpus, register
from ..streaming import cdc
from . import mirror
from . import search as S
from .config import config_of
from .shelf import Shelf, open_index

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
WS = T.SPACES
NOW = "2024-02-01T00:00:00Z"


def query(sql: str | None = None) -> Callable:
    def register_(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register_


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# --- documents as records -------------------------------------------------------------------------------------------------------------

REC = """rec AS (SELECT d.doc_id, d.lang AS authority, 'QA-' || lpad(CAST(d.doc_id AS VARCHAR), 8, '0') AS qa_id, upper(d.lang) || CAST(d.doc_id AS VARCHAR) AS joint_id,
 d.source AS legal_act, d.source AS family, '' AS article, CASE WHEN l.quality IS NULL THEN '' ELSE 'quality ' || CAST(l.quality AS VARCHAR) END AS topic,
 CASE l.toxic WHEN 1 THEN 'Rejected' WHEN 0 THEN 'Final' ELSE '' END AS status,
 CASE WHEN d.doc_id % 10 = 0 THEN '' ELSE strftime(DATE '2020-01-01' + CAST(d.doc_id % 1500 AS INTEGER), '%Y-%m-%d') END AS date, d.text AS question FROM documents d LEFT JOIN labels l USING (doc_id))"""
HAY = f"""{REC}, idx AS (SELECT *, lower(regexp_replace(qa_id || ' ' || joint_id || ' ' || article || ' ' || topic || ' ' || question || '  ', '{WS}+', ' ', 'g')) AS hay FROM rec)"""


def records(spark: SparkSession, d: str) -> DataFrame:
    day = F.date_format(F.date_add(F.to_date(F.lit("2020-01-01")), (F.col("doc_id") % 1500).cast("int")), "yyyy-MM-dd")
    rows = _t(spark, d, "documents").join(_t(spark, d, "labels"), "doc_id", "left")
    return rows.select(
        "doc_id", F.col("lang").alias("authority"), F.concat(F.lit("QA-"), F.lpad(F.col("doc_id").cast("string"), 8, "0")).alias("qa_id"), F.concat(F.upper("lang"), F.col("doc_id").cast("string")).alias("joint_id"),
        F.col("source").alias("legal_act"), T.act_family(F.col("source")).alias("family"), F.lit("").alias("article"), T.nz(F.concat(F.lit("quality "), F.col("quality").cast("string"))).alias("topic"),
        F.when(F.col("toxic") == 1, "Rejected").when(F.col("toxic") == 0, "Final").otherwise("").alias("status"), F.when(F.col("doc_id") % 10 == 0, "").otherwise(day).alias("date"),
        F.col("text").alias("question"), F.lit("").alias("background"), F.lit("").alias("answer"),
    )


def searchable(spark: SparkSession, d: str) -> DataFrame:
    return index.with_haystack(records(spark, d))


def shelf_of(spark: SparkSession, d: str) -> Shelf:
    """The tables' stored index, written once in a session, as searches come after it is built."""
    shelves = spark.__dict__.setdefault("_quillstone_shelves", {})
    if d not in shelves:
        store = open_index(spark, Scratch(spark, "index").at, "family STRING, qa_id STRING, authority STRING, legal_act STRING, date STRING, hay STRING")
        shelves[d] = Shelf(store, version=store.commit({"index": searchable(spark, d)}, key="qa_id"))
    return shelves[d]


def _hits(where: str, families: str = "TRUE") -> str:
    return f"""WITH {HAY}, loaded AS (SELECT * FROM idx WHERE {families}), hit AS (SELECT * FROM loaded WHERE {where}),
 best AS (SELECT qa_id, authority, date FROM hit ORDER BY nullif(date, '') DESC NULLS LAST, qa_id DESC LIMIT 200)
 SELECT best.*, n.hits, n.loaded FROM (SELECT (SELECT count(*) FROM hit) AS hits, (SELECT count(*) FROM loaded) AS loaded) n LEFT JOIN best ON TRUE"""


def _search(name: str, q: str, where: str, families: tuple[str, ...] = (), prune: bool = True, **facets: object) -> None:
    """families: those that the acts asked for lie in, which are all that is read. prune=False: every family is read, whatever the acts."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        return shelf_of(spark, d).search(q, prune=prune, **facets).select("qa_id", "authority", "date", "hits", "loaded")

    pruned = "family IN ({})".format(", ".join(f"'{f}'" for f in families)) if families else "TRUE"
    QUERIES[name], ORACLES[name] = run, _hits(where, pruned)


def _word(w: str) -> str:
    return f"regexp_matches(hay, '(^|[^a-z0-9_]){w}')"


_search("search_words_and", "then AND thing", f"{_word('then')} AND {_word('thing')}")
_search("search_phrase", "“of  the” on", "contains(hay, 'of the')")
_search("search_or", 'worthless or "le la" OR pathetic!', f"{_word('worthless')} OR contains(hay, 'le la') OR {_word('pathetic')}")
_search("search_regex", "/th[aeiou]n (and|of)/ ing", f"regexp_matches(hay, 'th[aeiou]n (and|of)') AND {_word('ing')}")
_search("search_stopwords_only", "the of and", "TRUE")
_search("search_bad_regex_literal", "/(of/ or /on the/", "contains(hay, '(of') OR regexp_matches(hay, 'on the')")
_search("search_facets_topk", "ent", f"{_word('ent')} AND legal_act IN ('src1', 'src10', 'src3') AND authority = 'en' AND date >= '2020-03-01'", prune=False, acts=["src1", "src10", "src3"], authority="en", date_from="2020-03-01")
_search("search_no_hits", "nosuchword AND then", f"{_word('nosuchword')} AND {_word('then')}")
_search("search_pruned_families", "er", f"{_word('er')} AND legal_act IN ('src2', 'src7')", families=("src2", "src7"), acts=["src2", "src7"])


@query("""WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date FROM orders)
 SELECT o_orderkey, date FROM o WHERE nullif(date, '') >= '1996-01-01' AND nullif(date, '') <= '1996-12-31'""")
def search_date_range_excludes_missing(spark, d):
    day = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return _t(spark, d, "orders").select("o_orderkey", day.alias("date")).where(S.facets(date_from="1996-01-01", date_to="1996-12-31"))


@query("""SELECT doc_id, regexp_replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '(?i)(of\\s+the|worthless)', '<mark>\\1</mark>', 'g') AS shown FROM documents""")
def search_highlight(spark, d):
    # a phrase and a literal: word boundaries before a match can't be said without capturing in the other engine
    terms = [[S.Term("phrase", "of the")], [S.Term("pattern", "worthless")]]
    return _t(spark, d, "documents").select("doc_id", S.highlighted(terms, F.col("text")).alias("shown"))


@query(f"WITH {HAY} SELECT qa_id, hay FROM idx")
def haystack_normalize(spark, d):
    return searchable(spark, d).select("qa_id", "hay")


@query("""SELECT DISTINCT * FROM (SELECT 'act' AS kind, source AS value FROM documents UNION ALL SELECT 'base', split_part(source, '-', 1) FROM documents UNION ALL SELECT 'authority', lang FROM documents) WHERE value <> ''""")
def facet_options(spark, d):
    return S.facet_options(records(spark, d).select("legal_act", "authority"))


# --- scalar functions -----------------------------------------------------------------------------------------------------------------

SLUG = "lower(regexp_replace(regexp_replace({}, '[^A-Za-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'))"


@query(f"SELECT p_partkey, {SLUG.format('p_name')} AS slug, {SLUG.format(chr(39) + '#' + chr(39) + ' || p_type || ' + chr(39) + '..' + chr(39))} AS type_slug FROM part")
def slug(spark, d):
    return _t(spark, d, "part").select("p_partkey", T.slug_of(F.col("p_name")).alias("slug"), T.slug_of(F.concat(F.lit("#"), "p_type", F.lit(".."))).alias("type_slug"))


@query(f"SELECT page_id, coalesce(nullif({SLUG.format(chr(34) + 'i' + chr(34))}, ''), substr(sha1(url), 1, 12)) AS slug FROM (SELECT page_id, url, CASE WHEN page_id % 2 = 0 THEN '__' ELSE 'QA ' || CAST(page_id AS VARCHAR) END AS i FROM pages)")
def slug_hash_fallback(spark, d):
    qa = F.when(F.col("page_id") % 2 == 0, "__").otherwise(F.concat(F.lit("QA "), F.col("page_id").cast("string")))
    return _t(spark, d, "pages").select("page_id", T.record_slug(qa, F.col("url")).alias("slug"))


@query(f"SELECT page_id, {SLUG.format(chr(34) + 't' + chr(34))} AS slug FROM (SELECT page_id, regexp_replace(regexp_extract(regexp_replace(url, '/+$', ''), '[^/]*$'), '_en$', '') AS t FROM pages)")
def url_slug(spark, d):
    return _t(spark, d, "pages").select("page_id", T.url_slug(F.col("url")).alias("slug"))


@query("""SELECT n_nationkey, coalesce(nullif(regexp_replace(regexp_replace(lower(trim(split_part(x, '-', 1))), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'unsorted') AS family
 FROM (SELECT n_nationkey, CASE WHEN n_nationkey % 7 = 0 THEN '-' ELSE replace(n_name, 'A', ' & ') || '-RTS-' || CAST(n_nationkey AS VARCHAR) END AS x FROM nation)""")
def act_family(spark, d):
    label = F.when(F.col("n_nationkey") % 7 == 0, "-").otherwise(F.concat(F.regexp_replace("n_name", "A", " & "), F.lit("-RTS-"), F.col("n_nationkey").cast("string")))
    return _t(spark, d, "nation").select("n_nationkey", T.act_family(label).alias("family"))


def _raw_acts(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    number = F.concat((F.lit(1) + k % 999).cast("string"), F.lit("/"), (F.lit(2010) + k % 15).cast("string"))
    turned = F.concat((F.lit(2010) + k % 15).cast("string"), F.lit("/"), (F.lit(1) + k % 999).cast("string"))
    raw = F.when(k % 6 == 0, "").when(k % 6 == 1, F.concat(F.lit("Regulation (EU) No "), number)).when(k % 6 == 2, F.concat(F.lit("Directive "), turned, F.lit("/EU as amended by (EU) 2022/2554")))
    raw = raw.when(k % 6 == 3, F.concat(F.lit("Regulation (EU) "), turned, F.lit(" - the act"))).when(k % 6 == 4, "Directive 2013/36/EU").otherwise("MiCA")
    return _t(spark, d, "orders").select("o_orderkey", raw.alias("raw"))


RAW = """raw AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'Regulation (EU) No ' || CAST(1 + o_orderkey % 999 AS VARCHAR) || '/' || CAST(2010 + o_orderkey % 15 AS VARCHAR)
 WHEN 2 THEN 'Directive ' || CAST(2010 + o_orderkey % 15 AS VARCHAR) || '/' || CAST(1 + o_orderkey % 999 AS VARCHAR) || '/EU as amended by (EU) 2022/2554'
 WHEN 3 THEN 'Regulation (EU) ' || CAST(2010 + o_orderkey % 15 AS VARCHAR) || '/' || CAST(1 + o_orderkey % 999 AS VARCHAR) || ' - the act' WHEN 4 THEN 'Directive 2013/36/EU' ELSE 'MiCA' END AS raw FROM orders)"""
REF = r"regexp_extract(regexp_extract(raw, '\((?:EU|EG|EC)\)\s*(?:No\.?\s*)?\d{1,4}/\d{1,4}|\d{4}/\d{1,4}/(?:EU|EG|EC)\b'), '\d{1,4}/\d{1,4}')"
LABELS = "labels_(ref, label) AS (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in T.ACT_LABELS.items()) + ")"


@query(f"WITH {RAW} SELECT o_orderkey, {REF} AS ref FROM raw")
def act_ref_extract(spark, d):
    return _raw_acts(spark, d).select("o_orderkey", T.act_ref(F.col("raw")).alias("ref"))


@query(f"WITH {RAW}, {LABELS} SELECT o_orderkey, coalesce(label, 'other') AS label FROM (SELECT o_orderkey, {REF} AS ref FROM raw) LEFT JOIN labels_ USING (ref)")
def act_label_join(spark, d):
    return _raw_acts(spark, d).select("o_orderkey", T.lookup(T.act_ref(F.col("raw")), T.ACT_LABELS, "other").alias("label"))


@query(f"""WITH {RAW}, {LABELS} SELECT o_orderkey, ref, CASE WHEN ref = '' THEN '' ELSE '(EU) ' || ref END AS legal_act_ref, coalesce(label, 'kept') AS legal_act
 FROM (SELECT o_orderkey, CASE WHEN raw = '' THEN '2013/36' ELSE {REF} END AS ref FROM raw) LEFT JOIN labels_ USING (ref)""")
def act_finalize(spark, d):
    return _raw_acts(spark, d).select("o_orderkey", T.finalised(F.col("raw"), F.lit("kept"), "2013/36").alias("f")).select("o_orderkey", "f.*")


@query("""SELECT o_orderkey, coalesce(strftime(try_strptime(trim(regexp_replace(x, '\\s+', ' ', 'g')), ['%d/%m/%Y', '%d %b %Y', '%d %B %Y', '%Y-%m-%d', '%d.%m.%Y']), '%Y-%m-%d'), '') AS day FROM (SELECT o_orderkey,
 CASE o_orderkey % 7 WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 1 THEN strftime(o_orderdate, ' %d  %b %Y') WHEN 2 THEN strftime(o_orderdate, '%d %B %Y') WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d')
 WHEN 4 THEN strftime(o_orderdate, '%d.%m.%Y') WHEN 5 THEN '31/02/' || strftime(o_orderdate, '%Y') ELSE 'sometime in ' || strftime(o_orderdate, '%Y') END AS x FROM orders)""")
def iso_date_formats(spark, d):
    f = lambda p: F.date_format("o_orderdate", p)
    k = F.col("o_orderkey") % 7
    x = F.when(k == 0, f("dd/MM/yyyy")).when(k == 1, f(" dd  MMM yyyy")).when(k == 2, f("dd MMMM yyyy")).when(k == 3, f("yyyy-MM-dd")).when(k == 4, f("dd.MM.yyyy"))
    x = x.when(k == 5, F.concat(F.lit("31/02/"), f("yyyy"))).otherwise(F.concat(F.lit("sometime in "), f("yyyy")))
    return _t(spark, d, "orders").select("o_orderkey", T.iso_date(x).alias("day"))


@query("""SELECT s_suppkey, CASE WHEN t = '' THEN '' WHEN upper(t) = 'DORA' THEN 'DORA' || lpad(n, CAST(greatest(3, length(n)) AS INTEGER), '0') ELSE upper(t) || n END AS joint_id FROM (SELECT s_suppkey,
 regexp_extract(x, '([A-Za-z]{3,10})[\\s_-]*0*(\\d{1,4})', 1) AS t, CAST(CAST(nullif(regexp_extract(x, '([A-Za-z]{3,10})[\\s_-]*0*(\\d{1,4})', 2), '') AS INTEGER) AS VARCHAR) AS n FROM (SELECT s_suppkey,
 CASE s_suppkey % 4 WHEN 0 THEN 'Dora ' || CAST(s_suppkey AS VARCHAR) || ' - 3195' WHEN 1 THEN '3308 - DORA0' || CAST(s_suppkey AS VARCHAR) WHEN 2 THEN 'xyz_' || CAST(s_suppkey AS VARCHAR) ELSE CAST(s_suppkey AS VARCHAR) END AS x FROM supplier))""")
def joint_id_format(spark, d):
    k = F.col("s_suppkey").cast("string")
    r = F.col("s_suppkey") % 4
    x = F.when(r == 0, F.concat(F.lit("Dora "), k, F.lit(" - 3195"))).when(r == 1, F.concat(F.lit("3308 - DORA0"), k)).when(r == 2, F.concat(F.lit("xyz_"), k)).otherwise(k)
    return _t(spark, d, "supplier").select("s_suppkey", T.joint_id_of(x).alias("joint_id"))


@query("SELECT event_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day FROM events")
def epoch_ms_to_date(spark, d):
    return _t(spark, d, "events").select("event_id", T.epoch_ms_date(F.unix_millis(F.col("ts").cast("timestamp"))).alias("day"))


@query("""SELECT o_orderkey, replace(strftime(o_orderdate, '%d/%m/%Y'), '/', '%2F') AS facet, 'qa_legal_act%5B%5D=' || CAST(o_orderkey AS VARCHAR) || '&qa_legal_act%5B%5D=' || CAST(o_custkey AS VARCHAR) AS acts FROM orders""")
def facet_parameters(spark, d):
    day = T.facet_date(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return _t(spark, d, "orders").select("o_orderkey", day.alias("facet"), T.act_query(F.array("o_orderkey", "o_custkey")).alias("acts"))


@query("""SELECT p_partkey, CASE WHEN lower(y) IN ('n/a', 'na', 'none', '-') THEN '' ELSE y END AS article FROM (SELECT p_partkey, trim(regexp_replace(x, '^\\s*art(?:icle|\\.)?\\s+', '', 'i')) AS y FROM (SELECT p_partkey,
 CASE p_partkey % 5 WHEN 0 THEN 'Article  ' || CAST(p_size AS VARCHAR) WHEN 1 THEN 'Art. ' || p_brand WHEN 2 THEN 'N/A' WHEN 3 THEN CAST(p_size AS VARCHAR) ELSE 'arts ' || p_name END AS x FROM part))""")
def article_cleanup(spark, d):
    k, size = F.col("p_partkey") % 5, F.col("p_size").cast("string")
    x = F.when(k == 0, F.concat(F.lit("Article  "), size)).when(k == 1, F.concat(F.lit("Art. "), "p_brand")).when(k == 2, "N/A").when(k == 3, size).otherwise(F.concat(F.lit("arts "), "p_name"))
    return _t(spark, d, "part").select("p_partkey", T.clean_article(x).alias("article"))


@query("SELECT p_partkey, regexp_replace(regexp_replace(lower(p_type || ' (' || p_brand || '):'), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS label, p_type AS before, p_brand || ': x' AS after FROM part")
def label_normalize(spark, d):
    both = F.concat("p_type", F.lit(" : "), "p_brand", F.lit(": x"))
    return _t(spark, d, "part").select("p_partkey", T.label_key(F.concat("p_type", F.lit(" ("), "p_brand", F.lit("):"))).alias("label"), T.before_colon(both).alias("before"), T.after_colon(both).alias("after"))


@query("""SELECT doc_id, '"' || replace(replace(replace(replace(replace(text, chr(92), chr(92) || chr(92)), '"', chr(92) || '"'), chr(13) || chr(10), chr(92) || 'n'), chr(13), chr(92) || 'n'), chr(10), chr(92) || 'n') || '"' AS quoted,
 replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS back FROM documents""")
def yaml_escape_roundtrip(spark, d):
    quoted = T.yaml_quoted(F.col("text"))
    return _t(spark, d, "documents").select("doc_id", quoted.alias("quoted"), T.yaml_value(quoted).alias("back"))


@query("""SELECT doc_id, replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') AS escaped, regexp_extract(text, '\\d+') AS first_integer FROM documents""")
def html_escape(spark, d):
    return _t(spark, d, "documents").select("doc_id", T.html_escaped(F.col("text")).alias("escaped"), T.first_integer(F.col("text")).alias("first_integer"))


def _as_records(spark: SparkSession, d: str) -> DataFrame:
    """Documents with all columns of a record."""
    rows = records(spark, d)
    empty = F.create_map().cast("map<string,string>")
    dates = F.when(F.col("date") == "", empty).otherwise(F.create_map(F.lit("submission_date"), F.col("date")))
    url = F.concat(F.lit("https://example.org/qa/"), F.col("qa_id"))
    more = {"legal_act_ref": F.lit(""), "legal_act_raw": F.col("legal_act"), "dates": dates, "extra": empty, "source_url": url, "retrieved_at": F.lit(NOW), "slug": T.slug_of(F.col("qa_id")), "file": F.concat_ws("-", "authority", T.slug_of(F.col("qa_id")))}
    return rows.withColumns(more)


def _document(with_time: bool) -> str:
    """A record's Markdown document as SQL."""
    line = lambda k, v: f"'{k}: \"' || {v} || '\"'"
    url = "'https://example.org/qa/' || qa_id"
    dates = f"""CASE WHEN date = '' THEN [] ELSE [{line("date_submission_date", "date")}, {line("date_submission_date_iso", "date")}] END"""
    head = ["'---'", "'authority: ' || authority", line("qa_id", "qa_id"), line("joint_id", "joint_id"), line("legal_act", "legal_act"), line("legal_act_ref", "''"), line("legal_act_raw", "legal_act"), line("article", "''"), line("topic", "topic"), line("status", "status")]
    tail = [line("source_url", url), line("license", "'© ' || upper(authority) || ' — reuse subject to the authority''s legal notice'"), *([line("retrieved_at", f"'{NOW}'")] if with_time else [])]
    note = f"'{corpus.NOTE} Unofficial copy made by a program, without any warranty; check it against the original before relying on it: <' || {url} || '>.'"
    body = ["'---'", "''", "'# ' || upper(authority) || ' Q&A ' || qa_id", "''", "'## Question'", "''", "CASE WHEN coalesce(question, '') = '' THEN '*(not captured)*' ELSE question END", "''", "'## Answer'", "''", "'*(not captured)*'", "''", "'---'", "''", note, "''"]
    return f"array_to_string(list_concat(list_concat([{', '.join(head)}], {dates}), [{', '.join(tail + body)}]), chr(10))"


@query(f"WITH {REC} SELECT qa_id, {_document(True)} AS document, substr(sha256({_document(False)}), 1, 16) AS hash FROM rec")
def record_markdown(spark, d):
    rows = _as_records(spark, d)
    return rows.select("qa_id", corpus.markdown().alias("document"), corpus.content_hash().alias("hash"))


@query(f"WITH {REC} SELECT qa_id, substr(sha256({_document(False)}), 1, 16) AS hash FROM rec")
def content_hash(spark, d):
    return _as_records(spark, d).select("qa_id", corpus.content_hash().alias("hash"))


@query(f"""WITH {REC} SELECT family, authority, qa_id, joint_id, legal_act, '' AS article, topic, status, date, '' AS delisted, '' AS archived, '2024-02-01' AS mirrored, 'https://example.org/qa/' || qa_id AS source_url,
 authority || '-' || lower(qa_id) AS file, question, '' AS background, '' AS answer FROM rec""")
def index_projection(spark, d):
    return index.index_rows(_as_records(spark, d)).drop("hay")


@query(f"""WITH {REC} SELECT family, authority, qa_id, joint_id, legal_act, '' AS article, topic, status, date, '' AS delisted, '' AS archived, '2024-02-01' AS mirrored, 'https://example.org/qa/' || qa_id AS source_url,
 authority || '-' || lower(qa_id) AS file, CASE WHEN q = '' THEN '*(not captured)*' ELSE q END AS question, '' AS background, '*(not captured)*' AS answer FROM (SELECT *, regexp_replace(coalesce(question, ''), '^{WS}+|{WS}+$', '', 'g') AS q FROM rec)""")
def index_of_rendered(spark, d):
    """Records written as Markdown documents, read back by their heads and sections, and put into the index."""
    files = _as_records(spark, d).select("file", "family", corpus.markdown().alias("text"))
    return index.index_rows(corpus.records_of(files)).drop("hay")


# --- change capture and selection -----------------------------------------------------------------------------------------------------

HASHED = "new AS (SELECT lang || ':' || CAST(doc_id AS VARCHAR) AS key, lang, doc_id, substr(sha256(text), 1, 16) AS content_hash FROM documents)"
STATE = """state AS (SELECT key, CASE doc_id % 4 WHEN 0 THEN 'old' WHEN 1 THEN 'delisted:' || content_hash ELSE content_hash END AS hash, strftime(TIMESTAMP '2024-01-01' + to_hours(CAST(doc_id * 7 % 800 AS INTEGER)), '%Y-%m-%dT%H:%M:%SZ') AS verified_at
 FROM new WHERE doc_id % 5 <> 0)"""


def _new(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").select(F.concat_ws(":", "lang", F.col("doc_id").cast("string")).alias("key"), "lang", "doc_id", F.substring(F.sha2("text", 256), 1, 16).alias("content_hash"))


def _state(new: DataFrame) -> DataFrame:
    """A state that knows four in five of the documents, some by an old hash, some as tombstones."""
    k = F.col("doc_id") % 4
    h = F.when(k == 0, "old").when(k == 1, F.concat(F.lit("delisted:"), "content_hash")).otherwise(F.col("content_hash"))
    hours = F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 7 % 800 * 3600)
    return new.where("doc_id % 5 <> 0").select("key", h.alias("hash"), F.date_format(hours, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("verified_at"))


@query(f"WITH {HASHED}, {STATE} SELECT new.key, new.content_hash FROM new LEFT JOIN state USING (key) LEFT JOIN (SELECT key AS k FROM new WHERE doc_id % 7 <> 0) s ON s.k = new.key WHERE state.hash IS DISTINCT FROM new.content_hash OR s.k IS NULL")
def change_detect(spark, d):
    new = _new(spark, d)
    return merge.changed(new, _state(new), new.where("doc_id % 7 <> 0")).select("key", "content_hash")


@query(f"WITH {HASHED}, {STATE} SELECT key, content_hash AS hash, '{NOW}' AS verified_at FROM new WHERE doc_id % 3 <> 0 UNION ALL SELECT key, hash, verified_at FROM state WHERE key NOT IN (SELECT key FROM new WHERE doc_id % 3 <> 0)")
def state_upsert(spark, d):
    new = _new(spark, d)
    return merge.next_state(_state(new), new.where("doc_id % 3 <> 0"), NOW)


CAND = "cand AS (SELECT key, CASE lang WHEN 'de' THEN 0 WHEN 'en' THEN 1 ELSE 2 END AS source_seq, doc_id % 11 = 0 AS in_window FROM new)"
MODE = select.run_mode("2024-01-20", NOW, budget=60)


def _candidates(new: DataFrame) -> DataFrame:
    return new.select("key", F.when(F.col("lang") == "de", 0).when(F.col("lang") == "en", 1).otherwise(2).alias("source_seq"), (F.col("doc_id") % 11 == 0).alias("in_window"))


@query(f"""WITH {HASHED}, {STATE}, {CAND}, j AS (SELECT cand.*, hash IS NULL OR starts_with(hash, 'delisted:') OR in_window AS must, coalesce(verified_at, '') AS v FROM cand LEFT JOIN state USING (key)),
 q AS (SELECT key, must FROM j WHERE NOT must AND v <= '{MODE.stale_before}' ORDER BY source_seq, v, key LIMIT {MODE.budget}) SELECT key, must FROM j WHERE must UNION ALL SELECT key, must FROM q""")
def fetch_select_budget(spark, d):
    new = _new(spark, d)
    return select.select_fetches(_candidates(new), _state(new), MODE).select("key", "must")


@query(f"""WITH {HASHED}, {STATE}, {CAND} SELECT key, row_number() OVER (ORDER BY source_seq, verified_at, key) AS place FROM cand JOIN state USING (key) WHERE NOT starts_with(hash, 'delisted:') AND NOT in_window AND verified_at <= '{MODE.stale_before}'
 QUALIFY place <= {MODE.budget}""")
def fetch_queue_places(spark, d):
    new = _new(spark, d)
    return select.queue_places(_candidates(new), _state(new), MODE).select("key", F.col("place").cast("long").alias("place"))


def _gone(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    new = _new(spark, d)
    archive = new.where("doc_id % 9 = 3").select(F.col("lang").alias("authority"), F.col("doc_id").cast("string").alias("slug"))
    complete = spark.createDataFrame([("en", True, 0), ("de", True, 0), ("fr", True, 2), ("es", False, 0)], "authority string, complete boolean, errors int")
    return _state(new), new.where("(lang = 'en' AND doc_id % 25 <> 3) OR doc_id % 3 <> 0"), archive, complete


GONE = f"""WITH {HASHED}, {STATE}, act AS (SELECT key, hash, split_part(key, ':', 1) AS authority, split_part(key, ':', 2) AS slug FROM state WHERE NOT starts_with(hash, 'delisted:')),
 seen AS (SELECT key FROM new WHERE (lang = 'en' AND doc_id % 25 <> 3) OR doc_id % 3 <> 0), arch AS (SELECT lang AS authority, CAST(doc_id AS VARCHAR) AS slug FROM new WHERE doc_id % 9 = 3),
 missing AS (SELECT act.* FROM act WHERE authority IN ('en', 'de') AND key NOT IN (SELECT key FROM seen)), archived AS (SELECT m.* FROM missing m SEMI JOIN arch USING (authority, slug)), gone AS (SELECT m.* FROM missing m ANTI JOIN arch USING (authority, slug))"""


@query(GONE + " SELECT key FROM missing")
def vanished_anti(spark, d):
    state, seen, _, complete = _gone(spark, d)
    return tombstone.vanished(state, seen, complete).select("key")


@query(GONE + " SELECT key FROM archived")
def archived_semi(spark, d):
    state, seen, archive, complete = _gone(spark, d)
    return tombstone.split_gone(tombstone.vanished(state, seen, complete), archive)[0].select("key")


BRAKE = GONE + """, n AS (SELECT authority, count(*) AS g, (SELECT count(*) FROM act a WHERE a.authority = gone.authority) AS k FROM gone GROUP BY authority),
 marks AS (SELECT key, authority, 'archived' AS field, FALSE AS blocked FROM archived UNION ALL SELECT key, gone.authority, 'delisted', g > greatest(5, k // 5) FROM gone JOIN n USING (authority))"""


@query(BRAKE + " SELECT key, authority, field, blocked FROM marks")
def delist_split_brake(spark, d):
    return tombstone.tombstones(*_gone(spark, d)).select("key", "authority", "field", "blocked")


@query(BRAKE + " SELECT key, CASE WHEN key IN (SELECT key FROM marks WHERE NOT blocked) AND NOT starts_with(hash, 'delisted:') THEN 'delisted:' || hash ELSE hash END AS hash FROM state")
def tombstoned_state(spark, d):
    gone = _gone(spark, d)
    return tombstone.buried(gone[0], tombstone.tombstones(*gone)).select("key", "hash")


# --- merging ----------------------------------------------------------------------------------------------------------------------------

MERGE = f"""WITH {RAW}, p AS (SELECT doc_id, lang, source, CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'Regulation (EU) No 575/2013' END AS page_act, CASE WHEN doc_id % 4 = 0 THEN '' ELSE source END AS topic FROM documents),
 r AS (SELECT o_orderkey, raw, o_orderstatus FROM raw JOIN orders USING (o_orderkey)), j AS (SELECT * FROM p JOIN r ON doc_id = o_orderkey)"""


def _merged(spark: SparkSession, d: str) -> DataFrame:
    empty = F.create_map().cast("map<string,string>")
    pages = _t(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("key"), F.lit("").alias("joint_id"), F.lit("Draft").alias("status"), F.when(F.col("doc_id") % 3 == 0, "").otherwise("Regulation (EU) No 575/2013").alias("legal_act_raw"),
        F.lit("").alias("article"), F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.col("source")).alias("topic"), empty.alias("dates"), empty.alias("extra"),
    )
    found = _raw_acts(spark, d).join(_t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate"), "o_orderkey").select(
        F.col("o_orderkey").cast("string").alias("key"), F.concat(F.lit("J"), F.col("o_orderkey").cast("string")).alias("joint_id"), F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("status"),
        F.col("raw").alias("legal_act_raw"), F.lit("7").alias("article"), F.lit("registered").alias("topic"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_submission"), F.lit("").alias("date_publication"),
    )
    return merge.merged(found, pages)


@query(MERGE + """ SELECT CAST(doc_id AS VARCHAR) AS key, 'J' || CAST(doc_id AS VARCHAR) AS joint_id, CASE WHEN o_orderstatus = 'P' THEN 'Draft' ELSE o_orderstatus END AS status, '7' AS article,
 CASE WHEN topic = '' THEN 'registered' ELSE topic END AS topic, CASE WHEN raw = '' THEN page_act ELSE raw END AS legal_act_raw FROM j""")
def metadata_override(spark, d):
    return _merged(spark, d).select("key", "joint_id", "status", "article", "topic", "legal_act_raw")


@query(MERGE + f" SELECT CAST(doc_id AS VARCHAR) AS key, page_act AS portal_legal_act FROM j WHERE page_act <> '' AND raw <> '' AND '575/2013' <> {REF}")
def act_disagreement(spark, d):
    return _merged(spark, d).select("key", F.col("extra")["portal_legal_act"].alias("portal_legal_act")).where("portal_legal_act IS NOT NULL")


@query("""SELECT o_orderkey, coalesce(nullif(a, ''), nullif(b, ''), '') AS day FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'O' THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS a,
 CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') END AS b FROM orders)""")
def first_nonempty_date(spark, d):
    a = F.when(F.col("o_orderstatus") == "P", F.lit(None)).when(F.col("o_orderstatus") == "O", "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    b = F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.date_format(F.date_add(F.to_date("o_orderdate"), 30), "yyyy-MM-dd"))
    return _t(spark, d, "orders").select("o_orderkey", T.first_of(a, b).alias("day"))


# --- index, manifest, runs --------------------------------------------------------------------------------------------------------------


@query("SELECT source AS family, count(*) AS count, string_agg(DISTINCT source, '|' ORDER BY source) AS acts, string_agg(DISTINCT lang, '|' ORDER BY lang) AS authorities FROM documents GROUP BY source")
def family_manifest(spark, d):
    return index.manifest(records(spark, d).select("family", "legal_act", "authority"))


@query("SELECT coalesce(source, 'all') AS family, count(*) AS count FROM documents GROUP BY ROLLUP (source)")
def manifest_total(spark, d):
    return index.family_totals(records(spark, d).select("family"))


@query(f"WITH {HASHED}, {STATE} SELECT coalesce(substr(min(nullif(verified_at, '')), 1, 10), '') AS oldest_verified FROM state WHERE NOT starts_with(hash, 'delisted:')")
def oldest_verified(spark, d):
    return index.oldest_verified(_state(_new(spark, d)))


EVENTS = "ev AS (SELECT CAST(user_id % 5 AS VARCHAR) AS authority, CASE event_id % 9 WHEN 0 THEN 'errors' WHEN 1 THEN 'written' WHEN 2 THEN 'checked' WHEN 3 THEN 'archived' WHEN 4 THEN 'delisted' WHEN 5 THEN 'enumerated' ELSE 'seen' END AS event, user_id % 5 <> 3 OR value < 1e18 AS ok FROM events)"


def _events(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id") % 9
    name = F.when(k == 0, "errors").when(k == 1, "written").when(k == 2, "checked").when(k == 3, "archived").when(k == 4, "delisted").when(k == 5, "enumerated").otherwise("seen")
    ok = (F.col("user_id") % 5 != 3) | (F.col("value") < 1e18)
    return _t(spark, d, "events").select((F.col("user_id") % 5).cast("string").alias("authority"), name.alias("event"), ok.alias("ok"))


@query(f"WITH {EVENTS} SELECT authority, " + ", ".join(f"count(*) FILTER (event = '{c}') AS {c}" for c in runs.COUNTERS) + " FROM ev GROUP BY authority")
def run_totals(spark, d):
    return runs.totals(_events(spark, d))


@query(f"WITH {EVENTS} SELECT authority, bool_and(ok) AS complete, count(*) FILTER (event = 'errors') AS errors FROM ev GROUP BY authority")
def run_completeness(spark, d):
    return runs.completeness(_events(spark, d))


@query(f"WITH {EVENTS} SELECT coalesce(bool_and(e = 0), TRUE) AS ok FROM (SELECT count(*) FILTER (event = 'errors') AS e FROM ev GROUP BY authority)")
def run_ok(spark, d):
    return runs.run_ok(runs.totals(_events(spark, d)))


@query(f"""WITH {HASHED}, {STATE}, p AS (SELECT substr(sha256(key), 1, 3) AS part, sha256(string_agg(key || '=' || hash, chr(10) ORDER BY key || '=' || hash)) AS digest FROM state GROUP BY 1)
 SELECT sha256(string_agg(part || ':' || digest, chr(10) ORDER BY part)) AS state_sha256 FROM p""")
def state_digest(spark, d):
    return runs.state_digest(_state(_new(spark, d)))


# --- compressed results, listings, links ------------------------------------------------------------------------------------------------


def _dsr(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Line items as a compressed result: an order is one result, its lines the rows in the order of their keys, which also say what repeats and what is null."""
    li = _t(spark, d, "lineitem")
    r = F.when(F.col("l_linenumber") == 1, F.lit(0)).otherwise(F.col("l_partkey") % 8).cast("long")
    n = (F.col("l_suppkey") % 8).cast("long")
    free = lambda c: F.expr(f"((r | n) & {1 << c}) = 0")
    rows = li.select(F.col("l_orderkey").alias("result"), (F.expr("((l_linenumber * 1000000 + l_partkey) * 1000 + l_suppkey) * 100 + cast(l_quantity as int)") * 100_000 + F.unix_date(F.col("l_shipdate").cast("date"))).alias("i"), r.alias("r"), n.alias("n"), F.col("l_quantity").cast("int").cast("string").alias("a"), (F.col("l_partkey") % 3).cast("string").alias("b"), F.col("l_shipdate").cast("date").cast("string").alias("e"))
    cells = F.filter(F.array(*[F.when(free(k), F.col(c)) for k, c in enumerate("abe")]), lambda x: x.isNotNull())
    desc = spark.createDataFrame([(0, "qty", None), (1, "flag", "D0"), (2, "ship", None)], "col int, name string, dict string")
    words = spark.createDataFrame([("D0", 0, "zero"), ("D0", 1, "one"), ("D0", 2, "two")], "dict string, idx int, value string")
    return rows.select("result", "i", "r", "n", cells.alias("c")), desc, words


@query("""WITH l AS (SELECT l_orderkey AS result, (((l_linenumber * 1000000 + l_partkey) * 1000 + l_suppkey) * 100 + CAST(l_quantity AS INTEGER)) * 100000 + date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS i, CASE WHEN l_linenumber = 1 THEN 0 ELSE l_partkey % 8 END AS r, l_suppkey % 8 AS n, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS a, CASE l_partkey % 3 WHEN 0 THEN 'zero' WHEN 1 THEN 'one' ELSE 'two' END AS b,
 strftime(l_shipdate, '%Y-%m-%d') AS e FROM lineitem), x AS (SELECT result, i, unnest([0, 1, 2]) AS col, unnest(['qty', 'flag', 'ship']) AS name, unnest([a, b, e]) AS v, r, n FROM l),
 y AS (SELECT *, CASE WHEN (r >> col) & 1 = 0 AND (n >> col) & 1 = 0 THEN v END AS own, sum(CASE WHEN (r >> col) & 1 = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY result, col ORDER BY i) AS run FROM x)
 SELECT result, i, col, name, first_value(own) OVER (PARTITION BY result, col, run ORDER BY i) AS value FROM y""")
def dsr_decode(spark, d):
    return register.decode_cells(*_dsr(spark, d)).select("result", "i", "col", "name", "value")


LINKS = "links AS (SELECT CAST(o_custkey % 50 AS VARCHAR) AS source, CAST(o_orderkey // 50 AS BIGINT) AS page_no, CAST(o_orderkey * 7919 % 997 AS VARCHAR) AS link FROM orders)"


def _links(spark: SparkSession, d: str) -> DataFrame:
    """Orders as listings: few distinct links, so pages go stale."""
    page = F.expr("o_orderkey div 50").cast("long")
    return _t(spark, d, "orders").select((F.col("o_custkey") % 50).cast("string").alias("source"), page.alias("page_no"), (F.col("o_orderkey") * 7919 % 997).cast("string").alias("link"))


@query(f"""WITH {LINKS}, f AS (SELECT source, link, min(page_no) AS page_no FROM links GROUP BY ALL), p AS (SELECT source, page_no, (SELECT count(*) FROM f WHERE f.source = q.source AND f.page_no = q.page_no) AS n FROM (SELECT DISTINCT source, page_no FROM links) q),
 w AS (SELECT *, lag(n, 1, 1) OVER (PARTITION BY source ORDER BY page_no) AS b FROM p), c AS (SELECT source, min(page_no) FILTER (n = 0 AND b = 0) AS cutoff FROM w GROUP BY source)
 SELECT f.source, f.page_no, link FROM f JOIN c USING (source) WHERE cutoff IS NULL OR f.page_no < cutoff""")
def listing_walk(spark, d):
    return register.walk(_links(spark, d))[0]


@query("SELECT DISTINCT lang AS source, source AS page_no, 'QA-' || CAST(doc_id AS VARCHAR) AS link FROM documents")
def listing_links(spark, d):
    html = F.concat(F.lit('<ul><a href="/qa/QA-'), F.col("doc_id").cast("string"), F.lit('">x</a><a href="/qa/QA-'), F.col("doc_id").cast("string"), F.lit('">again</a></ul>'))
    pages = _t(spark, d, "documents").select(F.col("lang").alias("source"), F.col("source").alias("page_no"), html.alias("html"))
    return register.listing_links(pages, r'href="/qa/([^"]+)"')


@query("SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 5")
def limit_per_source(spark, d):
    return select.limit_per_source(_t(spark, d, "documents").select("source", "doc_id"), 5, "source", "doc_id")


LINK = """SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'eba' WHEN 1 THEN 'esma' WHEN 2 THEN 'eiopa' ELSE 'eba' END AS authority, CASE page_id % 4 WHEN 3 THEN url WHEN 0 THEN 'Title of 2024_' || CAST(page_id AS VARCHAR) || ' page' WHEN 1 THEN 'see 1' || lpad(CAST(page_id AS VARCHAR), 4, '0') ELSE '' END AS link,
 CASE page_id % 4 WHEN 1 THEN 'none' ELSE CAST(page_id AS VARCHAR) END AS native_id, CASE WHEN page_id % 8 = 2 THEN '' ELSE 'DORA' || CAST(page_id AS VARCHAR) END AS joint_id FROM pages"""


@query(f"""WITH x AS ({LINK}), y AS (SELECT page_id, CASE WHEN starts_with(link, 'http') THEN [link] WHEN authority = 'eba' THEN ['https://www.eba.europa.eu/single-rule-book-qa/qna/view/publicId/2024_' || native_id]
 WHEN authority = 'esma' THEN ['https://www.esma.europa.eu/publications-data/questions-answers/' || substr(link, 5)] WHEN joint_id = '' THEN CAST([] AS VARCHAR[])
 ELSE ['https://www.eiopa.europa.eu/qa-regulation/questions-and-answers-database/' || native_id || '-' || lower(joint_id) || '_en', 'https://www.eiopa.europa.eu/qa-regulation/questions-and-answers-database/' || lower(joint_id) || '-' || native_id || '_en'] END AS c FROM x)
 SELECT page_id, coalesce(c[1], '') AS link, array_to_string(c[2:], ' ') AS link_alts FROM y""")
def link_repair(spark, d):
    k, s = F.col("page_id") % 4, F.col("page_id").cast("string")
    rows = _t(spark, d, "pages").select(
        "page_id", F.when(k == 1, "esma").when(k == 2, "eiopa").otherwise("eba").alias("authority"),
        F.when(k == 3, F.col("url")).when(k == 0, F.concat(F.lit("Title of 2024_"), s, F.lit(" page"))).when(k == 1, F.concat(F.lit("see 1"), F.lpad(s, 4, "0"))).otherwise("").alias("link"),
        F.when(k == 1, "none").otherwise(s).alias("native_id"), F.when(F.col("page_id") % 8 == 2, "").otherwise(F.concat(F.lit("DORA"), s)).alias("joint_id"),
    )
    return register.repair_links(rows).select("page_id", "link", F.array_join("link_alts", " ").alias("link_alts"))


@query("SELECT lang, count(*) AS n FROM documents WHERE contains(lower(source), 'src1') AND lang IN ('en', 'fr') GROUP BY lang")
def register_filter(spark, d):
    rows = _t(spark, d, "documents").select("lang", F.col("lang").alias("authority"), F.col("source").alias("legal_act_raw"), F.lit("Final").alias("status"))
    return register.filter_register(rows, "SRC1", ["final", "revised"], ["en", "fr"]).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


CHECKS = "SELECT o_orderpriority AS source, count(*) AS announced, count(*) FILTER (o_orderstatus <> 'P') AS listed, count(*) FILTER (o_orderdate >= TIMESTAMP '1999-01-01') AS windowed FROM orders GROUP BY 1"


def _checks(spark: SparkSession, d: str) -> DataFrame:
    n = F.count_if
    return _t(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("source")).agg(F.count(F.lit(1)).alias("announced"), n(F.col("o_orderstatus") != "P").alias("listed"), n(F.col("o_orderdate") >= "1999-01-01").alias("windowed"))


@query(f"SELECT source, CAST(ceil(announced / 20) AS BIGINT) AS pages, ceil(announced / 20) <= 150 AS ok FROM ({CHECKS})")
def preflight_pages(spark, d):
    return _checks(spark, d).select("source", T.ceil_div(F.col("announced"), 20).alias("pages"), register.page_budget_ok(F.col("announced"), 150).alias("ok"))


@query(f"SELECT source, listed >= 0.95 * announced AS ok FROM ({CHECKS})")
def completeness_check(spark, d):
    return _checks(spark, d).select("source", register.discovery_ok(F.col("listed"), F.col("announced")).alias("ok"))


@query(f"SELECT source, windowed <= 1.5 * announced + 3 AND windowed <= 1200 AS ok FROM ({CHECKS})")
def window_plausibility(spark, d):
    return _checks(spark, d).select("source", register.window_plausible(F.col("windowed"), F.col("announced"), 1200).alias("ok"))


@query("""WITH t AS (SELECT page_id AS key, unnest([page_id + 1, page_id, page_id - 1]) AS id, unnest([0, 1, 2]) AS ord FROM pages), h AS (SELECT t.key, t.ord, p.url FROM t JOIN pages p ON p.page_id = t.id WHERE p.page_id % 3 <> 0)
 SELECT CAST(key AS VARCHAR) AS key, arg_min(url, ord) AS url, min(ord) AS ord FROM h GROUP BY key""")
def alternate_fetch(spark, d):
    pages = _t(spark, d, "pages")
    # addresses of pages may repeat, so the page's number stands for it here
    urls = F.array(*[(F.col("page_id") + k).cast("string") for k in (1, 0, -1)])
    got = pages.select(F.col("page_id").cast("string").alias("source_url"), F.when(F.col("page_id") % 3 == 0, "bad page").otherwise("").alias("error"), F.col("url").alias("address"))
    found = select.first_that_parses(pages.select(F.col("page_id").cast("string").alias("key"), urls.alias("urls")), got)
    return found.select("key", F.col("address").alias("url"), "ord")


@query("SELECT joint_id, count(*) AS n, string_agg(CAST(doc_id AS VARCHAR), ' ' ORDER BY doc_id) AS docs FROM (SELECT doc_id, upper(lang) || CAST(doc_id // 2 AS VARCHAR) AS joint_id FROM documents) GROUP BY joint_id HAVING count(*) > 1")
def joint_id_duplicates(spark, d):
    rows = _t(spark, d, "documents").select("doc_id", F.concat(F.upper("lang"), F.expr("doc_id div 2").cast("string")).alias("joint_id"))
    return index.repeated_ids(rows, "joint_id", "doc_id").withColumnRenamed("keys", "docs")


# --- pages ------------------------------------------------------------------------------------------------------------------------------


@query()
def html_to_text(spark, d):
    return _t(spark, d, "pages").select("page_id", pages_html.html_to_text("html").alias("text"))


@query()
def html_fields(spark, d):
    """Every page through the parser of a dialect; the dialects have none of these pages' markup, so what they capture is the body."""
    k = F.col("page_id") % 3
    rows = _t(spark, d, "pages").select(F.when(k == 0, "eba").when(k == 1, "eiopa").otherwise("esma").alias("authority"), "url", "html")
    return pages_html.parse_pages(rows).select("authority", "qa_id", "joint_id", "source_url", "question", T.nz(F.col("extra")["parse_warning"]).alias("warning"), "error")


@query("""SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, CAST(len(regexp_extract_all(html, '<a href="([^"]+)"', 1)) AS BIGINT) AS n_links, array_to_string(regexp_extract_all(html, '<a href="([^"]+)"', 1), ' ') AS links FROM pages""")
def html_title_links(spark, d):
    links = F.regexp_extract_all("html", F.lit('<a href="([^"]+)"'), F.lit(1))
    return _t(spark, d, "pages").select("page_id", F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"), F.size(links).cast("long").alias("n_links"), F.array_join(links, " ").alias("links"))


_COUNTED = ", ".join(f"count(*) FILTER (event_id % {len(COUNTERS)} = {i}) AS {c}" for i, c in enumerate(COUNTERS))


@query(f"SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS ts, 'incremental' AS mode, false AS \"full\", event_type AS authority, {_COUNTED} FROM events GROUP BY 1, event_type")
def runs_history(spark, d):
    """A run log, a line per day, as rows of its authorities' counters."""
    rows = _t(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type", F.element_at(F.array(*[F.lit(c) for c in COUNTERS]), (F.col("event_id") % len(COUNTERS) + 1).cast("int")).alias("event"))
    of = F.struct(F.col("event_type").alias("authority"), F.struct(*COUNTERS).alias("t"))
    totals = rows.groupBy("day", "event_type").agg(*[F.count_if(F.col("event") == c).alias(c) for c in COUNTERS]).groupBy("day").agg(F.map_from_entries(F.collect_list(of)).alias("totals"))
    return corpus.run_rows(totals.select(F.col("day").alias("ts"), F.lit("incremental").alias("mode"), F.lit(False).alias("full"), "totals"))


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_version(spark, d):
    """The last row per key, as a batch of the change stream takes it."""
    return cdc.newest(_t(spark, d, "events").select("user_id", "event_id", "event_type", "ts"), "user_id", "ts", "event_id").drop("ts")


# --- a whole run ------------------------------------------------------------------------------------------------------------------------


@query("""SELECT 'eba' AS authority, count(*) FILTER (doc_id % 20 <> 19) AS enumerated, count(*) FILTER (doc_id % 20 <> 19 AND doc_id % 3 <> 0) AS seen, count(*) FILTER (doc_id % 20 <> 19 AND doc_id % 3 <> 0) AS written,
 count(*) FILTER (doc_id % 20 <> 19 AND doc_id % 3 <> 0) AS checked, count(*) FILTER (doc_id % 40 = 39) AS archived, count(*) FILTER (doc_id % 40 = 19) AS delisted, CAST(0 AS BIGINT) AS errors FROM documents""")
def mirror_totals(spark, d):
    """Counters of a run over landed pages made of documents: a third is known and fresh, one in twenty has vanished, half of those into the archive."""
    docs = _t(spark, d, "documents").select("doc_id", F.concat(F.lit("2020_"), F.col("doc_id").cast("string")).alias("qa"), "text")
    docs = docs.withColumn("url", F.concat(F.lit("https://example.org/publicId/"), "qa"))
    part = lambda label, value: F.concat(F.lit(f"<dt>{label}</dt><dd>"), value, F.lit("</dd>"))
    html = F.concat(F.lit('<dl class="metadata">'), part("Question ID", F.col("qa")), part("Status", F.lit("Final Q&amp;A")), part("Legal act", F.lit("Directive 2013/36/EU")), part("Question", F.concat(F.lit("<p>"), T.html_escaped(F.col("text")), F.lit("</p>"))), part("Answer", F.lit("<p>Yes.</p>")), F.lit("</dl>"))
    listed, gone = docs.where("doc_id % 20 <> 19"), docs.where("doc_id % 20 = 19")
    state = listed.where("doc_id % 3 = 0").unionByName(gone).select(F.concat(F.lit("eba:"), T.url_slug(F.col("url"))).alias("key"), F.lit("known").alias("hash"), F.lit(NOW).alias("verified_at"))
    none = spark.createDataFrame([], REGISTER_ROW)
    landed = mirror.Landed(none, listed.select("url"), gone.where("doc_id % 40 = 39").select("url"), docs.where("false").select("url"), listed.select(F.lit("eba").alias("authority"), "url", html.alias("html")))
    settings = config_of({"eba": {"legal_act_ids": [32], "default_act_ref": "2013/36", "require_status": "Final"}})
    r = mirror.mirror_run(landed, spark.createDataFrame([], "key string, " + RECORD), state, "2024-01-31", settings, NOW, f"{shared_dir(spark)}/mirror", authorities=("eba",))
    return r.totals
