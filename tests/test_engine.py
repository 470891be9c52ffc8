import pytest
from pyspark.sql import functions as F

from quillstone import schemas
from quillstone.functions import html as H
from quillstone.operators import index, merge, runs, select, tombstone
from quillstone.plans import search as S
from quillstone.sources import corpus, register



# --- HTML -----------------------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("html", "want"),
    [("<p>A</p><p>A</p>", "A\n\nA"), ("<ul><li><p>x</p></li></ul>", "- x"), ("<td><p>a</p><p>b</p></td>", "a b"), ("plain <b>text</b>", "plain text"), ("x<p>A</p>", "A"), ("", ""), ("<p>a<br>b</p>", "a b"), ("<p>a<script>no()</script></p><!-- c --><style>p{}</style>", "a")],
)
def test_to_text(html, want):
    assert H.to_text(H.parse(html)) == want


LIST = """<dl class="metadata"><dt>Topic</dt><dd>Liquidity</dd><dt>Lonely</dt><dt>Subject matter</dt><dd>Buffers</dd><dt>Legal act</dt><dd>Regulation (EU) No 575/2013</dd><dt>Date of submission</dt><dd>7/9/2018</dd>
<dt>Question</dt><dd><ul><li><p>one</p></li></ul><p>two</p></dd><dt>Country of incorporation of the firm</dt><dd>Nowhere</dd><dt>Answer</dt><dd><p>Yes.</p></dd><dt>Question ID</dt><dd>2018_7</dd></dl>"""
HEADED = """<article><p>Question ID: <b>DORA 137 - 3195</b></p><p>Regulation reference: <b>(EU) 2022/2554</b></p><p>Date of publication: <b>06 Dec 2024</b></p><div><h2>Question</h2><p>What?</p></div><h2>Background of the question</h2><p>Why.</p><h2>EIOPA answer</h2><p>Because.</p></article><p>x</p>"""
FIELDED = """<div class="field--name-field-qa-subject-matter"><div class="field__label">S</div><div class="field__item">Topic</div></div><div class="field--name-field-qa-level1"><div class="field__item">Regulation (EU) 2022/2554</div></div>
<div class="additionalinfo"><div>Status: Answer published</div><div>Submission date: 01/02/2024</div></div><details><summary>Q</summary><p>Ask?</p></details><details><p>One.</p></details><details><p>Two.</p></details>"""


def test_dialects(spark):
    pages = spark.createDataFrame([("eba", "http://e/2018_7", LIST), ("eiopa", "http://i/x_en", HEADED), ("esma", "http://m/2356", FIELDED), ("none", "http://n", "<p>"), ("eba", "http://e/9", "<p>nothing</p>")], "authority string, url string, html string")
    got = {r["source_url"]: r for r in H.parse_pages(pages).collect()}
    a = got["http://e/2018_7"]
    assert (a["qa_id"], a["question"], a["answer"], a["dates"], a["extra"]) == ("2018_7", "- one\n\ntwo", "Yes.", {"date_of_submission": "7/9/2018"}, {"subject_matter": "Buffers"})
    b = got["http://i/x_en"]
    assert (b["joint_id"], b["question"], b["background"], b["answer"], b["dates"]) == ("DORA137", "What?", "Why.", "Because.", {"date_of_publication": "06 Dec 2024"})
    c = got["http://m/2356"]
    assert (c["qa_id"], c["topic"], c["status"], c["question"], c["answer"], c["dates"]) == ("2356", "Topic", "Answer published", "Ask?", "One.\n\n---\n\nTwo.", {"submission_date": "01/02/2024"})
    assert got["http://n"]["error"].startswith("KeyError")
    assert got["http://e/9"]["qa_id"] == "9" and "parse_warning" in got["http://e/9"]["extra"]


# --- records on disk ------------------------------------------------------------------------------------------------------------------


def a_record(spark, **more):
    base = dict(authority="esma", qa_id="7", slug="7", family="dora", joint_id="", legal_act="DORA", legal_act_ref="(EU) 2022/2554", legal_act_raw="x", article="Article 5", topic="t", status="Final", source_url="http://u", retrieved_at="2024-01-02T00:00:00Z", question='He said "no"\nand left', background="", answer="A.\n\n---\n\nB.")
    rows = [tuple((base | m).values()) for m in (more.get("rows") or [more])]
    return spark.createDataFrame(rows, ", ".join(f"{k} string" for k in base)).withColumns({"dates": F.create_map(F.lit("final_publishing_date"), F.lit("20/05/2024")), "extra": F.create_map(F.lit("note"), F.lit('a "b" \\'))})


def test_markdown_round_trip(spark, tmp_path):
    rows = a_record(spark, rows=[{}, {"slug": "8", "qa_id": "8", "family": "crr", "background": "Why", "answer": ""}])
    assert corpus.export_markdown(rows, str(tmp_path)) == 2
    (tmp_path / "crr" / "bad.md").write_text("no head")
    got = {r["slug"]: r for r in corpus.read_records(spark, str(tmp_path)).collect()}
    assert set(got) == {"7", "8"}
    r = got["7"]
    assert (r["question"], r["answer"], r["background"], r["dates"], r["extra"], r["family"]) == ('He said "no"\nand left', "A.\n\n---\n\nB.", "", {"final_publishing_date": "20/05/2024"}, {"note": 'a "b" \\'}, "dora")
    assert got["8"]["background"] == "Why" and got["8"]["answer"] == "*(not captured)*"
    assert corpus.read_record(spark, str(tmp_path), "esma:8").count() == 1
    text = (tmp_path / "dora" / "esma-7.md").read_text()
    assert 'date_final_publishing_date_iso: "2024-05-20"' in text and "## Background" not in text
    idx = index.index_rows(corpus.read_records(spark, str(tmp_path)))
    assert {r["qa_id"]: (r["date"], r["article"], r["mirrored"]) for r in idx.collect()}["7"] == ("2024-05-20", "5", "2024-01-02")
    meta = index.manifest_meta(idx, spark.createDataFrame([("a:1", "h", "2024-01-03T00:00:00Z"), ("a:2", "delisted:h", "2023-01-01T00:00:00Z")], schemas.STATE), "2024-01-01").first()
    assert tuple(meta) == (2, "2024-01-01", "2024-01-03")
    index.write_index(idx, str(tmp_path / "index"))
    assert spark.read.json(str(tmp_path / "index")).count() == 2
    assert {tuple(r) for r in index.manifest(idx).collect()} == {("dora", 1, "DORA", "esma"), ("crr", 1, "DORA", "esma")}


@pytest.mark.parametrize(
    ("dates", "want"),
    [
        ({"final_publishing_date": "sometime", "publication_final_answer": "2021-02-03", "submission_date": "01/01/2020"}, "2021-02-03"),
        ({"publication_final_answer": "5 March 2021", "submission_to_esas": "2019-01-01"}, "2021-03-05"),
        ({"submission_date": "01/02/2020"}, "2020-02-01"),
        ({"date_of_publication": "01/02/2020"}, ""),
    ],
)
def test_index_dates_are_iso_days(spark, tmp_path, dates, want):
    rows = a_record(spark).withColumn("dates", F.create_map(*[F.lit(x) for kv in dates.items() for x in kv]))
    corpus.export_markdown(rows, str(tmp_path))
    for r in (rows.withColumn("file", F.lit("f")), corpus.read_records(spark, str(tmp_path))):
        assert [x["date"] for x in index.index_rows(r).collect()] == [want]


def test_content_hash_leaves_the_time_out(spark):
    h = lambda **m: a_record(spark, **m).select(corpus.content_hash().alias("h")).first()["h"]
    assert h() == h(retrieved_at="2030-01-01T00:00:00Z") != h(answer="other")


def test_state_and_runs(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"records": {"a:1": "h"}, "verified_at": {"a:1": "2024-01-01T00:00:00Z", "a:2": "x"}}')
    state, meta = corpus.read_state(spark, str(tmp_path / "s.json"))
    assert sorted(map(tuple, state.collect())) == [("a:1", "h", "2024-01-01T00:00:00Z"), ("a:2", "", "x")]
    assert meta.first()["last_full_sweep"] == ""
    (tmp_path / "r.jsonl").write_text('{"ts":"t1","totals":{"eba":{"seen":2,"written":1}}}\n{"ts":"t2","mode":"sweep","totals":{"eba":{"seen":3,"checked":3,"errors":0}}}\n')
    got = corpus.run_rows(corpus.read_runs(spark, str(tmp_path / "r.jsonl"))).orderBy("ts").collect()
    assert (got[0]["mode"], got[0]["checked"], got[1]["checked"]) == (None, None, 3)
    corpus.append_run(spark.createDataFrame([("t3",)], "ts string"), str(tmp_path / "log"))
    corpus.append_run(spark.createDataFrame([("t4",)], "ts string"), str(tmp_path / "log"), limited=True)
    assert corpus.read_runs(spark, str(tmp_path / "log")).count() == 1


# --- register and listings ------------------------------------------------------------------------------------------------------------


def test_decode(spark):
    desc = spark.createDataFrame([(0, "id", None), (1, "act", "D0"), (2, "date", None)], "col int, name string, dict string")
    words = spark.createDataFrame([("D0", 0, "DORA"), ("D0", 1, "CRR")], "dict string, idx int, value string")
    rows = [(1, 0, 0, ["a", "0", "x"]), (2, 0b010, 0, ["b", "y"]), (3, 0, 0b100, ["c", "1"]), (4, 0b100, 0, ["d", "1"]), (5, 0b110, 0b100, ["e"]), (6, 0b111, 0b111, [])]
    df = spark.createDataFrame(rows, "i int, r long, n long, c array<string>")
    got = [tuple(r) for r in register.decode_rows(df, desc, words, ["id", "act", "date"]).orderBy("i").collect()]
    assert got == [(1, "a", "DORA", "x"), (2, "b", "DORA", "y"), (3, "c", "CRR", None), (4, "d", "CRR", None), (5, "e", "CRR", None), (6, "e", "CRR", None)]


def pages_of(spark, *links):
    return spark.createDataFrame([("s", n, x) for n, xs in enumerate(links) for x in (xs or [None])], "source string, page_no int, link string")


@pytest.mark.parametrize(("pages", "want"), [((["a", "b"], [], ["c"], [], []), "abc"), ((["a"], [], [], ["z"]), "a"), ((["a"], ["a"], ["b"], ["a"], ["b"]), "ab")])
def test_walk(spark, pages, want):
    assert sorted(r["link"] for r in register.complete_walk(pages_of(spark, *pages)).collect()) == list(want)


def test_a_second_read_counts_for_barren_pages_only(spark):
    pages = spark.createDataFrame([("s", 0, "<a x=1>", "<a x=9>"), ("s", 1, "<a x=1>", "<a x=2>"), ("s", 2, "", None), ("s", 3, "<a x=3>", "<a x=8>")], "source string, page_no int, html string, retry_html string")
    got = register.listing_links(pages, r"<a x=(\d)>").collect()
    assert sorted((r["page_no"], r["link"] or "") for r in got) == [(0, "1"), (1, "2"), (2, ""), (3, "3")]


def test_register_rows_from_decoded_columns(spark):
    names = ["Q.Joint ID", "Q.Receiving ESA", "Q.ID at the ESA", "Q.Link to the answer", "Q.Status", "Q.Legal act", "Q.Article", "Q.Topic", "Q.Answered by", "Q.Date of submission", "Q.Date of publication"]
    decoded = spark.createDataFrame([(" DORA1 ", "ESMA", "77", None, "Final", "DORA", "5", "t", "EC", "1704067200000", "2024-02-03")], ", ".join(f"`{n}` string" for n in names))
    got = register.register_rows(decoded).first()
    assert tuple(got) == ("DORA1", "esma", "77", "", "Final", "DORA", "5", "t", "EC", "2024-01-01", "2024-02-03", [])


def test_a_truncated_walk_is_an_error(spark):
    with pytest.raises(register.ListingTruncated):
        register.complete_walk(pages_of(spark, ["a"], ["b"]))


def test_register_parts(spark):
    rows = spark.createDataFrame([("DORA1", "esma", "12", "Some title", "Final", "DORA (EU) 2022/2554"), ("DORA2", "eba", "9", "http://x", "Revised", "dora"), ("X", "eba", "9", "no id", "Rejected", "DORA")], "joint_id string, authority string, native_id string, link string, status string, legal_act_raw string")
    kept = register.filter_register(rows, "DORA", ["final", "REVISED"], ["eba", "esma"])
    assert kept.count() == 2
    good, bad = register.split_unreachable(register.repair_links(rows))
    assert {r["link"] for r in good.collect()} == {"http://x", "https://www.esma.europa.eu/publications-data/questions-answers/12"}
    assert [r["joint_id"] for r in bad.collect()] == ["X"]
    assert register.loose_column(["Q.Legal act", "Q.Status"], "legal", "ACT") == "Q.Legal act"
    with pytest.raises(LookupError):
        register.loose_column(["a"], "b")
    raw = spark.createDataFrame([('[{"command":"insert","selector":"#view-count-final","data":"<b>(2124)</b>"},{"selector":"#other","data":"5"}]',), ("not json",)], "body string")
    assert [tuple(r) for r in register.tab_counts(raw).collect()] == [("final", 2124)]
    ent = spark.createDataFrame([("A", ["x"]), ("B", ["x", "y"])], "name string, properties array<string>")
    assert register.widest_entity(ent).first()["name"] == "B"
    p = register.read_params("?q=a+b&act=CRR,NO&auth=eba&from=2024-01-01&to=bad", {"CRR", "CRD"}, {"eba"})
    assert p == {"q": "a b", "acts": ["CRR"], "authority": "eba", "date_from": "2024-01-01", "date_to": ""}
    assert register.to_params("a b", ["CRR", "CRD"]) == "q=a+b&act=CRD%2CCRR"


# --- selection, merging, tombstones -----------------------------------------------------------------------------------------------------


def test_modes():
    m = select.run_mode("2024-01-20", "2024-02-01T00:00:00Z")
    assert (m.sweep, m.stale_before, m.window_start) == (False, "2024-01-25T00:00:00Z", "2024-01-18")
    assert select.run_mode("", "2024-02-01T00:00:00Z").sweep and select.run_mode("2023-12-01", "2024-02-01T00:00:00Z").sweep and select.run_mode("2024-01-31", "2024-02-01T00:00:00Z", sweep=True).sweep


def test_the_budget_is_shared_and_takes_the_oldest(spark):
    mode = select.RunMode(False, "2024-01-25T00:00:00Z", "2024-01-18", 2)
    cand = spark.createDataFrame([("a:1", 0, False), ("a:2", 0, False), ("b:1", 1, False), ("b:2", 1, True), ("b:3", 1, False), ("b:4", 1, False)], "key string, source_seq int, in_window boolean")
    state = spark.createDataFrame([("a:1", "h", "2024-01-31T00:00:00Z"), ("a:2", "h", "2024-01-02T00:00:00Z"), ("b:1", "h", ""), ("b:2", "h", "2024-01-31T00:00:00Z"), ("b:3", "delisted:h", "2024-01-31T00:00:00Z"), ("b:4", "h", "2024-01-01T00:00:00Z")], schemas.STATE)
    got = {r["key"]: r["must"] for r in select.select_fetches(cand, state, mode).collect()}
    assert got == {"a:2": False, "b:1": False, "b:2": True, "b:3": True}


def test_delta_then_nothing(spark):
    rec = spark.createDataFrame([("a:1", "h1"), ("a:2", "h2")], "key string, content_hash string")
    none = spark.createDataFrame([], schemas.STATE)
    assert merge.changed(rec, none, rec.where("false")).count() == 2
    state = merge.next_state(none, rec, "now")
    assert merge.changed(rec, state, rec).count() == 0
    assert merge.changed(rec, state, rec.where("key = 'a:1'")).count() == 1
    assert merge.changed(rec, state, rec, full=True).count() == 2


def gone(spark, n, missing, archived=0, errors=0, allow=False, complete=True, unselected=False):
    state = spark.createDataFrame([(f"eba:{i}", "h", "t") for i in range(n)] + [("esma:1", "h", "t"), ("eba:old", "delisted:h", "t")], schemas.STATE)
    seen = spark.createDataFrame([(f"eba:{i}",) for i in range(missing, n)], "key string")
    archive = spark.createDataFrame([("eba", str(i)) for i in range(archived)], "authority string, slug string")
    done = spark.createDataFrame([("esma" if unselected else "eba", complete, errors)], "authority string, complete boolean, errors int")
    return tombstone.tombstones(state, seen, archive, done, allow), state


def test_tombstones(spark):
    marks, state = gone(spark, 30, 3, archived=1)
    assert sorted(tuple(r) for r in marks.collect()) == [("eba:0", "eba", "archived", False), ("eba:1", "eba", "delisted", False), ("eba:2", "eba", "delisted", False)]
    assert {r["key"] for r in tombstone.buried(state, marks).where("hash LIKE 'delisted:%'").collect()} == {"eba:0", "eba:1", "eba:2", "eba:old"}
    assert all(r["blocked"] for r in gone(spark, 30, 7)[0].collect())
    assert not any(r["blocked"] for r in gone(spark, 30, 7, allow=True)[0].collect())
    assert gone(spark, 30, 3, errors=1)[0].count() == 0
    assert gone(spark, 30, 3, complete=False)[0].count() == 0
    # authorities that a run didn't select lose nothing
    assert {r["authority"] for r in gone(spark, 30, 3, unselected=True)[0].collect()} <= {"esma"}


def test_marks_are_exclusive(spark):
    df = spark.createDataFrame([("k", {"archived": "d1"}), ("l", {})], "key string, extra map<string,string>")
    marks = spark.createDataFrame([("k", "delisted", False), ("l", "delisted", False)], "key string, field string, blocked boolean")
    assert {r["key"]: r["extra"] for r in tombstone.apply_marks(df, marks, "d2").collect()} == {"k": {"archived": "d1"}, "l": {"delisted": "d2"}}


def test_merge(spark):
    pages = spark.createDataFrame([("k", "", "Draft", "Directive 2013/36/EU", "5", "", {"submission_to_esas": "x"}, {})], "key string, joint_id string, status string, legal_act_raw string, article string, topic string, dates map<string,string>, extra map<string,string>")
    reg = spark.createDataFrame([("k", "DORA1", "Final", "(EU) 2022/2554", "9", "T", "2024-01-01", "2024-02-02")], "key string, joint_id string, status string, legal_act_raw string, article string, topic string, date_submission string, date_publication string")
    r = merge.merged(reg, pages).first()
    assert (r["joint_id"], r["status"], r["legal_act_raw"], r["article"], r["topic"]) == ("DORA1", "Final", "(EU) 2022/2554", "5", "T")
    assert r["dates"] == {"submission_to_esas": "x", "publication_final_answer": "2024-02-02"} and r["extra"] == {"portal_legal_act": "Directive 2013/36/EU"}
    assert merge.with_status(pages, "final").count() == 0 and merge.with_status(pages, "").count() == 1


def test_alternates(spark):
    cand = spark.createDataFrame([("k", ["u1", "u2", "u3"]), ("l", ["u1"])], "key string, urls array<string>")
    pages = spark.createDataFrame([("u1", "boom", "x"), ("u3", "", "3"), ("u2", "", "2")], "source_url string, error string, qa_id string")
    assert [(r["key"], r["url"], r["qa_id"]) for r in select.first_that_parses(cand, pages).collect()] == [("k", "u2", "2")]


def test_runs(spark):
    ev = spark.createDataFrame([("eba", "seen", True), ("eba", "errors", False), ("esma", "seen", True)], "authority string, event string, ok boolean")
    t = runs.totals(ev)
    assert {r["authority"]: (r["seen"], r["errors"], r["written"]) for r in t.collect()} == {"eba": (1, 1, 0), "esma": (1, 0, 0)}
    assert not runs.run_ok(t).first()["ok"] and runs.run_ok(t.where("authority = 'esma'")).first()["ok"]
    assert "| eba |" in runs.summary_table(t)
    assert runs.sweep_watermark("a", "b", True, True, False, True) == "b" and runs.sweep_watermark("a", "b", True, True, True, True) == "a"
    s = spark.createDataFrame([(f"k{i}", "h", "") for i in range(50)], schemas.STATE)
    assert runs.state_digest(s).first() == runs.state_digest(s.repartition(7)).first() != runs.state_digest(s.where("key <> 'k7'")).first()


# --- search -----------------------------------------------------------------------------------------------------------------------------


def found(spark, q, *texts, **facets):
    rows = [(f"q{i}", t, "CRR" if i % 2 else "DORA-RTS", "eba", ["2024-01-01", "", "2023-05-05"][i % 3], "crr" if i % 2 else "dora") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "qa_id string, question string, legal_act string, authority string, date string, family string")
    for c in ("joint_id", "article", "topic", "background", "answer"):
        df = df.withColumn(c, F.lit(""))
    return [r["qa_id"] for r in S.search(index.with_haystack(df), q, count=False, **facets).collect()]


def test_search_language(spark):
    assert found(spark, "art", "art 5", "party", "éart", "Articles") == ["q3", "q0", "q2"]
    assert found(spark, "the of", "x", "y") == ["q0", "q1"]
    assert found(spark, "“own  funds”", "Own funds!", "funds own") == ["q0"]
    assert found(spark, "alpha beta", "beta alpha", "alpha") == ["q0"]
    assert found(spark, "alpha OR beta and gamma", "alpha", "beta", "beta gamma") == ["q0", "q2"]
    assert found(spark, "/ba[rz]+/", "x bazz", "ba") == ["q0"]
    assert found(spark, "/a(b/", "x a(b y", "ab") == ["q0"]
    assert found(spark, "/É/", "é", "e") == ["q0"]
    assert found(spark, "(word),", "words", "sword") == ["q0"]
    assert found(spark, "", "a", "b", "c", date_from="2023-01-01") == ["q0", "q2"]
    assert found(spark, "", "a", "b", acts=["CRR"], families=S.needed_families(["CRR"], ["crr", "dora"])) == ["q1"]
    assert S.needed_families(["Other"], ["crr", "dora"]) == ["crr", "dora"]


def test_highlight(spark):
    df = spark.createDataFrame([("Own\n funds & art <b>",)], "t string")
    f = lambda q: df.select(S.highlighted(S.parse_query(q), F.col("t")).alias("x")).first()["x"]
    assert f('"own funds" art') == "<mark>Own\n funds</mark> &amp; <mark>art</mark> &lt;b&gt;"
    assert f("of the") is None


# --- streams ------------------------------------------------------------------------------------------------------------------------------


def test_stream_applies_each_change_once(spark, tmp_path):
    from quillstone.streaming import cdc

    schema = "key string, content_hash string, retrieved_at string, question string"
    landed, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("a:1", "h1", "1", "q"), ("a:1", "h2", "2", "q2"), ("a:2", "x", "1", "z")], schema).write.parquet(landed)
    cdc.mirror(spark, landed, out, schema, "t1").awaitTermination()
    spark.createDataFrame([("a:1", "h2", "3", "q2"), ("a:3", "n", "3", "new")], schema).write.mode("append").parquet(landed)
    cdc.mirror(spark, landed, out, schema, "t2").awaitTermination()
    records = {r["key"]: r["retrieved_at"] for r in cdc.latest(spark, out, "records", schema).collect()}
    assert records == {"a:1": "2", "a:2": "1", "a:3": "3"}  # an unchanged record isn't written again
    state = {r["key"]: (r["hash"], r["verified_at"]) for r in cdc.latest(spark, out, "state", schema).collect()}
    assert state == {"a:1": ("h2", "t2"), "a:2": ("x", "t1"), "a:3": ("n", "t2")}


def test_searches_read_only_the_families_asked_for(spark, tmp_path):
    rows = a_record(spark, rows=[{"slug": str(i), "qa_id": str(i), "family": f"f{i % 4}", "question": f"thing {i}"} for i in range(12)]).withColumn("file", F.lit("x"))
    index.write_search_table(index.index_rows(rows), str(tmp_path / "t"))
    got = S.search(spark.read.parquet(str(tmp_path / "t")), "thing", families=["f1", "f2"])
    assert {r["qa_id"] for r in got.collect()} == {str(i) for i in range(12) if i % 4 in (1, 2)}
    plan = got._jdf.queryExecution().explainString(got._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [family" in plan


@pytest.mark.parametrize(("word", "hay", "want"), [("thing", "athing thing", True), ("thing", "athing", False), ("thing", "\u00e9thing", True), ("9a", "x-9a", True), ("c++", "c++ c", True), ("\u00e9t", "x\u00e9t", True), ("thing", "things", True)])
def test_words_match_at_their_beginning(spark, word, hay, want):
    df = spark.createDataFrame([(hay,)], "hay string")
    assert df.select(S.matches(S.parse_query(word), F.col("hay")).alias("m")).first()["m"] == want


def test_a_limit_takes_what_must_be_first_and_then_the_longest_unverified(spark):
    from quillstone.operators.select import limited

    rows = [(0, "a", False, "2024-01-01"), (0, "z", True, "2024-01-09"), (0, "y", True, None), (0, "b", False, "2023-12-01"), (1, "c", False, "2024-01-01"), (1, "d", False, None)]
    chosen = spark.createDataFrame(rows, "source_seq int, key string, must boolean, verified_at string")
    assert sorted(r["key"] for r in limited(chosen, 3).collect()) == ["b", "c", "d", "y", "z"]
    assert sorted(r["key"] for r in limited(chosen, 1).collect()) == ["d", "y"]


@pytest.mark.parametrize("files", [1, 3])
def test_the_state_as_a_sorted_document(spark, tmp_path, files):
    import json

    rows = [("eba:b", 'h"1', "2024-01-02"), ("eba:a", "delisted:x", ""), ("esma:c", "", "2024-01-01"), ("eba:é", "z", None)]
    corpus.write_state_json(spark.createDataFrame(rows, schemas.STATE), "2024-01-31", str(tmp_path / "s"), files)
    text = "".join(p.read_text() for p in sorted((tmp_path / "s").glob("part-*")))
    said = json.loads(text)
    assert said == {"last_full_sweep": "2024-01-31", "records": {"eba:a": "delisted:x", "eba:b": 'h"1', "eba:é": "z"}, "verified_at": {"eba:b": "2024-01-02", "esma:c": "2024-01-01"}}
    assert list(said["records"]) == sorted(said["records"]) and len(text.splitlines()) == 5 + 2 + 5
    (tmp_path / "s.json").write_text(text)
    state, meta = corpus.read_state(spark, str(tmp_path / "s.json"))
    assert sorted((r["key"], r["hash"], r["verified_at"]) for r in state.collect()) == [("eba:a", "delisted:x", ""), ("eba:b", 'h"1', "2024-01-02"), ("eba:é", "z", ""), ("esma:c", "", "2024-01-01")]
    empty = spark.createDataFrame([], schemas.STATE)
    corpus.write_state_json(empty, "", str(tmp_path / "e"))
    assert json.loads("".join(p.read_text() for p in sorted((tmp_path / "e").glob("part-*")))) == {"last_full_sweep": "", "records": {}, "verified_at": {}}
