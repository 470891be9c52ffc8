import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from quillstone import schemas
from quillstone.plans.config import config_of, read_config
from quillstone.plans.mirror import Landed, mirror_run
from quillstone.sources import corpus

CONFIG = config_of({"joint_acts": {"DORA": {"register_act": "DORA", "act_ref": "2022/2554", "statuses": ["Final"]}}, "eba": {"legal_act_ids": [32], "default_act_ref": "2013/36", "require_status": "Final"}, "acts": {"2023/1114": {"label": "MiCA", "joint_id_format": "%s%04d", "token": "mica"}}})
NOW = "2024-02-01T00:00:00Z"


def page(qa, answer, status="Final Q&A"):
    return f'<dl class="metadata"><dt>Question ID</dt><dd>{qa}</dd><dt>Status</dt><dd>{status}</dd><dt>Legal act</dt><dd>Directive 2013/36/EU</dd><dt>Question</dt><dd><p>Q {qa}</p></dd><dt>Answer</dt><dd><p>{answer}</p></dd></dl>'


def landed(spark, listed=("1", "2", "3"), answer="yes", **more):
    url = lambda i: f"https://x/publicId/2020_{i}"
    register = spark.createDataFrame([("DORA1", "esma", "77", "Title only", "Final", "DORA (EU) 2022/2554", "", "t", "", "2024-01-01", "2024-01-30", None)], schemas.REGISTER_ROW)
    esma = '<details><p>Ask</p></details><details><p>Tell</p></details>'
    pages = [("eba", url(i), page(f"2020_{i}", answer, "Review" if i == "9" else "Final Q&A")) for i in listed] + [("esma", "https://www.esma.europa.eu/publications-data/questions-answers/77", esma)]
    urls = lambda xs: spark.createDataFrame([(url(i),) for i in xs], "url string")
    return Landed(register, urls(listed), urls(more.pop("archive", [])), urls([]), spark.createDataFrame(pages, "authority string, url string, html string"), **more)


def empty(spark):
    records = spark.createDataFrame([], "key string, " + schemas.RECORD)
    return records, spark.createDataFrame([], schemas.STATE)


@pytest.fixture
def run(tmp_path):
    return lambda *a, **kw: a_run(str(tmp_path / "work"), *a, **kw)


def a_run(work, spark, land, records, state, last="2024-01-31", **kw):
    r = mirror_run(land, records, state, last, CONFIG, NOW, work, **kw)
    return r, {x["authority"]: x for x in r.totals.collect()}


def fixed(spark, df, path):
    df.write.mode("overwrite").parquet(str(path))
    return spark.read.parquet(str(path))


def test_a_run_then_a_second_one(spark, tmp_path, run):
    r, n = run(spark, landed(spark, ("1", "2", "3", "9")), *empty(spark))
    assert r.ok and tuple(n["eba"][c] for c in ("enumerated", "seen", "checked", "written")) == (4, 3, 3, 3) and n["esma"]["written"] == 1
    records, state = fixed(spark, r.records, tmp_path / "r"), fixed(spark, r.state, tmp_path / "s")
    rows = {x["key"]: x for x in records.collect()}
    assert (rows["eba:2020-1"]["legal_act"], rows["eba:2020-1"]["family"], rows["eba:2020-1"]["answer"]) == ("CRD", "crd", "yes")
    assert (rows["esma:77"]["legal_act"], rows["esma:77"]["joint_id"], rows["esma:77"]["question"]) == ("DORA", "DORA1", "Ask")
    swept, n = run(spark, landed(spark, ("1", "2", "3"), "changed"), records, state, last="")
    assert n["eba"]["written"] == 3 and swept.ok and swept.last_full_sweep == "2024-02-01"
    gone, n = run(spark, landed(spark, ("1",), archive=("2",)), records, state)
    assert (n["eba"]["archived"], n["eba"]["delisted"]) == (1, 1)
    marked = {x["key"]: x["extra"] for x in gone.records.collect()}
    assert marked["eba:2020-2"] == {"archived": "2024-02-01"} and marked["eba:2020-3"] == {"delisted": "2024-02-01"}
    assert {x["key"] for x in gone.state.where(F.col("hash").startswith("delisted:")).collect()} == {"eba:2020-2", "eba:2020-3"}
    short, n = run(spark, landed(spark, ("1",), announced=3), records, state)
    assert not short.ok and short.marks.count() == 0


def test_a_joint_record_keeps_what_the_register_says(spark, run):
    land = landed(spark, ("1",))
    land.register = land.register.withColumns({"legal_act_raw": F.lit("DORA"), "answered_by": F.lit("EC")})
    r, _ = run(spark, land, *empty(spark))
    row = r.records.where("key = 'esma:77'").first()
    assert row["legal_act_ref"] == ""  # words that name no act: never the default
    assert row["extra"]["answered_by"] == "EC"
    assert (row["dates"]["submission_to_esas"], row["dates"]["publication_final_answer"]) == ("2024-01-01", "2024-01-30")


def test_defaults_by_source(spark, run):
    from quillstone.functions.text import finalised

    rows = spark.createDataFrame([("", "2022/2554"), ("", "2013/36"), ("DORA", "2013/36")], "raw string, ref string")
    got = [r["a"]["legal_act"] for r in rows.select(finalised(F.col("raw"), F.lit(""), F.col("ref")).alias("a")).collect()]
    assert got == ["DORA", "CRD", ""]


def test_the_run_row(spark, tmp_path, run):
    r, _ = run(spark, landed(spark, ("1", "2")), *empty(spark), authorities=("eba", "esma"))
    row = r.run.first()
    assert (row["ts"], row["mode"], row["authorities"], row["full"]) == (NOW, "incremental", ["eba", "esma"], False)
    assert (row["totals"]["eba"]["written"], row["totals"]["esma"]["written"], len(row["state_sha256"])) == (2, 1, 64)
    corpus.append_run(r.run, str(tmp_path / "log"))
    assert corpus.run_rows(corpus.read_runs(spark, str(tmp_path / "log"))).where("authority = 'eba'").first()["checked"] == 2
    limited, _ = run(spark, landed(spark, ("1", "2")), *empty(spark), limit_per_source=1)
    assert limited.run is None


def test_an_implausible_window_is_ignored_with_or_without_a_count(spark, tmp_path, run):
    many = tuple(str(i) for i in range(10, 20))
    r, _ = run(spark, landed(spark, many), *empty(spark))
    records, state = fixed(spark, r.records, tmp_path / "r"), fixed(spark, r.state.withColumn("verified_at", F.lit(NOW)), tmp_path / "s")
    land = landed(spark, many)
    land.window = land.listing
    for cap, announced, checked in ((250, None, 10), (5, None, 0), (250, 2, 0), (250, 10, 10)):
        land.window_announced = announced
        got = mirror_run(land, records, state, "2024-01-31", replace(CONFIG, window_max=cap), NOW, str(tmp_path / "w"))
        assert {x["authority"]: x["checked"] for x in got.totals.collect()}["eba"] == checked


def test_a_listing_beyond_the_page_budget_is_not_begun(spark, run, tmp_path):
    r = mirror_run(landed(spark, ("1", "2"), announced=41), *empty(spark), "2024-01-31", replace(CONFIG, max_pages=2), NOW, str(tmp_path / "w"))
    n = {x["authority"]: x for x in r.totals.collect()}
    assert not r.ok and (n["eba"]["enumerated"], n["eba"]["written"], n["eba"]["errors"], n["esma"]["written"]) == (0, 0, 1, 1)


def test_a_listing_is_complete_by_its_own_length(spark, run):
    # one of the listed addresses is the register's, another a twin: still three listed of three
    land = landed(spark, ("1", "2"), announced=3)
    land.listing = land.listing.unionByName(spark.createDataFrame([("https://x/publicId/2020_2/",)], "url string"))
    r, _ = run(spark, land, *empty(spark))
    assert r.ok


def test_an_archive_failure_counts_only_if_something_is_missing(spark, tmp_path, run):
    r, _ = run(spark, landed(spark, ("1", "2")), *empty(spark))
    records, state = fixed(spark, r.records, tmp_path / "r"), fixed(spark, r.state, tmp_path / "s")
    fine, _ = run(spark, landed(spark, ("1", "2"), archive_failed=True), records, state)
    assert fine.ok
    bad, _ = run(spark, landed(spark, ("1",), archive_failed=True), records, state)
    assert not bad.ok and bad.marks.count() == 0


def test_config(tmp_path):
    assert config_of({"joint_acts": {"X": {"register_act": "X"}}, "delay_seconds": 2}).joint_acts["X"].statuses == ("Final",)
    assert CONFIG.act_labels["2023/1114"] == "MiCA" and CONFIG.joint_formats["MICA"] == "%s%04d" and CONFIG.window_max == 250
    (tmp_path / "c.json").write_text(json.dumps({"incremental": {"window_days": 3}}))
    assert read_config(str(tmp_path / "c.json")).window_days == 3
