import pytest
from pyspark.sql import functions as F

from quillstone.sources import ordered


@pytest.fixture
def table(spark, tmp_path):
    rows = spark.range(500).select(F.when(F.col("id") % 50 == 7, None).otherwise(F.concat(F.lit("f"), (F.col("id") % 7).cast("string"))).alias("family"), F.format_string("p%03d", (F.col("id") * 37) % 500 % 460).alias("path"), "id")
    files = ordered.write_ordered(rows.repartition(3), str(tmp_path), ["family", "path"], rows_per_file=60)
    return rows, files, str(tmp_path)


def key(r):
    return (r["family"] is not None, r["family"] or "", r["path"])


def test_files_one_after_another_are_the_sorted_table(spark, table):
    rows, files, path = table
    want = sorted(map(key, rows.collect()))
    listed = files.orderBy("place").collect()
    assert all(r["rows"] <= 60 for r in listed) and sum(r["rows"] for r in listed) == 500 and len(listed) >= 9
    assert [key(r) for t in ordered.in_order(spark, path) for r in t.collect()] == want
    placed = ordered.positions(spark, path).orderBy("position").collect()
    assert [r["position"] for r in placed] == list(range(500)) and [key(r) for r in placed] == want


def test_a_range_opens_only_files_that_can_hold_it(spark, table):
    rows, files, path = table
    got = ordered.between(spark, path, ("f2", "p100"), ("f2", "p300"))
    assert sorted(map(key, got.collect())) == sorted(key(r) for r in rows.collect() if r["family"] == "f2" and "p100" <= r["path"] <= "p300")
    assert 0 < len(got.inputFiles()) < files.count() / 2
    assert ordered.between(spark, path, ("zz", ""), ("zzz", "")).count() == 0


def test_an_empty_table(spark, tmp_path):
    files = ordered.write_ordered(spark.createDataFrame([], "family string, path string"), str(tmp_path), ["family", "path"])
    assert files.count() <= 1 and ordered.positions(spark, str(tmp_path)).count() == 0
