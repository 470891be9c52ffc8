import pytest
from pyspark.sql import functions as F

from quillstone.operators.merge import next_state
from quillstone.schemas import STATE
from quillstone.streaming import keyed


def land(spark, folder, number, rows):
    spark.createDataFrame(rows, keyed.LANDED).coalesce(1).write.parquet(f"{folder}/b{number}")


def stream(spark, folder):
    return spark.readStream.schema(keyed.LANDED).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").option("latestFirst", "false").parquet(folder)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def work(tmp_path):
    for x in ("landed", "out", "log"):
        (tmp_path / x).mkdir()
    return {x: f"file://{tmp_path}/{x}" for x in ("landed", "out", "log", "ck")}


def test_state_after_batches_and_a_restart_is_that_of_runs(spark, sf, work):
    """Events as records: users in several batches, and a restart between them."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    rows = events.select(F.col("user_id").cast("string").alias("key"), F.sha1(F.concat_ws(":", "event_type", F.col("value").cast("string"))).alias("content_hash"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("retrieved_at"))
    bounds = [r[0] for r in rows.select(F.explode(F.percentile(F.unix_micros(F.to_timestamp("retrieved_at")), F.array(*[F.lit(x) for x in (0.25, 0.5, 0.75)])))).collect()]
    at = F.unix_micros(F.to_timestamp("retrieved_at"))
    edges = [float("-inf"), *bounds, float("inf")]
    log = keyed.BatchLog(spark, work["log"])
    spark.streams.addListener(log)
    expected = spark.createDataFrame([], STATE)
    try:
        for k in range(4):
            part = rows.where((at > edges[k]) & (at <= edges[k + 1]))
            land(spark, work["landed"].removeprefix("file://"), k, part.collect())
            last = part.groupBy("key").agg(F.max_by("content_hash", F.struct("retrieved_at", "content_hash")).alias("content_hash"), F.max("retrieved_at").alias("t"))
            new = spark.createDataFrame(last.collect(), last.schema)
            expected = next_state(expected, new, "x").join(new.select("key", "t"), "key", "left").withColumn("verified_at", F.coalesce("t", "verified_at")).drop("t")
            expected = spark.createDataFrame(expected.collect(), STATE)
            if k != 0:  # the first two batches in one start, the others after a restart each
                keyed.run(stream(spark, work["landed"]), work["ck"], work["out"]).awaitTermination()
        state = rows_of(keyed.read_state(spark, work["ck"]))
        assert state == rows_of(expected) and len(state) >= 10
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        logged = keyed.read_log(spark, work["log"]).orderBy("batch").collect()
    finally:
        spark.streams.removeListener(log)
    assert [r["batch"] for r in logged] == [0, 1, 2, 3] and len({r["query"] for r in logged}) == 1
    assert sum(r["rows"] for r in logged) == rows.count() and sum(r["new"] for r in logged) == len(state)
    out = spark.read.parquet(work["out"])
    by_batch = {(r["batch"], r["change"]): r["n"] for r in out.groupBy("batch", "change").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert all(by_batch.get((r["batch"], c), 0) == r[c] for r in logged for c in ("new", "changed", "returned", "same"))


def test_changes_late_rows_and_returns(spark, work):
    batches = [
        [("a", "1", "2024-01-02"), ("a", "0", "2024-01-01"), ("b", "delisted:9", "2024-01-02"), (None, "x", "2024-01-02"), ("c", None, None)],
        [("a", "0", "2024-01-01"), ("b", "9", "2024-01-03"), ("c", "5", "2024-01-03")],
        [("a", "1", "2024-01-04"), ("b", "9", "2024-01-03"), ("c", "6", "2024-01-04"), ("c", "7", "2024-01-04")],
    ]
    want = [{"a": "new", "b": "new", "c": "new"}, {"b": "returned", "c": "changed"}, {"a": "same", "b": "same", "c": "changed"}]
    for k, rows in enumerate(batches):
        land(spark, work["landed"].removeprefix("file://"), k, rows)
        keyed.run(stream(spark, work["landed"]), work["ck"], work["out"]).awaitTermination()
        got = spark.read.parquet(f"{work['out']}/batch={k}").collect()
        assert {r["key"]: r["change"] for r in got} == want[k]
    assert rows_of(keyed.read_state(spark, work["ck"])) == [("a", "1", "2024-01-04"), ("b", "9", "2024-01-03"), ("c", "7", "2024-01-04")]
    # nothing new has landed: nothing is written
    keyed.run(stream(spark, work["landed"]), work["ck"], work["out"]).awaitTermination()
    assert {r["batch"] for r in spark.read.parquet(work["out"]).select("batch").distinct().collect()} == {0, 1, 2}
