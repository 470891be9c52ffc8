"""Change capture as a stream: landed records flow into a store of records and their state, batch by batch.

A batch reads and writes only the buckets that its keys lie in, and shows records and state at once, as the store's next version. A batch that runs again after a
failure finds its own hashes known, so nothing is applied twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import changed
from ..schemas import STATE
from ..sources.store import Store, bucket


def open_store(spark: SparkSession, folder: str, record_schema: str) -> Store:
    return Store(spark, f"{folder}/store", {"records": (f"{record_schema}, bucket STRING", "bucket"), "state": (f"{STATE}, bucket STRING", "bucket")})


def latest(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """records or state as the last batch left them. schema: that of the records."""
    return open_store(spark, folder, schema).read(name).drop("bucket")


def newest(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of each key by the given columns; merged from each task's own, so no key lands in one task whole."""
    last = F.max_by(F.struct(*[c for c in rows.columns if c != key]), F.struct(*order))
    return rows.groupBy(key).agg(last.alias("r")).select(key, "r.*")


def apply_batch(store: Store, rows: DataFrame, now: str) -> None:
    """rows: key, content_hash and record columns. Of several rows for a key the last retrieved one counts."""
    last = newest(rows, "key", "retrieved_at", "content_hash").withColumn("bucket", bucket("key")).persist()
    base = store.version()
    parts = [r[0] for r in last.select("bucket").distinct().collect()]  # a row per bucket
    new = changed(last, store.read("state", parts, base), store.read("records", parts, base).select("key"))
    state = last.select("key", F.col("content_hash").alias("hash"), F.lit(now).alias("verified_at"), "bucket")
    store.commit({"records": new, "state": state}, base=base)
    last.unpersist()


def mirror(spark: SparkSession, landed: str, folder: str, schema: str, now: str, trigger_once: bool = True):  # noqa: ANN201
    """Apply all landed parquet files that haven't been; with trigger_once the query ends when they are."""
    stream = spark.readStream.schema(schema).parquet(landed)
    writer = stream.writeStream.option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(lambda df, n: apply_batch(open_store(df.sparkSession, folder, schema), df, now))
    return (writer.trigger(availableNow=True) if trigger_once else writer).start()
