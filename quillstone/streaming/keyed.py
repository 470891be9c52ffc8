"""The state of records as a stream keeps it: a row per key in a state store, so a batch costs its own keys and not the corpus.

Landed rows (key, content_hash, retrieved_at) come in batches. For each key the newest row of a batch counts, by time and then hash; one that is older than what is known is late and
changes nothing. Out come the keys that the batch verified, each with its change: new, changed, returned (known, but marked as gone) or same. Only the first three need to be
written. The state outlives restarts in the stream's checkpoint; read_state() shows it as a table. BatchLog writes a line per batch, once, whatever restarts.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery, StreamingQueryListener

LANDED = "key STRING, content_hash STRING, retrieved_at STRING"
VERIFIED = "key STRING, hash STRING, verified_at STRING, change STRING"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
GONE = "delisted:"


class Verify(StatefulProcessor):
    """Of each key: hash and verified_at."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "hash STRING, verified_at STRING")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: ANN401, N802, N803, ARG002
        last = max((t, h) for b in rows for t, h in zip(b["retrieved_at"].fillna(""), b["content_hash"].fillna(""), strict=True))
        before = self.known.get() if self.known.exists() else None
        if before is not None and last[0] < before[1]:
            return
        change = "new" if before is None else "returned" if before[0].startswith(GONE) else "same" if before[0] == last[1] else "changed"
        self.known.update((last[1], last[0]))
        yield pd.DataFrame({"key": [key[0]], "hash": [last[1]], "verified_at": [last[0]], "change": [change]})

    def close(self) -> None:
        pass


def verified(landed: DataFrame) -> DataFrame:
    """landed: a stream with the columns of LANDED. A row per key and batch, as VERIFIED says; rows without a key are left out."""
    rows = landed.select("key", "content_hash", "retrieved_at").where("key IS NOT NULL")
    return rows.groupBy("key").transformWithStateInPandas(Verify(), VERIFIED, outputMode="Update", timeMode="None")


def run(landed: DataFrame, checkpoint: str, out: str, name: str | None = None, **options: str) -> StreamingQuery:
    """Starts the stream over all that has landed; changes lie below out, a folder per batch, which a batch that runs again replaces. Its counts are observed as ``changes``."""
    spark = landed.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)
    counts = [F.count_if(F.col("change") == c).alias(c) for c in ("new", "changed", "returned", "same")]

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = verified(landed).observe("changes", *counts).writeStream.outputMode("update").option("checkpointLocation", checkpoint).options(**options)
    writer = writer.queryName(name) if name else writer
    return writer.foreachBatch(write).trigger(availableNow=True).start()


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """key, hash, verified_at of all keys, as the last batch left them."""
    rows = spark.read.format("statestore").option("stateVarName", "known").load(checkpoint)
    return rows.select(F.col("key.key").alias("key"), F.col("value.hash").alias("hash"), F.col("value.verified_at").alias("verified_at"))


class BatchLog(StreamingQueryListener):
    """A line of the run log per batch: one small file, named by query and batch, so a batch that is reported again replaces its line."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def onQueryStarted(self, event: Any) -> None:  # noqa: ANN401, N802
        pass

    def onQueryProgress(self, event: Any) -> None:  # noqa: ANN401, N802
        p = event.progress
        if not p.numInputRows:
            return  # an idle report repeats the number of the next batch
        seen = {k: v.asDict() for k, v in p.observedMetrics.items()}
        line = {"query": str(p.id), "batch": p.batchId, "ts": p.timestamp, "rows": p.numInputRows, **seen.get("changes", {})}
        sc = self.spark.sparkContext
        at = sc._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{p.id}-{p.batchId:09d}.json")
        out = at.getFileSystem(sc._jsc.hadoopConfiguration()).create(at, True)
        try:
            out.write(bytearray((json.dumps(line) + "\n").encode()))
        finally:
            out.close()

    def onQueryIdle(self, event: Any) -> None:  # noqa: ANN401, N802
        pass

    def onQueryTerminated(self, event: Any) -> None:  # noqa: ANN401, N802
        pass


LOG = "query STRING, batch BIGINT, ts STRING, rows BIGINT, new BIGINT, changed BIGINT, returned BIGINT, same BIGINT"


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(LOG).json(folder)
