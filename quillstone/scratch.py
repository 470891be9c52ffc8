"""Tables between the steps of a job, in the folder that all executors share."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

from .session import shared_dir

#: Texts that Python is handed at a time while a table is written, and their bytes (one text at least).
BATCH_ROWS, BATCH_BYTES = 2000, "8m"
_RECORDS, _BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def remove(sc: SparkContext, path: str) -> None:
    """A file or folder of any file system that Spark knows."""
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def _paths(sc: SparkContext) -> set[str]:
    """The application's scratch folders. Its stop(), called or at the program's end, removes them first; one that can't be removed keeps no other."""
    if not hasattr(sc, "_quillstone_scratch"):
        sc._quillstone_scratch = set()
        stop = sc.stop

        def clear() -> None:
            for path in list(sc._quillstone_scratch):
                with contextlib.suppress(Exception):  # the folder's file system may be gone
                    remove(sc, path)
                sc._quillstone_scratch.discard(path)

        def cleared_stop() -> None:
            clear()
            stop()

        sc.stop = cleared_stop
        atexit.register(clear)
    return sc._quillstone_scratch


class Scratch:
    """Tables written to the shared folder: they cut lineage and outlive any executor.

    While one is written, the shuffles behind it are removed as soon as it is done, and Python gets small batches: settings of a clone of the session, so the
    session's own stay as they are, and queries side by side don't meet. The folder goes when the session stops, or before it, by drop().
    """

    def __init__(self, spark: SparkSession, name: str, under: str | None = None):
        self.spark, self.n, self.paths = spark, 0, []
        self.at = f"{(under or shared_dir(spark)).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        _paths(spark.sparkContext).add(self.at)

    def lean(self, df: DataFrame, settings: dict[str, str] | None = None) -> DataFrame:
        """df in a clone of its session with the settings of a write, and any more."""
        clone = df.sparkSession._jsparkSession.cloneSession()
        rows = int(clone.conf().get(_RECORDS))
        clone.conf().set(_RECORDS, str(min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS))
        clone.conf().set(_BYTES, BATCH_BYTES)
        for key, value in {_CLEANUP: "true", **(settings or {})}.items():
            clone.conf().set(key, value)
        plan = df._jdf.queryExecution().logical()
        jvm = self.spark.sparkContext._jvm
        return DataFrame(jvm.org.apache.spark.sql.classic.Dataset.ofRows(clone, plan), SparkSession(self.spark.sparkContext, clone))

    def cut(self, df: DataFrame, codec: str = "snappy", settings: dict[str, str] | None = None) -> DataFrame:
        """df, written once and read again. settings: more of them, for this write alone."""
        self.n += 1
        path = f"{self.at}/{self.n}"
        self.lean(df, settings).write.option("compression", codec).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        self.paths.append(path)
        return out

    def drop(self, *dfs: DataFrame | None) -> None:
        """Remove tables that nothing reads any more."""
        for path in {getattr(df, "scratch_path", None) for df in dfs if df is not None} - {None}:
            remove(self.spark.sparkContext, path)
            if path in self.paths:
                self.paths.remove(path)

    def drop_all_but(self, *dfs: DataFrame | None) -> None:
        """Remove all tables that were cut here but those given, which a result still reads."""
        kept = {getattr(df, "scratch_path", None) for df in dfs if df is not None}
        for path in [p for p in self.paths if p not in kept]:
            remove(self.spark.sparkContext, path)
            self.paths.remove(path)
