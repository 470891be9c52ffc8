"""Tables as files of bounded size in a total order, with a list that says what each file holds.

Rows are dealt by ranges of their order and sorted within each, and a file ends at a number of rows. The list has a file's first and last row's keys and its rows, so a reader takes the files one
after another and has the sorted table, or opens just those that can hold what it looks for.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ROWS = 100_000


def _key(order: list[str]) -> Column:
    return F.struct(*order)


def write_ordered(rows: DataFrame, path: str, order: list[str], rows_per_file: int = ROWS) -> DataFrame:
    """Writes path/rows and path/files; returns the list of files. Nulls come first. Rows with the same keys may lie in two files, in either order."""
    n = max(1, -(-rows.count() // rows_per_file))
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/rows")
    stored = rows.sparkSession.read.schema(rows.schema).parquet(f"{path}/rows")
    bounds = stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows"), F.min(_key(order)).alias("first"), F.max(_key(order)).alias("last"))
    bounds.coalesce(1).write.mode("overwrite").parquet(f"{path}/files")  # a row per file
    return list_of(rows.sparkSession, path)


def list_of(spark: SparkSession, path: str) -> DataFrame:
    """file, rows, first, last, place (from 0, in the table's order) and before (rows of earlier files)."""
    files = spark.read.parquet(f"{path}/files")
    order = Window.orderBy("first", "last", "file")  # a row per file of ROWS rows
    return files.select("*", (F.row_number().over(order) - 1).alias("place"), F.coalesce(F.sum("rows").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))


def positions(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows with their position in the sorted table: their place in their file, after the rows of earlier files."""
    stored = spark.read.parquet(f"{path}/rows").select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    return stored.join(list_of(spark, path).select(F.col("file").alias("_file"), "before"), "_file").withColumn("position", F.col("before") + F.col("_at")).drop("_file", "_at", "before")


def in_order(spark: SparkSession, path: str) -> Iterator[DataFrame]:
    """The files as tables, one after another: together the sorted table."""
    for r in list_of(spark, path).orderBy("place").toLocalIterator():
        yield spark.read.parquet(f"{path}/rows/{r['file']}")


def between(spark: SparkSession, path: str, low: tuple, high: tuple) -> DataFrame:
    """Rows whose keys lie between two (both included), from only the files whose bounds meet them."""
    files = list_of(spark, path)
    names = files.schema["first"].dataType.names
    edge = lambda values: F.struct(*[F.lit(v).alias(c) for c, v in zip(names, values, strict=True)])
    found = [r["file"] for r in files.where((F.col("last") >= edge(low)) & (F.col("first") <= edge(high))).orderBy("place").collect()]
    rows = spark.read.parquet(*[f"{path}/rows/{f}" for f in found]) if found else spark.read.parquet(f"{path}/rows").where("false")
    return rows.where((_key(names) >= edge(low)) & (_key(names) <= edge(high)))
