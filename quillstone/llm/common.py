"""What the operators share: scratch tables, hot-key joins and distributed ranks."""

from __future__ import annotations

import contextlib
import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..scratch import Scratch  # noqa: F401  the operators' scratch tables

#: Rows that a broadcast may have, and bytes (16 a number, 32 anything else); beyond them a shuffled join does the same.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 1 << 24
#: Groups that ranked() treats as hot at most, so that their table may be broadcast.
HOT_GROUPS = 4096
LAST_ID = 2**63 - 1


def lean(run):  # noqa: ANN001, ANN201
    """run, after which its worker gives what it freed back to the system; for tasks that hold much at once."""

    def inner(*args):  # noqa: ANN002, ANN202
        try:
            yield from run(*args)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # not a GNU C library
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return inner


def maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table of a counted size and narrow columns; larger ones are left to a shuffled join."""
    width = sum(16 if isinstance(f.dataType, T.NumericType) else 32 for f in df.schema)
    return F.broadcast(df) if rows <= BROADCAST_ROWS and rows * width <= BROADCAST_BYTES else df.hint("merge")


def named(df: DataFrame, name: str) -> Column:
    """A column by its plain name, dots and all; null if df has none of that name."""
    return F.col("`" + name.replace("`", "``") + "`") if name in df.columns else F.lit(None).cast("string")


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that further ones of any name can't clash; missing ones are null."""
    return df.select(*[named(df, n).alias(n) for n in names])


def only(df: DataFrame, names: list[str]) -> DataFrame:
    """These columns of df, whatever characters their names hold."""
    return df.select(*[named(df, n) for n in names])


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def as_key(col: Column) -> Column:
    """A document's id, null as the largest number, so that nulls come last and joins keep them."""
    return F.coalesce(col.cast("long"), F.lit(LAST_ID))


def from_key(col: Column) -> Column:
    return F.when(col != LAST_ID, col)


def order_hash(*cols: Column | str, seed: int = 0) -> Column:
    """31 bits that put rows in a seeded order."""
    return F.xxhash64(F.lit(seed), *cols).bitwiseAND(F.lit(0x7FFFFFFF))


def ranked(df: DataFrame, group: str, keys: list[str], seed: int = 0, weight: str | None = None, rows_per_bucket: int = 5_000) -> DataFrame:
    """Adds rank (from 0, gapless within group) and, given weight, before (weights of lower ranks in the group).

    df should be a written table, as it is read several times. Rows stand in a seeded order of their keys. Groups of more than
    rows_per_bucket rows are split into runs of that order, ranked apart and shifted by the runs before, so no group lands in one
    task whole. At most HOT_GROUPS groups are split, whatever the input's size; only those and their runs are broadcast.
    """
    total = df.count()
    limit = max(rows_per_bucket, -(-total // HOT_GROUPS))
    df = df.withColumn("_h", order_hash(*keys, seed=seed))
    sums = [F.count(F.lit(1)).alias("_n"), F.sum(F.col(weight) if weight else F.lit(0)).alias("_w")]
    hot = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    hot = hot.select(F.col(group).alias("_g"), F.ceil(F.col("_n") / limit).cast("long").alias("_runs"))
    df = df.join(F.broadcast(hot), df[group].eqNullSafe(F.col("_g")), "left").drop("_g")
    df = df.withColumn("_run", F.coalesce(F.shiftright(F.col("_h") * F.col("_runs"), 31), F.lit(0).cast("long")))
    runs = df.where(F.col("_runs").isNotNull()).groupBy(group, "_run").agg(*sums)
    before = Window.partitionBy(group).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col(group).alias("_g"), F.col("_run").alias("_r"), F.sum("_n").over(before).alias("_n0"), F.sum("_w").over(before).alias("_w0"))
    df = df.join(F.broadcast(runs), df[group].eqNullSafe(F.col("_g")) & (df["_run"] == F.col("_r")), "left")
    within = Window.partitionBy(group, "_run").orderBy("_h", *keys)
    out = df.withColumn("rank", F.coalesce("_n0", F.lit(0)) + F.row_number().over(within) - 1)
    if weight:
        lower = within.rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn("before", F.coalesce("_w0", F.lit(0)) + F.coalesce(F.sum(weight).over(lower), F.lit(0)))
    return out.drop("_h", "_runs", "_run", "_g", "_r", "_n0", "_w0")


def running(df: DataFrame, group: str, place: str, weight: str, places: int, rows_per_bucket: int = 5_000) -> DataFrame:
    """Adds before: the weights of lower places in the group. Places are numbers below ``places`` that don't repeat in a group, gaps allowed.

    df should be a written table. A group is summed in runs of places, so none lands in one task whole.
    """
    width = max(rows_per_bucket, -(-places // HOT_GROUPS))
    df = df.withColumn("_run", F.floor(F.col(place) / width).cast("long"))
    runs = df.groupBy(F.col(group).alias("_g"), F.col("_run").alias("_r")).agg(F.sum(weight).alias("_w"))
    lower = Window.partitionBy("_g").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_g", "_r", F.sum("_w").over(lower).alias("_w0")).where("_w0 IS NOT NULL")
    df = df.join(runs, df[group].eqNullSafe(F.col("_g")) & (F.col("_run") == F.col("_r")), "left")
    within = Window.partitionBy(group, "_run").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("before", F.coalesce("_w0", F.lit(0)) + F.coalesce(F.sum(weight).over(within), F.lit(0))).drop("_run", "_g", "_r", "_w0")
