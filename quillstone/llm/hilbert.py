"""Sharding along a Hilbert curve over several metadata columns, with DataFrame functions only.

Each column is cut into 2**bits ranges at its own quantiles (strings by their bytes, as many as it takes; null in the first range). The
ranges of a row are a cell; cells are few by construction (2**(bits * columns)), so the curve's index is computed per cell, not per row.
Rows in the order (curve index, seeded hash, doc_id) are cut into runs of counts at most one apart. A run covers few ranges of every
column, so a filter on any of them skips most files; ``file_ranges`` gives each shard's least and greatest values.

Nulls: a null text counts as empty (size 1), null metadata go to the first range. Equal rows are interchangeable. An empty table gives an
empty result; columns beyond the named ones are ignored, or kept by ``assign`` under their own names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import Scratch, own_columns, ranked

DIMENSIONS = ("source", "lang", "n_chars")
BITS = 4
SHARDS = 8
#: Times six bytes by which strings are told apart at most.
LEVELS = 16


def _turn(n: int, q: int, i: int) -> Callable[[Column], Column]:
    """Exchange or invert the lower bits of the first coordinate, as bit q of coordinate i says."""

    def turn(v: Column) -> Column:
        low = F.lit(q - 1)
        flip = v[i].bitwiseAND(F.lit(q)) != 0
        t = v[0].bitwiseXOR(v[i]).bitwiseAND(low)
        first = F.when(flip, v[0].bitwiseXOR(low)).otherwise(v[0].bitwiseXOR(t))
        mine = F.when(flip, v[i]).otherwise(v[i].bitwiseXOR(t))
        return F.array(*[first if k == 0 else mine if k == i else v[k] for k in range(n)])

    return turn


def hilbert_index(axes: list[Column], bits: int) -> Column:
    """The place on the curve of a point with the given coordinates (0 to 2**bits - 1), after Skilling's transform."""
    n = len(axes)
    x: Column = F.array(*[a.cast("long") for a in axes])
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        for i in range(n):
            x = F.transform(F.array(x), _turn(n, q, i))[0]
    gray = F.aggregate(x, F.array(F.lit(0).cast("long")), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1).bitwiseXOR(v))))
    gray = F.slice(gray, 2, n)

    def finish(v: Column) -> Column:
        last = v[n - 1]
        t = reduce(lambda a, b: a.bitwiseXOR(b), [F.when(last.bitwiseAND(F.lit(1 << k)) != 0, F.lit((1 << k) - 1).cast("long")).otherwise(F.lit(0).cast("long")) for k in range(1, bits)], F.lit(0).cast("long"))
        done = [v[k].bitwiseXOR(t) for k in range(n)]
        parts = [F.shiftleft(F.shiftright(done[k], b).bitwiseAND(F.lit(1)), b * n + n - 1 - k) for b in range(bits) for k in range(n)]
        return reduce(lambda a, c: a + c, parts)

    return F.transform(F.array(gray), finish)[0]


def _six(c: str, at: int) -> Column:
    """Six bytes of a string from a place on, as a number that a double holds; zeros past its end."""
    return F.conv(F.rpad(F.hex(F.substring(F.encode(c, "utf-8"), at + 1, 6)), 12, "0"), 16, 10).cast("long")


def _cuts(rows: DataFrame, c: str, n: int) -> list[Column]:
    """n conditions or fewer, each of which splits rows in two by the order of column c, together at its quantiles.

    Strings are cut by six bytes after what all of them begin with; where several cuts fall on the same bytes, by the next six within those, and so on.
    """
    parts = lambda m: [i / (m + 1) for i in range(1, m + 1)]
    if not isinstance(rows.schema[c].dataType, T.StringType):
        cuts = rows.agg(F.percentile_approx(F.col(c).cast("double"), parts(n), 10_000)).first()[0]
        return [F.col(c).cast("double") >= x for x in sorted(set(cuts or []))]
    ends = rows.agg(F.min(F.encode(c, "utf-8")), F.max(F.encode(c, "utf-8"))).first()
    low, high = (bytes(x or b"") for x in ends)
    start = next((i for i, (x, y) in enumerate(zip(low, high, strict=False)) if x != y), min(len(low), len(high)))
    found, todo, level = [], {(): n}, 0
    while todo and start + 6 * level < max(len(low), len(high), 6 * LEVELS) and level < LEVELS:
        within = lambda prefix: reduce(lambda x, y: x & y, [_six(c, start + 6 * i) == v for i, v in enumerate(prefix)], F.col(c).isNotNull())
        got = rows.agg(*[F.percentile_approx(F.when(within(p), _six(c, start + 6 * level)), parts(m), 10_000) for p, m in todo.items()]).first()
        more = {}
        for (prefix, _), values in zip(todo.items(), got, strict=True):
            for v in sorted(set(values or [])):
                found.append((*prefix, v))
                if (values or []).count(v) > 1:
                    more[(*prefix, v)] = values.count(v) - 1
        todo, level = more, level + 1
    at_least = lambda cut: F.struct(*[_six(c, start + 6 * i) for i in range(len(cut))]) >= F.struct(*[F.lit(v) for v in cut])
    return [at_least(cut) for cut in sorted(set(found))]


def assign(docs: DataFrame, dims: tuple[str, ...] = DIMENSIONS, shards: int = SHARDS, bits: int = BITS, seed: int = 0) -> DataFrame:
    """Per row doc_id, size, text_crc32, the dimensions, curve (index of its cell), shard and slot (gapless from 0 within the shard)."""
    scratch = Scratch(docs.sparkSession, "hilbert")
    rows = own_columns(docs, "doc_id", "text", *dims)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), *dims)
    rows = scratch.cut(rows)
    cells = {f"_q{i}": sum((F.coalesce(c.cast("int"), F.lit(0)) for c in _cuts(rows, d, (1 << bits) - 1)), F.lit(0)) for i, d in enumerate(dims)}
    rows = rows.withColumns(cells)
    axes = [F.col(f"_q{i}") for i in range(len(dims))]
    cells = rows.groupBy(*[f"_q{i}" for i in range(len(dims))]).agg(F.count(F.lit(1)).alias("_n"))
    cells = scratch.cut(cells.withColumn("curve", hilbert_index(axes, bits)))  # at most 2**(bits * dimensions) rows
    lower = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    places = cells.select("curve", F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_start"), F.sum("_n").over(Window.partitionBy()).alias("_total"))
    rows = rows.join(F.broadcast(cells.drop("_n")), [f"_q{i}" for i in range(len(dims))])
    rows = scratch.cut(rows.select("doc_id", "size", "text_crc32", *dims, "curve"))
    rows = ranked(rows, "curve", ["doc_id", "size", "text_crc32"], seed=seed)
    rows = rows.join(F.broadcast(places), "curve").withColumn("_at", F.col("_start") + F.col("rank"))
    rows = rows.withColumn("shard", F.expr(f"int((_at * {shards}) div _total)"))
    first = F.expr(f"(shard * _total + {shards - 1}) div {shards}")
    return rows.select("doc_id", "size", "text_crc32", *dims, "curve", "shard", (F.col("_at") - first).cast("long").alias("slot"))


def file_ranges(assigned: DataFrame, dims: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """Per shard: rows, and the least and greatest value of each dimension, by which a reader skips shards."""
    return assigned.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), *[f(c).alias(f"{k}_{c}") for c in dims for k, f in (("min", F.min), ("max", F.max))])


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder per shard, its rows in slot order; a shard's rows go through one task, as they make one file."""
    assigned.repartition(F.col("shard")).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
