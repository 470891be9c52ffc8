"""Mixing sources to target weights by capped water-filling, with DataFrame functions only.

Sources by code point, null last, have the weights 1, 2, 3, repeating, and share the corpus's words in their proportion; no source
gets more than ``epochs`` times its own words. What a cap cuts off goes to the others in proportion to their weights, until none is above its
cap. The end of those rounds is a water level: sources in the order cap / weight are capped as long as the level that the rest would
have lies at or above theirs; so one pass over the sorted sources finds it.

A source's target is whole repetitions of all its documents plus a fraction, for which documents in a seeded order are taken up to the first
that doesn't fit. Of the others, those of at most half of what is missing are put in order and taken in the same way, until none is left: each
time at least half of what was missing is filled, or all of them are taken. The document that comes nearest to the rest is the last. So a
source is off its target by no more than the smallest document that was left for that last step. Documents without words are taken in whole repetitions only.

What a round takes follows from two values of its source: the most words a document may have, and the last place in the seeded order. So
``mixed_documents`` moves no text: each row decides for itself by its source's rounds, a few dozen at most.

Nulls: a null text has size 0; documents of the null source make a source of their own, last in order. Rows that repeat an id are separate rows. Rows
that are alike in id, text and source are taken as often together as the mix says; where it takes some of them once more, one stands for all.
An empty table gives an empty result. Only doc_id, text and source are read, so other columns can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, as_key, free_name, maybe_broadcast, named, only, order_hash, own_columns, ranked, running

EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = 17
_ROUNDS = "array<struct<most:bigint,rank:bigint,place:struct<h:bigint,id:bigint,print:bigint>>>"


def targets(sizes: DataFrame, epochs: int = EPOCHS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """sizes: a row (source, source_size) per source. Adds weight and target.

    The windows run over one row per source, not over documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * epochs)
    rising = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing)
    rows = rows.withColumns({"total": F.sum("source_size").over(Window.partitionBy()), "capped": F.coalesce(F.sum("cap").over(before), F.lit(0)), "open": F.sum("weight").over(onward)})
    # this source, and with it all later ones, is uncapped if the level over them keeps below its cap
    rows = rows.withColumn("level", (F.col("total") - F.col("capped")) / F.col("open"))
    rows = rows.withColumn("is_open", F.col("level") * F.col("weight") <= F.col("cap"))
    level = F.min(F.when(F.col("is_open"), F.struct(F.col("capped"), F.col("open")))).over(Window.partitionBy())
    rows = rows.withColumn("at", level)
    target = (F.col("total") - F.col("at.capped")) * F.col("weight") / F.col("at.open")
    return rows.select("source", "source_size", "weight", F.least(F.coalesce(target, F.col("cap").cast("double")), F.col("cap").cast("double")).alias("target"))


def _size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _print(doc_id: Column, text: Column) -> Column:
    """Tells rows of one id apart, and a missing id from the number that stands for it."""
    return F.xxhash64(F.isnull(doc_id), text.cast("string"))


def _place(id_: Column, print_: Column, seed: int) -> Column:
    """A row's place in the seeded order that ranked() gives it. Rows alike in id and text have the same."""
    return F.struct(order_hash(id_, print_, seed=seed).alias("h"), id_.alias("id"), print_.alias("print"))


def _beside(df: DataFrame, of: DataFrame, n_sources: int) -> DataFrame:
    """df with the columns of its source's row."""
    return df.join(maybe_broadcast(of.withColumnRenamed("source", "_s"), n_sources), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")


def _plan(docs: DataFrame, epochs: int, weights: tuple[int, ...], seed: int, scratch: Scratch) -> tuple[DataFrame, DataFrame, int]:
    """(rows with more, sources with whole, rounds and near, number of sources), both written tables.

    more: whether the fraction takes the row. rounds: array of (most, rank, place): rows of at most so many words, up to that rank or place, are
    taken. near: the place of the last row taken.
    """
    rows = own_columns(docs, "doc_id", "text", "source")
    rows = scratch.cut(rows.select(F.col("doc_id").cast("long").alias("doc_id"), "source", _size(F.col("text")).alias("size"), as_key(F.col("doc_id")).alias("id"), _print(F.col("doc_id"), F.col("text")).alias("print")))
    found = scratch.cut(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), epochs, weights))
    n_sources = found.count()
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    found = found.withColumn("whole", whole).withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))
    out = _beside(ranked(rows, "source", ["id", "print"], seed=seed, weight="size"), found.select("source", "source_size", "target", "whole", "part"), n_sources)
    first = (F.col("before") + F.col("size") <= F.col("part")) & (F.col("size") > 0)
    out = scratch.cut(out.withColumn("first", first).drop("before"))
    scratch.drop(rows)
    place = _place(F.col("id"), F.col("print"), seed)
    # a row per source: what is short, and the rounds so far, each with the most words of a row, the last rank and the last place
    def fits(of: Column, most: Column) -> list[Column]:
        end = F.max(F.when(of, F.struct(F.col("rank"), place.alias("place"))))
        return [end.alias("end"), most.alias("most"), F.coalesce(F.sum(F.when(of, F.col("size"))), F.lit(0)).alias("taken")]

    state = out.groupBy("source").agg(*fits(F.col("first"), F.lit(2**62)), F.max("part").alias("part"), F.max("rank").alias("ranks"))
    one = F.struct("most", F.col("end.rank").alias("rank"), F.col("end.place").alias("place"))
    state = scratch.cut(state.select("source", (F.col("part") - F.col("taken")).alias("short"), F.when(F.col("end").isNotNull(), F.array(one)).otherwise(F.array().cast(_ROUNDS)).alias("rounds"), "ranks"))
    ranks = (state.agg(F.max("ranks")).first()[0] or 0) + 1
    left = out.where("NOT first AND size > 0").select("source", "rank", "size", "id", "print")
    while True:
        # rows past half of what is short now are past it in all later rounds too
        left = _beside(left, state.select("source", "short"), n_sources).where("2 * size <= short")
        left = scratch.cut(left)
        if left.isEmpty():
            break
        took = scratch.cut(running(left, "source", "rank", "size", ranks).withColumn("took", F.col("before") + F.col("size") <= F.col("short")))
        done = took.groupBy("source").agg(*fits(F.col("took"), F.floor(F.max("short") / 2).cast("long")))
        state_ = _beside(state, done, n_sources).select("source", (F.col("short") - F.coalesce("taken", F.lit(0))).alias("short"), F.when(F.col("end").isNotNull(), F.concat("rounds", F.array(one))).otherwise(F.col("rounds")).alias("rounds"))
        state_ = scratch.cut(state_)
        scratch.drop(state)
        state, left = state_, took.where("NOT took").select("source", "rank", "size", "id", "print")
    by_rounds = F.exists("rounds", lambda r: (F.col("size") <= r["most"]) & (F.col("rank") <= r["rank"]))
    filled = _beside(out, state.select("source", "short", "rounds"), n_sources).withColumn("more", (F.col("size") > 0) & by_rounds)
    filled = scratch.cut(filled.drop("first", "rounds"))
    near = F.min(F.struct(F.abs(F.col("short") - F.col("size")).alias("off"), "rank", place.alias("place")))
    near = filled.where("NOT more AND size > 0 AND abs(short - size) < short").groupBy("source").agg(near.alias("n")).select("source", F.col("n.rank").alias("one"), F.col("n.place").alias("near"))
    plan = scratch.cut(_beside(_beside(found.select("source", "whole"), state.select("source", "rounds"), n_sources), near, n_sources))
    filled = _beside(filled, plan.select("source", "one"), n_sources).withColumn("more", F.col("more") | F.coalesce(F.col("rank") == F.col("one"), F.lit(False)))
    filled = scratch.cut(filled.drop("one", "short"))
    scratch.drop_all_but(filled, plan)
    return filled, plan, n_sources


def mix(docs: DataFrame, epochs: int = EPOCHS, weights: tuple[int, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, repeats (how often the row is taken) and taken (words)."""
    out, _, _ = _plan(docs, epochs, weights, seed, Scratch(docs.sparkSession, "mixing"))
    out = out.withColumn("repeats", (F.col("whole") + F.col("more").cast("long")).cast("long"))
    return out.select("doc_id", "source", "size", "source_size", "target", "repeats", (F.col("repeats") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, epochs: int = EPOCHS, weights: tuple[int, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """The rows of docs, each as often as the mix takes it."""
    scratch = Scratch(docs.sparkSession, "mixed")
    taken, plan, n_sources = _plan(docs, epochs, weights, seed, scratch)
    source, size, place, s, times, again = (free_name(docs, x) for x in ("_source", "_size", "_place", "_s", "_times", "_again"))
    # rows alike of which the fraction takes some: the place alone doesn't tell which
    alike = taken.where("size > 0").groupBy("source", "id", "print").agg(F.count_if("more").alias("m"), F.count(F.lit(1)).alias("n")).where("0 < m AND m < n")
    alike = scratch.cut(alike.select("source", "m", _place(F.col("id"), F.col("print"), seed).alias("place")))  # one a round and source at most
    scratch.drop(taken)
    split = alike.groupBy("source").agg(F.collect_list("place").alias("split"))
    plan = _beside(plan, split, n_sources).select(F.col("source").alias(s), F.struct("whole", "rounds", "near", "split").alias(times))
    rows = docs.withColumns({source: named(docs, "source"), size: _size(named(docs, "text")), place: _place(as_key(named(docs, "doc_id")), _print(named(docs, "doc_id"), named(docs, "text")), seed)})
    rows = rows.join(maybe_broadcast(plan, n_sources), F.col(source).eqNullSafe(F.col(s)))
    p = lambda k: F.col(times)[k]
    in_round = F.exists(p("rounds"), lambda r: (F.col(size) <= r["most"]) & (F.col(place) <= r["place"]))
    more = (F.col(size) > 0) & (F.coalesce(in_round, F.lit(False)) | F.col(place).eqNullSafe(p("near"))) & ~F.coalesce(F.array_contains(p("split"), F.col(place)), F.lit(False))
    out = rows.withColumn(again, p("whole").cast("int") + more.cast("int")).where(F.col(again) > 0)
    out = only(out.withColumn(again, F.explode(F.sequence(F.lit(1), F.col(again)))), docs.columns)
    if alike.isEmpty():
        return out
    one = rows.join(F.broadcast(alike.select(F.col("source").alias(again), "m", F.col("place").alias("at"))), F.col(source).eqNullSafe(F.col(again)) & (F.col(place) == F.col("at")))
    one = one.groupBy(F.col(source), F.col(place), F.col("m")).agg(F.any_value(F.struct(*[named(docs, c).alias(f"c{i}") for i, c in enumerate(docs.columns)])).alias("row"))
    one = one.withColumn(again, F.explode(F.sequence(F.lit(1), F.col("m").cast("int")))).select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
    return out.unionByName(one)
