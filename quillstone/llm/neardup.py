"""Near-duplicate documents by HyperMinHash registers, confirmed on full shingle sets.

1. Each text's set of 5-word shingles is hashed. Bucket ``h >> 56`` keeps its least hash, as the count of leading zeros of the rest
   and ten bits after the first one: 256 registers of two bytes. Texts of equal sets become one class before anything is compared.
2. Bands of registers are keys, as wide as the threshold allows: at 0.85 42 bands of six, at 0.8 51 bands of five. Two sets that just reach
   it share no band once in 400 million (600 million) cases; sets that have fewer shingles than buckets share more, as empty registers agree.
3. A band's documents are each paired with the band's first one (a star, never all pairs). Registers give a collision-corrected estimate, which
   drops pairs far below the threshold; the others are confirmed on the full sets of both.
4. Links are joined to components. A band is open for its documents past the centre if those lie in several components. Open bands are all
   in which the star can have missed a partner, and a partner at the threshold shares more than ``spare_bands`` bands but once in a million
   cases; so a document with no more open bands than that is settled. So is one with more bands that are done than a partner can differ in. All others (texts
   that are mostly a passage many share) go through an exact join on their rarest shingles, in blocks.

A link is lost if two texts share no band (``MISSED``), if both are settled and share open bands only (``UNSEEN``), or if an estimate is off
by ``SLACK`` standard errors: less than once in half a million links, whatever the corpus looks like, as all three hang on hash values alone.

Nulls: a null or blank text has no shingles and is linked with nothing. A row without doc_id is linked with nothing, has no component
and is kept. Rows that repeat a doc_id are one document. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, free_name, maybe_broadcast, own_columns
from .words import U, hashed, mix, shingles, slices

BUCKETS, MANTISSA = 256, 10
#: Two sets at the threshold share no band at most this often, and no more bands than spare_bands() at most that often.
MISSED, UNSEEN = 1e-8, 1e-6
#: Sets of fewer shingles are settled by the exact bound only: their bands hold too few buckets for the chance above.
SPARE_SHINGLES = 64
#: Shingles and documents of one block, where blocks are compared.
BLOCK_SHINGLES, BLOCK_DOCS = 250_000, 2000
#: Pairs whose estimate lies this many standard errors below the threshold are not looked at again.
SLACK = 5.0
WORDS = 5
_BLOCKS = 1 << 24


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """(sets x 256) registers of sorted hash sets: 0 where empty, else 1 + (leading zeros << 10 | next ten bits)."""
    out = np.zeros((len(sets), BUCKETS), np.uint16)
    sizes = np.array([len(s) for s in sets], np.int64)
    if not sizes.sum():
        return out
    h = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), sizes)
    bucket = (h >> U(56)).astype(np.int64)
    cell = row * BUCKETS + bucket
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))  # sorted: the first is the least
    rest = ((h[first] << U(8)) >> U(12)).astype(np.int64)  # 52 of the 56 bits, so that a double holds them
    exponent = np.frexp(rest.astype(np.float64))[1]
    zeros = 52 - exponent
    below = np.where(exponent > 0, rest - (np.int64(1) << np.maximum(exponent - 1, 0)), 0)
    shift = exponent - 1 - MANTISSA
    part = np.where(shift >= 0, below >> np.maximum(shift, 0), below << np.maximum(-shift, 0))
    out.reshape(-1)[cell[first]] = (1 + (np.minimum(zeros, 62) << MANTISSA | part & (1 << MANTISSA) - 1)).astype(np.uint16)
    return out


def rows_per_band(percent: int) -> int:
    """Registers of a band: as many as leave a pair at the threshold without a shared band at most MISSED often."""
    return max((r for r in range(1, 17) if (1 - (percent / 100) ** r) ** (BUCKETS // r) <= MISSED), default=1)


def spare_bands(percent: int) -> int:
    """How many open bands settle a document all the same: a partner at the threshold shares no more than these at most UNSEEN often; -1: not even none do."""
    rows = rows_per_band(percent)
    n, p = BUCKETS // rows, (percent / 100) ** rows
    tail, k = 0.0, 0
    while k <= n and (tail := tail + comb(n, k) * p**k * (1 - p) ** (n - k)) <= UNSEEN:
        k += 1
    return k - 1


def bands(reg: np.ndarray, rows: int) -> np.ndarray:
    """(sets x bands) keys of so many registers each; 0 for a band whose registers are all empty. Registers left over only serve the estimate."""
    n = BUCKETS // rows
    parts = reg[:, : n * rows].reshape(len(reg), n, rows)
    key = np.arange(1, n + 1, dtype=U)[None, :] * U(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for lo in range(0, rows, 4):
            four = np.zeros((len(reg), n), U)
            for i in range(lo, min(lo + 4, rows)):
                four = four << U(16) | parts[:, :, i].astype(U)
            key = mix(key ^ four)
    return np.where(parts.any(axis=2), key | U(1), U(0))


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard similarity from registers (pairs x 256), less the share of buckets expected to agree by chance; and its standard error."""
    used = (a > 0) | (b > 0)
    m = np.maximum(used.sum(axis=1), 1)
    agree = ((a == b) & used).sum(axis=1)
    # Unlike least hashes x, y ~ Exp(n / 256) get one register if both zeros and mantissa agree: about the chance that they fall
    # in one of the 2**10 parts of an octave, times that of one octave (1/3 for like rates, less for unlike ones).
    lo, hi = np.minimum(na, nb), np.maximum(na, nb)
    chance = lo / np.maximum(hi, 1) / 3 / (1 << MANTISSA)
    j = np.clip((agree / m - chance) / (1 - chance), 0, 1)
    return j, np.sqrt(np.maximum(j * (1 - j), 1 / m) / m)


def _binary(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())


def sketches(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, set_id (16 bytes, equal for equal sets; null where empty), registers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id")
            for lo, hi, data, at in slices(b.column("text")):
                sets = list(shingles(hashed(data, at), WORDS))
                reg = registers(sets)
                with np.errstate(over="ignore"):
                    set_id = [np.array([len(s), *((mix(s ^ U(k)).sum(dtype=U)) for k in (1, 2))], U).tobytes() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()), pa.array(set_id, pa.binary()), _binary([r.tobytes() if len(s) else b"" for r, s in zip(reg, sets, strict=True)])],
                    ["doc_id", "n_shingles", "set_id", "registers"],
                )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_id binary, registers binary")


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), BUCKETS)


def keyed(sketch: DataFrame, percent: int) -> DataFrame:
    """(key, doc_id, n_shingles, n_bands) of every band of the sketches; n_bands: how many the set has."""
    rows = rows_per_band(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                keys = bands(_registers(b.column("registers")), rows)
                row, _ = np.nonzero(keys)
                n = pa.array((keys > 0).sum(axis=1)[row].astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(keys[keys > 0].view(np.int64)), *(b.column(c).take(pa.array(row)) for c in ("doc_id", "n_shingles")), n], ["key", "doc_id", "n_shingles", "n_bands"])

    return sketch.select("doc_id", "n_shingles", "registers").mapInArrow(run, "key long, doc_id long, n_shingles long, n_bands int")


def _sets(docs: DataFrame) -> DataFrame:
    """Per row: doc_id and its whole set, sorted, eight bytes a shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, at in slices(b.column("text")):
                sets = shingles(hashed(data, at), WORDS)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), _binary([s.tobytes() for s in sets])], ["doc_id", "shingles"])

    return docs.mapInArrow(run, "doc_id long, shingles binary")


def _likely(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b with registers and sizes) whose estimate doesn't rule out the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            if not len(x):
                continue
            ra, rb = _registers(x.column("ra")), _registers(x.column("rb"))
            na, nb = (x.column(c).to_numpy(zero_copy_only=False) for c in ("na", "nb"))
            j, error = estimate(ra, rb, na, nb)
            ok = (j + SLACK * error >= percent / 100) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
            yield pa.RecordBatch.from_arrays([x.column("a"), x.column("b")], ["a", "b"]).filter(pa.array(ok))

    return pairs.mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            ok = []
            for p, q in zip(x.column("sa"), x.column("sb"), strict=True):
                s, t = np.frombuffer(p.as_buffer(), U), np.frombuffer(q.as_buffer(), U)
                both = len(np.intersect1d(s, t, assume_unique=True))
                ok.append(100 * both >= percent * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([x.column("a"), x.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.mapInArrow(run, "a long, b long")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every node that has a link; root: the least node reachable.

    Each round every node takes its least neighbour, links are drawn between those, and links within a node go, until none is left.
    Nodes at least halve in each component, so rounds grow with the logarithm of a component's size.
    """
    links = scratch.cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    roots = scratch.cut(both.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node")))
    while not links.isEmpty():
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("v"), F.least("a", "b").alias("up"))
        up = scratch.cut(up)
        # a chain of parents shortens by two steps
        jump = up.join(up.select(F.col("v").alias("up"), F.col("up").alias("up2")), "up", "left").select("v", F.coalesce("up2", "up").alias("up"))
        jump = scratch.cut(jump)
        left = links.join(jump.select(F.col("v").alias("a"), F.col("up").alias("pa")), "a").join(jump.select(F.col("v").alias("b"), F.col("up").alias("pb")), "b")
        left = scratch.cut(left.where("pa <> pb").select(F.greatest("pa", "pb").alias("a"), F.least("pa", "pb").alias("b")).distinct())
        new = roots.join(jump.select(F.col("v").alias("root"), "up"), "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        new = scratch.cut(new)
        scratch.drop(links, roots, up, jump)
        links, roots = left, new
    return roots


def _alike(na: str, nb: str, percent: int) -> F.Column:
    """Whether sets of these sizes can reach the threshold."""
    return F.least(na, nb) * 100 >= F.greatest(na, nb) * percent


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept. Linked: 100 * intersection >= percent * union."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "neardup")
    rows = own_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = scratch.cut(sketches(rows))
    # classes of equal sets: only their first document goes on
    member = sketch.where("set_id IS NOT NULL AND doc_id IS NOT NULL")
    firsts = scratch.cut(member.groupBy("set_id").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("set_id", "first"))
    n_firsts = firsts.count()
    copies = scratch.cut(member.select("doc_id", "set_id").join(maybe_broadcast(firsts, n_firsts), "set_id").where("doc_id <> first").select(F.col("doc_id").alias("a"), F.col("first").alias("b")).distinct())
    # a document stands for each of its sets of which it is the first; it may have other texts that are copies
    alone = member.join(maybe_broadcast(firsts, n_firsts), "set_id", "left").where(F.coalesce("first", "doc_id") == F.col("doc_id")).select("doc_id", "n_shingles", "registers")
    key = keyed(alone, percent)
    shared = scratch.cut(key.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi"))
    # (key, doc) of bands with more than two documents, and their centre; of two, the pair is at hand
    centres = shared.where("n > 2").select("key", F.col("lo").alias("b"))
    crowd = scratch.cut(key.join(maybe_broadcast(centres, centres.count()), "key"))
    pairs = shared.where("n = 2").select(F.col("hi").alias("a"), F.col("lo").alias("b")).unionByName(crowd.where("doc_id <> b").select(F.col("doc_id").alias("a"), "b"))
    sizes = alone.select("doc_id", "n_shingles")
    n_alone = sizes.count()
    a, b = (maybe_broadcast(sizes.toDF(x, f"n{x}"), n_alone) for x in ("a", "b"))
    pairs = scratch.cut(pairs.distinct().join(a, "a").join(b, "b").where(_alike("na", "nb", percent)).select("a", "b").distinct())
    scratch.drop(shared)
    good = _verify(pairs, rows, alone, percent, scratch)
    scratch.drop(pairs)
    links = scratch.cut(copies.unionByName(good))
    scratch.drop(copies, good)
    roots = components(links, scratch)
    # what a band's centre has met is done; a band whose other documents lie in one component is done as well
    past = scratch.cut(_rooted(crowd.where("doc_id <> b"), roots))
    past = scratch.cut(_of_several(past, scratch))
    n = F.max("n_shingles")
    open_ = past.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_open"), n.alias("n"), F.min("n_shingles").alias("least"), F.min("n_bands").alias("n_bands"))
    by_chance = (F.col("n_open") <= spare_bands(percent)) & (F.col("least") >= SPARE_SHINGLES)
    by_bound = (F.col("n_bands") - F.col("n_open")) * percent > F.col("n") * (100 - percent)  # each shingle that differs changes one band
    short = scratch.cut(open_.where(~by_chance & ~by_bound).select("doc_id"))
    scratch.drop(crowd, past)
    n_short = short.count()
    if n_short:
        of_short = lambda df: df.join(maybe_broadcast(short, n_short), "doc_id", "left_semi")
        more = scratch.cut(_of_short(of_short(rows), of_short(alone), roots, percent, scratch))
        if not more.isEmpty():
            roots = components(links.unionByName(more), scratch)
    out = sketch.select("doc_id", "n_shingles").join(roots.select(F.col("node").alias("doc_id"), "root"), "doc_id", "left")
    component = F.coalesce("root", "doc_id")
    out = scratch.cut(out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")))
    scratch.drop_all_but(out)
    return out


def _rooted(crowd: DataFrame, roots: DataFrame) -> DataFrame:
    """crowd with the root of each document's component, itself if it has no link."""
    out = crowd.join(roots.select(F.col("node").alias("doc_id"), "root"), "doc_id", "left")
    return out.withColumn("root", F.coalesce("root", "doc_id"))


def _with(crowd: DataFrame, table: DataFrame, on: list[str], scratch: Scratch, how: str = "inner") -> DataFrame:
    """crowd joined with a table of a row per key: sent to all tasks if it is small enough, so that a key of many rows stays where its rows are."""
    table = scratch.cut(table)
    return crowd.join(maybe_broadcast(table, table.count()), on, how)


def _of_several(crowd: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of keys that hold more than one root."""
    several = crowd.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("key")
    return _with(crowd, several, ["key"], scratch, "left_semi")


def _occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, n, key) of every shingle of the texts' sets; n: how many the set has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id").to_numpy()
            for lo, hi, data, at in slices(b.column("text")):
                sets = list(shingles(hashed(data, at), WORDS))
                n = np.array([len(s) for s in sets], np.int64)
                key = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[lo:hi], n)), pa.array(np.repeat(n, n)), pa.array(key)], ["doc_id", "n", "key"])

    return docs.mapInArrow(run, "doc_id long, n long, key long")


def _rarest(rows: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(key, doc_id, n): of each set's n shingles, rarest first, those among the first n - ceil(n * percent / 100) + 1 that others have too.

    Two sets at the threshold share one of these. Shingles that one document alone has go no further than their count.
    """
    every = _occurrences(rows)
    often = scratch.cut(every.groupBy("key").agg(F.count(F.lit(1)).alias("f")).where("f > 1"))
    common = every.join(maybe_broadcast(often, often.count()), "key")
    by_rarity = Window.partitionBy("doc_id", "n").orderBy("f", "key")
    common = common.withColumns({"place": F.row_number().over(by_rarity), "held": F.count(F.lit(1)).over(Window.partitionBy("doc_id", "n"))})
    # the others come first, and take n - held places
    common = common.where(F.col("place") + F.col("n") - F.col("held") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)
    out = scratch.cut(common.select("key", "doc_id", "n"))
    scratch.drop(often)
    return out


def _of_short(rows: DataFrame, sketch: DataFrame, roots: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """All links between the given documents that join two components, found without bands. sketch: their registers.

    Documents that share a shingle of their rarest and lie in several components meet in blocks of about BLOCK_SHINGLES and at most some BLOCK_DOCS,
    by sizes, so that only blocks of sizes that can be alike meet; each pair of blocks is a task of its own. There the registers tell
    which documents may have a partner at all (documents, never pairs); only those meet again with their whole sets, by products of the blocks' incidence matrices.
    """
    rarest = _rarest(rows, percent, scratch)
    rooted = scratch.cut(_rooted(rarest, roots))
    several = scratch.cut(_of_several(rooted, scratch))
    scratch.drop(rarest, rooted)
    crowd = scratch.cut(_without_subsets(several, scratch))
    scratch.drop(several)
    # sets at the threshold lie in one size class or in two that adjoin
    crowd = crowd.withColumn("size", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent)) + 1e-9))
    blocks = crowd.groupBy("key", "size").agg(F.ceil(F.greatest(F.sum("n") / BLOCK_SHINGLES, F.count(F.lit(1)) / BLOCK_DOCS)).alias("blocks"))
    blocks = scratch.cut(blocks)
    crowd = _with(crowd, blocks, ["key", "size"], scratch).withColumn("block", F.col("size") * _BLOCKS + F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
    near = blocks.select("key", "size", F.col("blocks").alias("n_near"), F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1)).alias("of"))
    near = near.select("key", F.col("of").alias("size"), F.expr(f"transform(sequence(0, n_near - 1), x -> size * {_BLOCKS} + x)").alias("others"))
    crowd = _with(crowd, near, ["key", "size"], scratch).withColumn("other", F.explode("others"))
    crowd = scratch.cut(crowd.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "doc_id", "n", "root"))
    sides = lambda x: (np.flatnonzero(x["block"].to_numpy() == x[k].iat[0]) for k in ("i", "j"))

    def promising(x):  # noqa: ANN001, ANN202  a pandas frame of one pair of blocks
        reg = np.frombuffer(b"".join(x["registers"]), np.uint16).reshape(len(x), BUCKETS)
        n, root = x["n"].to_numpy(), x["root"].to_numpy()
        left, right = sides(x)
        good = np.zeros(len(x), bool)
        for a in left:
            b = right[(root[right] != root[a]) & (100 * np.minimum(n[right], n[a]) >= percent * np.maximum(n[right], n[a]))]
            j, error = estimate(reg[a][None], reg[b], n[a], n[b])
            b = b[j + SLACK * error >= percent / 100]
            good[b] = True
            good[a] |= len(b) > 0
        return x.loc[good, ["key", "i", "j", "block", "doc_id", "root"]]

    kept = crowd.join(sketch.select("doc_id", F.col("n_shingles").alias("n"), "registers"), ["doc_id", "n"]).groupBy("key", "i", "j").applyInPandas(promising, "key long, i long, j long, block long, doc_id long, root long")
    kept = scratch.cut(kept)
    scratch.drop(crowd)
    ids = kept.select("doc_id").distinct()
    sets = scratch.cut(_sets(rows.join(maybe_broadcast(ids, ids.count()), "doc_id", "left_semi")).distinct())

    def compare(x):  # noqa: ANN001, ANN202  a pandas frame of one pair of blocks
        import pandas as pd

        found = [np.frombuffer(s, U) for s in x["shingles"]]
        n = np.array([len(s) for s in found])
        _, column, times = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(found)), n)
        column, row = column[times[column] > 1], row[times[column] > 1]
        order = np.argsort(column, kind="stable")
        column, row = np.unique(column[order], return_inverse=True)[1], row[order]
        left, right = sides(x)
        both = np.zeros((len(left), len(right)), np.float32)
        top = int(column[-1]) + 1 if len(column) else 0
        wide = max(64, min(4096, (1 << 21) // len(found)))
        for at in range(0, top, wide):
            lo, hi = np.searchsorted(column, [at, at + wide])
            m = np.zeros((len(found), wide), np.float32)
            m[row[lo:hi], column[lo:hi] - at] = 1
            both += m[left] @ m[right].T
        root, ids = x["root"].to_numpy(), x["doc_id"].to_numpy()
        # counts below 2**24 are exact in single precision, and so is the sum of two sizes less them in double precision
        a, b = np.nonzero((100.0 + percent) * both >= percent * (n[left][:, None] + n[right][None, :]).astype(np.float64))
        apart = root[left][a] != root[right][b]
        a, b = ids[left[a[apart]]], ids[right[b[apart]]]
        return pd.DataFrame({"a": np.maximum(a, b), "b": np.minimum(a, b)})

    met = kept.join(sets, "doc_id").groupBy("key", "i", "j").applyInPandas(compare, "a long, b long")
    return met.where("a <> b").distinct()


def _without_subsets(crowd: DataFrame, scratch: Scratch) -> DataFrame:
    """crowd without keys all of whose documents hold one and the same larger key, which compares them anyway.

    A passage's rarest shingle is in all texts that begin their prefix with the passage; its other shingles are in some of those.
    """
    n = crowd.groupBy("key").agg(F.count(F.lit(1)).alias("f"))
    largest = _with(crowd, n, ["key"], scratch).groupBy("doc_id").agg(F.max(F.struct("f", "key")).alias("m")).select("doc_id", F.col("m.key").alias("largest"))
    by_key = _with(crowd, largest, ["doc_id"], scratch).groupBy("key").agg(F.min("largest").alias("lo"), F.max("largest").alias("hi"))
    return _with(crowd, by_key.where("lo <> hi OR lo = key").select("key"), ["key"], scratch, "left_semi")


def _verify(pairs: DataFrame, rows: DataFrame, alone: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) that are links: by estimate first, then by their whole sets."""
    side = alone.select("doc_id", F.col("n_shingles").alias("n"), F.col("registers").alias("r"))
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    side = side.join(maybe_broadcast(ids, 2 * pairs.count()), "doc_id", "left_semi")
    met = pairs.join(side.toDF("a", "na", "ra"), "a").join(side.toDF("b", "nb", "rb"), "b")
    likely = scratch.cut(_likely(met, percent).distinct())
    ids = likely.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = scratch.cut(_sets(rows.join(maybe_broadcast(ids, 2 * likely.count()), "doc_id", "left_semi")).distinct())
    met = likely.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    good = scratch.cut(_confirmed(met, percent).distinct())
    scratch.drop(likely, sets)
    return good


def without_near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The rows of docs that near_duplicates keeps, with all their columns."""
    scratch = Scratch(docs.sparkSession, "without-near")
    name = free_name(docs, "_gone")
    found = near_duplicates(docs, percent)
    gone = scratch.cut(found.where("NOT kept").select(F.col("doc_id").alias(name)).distinct())
    scratch.drop(found)
    return docs.join(maybe_broadcast(gone, gone.count()), docs["doc_id"].cast("long") == gone[name], "left_anti")
