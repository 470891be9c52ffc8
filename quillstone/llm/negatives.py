"""Hard negatives: for an anchor and each of its nearest rows of the same label, the nearest rows of other labels that are somewhat less like it.

Likeness is the inner product of whole-number vectors. A row x of the table gets one more component, the root of M - |x|^2 (M: the largest squared norm), an anchor q a 0 there; so
|q - x|^2 = |q|^2 + M - 2 qx, and the nearest by Euclidean distance have the largest inner product. The pivot table stores every row's distances to ``PIVOTS`` rows,
which are drawn from a bounded sample, each the farthest from those before. By the triangle inequality distances to a pivot bracket the distance of an anchor and a row, and so their
score. Rows lie in bins by their nearest pivot and their distance to it; a bin's least and largest pivot distances bracket all its scores.

An anchor first meets its own bin, which gives it a bound, and then just those bins whose bracket reaches the bound. Within a bin the rows' brackets pick the survivors, whose
scores are computed exactly. That is done once for positives (the k-th best score so far is the bound) and once for negatives (the band below each positive, and the
best few found in it). Bins are met in blocks of rows by blocks of anchors, so no task holds a whole bin, whatever its size. Nothing is approximate: brackets are widened
by more than rounding can move them.

Nulls: rows with a null id, label or vector, or with a component that is null or not finite, take no part; nor do vectors of another length than most, or with components so
large that a score could leave the range of a 64-bit number. A vec_id names one row: of rows that repeat it, the first by label and vector counts. Equal vectors
stand in the order of their ids. An empty table, or one without pairs, gives an empty result. Only vec_id, embedding and label are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .ann import _stack
from .common import Scratch

SCALE, POSITIVES, NEGATIVES = 256, 5, 3
#: Percent of a positive's score that a negative's score lies between.
LOW, HIGH = 50, 95
PIVOTS, SAMPLE_ROWS = 32, 4096
#: Rows and anchors that meet in one task; bins by distance that a pivot's rows are cut into, at most (so the brackets' table has PIVOTS * PIVOTS * MOST_RINGS rows).
BLOCK_ROWS, BLOCK_ASKS, MOST_RINGS = 4096, 1024, 64
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_NONE = -np.iinfo(np.int64).max


def whole_vectors(vectors: DataFrame, label: Column | str = "label", id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id, label, x (components as whole numbers) of the rows that take part."""
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"), F.col(vector_column).alias("v"))
    whole = F.transform("v", lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")))
    fits = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) * SCALE < F.sqrt(F.lit(2.0**62) / F.greatest(F.size("v"), F.lit(1)))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(fits, F.lit(False)))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", whole.alias("x"))).alias("r")).select("vec_id", "r.*")


@dataclass
class Pivots:
    """Pivots with their further component; edges: for each the distances that cut its rows into rings."""

    x: np.ndarray
    more: np.ndarray
    largest: int  # the largest squared norm of any row
    edges: np.ndarray

    def distances(self, x: np.ndarray, more: np.ndarray) -> np.ndarray:
        """Of vectors with these further components."""
        out = np.empty((len(x), len(self.x)))
        for k in range(len(self.x)):
            out[:, k] = np.sqrt(((x - self.x[k]) ** 2).sum(axis=1) + (more - self.more[k]) ** 2)
        return out

    def of_rows(self, x: np.ndarray) -> np.ndarray:
        return self.distances(x, np.sqrt(np.maximum(float(self.largest) - (x**2).sum(axis=1), 0.0)))

    def bins(self, d: np.ndarray) -> np.ndarray:
        own = d.argmin(axis=1)
        ring = (d[np.arange(len(d)), own][:, None] >= self.edges[own]).sum(axis=1)
        return own * (self.edges.shape[1] + 1) + ring

    def score(self, norm: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """The inner product at a distance from an anchor of a squared norm."""
        return (norm + float(self.largest) - distance**2) / 2

    def slack(self, norm: np.ndarray) -> np.ndarray:
        """More than rounding moves a bracket of scores."""
        return 1e-9 * (norm + float(self.largest)) + 1e-6


def chosen_pivots(sample: np.ndarray, largest: int, rows: int, pivots: int = PIVOTS) -> Pivots:
    """The first row of the sample, then always the one farthest from all before; no more than there are different ones."""
    more = np.sqrt(np.maximum(float(largest) - (sample**2).sum(axis=1), 0.0))
    at, far = [0], np.full(len(sample), np.inf)
    while len(at) < pivots:
        far = np.minimum(far, ((sample - sample[at[-1]]) ** 2).sum(axis=1) + (more - more[at[-1]]) ** 2)
        if far.max() <= 0:
            break
        at.append(int(far.argmax()))
    rings = int(min(MOST_RINGS, max(1, rows // (BLOCK_ROWS * len(at)))))
    found = Pivots(sample[at], more[at], largest, np.zeros((len(at), 0)))
    d = found.of_rows(sample)
    own, inner = d.argmin(axis=1), np.arange(1, rings) / rings
    found.edges = np.array([np.quantile(d[own == k, k], inner) if (own == k).any() else np.full(rings - 1, np.inf) for k in range(len(at))]).reshape(len(at), rings - 1)
    return found


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers; by floating point where that is exact."""
    size = max(float(np.abs(q).max(initial=0)), 1.0) * max(float(np.abs(x).max(initial=0)), 1.0) * max(q.shape[1], 1)
    return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64) if size < 2**53 else q @ x.T


def _whole(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.int64) for v in column])


class Met:
    """A block of anchors and a block of rows, the rows by id: exact scores of the survivors, anchor by anchor in chunks."""

    def __init__(self, asks: pd.DataFrame, rows: pd.DataFrame, pivots: Pivots):
        self.asks, self.pivots = asks, pivots
        rows = rows.sort_values("vec_id")
        self.ids, self.labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        self.x, self.d = _whole(rows["x"]), _stack(rows["d"])
        self.q, self.qd = _whole(asks["x"]), _stack(asks["d"])
        self.norm = (self.q.astype(np.float64) ** 2).sum(axis=1)

    def chunks(self, low: np.ndarray, high: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(anchors' places, scores): rows whose bracket meets low to high and whose label is the anchor's (or isn't); all others have the least number."""
        own, ask_id = self.asks["label"].to_numpy(), self.asks["anchor_id"].to_numpy()
        step = max(1, (1 << 20) // max(1, len(self.ids)))
        for lo in range(0, len(own), step):
            at = np.arange(lo, min(len(own), lo + step))
            near, far = np.zeros((len(at), len(self.ids))), np.full((len(at), len(self.ids)), np.inf)
            for k in range(self.d.shape[1]):
                a, b = self.qd[at, k][:, None], self.d[:, k][None, :]
                np.maximum(near, np.abs(a - b), out=near)
                np.minimum(far, a + b, out=far)
            norm = self.norm[at][:, None]
            slack = self.pivots.slack(norm)
            alive = (self.pivots.score(norm, near) + slack >= low[at][:, None]) & (self.pivots.score(norm, far) - slack <= high[at][:, None])
            alive &= ((own[at][:, None] == self.labels[None, :]) == same) & (ask_id[at][:, None] != self.ids[None, :])
            some = np.flatnonzero(alive.any(axis=0))
            scores = np.full(alive.shape, _NONE)
            if len(some):
                scores[:, some] = np.where(alive[:, some], _exact(self.q[at], self.x[some]), _NONE)
            yield at, scores


def _bins_between(pivots: Pivots, least: np.ndarray, most: np.ndarray, asks: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score that each anchor can have with a row of each bin (anchors x bins)."""
    qd, norm = _stack(asks["d"]), (_stack(asks["x"]) ** 2).sum(axis=1)[:, None]
    near, far = np.zeros((len(qd), len(least))), np.full((len(qd), len(least)), np.inf)
    for k in range(qd.shape[1]):
        a = qd[:, k][:, None]
        np.maximum(near, np.maximum(least[:, k][None, :] - a, a - most[:, k][None, :]), out=near)
        np.minimum(far, a + most[:, k][None, :], out=far)
    slack = pivots.slack(norm)
    return pivots.score(norm, far) - slack, pivots.score(norm, near) + slack


def band(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of a positive's negatives: 100 * score lies between LOW and HIGH times the positive's."""
    low = LOW * (positive // 100) - (-(LOW * (positive % 100)) // 100)
    high = HIGH * (positive // 100) + HIGH * (positive % 100) // 100
    return low, high


class Miner:
    """The pivot table over the rows, and meetings of anchors with its bins."""

    def __init__(self, scratch: Scratch, rows: DataFrame, n: int, largest: int):
        spark = rows.sparkSession
        share = SAMPLE_ROWS / n
        some = rows.where(F.xxhash64(F.lit(0), "vec_id").bitwiseAND(F.lit(0x7FFFFFFF)) < int(min(share, 1.0) * (1 << 31)))
        sample = some.select("vec_id", "x").toPandas().sort_values("vec_id")  # about SAMPLE_ROWS
        if not len(sample):
            sample = rows.orderBy("vec_id").limit(1).select("vec_id", "x").toPandas()
        self.scratch, self.pivots = scratch, chosen_pivots(_whole(sample["x"]).astype(np.float64), largest, n)
        shared = self.shared = spark.sparkContext.broadcast(self.pivots)

        def place(batches):  # noqa: ANN001, ANN202
            for b in batches:
                if len(b):
                    d = shared.value.of_rows(_stack(b["x"]))
                    yield b.assign(d=list(d), bin=shared.value.bins(d))

        self.table = scratch.cut(rows.mapInPandas(place, "vec_id long, label long, x array<long>, d array<double>, bin int"))
        ends = self.table.select("bin", F.posexplode("d").alias("k", "d")).groupBy("bin", "k").agg(F.min("d").alias("least"), F.max("d").alias("most")).toPandas()  # bins by pivots
        self.sizes = scratch.cut(self.table.groupBy("bin").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks")))  # a row per bin
        ends = ends.sort_values(["bin", "k"])
        self.bins = ends["bin"].unique()
        self.least, self.most = (ends[c].to_numpy().reshape(len(self.bins), -1) for c in ("least", "most"))

    def anchors(self, is_anchor: str) -> DataFrame:
        """anchor_id, label, x, d (of the vector with a 0 in the further place), home (its row's bin)."""
        shared = self.shared

        def ask(batches):  # noqa: ANN001, ANN202
            for b in batches:
                if len(b):
                    x = _stack(b["x"])
                    yield b.assign(d=list(shared.value.distances(x, np.zeros(len(x)))))

        rows = self.table.where(is_anchor).select(F.col("vec_id").alias("anchor_id"), "label", "x", F.col("bin").alias("home"))
        return self.scratch.cut(rows.mapInPandas(ask, "anchor_id long, label long, x array<long>, home int, d array<double>"))

    def routed(self, asks: DataFrame, wanted) -> DataFrame:  # noqa: ANN001
        """asks with a row per further bin that wanted(asks, least, largest score by bin) names."""
        shared, bins = self.shared, self.bins
        ends = asks.sparkSession.sparkContext.broadcast((self.least, self.most))

        def route(batches):  # noqa: ANN001, ANN202
            for b in batches:
                for lo in range(0, len(b), 256):
                    some = b.iloc[lo : lo + 256]
                    keep = wanted(some, *_bins_between(shared.value, *ends.value, some)) & (some["home"].to_numpy()[:, None] != bins[None, :])
                    yield some.assign(bins=[bins[k] for k in keep])

        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asks.schema)
        return asks.mapInPandas(route, schema + ", bins array<int>").withColumn("bin", F.explode("bins")).drop("bins")

    def meet(self, asks: DataFrame, compare, schema: str) -> DataFrame:  # noqa: ANN001
        """compare(Met) on each block of a bin's rows and block of the anchors that ask for the bin."""
        shared = self.shared
        asks = self.scratch.cut(asks)
        sizes = asks.groupBy("bin").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ASKS).cast("int").alias("parts")).join(self.sizes, "bin")  # a row per bin
        sizes = F.broadcast(sizes)
        to = asks.join(sizes, "bin").withColumn("part", F.pmod(F.xxhash64("anchor_id"), "parts").cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("parts", "blocks")
        mine = self.table.join(sizes, "bin").withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts", "blocks")

        def run(key, a, b):  # noqa: ANN001, ANN202, ARG001
            if not len(a) or not len(b):
                return pd.DataFrame({f.split()[0]: pd.Series([], dtype=np.int64) for f in schema.split(", ")})
            return compare(Met(a, b, shared.value))

        by = ("bin", "block", "part")
        return self.scratch.cut(to.groupBy(*by).cogroup(mine.groupBy(*by)).applyInPandas(run, schema))


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchors, rows) of each anchor's k best scores; rows stand by id, so ties keep the smaller first."""
    best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    r, c = np.nonzero(np.take_along_axis(scores, best, 1) != _NONE)
    return r, best[r, c]


def _positives(k: int):  # noqa: ANN202
    def compare(met: Met) -> pd.DataFrame:
        found = []
        for at, scores in met.chunks(met.asks["bound"].to_numpy().astype(np.float64), np.full(len(met.asks), np.inf), same=True):
            r, c = _best(scores, k)
            found.append(pd.DataFrame({"anchor_id": met.asks["anchor_id"].to_numpy()[at[r]], "vec_id": met.ids[c], "score": scores[r, c]}))
        return pd.concat(found)

    return compare


def _negatives(k: int):  # noqa: ANN202
    def compare(met: Met) -> pd.DataFrame:
        found = [pd.DataFrame({c: np.zeros(0, np.int64) for c in ("anchor_id", "positive_id", "vec_id", "score")})]
        asks = met.asks
        reach = [np.array(b, np.int64) for b in asks["bounds"]]
        high = [band(np.asarray(s, np.int64))[1] for s in asks["positive_scores"]]
        for at, scores in met.chunks(np.array([b.min() for b in reach], np.float64), np.array([h.max() for h in high], np.float64), same=False):
            order = np.argsort(-scores, axis=1, kind="stable")
            for i, row in enumerate(at):
                falling = -scores[i, order[i]][: int((scores[i] != _NONE).sum())]
                for positive, least, most in zip(asks["positive_ids"].iloc[row], reach[row], high[row], strict=True):
                    first = int(np.searchsorted(falling, -most, "left"))
                    last = min(first + k, int(np.searchsorted(falling, -least, "right")))
                    if last > first:
                        some = order[i, first:last]
                        found.append(pd.DataFrame({"anchor_id": asks["anchor_id"].iloc[row], "positive_id": positive, "vec_id": met.ids[some], "score": scores[i, some]}))
        return pd.concat(found)

    return compare


def mine(vectors: DataFrame, is_anchor: str, label: Column | str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. is_anchor: a condition on vec_id."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "negatives")
    rows = scratch.cut(whole_vectors(vectors, label))
    norm = F.aggregate("x", F.lit(0).cast("long"), lambda a, c: a + c * c)
    size = rows.groupBy(F.size("x").alias("n")).agg(F.count(F.lit(1)).alias("rows"), F.max(norm).alias("largest")).orderBy(F.desc("rows"), "n").first()
    if size is None:
        return spark.createDataFrame([], RESULT)
    miner = Miner(scratch, rows.where(F.size("x") == size["n"]), size["rows"], size["largest"])
    scratch.drop(rows)
    asks = miner.anchors(is_anchor)
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    near = "anchor_id long, vec_id long, score long"
    first = miner.meet(asks.withColumns({"bin": F.col("home"), "bound": F.lit(int(_NONE))}), _positives(positives), near)
    bound = first.groupBy("anchor_id").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s"))  # k scores a block of the home bin
    bound = bound.select("anchor_id", F.try_element_at("s", F.lit(positives)).alias("bound"))
    further = miner.routed(asks.join(bound, "anchor_id", "left").fillna(int(_NONE), ["bound"]), lambda a, low, high: high >= a["bound"].to_numpy()[:, None])
    second = miner.meet(further, _positives(positives), near)
    pairs = first.unionByName(second).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives)
    pairs = scratch.cut(pairs.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    listed = pairs.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("positive_id", "positive_score"))).alias("p"))
    asks = asks.join(listed, "anchor_id").select("*", F.col("p.positive_id").alias("positive_ids"), F.col("p.positive_score").alias("positive_scores")).drop("p")
    lows = F.transform("positive_scores", lambda s: F.ceil(s.cast("decimal(38,0)") * LOW / 100).cast("long"))
    asks = scratch.cut(asks.withColumn("bounds", lows))
    found = "anchor_id long, positive_id long, vec_id long, score long"
    first_n = miner.meet(asks.withColumn("bin", F.col("home")), _negatives(negatives), found)
    reached = first_n.groupBy("anchor_id", "positive_id").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s")).select("anchor_id", "positive_id", F.try_element_at("s", F.lit(negatives)).alias("bound"))
    reached = reached.where("bound IS NOT NULL").groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("positive_id", "bound"))).alias("m"))
    raised = F.transform("positive_ids", lambda p, i: F.greatest(F.get("bounds", i), F.try_element_at("m", p)))
    again = asks.join(reached, "anchor_id", "left").withColumn("bounds", raised).drop("m")

    def in_band(a: pd.DataFrame, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        least = np.array([np.min(b) for b in a["bounds"]], np.float64)
        most = np.array([band(np.asarray(s, np.int64))[1].max() for s in a["positive_scores"]], np.float64)
        return (high >= least[:, None]) & (low <= most[:, None])

    second_n = miner.meet(miner.routed(again, in_band), _negatives(negatives), found)
    of = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id")
    out = first_n.unionByName(second_n).withColumn("rank", F.row_number().over(of)).where(F.col("rank") <= negatives).join(pairs, ["anchor_id", "positive_id"])
    scratch.drop_all_but(first_n, second_n, pairs)
    return out.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
