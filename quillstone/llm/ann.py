"""Approximate nearest neighbours: a hierarchical k-means tree, searched best bin first.

The tree is fitted on the driver on at most about ``sample_rows`` vectors, drawn by a hash of id and vector; every vector is then put into one of its leaves.
Leaves that hold many times ``LEAF_ROWS`` get trees of their own, each fitted by a task on a sample of its leaf, level by level; so leaves grow in
number with the table, up to ``MOST_LEAVES``, and a query meets an ever smaller share of it. A query walks the tree through a priority queue: the node with the nearest
centre is opened next, wherever it lies. How many leaves it visits is calibrated on the grown tree: some vectors' true neighbours among all
rows are found by brute force, in blocks, and visits are widened until they hold ``recall`` of them. Vectors and queries meet by
leaf; a leaf of many rows (equal vectors, say) is split into blocks, each met by all its queries. Distances are the root of the summed squares of
differences, in double precision, ties to the smaller vec_id; centres are taken about the sample's mean, so an offset costs no digits.

Vectors that are null, zero, hold null or non-finite components, have no vec_id, or another length than most, take no part. A row that repeats
a vec_id is a candidate of its own (not for its own id), and one query. With no candidates a query returns nothing. An empty table gives an
empty result. Only the two named columns are read.
"""

from __future__ import annotations

import heapq
import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch

SAMPLE_ROWS, BRANCHES, LEAF_ROWS, RECALL, CALIBRATED = 20_000, 16, 48, 0.98, 200
#: Leaves of more than so many times LEAF_ROWS are split, as long as there aren't this many; the tree, which every task holds, stays bounded.
TOO_MANY, MOST_LEAVES = 8, 1 << 16
#: Rows of a leaf that meet its queries in one task.
BLOCK_ROWS = 4096
NEAR = "query_id long, vec_id long, score double"


def k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = nearest(x, centres)
        n = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1)[None, :] - 2 * x @ centres.T).argmin(axis=1)


@dataclass
class Tree:
    """Nodes in the order they were made; children[i] is empty for a leaf, which has the number leaf[i]. Centres stand about the origin."""

    origin: np.ndarray
    centres: np.ndarray
    children: list[list[int]]
    leaf: list[int]

    @classmethod
    def fit(cls, x: np.ndarray, branches: int = BRANCHES, leaf_rows: float = LEAF_ROWS, seed: int = 0) -> Tree:
        rng = np.random.default_rng(seed)
        origin = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
        x = x - origin
        centres, children, leaf = [np.zeros(x.shape[1])], [[]], [0]
        todo, leaves = [(0, np.arange(len(x)))], 0
        while todo:
            node, rows = todo.pop()
            own = None
            if len(rows) > max(leaf_rows, 1):
                c = k_means(x[rows], int(min(branches, len(rows), max(2, len(rows) // leaf_rows))), rng)
                own = nearest(x[rows], c)
                if len(np.unique(own)) < 2:  # equal vectors: no split helps
                    own = None
            if own is None:
                leaf[node] = leaves
                leaves += 1
                continue
            for k in np.unique(own):
                centres.append(c[k])
                children.append([])
                leaf.append(-1)
                children[node].append(len(centres) - 1)
                todo.append((len(centres) - 1, rows[own == k]))
        return cls(origin, np.array(centres, np.float64), children, leaf)

    def grown(self, trees: dict[int, Tree]) -> Tree:
        """With these trees in place of the leaves of their numbers; leaves are numbered anew."""
        centres, children, leaf = list(self.centres), [list(c) for c in self.children], list(self.leaf)
        node_of = {k: i for i, k in enumerate(self.leaf) if k >= 0}
        for number, sub in trees.items():
            node, first = node_of[number], len(centres) - 1  # the root of sub is the leaf itself
            move = sub.origin - self.origin
            for i in range(1, len(sub.centres)):
                centres.append(sub.centres[i] + move)
                children.append([first + k for k in sub.children[i]])
                leaf.append(sub.leaf[i])
            children[node] = [first + k for k in sub.children[0]]
        numbers = iter(range(len(centres)))
        return Tree(self.origin, np.array(centres, np.float64), children, [-1 if kids else next(numbers) for kids in children])

    @property
    def leaves(self) -> int:
        return max(self.leaf) + 1

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector, down the nearest centres."""
        x, out = x - self.origin, np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if not self.children[node]:
                out[rows] = self.leaf[node]
                continue
            kids = np.array(self.children[node])
            own = nearest(x[rows], self.centres[kids])
            todo += [(int(k), rows[own == i]) for i, k in enumerate(kids)]
        return out

    def visit(self, q: np.ndarray, most: int, rows: np.ndarray | None = None, enough: int = 0) -> list[int]:
        """The first leaves that best-bin-first traversal reaches: so many, and on until they hold enough rows (rows: by leaf)."""
        q, queue, out, held = q - self.origin, [(0.0, 0)], [], 0
        while queue and (len(out) < most or held < enough):
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not kids:
                out.append(self.leaf[node])
                held += 0 if rows is None else int(rows[self.leaf[node]])
                continue
            d = ((self.centres[kids] - q) ** 2).sum(axis=1)
            for k, x in zip(kids, d.tolist(), strict=True):
                heapq.heappush(queue, (x, k))
        return out


def calibrate(tree: Tree, queries: np.ndarray, of: np.ndarray, leaf: np.ndarray, recall: float = RECALL) -> int:
    """Leaves to visit so that the queries find the given share of their true neighbours. of, leaf: a neighbour's query (its index) and leaf."""
    if not len(of):
        return tree.leaves
    order = np.full((len(queries), tree.leaves), tree.leaves, np.int32)
    for i, q in enumerate(queries):
        seen = tree.visit(q, tree.leaves)
        order[i, seen] = np.arange(len(seen))
    at = np.sort(order[of, leaf])
    return int(min(tree.leaves, at[max(0, int(np.ceil(recall * len(at))) - 1)] + 1))


def top(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> pd.DataFrame:
    """Each query's k nearest of x by exact distance, ties to the smaller id; rows of the query's own id don't count."""
    found = [pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})]
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    some = max(1, (1 << 21) // max(1, x.size))
    for lo in range(0, len(q) if len(x) else 0, some):
        part, asked = q[lo : lo + some], query_ids[lo : lo + some]
        d = np.sqrt(((part[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
        d[asked[:, None] == ids[None, :]] = np.inf
        best = np.argsort(d, axis=1, kind="stable")[:, :k]  # ids rise, so ties keep the smaller first
        near = np.take_along_axis(d, best, 1)
        r, c = np.nonzero(np.isfinite(near))
        found.append(pd.DataFrame({"query_id": asked[r], "vec_id": ids[best[r, c]], "score": near[r, c]}))
    return pd.concat(found)


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def usable(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Per row that takes part: vec_id, vector."""
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.coalesce(finite & F.exists("vector", lambda v: v != 0), F.lit(False)))


def _drawn(rows: DataFrame, share: float, seed: int) -> DataFrame:
    """Rows drawn by a hash of id and vector; of equal rows one."""
    if share < 1:
        rows = rows.where(F.xxhash64(F.lit(seed), "vec_id", "vector").bitwiseAND(F.lit(0x7FFFFFFF)) < int(share * (1 << 31)))
    return rows.distinct()


def _grow(tree: Tree, placed: DataFrame, sample_rows: int, seed: int) -> Tree | None:
    """The tree with trees of their own for its leaves that hold too many rows; None if there are none, or leaves enough."""
    counts = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > TOO_MANY * LEAF_ROWS)
    full = {r["leaf"]: r["n"] for r in counts.collect()}  # a row per leaf at most
    if not full or tree.leaves >= MOST_LEAVES:
        return None
    room = (MOST_LEAVES - tree.leaves) / len(full)
    share = F.lit(sample_rows) / F.col("n")
    some = placed.join(F.broadcast(counts), "leaf").where(F.xxhash64(F.lit(seed), "vec_id", "vector").bitwiseAND(F.lit(0x7FFFFFFF)) < share * (1 << 31))
    some = some.select("leaf", "vec_id", "vector").distinct()

    def fit(key, rows):  # noqa: ANN001, ANN202
        rows = rows.sort_values("vec_id")
        x, n = _stack(rows["vector"]), full[key[0]]
        sub = Tree.fit(x, leaf_rows=max(LEAF_ROWS * len(x) / n, len(x) / room, 4), seed=seed)
        tables = [sub.origin, sub.centres]
        return pd.DataFrame({"leaf": [key[0]], "tree": [pickle.dumps((*tables, sub.children, sub.leaf))]})

    trees = {r["leaf"]: Tree(*pickle.loads(r["tree"])) for r in some.groupBy("leaf").applyInPandas(fit, "leaf long, tree binary").collect()}  # noqa: S301  MOST_LEAVES centres
    trees = {k: t for k, t in trees.items() if t.leaves > 1}
    return tree.grown(trees) if trees else None


def search(vectors: DataFrame, is_query: str, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding", sample_rows: int = SAMPLE_ROWS, recall: float = RECALL, seed: int = 0) -> DataFrame:
    """query_id, rank, vec_id, score. is_query: a condition on vec_id that makes a row a query."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "ann")
    rows = usable(vectors, id_column, vector_column)
    sizes = rows.groupBy(F.size("vector").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "n").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("vector") == sizes["n"])
    kind = rows.schema["vector"].dataType.simpleString()
    x = _drawn(rows, sample_rows / sizes["rows"], seed).toPandas().sort_values("vec_id")  # about sample_rows
    tree = Tree.fit(_stack(x["vector"]) if len(x) else np.zeros((0, sizes["n"])), seed=seed)

    def placed_by(tree: Tree) -> DataFrame:
        shared = spark.sparkContext.broadcast(tree)  # MOST_LEAVES centres at most

        def place(batches):  # noqa: ANN001, ANN202
            for b in batches:
                if len(b):
                    yield b.assign(leaf=shared.value.place(_stack(b["vector"])))

        return scratch.cut(rows.mapInPandas(place, f"vec_id long, vector {kind}, leaf long"))

    placed = placed_by(tree)
    while sizes["rows"] > len(x) and (larger := _grow(tree, placed, sample_rows, seed)):
        scratch.drop(placed)
        tree = larger
        placed = placed_by(tree)
    # calibration: true neighbours of some drawn vectors among all rows
    some = x.drop_duplicates("vec_id").sample(min(CALIBRATED, x["vec_id"].nunique()), random_state=seed)
    some_ids, some_q = some["vec_id"].to_numpy(), _stack(some["vector"]) if len(some) else np.zeros((0, sizes["n"]))
    asked = spark.sparkContext.broadcast((some_ids, some_q))

    def nearest_here(batches):  # noqa: ANN001, ANN202
        own, q = asked.value
        for b in batches:
            if len(b) and len(own):
                ids, leaves = b["vec_id"].to_numpy(), b["leaf"].to_numpy()
                more = int((ids[:, None] == own[None, :]).sum(axis=0).max())
                near = top(-1 - np.arange(len(own)), q, np.arange(len(b)), _stack(b["vector"]), k + more)  # numbers of rows, so that their leaves are at hand
                query, at = -1 - near["query_id"].to_numpy(), near["vec_id"].to_numpy()
                near = near.assign(query_id=query, vec_id=ids[at], leaf=leaves[at])
                yield near[ids[at] != own[query]]

    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    true = placed.mapInPandas(nearest_here, f"{NEAR}, leaf long").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "leaf").toPandas()
    visits = calibrate(tree, some_q, true["query_id"].to_numpy(), true["leaf"].to_numpy(), recall)
    shared = spark.sparkContext.broadcast(tree)
    counts = scratch.cut(placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")))  # a row per leaf
    blocks = F.broadcast(counts.select("leaf", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks")))
    held = np.zeros(tree.leaves, np.int64)
    for r in counts.collect():
        held[r["leaf"]] = r["n"]
    enough = k + (placed.where(is_query).groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0)  # k besides the query's own

    def route(batches):  # noqa: ANN001, ANN202
        for b in batches:
            leaves = [shared.value.visit(np.asarray(v, np.float64), visits, held, enough) for v in b["vector"]]
            yield b.assign(leaves=leaves)

    mine = placed.join(blocks, "leaf").select("leaf", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), "blocks").cast("int").alias("block"), "vec_id", "vector")
    asking = rows.where(is_query).dropDuplicates(["vec_id"]).mapInPandas(route, f"vec_id long, vector {kind}, leaves array<long>")
    asking = asking.select("vec_id", "vector", F.explode("leaves").alias("leaf")).join(blocks, "leaf")
    asking = asking.select("leaf", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("vec_id").alias("query_id"), "vector")

    def compare(key, a, b):  # noqa: ANN001, ANN202
        if not len(a) or not len(b):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        return top(a["query_id"].to_numpy(), _stack(a["vector"]), b["vec_id"].to_numpy(), _stack(b["vector"]), k)

    near = asking.groupBy("leaf", "block").cogroup(mine.groupBy("leaf", "block")).applyInPandas(compare, NEAR)
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def exact_search(x: np.ndarray, ids: np.ndarray, query: np.ndarray, k: int = 10) -> pd.DataFrame:
    """Plain brute force, for measuring recall on small inputs."""
    out = []
    for i in query:
        d = [float(np.sqrt(sum((x[j] - x[i]) ** 2))) for j in range(len(x))]
        best = sorted((d[j], int(ids[j])) for j in range(len(x)) if ids[j] != ids[i])[:k]
        out += [(int(ids[i]), v, s) for s, v in best]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])
