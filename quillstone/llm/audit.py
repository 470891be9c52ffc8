"""How filters interact: what each of them removes in every order, and what it alone or again would remove.

Five filters: A too few words, B too few distinct words, C too many capitals, D a symbol, E a copy of a smaller doc_id's text. A to D are read off a text; E needs all texts: an
RDD is routed by the text's xxhash, so equal texts meet in one partition. There a chain per hash holds full texts with their smallest id, and every row that isn't its
text's smallest is emitted as a copy. The same chains run before the shuffle, within each task, so a text that a third of all rows have leaves a
task once, and its other rows leave as ids alone, spread evenly. Chains before the shuffle are flushed at ``HELD_BYTES`` (texts met twice stay); partitions are
as many as it takes for ``PART_BYTES`` of text each. Each row's failures make a mask of five bits; combineByKey adds up mask counts per part, and all orders
follow from those 32 counts.

Nulls: a null text is empty, a null source is the part ''. A null doc_id is larger than any other. Rows that repeat a doc_id and its text are no copies of each other;
each counts. A document is good (toxic) if one of its labels says so. A part with rows has all its 600 rows; an empty table gives none. Huge texts are counted
in parts. Only doc_id, text and source are read of documents.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own_columns
from .words import CUT, parts

FILTERS = "ABCDE"
COPY = 16
#: In place of a null doc_id: larger than any.
NO_ID = 1 << 63
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5
#: Text that a task's chains hold before they are flushed, and that a partition gets after the shuffle, on average.
HELD_BYTES, PART_BYTES = 32 << 20, 32 << 20
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS) + ", shapley long"
_CAPITALS = bytes(range(65, 91))
_SYMBOL = re.compile(rb"[#$%&*|]")


def failures(text: bytes, points: int) -> int:
    """Bits of the filters A to D that a text of so many code points fails."""
    if len(text) > CUT:
        n, distinct = 0, set()
        for lo, hi in parts(np.frombuffer(text, np.uint8)):
            some = text[lo:hi].split()
            n += len(some)
            distinct.update(some)
        different = len(distinct)
    else:
        words = text.split()
        n, different = len(words), len(set(words))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return (n < LEAST_WORDS) | (100 * different < LEAST_DISTINCT * n) << 1 | (100 * capitals > MOST_CAPITALS * points) << 2 | bool(_SYMBOL.search(text)) << 3


class Chains:
    """Texts by fingerprint: [text, smallest id, rows of it by part, mask, met again]."""

    def __init__(self) -> None:
        self.of: dict[int, list[list]] = {}
        self.held = 0

    def add(self, fingerprint: int, text: bytes, key: int, rows: dict[str, int], mask: int) -> tuple[int, dict[str, int], int] | None:
        """Notes rows (their number by part) of one id; returns the id and rows that are copies now, and their mask."""
        chain = self.of.setdefault(fingerprint, [])
        link = next((x for x in chain if x[0] == text), None)
        if link is None:
            chain.append([text, key, dict(rows), mask, False])
            self.held += len(text)
            return None
        link[4] = True
        if key == link[1]:
            for part, n in rows.items():
                link[2][part] = link[2].get(part, 0) + n
            return None
        if key > link[1]:
            return key, rows, mask | COPY
        gone = link[1], link[2], mask | COPY
        link[1], link[2] = key, dict(rows)
        return gone

    def flush(self, everything: bool) -> Iterator[tuple[int, list]]:
        """Links and their fingerprints, but for those met again, which stay as long as they take up half of the room."""
        kept, held = {}, 0
        for fingerprint, chain in self.of.items():
            for link in chain:
                if not everything and link[4] and held + len(link[0]) <= HELD_BYTES // 2:
                    kept.setdefault(fingerprint, []).append(link)
                    held += len(link[0])
                else:
                    yield fingerprint, link
        self.of, self.held = kept, held


def _route(rows: Iterator) -> Iterator[tuple[int, tuple]]:
    """(fingerprint, (text, smallest id, rows by part, mask)) of what a task can't decide, (id, (None, ...)) of what it can."""
    chains = Chains()
    for part, key, text, fingerprint in rows:
        raw, key = text.encode(), NO_ID if key is None else key
        gone = chains.add(fingerprint, raw, key, {part: 1}, failures(raw, len(text)))
        if gone:
            yield gone[0], (None, *gone)
        if chains.held > HELD_BYTES:
            for fp, link in chains.flush(False):
                yield fp, tuple(link[:4])
    for fp, link in chains.flush(True):
        yield fp, tuple(link[:4])


def _settle(routed: Iterator[tuple[int, tuple]]) -> Iterator[tuple[int | None, str, int, int]]:
    """(id, part, mask, rows), of a partition's fingerprints."""
    chains, own = Chains(), lambda key: None if key == NO_ID else key
    for fingerprint, (text, key, rows, mask) in routed:
        done = (key, rows, mask) if text is None else chains.add(fingerprint, text, key, rows, mask)
        if done:
            for part, n in done[1].items():
                yield own(done[0]), part, done[2], n
    for _, link in chains.flush(True):
        for part, n in link[2].items():
            yield own(link[1]), part, link[3], n


def masks(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask (bits of failed filters, A first) and n, the number of such rows."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = own_columns(docs, "doc_id", "text", "source").select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.col("doc_id").cast("long").alias("key"), text.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    routed = rows.select("part", "key", "text", F.xxhash64("text").alias("fingerprint")).rdd.mapPartitions(_route).partitionBy(n, lambda key: key % n)
    return spark.createDataFrame(routed.mapPartitions(_settle), "doc_id long, part string, mask int, n long", verifySchema=False)


def _orders() -> tuple[list[tuple[str, int, int]], dict[str, np.ndarray]]:
    """(order, step, filter's place) of all steps, and per count which masks make it up (steps x 32)."""
    steps, chosen = [], {c: [] for c in COUNTS[:4]}
    mask = np.arange(1 << len(FILTERS))
    for order in itertools.permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order):
            bit = 1 << f
            steps.append(("".join(FILTERS[i] for i in order), step + 1, f))
            fails, passed = mask & bit > 0, mask & before == 0
            chosen["kept"].append(passed & ~fails)
            chosen["removed"].append(passed & fails)
            chosen["redundant"].append(~passed & fails)
            chosen["unique_fails"].append(mask == bit)
            before |= bit
    return steps, {k: np.array(v, np.int64) for k, v in chosen.items()}


def _table(vectors: Iterator[tuple[str, np.ndarray]]) -> Iterator[tuple]:
    """All orders' rows of each part's mask counts (rows, good, toxic: 3 x 32)."""
    steps, chosen = _orders()
    place = np.array([f for _, _, f in steps])
    for part, (rows, good, toxic) in vectors:
        found = {k: v @ rows for k, v in chosen.items()} | {"good_lost": chosen["removed"] @ good, "toxic_lost": chosen["removed"] @ toxic}
        shapley = np.array([found["removed"][place == f].sum() for f in range(len(FILTERS))])[place]
        for i, (order, step, _) in enumerate(steps):
            yield (part, order, step, *(int(found[c][i]) for c in COUNTS), int(shapley[i]))


def _one(x: tuple[int, int, bool, bool]) -> np.ndarray:
    return _more(np.zeros((3, 1 << len(FILTERS)), np.int64), x)


def _more(to: np.ndarray, x: tuple[int, int, bool, bool]) -> np.ndarray:
    to[:, x[0]] += np.array([x[1], x[1] * x[2], x[1] * x[3]])
    return to


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: part, filter_order, step and the counts."""
    spark = docs.sparkSession
    said = own_columns(labels, "doc_id", "quality", "toxic").where("doc_id IS NOT NULL")
    one = lambda c: F.coalesce(F.bool_or(F.col(c).cast("int") == 1), F.lit(False))
    said = said.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    rows = masks(docs).groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    rows = rows.join(said, "doc_id", "left").select("part", "mask", "n", F.coalesce("good", F.lit(False)), F.coalesce("toxic", F.lit(False)))
    vectors = rows.rdd.map(lambda r: (r[0], tuple(r[1:]))).combineByKey(_one, _more, lambda a, b: a + b, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spark.createDataFrame(vectors.mapPartitions(_table), SCHEMA, verifySchema=False)
