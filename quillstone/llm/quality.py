"""Quality rules: plain counts, and a hashed n-gram likelihood ratio between trusted texts and the raw corpus.

Words (one and two in a row; a word and itself is one pair, whatever the word) and runs of four bytes are hashed into ``BUCKETS`` buckets. Their counts over all documents make the raw multinomial, those over
trusted documents (``labels.quality`` is 1) the target one. A text's score is the mean log ratio of its n-grams' chances, target over raw, so length doesn't matter; both
get the same ``PRIOR`` counts in a bucket, at the target's scale, so that buckets with little evidence say little. A document stays if it passes the plain rules and
its score reaches ``THRESHOLD``: a fixed number, no draw, so every document's verdict can be repeated.

Trusted documents are at most about ``max_rows`` (drawn by a hash of doc_id); the raw counts and the scores cover every text whole. Counts are whole numbers, summed by
bucket, so the order of tasks changes nothing.

Nulls: a null text has no word, like an empty one: it fails the plain rules; its score is 0. Labels that are null, or whose doc_id is, aren't used; a doc_id with several
labels is trusted if one says so. Rows that repeat a doc_id are each counted and scored. Without trusted documents every score is 0. A huge text is worked on in parts
(n-grams across their joints aren't scored; the plain counts are exact). An empty table gives an empty result. Only doc_id and text are read of documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, own_columns
from .words import _SPACE, U, _powers, is_huge, mix, parts, slices

BITS = 17
BUCKETS = 1 << BITS
#: Counts that every bucket has beforehand, and the least mean log ratio of a text that stays.
PRIOR, THRESHOLD = 20.0, -0.3
#: Trusted documents, at most about so many, so that the table of their ids can be broadcast (16 bytes each).
MAX_ROWS = 200_000
#: The plain rules: fewer words than this fail, as does a greater share (percent) of words in repeated windows of WINDOW words.
LEAST_WORDS, MOST_REPEATED, WINDOW = 10, 20, 5
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, rows) of the words of texts that begin at ``at``, as they are written."""
    n = len(data)
    word = ~_SPACE[data]
    first = np.zeros(n + 1, bool)
    first[at] = True  # a text ends a word
    start = np.flatnonzero(word & (~np.concatenate([[False], word[:-1]]) | first[:-1])) if n else np.zeros(0, np.int64)
    end = np.flatnonzero(word & (~np.concatenate([word[1:], [False]]) | first[1:])) + 1 if n else start
    power, inverse = _powers(n + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, U), np.cumsum((data.astype(U) + U(1)) * power[:n])])
        numbers = mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U) * U(0xD6E8FEB86659FD93))
    return numbers, np.searchsorted(at, start, "right") - 1


def _windows(numbers: np.ndarray, k: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        n = max(0, len(numbers) - k + 1)
        out = np.zeros(n, U)
        for i in range(k):
            out += numbers[i : i + n] * U(pow(0xC2B2AE3D27D4EB4F, i + 1, 1 << 64))
        return mix(out)


def repeated_words(numbers: np.ndarray, k: int = WINDOW) -> int:
    """Words that lie in a window of k words that the text holds twice or more."""
    w = _windows(numbers, k)
    if not len(w):
        return 0
    order = np.argsort(w, kind="stable")
    same = w[order][1:] == w[order][:-1]
    again = np.zeros(len(w), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    edges = np.zeros(len(numbers) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + k, -1)
    return int((np.cumsum(edges) > 0).sum())


def _pieces(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A slice, or the parts of a huge text."""
    if is_huge(data, at):
        for a, b in parts(data):
            yield data[a:b], np.array([0, b - a])
    else:
        yield data, at


def n_grams(data: np.ndarray, at: np.ndarray, numbers: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, rows): words, pairs of words and runs of four bytes, none across two texts."""
    with np.errstate(over="ignore"):
        two = _windows(numbers, 2)
        two[numbers[1:] == numbers[:-1]] = U(0)
        inside = rows[1:] == rows[:-1] if len(rows) else np.zeros(0, bool)
        d = data.astype(U)
        four = d[:-3] | d[1:-2] << U(8) | d[2:-1] << U(16) | d[3:] << U(24) if len(d) > 3 else np.zeros(0, U)
        at_row = np.repeat(np.arange(len(at) - 1), np.diff(at))
        whole = at_row[:-3] == at_row[3:] if len(d) > 3 else np.zeros(0, bool)
        keys = np.concatenate([numbers, two[inside], mix(four[whole] + U(0x5851F42D4C957F2D))])
        owner = np.concatenate([rows, rows[1:][inside], at_row[:-3][whole] if len(d) > 3 else np.zeros(0, np.int64)])
    return (keys >> U(64 - BITS)).astype(np.int64), owner


def _documents(docs: DataFrame) -> DataFrame:
    return own_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, seed: int = 0) -> np.ndarray:
    """The log ratio of each bucket."""
    good = own_columns(labels, "doc_id", "quality").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    good = good.where("doc_id IS NOT NULL AND quality = 1").select("doc_id").distinct()
    n = good.count()
    if n > max_rows:
        good = good.where(F.xxhash64(F.lit(seed), "doc_id").bitwiseAND(F.lit(0x7FFFFFFF)) < int(max_rows / n * (1 << 31)))
    rows = _documents(docs).join(F.broadcast(good.withColumn("trusted", F.lit(True))), "doc_id", "left").select("text", "trusted")  # max_rows ids or so

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for b in batches:
            good = b.column("trusted").is_valid().to_numpy(zero_copy_only=False)
            for lo, hi, data, at in slices(b.column("text")):
                for part, begins in _pieces(data, at):
                    bucket, row = n_grams(part, begins, *_words(part, begins))
                    raw += np.bincount(bucket, minlength=BUCKETS)
                    target += np.bincount(bucket[good[lo:hi][row]], minlength=BUCKETS)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])], ["bucket", "raw", "target"])

    got = rows.mapInArrow(lean(count), "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()  # BUCKETS rows
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[got.column("bucket").to_numpy()], target[got.column("bucket").to_numpy()] = got.column("raw").to_numpy(), got.column("target").to_numpy()
    if not target.sum():
        return np.zeros(BUCKETS)
    return np.log(target + PRIOR) - np.log(raw * (target.sum() / raw.sum()) + PRIOR)


def scored(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """Per row: doc_id, the plain counts, n_grams (how many were scored) and score."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, at in slices(b.column("text")):
                n = hi - lo
                counts, found, of = np.zeros((n, 5), np.int64), [], []
                total, many = np.zeros(n), np.zeros(n, np.int64)
                for part, begins in _pieces(data, at):
                    numbers, rows = _words(part, begins)
                    found.append(numbers)
                    of.append(rows)
                    bucket, owner = n_grams(part, begins, numbers, rows)
                    total += np.bincount(owner, shared.value[bucket], n)
                    many += np.bincount(owner, minlength=n)
                    at_row = np.repeat(np.arange(n), np.diff(begins))
                    counts[:, 1] += np.bincount(at_row[~_SPACE[part] & (part & 0xC0 != 0x80)], minlength=n)
                    counts[:, 2] += np.bincount(at_row[_SYMBOL[part]], minlength=n)
                numbers, rows = np.concatenate(found), np.concatenate(of)
                counts[:, 0] = np.bincount(rows, minlength=n)
                first = np.concatenate([[0], np.cumsum(counts[:, 0])])
                for r in range(n):
                    lines = [x for x in data[at[r] : at[r + 1]].tobytes().split(b"\n") if x and not x.isspace()]
                    counts[r, 3] = len(lines) - len(set(lines))
                    counts[r, 4] = repeated_words(numbers[first[r] : first[r + 1]])
                columns = [b.column("doc_id").slice(lo, n), *(pa.array(counts[:, k]) for k in range(5)), pa.array(many), pa.array(total / np.maximum(many, 1))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_grams", "score"])

    return _documents(docs).mapInArrow(lean(run), f"doc_id long, {BASE}, n_grams long, score double")


def judged(docs: DataFrame, ratio: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """scored() with base_failed and kept."""
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return scored(docs, ratio).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
