"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence's score is the logistic function of the summed weights of its words and of the beginnings of its words (four to six bytes, so that inflected
forms share weights). A document's score is the noisy-or of its sentences: one minus the product of their chances to be harmless. Only
document labels train it; the sentences that carry the score then stand out, and ``sentences`` returns them with their bytes.

The model is fitted by one task on at most ``max_rows`` labelled documents, drawn by a hash of doc_id; every document is scored whole.
Nulls: a null or empty text has no sentence and the score 0. Labels that are null, or whose doc_id is, aren't used; of several labels for a doc_id
the largest counts. Rows that repeat a doc_id are scored each. Without labels of either kind every score is that of the starting weights.
An empty table gives an empty result. Only doc_id and text are read of documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, own_columns
from .words import U, Words, is_huge, parts, slices

#: Weights are looked up by this many bits of a feature's number.
BITS = 18
PREFIXES = (4, 5, 6)
MAX_ROWS = 6000
THRESHOLD = 0.3
EPOCHS, RATE, DECAY, START = 150, 0.08, 0.005, -7.0
#: Least log-likelihood ratio (twice) of a feature's link with the label.
EVIDENCE = 12.0
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?\n"]] = True


@dataclass
class Model:
    weights: np.ndarray  # one per feature
    bias: float


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, Words]:
    """(words x features) numbers, -1 for a prefix that a word is too short for, and the sentence of each word."""
    w = Words(data, at)
    n = len(w.start)
    tail = w.end.copy()  # without trailing marks, so that "word." counts as "word"
    for _ in range(3):
        mark = (tail - w.start > 1) & np.isin(data[tail - 1], np.frombuffer(b".,!?;:|\"')", np.uint8)) if n else np.zeros(0, bool)
        tail = tail - mark
    out = np.full((n, 1 + len(PREFIXES)), -1, np.int64)
    if n:
        out[:, 0] = (w.upto(tail) >> U(64 - BITS)).astype(np.int64)
        for k, size in enumerate(PREFIXES):
            long = np.flatnonzero(tail - w.start >= size)
            end = w.start + np.minimum(size, tail - w.start)
            out[long, k + 1] = ((w.upto(end)[long] ^ U(size * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> U(64 - BITS)).astype(np.int64)
    stops = np.concatenate([[0], np.cumsum(_STOP[data])])
    # a sentence begins with a text, and after a word that is followed by a stop before the next word
    begins = np.zeros(n, bool)
    if n:
        begins[w.first[:-1][w.count > 0]] = True
        begins[1:] |= stops[w.start[1:]] > stops[w.end[:-1] - 1]
    return out, np.cumsum(begins) - 1, w


def sentence_logits(f: np.ndarray, sentence: np.ndarray, model: Model) -> np.ndarray:
    if not len(f):
        return np.zeros(0)
    weight = np.append(model.weights, 0.0)[f].sum(axis=1)
    return np.bincount(sentence, weight, sentence[-1] + 1) + model.bias


def fit(texts: list[str], toxic: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Features that toxic documents hold more often than chance allows, weighted by gradient ascent on the noisy-or's log-likelihood."""
    model, n = Model(np.zeros(1 << BITS), START), len(texts)
    y = np.asarray(toxic, bool)
    parts, owners, total = [], [], 0
    a, b = np.zeros(1 << BITS), np.zeros(1 << BITS)  # documents of either kind that hold a feature
    for lo, _, data, at in slices(pa.array(texts, pa.large_string())):
        f, s, w = features(data, at)
        first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
        parts.append((f.astype(np.int32), (s + total).astype(np.int32)))
        pair = np.unique((f * n + (w.row + lo)[:, None])[f >= 0])
        for count, kind in ((a, True), (b, False)):
            count += np.bincount(pair[y[pair % n] == kind] // n, minlength=1 << BITS)
        owners.append(w.row[first] + lo)
        total += len(first)
    if not total or not y.any() or y.all():
        return model
    owner = np.concatenate(owners)
    na, nb = y.sum(), n - y.sum()
    expected = (a + b) * na / n
    lr = 2 * (a * np.log(np.maximum(a, 1e-9) / np.maximum(expected, 1e-9)) + b * np.log(np.maximum(b, 1e-9) / np.maximum((a + b) * nb / n, 1e-9)))
    used = np.flatnonzero((a + b > 1) & (a > expected) & (lr > EVIDENCE))
    # no bias may make a long text toxic by its length
    most = np.quantile(np.bincount(owner, minlength=n), 0.999)
    bias = highest = min(START, -np.log(20 * max(most, 1)))
    if len(used):
        place = np.full((1 << BITS) + 1, -1)
        place[used] = np.arange(len(used))
        rows, columns = [], []
        for f, s in parts:
            c = place[f]
            r, k = np.nonzero(c >= 0)
            rows.append(s[r])
            columns.append(c[r, k])
        rows, columns = np.concatenate(rows), np.concatenate(columns)
        w = np.log((a[used] + 0.5) / na / ((b[used] + 0.5) / nb)) / 2
        moment, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
        for t in range(1, epochs + 1):
            logit = np.bincount(rows, w[columns], total) + bias
            p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            calm = np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-9)), n)
            # slope of the log-likelihood by a sentence's logit: p (1 - score) / score in toxic documents, -p in others
            slope = p * np.where(y, np.exp(calm) / np.maximum(-np.expm1(calm), 1e-9), -1.0)[owner]
            g = np.append(np.bincount(columns, slope[rows], len(w)) - DECAY * w, slope.sum())
            moment, second = 0.9 * moment + 0.1 * g, 0.99 * second + 0.01 * g**2
            step = RATE * moment / (1 - 0.9**t) / (np.sqrt(second / (1 - 0.99**t)) + 1e-6)
            w, bias = w + step[:-1], min(bias + step[-1], highest)
        model.weights[used] = w
    model.bias = float(bias)
    return model


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, seed: int = 0) -> Model:
    """Fitted on labelled rows that aren't held out (crc32 of doc_id mod 4 is not 2), at most about max_rows of them."""
    label = own_columns(labels, "doc_id", "toxic").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    label = label.where("doc_id IS NOT NULL AND toxic IS NOT NULL AND crc32(cast(doc_id AS string)) % 4 <> 2").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = label.count()
    if n > max_rows:
        share = int(max_rows / n * (1 << 31))
        label = label.where(F.xxhash64(F.lit(seed), "doc_id").bitwiseAND(F.lit(0x7FFFFFFF)) < share)
    rows = own_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    some = rows.join(F.broadcast(label), "doc_id").select("doc_id", "text", "toxic")  # label: about max_rows rows

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(batches, schema=some_schema).sort_by([("doc_id", "ascending"), ("text", "ascending")])
        model = fit([t or "" for t in got.column("text").to_pylist()], got.column("toxic").to_numpy() > 0)
        used = np.flatnonzero(model.weights)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(model.weights[used], model.bias))], ["feature", "weight"])

    some_schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("toxic", pa.int32())])
    # fitted by one task: the sample is bounded, and the driver's memory stays free
    got = some.repartition(1).mapInArrow(lean(fitted), "feature long, weight double").toArrow()
    feature, weight = got.column("feature").to_numpy(), got.column("weight").to_numpy()
    model = Model(np.zeros(1 << BITS), START)
    model.weights[feature[feature >= 0]] = weight[feature >= 0]
    if (feature < 0).any():
        model.bias = float(weight[feature < 0][0])
    return model


@dataclass
class Scored:
    """A slice's texts: scores, and per sentence its score, its text's row, and the bytes of its begin and end."""

    score: np.ndarray
    sentence: np.ndarray
    owner: np.ndarray
    start: np.ndarray
    end: np.ndarray


def _scored(data: np.ndarray, at: np.ndarray, m: Model) -> Scored:
    """Scores of a slice's texts. A huge text is read in parts, whose sentences go on where the part before ends inside one."""
    if is_huge(data, at):
        logit, start, end = [np.zeros(0)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for lo, hi in parts(data):
            f, s, w = features(data[lo:hi], np.array([0, hi - lo]))
            if not len(s):
                continue
            x = sentence_logits(f, s, m) - m.bias
            first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
            begin, stop = w.start[first] + lo, w.end[np.append(first[1:], len(s)) - 1] + lo
            if len(end[-1]) and not _STOP[data[end[-1][-1] - 1 : begin[0]]].any():
                logit[-1][-1] += x[0]
                end[-1][-1] = stop[0]
                x, begin, stop = x[1:], begin[1:], stop[1:]
            if len(x):
                logit.append(x)
                start.append(begin)
                end.append(stop)
        logit, start, end = np.concatenate(logit) + m.bias, np.concatenate(start), np.concatenate(end)
        owner = np.zeros(len(logit), np.int64)
    else:
        f, s, w = features(data, at)
        logit = sentence_logits(f, s, m)
        first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
        start, end, owner = w.start[first], w.end[np.append(first[1:], len(s))[: len(first)] - 1], w.row[first]
    p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return Scored(-np.expm1(np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-12)), len(at) - 1)), p, owner, start, end)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, score, sentence (the worst one's number, null without one), sentence_start, sentence_end (its bytes), sentence_score."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(shared.value[0].astype(np.float64), shared.value[1])
        names = ["doc_id", "score", "sentence_start", "sentence_end", "sentence_score"]
        for b in batches:
            for lo, hi, data, at in slices(b.column("text")):
                n = hi - lo
                got = _scored(data, at, m)
                p, owner, first = got.sentence, got.owner, np.arange(len(got.owner))
                order = np.lexsort((first, -p, owner))
                worst = order[np.concatenate([[True], owner[order][1:] != owner[order][:-1]])] if len(order) else order
                start, end, top = np.full(n, -1), np.full(n, -1), np.zeros(n)
                who = owner[worst]
                start[who], end[who], top[who] = got.start[worst] - at[who], got.end[worst] - at[who], p[worst]
                none = pa.array(start < 0)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, n), pa.array(got.score), *(pa.compute.if_else(none, pa.scalar(None, x.type), x) for x in map(pa.array, (start, end, top)))], names)

    import pyarrow.compute  # noqa: F401, PLC0415  for pa.compute

    rows = own_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, sentence_start long, sentence_end long, sentence_score double")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs whose text scores below threshold, with all their columns; scored in place, so no row is matched by its id."""
    model = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(shared.value[0].astype(np.float64), shared.value[1])
        for b in batches:
            for lo, hi, data, begins in slices(b.column(at)):
                yield b.slice(lo, hi - lo).filter(pa.array(_scored(data, begins, m).score < threshold))

    return docs.mapInArrow(run, docs.schema)
