"""Language-model scores: an add-one unigram base, and a log-bilinear model trained with noise-contrastive estimation.

Tokens are lower-cased words and one end per text. Counts of all training tokens are gathered by 64-bit word numbers into one table
(a row per distinct token). The neural model predicts classes of tokens, in number ``2.5 * sqrt(V)``, so they grow with the vocabulary: the most frequent words
have half of the classes to themselves, all others share the rest by how they begin. A context's vector is the sum of the vectors of the last
``CONTEXT`` tokens' classes, each scaled by position. Classes lie in groups of the square root of their number: the products of the context's vector with all
groups' vectors, and then with those of the token's group, give normalised log-probabilities of the group and of the class in it (their powers of e
are products of powers for each position, taken once for classes that repeat); a word has within its class the probability
(c + 1) / (N of the class + V of the class + 1). The log-probabilities of a text's tokens add up to its score.

Training learns from every training text: texts become class numbers and are dealt by a hash of id and text to parts and to rounds. In a round each part goes on
from the common model over its texts in the order of that hash, and the parts' models are averaged in whole numbers; so how the input is split
changes nothing. Parts grow in number and in length with the corpus. Counts of the most frequent tokens (``HEAD``) are broadcast; a text's
other tokens meet the count table in a shuffled join, so nothing that is broadcast grows with the vocabulary but the model, with its square root.

Nulls: a null text is empty and has the end alone. A null doc_id isn't held out. Rows that repeat a doc_id are scored (and counted) each; of rows that
repeat id and text the model may learn once. With no training text all counts are 0. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, own_columns
from .words import U, Words, is_huge, mix, parts, slices

HEAD = 1 << 17
CONTEXT, SIZE, LEAST_CLASSES = 3, 16, 64
#: Noise groups of a batch and noise classes of each group; tokens of a batch; the step, and what each weight's sum of squares starts with.
NOISE, BATCH, RATE, BEGUN = (12, 4), 2048, 0.1, 1.0
#: Bits of the tables in which the most frequent tokens are looked up.
SLOTS = 19
#: Beginnings of words that shared classes tell apart before they look at a third byte.
BEGINNINGS = 1024
#: Training tokens of the first part, and that a model sees at least, in at most PASSES passes; shares of the texts by round, in 64ths.
PART_TOKENS, PASSES, ROUNDS = 1 << 22, 4, (4, 12, 16, 32)
END = int(mix(np.array([0xE0D], U))[0])
END_CLASS = 0
#: Weights are averaged as whole numbers of this part of one.
_UNIT = 2.0**-36
#: Exponents up to which powers of e are taken as they are, and powers for the groups' vectors that a task holds at most; tokens scored at a time, and
#: rows of powers multiplied at a time; rows from which classes that repeat are looked for, and distinct ones to a row below which they are used.
LARGEST, POWERS, SCORED, BLOCK, MANY, REPEATED = 600.0, 1 << 23, 1 << 17, 1 << 11, 256, 0.75
#: Weights that are added up in one row.
CHUNK = 1024


def tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of all tokens of a slice, what shared class they go by (31 bits of how they begin), and where each text's begin; each text ends with END."""
    if not is_huge(data, at):
        return _tokens(data, at)
    found = [_tokens(data[a:b], np.array([0, b - a]))[:2] for a, b in parts(data)]
    out, form = (np.concatenate([*(x[k][:-1] for x in found), found[-1][k][-1:]]) for k in (0, 1))  # one end
    return out, form, np.array([0, len(out)])


def _tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    w = Words(data, at)
    rows = len(w.count)
    first = w.first + np.arange(rows + 1)
    out, form = np.full(first[-1], U(END)), np.zeros(first[-1], np.int64)
    where = np.arange(len(w.hash)) + w.row
    out[where] = w.hash
    if len(w.hash):
        two, three = (w.upto(np.minimum(w.start + k, w.end)) for k in (2, 3))
        form[where] = ((two >> U(48)) << U(15) | three >> U(49)).astype(np.int64)
    return out, form, first


def shape(distinct: int) -> tuple[int, int, int]:
    """(groups, classes of a group, words with a class of their own) for a vocabulary."""
    side = max(int(np.ceil(np.sqrt(max(LEAST_CLASSES, 2.5 * np.sqrt(distinct))))), 2)
    return side, side, min(side * side // 2 - 1, HEAD - 1)


def _runs(index: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows in the order of their index, the distinct values, and where each one's rows begin."""
    order = np.argsort(index.astype(np.uint16) if len(index) and index.max() < 1 << 16 else index, kind="stable")  # few bits sort faster
    sorted_ = index[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    return order, sorted_[first], first


def _places(index: np.ndarray, upto: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of index (all below upto), and each one's place among them."""
    seen, place = np.zeros(upto, bool), np.empty(upto, np.int64)
    seen[index] = True
    which = np.flatnonzero(seen)
    place[which] = np.arange(len(which))
    return which, place[index]


def _sums(values: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows of values (or of numbers) that have one index, by what _runs gives for the indices."""
    return np.add.reduceat(values.take(order, axis=0), first, axis=0)


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, b)


@dataclass
class Model:
    """Vectors of classes as context, the scale of each position, and vectors and biases of groups and classes as output."""

    context: np.ndarray
    scale: np.ndarray
    group: np.ndarray
    group_bias: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    @classmethod
    def new(cls, counts: np.ndarray, groups: int, seed: int = 0) -> Model:
        """counts: by class. Biases start as the classes' own frequencies."""
        rng, n = np.random.default_rng(seed), len(counts)
        p_group, p_class = frequencies(counts, groups)
        vectors = lambda k: rng.normal(0, 0.1, (k, SIZE)).astype(np.float32)
        return cls(vectors(n), np.ones((CONTEXT, SIZE), np.float32), vectors(groups), np.log(p_group).astype(np.float32), vectors(n), np.log(p_class).astype(np.float32))

    @property
    def parts(self) -> list[np.ndarray]:
        return [self.context, self.scale, self.group, self.group_bias, self.output, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parts])

    @classmethod
    def of(cls, flat: np.ndarray, groups: int, classes: int) -> Model:
        shapes = [(classes, SIZE), (CONTEXT, SIZE), (groups, SIZE), (groups,), (classes, SIZE), (classes,)]
        ends = np.cumsum([0, *(int(np.prod(x)) for x in shapes)])
        return cls(*(flat[a:b].reshape(x).copy() for a, b, x in zip(ends[:-1], ends[1:], shapes, strict=True)))


def frequencies(counts: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """The groups' frequencies, and each class's in its group; a class that nothing holds counts as one token."""
    c = (counts + 1.0).reshape(groups, -1)
    return c.sum(axis=1) / c.sum(), (c / c.sum(axis=1, keepdims=True)).ravel()


def contexts(classes: np.ndarray, first: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """(tokens lo to hi - 1 x CONTEXT) classes before each token, the nearest first; before a text stand ends."""
    a, b = np.searchsorted(first, [lo, hi - 1], "right") - 1
    begin = first[a : b + 1]
    place = np.arange(lo, hi) - np.repeat(begin, np.diff(np.append(np.maximum(begin, lo), hi)))
    out = np.full((hi - lo, CONTEXT), END_CLASS, classes.dtype)
    for k in range(1, CONTEXT + 1):
        from_ = max(lo - k, 0)
        if from_ + k >= hi:
            break
        out[from_ + k - lo :, k - 1] = np.where(place[from_ + k - lo :] >= k, classes[from_ : hi - k], END_CLASS)
    return out


class Learner:
    """Noise-contrastive estimation over batches of tokens, first of a token's group, then of its class among the group's; Adagrad."""

    def __init__(self, model: Model, squares: Model, counts: np.ndarray, seed: list[int]):
        self.model, self.squares, self.rng = model, squares, np.random.default_rng(seed)
        groups = len(model.group)
        self.p_group, self.p_class = frequencies(counts, groups)
        self.upto_group, self.upto = np.cumsum(self.p_group), np.cumsum(self.p_class.reshape(groups, -1), axis=1)
        self.upto_group /= self.upto_group[-1]
        self.log_group, self.log_class = np.log(NOISE[0] * self.p_group).astype(np.float32), np.log(NOISE[1] * self.p_class).astype(np.float32)

    def step(self, name: str, index: np.ndarray | slice, g: np.ndarray) -> None:
        x, s = getattr(self.model, name), getattr(self.squares, name)
        s[index] += g**2
        x[index] += np.float32(RATE) * g / np.sqrt(s[index])

    def learn(self, t: np.ndarray, c: np.ndarray) -> None:
        """One batch: classes and their contexts."""
        m, side = self.model, self.upto.shape[1]
        sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
        vectors = [m.context.take(c[:, k], axis=0) for k in range(CONTEXT)]
        q = sum(v * m.scale[k] for k, v in enumerate(vectors))
        g = t // side
        order, groups, first = _runs(g)
        of = list(zip(groups.tolist(), first.tolist(), [*first[1:].tolist(), len(g)], strict=True))  # group, and its rows in order
        # groups: the same noise for the whole batch
        noise = self.upto_group.searchsorted(self.rng.random(NOISE[0]), "right")
        near = m.group.take(g, axis=0)
        good = 1 - sigmoid(_dots(q, near) + (m.group_bias - self.log_group)[g])
        bad = -sigmoid(q @ m.group[noise].T + (m.group_bias - self.log_group)[noise])
        grad_q = good[:, None] * near + bad @ m.group[noise]
        into, bias = np.zeros_like(m.group), np.zeros_like(m.group_bias)
        into[groups], bias[groups] = _sums(good[:, None] * q, order, first), _sums(good, order, first)
        np.add.at(into, noise, bad.T @ q)
        np.add.at(bias, noise, bad.sum(axis=0))
        # classes: each group has noise of its own
        place = (self.upto[:, None, :-1] < self.rng.random((len(m.group), NOISE[1], 1))).sum(axis=2)
        others = place + np.arange(len(m.group))[:, None] * side
        near = m.output.take(t, axis=0)
        good = 1 - sigmoid(_dots(q, near) + m.bias[t] - self.log_class[t])
        grad_q += good[:, None] * near
        sorted_q, sorted_g, near = q.take(order, axis=0), g[order], m.output[others]
        s, pull = np.empty((len(g), NOISE[1]), np.float32), np.empty_like(q)
        for group, a, b in of:
            np.dot(sorted_q[a:b], near[group].T, out=s[a:b])
        bad = -sigmoid(s + (m.bias[others] - self.log_class[others]).take(sorted_g, axis=0))
        pushed = np.empty((len(of), NOISE[1], SIZE), np.float32)
        for i, (group, a, b) in enumerate(of):
            np.dot(bad[a:b], near[group], out=pull[a:b])
            np.dot(bad[a:b].T, sorted_q[a:b], out=pushed[i])
        pushed_bias = np.add.reduceat(bad, first, axis=0)
        grad_q[order] += pull
        order, rows, first = _runs(np.concatenate([t, others[groups].ravel()]))
        self.step("output", rows, _sums(np.concatenate([good[:, None] * q, pushed.reshape(-1, SIZE)]), order, first))
        self.step("bias", rows, _sums(np.concatenate([good, pushed_bias.ravel()]), order, first))
        self.step("group", slice(None), into)
        self.step("group_bias", slice(None), bias)
        order, rows, first = _runs(c.T.ravel())
        sums = _sums(np.concatenate([grad_q * x for x in m.scale]), order, first)
        self.step("scale", slice(None), np.stack([np.einsum("ij,ij->j", grad_q, v) for v in vectors]))
        self.step("context", rows, sums)


class Scorer:
    """Normalised log-probabilities by a model.

    A power of e of a sum of products is the product of one power for each position of the context, and those repeat. For the groups' vectors they are taken
    once for each class and position; for the classes of a group, and for groups beyond POWERS, once for each that occurs in a batch, if that is less work.
    """

    def __init__(self, model: Model):
        context_, scale, self.group, self.group_bias, self.output, self.bias = (x.astype(np.float64) for x in model.parts)
        self.side = len(self.output) // len(self.group)
        self.vectors = [context_ * s for s in scale]
        few = CONTEXT * len(self.output) * len(self.group) <= POWERS
        self.powers = self._powers(self.vectors, self.group, self.group_bias) if few else None

    @staticmethod
    def _powers(vectors: list[np.ndarray], output: np.ndarray, bias: np.ndarray) -> list[np.ndarray] | None:
        """By position e to the products of its vectors and output's, the first with the bias; None if a product of them may leave a double's range."""
        found = [v @ output.T for v in vectors]
        found[0] += bias
        if not sum(max(s.max(), -s.min()) for s in found) < LARGEST:
            return None
        return [np.exp(s, out=s) for s in found]

    @staticmethod
    def _of_powers(powers: list[np.ndarray], rows: list[np.ndarray], own: np.ndarray) -> np.ndarray:
        """Log-probabilities of own, for rows of each position's powers."""
        out, ones = np.empty(len(own)), np.ones(powers[0].shape[1])
        for lo in range(0, len(own), BLOCK):
            p = powers[0].take(rows[0][lo : lo + BLOCK], axis=0)
            for x, at in zip(powers[1:], rows[1:], strict=True):
                p *= x.take(at[lo : lo + BLOCK], axis=0)
            out[lo : lo + BLOCK] = p[np.arange(len(p)), own[lo : lo + BLOCK]] / (p @ ones)
        return np.log(out, out=out)

    def _of_sums(self, rows: list[np.ndarray], output: np.ndarray, bias: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The same from classes at each position, with a power of e for each row and each of output's vectors."""
        out, ones, output = np.empty(len(own)), np.ones(len(output)), output.T
        for lo in range(0, len(own), BLOCK):
            s = sum(v.take(c[lo : lo + BLOCK], axis=0) for v, c in zip(self.vectors, rows, strict=True)) @ output
            s += bias
            if s.max() > LARGEST or s.min() < -LARGEST:
                s -= s.max(axis=1, keepdims=True)
            mine = s[np.arange(len(s)), own[lo : lo + BLOCK]]
            np.exp(s, out=s)
            out[lo : lo + BLOCK] = mine - np.log(s @ ones)
        return out

    def _of_batch(self, rows: list[np.ndarray], output: np.ndarray, bias: np.ndarray, own: np.ndarray) -> np.ndarray:
        """By whichever takes fewer powers."""
        if len(own) >= MANY:
            which, places = zip(*(_places(c, len(self.output)) for c in rows), strict=True)
            if sum(len(x) for x in which) < REPEATED * len(own):
                powers = self._powers([v[x] for v, x in zip(self.vectors, which, strict=True)], output, bias)
                if powers is not None:
                    return self._of_powers(powers, list(places), own)
        return self._of_sums(rows, output, bias, own)

    def log_probabilities(self, classes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Natural logarithms of the normalised probabilities of each token's class; first: where texts begin, and the last ends."""
        out = np.empty(len(classes))
        for lo in range(0, len(classes), SCORED):
            t = classes[lo : lo + SCORED]
            rows = list(np.ascontiguousarray(contexts(classes, first, lo, lo + len(t)).T))
            g = t // self.side
            p = self._of_batch(rows, self.group, self.group_bias, g) if self.powers is None else self._of_powers(self.powers, rows, g)
            order, which, begin = _runs(g)
            place, rows, of_class = (t - g * self.side)[order], [c[order] for c in rows], np.empty(len(t))
            for k, a, b in zip(which.tolist(), begin.tolist(), [*begin[1:].tolist(), len(t)], strict=True):
                mine = slice(k * self.side, (k + 1) * self.side)
                of_class[a:b] = self._of_batch([c[a:b] for c in rows], self.output[mine], self.bias[mine], place[a:b])
            p[order] += of_class
            out[lo : lo + len(t)] = p
        return out


def log_probabilities(model: Model, classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """As Scorer's, for one call."""
    return Scorer(model).log_probabilities(classes, first)


class Head:
    """Counts and classes of the most frequent tokens, looked up by number."""

    def __init__(self, number: np.ndarray, count: np.ndarray, own: int, classes: int):
        """By falling count; the end has class 0, the first so many words those that follow, all others share the rest by their form."""
        order = np.argsort(number)
        self.number, self.count = number[order], count[order]
        of = np.full(len(number), -1, np.int64)
        words = np.flatnonzero(number != U(END))[:own]
        of[words] = 1 + np.arange(len(words))
        of[number == U(END)] = END_CLASS
        self.own, self.first_shared, self.shared = of[order], 1 + own, classes - 1 - own
        # places by bits of the number: a table for all, one for those whose bits are taken in it, and so on
        self.tables, left, shift = [], np.arange(len(number)), 64 - SLOTS
        while len(left):
            slot = self._slot(self.number[left], shift)
            table = np.zeros(1 << SLOTS, np.int32)
            table[slot] = left
            self.tables.append((shift, table))
            left, shift = left[table[slot] != left], shift - 9
            if shift < 0:
                break
        self.rare = left  # alike in all tables: looked up by order
        self.finer = max(1, self.shared // BEGINNINGS)

    @staticmethod
    def _slot(number: np.ndarray, shift: int) -> np.ndarray:
        return ((number >> U(shift)) & U((1 << SLOTS) - 1)).astype(np.int64)

    def by_form(self, form: np.ndarray) -> np.ndarray:
        """Shared classes: by a word's first two bytes, and where there are classes enough, by the third as well."""
        return self.first_shared + (form >> 15) % (self.shared // self.finer) * self.finer + (form & 0x7FFF) % self.finer

    def find(self, number: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count (-1 if not in the head), class, and whether the class is its own."""
        is_end = number == U(END)
        count, own = np.full(len(number), -1, np.int64), np.full(len(number), -1, np.int64)
        todo = np.arange(len(number))
        for shift, table in self.tables:
            n = number[todo]
            at = table[self._slot(n, shift)]
            here = self.number[at] == n
            found, at = todo[here], at[here]
            count[found], own[found] = self.count[at], self.own[at]
            todo = todo[~here]
        if len(self.rare):
            at = self.rare[np.minimum(np.searchsorted(self.number[self.rare], number[todo]), len(self.rare) - 1)]
            here = self.number[at] == number[todo]
            count[todo[here]], own[todo[here]] = self.count[at[here]], self.own[at[here]]
        own[is_end] = END_CLASS
        return count, np.where(own >= 0, own, self.by_form(form)), own >= 0


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 7 == 2, F.lit(False))


def token_counts(docs: DataFrame) -> DataFrame:
    """number, form (what shared class it goes by) and c of every distinct token of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, data, at in slices(b.column("text")):
                n, form, _ = tokens(data, at)
                n, first, c = np.unique(n, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(n.view(np.int64)), pa.array(form[first].astype(np.int32)), pa.array(c)], ["number", "form", "c"])

    found = docs.select("text").mapInArrow(run, "number long, form int, c long")
    return found.groupBy("number", "form").agg(F.sum("c").alias("c"))


def _prepared(texts: pa.Array, head: Head):  # noqa: ANN202
    for lo, hi, data, at in slices(texts):
        n, form, first = tokens(data, at)
        yield lo, hi, n, first, *head.find(n, form)


@dataclass
class Fitted:
    """What scoring needs: the model, tokens and distinct words by class, and the counts of all training tokens (a table)."""

    model: Model
    head: Head
    n_class: np.ndarray
    v_class: np.ndarray
    total: int
    distinct: int
    counts: DataFrame


def _deal(training: DataFrame, head: Head, classes: int, parts: int, seed: int, kept: Broadcast) -> DataFrame:
    """Per text: part, round, h (its place in the part) and its tokens' classes."""
    kind = np.uint16 if classes <= 1 << 16 else np.uint32
    upto = np.cumsum(ROUNDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column("h").to_numpy().view(U)
            part, turn = (h % U(parts)).astype(np.int32), np.searchsorted(upto, (mix(h) >> U(58)).astype(np.int64), "right").astype(np.int32)
            for lo, hi, _, first, _, found, _ in _prepared(b.column("text"), kept.value):
                flat = found.astype(kind)
                ids = [flat[first[i] : first[i + 1]].tobytes() for i in range(hi - lo)]
                _, one = np.unique(h[lo:hi], return_index=True)  # of copies in a slice, one goes on
                one = np.sort(one)
                yield pa.RecordBatch.from_arrays([*(pa.array(x[lo:hi][one]) for x in (part, turn, h.view(np.int64))), pa.array([ids[i] for i in one], pa.binary())], ["part", "turn", "h", "ids"])

    rows = training.select(F.xxhash64(F.lit(seed), F.isnull("doc_id"), "doc_id", "text").alias("h"), "text")
    return rows.mapInArrow(run, "part int, turn int, h long, ids binary")


def _round(dealt: DataFrame, begun: Broadcast, groups: int, classes: int, seed: list[int]) -> DataFrame:
    """The parts' models after a round, added up: j, high and low (CHUNK numbers from j * CHUNK on, in whole units, by 32 bits each) and n (how many parts).

    The numbers are the weights and then the roots of their sums of squares.
    """
    number = np.uint16 if classes <= 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, held, n, learner, sums, models = None, None, [], 0, None, None, 0

        def work(least: int) -> None:
            """Learn from what is held, as long as that is so many tokens."""
            nonlocal held, n
            if n < max(least, 1):
                return
            flat, first = np.concatenate(held), np.concatenate([[0], np.cumsum([len(x) for x in held])])
            for lo in range(0, n, BATCH):
                hi = min(lo + BATCH, n)
                learner.learn(flat[lo:hi].astype(np.int64), contexts(flat, first, lo, hi))
            held, n = [], 0

        def close() -> None:
            nonlocal sums, models
            if learner is not None:
                work(0)
                x = np.rint(np.concatenate([learner.model.flat(), np.sqrt(learner.squares.flat())]).astype(np.float64) / _UNIT).astype(np.int64)
                x = np.stack([x >> 32, x & 0xFFFFFFFF])
                sums, models = x if sums is None else sums + x, models + 1

        for b in batches:
            for p, h, ids in zip(b.column("part").to_pylist(), b.column("h").to_pylist(), b.column("ids"), strict=True):
                if p != part:
                    close()
                    part, last = p, None
                    flat, squares, counts = begun.value
                    learner = Learner(Model.of(flat, groups, classes), Model.of(squares, groups, classes), counts, [*seed, p])
                if h != last:
                    last = h
                    held.append(np.frombuffer(ids.as_buffer(), number))
                    n += len(held[-1])
                    work(BATCH)
        close()
        if sums is not None:
            at = range(0, sums.shape[1], CHUNK)
            high, low = ([x[a : a + CHUNK].tobytes() for a in at] for x in sums)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(at))), pa.array(high, pa.binary()), pa.array(low, pa.binary()), pa.array(np.full(len(at), models))], ["j", "high", "low", "n"])

    def added(x):  # noqa: ANN001, ANN202  a pandas frame of one chunk
        total = lambda c: np.sum([np.frombuffer(b, np.int64) for b in x[c]], axis=0).tobytes()
        return x.iloc[:1].assign(high=[total("high")], low=[total("low")], n=[int(x["n"].sum())])

    rows = dealt.select("part", "h", "ids").repartition("part").sortWithinPartitions("part", "h")
    kind = "j long, high binary, low binary, n long"
    return rows.mapInArrow(run, kind).groupBy("j").applyInPandas(added, kind)


def fit(training: DataFrame, scratch: Scratch, seed: int = 0) -> Fitted:
    """Counts and the model of all texts of training (doc_id, text)."""
    spark = training.sparkSession
    counts = scratch.cut(token_counts(training))
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    groups, side, own = shape(distinct)
    classes = groups * side
    top = counts.orderBy(F.desc("c"), "number").limit(HEAD).select("number", "c", "form").toArrow()  # HEAD rows
    number, count, form = top.column("number").to_numpy().view(U), top.column("c").to_numpy(), top.column("form").to_numpy()
    head = Head(number, count, own, classes)
    n_class, v_class = np.zeros(classes), np.zeros(classes)
    k = F.expr(f"shiftright(form, 15) % {head.shared // head.finer} * {head.finer} + (form & 32767) % {head.finer}")
    for r in counts.groupBy(k.alias("k")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect():  # a row per shared class
        n_class[head.first_shared + r["k"]], v_class[head.first_shared + r["k"]] = r["n"], r["v"]
    form = form.astype(np.int64)
    _, of, is_own = head.find(number, form)
    shared = head.by_form(form[is_own])
    np.subtract.at(n_class, shared, count[is_own])
    np.subtract.at(v_class, shared, 1)
    n_class[of[is_own]], v_class[of[is_own]] = count[is_own], 1
    model = Model.new(n_class, groups, seed)
    if total:
        squares = Model.of(np.full(len(model.flat()), BEGUN, np.float32), groups, classes)
        kept = spark.sparkContext.broadcast(head)
        parts = max(1, round((total / PART_TOKENS) ** 0.75))
        dealt = scratch.cut(_deal(training, head, classes, parts, seed, kept))
        size = len(model.flat())
        passes = min(PASSES, -(-PART_TOKENS // total))
        for step in range(passes * len(ROUNDS)):
            begun = spark.sparkContext.broadcast((model.flat(), squares.flat(), n_class))
            got = _round(dealt.where(F.col("turn") == step % len(ROUNDS)), begun, groups, classes, [seed, step]).toArrow().sort_by("j")  # the model and its squares
            if len(got):  # a turn may have no text
                high, low = (np.frombuffer(b"".join(got.column(c).to_pylist()), np.int64) for c in ("high", "low"))
                mean = ((high * 2.0**32 + low) / got.column("n")[0].as_py() * _UNIT).astype(np.float32)
                model, squares = Model.of(mean[:size], groups, classes), Model.of(mean[size:] ** 2, groups, classes)
            begun.unpersist()
        scratch.drop(dealt)
    return Fitted(model, head, n_class, v_class, total, distinct, counts)


def score(docs: DataFrame, seed: int = 0) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    scratch = Scratch(docs.sparkSession, "lm")
    rows = own_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("held_out", held_out())
    return scored(rows, fit(rows.where("NOT held_out"), scratch, seed), scratch)


def scored(rows: DataFrame, fitted: Fitted, scratch: Scratch) -> DataFrame:
    """rows: doc_id, text, held_out."""
    model, counts, total = fitted.model, fitted.counts, fitted.total
    groups, classes = len(model.group), len(model.output)
    shared = rows.sparkSession.sparkContext.broadcast((fitted.head, model.flat(), fitted.n_class, fitted.v_class, float(total + fitted.distinct + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, flat, n_class, v_class, mass = shared.value
        scorer, log10_mass = Scorer(Model.of(flat, groups, classes)), np.log10(mass)
        within = np.log10(n_class + v_class + 1)
        for b in batches:
            for lo, hi, n, first, count, of, is_own in _prepared(b.column("text"), head):
                p = scorer.log_probabilities(of, first) / np.log(10)
                known = count >= 0
                logs = np.log10(np.maximum(count, 0) + 1.0)
                p += np.where(is_own, 0.0, np.where(known, logs, 0.0) - within[of])
                # the counts of other tokens come later, as log10(c + 1) for each of the two sums
                base = np.where(known, logs, 0.0) - log10_mass
                starts = first[:-1]
                sizes = np.diff(first)
                rest = np.flatnonzero(~known)
                owner = np.repeat(np.arange(hi - lo), sizes)[rest]
                order = np.lexsort((n[rest], owner))
                owner, number = owner[order], n[rest][order]
                new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (number[1:] != number[:-1])]) if len(owner) else np.zeros(0, bool)
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, len(owner)))
                offsets = np.concatenate([[0], np.cumsum(np.bincount(owner[at], minlength=hi - lo))]).astype(np.int32)
                is_end = number[at] == U(END)
                values = pa.StructArray.from_arrays([pa.array(number[at].view(np.int64)), pa.array(times.astype(np.int32)), pa.array(is_end)], ["number", "times", "is_end"])
                arrays = [b.column("uid").slice(lo, hi - lo), b.column("doc_id").slice(lo, hi - lo), b.column("held_out").slice(lo, hi - lo), pa.array(sizes.astype(np.int64))]
                arrays += [pa.array(np.add.reduceat(x, starts)) for x in (known.astype(np.int64), base, p)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.ListArray.from_arrays(pa.array(offsets), values)], ["uid", "doc_id", "held_out", "n_tokens", "n_head", "base", "p", "rest"])

    schema = "uid long, doc_id long, held_out boolean, n_tokens long, n_head long, base double, p double, rest array<struct<number: long, times: int, is_end: boolean>>"
    found = scratch.cut(rows.withColumn("uid", F.monotonically_increasing_id()).select("uid", "doc_id", "held_out", "text").mapInArrow(run, schema))
    rest = found.select("uid", F.explode("rest").alias("r")).select("uid", "r.*").join(counts.select("number", "c"), "number", "left")
    log = F.log10(F.coalesce("c", F.lit(0)) + F.lit(1.0)) * F.col("times")
    rest = rest.groupBy("uid").agg(F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("n_rest"), F.sum(log).alias("log_base"), F.sum(F.when(F.col("is_end"), 0.0).otherwise(log)).alias("log_score"))
    out = found.drop("rest").join(rest, "uid", "left")
    zero = F.lit(0.0)
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_head") + F.coalesce("n_rest", F.lit(0))).cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("log_base", zero)).alias("base_score"), (F.col("p") + F.coalesce("log_score", zero)).alias("score"),
    )
