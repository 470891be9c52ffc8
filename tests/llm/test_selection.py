"""Hard negatives, the filter audit and the quality ratio against plain loops."""

import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

from quillstone.llm import audit, negatives, quality, queries

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
VECTORS = "vec_id long, embedding array<float>, label int, `rank` int, score double, bin int, x string, d string"


# --- hard negatives ---------------------------------------------------------------------------------------------------------------------


def plain_negatives(rows, is_anchor):
    """rows: (vec_id, vector, label). What mine() returns, by definition."""
    take = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        x = [math.floor(256 * float(np.float32(c))) for c in v]
        if any(abs(256 * float(np.float32(c))) >= math.sqrt(2**62 / max(1, len(x))) for c in v):
            continue
        take[i] = min(take.get(i, (label, x)), (label, x))
    sizes = [len(x) for _, x in take.values()]
    most = min(set(sizes), key=lambda n: (-sizes.count(n), n)) if sizes else 0
    take = {i: r for i, r in take.items() if len(r[1]) == most}
    out = []
    for a, (label, x) in take.items():
        if not is_anchor(a):
            continue
        scores = sorted((-sum(p * q for p, q in zip(x, y, strict=True)), i, other == label) for i, (other, y) in take.items() if i != a)
        for s, p, _ in [r for r in scores if r[2]][:5]:
            fit = [(-n, i) for n, i, same in scores if not same and 50 * -s <= 100 * -n <= 95 * -s]
            out += [(a, p, k + 1, i, -s, n) for k, (n, i) in enumerate(fit[:3])]
    return sorted(out)


def clustered(n, clusters=12, dim=6, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    x = (centres[rng.integers(0, clusters, n)] + 0.05 * rng.normal(size=(n, dim))).astype(np.float32)
    return [(i, [float(c) for c in v], int(label)) for i, (v, label) in enumerate(zip(x, rng.integers(0, 3, n), strict=True))]


def mined(spark, rows, anchor="vec_id % 20 = 0"):
    df = spark.createDataFrame([(*r, 1, 0.5, 3, "x", "d") for r in rows], VECTORS)
    return sorted(tuple(r) for r in negatives.mine(df, anchor).collect())


def test_negatives_against_a_loop_over_odd_rows(spark):
    rows = clustered(120)
    rows += [(0, rows[3][1], 2), (0, rows[3][1], 2), (20, rows[5][1], 0), (None, rows[1][1], 1), (1001, None, 1), (1002, [], 1), (1003, [0.0] * 6, 1), (1004, [float("nan")] * 6, 1), (1005, [float("inf")] + [0.0] * 5, 0), (1006, [None] + [0.0] * 5, 0)]
    rows += [(1010, rows[8][1], None), (1020, rows[8][1][:3], 1), (1040, [1e30] * 6, 1), (1060, [-c for c in rows[8][1]], 2)] + [(2000 + i, rows[7][1], i % 2) for i in range(40)]
    want = plain_negatives(rows, lambda i: i % 20 == 0)
    assert want and mined(spark, rows) == want


def test_blocks_rings_and_bounds_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 16)
    monkeypatch.setattr(negatives, "BLOCK_ASKS", 4)
    monkeypatch.setattr(negatives, "PIVOTS", 6)
    monkeypatch.setattr(negatives, "SAMPLE_ROWS", 200)
    rows = clustered(700, seed=2)
    assert mined(spark, rows, "vec_id % 35 = 0") == plain_negatives(rows, lambda i: i % 35 == 0)


def test_large_components_are_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1, 1]) * rng.uniform(2e5, 2e6) for _ in range(4)], i % 2) for i in range(60)]
    assert mined(spark, rows) == plain_negatives(rows, lambda i: i % 20 == 0)


def test_no_vectors_and_lone_vectors(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0, 2.0], 1)]) == []
    assert mined(spark, [(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1)]) == []


def test_brackets_hold_every_score():
    rng = np.random.default_rng(5)
    x = np.floor(256 * rng.normal(size=(500, 8)))
    largest = int((x**2).sum(axis=1).max())
    p = negatives.chosen_pivots(x[:200], largest, len(x), 9)
    d, qd, norm = p.of_rows(x), p.distances(x, np.zeros(len(x))), (x**2).sum(axis=1)[:, None]
    near = np.abs(qd[:, None, :] - d[None, :, :]).max(axis=2)
    far = (qd[:, None, :] + d[None, :, :]).min(axis=2)
    s = x @ x.T
    high, low = p.score(norm, near), p.score(norm, far)
    assert (s <= high + p.slack(norm)).all() and (s >= low - p.slack(norm)).all()
    assert (high < high.max()).any() and len(np.unique(p.bins(d))) == len(p.x)


def test_the_band_is_exact_for_any_score():
    for s in [-7, 0, 1, 2, 3, 99, 100, 101, 10**17 + 3, 2**61]:
        low, high = negatives.band(np.array([s]))
        assert low[0] == -(-50 * s // 100) and high[0] == 95 * s // 100


# --- filter audit -----------------------------------------------------------------------------------------------------------------------


def plain_audit(rows, labels):
    """rows: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    smallest = {}
    key = lambda i: 2**63 if i is None else i
    for i, t, _ in rows:
        smallest[t or ""] = min(smallest.get(t or "", 2**64), key(i))
    parts = {}
    for i, t, s in rows:
        t = t or ""
        w = SPACE.findall(t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": key(i) > smallest[t]}
        parts.setdefault(s or "", []).append(({f for f in fails if fails[f]}, i in good, i in toxic))
    out, total = [], {}
    for part, docs in parts.items():
        for order in itertools.permutations("ABCDE"):
            alive = docs
            for step, f in enumerate(order):
                gone = [d for d in alive if f in d[0]]
                kept = [d for d in alive if f not in d[0]]
                failing = sum(f in d[0] for d in docs)
                out.append([part, "".join(order), step + 1, len(kept), len(gone), failing - len(gone), sum(d[0] == {f} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone), f])
                total[part, f] = total.get((part, f), 0) + len(gone)
                alive = kept
    return sorted((*r[:-1], total[r[0], r[-1]]) for r in out)


def odd_texts():
    rng = random.Random(7)
    words = ["the", "The", "of", "#x", "été", "ÉTÉ", "A|B", "WORD", "x y", "\x1fq"]
    texts = [None, "", " \n\t", "a " * 60, " ".join(f"w{i}" for i in range(50)), " ".join(f"w{i}" for i in range(49)), "É" * 30, "A" * 30]
    texts += [" ".join(rng.choice(words) + str(rng.randrange(30)) for _ in range(rng.randrange(1, 90))) for _ in range(25)]
    rows = [(i, t, [None, "", "s1", "s2"][i % 4]) for i, t in enumerate(texts)]
    rows += [(100 + i, texts[9], "hot") for i in range(60)] + [(-5, texts[9], "s1"), (-5, texts[9], "s2"), (None, texts[9], "s1"), (None, "alone", "s1"), (None, "alone", None), (2**63 - 1, "alone", "s1")]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 110, 2)] + [(4, 1, 1), (None, 1, 1), (7, None, 1), (2**63 - 1, 1, 0)]
    return rows, [(i, None if q is None else int(q), int(t)) for i, q, t in labels]


def test_audit_against_a_loop(spark):
    rows, labels = odd_texts()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, mask int, part string").repartition(5)
    said = spark.createDataFrame([(*r, "e") for r in labels], "doc_id long, quality int, toxic int, text string")
    got = audit.audit(docs, said)
    assert got.columns == ["part", "filter_order", "step", *audit.COUNTS, "shapley"]
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(rows, labels)


def test_audit_of_nothing(spark, no_docs):
    assert audit.audit(no_docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_chains_flush_and_tell_colliding_texts_apart(monkeypatch):
    monkeypatch.setattr(audit, "HELD_BYTES", 64)
    rng = random.Random(11)
    texts = [f"text {i} " * 3 for i in range(20)]
    rows = [(f"p{rng.randrange(3)}", rng.randrange(200), rng.choice([texts[0], rng.choice(texts)])) for _ in range(500)]
    # two fingerprints for all texts: every chain holds several
    routed = [r for k in range(4) for r in audit._route([(p, i, t, int(t.split()[1]) % 2) for p, i, t in rows[k::4]])]
    assert any(r[1][0] is None for r in routed) and len(routed) > 20
    settled = [x for k in range(2) for x in audit._settle([r for r in routed if r[0] % 2 == k])]
    got = sorted((i, p, bool(mask & audit.COPY)) for i, p, mask, n in settled for _ in range(n))
    first = {t: min(i for _, i, u in rows if u == t) for t in texts}
    assert got == sorted((i, p, i > first[t]) for p, i, t in rows)


def test_failures_of_a_huge_text_are_those_of_the_whole(monkeypatch):
    text = ("w%d " * 7 % tuple(range(7)) + "x\n") * 700_000
    assert len(text) > 1 << 22
    assert audit.failures(text.encode(), len(text)) == 0b0010
    wide = " ".join(str(i) for i in range(900_000))
    assert audit.failures(wide.encode(), len(wide)) == 0


# --- quality ratio ----------------------------------------------------------------------------------------------------------------------


def plain_counts(text):
    text = text or ""
    w = SPACE.findall(text)
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    five = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    again = {f for f in five if five.count(f) > 1} if len(five) < 500 else {f for f, n in __import__("collections").Counter(five).items() if n > 1}
    covered = {i + k for i, f in enumerate(five) if f in again for k in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_plain_counts_of_odd_texts(spark, odd_docs):
    rng = random.Random(13)
    more = [(100 + k, " ".join(rng.choice(["a", "A", "b|", "été", "x y"]) for _ in range(rng.randrange(60))).replace(" b| ", "\nb|\n"), "en", "s", 1, 1, "x", 1, "c") for k in range(60)]
    docs = odd_docs.unionByName(spark.createDataFrame(more, odd_docs.schema))
    got = quality.scored(docs, np.zeros(quality.BUCKETS)).collect()
    want = sorted(((r.doc_id is None, r.doc_id or 0), *plain_counts(r.text)) for r in docs.collect())
    assert sorted(((r[0] is None, r[0] or 0), *r[1:6]) for r in got) == want


def test_counts_of_a_huge_text_cross_its_parts(spark):
    text = "\n".join(f"line {i % 90_000} of some words here" for i in range(180_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = quality.scored(docs, np.zeros(quality.BUCKETS)).first()
    assert len(text) > 1 << 22 and tuple(r[1:6]) == plain_counts(text)


def test_the_ratio_is_that_of_the_counts(spark):
    """Scores by a dictionary of the n-grams themselves, where no two share a bucket but by chance."""
    texts = [(1, "alpha beta gamma delta"), (2, "alpha beta beta"), (3, "junk | junk | junk"), (None, "alpha"), (4, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, None), (2, 1), (3, 0), (None, 1)], "doc_id long, quality int")
    ratio = quality.train(docs, labels)

    def grams(t):
        w = SPACE.findall(t or "")
        b = (t or "").encode()
        return [("w", x) for x in w] + [("p", "twice" if x == y else (x, y)) for x, y in itertools.pairwise(w)] + [("b", b[i : i + 4]) for i in range(len(b) - 3)]

    raw, target = {}, {}
    for i, t in texts:
        for g in grams(t):
            raw[g] = raw.get(g, 0) + 1
            target[g] = target.get(g, 0) + (i in (1, 2))
    scale = sum(target.values()) / sum(raw.values())
    for r in quality.scored(docs, ratio).collect():
        g = grams(dict(texts)[r.doc_id])
        want = sum(math.log(target[x] + quality.PRIOR) - math.log(raw[x] * scale + quality.PRIOR) for x in g) / max(1, len(g))
        assert r.n_grams == len(g) and r.score == pytest.approx(want, abs=2e-3)


def test_no_labels_no_documents(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert not quality.train(odd_docs, none).any()
    judged = quality.judged(odd_docs, quality.train(odd_docs, none))
    assert judged.count() == odd_docs.count() and judged.where("kept AND base_failed").count() == 0
    assert quality.judged(no_docs, quality.train(no_docs, none)).count() == 0


def test_held_out_documents_are_told_apart(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    ratio = quality.train(docs, labels.where("crc32(cast(doc_id AS string)) % 4 <> 2"))
    rows = [r for r in quality.judged(docs, ratio).join(labels, "doc_id").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and not r.base_failed]
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert len(good) > 60 and len(bad) > 8 and all(good) and not any(bad)


def test_verdicts_do_not_hang_on_the_layout(spark):
    one = queries.op13_quality_ratio(spark, "/root/testdata/sf0.001")
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    dealt = docs.repartition(7, "text")
    two = quality.judged(dealt, quality.train(dealt, labels.repartition(3)))
    assert sorted(map(tuple, one.select("doc_id", "kept", "n_words").collect())) == sorted(map(tuple, two.select("doc_id", "kept", "n_words").collect()))
