import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from quillstone.llm import exact, neardup


def words(t):
    return re.findall(rb"[^\x20\x09-\x0D]+", bytes(b + 32 if 65 <= b <= 90 else b for b in (t or "").encode()))


def shingle_set(t):
    w = words(t)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows, percent=85):
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_fingerprints_compose():
    r = random.Random(1)
    for _ in range(50):
        t = r.randbytes(r.randint(0, 300))
        k = r.randint(0, len(t))
        whole = exact.fingerprint(t, chunk=7)
        assert whole == exact.chunk_hash(t)
        assert exact.combine(exact.chunk_hash(t[:k]), exact.chunk_hash(t[k:]), len(t) - k) == whole


def check_exact(docs, **kw):
    want = {}
    rows = [(r["doc_id"], normal(r["text"])) for r in docs.select("doc_id", "text").collect()]
    for i, t in rows:
        want.setdefault(t, []).append((i is None, i or 0))
    got = exact.exact_dedup(docs, **kw).collect()
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in want.items()}
    for r in got:
        v = by_sha[r["text_sha256"]]
        none, keep = min(v)
        assert (r["keep_id"], r["group_size"]) == (None if none else keep, len(v))
        assert r["kept"] == (r["doc_id"] == r["keep_id"])


def test_exact_on_a_table(spark, sf):
    check_exact(spark.read.parquet(f"{sf}/documents.parquet"))


@pytest.mark.parametrize("kw", [{}, {"huge": 50, "chunk": 16}, {"chunk": 16}])
def test_exact_odd(odd_docs, kw):
    check_exact(odd_docs, **kw)


def test_exact_of_the_largest_id(spark):
    rows = [(2**63 - 1, "a b"), (None, "a  b"), (None, "c"), (2**63 - 1, "d"), (0, "c e"), (None, "c e")]
    check_exact(spark.createDataFrame(rows, "doc_id long, text string"))


def test_huge_texts_are_cut_in_linear_time(spark):
    import time

    took = []
    for mb in (8, 32):
        docs = spark.range(3).selectExpr("id AS doc_id", f"concat(if(id = 2, 'x', ''), repeat('lorem  ipsum dolor ', {mb << 20} div 19)) AS text")
        t = time.time()
        got = {r["doc_id"]: r for r in exact.exact_dedup(docs).collect()}
        took.append(time.time() - t)
        assert [got[i]["keep_id"] for i in range(3)] == [0, 0, 2]
        assert got[0]["text_sha256"] == hashlib.sha256(b"lorem ipsum dolor " * ((mb << 20) // 19)).hexdigest()
    assert took[1] < 8 * took[0] + 5


def test_exact_survives_fingerprint_collisions(spark):
    rows = [(i, f"text number {i % 40:02d}") for i in range(100)]
    check_exact(spark.createDataFrame(rows, "doc_id long, text string"), moduli=(3, 5), chunk=4)


def test_exact_empty(no_docs):
    assert exact.exact_dedup(no_docs).collect() == []
    assert exact.deduplicated(no_docs).collect() == []


def test_deduplicated_keeps_one_row_of_each_text(odd_docs):
    got = exact.deduplicated(odd_docs)
    assert got.columns == odd_docs.columns
    texts = [normal(r["text"]) for r in got.collect()]
    assert sorted(texts) == sorted({normal(r["text"]) for r in odd_docs.collect()})


def check_near(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = brute_components([r for r in rows if r[0] is not None])
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]], r
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_near_on_a_table(spark, sf):
    check_near(spark.read.parquet(f"{sf}/documents.parquet"))


def test_near_odd(odd_docs):
    check_near(odd_docs)


def made(seed, n):
    """Chains of near copies, texts around a shared passage (just below and above the threshold), short texts and copies."""
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefgh", k=r.randint(2, 5)))
    passage = [word() for _ in range(60)]
    out = []
    for _ in range(n):
        kind = r.random()
        if kind < 0.3 and out:
            w = list(r.choice(out))
            for _ in range(r.randint(0, max(1, len(w) // 60))):
                w[r.randrange(len(w))] = word()
        elif kind < 0.7:
            w = [word() for _ in range(r.randint(0, 14))] + passage + [word() for _ in range(r.randint(0, 3))]
        elif kind < 0.8:
            w = r.choices("ab", k=r.randint(1, 6))
        else:
            w = [word() for _ in range(r.randint(20, 200))]
        out.append(w)
    return [(i, " ".join(w)) for i, w in enumerate(out)]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_finds_every_link(spark, seed):
    check_near(spark.createDataFrame(made(seed, 400), "doc_id long, text string").repartition(4))


def test_near_blocks_are_compared_with_each_other(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 500)
    monkeypatch.setattr(neardup, "BLOCK_DOCS", 7)
    monkeypatch.setattr(neardup, "spare_bands", lambda percent: -1)  # chance settles none
    check_near(spark.createDataFrame(made(3, 300), "doc_id long, text string"))


def test_near_empty(no_docs):
    assert neardup.near_duplicates(no_docs).collect() == []
    assert neardup.without_near_duplicates(no_docs).collect() == []


def test_without_near_duplicates(odd_docs):
    got = neardup.without_near_duplicates(odd_docs)
    assert got.columns == odd_docs.columns
    kept = {r["doc_id"] for r in neardup.near_duplicates(odd_docs).where("kept").collect()}
    assert {r["doc_id"] for r in got.collect()} == kept


def test_components_of_a_path(spark):
    from quillstone.llm.common import Scratch

    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).where("id % 50 <> 49")
    got = {r["node"]: r["root"] for r in neardup.components(links, Scratch(spark, "t")).collect()}
    assert all(got[i] == i // 50 * 50 for i in range(200))


def around_a_passage(seed, share=0.91, n=1000):
    """Twelve texts of n words that are mostly one passage, and two more that share some of the rest as well: just above 0.85."""
    r = random.Random(seed)
    own = lambda k: ["".join(r.choices("abcdefgh", k=8)) for _ in range(k)]
    passage = own(int(n * share))
    rest = n - len(passage)
    both = own(int(0.925 * n) - len(passage))
    texts = [passage + own(rest) for _ in range(12)] + [passage + both + own(rest - len(both)) for _ in range(2)]
    return [(i, " ".join(w)) for i, w in enumerate(texts)]


def test_near_links_of_long_texts_around_a_passage(spark):
    # texts whose own shingles fill 24 bands and more, none of which the partner shares
    rows = [(100 * k + i, t) for k, (seed, share) in enumerate([(672, 0.88), (67, 0.91), (104, 0.91), (261, 0.91)]) for i, t in around_a_passage(seed, share)]
    check_near(spark.createDataFrame(rows, "doc_id long, text string"))


def test_near_repeated_ids_with_differing_texts(spark):
    r = random.Random(9)
    a, b = (["".join(r.choices("abcdefgh", k=6)) for _ in range(200)] for _ in range(2))
    near = [*b[:-1], "other"]
    # 5 has a copy of 1's text, and one of its own that is like 7's
    rows = [(1, " ".join(a)), (5, " ".join(a)), (5, " ".join(b)), (7, " ".join(near)), (8, "x y z")]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((x["doc_id"], x["component_id"]) for x in got) == [(1, 1), (5, 1), (5, 1), (7, 1), (8, 8)]


def test_registers_by_a_plain_loop():
    import numpy as np

    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2**63, k, dtype=np.uint64) * np.uint64(2)) for k in (0, 1, 5, 300, 4000)]
    for s, got in zip(sets, neardup.registers(sets), strict=True):
        want = [0] * neardup.BUCKETS
        least = {}
        for h in map(int, s):
            bucket, rest = h >> 56, (h & (1 << 56) - 1) >> 4
            least[bucket] = min(rest, least.get(bucket, rest))
        for bucket, rest in least.items():
            bits = f"{rest:052b}"
            zeros = len(bits) - len(bits.lstrip("0"))
            want[bucket] = 1 + (zeros << 10 | int(bits[zeros + 1 : zeros + 11].ljust(10, "0") or "0", 2))
        assert got.tolist() == want


def pairs_at(similarity, n, count, seed):
    """Registers of pairs of sets that just reach a similarity, all differences on both sides."""
    import numpy as np

    rng = np.random.default_rng(seed)
    union = round(n / (0.5 + similarity / 2))
    both = int(np.ceil(similarity * union))
    one = (union - both) // 2
    left, right = [], []
    for _ in range(count):
        h = rng.integers(0, 2**63, union, dtype=np.uint64) * np.uint64(2)
        left.append(np.sort(h[: both + one]))
        right.append(np.sort(np.concatenate([h[:both], h[both + one :]])))
    return neardup.registers(left), neardup.registers(right), np.array([len(x) for x in left]), np.array([len(x) for x in right])


@pytest.mark.parametrize("percent", [80, 85])
def test_a_partner_shares_more_bands_than_are_spared(percent):
    import numpy as np

    rows, spare = neardup.rows_per_band(percent), neardup.spare_bands(percent)
    assert spare >= 0
    shared = []
    for n in (neardup.SPARE_SHINGLES, 200, 1000):
        a, b, na, nb = pairs_at(percent / 100, n, 1500, n)
        ka, kb = neardup.bands(a, rows), neardup.bands(b, rows)
        shared.append(((ka == kb) & (ka > 0)).sum(axis=1))
        j, error = neardup.estimate(a, b, na, nb)
        assert abs(j.mean() - percent / 100) < 0.01 and (j + neardup.SLACK * error >= percent / 100).all()
    assert min(map(np.min, shared)) > spare
    # of sets far apart the estimate, corrected for collisions, is near 0
    a, b, na, nb = pairs_at(0.02, 3000, 300, 7)
    assert abs(neardup.estimate(a, b, na, nb)[0].mean() - 0.02) < 0.005
    # few in a thousand keys of unlike sets agree
    assert (neardup.bands(a, rows) == neardup.bands(b, rows)).mean() < 1e-4
