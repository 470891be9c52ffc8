import collections
import random

import corpus_pipeline
import pytest

from .test_dedup import brute_components, made, normal, words
from .test_order import check_packed, fill


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    from quillstone.llm.common import Scratch

    scratch, got = Scratch(spark, "t"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.cut(stage(spark, docs, sf))
        got[name] = docs
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    clean = [(r["doc_id"], r["text"]) for r in got["toxicity"].collect()]
    first = {}
    for i, t in sorted(clean):
        first.setdefault(normal(t), i)
    distinct = [(r["doc_id"], r["text"]) for r in got["exact dedup"].collect()]
    assert sorted(i for i, _ in distinct) == sorted(first.values())
    near = brute_components(distinct, corpus_pipeline.NEAR_PERCENT)
    kept = {i for i, (_, root) in near.items() if root == i}
    assert {r["doc_id"] for r in got["near dedup"].collect()} == kept
    check_mixed(got["near dedup"], got["mixing"])
    check_packed(got["mixing"], 2048)
    assert sorted(map(tuple, got["packing"].collect())) == sorted(map(tuple, corpus_pipeline.packed(spark, got["mixing"], sf).collect()))


def check_mixed(docs, mixed):
    """Every row is taken whole times or once more, and each source's words come as near to its target as its smallest row left."""
    rows = collections.Counter(map(tuple, docs.collect()))
    got = collections.Counter(map(tuple, mixed.collect()))
    at, text = docs.columns.index("source"), docs.columns.index("text")
    size = {r: len(words(r[text])) for r in rows}
    sources = sorted({r[at] for r in rows}, key=lambda s: (s is None, s or ""))
    sizes = [sum(n * size[r] for r, n in rows.items() if r[at] == s) for s in sources]
    targets = fill(sizes, [1 + k % 3 for k in range(len(sources))], 3)
    assert set(got) <= set(rows)
    for s, total, target in zip(sources, sizes, targets, strict=True):
        mine = [r for r in rows if r[at] == s]
        whole = int(target // total) if total else 0
        assert all(whole * rows[r] <= got[r] <= (whole + 1) * rows[r] and got[r] <= 3 * rows[r] for r in mine)
        off = sum(got[r] * size[r] for r in mine) - target
        # short of it: by no more than any row left; past it: by no more than half of a row that was taken, the last
        free = [size[r] for r in mine if size[r] and got[r] < (whole + 1) * rows[r]]
        past = [size[r] / 2 for r in mine if got[r] > whole * rows[r]]
        assert -off <= min(free, default=0) if off <= 0 else off <= max(past)


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_near_stage_links_from_080(spark, sf):
    r = random.Random(4)
    word = lambda: "".join(r.choices("abcdefgh", k=r.randint(2, 5)))
    rows = made(5, 100)
    for _ in range(60):  # pairs of long texts at about 0.82, and a few words around it
        w = [word() for _ in range(r.randint(300, 600))]
        v = list(w)
        for at in range(0, len(v), 50):
            v[min(at + r.randrange(40), len(v) - 1)] = word()
        rows += [(len(rows), " ".join(w)), (len(rows) + 1, " ".join(v))]
    want, strict = (brute_components(rows, percent) for percent in (80, 85))
    assert sum(i != want[i][1] for i in want) >= 50 + sum(i != strict[i][1] for i in strict)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x["doc_id"] for x in corpus_pipeline.unlike(spark, docs, sf).collect()} == {i for i, (_, root) in want.items() if root == i}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mixing_of_odd_rows(spark, odd_docs, seed):
    from quillstone.llm import mixing

    odd = odd_docs.unionByName(odd_docs.where("doc_id IN (3, 7)")).withColumn("m.x", odd_docs["doc_id"])
    for docs in (odd, odd.repartition(3)):
        check_mixed(docs, mixing.mixed_documents(docs, seed=seed))
    assert mixing.mixed_documents(odd).columns == odd.columns


def test_stages_on_empty_and_odd_tables(spark, sf, odd_docs, no_docs):
    for docs in (no_docs, odd_docs):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf)
            if name != "packing":
                assert docs.columns == odd_docs.columns
        assert (docs.count() == 0) == (docs.select("doc_id").count() == 0)
