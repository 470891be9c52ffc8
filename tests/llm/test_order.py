import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillstone.llm import hilbert, materialise, mixing, packing, queries, tokens
from quillstone.llm.common import Scratch, order_hash


def size_of(t):
    return len((t or "").encode()) + 1


@pytest.mark.parametrize("n", [2, 3])
def test_the_curve_visits_neighbours(spark, n):
    bits = 3
    axes = [F.expr(f"(id div {8**i}) % 8") for i in range(n)]
    got = sorted(tuple(r) for r in spark.range(8**n).select(hilbert.hilbert_index(axes, bits), *axes).collect())
    assert [r[0] for r in got] == list(range(8**n))
    assert all(sum(abs(a - b) for a, b in zip(p[1:], q[1:], strict=True)) == 1 for p, q in zip(got, got[1:], strict=False))


def check_shards(docs, shards=8):
    rows = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in docs.collect())
    got = hilbert.assign(docs, shards=shards).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == sorted((a, b, size_of(t), zlib.crc32(t.encode())) for a, b, t in rows)
    per = [sorted(r["slot"] for r in got if r["shard"] == s) for s in range(shards)]
    assert all(p == list(range(len(p))) for p in per)
    assert max(map(len, per)) - min(map(len, per)) <= 1
    order = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in order] == sorted(r["curve"] for r in got)
    return got


def test_shards_of_a_table_prune(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check_shards(docs)
    ranges = hilbert.file_ranges(hilbert.assign(docs)).collect()
    assert len(ranges) == 8 and any(r["min_n_chars"] > 1000 or r["max_n_chars"] < 5000 for r in ranges)


def test_shards_odd(odd_docs, no_docs):
    check_shards(odd_docs, 3)
    assert hilbert.assign(no_docs).collect() == []


def test_strings_are_cut_where_they_differ(spark):
    import collections

    # long common beginnings, one value that has none of them, a heavy value, nulls, other scripts
    values = [f"https://www.example.org/{k:03d}" for k in range(150) for _ in range(2)] + ["https://www.example.org/050"] * 100 + ["A", "", None, "日本", "日本語"]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    cuts = hilbert._cuts(df, "s", 15)
    got = [(r["s"], r["q"]) for r in df.select("s", sum((F.coalesce(c.cast("int"), F.lit(0)) for c in cuts), F.lit(0)).alias("q")).collect()]
    assert len(cuts) <= 15
    order = sorted(got, key=lambda x: (x[0] is not None, (x[0] or "").encode()))
    assert [q for _, q in order] == sorted(q for _, q in order)
    sizes = collections.Counter(q for _, q in got)
    assert len(sizes) >= 8 and max(n for q, n in sizes.items() if not any(s == "https://www.example.org/050" for s, x in got if x == q)) <= 100


def test_hot_cells_are_split(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("s").alias("source"), F.lit("en").alias("lang"), F.lit(1).alias("n_chars"))
    from quillstone.llm import common

    df = docs.withColumn("g", F.lit(1))
    got = common.ranked(df, "g", ["doc_id"], rows_per_bucket=40, weight="n_chars").select("doc_id", "rank", "before", order_hash("doc_id").alias("h")).collect()
    assert sorted(r["rank"] for r in got) == list(range(500))
    assert all(r["before"] == r["rank"] for r in got)
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["rank"])] == [r["doc_id"] for r in sorted(got, key=lambda r: (r["h"], r["doc_id"]))]


def fill(sizes, weights, epochs):
    """Rounds of resharing, as the rule is told."""
    total, caps, target, open_ = sum(sizes), [epochs * s for s in sizes], [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        left = total - sum(caps[i] for i in range(len(sizes)) if i not in open_)
        w = sum(weights[i] for i in open_)
        over = {i for i in open_ if left * weights[i] / w > caps[i]}
        for i in open_:
            target[i] = left * weights[i] / w
        if not over:
            break
        for i in over:
            target[i] = caps[i]
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [[100, 100, 100], [5, 1000, 1, 900, 2, 3, 40], [0, 0, 10], [7], [0], [1, 2, 3, 4, 5, 600]])
def test_targets_are_the_rounds_fixpoint(spark, sizes):
    df = spark.createDataFrame([(f"s{i:02d}" if i else None, s) for i, s in enumerate(sizes)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    order = [*range(1, len(sizes)), 0]  # null comes last
    want = fill([sizes[i] for i in order], [1 + k % 3 for k in range(len(order))], 3)
    assert [got[f"s{i:02d}" if i else None] for i in order] == pytest.approx(want)


def test_mix_of_a_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count()
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(docs.repartition(3)).collect()))
    by = {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["repeats"] * r["size"]
        by.setdefault(r["source"], []).append(r)
    for rows in by.values():
        taken = sum(r["taken"] for r in rows)
        assert rows[0]["source_size"] == sum(r["size"] for r in rows)
        free = min((r["size"] for r in rows if r["repeats"] == min(x["repeats"] for x in rows) and r["size"]), default=0)
        assert abs(taken - rows[0]["target"]) <= max(free, 0.1 * rows[0]["target"])
    again = mixing.mixed_documents(docs)
    assert again.count() == sum(r["repeats"] for r in got) and again.columns == docs.columns


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix_fills_past_a_giant_document(spark, seed):
    import random

    r = random.Random(seed)
    rows, n = [], {"a": 120, "b": 300, "c": 400}
    for source, k in n.items():
        sizes = [r.randint(1, 60) for _ in range(k)]
        sizes += [sum(sizes) * share // 100 for share in (45, 20, 15)]  # giants that don't fit what is left
        rows += [(len(rows) + i, "w " * x, source) for i, x in enumerate(sizes)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for mixed_by in (seed, seed + 10):
        by = {}
        for x in mixing.mix(docs, weights=(1, 6, 9), seed=mixed_by).collect():
            by.setdefault(x["source"], []).append(x)
        for of in by.values():
            least = min(x["repeats"] for x in of)
            free = min(x["size"] for x in of if x["repeats"] == least)
            assert abs(sum(x["taken"] for x in of) - of[0]["target"]) <= free


def test_mix_odd(odd_docs, no_docs):
    got = mixing.mix(odd_docs).collect()
    assert len(got) == odd_docs.count() and all(r["taken"] <= 3 * r["size"] for r in got)
    assert {r["doc_id"]: r["size"] for r in got}[4] == 0
    assert mixing.mixed_documents(odd_docs).columns == odd_docs.columns and mixing.mixed_documents(odd_docs).count() > 0
    assert mixing.mix(no_docs).collect() == [] and mixing.mixed_documents(no_docs).collect() == []


def library_ids(texts):
    t = Tokenizer.from_file(tokens.default_path())
    return [[*t.encode(x or "", add_special_tokens=False).ids, 1] for x in texts]


def test_ids_are_the_librarys(spark, sf, odd_docs):
    import pyarrow as pa

    texts = [r["text"] for d in (spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/pages.parquet").select(F.col("html").alias("text")), odd_docs.where("length(text) < 5000 OR text IS NULL")) for r in d.select("text").collect()]
    texts += ["a" * 100, "ABC'S don't 'RE x'", "́x é́", "ÀÖ×÷ßÿŸ ǅ", "日本語 text", "a\x00b \x1c c", "12,345.67%", "<|startoftext|> <b>", " x　y"]
    got = [list(map(int, x)) for _, part in tokens.encoded(pa.array(texts), tokens.default_path()) for x in part]
    assert got == library_ids(texts)


def test_patterns_use_every_length_once():
    rng = np.random.default_rng(0)
    lengths = np.minimum(64, rng.geometric(0.05, 5000))
    histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)), strict=True))
    packed = packing.patterns(histogram, 64)
    used = {}
    for parts, n in packed:
        assert 0 < sum(parts) <= 64 and n > 0
        for p in parts:
            used[p] = used.get(p, 0) + n
    assert used == histogram
    assert lengths.sum() / 64 / sum(n for _, n in packed) > 0.98


def check_packed(docs, width):
    rows = docs.select("doc_id", "text").collect()
    ids = library_ids([r["text"] for r in rows])
    got = packing.packed(docs, width=width).collect()
    assert sum(r["length"] for r in got) == sum(map(len, ids))
    whole = {}
    for r, x in zip(rows, ids, strict=True):
        whole.setdefault(r["doc_id"], []).append(x)
    for r in got:
        assert any(len(x) == r["doc_tokens"] and zlib.crc32(np.array(x[r["start"] : r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"] for x in whole[r["doc_id"]])
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= width
    assert sorted(by) == list(range(len(by)))


def test_packing(spark, sf, odd_docs, no_docs):
    check_packed(spark.read.parquet(f"{sf}/documents.parquet"), 2048)
    check_packed(odd_docs, 64)
    assert packing.packed(no_docs).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 10, 255, 256, 257, 5000])
def test_feistel_is_one_to_one(n):
    got = materialise.feistel(np.arange(n), n, key=5)
    assert sorted(got.tolist()) == list(range(n))
    assert n < 100 or abs(np.corrcoef(got, np.arange(n))[0, 1]) < 0.2
    assert n < 10 or got.tolist() != materialise.feistel(np.arange(n), n, key=6).tolist()


def test_shards_hold_every_sequence(spark, odd_docs, no_docs, tmp_path):
    records = materialise.placed(odd_docs, length=32, per_shard=50)
    rows = sorted(records.collect(), key=lambda r: r["slot"])
    assert [r["slot"] for r in rows] == list(range(len(rows)))
    parts = {}
    for r in rows:
        parts.setdefault(r["doc_id"], []).append((r["start"], list(np.frombuffer(r["record"], "<u2")[: r["n_ids"]])))
    texts = odd_docs.select("doc_id", "text").collect()
    want = {}
    for r, x in zip(texts, library_ids([r["text"] for r in texts]), strict=True):
        want.setdefault(r["doc_id"], []).extend((i, x[i : i + 32]) for i in range(0, len(x), 32))
    assert {k: sorted(v) for k, v in parts.items()} == {k: sorted(v) for k, v in want.items()}
    scratch = Scratch(spark, "t")
    table, total = materialise.indexed(odd_docs, scratch, length=32)
    manifest = materialise.write_shards(table, total, f"file://{tmp_path}", scratch, per_shard=50)
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")) == ["manifest", *(f"shard-{i:06d}.bin" for i in range(-(-len(rows) // 50)))]
    assert sorted(map(tuple, manifest.collect()), key=lambda r: r[3]) == [tuple(r[c] for c in manifest.columns) for r in rows]
    read = {r["slot"]: bytes(r["record"]) for r in materialise.with_records(manifest, f"file://{tmp_path}", length=32).collect()}
    assert read == {r["slot"]: bytes(r["record"]) for r in rows}
    some = materialise.with_records(manifest.where("slot % 7 = 3 OR slot > 60").orderBy("slot"), str(tmp_path), length=32).collect()
    assert [bytes(r["record"]) for r in some] == [read[r["slot"]] for r in some]
    back = list(materialise.read_slots(str(tmp_path), 37, len(rows) - 37, length=32, per_shard=50))
    assert [x.tobytes() for x in back] == [bytes(r["record"]) for r in rows[37:]]
    assert materialise.placed(no_docs).collect() == []
    assert materialise.materialised(no_docs, f"file://{tmp_path}/none").count() == 0


def test_slots_do_not_depend_on_the_files_a_task_writes(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    whole = sorted((r["slot"], r["doc_id"], r["start"]) for r in materialise.placed(docs).collect())
    limit = "spark.sql.files.maxRecordsPerFile"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "20")
    try:
        dealt = materialise.placed(docs).collect()
        query = queries.op1_training_order(spark, sf).collect()
    finally:
        spark.conf.set(limit, before)
    assert [r[0] for r in whole] == list(range(len(whole)))
    assert sorted((r["slot"], r["doc_id"], r["start"]) for r in dealt) == whole == sorted((r["slot"], r["doc_id"], r["start"]) for r in query)
    crc = {r["slot"]: zlib.crc32(bytes(r["record"])) for r in dealt}
    assert {r["slot"]: r["record_crc32"] for r in query} == crc


def test_slots_do_not_depend_on_how_the_input_lies(spark, sf, odd_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))
    one, other = (sorted((r["slot"], r["doc_id"] or -1, r["start"], bytes(r["record"])) for r in materialise.placed(d).collect()) for d in (docs.coalesce(1), docs.repartition(7)))
    assert one == other
