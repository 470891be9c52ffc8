import collections
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from quillstone.llm import ann, html, lm, queries, toxicity


def test_toxicity_finds_the_sentence(spark, odd_docs, no_docs):
    rng = np.random.default_rng(0)
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(1200):
        s = [" ".join(rng.choice(plain, 8)) for _ in range(rng.integers(1, 9))]
        bad = i % 7 == 0
        if bad:
            k = rng.integers(len(s))
            s[k] = s[k] + " vile" + ["ness", "ly", "st"][i % 3]
        rows.append((i, ". ".join(s) + ".", bad))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int"))
    got = {r["doc_id"]: r for r in toxicity.scores(docs, model).collect()}
    for i, t, bad in rows:
        assert (got[i]["score"] >= 0.3) == bad
        if bad:
            assert b"vile" in t.encode()[got[i]["sentence_start"] : got[i]["sentence_end"]]
    odd = toxicity.scores(odd_docs, model).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert {r["doc_id"]: r["score"] for r in odd}[5] == 0
    kept = toxicity.without_toxic(odd_docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    # the noisy-or, sentence by sentence, in a plain loop
    for i, t, _ in rows[:40]:
        calm = 1.0
        for sentence in re.findall(r"[^.]*\.", t):
            total = model.bias
            for w in sentence.split():
                w = w.rstrip(".").encode()
                f, _, _ = toxicity.features(np.frombuffer(w, np.uint8), np.array([0, len(w)]))
                total += sum(model.weights[k] for k in f[0] if k >= 0)
            calm *= 1 - 1 / (1 + np.exp(-total))
        assert got[i]["score"] == pytest.approx(1 - calm, abs=1e-5)
    assert toxicity.scores(no_docs, model).collect() == []
    assert toxicity.without_toxic(no_docs, spark.createDataFrame([], "doc_id long, toxic int")).collect() == []


def test_toxicity_on_held_out_labels(spark):
    d = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in queries.op4_toxicity(spark, d).collect()}
    labels = [(got[r["doc_id"]], r["toxic"]) for r in spark.read.parquet(f"{d}/labels.parquet").collect() if got[r["doc_id"]]["held_out"]]
    assert all(zlib.crc32(str(g["doc_id"]).encode()) % 4 == 2 for g, _ in labels)
    found = [g["predicted"] for g, y in labels if y]
    wrong = [g["predicted"] for g, y in labels if not y]
    assert np.mean(found) > 0.85 and np.mean(wrong) < 0.01  # about one in ten of these toxic labels stands on a text without any of the words


def test_huge_texts_are_worked_on_in_parts(monkeypatch):
    from quillstone.llm import neardup, tokens, words

    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("abcdé .!?\n\t"), 900)), "x" * 700 + " a b " + "y" * 300, " " * 500, "a. " * 300, "one two", "z" * 400]
    model = toxicity.Model(np.random.default_rng(1).normal(0, 1, 1 << toxicity.BITS), -2.0)

    def all_of(text):
        data = np.frombuffer(text.encode(), np.uint8)
        at = np.array([0, len(data)])
        scored = toxicity._scored(data, at, model)
        sets = list(words.shingles(words.hashed(data, at)))
        ids = [x for _, part in tokens.encoded(pa.array([text]), tokens.default_path()) for x in part]
        return [*lm.tokens(data, at), *sets, *ids, neardup.registers(sets), scored.start, scored.end], [scored.score, scored.sentence]

    whole = [all_of(t) for t in texts]
    monkeypatch.setattr(words, "CUT", 64)
    for t, (exact, near) in zip(texts, whole, strict=True):
        data = np.frombuffer(t.encode(), np.uint8)
        cut = list(words.parts(data))
        assert [a for a, _ in cut] == [0, *(b for _, b in cut[:-1])] and cut[-1][1] == len(data)
        got, close = all_of(t)
        assert all(np.array_equal(a, b) for a, b in zip(exact, got, strict=True))
        assert all(np.allclose(a, b, rtol=1e-12) for a, b in zip(near, close, strict=True))


def tokens_of(text):
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    return [*re.findall(rb"[^\x20\x09-\x0D]+", raw), None]


def check_lm(docs, rows, head=None, monkeypatch=None):
    if head:
        monkeypatch.setattr(lm, "HEAD", head)
    got = lm.score(docs).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count = collections.Counter()
    for i, t in rows:
        if not held(i):
            count.update(tokens_of(t))
    n, v = sum(count.values()), len(count)
    want = sorted((-1 if i is None else i, held(i), len(tokens_of(t)), sum(count[x] > 0 for x in tokens_of(t)), n, sum(np.log10((count[x] + 1) / (n + v + 1)) for x in tokens_of(t))) for i, t in rows)
    mine = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got)
    for a, b in zip(mine, want, strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])
    return got


def test_lm_on_a_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = check_lm(docs, [(r["doc_id"], r["text"]) for r in docs.collect()])
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_lm_odd(spark, odd_docs, no_docs, monkeypatch):
    got = check_lm(odd_docs, [(r["doc_id"], r["text"]) for r in odd_docs.collect()], 5, monkeypatch)
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert lm.score(no_docs).collect() == []


def test_lm_classes_are_normalised_and_learned():
    groups, side, _ = lm.shape(10)
    classes = groups * side
    flat = (np.arange(3000) % 5 * 9).astype(np.int64)  # each class tells the next; all in groups of their own or not
    first, counts = np.array([0, 3000]), np.bincount(np.arange(3000) % 5 * 9, minlength=classes).astype(float)
    model = lm.Model.new(counts, groups)
    learner = lm.Learner(model, lm.Model.of(np.full(len(model.flat()), lm.BEGUN, np.float32), groups, classes), counts, [0])
    context = lm.contexts(flat, first, 0, 3000)
    for _ in range(60):
        for lo in range(0, 3000, 500):
            learner.learn(flat[lo : lo + 500], context[lo : lo + 500])
    some = flat[10:18]
    every = np.stack([lm.log_probabilities(model, np.append(some, k), np.array([0, 9]))[-1] for k in range(classes)])
    assert np.exp(every).sum() == pytest.approx(1, abs=1e-9)
    assert lm.log_probabilities(model, flat, first).mean() > np.log(0.5) > np.log(0.2)


def lm_and_text(n=30_000, size=1.0):
    """A model of 2,809 classes with random weights, and a text of such classes, frequent and rare."""
    rng, side = np.random.default_rng(5), 53
    counts = 1e6 / np.arange(1, side * side + 1)
    model = lm.Model.new(counts, side)
    model = lm.Model.of(model.flat() + size * rng.normal(0, 0.3, len(model.flat())).astype(np.float32), side, side * side)
    flat = rng.choice(side * side, n, p=counts / counts.sum())
    return model, counts, flat, np.array([0, 7, n // 2, n])


def plain_log_probabilities(m, flat, first, some):
    side, begin = len(m.group), first[np.searchsorted(first, some, "right") - 1]
    out = []
    for i, b in zip(some.tolist(), begin.tolist(), strict=True):
        before = [flat[i - k] if i - k >= b else lm.END_CLASS for k in range(1, lm.CONTEXT + 1)]
        q = sum(m.context[c].astype(float) * m.scale[k] for k, c in enumerate(before))
        s, u = m.group.astype(float) @ q + m.group_bias, m.output.astype(float).reshape(side, side, -1)[flat[i] // side] @ q + m.bias.reshape(side, side)[flat[i] // side]
        out.append(sum(x[k] - x.max() - np.log(np.exp(x - x.max()).sum()) for x, k in ((s, flat[i] // side), (u, flat[i] % side))))
    return np.array(out)


def test_lm_scores_take_few_powers(monkeypatch):
    model, _, flat, first = lm_and_text()
    taken, exp = [], np.exp
    monkeypatch.setattr(np, "exp", lambda x, *a, **k: taken.append(np.size(x)) or exp(x, *a, **k))
    got = lm.log_probabilities(model, flat, first)
    monkeypatch.undo()
    assert sum(taken) < 0.6 * len(flat) * 2 * len(model.group)
    some = np.arange(0, len(flat), 37)
    assert got[some] == pytest.approx(plain_log_probabilities(model, flat, first, some), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("setting", [{"POWERS": 0}, {"MANY": 1 << 40}, {"POWERS": 0, "MANY": 1 << 40}, {"SCORED": 1000, "BLOCK": 64}, {"REPEATED": 9.0}, {"size": 40.0}])
def test_lm_scores_whatever_powers_are_taken(setting, monkeypatch):
    model, _, flat, first = lm_and_text(size=setting.get("size", 1.0))  # large weights leave a double's range
    for name in setting.keys() - {"size"}:
        monkeypatch.setattr(lm, name, setting[name])
    some = np.append(np.arange(12), np.arange(12, len(flat), 101))
    assert lm.log_probabilities(model, flat, first)[some] == pytest.approx(plain_log_probabilities(model, flat, first, some), rel=1e-11, abs=1e-11)


def test_lm_learns_a_batch_as_a_plain_loop_does():
    model, counts, flat, first = lm_and_text(2048)
    side, t, c = 53, flat, lm.contexts(flat, first, 0, 2048)
    learner = lm.Learner(lm.Model.of(model.flat(), side, side * side), lm.Model.of(np.full(len(model.flat()), lm.BEGUN, np.float32), side, side * side), counts, [3])
    learner.learn(t, c)
    rng, (p_group, p_class) = np.random.default_rng([3]), lm.frequencies(counts, side)
    noise = rng.choice(side, lm.NOISE[0], p=p_group)
    others = (np.cumsum(p_class.reshape(side, -1), axis=1)[:, None, :-1] < rng.random((side, lm.NOISE[1], 1))).sum(axis=2) + np.arange(side)[:, None] * side
    m = lm.Model(*(x.astype(float) for x in model.parts))
    grad = lm.Model(*(np.zeros_like(x) for x in m.parts))
    for x, before in zip(t.tolist(), c.tolist(), strict=True):
        q, pull = sum(m.context[b] * m.scale[k] for k, b in enumerate(before)), np.zeros(lm.SIZE)
        chosen = [("group", "group_bias", y, lm.NOISE[0] * p_group[y], y_good) for y, y_good in [(x // side, 1), *((int(y), 0) for y in noise)]]
        chosen += [("output", "bias", y, lm.NOISE[1] * p_class[y], y_good) for y, y_good in [(x, 1), *((int(y), 0) for y in others[x // side])]]
        for vectors, biases, y, p, y_good in chosen:
            g = y_good - 1 / (1 + np.exp(-(q @ getattr(m, vectors)[y] + getattr(m, biases)[y] - np.log(p))))
            pull += g * getattr(m, vectors)[y]
            getattr(grad, vectors)[y] += g * q
            getattr(grad, biases)[y] += g
        for k, b in enumerate(before):
            grad.context[b] += pull * m.scale[k]
            grad.scale[k] += pull * m.context[b]
    for x, g, got in zip(m.parts, grad.parts, learner.model.parts, strict=True):
        assert got == pytest.approx(x + lm.RATE * g / np.sqrt(lm.BEGUN + g**2), abs=2e-5)


def test_lm_scores_by_a_plain_loop(spark, sf):
    from quillstone.llm.common import Scratch

    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60").select("doc_id", "text")
    rows = docs.withColumn("held_out", lm.held_out())
    scratch = Scratch(spark, "t")
    fitted = lm.fit(rows.where("NOT held_out"), scratch)
    got = {r["doc_id"]: r for r in lm.scored(rows, fitted, scratch).collect()}
    train = collections.Counter()
    texts = [(r["doc_id"], r["text"], r["held_out"]) for r in rows.collect()]
    for _, t, held in texts:
        if not held:
            train.update(tokens_of(t))
    top = sorted((w for w in train if w is not None), key=lambda w: -train[w])
    m, groups = fitted.model, len(fitted.model.group)
    side = len(m.output) // groups

    def class_of(w):
        """As the model's own table says it; all else here is done again."""
        if w is None:
            return lm.END_CLASS, True
        n, form, _ = lm.tokens(np.frombuffer(w, np.uint8), np.array([0, len(w)]))
        _, c, own = fitted.head.find(n[:1], form[:1])
        return int(c[0]), bool(own[0])

    known = {w: class_of(w) for w in {x for _, t, _ in texts for x in tokens_of(t)}}
    n_class, v_class = collections.Counter(), collections.Counter()
    for w, c in train.items():
        n_class[known[w][0]] += c
        v_class[known[w][0]] += 1
    least_own = min((train[w] for w in top if known[w][1]), default=0)
    assert all(train[w] <= least_own for w in top if not known[w][1])
    for i, t, _ in texts[::7]:
        total, before = 0.0, [lm.END_CLASS] * lm.CONTEXT
        for w in tokens_of(t):
            c, own = known[w]
            q = sum(m.context[before[k]].astype(float) * m.scale[k] for k in range(lm.CONTEXT))
            s = [float(q @ m.group[g] + m.group_bias[g]) for g in range(groups)]
            u = [float(q @ m.output[x] + m.bias[x]) for x in range(c // side * side, (c // side + 1) * side)]
            total += s[c // side] - np.log(np.exp(s).sum()) + u[c % side] - np.log(np.exp(u).sum())
            if not own:
                total += np.log((train[w] + 1) / (n_class[c] + v_class[c] + 1))
            before = [c, *before[:-1]]
        assert got[i]["score"] == pytest.approx(total / np.log(10), rel=1e-6)


def test_lm_does_not_depend_on_how_the_input_lies(spark, sf, odd_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 100").select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))
    one, other = (sorted(((r["doc_id"] or -1, r["n_tokens"], r["base_score"], r["score"]) for r in lm.score(d).collect())) for d in (docs.coalesce(1), docs.repartition(5)))
    for a, b in zip(one, other, strict=True):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], rel=1e-9)


def test_ann_recall_and_ties(spark, sf):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = ann.search(vectors, "vec_id % 20 = 0").toPandas()
    p = vectors.toPandas()
    x, ids = np.stack(p["embedding"]).astype(float), p["vec_id"].to_numpy()
    want = ann.exact_search(x, ids, np.flatnonzero(ids % 20 == 0))
    assert len(got) == len(want)
    assert len(got.merge(want, on=["query_id", "vec_id"])) / len(want) >= 0.9
    at = dict(zip(ids, x, strict=True))
    assert all(abs(np.sqrt(((at[q] - at[v]) ** 2).sum()) - s) < 1e-12 for q, v, s in zip(got["query_id"], got["vec_id"], got["score"], strict=True))


def test_ann_odd(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 16)
    rows = [(i, [1.0, 2.0]) for i in range(60)] + [(100, None), (101, [0.0, 0.0]), (102, [1.0, None]), (103, [float("nan"), 1.0]), (104, [float("inf"), 1.0]), (None, [1.0, 1.0]), (105, [1.0]), (200, [3.0, 4.0]), (7, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("leaf", __import__("pyspark").sql.functions.lit(1))
    got = ann.search(df, "vec_id % 100 = 0").collect()
    assert {r["query_id"] for r in got} == {0, 200}
    mine = [(r["rank"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 0]
    assert mine == [(k + 1, v) for k, v in enumerate([1, 2, 3, 4, 5, 6, 7, 7, 8, 9])]
    assert ann.search(df.where("vec_id = 100"), "vec_id % 100 = 0").collect() == []
    assert ann.search(df.where("vec_id = 200"), "vec_id % 100 = 0").collect() == []


def test_tree_widens_until_recall_is_reached():
    x = np.random.default_rng(1).normal(size=(1500, 16))
    tree = ann.Tree.fit(x)
    near = ann.exact_search(x[:300], np.arange(300), np.arange(20))
    leaf = tree.place(x)[near["vec_id"].to_numpy()]
    few, many = (ann.calibrate(tree, x[:20], near["query_id"].to_numpy(), leaf, r) for r in (0.5, 0.95))
    assert 1 <= few < many <= tree.leaves
    assert sorted(tree.visit(x[0], tree.leaves)) == list(range(tree.leaves))
    assert all(tree.visit(v, 1) == [k] for v, k in zip(x[:20], tree.place(x[:20]), strict=True) if len(tree.children[0]) and all(not tree.children[c] for c in tree.children[0]))


def clustered(n, seed=2, offset=0.0, spread=1.0):
    rng = np.random.default_rng(seed)
    return offset + spread * (rng.normal(size=(n // 50, 12)) * 8)[rng.integers(n // 50, size=n)] + spread * rng.normal(size=(n, 12))


def frame(spark, x):
    return spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")


@pytest.mark.parametrize(("offset", "spread"), [(1e5, 1e-3), (1e8, 1.0), (0.0, 1e-12)])
def test_ann_distances_at_any_offset(spark, offset, spread):
    x = clustered(1500, 3, offset, spread)
    got = ann.search(frame(spark, x), "vec_id % 50 = 0").toPandas()
    want = ann.exact_search(x, np.arange(len(x)), np.arange(0, len(x), 50))
    both = got.merge(want, on=["query_id", "vec_id"])
    assert len(got) == len(want) and len(both) / len(want) >= 0.9
    assert np.allclose(both["score_x"], both["score_y"], rtol=1e-12, atol=0)


def test_ann_leaves_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAF_ROWS", 24)
    shares, grown = [], ann.Tree.grown

    def spy(tree, trees):
        spy.n += len(trees)
        return grown(tree, trees)

    spy.n = 0
    monkeypatch.setattr(ann.Tree, "grown", spy)
    real = ann.calibrate
    for n in (1500, 12_000):
        x = clustered(n, 4)
        monkeypatch.setattr(ann, "calibrate", lambda tree, *a: shares.append((real(tree, *a), tree.leaves)) or shares[-1][0])
        got = ann.search(frame(spark, x), "vec_id % 400 = 0", sample_rows=1000).toPandas()
        want = ann.exact_search(x, np.arange(n), np.arange(0, n, 400))
        assert len(got) == len(want) and len(got.merge(want, on=["query_id", "vec_id"])) / len(want) >= 0.9
    assert spy.n > 0 and shares[1][1] > 2 * shares[0][1]
    assert shares[1][0] / shares[1][1] < shares[0][0] / shares[0][1]  # a smaller share of the table


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body><header><p>Site name</p></header><nav><ul><li><a href='/a'>Home</a></li></ul></nav>"
    '<div class="cookie-notice">We use cookies on this long notice text which has quite a few words in it</div><article><h1>Title &amp; more</h1><p>First&nbsp;para <a href="x>y">link</a> goes\n on.<br><p>Be.</p>'
    '<aside class="ad">Buy this</aside><form><p>Your mail</p></form><p>Last é one.</p></article><section id="comments"><p>I think this article is nice and so on and on and on and on</p></section><!-- <p>no</p> --><footer>&copy; site</footer></body></html>'
)


def test_main_text_of_a_page():
    tree = html.trained()
    assert html.main_text(PAGE, tree) == "Title & more\nFirst para link goes on.\nBe.\nLast é one."
    plain = "<body><div><a href=/>Home</a> <a href=/x>Other</a></div><p>" + "long text here " * 20 + "</p><p>" + "and more of it " * 15 + "</p><div class=footer>all rights</div>"
    assert html.main_text(plain, tree) == ("long text here " * 20).strip() + "\n" + ("and more of it " * 15).strip()
    for odd in (None, "", "<", "<p", "</p></div>", "<p>", "<!--", "<script>", "a < b & c", "<a href='x>y</a>"):
        html.main_text(odd, tree)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ('<article><div class="entry-header"><h1>My Title</h1></div><p>Some text here that goes on.</p></article>', "My Title\nSome text here that goes on."),
        ('<article><h1>T</h1><div class="side-by-side"><p>One column of text.</p></div><div class="legal"><p>The law says so and so.</p></div></article>', "T\nOne column of text.\nThe law says so and so."),
        ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be so.</p></article>", "Let x=2 be so."),
        ("<body><p>Short first.</p><p>" + "long text here " * 20 + "</p></body>", "Short first.\n" + ("long text here " * 20).strip()),
        ('<body><div class="tags-page"><h1>Tags</h1><p>' + "all about tags " * 15 + "</p></div></body>", "Tags\n" + ("all about tags " * 15).strip()),
    ],
)
def test_names_alone_drop_nothing(page, want):
    assert html.main_text(page, html.trained()) == want


#: Pages of other shapes than those that the tree is grown from.
HELD_OUT = (
    "<body><div class=site-header><a>{-2}</a><ul class=nav-list><li><a>{-1}</a></li><li><a>{-1}</a></li></ul></div><div id=content><article id=post-7><div class=entry-header><h1>{+7}</h1><span>{+3}</span></div><div class=entry-content><p>{+48}</p><h2>{+4}</h2>"
    "<p>{+22}</p><div class=ad-container>{-8}</div><p>{+5}</p><p>{+66}</p></div></article><div id=respond><form><p>{-6}</p></form></div></div><div class=widget-area><h3>{-3}</h3><ul><li><a>{-5}</a></li></ul></div><footer>{-10}</footer></body>",
    "<body><header role=banner><h2>{-3}</h2></header><nav><ol><li><a>{-2}</a></li><li><a>{-3}</a></li></ol></nav><main><h1>{+5}</h1><div class=grid><section><h2>{+2}</h2><p>{+40}</p></section><section class=side-column><h2>{+3}</h2><p>{+36}</p></section></div></main><aside><p>{-44}</p></aside></body>",
    "<body><div class=navbar><a>{-1}</a><a>{-1}</a><a>{-1}</a></div><h1>{+6}</h1><p>{+11}</p><p>{+58}</p><p>{+70}</p><ol><li>{+8}</li><li>{+14}</li></ol><div class=social-links><a>{-1}</a></div><div class=footer-text>{-16}</div></body>",
    "<body><div><a>{-1}</a><a>{-2}</a></div><p>{+5}</p><p>{+90}</p><p>{+44} <a>{+2}</a></p><p>{+16}</p><div class=cookie-banner>{-25}</div></body>",
    "<body><div id=page><div class=promo><p>{-20}</p></div><article><h1>{+4}</h1><p>{+25}</p><blockquote><p>{+18}</p></blockquote><p>{+3}</p><table><tr><td>{+2}</td><td>{+2}</td></tr></table></article><section class=comments><h3>{-2}</h3><div class=comment-text><p>{-52}</p></div><div class=comment-text><p>{-31}</p></div></section></div></body>",
    "<body><form id=aspnet><div class=top-menu><a>{-2}</a><a>{-2}</a></div><div class=main><h1>{+5}</h1><p>{+38}</p><p>{+61}</p></div><div class=copyright>{-9}</div></form></body>",
    # by structure: telling names around text, short pages without an article, adverts and comments without telling names
    # telling names around text of an article
    "<body><nav><a>{-1}</a></nav><article><h1>{+6}</h1><div class='cookies-recipe'><p>{+18}</p><p>{+24}</p></div><p>{+12}</p></article><footer>{-8}</footer></body>",
    "<body><main><h1>{+4}</h1><p>{+9}</p><div class=share-price><p>{+30}</p></div><p>{+20}</p></main></body>",
    "<body><article><h1>{+4}</h1><section class=alert-history><p>{+22}</p><p>{+13}</p></section><p>{+31}</p></article></body>",
    "<body><article><h1>{+4}</h1><p>{+16}</p><section id=social-policy><h2>{+2}</h2><p>{+28}</p><p>{+35}</p></section></article></body>",
    "<body><article><h1>{+3}</h1><div id=menu><p>{+20}</p><p>{+17}</p></div></article><div id=menu-main><a>{-1}</a><a>{-2}</a></div></body>",
    "<body><div class=navigation-bar><a>{-1}</a><a>{-1}</a></div><article><h1>{+7}</h1><div class='related-studies'><p>{+44}</p></div><div class=related><a>{-4}</a><a>{-6}</a></div></article></body>",
    # short pages without an article
    "<body><h1>{+4}</h1><ol><li>{+6}</li><li>{+4}</li><li>{+5}</li></ol></body>",
    "<body><h1>{+5}</h1><p>{+7}</p><p>{+6}</p><p>{+4}</p></body>",
    "<body><h1>{+4}</h1><p>{+25}</p><h3><a>{-6}</a></h3><h3><a>{-5}</a></h3></body>",
    "<body><h1>{+3}</h1><p>{+12}</p><ul><li>{+2}</li><li>{+4}</li></ul><p>{+3}</p></body>",
    # adverts and comments without a telling name
    "<body><div class=q1><p>{-15}</p></div><article><h1>{+6}</h1><p>{+50}</p><p>{+7}</p></article><div class=q2><p>{-27}</p></div></body>",
    "<body><article><h1>{+6}</h1><p>{+50}</p></article><div class=z><div class=t><b>{-2}</b><p>{-44}</p></div><div class=t><b>{-2}</b><p>{-11}</p></div></div></body>",
    "<body><h1>{+6}</h1><p>{+61}</p><p>{+34}</p><div><div class=w1><div>{-2}</div><p>{-29}</p></div><div class=w1><div>{-3}</div><p>{-8}</p></div><div class=w1><div>{-2}</div><p>{-17}</p></div></div></body>",
    "<body><h1>{+5}</h1><p>{+40}</p><ul class=z><li><span>{-3}</span><p>{-30}</p></li><li><span>{-2}</span><p>{-19}</p></li></ul></body>",
    # telling names of furniture
    "<body><div class=site-menu><a>{-1}</a><a>{-1}</a></div><h1>{+6}</h1><p>{+33}</p><div class=ad-box>{-10}</div><p>{+28}</p><div class=comment-list><p>{-36}</p><p>{-25}</p></div></body>",
    "<body><header><h2>{-2}</h2></header><article><h1>{+5}</h1><p>{+28}</p><div class=advert><p>{-12}</p></div><p>{+36}</p><aside>{-20}</aside><form>{-4}</form></article><section id=comments><p>{-50}</p></section></body>",
    "<body><div id=cookie-consent>{-22}</div><div id=main><h1>{+5}</h1><p>{+47}</p><p>{+6}</p></div><div id=footer>{-11}</div></body>",
    # text in plain elements
    "<body><table><tr><td><a>{-1}</a></td></tr></table><div>{+50}</div><div>{+8}</div><div>{+42}</div><div><a>{-2}</a> <a>{-1}</a></div></body>",
    "<body><article><h1>{+4}</h1><div class=step><h3>{+2}</h3><p>{+13}</p></div><div class=step><h3>{+2}</h3><p>{+20}</p></div></article><div role=complementary>{-12}</div></body>",
    "<body><article><h1>{+4}</h1><ol><li><b>{+2}</b><p>{+13}</p></li><li><b>{+2}</b><p>{+22}</p></li></ol></article></body>",
)


def test_held_out_blocks():
    tree, table = html.trained(), html.labelled(HELD_OUT)
    got, want = np.array([tree(tuple(x[:-1])) for x in table]), table[:, -1] > 0
    precision, recall = (got & want).sum() / got.sum(), (got & want).sum() / want.sum()
    assert precision >= 0.97 and recall >= 0.97, (precision, recall)
    assert all(tree(tuple(x[:-1])) == x[-1] for x in html.labelled())
    used, todo = set(), [tree]
    while todo:
        node = todo.pop()
        if node.feature >= 0:
            used.add(html.NAMES[node.feature])
            todo += [node.low, node.high]
    assert used & {"words", "density"} and used & {"words before", "density before", "words after", "density after"} and used >= {"article", "titled", "alike", "prose name", "beside name"}


SENTENCES = ("The committee met on Monday and agreed on the first three points of the list.", "A second meeting, to be held in spring, will deal with the rest of them and with what was left open.")


@pytest.mark.parametrize("around", ["article", "main"])
@pytest.mark.parametrize("name", ["class=cookies-recipe", "class=share-price", "class='alert-history'", "id=social-policy", "id=menu", "class=related-work", "id=navigation"])
def test_a_name_alone_drops_no_text(around, name):
    page = f"<body><nav><a>Home</a></nav><{around}><h1>A title</h1><div {name}><p>{SENTENCES[0]}</p><p>{SENTENCES[1]}</p></div><p>Some more text stands here at the end.</p></{around}><footer>All rights reserved</footer></body>"
    assert html.main_text(page, html.trained()) == "\n".join(("A title", *SENTENCES, "Some more text stands here at the end."))


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<h1>How to</h1><ol><li>Take some flour</li><li>Add the water to it</li><li>Bake it</li></ol>", "How to\nTake some flour\nAdd the water to it\nBake it"),
        ("<h1>A short note</h1><p>It rained all day.</p><p>Nobody went out.</p><p>The end.</p>", "A short note\nIt rained all day.\nNobody went out.\nThe end."),
        (f"<h1>A title</h1><p>{SENTENCES[0]} {SENTENCES[1]}</p><p><a>Another title of this site</a></p><p><a>One more of them</a></p>", f"A title\n{SENTENCES[0]} {SENTENCES[1]}"),
        (f"<div class=q1><p>Buy our new shoes today, they are the best in town by far.</p></div><article><h1>A title</h1><p>{SENTENCES[1]}</p></article><div><p>{SENTENCES[0]}</p></div>", f"A title\n{SENTENCES[1]}"),
        (f"<h1>A title</h1><p>{SENTENCES[0]}</p><p>{SENTENCES[1]}</p><div><div class=k><b>Ann, 3 May</b><p>I don't agree with that at all.</p></div><div class=k><b>Bob</b><p>Nor do I, for what it is worth.</p><p>Really.</p></div></div>", f"A title\n{SENTENCES[0]}\n{SENTENCES[1]}"),
        ("<ul><li>one<li>two words<li><p>three</p><p>words here</p></ul>", "one\ntwo words\nthree\nwords here"),
    ],
)
def test_short_pages_adverts_and_comments_without_names(page, want):
    assert html.main_text(f"<body>{page}</body>", html.trained()) == want


def test_main_text_of_all_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r["page_id"]: r for r in queries.op10_main_text(spark, sf).collect()}
    import html as std

    for p in pages.collect():
        body = re.search(r"<article>(.*?)</article>", p["html"], re.S)[1]
        parts = [" ".join(std.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert got[p["page_id"]]["text"] == "\n".join(x for x in parts if x)
        assert got[p["page_id"]]["n_chars"] == len(got[p["page_id"]]["text"])


def test_pages_odd(spark):
    df = spark.createDataFrame([(1, "u", None, "x"), (1, "u", "", "x"), (None, None, PAGE, "x")], "page_id long, url string, html string, text string")
    got = html.extract(df, "page_id", "html", "url").collect()
    assert sorted(len(r["text"]) for r in got)[:2] == [0, 0] and max(len(r["text"]) for r in got) > 20
    assert html.extract(df.where("false"), "page_id", "html").collect() == []
