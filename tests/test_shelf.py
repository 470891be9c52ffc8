import threading
import time

import pytest
from pyspark.sql import functions as F

from quillstone.operators import index
from quillstone.plans import search as S
from quillstone.plans.catalogue import QUERIES
from quillstone.plans.shelf import Shelf, open_index

SCHEMA = "family string, qa_id string, authority string, legal_act string, date string, article string, topic string, joint_id string, question string, background string, answer string"


@pytest.fixture
def store(spark, tmp_path):
    acts = {"crr": "CRR", "crd": "CRD-RTS", "dora": "DORA"}
    rows = [(f, f"{f}_{i:03d}", "eba", a, f"2024-01-{1 + i % 28:02d}", "", "", "", f"thing {i}" if i % 2 else "nothing here", "", "") for f, a in acts.items() for i in range({"crr": 40, "crd": 10, "dora": 5}[f])]
    stored = index.with_haystack(spark.createDataFrame(rows, SCHEMA))
    store = open_index(spark, f"file://{tmp_path}/s", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored.schema))
    store.commit({"index": stored}, key="qa_id")
    return store


def test_the_manifest_decides_what_is_read(store):
    shelf = Shelf(store)
    assert shelf.families(["CRR"]) == ["crr"] and shelf.families(["CRD-RTS", "DORA"]) == ["crd", "dora"] and shelf.families(["Other"]) == shelf.families() == ["crd", "crr", "dora"]
    got = shelf.search("thing", ["CRD-RTS", "DORA"])
    assert {(r["hits"], r["loaded"]) for r in got.collect()} == {(7, 15)} and got.count() == 7
    assert list(shelf.kept) == ["crd", "dora"]
    # nothing is read to learn how many rows a search looked through
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
    shelf.close()


def test_a_search_that_is_not_to_prune_reads_and_counts_the_whole_index(spark, sf, store):
    shelf = Shelf(store)
    assert {(r["hits"], r["loaded"]) for r in shelf.search("thing", ["CRD-RTS", "DORA"], prune=False).collect()} == {(7, 55)}
    shelf.close()
    documents = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert {r["loaded"] for r in QUERIES["search_facets_topk"](spark, sf).collect()} == {documents}


def test_a_search_that_finds_nothing_tells_of_how_many(store):
    shelf = Shelf(store)
    row = shelf.search("nosuch", ["CRR"]).collect()
    assert len(row) == 1 and (row[0]["qa_id"], row[0]["hits"], row[0]["loaded"]) == (None, 0, 40)
    plain = S.search(store.read("index"), "nosuch").first()
    assert (plain["qa_id"], plain["hits"], plain["loaded"]) == (None, 0, 55)
    assert S.search(store.read("index"), "nosuch", count=False).count() == 0
    shelf.close()


def test_the_longest_unused_family_goes_first(store):
    shelf = Shelf(store, most_rows=45)
    assert shelf.search("thing", ["CRD-RTS"]).count() == 5 and shelf.search("thing", ["DORA"]).count() == 2
    assert list(shelf.kept) == ["crd", "dora"]
    kept = shelf.kept["dora"]
    assert kept.storageLevel.useMemory and shelf.search("thing", ["CRR"]).count() == 20
    assert list(shelf.kept) == ["dora", "crr"]
    assert shelf.search("", []).select("loaded").first()[0] == 55 and shelf.rows(list(shelf.kept)) <= 45
    large = Shelf(store, most_rows=20)
    assert large.search("thing", []).count() == 27 and "crr" not in large.kept
    shelf.close()
    large.close()


def test_a_newer_search_ends_the_one_before(spark):
    newest, got = S.Newest(spark), {}
    slow = lambda: spark.range(0, 10**11, 1, 4).agg(F.sum(F.sin("id"))).collect()

    def first():
        got["first"] = newest.run(slow)

    t = threading.Thread(target=first, daemon=True)
    t.start()
    time.sleep(3)
    began = time.time()
    assert newest.run(lambda: spark.range(10).count()) == 10
    t.join(60)
    assert not t.is_alive() and got["first"] is None and time.time() - began < 60
    with pytest.raises(ZeroDivisionError):
        newest.run(lambda: 1 / 0)
    assert newest.run(lambda: "again") == "again"
