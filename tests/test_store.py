import pytest
from pyspark.sql import functions as F

from quillstone.sources.store import Conflict, Store, bucket

TABLES = {"records": ("key string, family string, text string", "family"), "state": ("key string, hash string, bucket string", "bucket")}


def rows(spark, *xs):
    return spark.createDataFrame(list(xs), TABLES["records"][0])


def states(spark, *xs):
    return spark.createDataFrame(list(xs), "key string, hash string").withColumn("bucket", bucket("key"))


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/s", TABLES)


def first(spark, store):
    return store.commit({"records": rows(spark, ("a", "crr", "1"), ("b", "crr", "2"), ("c", "dora", "3"), ("d", "a b/c=%", "4")), "state": states(spark, ("a", "x"), ("b", "y"))})


def test_a_commit_writes_only_what_it_touches(spark, store):
    assert store.version().number == 0 and store.read("records").count() == 0
    assert first(spark, store).number == 1
    v = store.commit({"records": rows(spark, ("c", "dora", "new"), ("e", "psd2", "5"))})
    assert got(store.manifest("records")) == [("a b/c=%", 1, 1), ("crr", 2, 1), ("dora", 1, 2), ("psd2", 1, 2)]
    assert got(store.read("records")) == [("a", "crr", "1"), ("b", "crr", "2"), ("c", "dora", "new"), ("d", "a b/c=%", "4"), ("e", "psd2", "5")]
    assert got(store.read("state").select("key", "hash")) == [("a", "x"), ("b", "y")] and v.of("state") == store.version(1).of("state")
    # the version before stays as it was
    assert got(store.read("records", version=store.version(1))) == [("a", "crr", "1"), ("b", "crr", "2"), ("c", "dora", "3"), ("d", "a b/c=%", "4")]


def test_a_moved_key_leaves_its_old_part_and_an_emptied_part_goes(spark, store):
    first(spark, store)
    store.commit({"records": rows(spark, ("a", "dora", "moved"), ("d", "crr", "moved"))})
    assert got(store.manifest("records")) == [("crr", 2, 2), ("dora", 2, 2)]
    store.commit({}, gone={"records": spark.createDataFrame([("b",), ("d",), ("zz",)], "key string")})
    assert got(store.read("records")) == [("a", "dora", "moved"), ("c", "dora", "3")]
    assert got(store.manifest("records")) == [("dora", 2, 2)]


def test_nothing_changed_writes_no_data(spark, store, tmp_path):
    first(spark, store)
    files = lambda: sorted(str(p) for p in (tmp_path / "s" / "data").rglob("*.parquet"))
    before = files()
    assert store.commit({"records": rows(spark).where("false")}).number == 2 and files() == before


def test_a_failed_commit_leaves_the_old_version_readable(spark, store):
    first(spark, store)
    bad = rows(spark, ("a", "crr", "x")).withColumn("text", F.expr("raise_error('lost')"))
    with pytest.raises(Exception, match="lost"):
        store.commit({"state": states(spark, ("a", "changed")), "records": bad})
    assert store.version().number == 1
    assert got(store.read("state").select("key", "hash")) == [("a", "x"), ("b", "y")]
    assert ("a", "crr", "1") in got(store.read("records"))
    # the files it left are in nobody's way, and go with the next cleaning
    store.commit({"records": rows(spark, ("a", "crr", "fine"))})
    assert ("a", "crr", "fine") in got(store.read("records"))
    assert any(f.startswith("state/") for f in store.vacuum(1)) and store.numbers() == [2]
    assert got(store.read("state").select("key", "hash")) == [("a", "x"), ("b", "y")] and store.read("records").count() == 4


def test_of_two_commits_on_one_version_the_second_is_refused(spark, store):
    first(spark, store)
    base = store.version()
    store.commit({"records": rows(spark, ("a", "crr", "one"))}, base=base)
    with pytest.raises(Conflict):
        store.commit({"records": rows(spark, ("b", "crr", "two"))}, base=base)
    assert got(store.read("records", ["crr"])) == [("a", "crr", "one"), ("b", "crr", "2")]


def test_readers_open_only_the_families_they_name(spark, store):
    first(spark, store)
    files = store.read("records", ["crr", "nosuch"]).inputFiles()
    assert files and all("family=crr" in f for f in files)
    assert store.read("records", ["nosuch"]).count() == 0
