import subprocess
import sys
import threading
from pathlib import Path

from pyspark.sql import functions as F

from quillstone.scratch import BATCH_ROWS, Scratch

ROOT = Path(__file__).resolve().parent.parent
RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def batch_sizes(batches):
    for b in batches:
        yield b.assign(n=len(b))[["n"]]


def test_small_batches_while_writing_and_settings_as_they_were(spark):
    before = spark.conf.get(RECORDS)
    scratch = Scratch(spark, "t")
    sizes = scratch.cut(spark.range(50_000).mapInPandas(batch_sizes, "n long"))
    assert sizes.agg(F.max("n")).first()[0] <= BATCH_ROWS and spark.conf.get(RECORDS) == before
    assert sizes.sparkSession is spark


def test_two_at_once_leave_the_settings_alone(spark):
    before, seen = spark.conf.get(RECORDS), []

    def work(k):
        scratch = Scratch(spark, f"t{k}")
        for _ in range(4):
            seen.append((scratch.cut(spark.range(20_000).mapInPandas(batch_sizes, "n long")).agg(F.max("n")).first()[0], spark.conf.get(RECORDS)))

    threads = [threading.Thread(target=work, args=(k,)) for k in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(seen) == 12 and all(n <= BATCH_ROWS and conf == before for n, conf in seen)


def test_dropped_tables_go_and_others_stay(spark, tmp_path):
    scratch = Scratch(spark, "t", under=f"file://{tmp_path}")
    a, b, c = (scratch.cut(spark.range(3)) for _ in range(3))
    scratch.drop(a)
    scratch.drop_all_but(c)
    at = next(p for p in tmp_path.iterdir())
    assert [p.name for p in at.iterdir() if not p.name.startswith(".")] == ["3"] and c.count() == 3


PROGRAM = """
import shutil, sys
sys.path.insert(0, {root!r})
from quillstone.scratch import Scratch
from quillstone.session import session
spark = session("local[2]", 2, **{{"spark.ui.enabled": "false", "spark.checkpoint.dir": "file://" + sys.argv[1]}})
Scratch(spark, "nothing-written")
two = Scratch(spark, "two")
two.cut(spark.range(5)); two.cut(spark.range(5))
odd = Scratch(spark, "odd", under="nosuchscheme://x")
one = Scratch(spark, "one")
assert one.cut(spark.range(5)).count() == 5
{end}
"""


def leftovers(tmp_path, end):
    subprocess.run([sys.executable, "-c", PROGRAM.format(root=str(ROOT), end=end), str(tmp_path)], check=True, timeout=300, capture_output=True)
    return [p for p in tmp_path.rglob("*") if p.is_file()]


def test_the_shared_folder_is_empty_after_stop(tmp_path):
    assert leftovers(tmp_path, "spark.stop()") == []


def test_the_shared_folder_is_empty_after_an_end_without_stop(tmp_path):
    assert leftovers(tmp_path, "") == []
