"""Sessions with the settings the engine expects."""

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive plans, and cheap small files (a corpus of Markdown is thousands of those)."""
    b = SparkSession.builder.appName("quillstone").config("spark.sql.session.timeZone", "UTC")
    b = b.config("spark.sql.adaptive.enabled", "true").config("spark.sql.files.openCostInBytes", "65536")
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, which import it by name, once per application."""
    if getattr(spark.sparkContext, "_quillstone_sent", False):
        return
    root, folder = Path(__file__).resolve().parent, tempfile.mkdtemp(prefix="quillstone-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # the driver serves it as long as it runs
    path = f"{folder}/quillstone.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(path)
    spark.sparkContext._quillstone_sent = True


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; one of our own only where none is set and all runs in one process."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="quillstone-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")
