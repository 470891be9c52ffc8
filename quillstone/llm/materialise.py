"""Training-order materialisation: every sequence gets a global slot by a keyed permutation, and shards hold a fixed stride.

Documents become token ids with an end id, cut into sequences of ``length`` ids (the last one padded). A sequence's index is its rank by doc_id, the text's hash
and its start: documents are dealt by ranges in that order, each task numbers its own sequences, the encoded table is written once to the shared folder, and an
index is the sequences of earlier tasks and then the own number. So it hangs on the data alone, not on the files they lie in or are written to, and no list of sequences is
ever gathered.
A Feistel network over the next even power of two, walked until it falls below the number of sequences, maps indices one-to-one to slots.
Slots are dealt by range: slot ``s`` is record ``s % per_shard`` of shard ``s // per_shard``. All records take ``2 * length`` bytes (unsigned
16-bit ids), so a reader seeks to any slot, and resumes from one, without an index. A manifest in slot order says which piece of which document a slot holds.

Nulls: a null text is empty, and has the end id alone. Rows that repeat an id get sequences each. An empty table gives an empty result. Only
doc_id and text are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, own_columns
from .tokens import default_path, encoded
from .words import U, mix

LENGTH, PER_SHARD, KEY, PAD, END = 512, 4096, 20_261, 0, 1
ROUNDS = 6
#: Shares of the shards that are shuffled and written one after another.
PASSES = 4


def feistel(index: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """A one-to-one map of 0 to n - 1 onto itself. Values that leave the range are mapped again (at most four times on average)."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    mask = U((1 << half) - 1)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=U) + mix(np.array([key], U))[0])

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> U(half), x & mask
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & mask)
        return left << U(half) | right

    x = once(index.astype(U))
    while (out := np.flatnonzero(x >= U(n))).size:
        x[out] = once(x[out])
    return x.astype(np.int64)


def sequences(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """Per sequence: doc_id, start, n_ids (without padding), record (length unsigned 16-bit ids), task and place (from 0, in the task); tasks stand in order."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, place = TaskContext.get().partitionId(), 0
        for b in batches:
            for lo, texts in encoded(b.column("text"), path, END):
                row, start, n, record = [], [], [], []
                for i, x in enumerate(texts):
                    for at in range(0, len(x), length):
                        part = x[at : at + length].astype("<u2")
                        row.append(lo + i)
                        start.append(at)
                        n.append(len(part))
                        record.append(part.tobytes() + PAD.to_bytes(2, "little") * (length - len(part)))
                own = [pa.array(np.full(len(row), task, np.int32)), pa.array(np.arange(place, place + len(row)))]
                place += len(row)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(record, pa.binary()), *own], ["doc_id", "start", "n_ids", "record", "task", "place"])

    rows = own_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.isnull("doc_id"), "doc_id", F.xxhash64("text"), "_n"]  # rows alike may go anywhere, so that a lot of them fill several ranges
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("_n", F.monotonically_increasing_id()).repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")
    return rows.mapInArrow(run, "doc_id long, start long, n_ids long, record binary, task int, place long")


def indexed(docs: DataFrame, scratch: Scratch, path: str | None = None, length: int = LENGTH) -> tuple[DataFrame, int]:
    """(per sequence: doc_id, start, n_ids, record, index; how many there are), of a table encoded once."""
    table = scratch.cut(sequences(docs, path, length), "zstd")
    tasks = table.groupBy("task").agg(F.count(F.lit(1)).alias("_n"))  # a row per task of the encoding, shuffle partitions at most
    lower = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = scratch.cut(tasks.select("task", "_n", F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_before")))
    total = tasks.agg(F.sum("_n")).first()[0] or 0
    table = table.join(F.broadcast(tasks.drop("_n")), "task")
    return table.select("doc_id", "start", "n_ids", "record", (F.col("_before") + F.col("place")).alias("index")), total


def slotted(table: DataFrame, total: int, per_shard: int = PER_SHARD, key: int = KEY, first: int = 0, shards: int | None = None) -> DataFrame:
    """indexed() rows with slot, shard and position in place of index; only those of so many shards from the first on, if given."""
    names = ["doc_id", "start", "n_ids", "record"]

    def slot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = feistel(b.column("index").to_numpy(), total, key)
            rows = np.arange(len(s)) if shards is None else np.flatnonzero((s >= first * per_shard) & (s < (first + shards) * per_shard))
            s, some = s[rows], pa.array(rows)
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(some) for c in names), pa.array(s), pa.array(s // per_shard), pa.array(s % per_shard)], [*names, "slot", "shard", "position"])

    return table.mapInArrow(slot, "doc_id long, start long, n_ids long, record binary, slot long, shard long, position long")


def placed(docs: DataFrame, path: str | None = None, length: int = LENGTH, per_shard: int = PER_SHARD, key: int = KEY) -> DataFrame:
    """Per sequence: doc_id, start, n_ids, record, and slot, shard, position. Not yet in slot order."""
    table, total = indexed(docs, Scratch(docs.sparkSession, "materialise"), path, length)
    return slotted(table, total, per_shard, key)


def in_training_order(records: DataFrame, first: int, shards: int) -> DataFrame:
    """Records of so many shards from the first on, dealt by ranges, each shard whole in one task, in slot order. Slots are evenly filled, so the ranges need no sampling."""
    n = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return records.repartitionById(n, F.expr(f"int((shard - {first}) * {n} div {shards})")).sortWithinPartitions("slot")


MANIFEST = "doc_id long, start long, n_ids long, slot long, shard long, position long"


def write_shards(table: DataFrame, total: int, folder: str, scratch: Scratch, per_shard: int = PER_SHARD, key: int = KEY) -> DataFrame:
    """indexed() rows as files shard-NNNNNN.bin of fixed-stride records in a folder that executors reach: a path they all mount, or an address that pyarrow opens.

    They are written in PASSES passes of consecutive shards, so the disk holds the shuffle of one of them at a time. Returns the manifest, a Parquet table below the folder: which piece of which document each slot holds, in slot order within its files. A shard is written
    under another name and then renamed, so a task that runs again replaces it whole; what failed attempts leave is removed at the end.
    """
    names = [c.split()[0] for c in MANIFEST.split(", ")]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _file_system(folder)
        fs.create_dir(root)
        out, current = None, None
        part = f"{root}/.writing-{uuid.uuid4().hex}"

        def close() -> None:
            if out:
                out.close()
                fs.move(part, f"{root}/shard-{current:06d}.bin")

        for b in batches:
            for shard, record in zip(b.column("shard").to_pylist(), b.column("record").to_pylist(), strict=True):
                if shard != current:
                    close()
                    current, out = shard, fs.open_output_stream(part)
                out.write(record)
            yield b.select(names)
        close()

    at = folder if ":" in folder else f"file://{folder}"
    shards = max(1, -(-total // per_shard))
    step = -(-shards // PASSES)
    for first in range(0, shards, step):
        some = min(step, shards - first)
        rows = in_training_order(slotted(table, total, per_shard, key, first, some), first, some).mapInArrow(write, MANIFEST)
        scratch.lean(rows).write.mode("overwrite").parquet(f"{at}/manifest/turn={first // step}")
    fs, root = _file_system(folder)
    for f in fs.get_file_info(pa.fs.FileSelector(root, allow_not_found=True)):
        if f.base_name.startswith(".writing-"):
            fs.delete_file(f.path)
    return table.sparkSession.read.schema(f"{MANIFEST}, turn int").parquet(f"{at}/manifest").select(*names)


def materialised(docs: DataFrame, folder: str, path: str | None = None, length: int = LENGTH, per_shard: int = PER_SHARD, key: int = KEY) -> DataFrame:
    """docs as shards in a folder; the manifest. The encoded table goes as soon as the shards stand."""
    scratch = Scratch(docs.sparkSession, "materialise")
    table, total = indexed(docs, scratch, path, length)
    manifest = write_shards(table, total, folder, scratch, per_shard, key)
    scratch.drop_all_but()
    return manifest


def with_records(manifest: DataFrame, folder: str, length: int = LENGTH) -> DataFrame:
    """The manifest's rows with their records as the shards hold them, read on from slot to slot; only a gap makes a reader seek."""
    names = [c.split()[0] for c in MANIFEST.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _file_system(folder)
        source, current, at = None, None, -1
        for b in batches:
            found = []
            for shard, position in zip(b.column("shard").to_pylist(), b.column("position").to_pylist(), strict=True):
                if shard != current:
                    if source:
                        source.close()
                    source, current, at = fs.open_input_file(f"{root}/shard-{shard:06d}.bin"), shard, 0
                if position != at:
                    source.seek(position * 2 * length)
                found.append(source.read(2 * length))
                at = position + 1
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(found, pa.binary())], [*names, "record"])
        if source:
            source.close()

    return manifest.select(*names).mapInArrow(read, f"{MANIFEST}, record binary")


def _file_system(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder) if ":" in folder else (pa.fs.LocalFileSystem(), folder)


def read_slots(folder: str, first: int, n: int, length: int = LENGTH, per_shard: int = PER_SHARD) -> Iterator[np.ndarray]:
    """n records from slot first on, read in sequence."""
    fs, root = _file_system(folder)
    at, end = first, first + n
    while at < end:
        shard, rows = at // per_shard, min(end - at, per_shard - at % per_shard)
        with fs.open_input_file(f"{root}/shard-{shard:06d}.bin") as f:
            f.seek(at % per_shard * 2 * length)
            for _ in range(rows):
                yield np.frombuffer(f.read(2 * length), "<u2")
        at += rows
