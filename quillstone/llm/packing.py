"""Shortest-pack-first packing over the length histogram.

Documents become token ids, and those over ``width`` are cut into pieces of it and a rest. Only the histogram of piece lengths (``width``
numbers at most) goes to the driver. Lengths are placed longest first: each into the packs with the most room left of those that hold it (the
shortest packs), many at a time; where none has room, into new ones. A pattern is a list of lengths and a number of packs. Patterns then give each
rank of each length a sequence and an offset, and pieces meet them by their length and seeded rank.

Nulls: a null text is empty, and has the end id alone. Rows that repeat an id are packed each. An empty table gives an empty result. Only doc_id
and text are read. A text of any length is encoded whole.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, own_columns, ranked
from .tokens import default_path, encoded

WIDTH = 2048
END = 1


def pieces(docs: DataFrame, path: str | None = None, width: int = WIDTH, end: int = END) -> DataFrame:
    """Per piece: doc_id, start, length, doc_tokens, ids (little-endian unsigned 32-bit)."""
    path = path or default_path()
    names = ["doc_id", "start", "length", "doc_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column("doc_id")
            for lo, texts in encoded(b.column("text"), path, end):
                row, start, length, total, ids = [], [], [], [], []
                for i, x in enumerate(texts):
                    for at in range(0, len(x), width):
                        part = x[at : at + width]
                        row.append(lo + i)
                        start.append(at)
                        length.append(len(part))
                        total.append(len(x))
                        ids.append(part.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, total)), pa.array(ids, pa.binary())], names)

    rows = own_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, start long, length long, doc_tokens long, ids binary")


def patterns(histogram: dict[int, int], width: int = WIDTH) -> list[tuple[list[int], int]]:
    """(lengths, packs) by shortest-pack-first: at most one new pattern per length and split, whatever the counts."""
    by_room: dict[int, list[tuple[list[int], int]]] = {}
    rooms: list[int] = []  # sorted
    done: list[tuple[list[int], int]] = []

    def put(lengths: list[int], packs: int, room: int) -> None:
        if room == 0:
            done.append((lengths, packs))
            return
        if room not in by_room:
            by_room[room] = []
            bisect.insort(rooms, room)
        by_room[room].append((lengths, packs))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left > 0:
            if not rooms or rooms[-1] < length:
                each = width // length  # new packs hold several at once
                full, rest = divmod(left, each)
                if full:
                    put([length] * each, full, width - each * length)
                if rest:
                    put([length] * rest, 1, width - rest * length)
                break
            room = rooms[-1]
            lengths, packs = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                rooms.pop()
            use = min(packs, left)
            if packs > use:
                put(lengths, packs - use, room)
            put([*lengths, length], use, room - length)
            left -= use
    for room in rooms:
        done.extend(by_room[room])
    return done


def placements(packed: list[tuple[list[int], int]]) -> dict[int, np.ndarray]:
    """For each length the runs of ranks: (first rank, first sequence, offset, ranks a sequence apart of 1) by first rank."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    first = 0
    for lengths, packs in packed:
        offset = 0
        for length in lengths:
            rank = used.get(length, 0)
            runs.setdefault(length, []).append((rank, first, offset))
            used[length] = rank + packs
            offset += length
        first += packs
    return {k: np.array(v, np.int64) for k, v in runs.items()}


def pack(parts: DataFrame, width: int = WIDTH, seed: int = 0) -> DataFrame:
    """parts: a written table of pieces (doc_id, start, length and more). Adds sequence_id and offset."""
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # width rows at most
    runs = placements(patterns(histogram, width))
    place = parts.sparkSession.sparkContext.broadcast(runs)  # a run per length and pattern

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            sequence, offset = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            order = np.argsort(length, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(some):
                    run = place.value[int(length[some[0]])]
                    k = np.searchsorted(run[:, 0], rank[some], "right") - 1
                    sequence[some], offset[some] = run[k, 1] + rank[some] - run[k, 0], run[k, 2]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sequence), pa.array(offset)], [*b.schema.names[:-1], "sequence_id", "offset"])

    keyed = ranked(parts, "length", ["doc_id", "start", "ids_crc32"], seed=seed).select(*parts.columns, F.col("rank").cast("long").alias("rank"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema)
    return keyed.mapInArrow(put, schema + ", sequence_id long, offset long")


def packed(docs: DataFrame, path: str | None = None, width: int = WIDTH, seed: int = 0) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    scratch = Scratch(docs.sparkSession, "packing")
    parts = pieces(docs, path, width).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return pack(scratch.cut(parts), width, seed)
