"""Exact deduplication by composable polynomial fingerprints.

A text's fingerprint is its UTF-8 bytes, with each run of white space as one space, read as digits to the base 256, modulo two fixed
61-bit primes. Fingerprints compose: ``h(a + b) = h(a) * 256**len(b) + h(b)``; so the chunks of a huge text are hashed by different tasks
and combined after. Rows of equal fingerprint and length are candidates only: each is compared with the group's first row,
chunk by chunk, and rows that differ form a group of their own, until none differs.

A huge text is normalised and cut in one pass of the task that reads it; its chunks then go to other tasks.

Nulls: a null text is an empty one. A null doc_id comes after all others, and keep_id is null only where all ids of a group are.
Rows that repeat a doc_id and text are one document: all of them get the same decision. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, free_name, maybe_broadcast, named, only, own_columns

CHUNK = 1 << 16
#: Texts of more bytes are hashed by chunks that different tasks hold.
HUGE = 1 << 22
#: Rows of one group that meet the copy of its first row in one task at most.
GROUP_ROWS = 1000
_BLANKS = bytes.maketrans(b"\t\n\v\f\r", b"     ")
MODULI = (2305843009213693921, 2305843009213693907)  # the two largest primes below 2**61 - 1


def normalised(text: bytes) -> bytes:
    text = text.translate(_BLANKS)
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    return text


def combine(a: tuple[int, ...], b: tuple[int, ...], n: int, moduli: tuple[int, ...] = MODULI) -> tuple[int, ...]:
    """The fingerprint of two texts one after another; n: bytes of the second."""
    return tuple((x * pow(256, n, p) + y) % p for x, y, p in zip(a, b, moduli, strict=True))


def chunk_hash(chunk: bytes, moduli: tuple[int, ...] = MODULI) -> tuple[int, ...]:
    x = int.from_bytes(chunk, "big")
    return tuple(x % p for p in moduli)


def fingerprint(text: bytes, moduli: tuple[int, ...] = MODULI, chunk: int = CHUNK) -> tuple[int, ...]:
    out: tuple[int, ...] = (0,) * len(moduli)
    for i in range(0, len(text), chunk):
        part = text[i : i + chunk]
        out = combine(out, chunk_hash(part, moduli), len(part), moduli)
    return out


def _texts(column: pa.Array) -> Iterator[bytes]:
    for x in column.cast(pa.large_binary()):
        yield x.as_buffer().to_pybytes() if x.is_valid else b""


#: A document's id: whether it is missing, and its number. Missing ones come last.
KEY = ["none", "key"]
GROUP = ["fp1", "fp2", "n_bytes"]
_KEY_TYPE = "none boolean, key long"


def _rows(docs: DataFrame) -> DataFrame:
    rows = own_columns(docs, "doc_id", "text")
    return rows.select(F.isnull("doc_id").alias("none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("key"), F.col("text").cast("string").alias("text"))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _cut(batches: Iterator[pa.RecordBatch], schema: pa.Schema, chunk: int, head) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
    """Rows (what head says of the key, the row and the normalised text; pos, chunk) of all texts, some megabytes at a time."""
    rows, size = [], 0
    for b in batches:
        others = [c.to_pylist() for c, name in zip(b.columns, b.schema.names, strict=True) if name != "text"]
        for at, raw in zip(zip(*others, strict=True), _texts(b.column("text")), strict=True):
            text = normalised(raw)
            first = head(at, text)
            for i in range(0, max(1, len(text)), chunk):
                rows.append((*first, i // chunk, text[i : i + chunk]))
                size += min(chunk, len(text)) + 64
                if size > 1 << 23:
                    yield _batch(rows, schema)
                    rows, size = [], 0
    if rows:
        yield _batch(rows, schema)


def fingerprints(docs: DataFrame, moduli: tuple[int, ...] = MODULI, huge: int = HUGE, chunk: int = CHUNK) -> DataFrame:
    """Per row: none, key, fp1, fp2, n_bytes, sha (hex of SHA-256), all of the normalised text."""
    key = [("none", pa.bool_()), ("key", pa.int64())]
    prints = [(c, pa.int64()) for c in GROUP]

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*key, *prints, ("sha", pa.string())])
        for b in batches:
            texts = [normalised(t) for t in _texts(b.column("text"))]
            rows = [(none, k, *fingerprint(t, moduli, chunk), len(t), hashlib.sha256(t).hexdigest()) for none, k, t in zip(b.column("none").to_pylist(), b.column("key").to_pylist(), texts, strict=True)]
            yield _batch(rows, schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*key, ("row", pa.int64()), ("sha", pa.string()), ("pos", pa.int32()), ("chunk", pa.binary())])
        return _cut(batches, schema, chunk, lambda at, text: (*at, hashlib.sha256(text).hexdigest()))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*key, ("row", pa.int64()), ("sha", pa.string()), ("pos", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("n", pa.int64())])
        for b in batches:
            found = [(*chunk_hash(t, moduli), len(t)) for t in _texts(b.column("chunk"))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *(pa.array([x[i] for x in found], pa.int64()) for i in range(3))], schema=schema)

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*key, *prints, ("sha", pa.string())])
        for b in batches:
            rows = []
            for none, k, sha, parts in zip(*(b.column(c).to_pylist() for c in ("none", "key", "sha", "parts")), strict=True):
                fp, n = (0, 0), 0
                for p in parts:
                    fp, n = combine(fp, (p["h1"], p["h2"]), p["n"], moduli), n + p["n"]
                rows.append((none, k, *fp, n, sha))
            yield _batch(rows, schema)

    out = f"{_KEY_TYPE}, fp1 long, fp2 long, n_bytes long, sha string"
    rows = _rows(docs)
    is_huge = F.coalesce(F.octet_length("text"), F.lit(0)) > huge
    big = rows.where(is_huge).select(*KEY, F.monotonically_increasing_id().alias("row"), "text").mapInArrow(cut, f"{_KEY_TYPE}, row long, sha string, pos int, chunk binary")
    big = big.repartition(F.col("row"), F.col("pos")).mapInArrow(hashed, f"{_KEY_TYPE}, row long, sha string, pos int, h1 long, h2 long, n long")
    big = big.groupBy("row", *KEY, "sha").agg(F.array_sort(F.collect_list(F.struct("pos", "h1", "h2", "n"))).alias("parts")).select(*KEY, "sha", "parts")
    return rows.where(~is_huge).mapInArrow(small, out).unionByName(big.mapInArrow(folded, out))


def _chunks(rows: DataFrame, moduli: tuple[int, ...], chunk: int) -> DataFrame:
    schema = pa.schema([("none", pa.bool_()), ("key", pa.int64()), *[(c, pa.int64()) for c in GROUP], ("pos", pa.int32()), ("chunk", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _cut(batches, schema, chunk, lambda at, text: (*at, *fingerprint(text, moduli, CHUNK), len(text)))

    return rows.mapInArrow(cut, f"{_KEY_TYPE}, fp1 long, fp2 long, n_bytes long, pos int, chunk binary")


def exact_dedup(docs: DataFrame, moduli: tuple[int, ...] = MODULI, huge: int = HUGE, chunk: int = CHUNK) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256 (see the module's text)."""
    scratch = Scratch(docs.sparkSession, "exact")
    prints = scratch.cut(fingerprints(docs, moduli, huge, chunk))
    rows, me = _rows(docs), F.struct(*KEY)
    member, left, done = [*KEY, *GROUP], prints.select(*KEY, *GROUP), []
    while True:
        # the first row of each group, and its size: tables of groups, never lists of rows
        groups = scratch.cut(left.groupBy(*GROUP).agg(F.min(me).alias("keep"), F.count(F.lit(1)).alias("size")).where("size > 1"))
        n_groups = groups.count()
        if not n_groups:
            break
        pairs = scratch.cut(left.join(maybe_broadcast(groups, n_groups), GROUP))
        n_pairs = pairs.count()
        ids = pairs.select(*KEY).distinct()
        texts = _chunks(rows.join(maybe_broadcast(ids, n_pairs), KEY, "left_semi"), moduli, chunk)
        mine = maybe_broadcast(pairs.dropDuplicates(member), n_pairs)
        split = F.ceil(F.col("size") / GROUP_ROWS).cast("int")
        texts = texts.join(mine, member).withColumn("salt", F.pmod(F.xxhash64("key"), split).cast("int"))
        is_first = F.col("keep") == me
        first = texts.where(is_first).dropDuplicates([*GROUP, "pos"])
        first = first.select(*GROUP, "pos", F.col("chunk").alias("kept_chunk"), F.explode(F.sequence(F.lit(0), split - 1)).alias("salt"))
        same = texts.where(~is_first).join(first, [*GROUP, "pos", "salt"]).select(*member, (F.col("chunk") == F.col("kept_chunk")).alias("same"))
        differ = scratch.cut(same.where("NOT same").select(*member).distinct())
        n_differ = differ.count()
        if not n_differ:
            done.append(pairs)
            break
        differ = maybe_broadcast(differ, n_differ)
        done.append(pairs.join(differ, member, "left_anti"))
        left = scratch.cut(pairs.select(*member).join(differ, member, "left_semi"))
    out = prints.withColumnRenamed("sha", "text_sha256")
    if done:
        found = done[0]
        for x in done[1:]:
            found = found.unionByName(x)
        if len(done) > 1:  # groups have lost rows
            found = found.drop("size")
            sizes = found.groupBy(*GROUP, "keep").agg(F.count(F.lit(1)).alias("size"))
            found = found.join(sizes, [*GROUP, "keep"])
        out = out.join(found.select(*member, "keep", "size").dropDuplicates(member), member, "left")
    else:
        out = out.withColumns({"keep": me, "size": F.lit(1).cast("long")})
    keep = F.coalesce("keep", me)
    id_of = lambda k: F.when(~k["none"], k["key"])
    out = out.select(id_of(me).alias("doc_id"), id_of(keep).alias("keep_id"), F.coalesce("size", F.lit(1)).cast("long").alias("group_size"), (keep == me).alias("kept"), "text_sha256")
    out = scratch.cut(out)
    scratch.drop_all_but(out)
    return out


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of docs that exact_dedup keeps, with all their columns; of rows that repeat an id and a text, one stays."""
    scratch = Scratch(docs.sparkSession, "deduplicated")
    none, key, sha = free_name(docs, "_none"), free_name(docs, "_key"), free_name(docs, "_sha")
    names = [none, key, sha]
    found = exact_dedup(docs)
    copies = found.groupBy(F.isnull("doc_id").alias(none), F.coalesce("doc_id", F.lit(0)).alias(key), F.col("text_sha256").alias(sha)).agg(F.bool_and("kept").alias("stays"), F.count(F.lit(1)).alias("n"))
    copies = scratch.cut(copies.where("n > 1 OR NOT stays").select(*names, "stays"))
    scratch.drop(found)
    digest = F.sha2(F.regexp_replace(F.coalesce(named(docs, "text").cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " "), 256)
    doc_id = named(docs, "doc_id").cast("long")
    rows = docs.withColumns({none: F.isnull(doc_id), key: F.coalesce(doc_id, F.lit(0)), sha: digest})
    n = copies.count()
    out = rows.join(maybe_broadcast(copies.select(*names), n), names, "left_anti")
    again = copies.where("stays")
    if not again.isEmpty():
        again = rows.join(maybe_broadcast(again.select(*names), n), names, "left_semi")
        out = out.unionByName(again.dropDuplicates(names))
    return only(out, docs.columns)
