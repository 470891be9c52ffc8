"""The Markdown corpus, its state and its run log: reading and writing."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import LEGAL_NOTICES, iso_date, lookup, nz, strip, yaml_quoted, yaml_value

_HEAD = r"(?s)\A---\n(.*?)\n---\n(.*)\z"
# The line that ends a record's answer begins with this.
NOTE = "> **Disclaimer.**"


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """file, family (its folder), text: one row per Markdown file below path."""
    raw = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md")
    parts = F.split(F.col("_metadata.file_path"), "/")
    return raw.select(F.element_at(parts, -1).alias("file"), F.element_at(parts, -2).alias("family"), F.col("value").alias("text"))


def split_head(files: DataFrame) -> DataFrame:
    """Adds head and body; files without a head are left out."""
    return files.withColumns({"head": F.regexp_extract("text", _HEAD, 1), "body": F.regexp_extract("text", _HEAD, 2)}).where(F.rlike("text", F.lit(_HEAD))).drop("text")


def head_map(head: Column) -> Column:
    """The head's keys and values."""
    lines = F.filter(F.split(head, "\n"), lambda x: F.contains(x, F.lit(": ")) | F.rlike(x, F.lit(":$")))
    pairs = F.transform(lines, lambda x: F.struct(F.split_part(x, F.lit(":"), F.lit(1)).alias("k"), yaml_value(F.regexp_replace(x, "^[^:]*:", "")).alias("v")))
    # the first of a repeated key
    first = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, 1, i), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(first)


def section(body: Column, name: str) -> Column:
    """Question, Background or Answer; an answer's inner rules stay, the note after it doesn't."""
    ends = {"Question": r"\n## (?:Background|Answer)\b", "Background": r"\n## Answer\b", "Answer": r"\n---\n+" + NOTE.replace("*", r"\*").replace(".", r"\.")}
    return strip(F.regexp_extract(body, rf"(?s)(?:^|\n)## {name}[ \t]*\n(.*?)(?:{ends[name]}|\z)", 1))


def prefixed(head: Column, prefix: str) -> Column:
    some = F.map_filter(head, lambda k, _: F.startswith(k, F.lit(prefix)))
    return F.transform_keys(some, lambda k, _: F.substring(k, F.lit(len(prefix) + 1), F.length(k)))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of a corpus folder, with all that their heads and sections hold."""
    return records_of(read_files(spark, path))


def records_of(files: DataFrame) -> DataFrame:
    """files: file, family, text (Markdown documents). The twins of dates that markdown() adds are left out; index_rows makes them anew."""
    rows = split_head(files).withColumn("m", head_map(F.col("head")))
    scalars = ("authority", "qa_id", "joint_id", "legal_act", "legal_act_ref", "legal_act_raw", "article", "topic", "status", "source_url", "retrieved_at")
    dates = F.map_filter(prefixed(F.col("m"), "date_"), lambda k, _: ~F.endswith(k, F.lit("_iso")))
    slug = F.regexp_replace(F.regexp_replace("file", r"\.md$", ""), "^[^-]*-", "")
    return rows.select(*[nz(F.col("m")[c]).alias(c) for c in scalars], slug.alias("slug"), "family", "file", dates.alias("dates"), prefixed(F.col("m"), "x_").alias("extra"), *[section(F.col("body"), s).alias(s.lower()) for s in ("Question", "Background", "Answer")])


def read_record(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The record file of a key "authority:slug", the first by path."""
    authority, slug = key.split(":", 1)
    rows = read_files(spark, path).where(F.col("file") == f"{authority}-{slug}.md")
    return rows.orderBy("family").limit(1)


def markdown(with_time: bool = True) -> Column:
    """A record as a Markdown document; without retrieved_at, it is what the content hash covers."""
    line = lambda k, c: F.concat(F.lit(f"{k}: "), yaml_quoted(c))
    dates = F.flatten(
        F.transform(
            F.array_sort(F.map_entries("dates")),
            lambda e: F.concat(
                F.array(F.concat(F.lit("date_"), e["key"], F.lit(": "), yaml_quoted(e["value"]))),
                F.when(iso_date(e["value"]) != "", F.array(F.concat(F.lit("date_"), e["key"], F.lit("_iso: "), yaml_quoted(iso_date(e["value"]))))).otherwise(F.array().cast("array<string>")),
            ),
        )
    )
    extra = F.transform(F.array_sort(F.map_entries("extra")), lambda e: F.concat(F.lit("x_"), e["key"], F.lit(": "), yaml_quoted(e["value"])))
    upper = F.upper("authority")
    notice = F.concat(F.lit("© "), upper, F.lit(" — reuse subject to "), lookup(F.col("authority"), LEGAL_NOTICES, "the authority's legal notice"))
    fields = [line(k, F.col(k)) for k in ("qa_id", "joint_id", "legal_act", "legal_act_ref", "legal_act_raw", "article", "topic", "status")]
    head = [F.array(F.lit("---"), F.concat(F.lit("authority: "), F.col("authority")), *fields), dates, extra, F.array(line("source_url", F.col("source_url")), line("license", notice))]
    if with_time:
        head.append(F.array(line("retrieved_at", F.col("retrieved_at"))))
    shown = lambda c: F.when(nz(F.col(c)) == "", "*(not captured)*").otherwise(F.col(c))
    background = F.when(nz(F.col("background")) == "", F.array().cast("array<string>")).otherwise(F.array(F.lit("## Background"), F.lit(""), F.col("background"), F.lit("")))
    title = F.concat(F.lit("# "), upper, F.lit(" Q&A "), F.col("qa_id"))
    note = F.concat(F.lit(f"{NOTE} Unofficial copy made by a program, without any warranty; check it against the original before relying on it: <"), F.col("source_url"), F.lit(">."))
    body = [F.array(F.lit("---"), F.lit(""), title, F.lit(""), F.lit("## Question"), F.lit(""), shown("question"), F.lit("")), background, F.array(F.lit("## Answer"), F.lit(""), shown("answer"), F.lit(""), F.lit("---"), F.lit(""), note, F.lit(""))]
    return F.array_join(F.concat(*head, *body), "\n")


def content_hash() -> Column:
    """Sixteen hex digits over the document without its retrieval time."""
    return F.substring(F.sha2(markdown(with_time=False), 256), 1, 16)


def export_markdown(records: DataFrame, folder: str) -> int:
    """One file per record below family folders, for people; the parquet copy is the one to compute with. Files appear whole (written aside, then renamed).

    folder: an address that pyarrow opens, or a path that all executors mount.
    """
    rows = records.select("family", F.concat_ws("-", "authority", "slug").alias("name"), markdown().alias("text"))

    def write(batches):  # noqa: ANN001, ANN202
        import pandas as pd
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)
        n, made = 0, set()
        for b in batches:
            for family, name, text in b.itertuples(index=False):
                if family not in made:
                    system.create_dir(f"{root}/{family}")
                    made.add(family)
                path = f"{root}/{family}/{name}.md"
                aside = f"{path}.{uuid.uuid4().hex}.tmp"
                with system.open_output_stream(aside) as f:
                    f.write(text.encode())
                system.move(aside, path)
                n += 1
        yield pd.DataFrame({"n": [n]})

    return rows.mapInPandas(write, "n long").agg(F.sum("n")).first()[0] or 0


def write_records(records: DataFrame, path: str) -> None:
    """The canonical copy, partitioned by family, replaced as a whole."""
    records.write.mode("overwrite").partitionBy("family").parquet(path)


def read_state(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """State and meta from a JSON file with the sections records, verified_at and last_full_sweep, any of which may be absent."""
    schema = "records MAP<STRING,STRING>, verified_at MAP<STRING,STRING>, last_full_sweep STRING"
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    hashes = raw.select(F.explode_outer("records").alias("key", "hash")).where("key IS NOT NULL")
    times = raw.select(F.explode_outer("verified_at").alias("key", "verified_at")).where("key IS NOT NULL")
    return hashes.join(times, "key", "full").select("key", nz(F.col("hash")).alias("hash"), nz(F.col("verified_at")).alias("verified_at")), raw.select(nz(F.col("last_full_sweep")).alias("last_full_sweep"))


def write_state(state: DataFrame, path: str) -> None:
    """A new version of the state table; path must not be what state was read from."""
    state.write.mode("overwrite").parquet(path)


def state_lines(state: DataFrame, last_full_sweep: str) -> DataFrame:
    """The state as lines of one JSON document, keys in order: section and key say where a line stands."""
    pair = lambda v: F.regexp_replace(F.to_json(F.create_map(F.col("key"), v)), r"^\{|\}$", "")
    parts = [(2, "records", state.where(nz(F.col("hash")) != "").select("key", pair(F.col("hash")).alias("line"))), (4, "verified_at", state.where(nz(F.col("verified_at")) != "").select("key", pair(F.col("verified_at")).alias("line")))]
    text = lambda at, line: state.sparkSession.createDataFrame([(at, "", line)], "section int, key string, line string")
    out = text(0, "{").unionByName(text(0, f'"last_full_sweep": {json.dumps(last_full_sweep)},').withColumn("section", F.lit(1)))
    for at, name, rows in parts:
        last = rows.agg(F.max("key").alias("_last"))  # one row
        rows = rows.join(F.broadcast(last)).select(F.lit(at).alias("section"), "key", F.concat(F.lit("  "), "line", F.when(F.col("key") == F.col("_last"), "").otherwise(",")).alias("line"))
        out = out.unionByName(text(at, f'"{name}": {{')).unionByName(rows).unionByName(text(at + 1, "}," if name == "records" else "}"))
    return out.unionByName(text(6, "}"))


def write_state_json(state: DataFrame, last_full_sweep: str, path: str, files: int = 1) -> None:
    """The state as a JSON document that people can compare: sorted, a line per key. Several files, one after another, make up the document."""
    lines = state_lines(state, last_full_sweep)
    lines.repartitionByRange(files, "section", "key").sortWithinPartitions("section", "key").select("line").write.mode("overwrite").text(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The run log. Counters that a line doesn't have are null, not 0."""
    return spark.read.schema(schemas.RUN).json(path)


def append_run(run: DataFrame, path: str, limited: bool = False) -> None:
    """One line of the run log; limited runs aren't logged."""
    if not limited:
        run.coalesce(1).write.mode("append").json(path)


def run_rows(runs: DataFrame) -> DataFrame:
    """A row per run and authority."""
    return runs.select("ts", "mode", "full", F.explode("totals").alias("authority", "t")).select("ts", "mode", "full", "authority", "t.*")
