"""Tables in versions: a commit writes only the parts that changed, and shows all of its tables at once.

A store holds tables, each in parts by one column (a record's family, a bucket of state keys). A version is a manifest: for every part of every table the folder that
holds it and its rows; parts are few, as the driver holds that list. A commit writes the parts it touches into a folder of its own, then puts the next manifest in place by
a rename that fails if another has taken its number (on file systems whose renames are atomic); until then readers see the version before, and a commit that dies leaves nothing but files that no manifest names. Parts that
didn't change keep their folders, so a run's cost hangs on what it changes. Manifests list parts, so a reader that wants some families opens only their files.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import remove

#: Parts that state is kept in.
BUCKETS = 64


class Conflict(RuntimeError):
    """Another commit has taken the version that this one was to make."""


def bucket(key: Column | str, buckets: int = BUCKETS) -> Column:
    """The part of a table that is kept by keys alone."""
    return F.lpad((F.crc32(F.col(key) if isinstance(key, str) else key) % buckets).cast("string"), 4, "0")


@dataclass(frozen=True)
class Part:
    folder: str
    rows: int
    version: int


@dataclass(frozen=True)
class Version:
    """number 0 is the empty store. parts: table -> part -> where it lies."""

    number: int = 0
    parts: dict[str, dict[str, Part]] = field(default_factory=dict)

    def of(self, table: str) -> dict[str, Part]:
        return self.parts.get(table, {})


class Store:
    """tables: name -> (schema as DDL, with the column that parts go by, and that column's name)."""

    def __init__(self, spark: SparkSession, path: str, tables: dict[str, tuple[str, str]]):
        self.spark, self.path, self.tables = spark, path.rstrip("/"), tables
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.path).toUri() if ":" in self.path else self._fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
        self._no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)

    # --- reading

    def numbers(self) -> list[int]:
        """Committed versions, rising."""
        at = self._path(f"{self.path}/versions")
        names = [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def version(self, number: int | None = None) -> Version:
        """The newest version, or one of a number."""
        number = max(self.numbers(), default=0) if number is None else number
        if not number:
            return Version()
        text = self.spark.read.text(f"{self.path}/versions/{number:012d}.json", wholetext=True).first()[0]
        return Version(number, {t: {p: Part(*x) for p, x in parts.items()} for t, parts in json.loads(text).items()})

    def read(self, table: str, parts: list[str] | None = None, version: Version | None = None) -> DataFrame:
        """A table, or some parts of it: only their folders are listed and opened."""
        schema, by = self.tables[table]
        there = (version or self.version()).of(table)
        folders = [p.folder for name, p in sorted(there.items()) if parts is None or name in parts]
        whole = T.StructType.fromDDL(schema)
        if not folders:
            return self.spark.createDataFrame([], whole)
        # the part's column comes from the folder's name
        inner = T.StructType([f for f in whole.fields if f.name != by] + [T.StructField(by, T.StringType())])
        rows = self.spark.read.schema(inner).option("basePath", f"{self.path}/data").parquet(*[f"{self.path}/data/{f}" for f in folders])
        return rows.select(*[f.name for f in whole.fields])

    def manifest(self, table: str, version: Version | None = None) -> DataFrame:
        """part, rows, version (that wrote it) of each of a table's parts."""
        there = (version or self.version()).of(table)
        return self.spark.createDataFrame([(name, p.rows, p.version) for name, p in sorted(there.items())], "part string, rows long, version long")

    # --- writing

    def commit(self, changes: dict[str, DataFrame], gone: dict[str, DataFrame] | None = None, key: str = "key", base: Version | None = None) -> Version:
        """A version with the rows of changes in place of those of the same key, in their part or any other, and without the keys in gone.

        Of each table only parts are written that a changed or gone key is in or was in. base: the version that the changes were made from (default: the newest);
        if it isn't the newest any more, the commit is a Conflict and changes nothing.
        """
        base = base or self.version()
        number, attempt = base.number + 1, uuid.uuid4().hex
        parts = {t: dict(p) for t, p in base.parts.items()}
        gone = gone or {}
        for table in {**changes, **gone}:
            schema, by = self.tables[table]
            names = [f.name for f in T.StructType.fromDDL(schema).fields]
            old = self.read(table, version=base)
            new = changes[table].select(*names) if table in changes else self.spark.createDataFrame([], schema)
            keys = new.select(key)
            keys = (keys.unionByName(gone[table].select(key)) if table in gone else keys).distinct()
            # a row per part; only keys and parts are read of the old rows
            was = old.select(key, by).join(keys, key, "left_semi").select(by)
            touched = sorted(r[0] for r in was.unionByName(new.select(by)).distinct().collect())
            if not touched:
                continue
            stay = self.read(table, [p for p in touched if p in base.of(table)], base).join(keys, key, "left_anti")
            folder = f"{table}/v={number}-{attempt}"
            stay.unionByName(new).write.partitionBy(by).parquet(f"{self.path}/data/{folder}")
            rows = self._counted(folder, by)
            mine = parts.setdefault(table, {})
            for part in touched:
                mine.pop(part, None)
                if rows.get(part):
                    mine[part] = Part(f"{folder}/{by}={self._escaped(part)}", rows[part], number)
        return self._publish(Version(number, parts), attempt)

    def _counted(self, folder: str, by: str) -> dict[str, int]:
        """Rows by part of a folder just written, from its files' footers."""
        at = f"{self.path}/data/{folder}"
        if not any(s.isDirectory() for s in self._fs.listStatus(self._path(at))):
            return {}
        rows = self.spark.read.schema(f"{by} string").parquet(at).groupBy(by).agg(F.count(F.lit(1)).alias("n"))
        return {r[0]: r["n"] for r in rows.collect()}

    def _escaped(self, part: str) -> str:
        return self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(part)

    def _publish(self, version: Version, attempt: str) -> Version:
        text = json.dumps({t: {p: [x.folder, x.rows, x.version] for p, x in parts.items()} for t, parts in version.parts.items()}, sort_keys=True)
        aside, at = (self._path(f"{self.path}/versions/{n}") for n in (f".{attempt}", f"{version.number:012d}.json"))
        out = self._fs.create(aside, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        try:
            self._files.rename(aside, at, self._no_options)
        except Exception as e:
            self._fs.delete(aside, False)
            if self._fs.exists(at):
                raise Conflict(f"version {version.number} of {self.path} is there already") from e
            raise
        return version

    def vacuum(self, keep: int = 2) -> list[str]:
        """Removes all but the newest versions, and folders that none of them names; not to run beside a commit. The folders removed."""
        numbers = self.numbers()
        kept = [self.version(n) for n in numbers[-max(1, keep) :]]
        for n in numbers[: -max(1, keep)]:
            remove(self.spark.sparkContext, f"{self.path}/versions/{n:012d}.json")
        named = {"/".join(p.folder.split("/")[:2]) for v in kept for parts in v.parts.values() for p in parts.values()}
        gone = []
        for table in self.tables:
            at = self._path(f"{self.path}/data/{table}")
            for f in self._fs.listStatus(at) if self._fs.exists(at) else []:
                folder = f"{table}/{f.getPath().getName()}"
                if folder not in named:
                    remove(self.spark.sparkContext, f"{self.path}/data/{folder}")
                    gone.append(folder)
        return sorted(gone)
