"""Searches over a stored index that read only the families they need.

The index lies in a store, a part per family, with the haystack that searches read, so no text is read or folded again. The manifest tells which families there
are and how many rows each has: it decides which are opened, and how many rows a search looked through, without reading any.
"""

from __future__ import annotations

from collections import OrderedDict
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..schemas import INDEX_ROW
from ..sources.store import Store, Version
from . import search as S

SCHEMA = f"family STRING, {INDEX_ROW}, hay STRING"
TABLES = {"index": (SCHEMA, "family")}


def open_index(spark: SparkSession, path: str, schema: str = SCHEMA) -> Store:
    return Store(spark, path, {"index": (schema, "family")})


class Shelf:
    """Families of an index that searches have read lately stay in memory, up to most_rows rows; the longest unused go first. Larger families are read each time."""

    def __init__(self, store: Store, most_rows: int = 1_000_000, version: Version | None = None):
        self.store, self.most_rows = store, most_rows
        self.version = version or store.version()
        self.kept: OrderedDict[str, DataFrame] = OrderedDict()

    def families(self, acts: list[str] = ()) -> list[str]:
        """Families that a search for these acts must read, by the manifest."""
        return S.needed_families(list(acts), list(self.version.of("index")))

    def rows(self, families: list[str]) -> int:
        return sum(self.version.of("index")[f].rows for f in families)

    def loaded(self, families: list[str]) -> DataFrame:
        """The rows of families, in memory if there is room for them."""
        small = [f for f in families if self.rows([f]) <= self.most_rows]
        for f in small:
            if f in self.kept:
                self.kept.move_to_end(f)
            else:
                self.kept[f] = self.store.read("index", [f], self.version).persist()
        large = [f for f in families if f not in self.kept]
        parts = [self.kept[f] for f in small]
        if large or not parts:
            parts.append(self.store.read("index", large, self.version))
        self._make_room()
        return reduce(DataFrame.unionByName, parts)

    def _make_room(self) -> None:
        while len(self.kept) > 1 and self.rows(list(self.kept)) > self.most_rows:
            self.kept.popitem(last=False)[1].unpersist()  # a search still running reads it from its files

    def search(self, query: str = "", acts: list[str] = (), prune: bool = True, **more: object) -> DataFrame:
        """As search.search(), over the families that the acts need; loaded is their rows. prune=False: over the whole index, whose rows are counted as they are read."""
        families = self.families(acts if prune else ())
        return S.search(self.loaded(families), query, acts=acts, loaded=self.rows(families) if prune else None, **more)

    def close(self) -> None:
        while self.kept:
            self.kept.popitem()[1].unpersist()
