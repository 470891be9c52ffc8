"""The search language, and searches as plans.

A query is words, "phrases" and /patterns/, joined by AND (which may be left out) and OR. It is parsed on the driver into a list of alternatives, each a
list of terms, and folded into one predicate, so a search is a scan with cheap filters first and a top-k, and nothing else.
"""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import act_family, html_escaped, nz

# Typographic quotes by the plain ones they stand for; words that don't narrow a search; marks around a word.
DOUBLE, SINGLE = "“”„‟«»", "‘’‚‛"
STOP = frozenset("an and are as at be by for in is it of on or the to with".split())
LEADING, TRAILING = "/(\"'[", ")\"'],.;:!?"
LIMIT = 200
Found = TypeVar("Found")


@dataclass(frozen=True)
class Term:
    kind: str  # word, phrase or pattern
    value: str


def parse_query(text: str) -> list[list[Term]]:
    """Alternatives of terms that must all match; empty: everything matches."""
    text = text.translate(str.maketrans(dict.fromkeys(DOUBLE, '"') | dict.fromkeys(SINGLE, "'")))
    groups: list[list[Term]] = [[]]
    for token in re.findall(r'"[^"]*"|/[^/]*/|\S+', text):
        word = token.lower()
        if word == "or":
            if groups[-1]:
                groups.append([])
        elif word == "and":
            continue
        elif token.startswith('"'):
            phrase = " ".join(word.strip('"').split())
            if phrase:
                groups[-1].append(Term("phrase", phrase))
        elif len(token) > 2 and token.startswith("/") and token.endswith("/"):
            groups[-1].append(Term("pattern", token[1:-1]))
        else:
            word = word.lstrip(LEADING).rstrip(TRAILING)
            if len(word) >= 2 and word not in STOP:
                groups[-1].append(Term("word", word))
    return [g for g in groups if g]


def _valid(pattern: str) -> bool:
    try:
        re.compile(pattern)
    except re.error:
        return False
    return True


def pattern_of(term: Term, collapsed: bool = True) -> str:
    """A term as a regular expression. Words match at their beginning, by ASCII word boundaries; a pattern that is none matches as it stands."""
    if term.kind == "pattern" and _valid(term.value):
        return term.value
    quoted = re.escape(term.value)
    if term.kind == "phrase":
        return quoted if collapsed else quoted.replace(r"\ ", r"\s+")
    if term.kind == "word" and re.match(r"[A-Za-z0-9_]", term.value):
        return r"(?<![A-Za-z0-9_])" + quoted
    return quoted


def matches(groups: list[list[Term]], hay: Column) -> Column:
    """The predicate on a haystack (lower case, white space collapsed)."""

    def one(t: Term) -> Column:
        if t.kind == "phrase" or (t.kind == "pattern" and not _valid(t.value)):
            return F.contains(hay, F.lit(t.value.lower()))
        if t.kind == "word":
            # the word itself first, by plain search, and what stands before it only where it is
            quoted = re.escape(t.value)
            there = F.contains(hay, F.lit(t.value))
            return there & F.rlike(hay, F.lit(f"{quoted}(?<![a-z0-9_]{quoted})")) if re.match(r"[a-z0-9_]", t.value) else there
        return F.rlike(hay, F.lit("(?iu)" + pattern_of(t)))

    if not groups:
        return F.lit(True)
    out = None
    for g in groups:
        every = None
        for t in g:
            every = one(t) if every is None else every & one(t)
        out = every if out is None else out | every
    return out


def highlighted(groups: list[list[Term]], col: Column) -> Column:
    """Escaped text with what the query's terms match in <mark>; null without terms."""
    terms = [pattern_of(t, collapsed=False) for g in groups for t in g]
    if not terms:
        return F.lit(None).cast("string")
    return F.regexp_replace(html_escaped(col), f"(?iu)({'|'.join(terms)})", "<mark>$1</mark>")


def facets(acts: list[str] = (), authority: str = "", date_from: str = "", date_to: str = "") -> Column:
    """Filters beside the text. With a date bound, rows without a date are out."""
    keep = F.lit(True)
    if acts:
        keep &= F.col("legal_act").isin(list(acts))
    if authority:
        keep &= F.col("authority") == authority
    date = F.nullif(F.col("date"), F.lit(""))
    if date_from:
        keep &= date >= date_from
    if date_to:
        keep &= date <= date_to
    return keep


def needed_families(acts: list[str], present: list[str]) -> list[str]:
    """Families to read for the acts chosen: those among the present ones, or all if none is."""
    wanted = {re.sub(r"[^a-z0-9]+", "-", a.split("-")[0].strip().lower()).strip("-") or "unsorted" for a in acts}
    return sorted(wanted & set(present)) or sorted(present)


def newest_first() -> list[Column]:
    """No date last; then by id falling."""
    return [F.nullif(F.col("date"), F.lit("")).desc_nulls_last(), F.collate(F.col("qa_id"), "UNICODE").desc(), F.col("qa_id").desc()]


def search(index: DataFrame, query: str = "", acts: list[str] = (), authority: str = "", date_from: str = "", date_to: str = "", families: list[str] | None = None, limit: int = LIMIT, count: bool = True, loaded: int | None = None) -> DataFrame:
    """Hits, newest first, the first ``limit`` of them, and how many there are (hits) of how many read (loaded).

    Families prune partitions. The top-k is merged from each task's own. Both counts are one row, to which the hits are joined, so a search that finds nothing still
    tells of how many: it returns one row of nulls and the counts. loaded: how many rows the index has, if that is known (from a manifest).
    """
    rows = index.where(F.col("family").isin(families)) if families else index
    hit = facets(acts, authority, date_from, date_to) & matches(parse_query(query), F.col("hay"))
    best = rows.where(hit).orderBy(*newest_first()).limit(limit)
    if not count:
        return best
    known = loaded is not None
    n = (rows.where(hit) if known else rows).agg((F.count(F.lit(1)) if known else F.count_if(hit)).alias("hits"), (F.lit(loaded).cast("long") if known else F.count(F.lit(1))).alias("loaded"))  # one row
    names = best.columns
    return n.join(best.withColumn("_hit", F.lit(True)), F.col("_hit"), "left").select(*names, "hits", "loaded")


class Newest:
    """Of searches that come one after another only the newest counts: a new one ends the jobs of the one before."""

    def __init__(self, spark: SparkSession):
        self.spark, self._lock, self._n, self._tag = spark, threading.Lock(), 0, None

    def run(self, make: Callable[[], Found]) -> Found | None:
        """What make returns, its jobs run with a tag of their own; None if a newer search has come since. To be called from any thread."""
        with self._lock:
            self._n += 1
            mine, before, self._tag = self._n, self._tag, f"search-{uuid.uuid4().hex}"
            tag = self._tag
        sc = self.spark.sparkContext
        if before:
            sc.cancelJobsWithTag(before)
        sc.addJobTag(tag)
        sc.setInterruptOnCancel(True)
        try:
            found = make()
        except Exception:
            if mine != self._n:
                return None  # ended by a newer one
            raise
        finally:
            sc.removeJobTag(tag)
        return found if mine == self._n else None


def facet_options(index: DataFrame) -> DataFrame:
    """(kind, value): acts, their base names and authorities to choose from."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in (("act", F.col("legal_act")), ("base", F.split_part("legal_act", F.lit("-"), F.lit(1))), ("authority", F.col("authority")))])
    return index.select(F.explode(kinds).alias("o")).select("o.*").where(nz(F.col("value")) != "").distinct()


def family_of(col: Column) -> Column:
    return act_family(col)
