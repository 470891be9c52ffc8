"""Counters, completeness and digests of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import COUNTERS


def totals(events: DataFrame) -> DataFrame:
    """events: authority, event (a counter's name). One row per authority with all seven counters."""
    return events.groupBy("authority").agg(*[F.count_if(F.col("event") == c).alias(c) for c in COUNTERS])


def completeness(events: DataFrame) -> DataFrame:
    """events: authority, event, ok. complete: no event said otherwise; errors: how many there were."""
    return events.groupBy("authority").agg(F.bool_and("ok").alias("complete"), F.count_if(F.col("event") == "errors").alias("errors"))


def run_ok(total: DataFrame) -> DataFrame:
    return total.agg(F.coalesce(F.bool_and(F.col("errors") == 0), F.lit(True)).alias("ok"))


def state_digest(state: DataFrame) -> DataFrame:
    """SHA-256 over the sorted state: of each of 4096 hash ranges first, so that no task holds all rows, then of those digests in order."""
    line = F.concat_ws("=", "key", "hash")
    part = F.substring(F.sha2(F.col("key"), 256), 1, 3)
    parts = state.groupBy(part.alias("part")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("digest"))
    return parts.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "part", "digest"))), "\n"), 256).alias("state_sha256"))


def run_row(total: DataFrame, state: DataFrame, now: str, sweep: bool, authorities: tuple[str, ...], full: bool = False) -> DataFrame:
    """The run log's row: when, in what mode, over which authorities, their counters, and the digest of the state it left."""
    counters = F.map_from_entries(F.array_sort(F.collect_list(F.struct("authority", F.struct(*COUNTERS)))))
    rows = total.agg(counters.alias("totals")).join(state_digest(state))  # one row and one row
    return rows.select(F.lit(now).alias("ts"), F.lit("sweep" if sweep else "incremental").alias("mode"), F.array(*[F.lit(a) for a in sorted(authorities)]).alias("authorities"), F.lit(full).alias("full"), "state_sha256", "totals")


def exit_status(total: DataFrame) -> int:
    """0 after a run without errors, else 1."""
    return 0 if run_ok(total).first()["ok"] else 1


def console_summary(total: DataFrame) -> str:
    """A line per authority, for whoever started the run."""
    shown = ("enumerated", "checked", "written", "archived", "delisted", "errors")
    return "".join(f"{r['authority']}: {', '.join(f'{r[c]} {c}' for c in shown)}\n" for r in total.orderBy("authority").collect())


def sweep_watermark(old: str, today: str, sweep: bool, ok: bool, limited: bool, all_authorities: bool) -> str:
    """The day of the last full sweep: today only after a green, unlimited sweep over all authorities."""
    return today if sweep and ok and not limited and all_authorities else old


def summary_table(total: DataFrame) -> str:
    """Markdown for people: a row per authority."""
    rows = total.orderBy("authority").collect()
    head = f"| authority | {' | '.join(COUNTERS)} |\n|---|{'---|' * len(COUNTERS)}\n"
    return head + "".join(f"| {r['authority']} | {' | '.join(str(r[c]) for c in COUNTERS)} |\n" for r in rows)
