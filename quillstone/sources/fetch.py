"""Landing pages over HTTP, politely: one task per host, spaced requests, waits that grow, errors kept with their rows.

What comes back is a table to be written as it is; all else starts from such landed tables, so a page is asked for once.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AGENT = "quillstone (landing pages of a question-and-answer corpus)"
SCHEMA = "url string, status int, body string, error string"


@dataclass(frozen=True)
class Policy:
    """Seconds between requests to a host; statuses that may pass; how often to try again, and how long to wait before."""

    delay: float = 1.5
    again: tuple[int, ...] = (429, 500, 502, 503, 504)
    tries: int = 3
    first_wait: float = 15.0
    longest_wait: float = 300.0
    heeds_server: bool = True  # whether a Retry-After header counts
    caps_network: bool = False  # whether waits after network errors are capped too

    def wait(self, attempt: int, said: str | None = None, network: bool = False) -> float:
        grown = self.first_wait * 2**attempt
        if network:
            return min(self.longest_wait, grown) if self.caps_network else grown
        asked = int(said) if self.heeds_server and said and said.strip().isdigit() else 0
        return min(self.longest_wait, asked or grown)


PAGES = Policy()
#: The register's service: 400 passes as well, more tries, shorter waits.
REGISTER = Policy(delay=0.0, again=(400, 408, 429, 500, 502, 503, 504), tries=6, first_wait=3.0, longest_wait=30.0, heeds_server=False, caps_network=True)


def get(url: str, body: str | None, headers: dict[str, str], policy: Policy, sleep: Callable[[float], None] = time.sleep) -> tuple[int | None, str | None, str | None]:
    """(status, body, error) of one address, after as many tries as the policy has."""
    for attempt in range(policy.tries + 1):
        last = attempt == policy.tries
        try:
            request = urllib.request.Request(url, body.encode() if body is not None else None, {"User-Agent": AGENT, **headers})  # noqa: S310
            with urllib.request.urlopen(request, timeout=60) as r:  # noqa: S310
                return r.status, r.read().decode(r.headers.get_content_charset() or "utf-8", "replace"), None
        except urllib.error.HTTPError as e:
            if e.code not in policy.again or last:
                return e.code, None, f"status {e.code}"
            sleep(policy.wait(attempt, e.headers.get("Retry-After")))
        except (OSError, ValueError) as e:
            if last or isinstance(e, ValueError):
                return None, None, f"{type(e).__name__}: {e}"
            sleep(policy.wait(attempt, network=True))
    return None, None, "not tried"


def fetched(requests: DataFrame, policy: Policy = PAGES, headers: dict[str, str] | None = None) -> DataFrame:
    """requests: url, and body for a POST of JSON. Per row: url, status, body, error (null if all went well).

    A host's requests go through one task, in the order of their addresses, so that its spacing holds. To be written at once: reading the result twice asks twice.
    """
    sent = dict(headers or {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, float] = {}
        for b in batches:
            rows = []
            for host, url, body in zip(*(b.column(c).to_pylist() for c in ("host", "url", "body")), strict=True):
                time.sleep(max(0.0, policy.delay - (time.monotonic() - seen.get(host, float("-inf")))))
                more = {"Content-Type": "application/json"} if body is not None else {}
                rows.append((url, *get(url or "", body, more | sent, policy)))
                seen[host] = time.monotonic()
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.string(), pa.string()), strict=True)], ["url", "status", "body", "error"])

    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z]+://([^/?#]*)", 1)), F.lit(""))
    body = F.col("body").cast("string") if "body" in requests.columns else F.lit(None).cast("string")
    rows = requests.select(host.alias("host"), F.col("url").cast("string").alias("url"), body.alias("body"))
    return rows.repartition("host").sortWithinPartitions("host", "url").mapInArrow(run, SCHEMA)
