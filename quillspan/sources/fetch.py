"""Fetching: URLs are rows, and so are their results and failures.

URLs are spread by host, since a host's spacing must be held in one place; hosts run beside each other. URLs without spacing
are spread one by one. Fetchers are
callables, so that tests and offline runs read files.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import time
from collections.abc import Callable, Iterator
from pathlib import Path
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillspan.functions import retry
from quillspan.functions.text import is_fresh

SCHEMA = "url string, status string, body string, error string"
FETCH_SPACING = 0.2
#: Tasks a core that fetch; rows and characters of a batch that a task gives back.
SPREAD, BATCH_ROWS, BATCH_CHARS = 4, 256, 4 << 20


class FileFetcher:
    """Bodies from a shared folder, by quoted URL; what isn't there is not found."""

    def __init__(self, root: str):
        self.root = root

    def path(self, url: str) -> Path:
        return Path(self.root) / quote(url, safe="")

    def __call__(self, url: str) -> str:
        try:
            return self.path(url).read_text(encoding="utf-8")
        except FileNotFoundError:
            raise retry.NotFound(url) from None


def fetch(urls: DataFrame, get: Callable[[str], str], url: str = "url", spacing: float | str = FETCH_SPACING, retries: int = 3, **schedule) -> DataFrame:
    """url, status (ok, missing or failed), body and error of each distinct URL. A failure never stops the others.

    spacing: seconds between calls to one host, or the column that holds them.
    """

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, pa.string()) for v in zip(*rows, strict=True)], names=["url", "status", "body", "error"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[str, float] = {}
        held, size = [], 0
        for rb in batches:
            for u, apart in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), strict=True):
                host = urlsplit(u).netloc
                wait = last[host] + apart - time.monotonic() if host in last else 0.0
                if wait > 0:
                    time.sleep(wait)
                last[host] = time.monotonic()
                try:
                    row = (u, "ok", retry.call(lambda u=u: get(u), retries=retries, **schedule), None)
                except retry.NotFound:
                    row = (u, "missing", None, "not found")
                except Exception as e:  # noqa: BLE001
                    row = (u, "failed", None, f"{type(e).__name__}: {e}")
                held.append(row)
                size += len(row[2] or "")
                if len(held) >= BATCH_ROWS or size >= BATCH_CHARS:
                    yield batch(held)
                    held, size = [], 0
        if held:
            yield batch(held)

    apart = F.coalesce(F.max(F.col(spacing).cast("double")), F.lit(FETCH_SPACING)) if isinstance(spacing, str) else F.lit(float(spacing))
    rows = urls.where(F.col(url).isNotNull()).groupBy(F.col(url).alias("url")).agg(apart.alias("apart"))
    place = F.when(F.col("apart") > 0, F.parse_url("url", F.lit("HOST"))).otherwise(F.col("url"))
    return rows.repartition(SPREAD * urls.sparkSession.sparkContext.defaultParallelism, place).mapInArrow(run, SCHEMA)


def read_through(urls: DataFrame, cache: DataFrame | None, get: Callable[[str], str], store: Callable[[DataFrame], DataFrame], now: Column, days: float = 7, **options) -> DataFrame:
    """Bodies of urls: fresh cache rows (url, body, stored_at) answer first, only the rest is fetched.

    store writes what was fetched and reads it back, so that nothing is fetched twice.
    """
    wanted = urls.select("url").where("url is not null").distinct()
    if cache is None:
        return store(fetch(wanted, get, **options))
    kept = cache.where(is_fresh(F.col("stored_at"), now, days)).groupBy("url").agg(F.max_by("body", "stored_at").alias("body"))
    hit = wanted.join(kept, "url").select("url", F.lit("cached").alias("status"), "body", F.lit(None).cast("string").alias("error"))
    return hit.unionByName(store(fetch(wanted.join(kept, "url", "left_anti"), get, **options)))


def typed(pages: DataFrame) -> DataFrame:
    """Adds http to fetched pages: 404 missing, 429 limited, 401 not let in, 204 an empty body, 500 other failures, else 200."""
    low = F.lower(F.coalesce("error", F.lit("")))
    refused = low.rlike("401|403|unauthorized")
    failed = F.when(low.rlike("429|rate limit|^limited"), 429).when(refused, 401).otherwise(500)
    blank = ~F.coalesce("body", F.lit("")).rlike(r"\S")
    return pages.withColumn("http", F.when(F.col("status") == "missing", 404).when(F.col("status") == "failed", failed).when(blank, 204).otherwise(200))


def snapshot_date(meta: str | None, today: dt.date) -> str:
    """Date of a snapshot's metadata; a week before `today` (a date) without any."""
    try:
        return str(json.loads(meta or "")["meta"]["date"])
    except (ValueError, KeyError, TypeError):
        return str(today - dt.timedelta(days=7))


def title_list(pages: DataFrame, body: str = "body") -> DataFrame:
    """number and name of each title in a titles document."""
    return pages.select(F.inline(F.from_json(body, "titles array<struct<number:int,name:string>>")["titles"]))


def title_parts(structure: DataFrame, body: str = "body") -> DataFrame:
    """Adds parts: part numbers of a structure document, ascending, from any depth; empty for documents that can't be read.

    Depth is not bounded, so no fixed JSON schema fits: an Arrow function.
    """

    @F.arrow_udf("array<int>")
    def of(col: pa.Array) -> pa.Array:
        out = []
        for text in col.to_pylist():
            found = []
            try:
                stack = [json.loads(text or "null")]
            except ValueError:
                stack = []
            while stack:
                node = stack.pop()
                if isinstance(node, dict):
                    m = re.match(r"\s*(\d+)", str(node.get("identifier") or "")) if node.get("type") == "part" else None
                    if m:
                        found.append(int(m[1]))
                    if isinstance(node.get("children"), list):
                        stack.extend(node["children"])
            out.append(sorted(found))
        return pa.array(out, pa.list_(pa.int32()))

    return structure.withColumn("parts", of(F.col(body)))
