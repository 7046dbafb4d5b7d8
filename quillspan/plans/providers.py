"""Pluggable providers for what needs a network, with deterministic offline stubs."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from functools import reduce
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillspan.functions import retry
from quillspan.functions.text import tokens
from quillspan.operators.control import Control

EMBED_BATCH, UPSERT_BATCH, MAX_TOKENS = 64, 100, 8191
#: Calls that a limited text is part of at most; seconds by which a round may be ahead of its rows' due times.
ATTEMPTS, TOGETHER = 4, 0.5
#: What a provider's call may end in.
RATE_LIMIT, TOKEN_LIMIT, CONTENT_FILTER, API_ERROR, BLANK = "RATE_LIMIT", "TOKEN_LIMIT", "CONTENT_FILTER", "API_ERROR", "BLANK"


class ProviderError(Exception):
    def __init__(self, code: str, message: str):
        super().__init__(message)
        self.code = code


def error_code(e: BaseException) -> str:
    """The code of a provider's error: its own, or by the HTTP status and type that it carries."""
    if isinstance(e, ProviderError):
        return e.code
    status = getattr(e, "status", None)
    if isinstance(e, retry.Limited) or status == 429:
        return RATE_LIMIT
    return CONTENT_FILTER if status == 400 and getattr(e, "type", None) == "invalid_request_error" else API_ERROR


def generated(generate: Callable[[str], str], prompt: str) -> str:
    """generate(prompt); any failure, an answer without text too, is a ProviderError with its code."""
    said = {RATE_LIMIT: "rate limit exceeded", CONTENT_FILTER: "content filter triggered"}
    try:
        out = generate(prompt)
    except Exception as e:
        code = error_code(e)
        raise ProviderError(code, f"{said.get(code, 'no answer')}: {type(e).__name__}: {e}") from e
    if not out:
        raise ProviderError(API_ERROR, "no text in the answer")
    return out


class Embedder(Protocol):
    dimensions: int

    def __call__(self, texts: list[str]) -> np.ndarray: ...


class HashEmbedder:
    """Unit vectors that depend on the text alone."""

    def __init__(self, dimensions: int = 64):
        self.dimensions = dimensions

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimensions), np.float32)
        for i, t in enumerate(texts):
            seed = int.from_bytes(hashlib.sha256(t.encode()).digest()[:8], "little")
            out[i] = np.random.default_rng(seed).standard_normal(self.dimensions)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


class Geocoder(Protocol):
    def __call__(self, address: str) -> dict | None: ...


class Generator(Protocol):
    def __call__(self, prompt: str) -> str: ...


class EchoGenerator:
    """Cites every source of the prompt once."""

    def __call__(self, prompt: str) -> str:
        import re

        refs = re.findall(r"^\[(\d+)\] ", prompt, re.M)
        return "### Federal Requirements\n" + " ".join(f"See [{r}]." for r in refs)


def jurisdictions(found: dict | None) -> list[str]:
    """['US', state, state-fips, state-city]; only 'US' when an address isn't found. Cities keep their registry key's underscores."""
    if not found or not found.get("state"):
        return ["US"]
    state, out = found["state"], ["US", found["state"]]
    if found.get("fips"):
        out.append(f"{state}-{found['fips']}")
    if found.get("city"):
        out.append(f"{state}-{'_'.join(found['city'].lower().split())}")
    return out


def embed(rows: DataFrame, embedder: Embedder, text: str = "text") -> DataFrame:
    """Adds a column embedding, in provider batches of 64 texts; blank texts are dropped before. An error fails the job: embedded() is
    for providers that limit their callers."""
    rows = rows.where(F.col(text).rlike(r"\S"))

    @F.arrow_udf("array<float>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for col in batches:
            texts = col.to_pylist()
            parts = [embedder(texts[i : i + EMBED_BATCH]) for i in range(0, len(texts), EMBED_BATCH)]
            yield pa.array([v.tolist() for p in parts for v in p], pa.list_(pa.float32()))

    return rows.withColumn("embedding", of(F.col(text)))


def _round(rows: DataFrame, embedder: Embedder, text: str) -> DataFrame:
    """rows with result (embedding, code, reason, wait): one call for each batch of 64 texts, never repeated in the task."""

    @F.arrow_udf("struct<embedding:array<float>,code:string,reason:string,wait:double>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for col in batches:
            out, texts = [], col.to_pylist()
            for i in range(0, len(texts), EMBED_BATCH):
                own = texts[i : i + EMBED_BATCH]
                try:
                    out += [{"embedding": v.tolist()} for v in embedder(own)]
                except Exception as e:  # noqa: BLE001
                    asked = retry.retry_after(e.header, time.time()) if isinstance(e, retry.Limited) else None
                    out += [{"code": error_code(e), "reason": f"{type(e).__name__}: {e}", "wait": asked}] * len(own)
            yield pa.array(out, pa.struct([("embedding", pa.list_(pa.float32())), ("code", pa.string()), ("reason", pa.string()), ("wait", pa.float64())]))

    return rows.withColumn("result", of(F.col(text)))


def embedded(
    rows: DataFrame, embedder: Embedder, control: Control, run: str, text: str = "text", most: int = MAX_TOKENS, attempts: int = ATTEMPTS, base: float = 1.0, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.time
) -> tuple[DataFrame, DataFrame]:
    """(rows with embedding, rejected rows with error_code and reason).

    Blank texts and texts above `most` tokens are rejected before any call. What a provider limits goes back as rows with a
    time when they are due (its own, or base * 2 ** round seconds on); no task waits. The driver waits for the first of them, and the
    next round calls for the rows that are due then and for no other. After `attempts` calls a limited row is rejected; other
    errors reject the rows of their call. Each round is a table under the run's name, so no call is made twice
    but for tasks that Spark repeats.
    """
    names = rows.columns
    blank = ~F.coalesce(F.col(text), F.lit("")).rlike(r"\S")
    wanted, over = embeddable(rows.where(~blank), text, most)
    bad = [rows.where(blank).select(*names, F.lit(BLANK).alias("error_code"), F.lit("blank text").alias("reason")), over.select(*names, F.lit(TOKEN_LIMIT).alias("error_code"), "reason")]
    good, pending, n = [], wanted.withColumns({"attempt": F.lit(0), "due": F.lit(0.0)}), 0
    while True:
        if n:
            first = pending.agg(F.min("due")).first()[0]
            if first is None:
                break
            if (ahead := first - clock()) > 0:
                sleep(ahead)
            now = max(clock(), first) + TOGETHER
            ready, later = pending.where(F.col("due") <= now), pending.where(F.col("due") > now)
        else:
            ready, later = pending, None
        done = control.save_step(run, f"embedded-{n}", _round(ready, embedder, text))
        r, tried = F.col("result"), F.col("attempt") + 1
        good.append(done.where("result.embedding is not null").select(*names, F.col("result.embedding").alias("embedding")))
        again = (r["code"] == RATE_LIMIT) & (tried < attempts)
        bad.append(done.where(r["embedding"].isNull() & ~again).select(*names, F.col("result.code").alias("error_code"), F.col("result.reason").alias("reason")))
        back = done.where(r["embedding"].isNull() & again).select(*names, tried.alias("attempt"), (F.lit(clock()) + F.coalesce(r["wait"], F.lit(base * 2**n))).alias("due"))
        pending = control.save_step(run, f"pending-{n}", back if later is None else back.unionByName(later))
        n += 1
    return reduce(DataFrame.unionByName, good), reduce(DataFrame.unionByName, bad)


def embedding_stats(rows: int) -> dict[str, int]:
    """Provider and upsert batches that a number of rows takes."""
    return {"rows": rows, "embed_batches": -(-rows // EMBED_BATCH), "upsert_batches": -(-rows // UPSERT_BATCH)}


def embeddable(rows: DataFrame, text: str = "text", most: int = MAX_TOKENS) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): texts above a provider's token limit leave with a reason before any call is made."""
    n = tokens(F.col(text))
    return rows.where(n <= most), rows.where(n > most).withColumn("reason", F.format_string("%d tokens are above the limit of %d", n, F.lit(most)))
