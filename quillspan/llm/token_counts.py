"""Exact byte-level BPE token counts for every prefix, by dynamic programming.

The BPE encoding of a byte string has a simple recurrence: exactly one token t ends the encoding of a prefix, and what
stands before t is the encoding of a shorter prefix. t fits if it and the token before it stay as they are when the two
are encoded together. So one pass over a piece of text gives the last token, and with it the count, of all prefixes:
count[j] = count[j - len(t)] + 1. Pieces are what the tokenizer's pattern cuts a text into; they are encoded apart from
each other, so a text's prefixes are sums over pieces. Tables of pieces are kept, as few are new after a while.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from quillspan.llm.common import utf8

#: The tokenizer's own pattern (a fixed value of byte-level BPE vocabularies of this kind).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: itself if it prints, else the next one from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Counts of a byte-level BPE tokenizer given as a tokenizers .json file."""

    def __init__(self, path: str, most: int = 700_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.pattern = regex.compile(PATTERN)
        self.tokens = {raw(t) for t in spec["model"]["vocab"] if t not in special}
        self.longest = max(map(len, self.tokens))
        merges = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(merges)}
        self.most, self.fits, self.known = most, {}, {}

    def merge(self, parts: list[bytes]) -> list[bytes]:
        """BPE by its definition: merge the pair of least rank, the leftmost first, until none is left."""
        while len(parts) > 1:
            best = min(zip(parts, parts[1:]), key=lambda p: self.rank.get(p, 1 << 60))
            if best not in self.rank:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def fit(self, a: bytes, b: bytes) -> bool:
        """Whether tokens a and b, encoded together, stay a and b. An empty a asks whether b itself is stable."""
        got = self.fits.get((a, b))
        if got is None:
            got = self.fits[a, b] = self.merge([bytes([x]) for x in a + b]) == ([a, b] if a else [b])
        return got

    def table(self, piece: bytes) -> list[int]:
        """Token counts of the first 0, 1, ... bytes of one piece."""
        n = len(piece)
        count, last = [0] * (n + 1), [b""] * (n + 1)
        tokens, fits, longest = self.tokens, self.fits, self.longest
        for j in range(1, n + 1):
            for i in range(max(0, j - longest), j):
                t = piece[i:j]
                if t in tokens:
                    ok = fits.get((last[i], t))
                    if ok or ok is None and self.fit(last[i], t):
                        count[j], last[j] = count[i] + 1, t
                        break
        return count

    def pieces(self, text: str) -> Iterator[tuple[str, bool]]:
        """Pieces of a text in order; True with those that are special tokens."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            yield from ((p, False) for p in self.pattern.findall(text[at : m.start()]))
            yield m[0], True
            at = m.end()
        yield from ((p, False) for p in self.pattern.findall(text[at:]))

    def of_piece(self, piece: str) -> int:
        got = self.known.get(piece)
        return self.table(piece.encode())[-1] if got is None else got

    def counts(self, texts: list[str], at_once: int = 200) -> list[int]:
        """Token counts of many texts. New pieces of some texts together are looked up once, and kept if they are short."""
        out = []
        for lo in range(0, len(texts), at_once):
            found, extra = [], []
            for text in texts[lo : lo + at_once]:
                cuts = self.special.split(text) if self.special else [text]
                found.append(self.pattern.findall(text) if len(cuts) == 1 else [p for c in cuts for p in self.pattern.findall(c)])
                extra.append(len(cuts) - 1)
            if len(self.known) > self.most:
                self.known.clear()
            if len(self.fits) > 2 * self.most:
                self.fits.clear()
            new = set().union(*found).difference(self.known)
            for p in new:
                self.known[p] = self.table(p.encode())[-1]
            long = [p for p in new if len(p) > 64]
            out += [sum(map(self.known.__getitem__, f)) + n for f, n in zip(found, extra)]
            for p in long:
                del self.known[p]
        return out

    def count(self, text: str) -> int:
        return self.counts([text])[0]

    def prefixes(self, text: str) -> np.ndarray:
        """Token counts of the first 0, 1, ... characters of a text, each as if the text ended there."""
        out, done, at = np.zeros(len(text) + 1, np.int64), 0, 0
        blank = 0  # where the white space that ends at `at` begins, and its count before
        before_blank = 0
        special_free = 0  # start of the run of pieces since the last special token
        for p, s in self.pieces(text):
            if s:  # inside a special token its letters are text like any other
                base = int(out[special_free])
                for k in range(1, len(p)):
                    out[at + k] = base + sum(self.of_piece(q) for q in self.pattern.findall(text[special_free : at + k]))
                done += 1
                at += len(p)
                out[at] = done
                special_free = blank = at
                before_blank = done
                continue
            counts, ends = self.table(p.encode()), list(accumulate(len(c.encode()) for c in p))
            for k in range(1, len(p) + 1):
                tail = p[:k]
                if tail.isspace() and blank < at:
                    whole = self.pattern.findall(text[blank : at + k])
                    out[at + k] = before_blank + sum(self.of_piece(q) for q in whole)
                else:
                    whole = self.pattern.findall(tail)
                    out[at + k] = done + (counts[ends[k - 1]] if len(whole) == 1 else sum(self.of_piece(q) for q in whole))
            done += counts[-1]
            at += len(p)
            if not p.isspace():
                blank, before_blank = at, done
        out[len(text)] = done
        return out

    def within(self, text: str, budget: int) -> int:
        """Characters of the longest prefix all of whose own prefixes have at most `budget` tokens."""
        over = np.flatnonzero(self.prefixes(text) > budget)
        return int(over[0]) - 1 if len(over) else len(text)


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def count_column(text: Column, path: str) -> Column:
    """Token count of a text column; null counts as empty."""

    @F.arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = counter(path)
        for col in batches:
            yield pa.array(table.counts(col.fill_null("").to_pylist()), pa.int64())

    return of(text)


def prefix_column(text: Column, path: str) -> Column:
    """Stored counts: the number of tokens of the first 0, 1, ... characters of each text."""

    @F.arrow_udf("array<long>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = counter(path)
        for col in batches:
            yield pa.array([table.prefixes(t or "").tolist() for t in col.to_pylist()], pa.list_(pa.int64()))

    return of(text)


def truncated(text: Column, prefixes: Column, budget: int) -> Column:
    """The longest prefix of a text that never exceeds the budget, from its stored counts."""
    fits = F.array_position(F.transform(prefixes, lambda n: n > budget), F.lit(True))
    return F.when(fits > 0, F.substring(text, F.lit(1), (fits - 2).cast("int"))).otherwise(text)


def token_counts(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document.

    Null texts are empty: no bytes, no tokens. Rows with a null id and repeated rows are counted like any other; an empty
    table gives an empty result; other columns are not read.
    """
    out = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), count_column(F.col(text_col), path).alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
