"""Token ids of documents in patched frame-of-reference segments.

A segment holds whole documents in ascending id order:

    magic "PFR1", then as little-endian unsigned 32-bit numbers: values per block, documents, blocks; 64-bit: tokens
    document ids (int64), a byte for each that is 0 if the id is null, tokens of each document (uint64)
    block index: byte offset of each block in the body (uint64), block minimum (uint32), bits a value (uint8),
        exceptions (uint16)
    body: each block's packed values, then its exceptions' places (uint16) and values (uint32)

A block's minimum is subtracted; the width is what the given percentile of the differences needs, and larger ones are
exceptions that keep their whole value. The index finds any block, so a reader needs no more than the blocks it wants.

Segments are rows of a Parquet table in the shared folder, (part, seq, first token in the part, tokens, body): Spark
commits them, so a lost executor's half-written segments never count, and they can be read wherever Spark reads.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from quillspan.llm import words as W
from quillspan.llm.common import materialise, rows_a_batch, utf8

BLOCK, PERCENTILE = 1024, 90


def _bits(x: np.ndarray, width: int) -> np.ndarray:
    """Rows of unsigned 32-bit numbers, each cut to its lowest `width` bits and packed."""
    rows, n = x.shape
    bits = np.unpackbits(np.ascontiguousarray(x, "<u4").view(np.uint8).reshape(rows, n, 4), axis=2, bitorder="little")
    return np.packbits(bits[:, :, :width].reshape(rows, -1), axis=1, bitorder="little")


def _unbits(x: np.ndarray, width: int, n: int) -> np.ndarray:
    bits = np.unpackbits(x, axis=1, bitorder="little")[:, : n * width].reshape(len(x), n, width)
    full = np.zeros((len(x), n, 32), np.uint8)
    full[:, :, :width] = bits
    return np.packbits(full.reshape(len(x), -1), axis=1, bitorder="little").view("<u4").reshape(len(x), n)


def pack(values: np.ndarray, doc_ids: np.ndarray, valid: np.ndarray, counts: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> bytes:
    """One segment. values: the ids of all documents in a row; counts: how many are each document's."""
    n_blocks = -(-len(values) // block)
    grid = np.zeros((n_blocks, block), np.uint32)
    grid.ravel()[: len(values)] = values
    if len(values):
        grid.ravel()[len(values) :] = values[-1]
    least = grid.min(axis=1) if n_blocks else np.zeros(0, np.uint32)
    off = grid - least[:, None]
    k = min(block - 1, int(block * percentile / 100))
    limit = np.partition(off, k, axis=1)[:, k] if n_blocks else least
    width = np.ceil(np.log2(limit.astype(np.float64) + 1)).astype(np.int64)
    over = off >= (np.uint64(1) << width.astype(np.uint64))[:, None] if n_blocks else off.astype(bool)
    n_over = over.sum(axis=1)
    body = [b""] * n_blocks
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        packed = _bits(off[own], int(w))
        for i, b in enumerate(own):
            body[b] = packed[i].tobytes()
    for b in np.flatnonzero(n_over):
        at = np.flatnonzero(over[b])
        body[b] += at.astype("<u2").tobytes() + off[b, at].astype("<u4").tobytes()
    starts = np.concatenate([[0], np.cumsum([len(x) for x in body])])[:n_blocks]
    return b"".join([
        b"PFR1", np.array([block, len(counts), n_blocks], "<u4").tobytes(), np.array([len(values)], "<u8").tobytes(),
        doc_ids.astype("<i8").tobytes(), valid.astype(np.uint8).tobytes(), counts.astype("<u8").tobytes(),
        starts.astype("<u8").tobytes(), least.astype("<u4").tobytes(), width.astype(np.uint8).tobytes(), n_over.astype("<u2").tobytes(), *body,
    ])


class Segment:
    """Reads a segment; blocks are unpacked when they are asked for."""

    def __init__(self, raw: bytes):
        if raw[:4] != b"PFR1":
            raise ValueError("not a segment")
        self.block, docs, blocks = (int(x) for x in np.frombuffer(raw, "<u4", 3, 4))
        self.n = int(np.frombuffer(raw, "<u8", 1, 16)[0])
        at = 24

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        self.doc_ids, self.valid, self.counts = take("<i8", docs), take("u1", docs).astype(bool), take("<u8", docs).astype(np.int64)
        self.starts, self.least, self.width, self.n_over = take("<u8", blocks).astype(np.int64), take("<u4", blocks), take("u1", blocks), take("<u2", blocks)
        self.body = np.frombuffer(raw, np.uint8, offset=at)

    def blocks(self, lo: int, hi: int) -> np.ndarray:
        """The values of blocks lo to hi - 1."""
        out = np.zeros((hi - lo, self.block), np.uint32)
        widths = self.width[lo:hi]
        for w in np.unique(widths):
            own = np.flatnonzero(widths == w)
            size = -(-self.block * int(w) // 8)
            if size:
                packed = self.body[self.starts[lo + own][:, None] + np.arange(size)]
                out[own] = _unbits(packed, int(w), self.block)
        for b in np.flatnonzero(self.n_over[lo:hi]):
            at, n = int(self.starts[lo + b]) + -(-self.block * int(widths[b]) // 8), int(self.n_over[lo + b])
            places = self.body[at : at + 2 * n].view("<u2")
            out[b, places] = self.body[at + 2 * n : at + 6 * n].view("<u4")
        out += self.least[lo:hi, None]
        return out.ravel()[: max(0, self.n - lo * self.block)]

    def values(self, start: int, stop: int) -> np.ndarray:
        lo = start // self.block
        return self.blocks(lo, -(-stop // self.block))[start - lo * self.block : stop - lo * self.block]


# --- tokens --------------------------------------------------------------------------------------------------------


#: Letters that end a word's first piece, and marks that begin its next one: the tokenizer always cuts between them.
_LETTER, _LATIN, _MARK = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LATIN[[c for c in range(0x80, 0xC0) if c not in (0x97, 0xB7)]] = True  # after 0xC3: Latin letters
_MARK[list(b".,!?#*$%&;:")] = True
_ODD = np.uint64(0x5851F42D4C957F2D)


class WordEncoder:
    """Ids of whole texts, by encoding every different word once with the tokenizers library.

    This holds for tokenizers that drop white space and never look past it, as word_bpe_49k.json. Words are lower-cased
    (A-Z) first, as the tokenizer does itself, but for those that could hold a special token, and marks after a letter are
    words of their own. Words are known by 64-bit hashes in sorted arrays, so that millions take little memory. New ones
    are encoded many at a time, with a special token between them that the tokenizer cuts at.
    """

    def __init__(self, path: str, end_id: int, most: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.end_id = Tokenizer.from_file(path), most, end_id
        special = [t for t in self.tokenizer.get_added_tokens_decoder().items() if t[1].special]
        self.cut_id, self.cut = special[0][0], special[0][1].content.encode()
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.hashes, self.index = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.flat, self.start, self.size = np.zeros(0, np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32), np.zeros(0, np.uint32), np.zeros(0, np.uint32)

    def ids(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids, np.uint32)

    def learn(self, hashes: np.ndarray, words: list[bytes], odd: np.ndarray, letters: np.ndarray) -> None:
        """Encode new words; odd ones one by one. letters: whether a word is of Latin letters alone."""
        flat, sizes, plain = [], np.zeros(len(words), np.int64), []
        for cut, some in ((b" ", np.flatnonzero(letters)), (self.cut, np.flatnonzero(~letters & ~odd))):
            plain.append(some)
            for lo in range(0, len(some), 500):
                own = some[lo : lo + 500]
                ids = self.ids(cut.join([words[i] for i in own]))
                if cut == b" ":
                    ends = np.flatnonzero(self.last[ids])
                    sizes[own] = np.diff(ends, prepend=-1)
                else:
                    sizes[own] = np.diff(np.flatnonzero(ids == self.cut_id), prepend=-1, append=len(ids)) - 1
                flat.append(ids[ids != self.cut_id])
        plain = np.concatenate(plain)
        for i in np.flatnonzero(odd):
            flat.append(self.ids(words[i]))
            sizes[i] = len(flat[-1])
        order = np.concatenate([plain, np.flatnonzero(odd)])
        starts = np.zeros(len(words), np.int64)
        starts[order] = len(self.flat) + np.cumsum(sizes[order]) - sizes[order]
        number = (len(self.start) + np.arange(len(words))).astype(np.int32)
        self.flat = np.concatenate([self.flat, *(x.astype(self.flat.dtype) for x in flat)])
        self.start, self.size = np.concatenate([self.start, starts.astype(np.uint32)]), np.concatenate([self.size, sizes.astype(np.uint32)])
        at = np.searchsorted(self.hashes, hashes)  # hashes come sorted
        self.hashes, self.index = np.insert(self.hashes, at, hashes), np.insert(self.index, at, number)

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (bytes and row offsets), each followed by the end id, and how many each text has."""
        mark = _MARK[data]
        cut = np.flatnonzero(_LETTER[data[:-1]] & mark[1:]) + 1
        latin = np.flatnonzero((data[:-2] == 0xC3) & _LATIN[data[1:-1]] & mark[2:]) + 2
        cut = np.sort(np.concatenate([cut, latin]))
        data, at = np.insert(data, cut, 32), at + np.searchsorted(cut, at)
        lower = W.LOWER[data]
        found = W.find_words(lower, at)
        hashes = W.Rolling(lower)(found.starts, found.ends)
        odd = np.zeros(len(hashes), bool)
        signs = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124))  # "<|"
        if len(signs):
            odd[np.searchsorted(found.starts, signs, "right") - 1] = True
            hashes[odd] = W.Rolling(data)(found.starts[odd], found.ends[odd]) ^ _ODD
        if len(self.hashes) > self.most:
            self.clear()
        new, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.hashes, new), max(len(self.hashes) - 1, 0))
        missing = np.flatnonzero(self.hashes[place] != new) if len(self.hashes) else np.arange(len(new))
        if len(missing):
            at_word = first[missing]
            raw, low = data.tobytes(), lower.tobytes()
            spans = zip(found.starts[at_word].tolist(), found.ends[at_word].tolist(), odd[at_word].tolist(), strict=True)
            letter = _LETTER[lower]
            pair = np.flatnonzero((lower[:-1] == 0xC3) & _LATIN[lower[1:]])
            letter[pair] = letter[pair + 1] = True
            others = np.concatenate([[0], np.cumsum(~letter)])
            letters = (others[found.starts[at_word]] == others[found.ends[at_word]]) & ~odd[at_word]
            self.learn(new[missing], [(raw if o else low)[s:e] for s, e, o in spans], odd[at_word], letters)
        index = self.index[np.searchsorted(self.hashes, new)][back]
        size = self.size[index].astype(np.int64)
        ends = np.cumsum(size)
        total, n = int(ends[-1]) if len(ends) else 0, len(at) - 1
        out = np.full(total + n, self.end_id, np.uint32)
        run = np.arange(total)
        out[run + np.repeat(found.doc, size)] = self.flat[run + np.repeat(self.start[index] - ends + size, size)]
        return out, np.diff(np.concatenate([[0], ends])[found.first]) + 1


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def write_segments(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None, segment_tokens: int = 1 << 18) -> DataFrame:
    """Encode every text, append end_id, and write the ids as segments in ascending id order; returns the table that was written."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).repartitionByRange(parts, F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _ENCODERS.setdefault((tokenizer_path, end_id), None) or WordEncoder(tokenizer_path, end_id)
        _ENCODERS[tokenizer_path, end_id] = coder  # kept for the worker's next task
        part, seq, first, held = TaskContext.get().partitionId(), 0, 0, []

        def segment() -> pa.RecordBatch:
            nonlocal seq, first
            ids, names, valid, counts = (np.concatenate(x) for x in zip(*held))
            row = [part], [seq], [first], [len(ids)], [pack(ids, names, valid, counts)]
            kinds = pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()
            seq, first = seq + 1, first + len(ids)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, kinds)], names=["part", "seq", "first", "tokens", "body"])

        for rb in batches:
            data, at = utf8(rb.column(1))
            names = rb.column(0)
            valid = ~np.asarray(names.is_null())
            names = names.fill_null(0).to_numpy(zero_copy_only=False)
            lo = 0
            while lo < len(names):
                hi = max(lo + 1, int(np.searchsorted(at, at[lo] + (3 << 19), "right")) - 1)
                hi = min(hi, len(names))
                ids, counts = coder.encode(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
                held.append((ids, names[lo:hi], valid[lo:hi], counts))
                lo = hi
                if sum(len(x[0]) for x in held) >= segment_tokens:
                    yield segment()
        if held:
            yield segment()

    with rows_a_batch(spark, 400):  # the table is written before this returns
        return materialise(ordered.mapInArrow(run, "part int, seq int, first long, tokens long, body binary"), "segments")


def read_documents(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the segments alone."""
    sums = {r["part"]: r["n"] for r in segments.groupBy("part").agg(F.sum("tokens").alias("n")).collect()}  # a row a part
    before = np.concatenate([[0], np.cumsum([sums.get(p, 0) for p in range(max(sums, default=0) + 1)])])[:-1].astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for i in range(len(rb)):
                row = rb.slice(i, 1).to_pylist()[0]
                s = Segment(row["body"])
                ends = np.cumsum(s.counts)
                starts = ends - s.counts
                ids = s.blocks(0, len(s.starts)).astype("<u4")
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]
                base = int(before[row["part"]]) + row["first"]
                cols = [pa.array(s.doc_ids, mask=~s.valid), pa.array(base + starts), pa.array(s.counts), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return segments.select("part", "first", "body").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 2, **options) -> DataFrame:
    """Write all documents' ids and read them back.

    Null texts are empty (the end id alone); rows with a null id come first and keep it; rows with equal ids stand in any
    order beside each other; an empty table gives an empty result; other columns are not read.
    """
    return read_documents(write_segments(docs, tokenizer_path, end_id, **options))
