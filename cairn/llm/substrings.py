"""Removal of repeated word windows, with a count-min prefilter.

A window of ``window`` words holds the smallest hash of its word n-grams, its anchor, so a window
can occur at most as often as its anchor does. Documents are put into blocks and written once. First
pass: every block sketches its anchors, sketches are merged by ranges of hashes, each in a task of its
own, and a range answers every block which of its anchors are estimated to repeat; an estimate is never
too low. Second pass: only windows with such anchors are grouped exactly, so none is lost. No table
of all counts exists anywhere, neither on the driver nor broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.support import materialize

WINDOW = 20
#: Words of an anchor.
GRAM = 8
#: A block ends after so many bytes of text, so a task's arrays stay bounded; one document is never split.
BLOCK_BYTES = 4 << 20
#: Level of zstd for the texts of a block: they are written twice, once in the table and once in a shuffle.
BODY_LEVEL = 7
#: Hash ranges of the sketch and of the exact pass: so many at least, and one for so many bytes of text, so that a range stays bounded.
MIN_RANGES = 64
SKETCH_BYTES = 32 << 20
MIN_KEYS = 256
KEY_BYTES = 16 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_CHECK = np.uint64(0xC2B2AE3D27D4EB4F)
#: Odd multipliers of the sketch's rows.
_ROWS = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
#: Seeds of the two word hashes that a window's two hashes are made of.
_SEEDS = (0, 1)


def word_hashes(words: list[bytes], seed: int = _SEEDS[0]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w, seed) for w in words), np.uint64, len(words)) if seed else np.fromiter(map(digest, words), np.uint64, len(words))


def gram_hashes(words: np.ndarray, n: int, base: np.uint64) -> np.ndarray:
    """Polynomial hash of every run of n words, by doubling."""
    out, power, span, left, have = words, base, 1, n, None
    offset = 0
    while left:
        if left & 1:
            if have is None:
                have, offset = out, span
            else:
                size = len(words) - offset - span + 1
                have = have[:size] * power + out[offset : offset + size]
                offset += span
        left >>= 1
        if left:
            size = len(out) - span
            out = out[:size] * power + out[span : span + size]
            power = np.uint64(int(power) * int(power) & 0xFFFFFFFFFFFFFFFF)
            span *= 2
    have = have ^ (have >> np.uint64(29))
    have = have * _CHECK
    return have ^ (have >> np.uint64(32))


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    span, out = 1, x
    while 2 * span <= n:
        out = np.minimum(out[: len(out) - span], out[span:])
        span *= 2
    return np.minimum(out[: len(x) - n + 1], out[n - span : n - span + len(x) - n + 1])


def anchors(words: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of every window, and the hashes of the positions that are one."""
    grams = gram_hashes(words, gram, _MIX)
    span = window - gram + 1
    least = sliding_min(grams, span)
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    padded = np.concatenate([np.full(span - 1, top), ~least, np.full(span - 1, top)])
    used = ~sliding_min(padded, span) if len(least) else least
    return least, grams[used == grams]


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def _power(n: int) -> int:
    """The exponent of the power of two at or below ``n``."""
    return max(1, n).bit_length() - 1


def _ranged(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def _runs(ordered: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, start, end) of every run of equal values."""
    values, starts = np.unique(ordered, return_index=True)
    return list(zip(values.tolist(), starts.tolist(), [*starts[1:].tolist(), len(ordered)], strict=True))


class Block:
    """Some documents: their ids (-1 beside a mask where null) and texts."""

    def __init__(self, ids: list, texts: list[bytes]):
        self.ids, self.texts = ids, texts

    def pack(self) -> tuple:
        known = np.array([i is not None for i in self.ids], np.uint8)
        ids = np.array([0 if i is None else i for i in self.ids], np.int64)
        body = b"".join(self.texts)
        return ids.tobytes(), known.tobytes(), np.array(list(map(len, self.texts)), np.int64).tobytes(), len(body), pa.Codec("zstd", BODY_LEVEL).compress(body, asbytes=True) if body else b""

    @classmethod
    def unpack(cls, table: pa.Table) -> Block:
        ids, known, sizes, size, body = (table.column(c)[0].as_py() for c in ("ids", "known", "sizes", "bytes", "body"))
        body = pa.decompress(body, size, "zstd", asbytes=True) if size else b""
        ends = np.cumsum(np.frombuffer(sizes, np.int64)).tolist()
        named = [i if k else None for i, k in zip(np.frombuffer(ids, np.int64).tolist(), known, strict=True)]
        return cls(named, [body[a:b] for a, b in zip([0, *ends], ends)])

    def windowed(self, window: int) -> Iterator[tuple[int, list[bytes]]]:
        """(doc_id, words) of the documents with an id and at least one window."""
        for doc_id, text in zip(self.ids, self.texts, strict=True):
            if doc_id is not None and len(text) >= 2 * window - 1:
                words = text.split()
                if len(words) >= window:
                    yield doc_id, words


def _sketched(found: list[np.ndarray], low: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Sorted distinct anchors of a block, which it holds more than once, and their cells in each row of the sketch."""
    anchor, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    return anchor, n > 1, [((anchor * odd) >> np.uint64(64 - low)).astype(np.uint32) for odd in _ROWS]


def blocks(docs: DataFrame, window: int, gram: int, range_bits: int, low: int) -> DataFrame:
    """Rows of two kinds, as one table: every block with its compressed texts, and each block's sketch by hash range."""
    names = ["block", "ids", "known", "sizes", "bytes", "body", "hash_range", "many", "cells"]
    types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId() << 32, 0
        ids, texts, size = [], [], 0

        def flush() -> pa.RecordBatch:
            block = Block(ids, texts)
            anchor, many, row_cells = _sketched([anchors(word_hashes(words), window, gram)[1] for _, words in block.windowed(window)], low)
            rows = [(part + n, *block.pack(), None, None, None)]
            for r, a, b in _runs(_ranged(anchor, range_bits)) if len(anchor) else []:
                rows.append((part + n, None, None, None, None, None, r, np.packbits(many[a:b]).tobytes(), [c[a:b].tobytes() for c in row_cells]))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for i in range(batch.num_rows):
                text = (batch.column(1)[i].as_py() or "").encode("utf-8", "replace")
                ids.append(batch.column(0)[i].as_py())
                texts.append(text)
                size += len(text) + 64
                if size >= BLOCK_BYTES:
                    yield flush()
                    ids, texts, size, n = [], [], 0, n + 1
        if ids:
            yield flush()

    return docs.mapInArrow(run, "block long, ids binary, known binary, sizes binary, bytes long, body binary, hash_range long, many binary, cells array<binary>")


def _estimates(sketches: DataFrame, low: int) -> DataFrame:
    """(block, hash_range, repeats): a bit for each anchor of a block's range, set if all rows of the merged sketch count two or more."""

    def merge(key: tuple, group: pa.Table) -> pa.Table:
        cells = [[np.frombuffer(c, np.uint32) for c in row] for row in zip(*group.column("cells").to_pylist(), strict=True)]
        sizes = np.array([len(c) for c in cells[0]])
        many = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=k) for m, k in zip(group.column("many").to_pylist(), sizes, strict=True)]).astype(bool)
        repeats = np.ones(len(many), bool)
        for row in cells:
            at = np.concatenate(row)
            repeats &= (np.bincount(at, minlength=1 << low) + np.bincount(at[many], minlength=1 << low))[at] > 1
        ends = np.cumsum(sizes)
        bits = [np.packbits(repeats[e - k : e]).tobytes() for e, k in zip(ends, sizes, strict=True)]
        return pa.table([group.column("block"), group.column("hash_range"), pa.array(bits, pa.binary()), pa.array(sizes, pa.int64())], names=["block", "hash_range", "repeats", "n"])

    return sketches.groupBy("hash_range").applyInArrow(merge, "block long, hash_range long, repeats binary, n long")


def _later(h: np.ndarray, check: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order by (h, check, doc, start), and which of those sorted have an equal window before them."""
    order = np.lexsort((start, doc, check, h))
    h, check, doc, start = h[order], check[order], doc[order], start[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (check[1:] != check[:-1])][: len(h)]
    first = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    return order, (doc != doc[first]) | (start != start[first])


_FOUND = ["key", "block", "hashes", "checks", "doc_ids", "starts"]
_FOUND_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
_FOUND_SHAPE = "key long, block long, hashes binary, checks binary, doc_ids binary, starts binary"


def repeated_windows(texts: DataFrame, sketches: DataFrame, *, window: int, gram: int, range_bits: int, low: int, key_bits: int) -> DataFrame:
    """(block, doc_ids, starts): windows whose words also start earlier, as packed int64 and int32 arrays.

    Windows are compared by 96 bits, a hash of 64 and one of 32 made of differently seeded word hashes. Each block sends at
    most one window per hash: the rest are already known to repeat, so a window in a third of all documents
    doesn't gather in one task.
    """

    def candidates(key: tuple, text: pa.Table, answers: pa.Table) -> pa.Table:
        block_id, block = key[0].as_py(), Block.unpack(text)
        docs = [(doc_id, words, *anchors(word_hashes(words), window, gram)) for doc_id, words in block.windowed(window)]
        anchor = _sketched([d[3] for d in docs], low)[0]
        answered = sorted(zip(*(answers.column(c).to_pylist() for c in ("hash_range", "repeats", "n")), strict=True))
        repeats = np.concatenate([np.zeros(0, np.uint8), *(np.unpackbits(np.frombuffer(b, np.uint8), count=n) for _, b, n in answered)]).astype(bool)
        found = []
        for doc_id, words, least, _ in docs:
            at = np.flatnonzero(repeats[np.searchsorted(anchor, least)])
            if len(at):
                h, check = gram_hashes(word_hashes(words), window, _MIX)[at], (gram_hashes(word_hashes(words, _SEEDS[1]), window, _CHECK)[at] >> np.uint64(32)).astype(np.uint32)
                found.append((h, check, np.full(len(at), doc_id, np.int64), at.astype(np.int32)))
        rows = []
        if found:
            h, check, doc, start = (np.concatenate(c) for c in zip(*found, strict=True))
            order, known = _later(h, check, doc, start)
            mine, rest = order[known], np.sort(order[~known])
            if len(mine):
                rows.append((xxhash.xxh64_intdigest(str(block_id)) >> (64 - key_bits), block_id, None, None, doc[mine].tobytes(), start[mine].tobytes()))
            ranged = _ranged(h[rest], key_bits)
            rest, ranged = rest[np.argsort(ranged, kind="stable")], np.sort(ranged, kind="stable")
            for k, a, b in _runs(ranged):
                at = rest[a:b]
                rows.append((k, block_id, *(c[at].tobytes() for c in (h, check, doc, start))))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 6, _FOUND_TYPES, strict=True)], names=_FOUND)

    def compare(key: tuple, group: pa.Table) -> pa.Table:
        settled = group.filter(pc.is_null(group.column("hashes"))).select(["block", "doc_ids", "starts"])
        group = group.filter(pc.is_valid(group.column("hashes")))
        gather = lambda n, t: np.concatenate([np.zeros(0, t), *(np.frombuffer(b.as_buffer(), t) for b in group.column(n))])
        h, check, doc, start = gather("hashes", np.uint64), gather("checks", np.uint32), gather("doc_ids", np.int64), gather("starts", np.int32)
        block = np.repeat(group.column("block").to_numpy(), [len(b.as_buffer()) // 4 for b in group.column("starts")])
        order, known = _later(h, check, doc, start)
        mine = order[known]
        mine = mine[np.argsort(block[mine], kind="stable")]
        rows = [(b, doc[mine[i:j]].tobytes(), start[mine[i:j]].tobytes()) for b, i, j in _runs(block[mine])] if len(mine) else []
        new = pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 3, (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["block", "doc_ids", "starts"])
        return pa.concat_tables([settled, new])

    found = texts.groupBy("block").cogroup(_estimates(sketches, low).groupBy("block")).applyInArrow(candidates, _FOUND_SHAPE)
    return found.groupBy("key").applyInArrow(compare, "block long, doc_ids binary, starts binary")


def remove_repeats(docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, text): every document without the words of repeated windows.

    Words are runs of anything but ASCII white space. A word goes if a window of ``window`` words that
    covers it has the same words as one starting earlier: in a document with a smaller id, or earlier
    in the same one. Windows are judged on the input. The kept words are joined by one space.

    Null and empty texts: no words, empty text. Documents shorter than a window stay whole. Rows that
    repeat a doc_id count as one place, so they don't remove each other. A null doc_id has no place in the
    order: its row stays whole and removes nothing. An empty table gives no rows. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    size = text_bytes(docs)
    range_bits = _power(max(MIN_RANGES, size // SKETCH_BYTES))
    # about one anchor in seven words of six bytes; four cells for each
    low = min(22, max(10, (size >> range_bits) // 10).bit_length())
    key_bits = _power(max(MIN_KEYS, size // KEY_BYTES))
    table = materialize(blocks(docs, window, gram, range_bits, low))
    texts = table.where("body IS NOT NULL").select("block", "ids", "known", "sizes", "bytes", "body")
    sketches = table.where("body IS NULL").select("block", "hash_range", "many", "cells")
    found = repeated_windows(texts, sketches, window=window, gram=gram, range_bits=range_bits, low=low, key_bits=key_bits)

    def apply(key: tuple, text: pa.Table, found: pa.Table) -> pa.Table:
        gather = lambda n, t: np.concatenate([np.zeros(0, t), *(np.frombuffer(b.as_buffer(), t) for b in found.column(n))])
        doc, start = gather("doc_ids", np.int64), gather("starts", np.int32)
        order = np.argsort(doc, kind="stable")
        doc, start = doc[order], start[order]
        block, out = Block.unpack(text), []
        for doc_id, body in zip(block.ids, block.texts, strict=True):
            words = body.split()
            n = len(words)
            if doc_id is not None and n >= window:
                mine = start[np.searchsorted(doc, doc_id) : np.searchsorted(doc, doc_id, side="right")]
                mine = mine[mine <= n - window]
                if len(mine):
                    edges = np.bincount(mine, minlength=n + 1)[: n + 1] - np.bincount(mine + window, minlength=n + 1)[: n + 1]
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edges)[:n] == 0).tolist()]
            out.append((doc_id, n, n - len(words), b" ".join(words).decode("utf-8", "replace")))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["doc_id", "n_words", "n_removed", "text"])

    return texts.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(apply, "doc_id long, n_words long, n_removed long, text string")
