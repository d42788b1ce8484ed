"""Packing of tokenized documents into fixed-length training sequences.

Bounded-space online packing: every input partition keeps at most ``open_windows``
open sequences, places each piece where it fits best, emits the fullest when none
fits, and leaves its open ones to a merge over a few partitions at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.support import Out, materialize

WINDOW = 4096
END_ID = 2
#: Words, and parts of words, that each Python worker remembers.
CACHE_WORDS = 300_000
CACHE_PARTS = 500_000

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_RAW = pa.schema([("part", pa.int64()), ("closed", pa.bool_()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])
_PIECES = pa.schema(list(_RAW)[2:])
_encoders: dict[str, WordEncoder] = {}
#: Texts on which a vocabulary must give the same ids word by word as whole.
PROBES = (
    "Plain words, a number 1234567 and  two blanks\n\nafter a line. ", "I'm don't 's a'b'ss ''", "ÀÉ×ß naïve-é é é Σίσυφος İs ﬁ",
    "漢字 ☃☃ 🙂👍 ªº µ ½", "...!!!@@ <b>x</b> a_b--c $5.00 #1 \\ ~", "UPPER MiXed camelCase x1y2 0x1F 3.14e-10", " leading", "tab\tand\rmore\x1c", "a" * 90, "",
)


class WordEncoder:
    """Ids of a text as little-endian uint32 bytes.

    The vocabulary drops white space before its merges, so a text's ids are those of its
    blank-separated words in order, and a word seen before is looked up. A word of plain Latin
    letters, digits and ASCII marks is the letters, digits and marks it consists of; these are
    looked up too. Any other word goes through the tokenizer as it is. A vocabulary for which
    this doesn't hold on PROBES gets every text whole.
    """

    #: What the vocabulary's pattern splits such words into (apostrophes have rules of their own there).
    plain = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]|[!-&(-/:-@\\[-`{-~]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.letters = {c: as_bytes(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.tokenize = self.tokenizer.model.tokenize
        self.as_ids = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.known: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {}
        # a vocabulary that splits otherwise, or can't be taken apart so, gets whole texts
        try:
            self.by_word = all(self.word_by_word(t) == self.whole(t) for t in PROBES)
        except (AttributeError, KeyError, IndexError, TypeError):
            self.by_word = False

    def part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            as_ids = self.as_ids
            ids = b"".join([as_ids[t.id] for t in self.tokenize(part if part.isascii() else part.translate(self.letters))])
            if len(self.parts) < CACHE_PARTS and len(part) <= 64:
                self.parts[part] = ids
        return ids

    def word(self, word: str) -> bytes:
        parts = self.plain.findall(word)
        if "<|" in word or sum(map(len, parts)) != len(word):
            ids = self.whole(word)
        elif len(parts) == 1:
            ids = self.part(word.lower())
        else:
            ids = b"".join([self.part(p.lower()) for p in parts])
        if len(self.known) < CACHE_WORDS and len(word) <= 64:
            self.known[word] = ids
        return ids

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word_by_word(self, text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        get, new = self.known.get, self.word
        ids = [get(w) for w in words]
        return b"".join([new(w) if i is None else i for w, i in zip(words, ids)] if None in ids else ids)

    def __call__(self, text: str) -> bytes:
        return self.word_by_word(text) if self.by_word else self.whole(text)


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class Packer:
    """Open windows of one partition; closed ones go to ``emit`` as lists of pieces.

    A piece is [doc_id, start, length, doc_tokens, ids]. A window closes when it is full;
    the fullest one, when nothing fits, is topped up with the head of the piece unless
    fewer than ``min_cut`` tokens would go there.
    """

    def __init__(self, window: int, open_windows: int, min_cut: int, emit):
        self.window, self.limit, self.min_cut, self.emit = window, open_windows, min_cut, emit
        self.open: list[list] = []
        self.gaps: list[int] = []

    def close(self, k: int) -> None:
        self.emit(self.open.pop(k))
        self.gaps.pop(k)

    def put(self, k: int, piece: list) -> None:
        self.open[k].append(piece)
        self.gaps[k] -= piece[2]
        if not self.gaps[k]:
            self.close(k)

    def add(self, piece: list) -> None:
        doc_id, start, length, total, ids = piece
        size, end = 4 * self.window, length // self.window
        for k in range(end):
            self.emit([[doc_id, start + k * self.window, self.window, total, ids[k * size : (k + 1) * size]]])
        piece = [doc_id, start + end * self.window, length - end * self.window, total, ids[end * size :]]
        while piece[2]:
            fits = [(g, k) for k, g in enumerate(self.gaps) if g >= piece[2]]
            if fits:
                return self.put(min(fits)[1], piece)
            if len(self.open) < self.limit:
                self.open.append([])
                self.gaps.append(self.window)
                return self.put(len(self.open) - 1, piece)
            gap, k = min((g, k) for k, g in enumerate(self.gaps))
            if gap < self.min_cut:
                self.close(k)
            else:
                head, piece = cut(piece, gap)
                self.put(k, head)


def cut(piece: list, n: int) -> tuple[list, list]:
    doc_id, start, length, total, ids = piece
    return [doc_id, start, n, total, ids[: 4 * n]], [doc_id, start + n, length - n, total, ids[4 * n :]]


def power_cuts(n: int) -> list[int]:
    """n as falling powers of two: a sequence of such a length needs no padding."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack_documents(docs: DataFrame, tokenizer_path: str, *, window: int = WINDOW, open_windows: int = 16, min_cut: int = 16, end_id: int = END_ID, fan_in: int = 8) -> DataFrame:
    """Pack ``docs(doc_id, text)`` into sequences of at most ``window`` tokens.

    One row per piece: doc_id, start (ids of the document before the piece), length, doc_tokens,
    sequence_id, offset and the ids as little-endian uint32 bytes. Every id, the closing
    ``end_id`` of each document included, lies in exactly one piece. Other columns of ``docs``
    are ignored, whatever their names.

    Null text counts as empty (one piece: the end id). A null doc_id stays null. Repeated rows are
    packed once each. An empty table gives no rows. Texts of any length are cut into full windows.

    Only open windows travel: they are merged over ``fan_in`` partitions at a time, so no task
    sees more than ``fan_in * open_windows`` of them, and what remains at the end of a group is
    cut at powers of two.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, end = encoder(tokenizer_path), TaskContext.get().partitionId(), np.asarray([end_id], "<u4").tobytes()
        out, done, n = Out(_RAW), [], 0
        packer = Packer(window, open_windows, min_cut, done.append)

        def rows(pieces: list, closed: bool, sequence: int) -> None:
            offset = 0
            for doc_id, start, length, total, ids in pieces:
                out.add((part, closed, doc_id, start, length, total, (part << 32) + sequence, offset, ids), 64 + len(ids))
                offset += length

        for batch in batches:
            for i in range(batch.num_rows):
                ids = encode(batch.column(1)[i].as_py() or "") + end
                total = len(ids) // 4
                packer.add([batch.column(0)[i].as_py(), 0, total, total, ids])
                for pieces in done:
                    rows(pieces, True, n)
                    n += 1
                done.clear()
                if out.bytes >= out.max_bytes:
                    yield out.flush()
        for pieces in packer.open:
            rows(pieces, False, n)
            n += 1
        yield out.flush()

    def merge(key: tuple, left: pa.Table) -> pa.Table:
        done: list[list] = []
        packer = Packer(window, open_windows, 1, done.append)
        names = ["doc_id", "start", "length", "doc_tokens", "ids"]
        pieces = [list(p) for p in zip(*(left.column(n).to_pylist() for n in names), strict=True)]
        for piece in sorted(pieces, key=lambda p: (-p[2], p[0] is None, p[0], p[1])):
            packer.add(piece)
        rest = [p for w in packer.open for p in w]
        total = sum(p[2] for p in rest)
        for size in [window] * (total // window) + power_cuts(total % window):
            filled = []
            while size:
                piece = rest.pop(0)
                if piece[2] > size:
                    piece, tail = cut(piece, size)
                    rest.insert(0, tail)
                filled.append(piece)
                size -= piece[2]
            done.append(filled)
        out, base = Out(_PIECES), (1 << 62) + (key[0].as_py() << 32)
        for n, filled in enumerate(done):
            offset = 0
            for doc_id, start, length, doc_tokens, ids in filled:
                out.add((doc_id, start, length, doc_tokens, base + n, offset, ids))
                offset += length
        return pa.Table.from_batches([out.flush()])

    raw = "part long, closed boolean, " + PIECES
    pieces = materialize(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(pack, raw))
    names = [f.split()[0] for f in PIECES.split(", ")]
    merged = pieces.where(~F.col("closed")).groupBy(F.floor(F.col("part") / fan_in).alias("group")).applyInArrow(merge, PIECES)
    return pieces.where("closed").select(*names).unionByName(merged)
