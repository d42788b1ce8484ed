"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most ``2 * r`` bits apart share a variant that is at most ``r`` flips from
both. Every fingerprint therefore emits all its variants within ``r`` flips, variants meet by
shuffle, and each colliding pair is verified. A variant is dealt by its leading bits: a fingerprint
goes once to every prefix within ``r`` flips of its own, and the variants of the remaining
bits are spread out where they meet, so 137 small rows travel for 2,081 variants.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.components import connected_components
from cairn.llm.support import materialize, shuffle_partitions

SHINGLE = 4
SEED = 42
BITS = 64
DISTANCE = 4
#: Fingerprints that one prefix may hold before longer prefixes are used.
PREFIX_ROWS = 20_000
#: Variants spread out at a time.
CHUNK_VARIANTS = 1_500_000


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit."""
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def majority(counts: np.ndarray, n: int) -> int:
    """The bits that more than half of ``n`` hashes have."""
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of ASCII-lower-cased word shingles, repeats included; no words: zero."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    body, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for i in range(0, n, 65536):
        counts += bit_counts(np.array([digest(body[s:e], seed) for s, e in zip(starts[i : i + 65536], stops[i : i + 65536], strict=True)], np.uint64))
    return majority(counts, n)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(batch.column(1)[i].as_py()) for i in range(batch.num_rows)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def flips(bits: int, most: int) -> list[int]:
    """All masks over ``bits`` bits with at most ``most`` ones."""
    return [sum(1 << b for b in c) for k in range(most + 1) for c in combinations(range(bits), k)]


def _prefix_bits(fps: DataFrame) -> int:
    """The shortest prefix of which no value holds more than PREFIX_ROWS fingerprints, 32 bits at most."""
    for bits in (16, 24):
        most = fps.groupBy(F.shiftrightunsigned("fp", BITS - bits).alias("p")).count().agg(F.max("count")).first()[0] or 0
        if most <= PREFIX_ROWS:
            return bits
    return 32


def variants_under(prefix: np.ndarray, bits: int, fp: np.ndarray, radius: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(variant, row, flips) for the variants of ``fp`` within ``radius`` flips that begin with their row's prefix of ``bits`` bits.

    Every variant comes in one piece with all its rows. A piece has about ``most`` variants: a larger one is
    divided by the variants' next bit, so that memory stays bounded however many rows a prefix has.
    """
    todo = [(bits, prefix, np.arange(len(fp)))]
    while todo:
        bits, prefix, rows = todo.pop()
        low = BITS - bits
        used = np.bitwise_count((fp[rows] >> np.uint64(low)) ^ prefix).astype(np.int64)
        rows, prefix, used = rows[used <= radius], prefix[used <= radius], used[used <= radius]
        sizes = np.cumsum([math.comb(low, r) for r in range(radius + 1)])
        if len(rows) > 1 and sizes[radius - used].sum() > most and low:
            todo += [(bits + 1, (prefix << np.uint64(1)) | np.uint64(bit), rows) for bit in (1, 0)]
            continue
        body = (fp[rows] & np.uint64((1 << low) - 1)) | (prefix << np.uint64(low))
        found, of, far = [], [], []
        for left in range(radius + 1):
            at, masks = np.flatnonzero(radius - used == left), np.array(flips(low, left), np.uint64)
            found.append((body[at][:, None] ^ masks[None, :]).ravel())
            of.append(np.repeat(rows[at], len(masks)))
            far.append((used[at][:, None] + np.bitwise_count(masks)[None, :].astype(np.int64)).ravel())
        yield np.concatenate(found), np.concatenate(of), np.concatenate(far)


def colliding_pairs(variant: np.ndarray, row: np.ndarray, far: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of rows (hub, member): in each variant's group the first row within ``radius`` flips, and every other row.

    Any two rows of a group of which one is within ``radius`` are joined by such pairs, so groups aren't paired up.
    """
    order = np.lexsort((row, far > radius, variant))
    variant, row, far = variant[order], row[order], far[order]
    first = np.r_[True, variant[1:] != variant[:-1]][: len(variant)]
    start = np.maximum.accumulate(np.where(first, np.arange(len(variant)), 0))
    pair = ~first & (far[start] <= radius)
    codes = np.unique((row[start][pair].astype(np.uint64) << np.uint64(32)) | row[pair].astype(np.uint64))
    return (codes >> np.uint64(32)).astype(np.int64), (codes & np.uint64(0xFFFFFFFF)).astype(np.int64)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Indexes of pairs (a, b) that join the same rows as all of them and close no ring."""
    label, kept = np.arange(n), []
    alive = np.arange(len(a))
    while True:
        alive = alive[label[a[alive]] != label[b[alive]]]
        if not len(alive):
            return np.unique(np.concatenate(kept)) if kept else alive
        least = np.full(n, len(a), np.int64)
        np.minimum.at(least, label[a[alive]], alive)
        np.minimum.at(least, label[b[alive]], alive)
        chosen = np.unique(least[least < len(a)])
        kept.append(chosen)
        while True:
            before, low = label.copy(), np.minimum(label[a[chosen]], label[b[chosen]])
            np.minimum.at(label, label[a[chosen]], low)
            np.minimum.at(label, label[b[chosen]], low)
            label = label[label]
            if (label == before).all():
                break


def fingerprint_links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fps(fp)``, each at most ``distance`` bits apart.

    Two fingerprints share a component of the links exactly if a chain of such pairs joins them. Pairs that
    collide in a variant are made distinct and verified by their Hamming distance; of the verified pairs found
    under one prefix those that close a ring are left out. For an odd distance one end is reached within half of
    it, rounded down, and the other within half, rounded up.
    """
    inner, radius = distance // 2, (distance + 1) // 2
    bits = _prefix_bits(fps)
    low = BITS - bits
    copies = F.explode(F.array(*(F.lit(m) for m in flips(bits, radius)))).alias("mask")
    dealt = fps.select("fp", copies).select("fp", F.shiftrightunsigned("fp", low).bitwiseXOR(F.col("mask")).alias("prefix"))

    def verified(keys: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pairs = []
        for piece in variants_under(keys, bits, fp, radius, CHUNK_VARIANTS):
            hub, member = colliding_pairs(*piece, inner)
            near = np.bitwise_count(fp[hub] ^ fp[member]) <= distance
            hub, member = hub[near], member[near]
            if len(hub):
                kept = forest(len(fp), hub, member)
                pairs.append((fp[hub[kept]], fp[member[kept]]))
        a, b = (np.concatenate(x) for x in zip(*pairs, strict=True)) if pairs else (fp[:0], fp[:0])
        return a.view(np.int64), b.view(np.int64)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive ordered by prefix; whole prefixes are spread out a bounded number of rows at a time."""
        most = max(1, CHUNK_VARIANTS // 16)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def whole(last: bool):
            keys, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            end = len(keys) if last else int(np.searchsorted(keys, keys[-1]))
            held[:] = [(keys[end:], fp[end:])]
            at = 0
            while at < end:
                stop = min(end, at + most)
                stop = end if stop == end else max(int(np.searchsorted(keys, keys[stop])), int(np.searchsorted(keys, keys[at], side="right")))
                a, b = verified(keys[at:stop], fp[at:stop])
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                at = stop

        for batch in batches:
            if batch.num_rows:
                held.append(tuple(batch.column(k).to_numpy().astype(np.int64).view(np.uint64) for k in (0, 1)))
                if sum(len(k) for k, _ in held) >= most:
                    yield from whole(False)
        if held:
            yield from whole(True)

    parts = shuffle_partitions(fps.sparkSession)
    return dealt.select("prefix", "fp").repartition(parts, "prefix").sortWithinPartitions("prefix").mapInArrow(meet, "a long, b long").distinct()


def simhash_components(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs(doc_id, text)``.

    component_id is the smallest doc_id reachable by links of at most ``distance`` differing bits.
    Null and empty texts have fingerprint zero and are linked like any other. Equal fingerprints are
    one node, whatever the number of rows. Repeated rows each return a row. A null doc_id keeps its
    row and can't be a component's name; a component of such rows alone has a null id. Other columns
    are ignored. An empty table gives no rows.
    """
    marked = materialize(fingerprints(docs))
    nodes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = materialize(connected_components(fingerprint_links(nodes.select("fp"), distance)))
    named = nodes.join(found, nodes.fp == found.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    named = materialize(named)
    least = materialize(named.groupBy("component").agg(F.min("first").alias("component_id")))
    lookup = materialize(named.join(least, "component").select("fp", "component_id"))
    return marked.join(lookup, "fp").select("doc_id", "fp", "component_id")
