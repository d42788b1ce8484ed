"""Counting quotient filters over fingerprints, and the fingerprints that all partitions together hold more than once.

A filter keeps a fingerprint's upper bits, its quotient, by place: the remainders of equal quotients form a sorted run that
starts at the quotient's slot or behind the run before it. Two bits a slot say which quotients occur and where runs end;
a third marks slots that carry on the remainder before them as a counter. Read in order, a filter gives its
fingerprints sorted with their counts, so two filters merge like sorted lists, and nothing is lost.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.support import shuffle_partitions

#: Fingerprints that a task gathers before it writes them down as filters.
FILTER_KEYS = 1 << 20
#: Distinct fingerprints of a hash range, about: what one merging task holds at a time.
RANGE_KEYS = 1 << 20
#: Slots of a filter are taken to this share at most.
LOAD = 0.9
_HEAD = struct.Struct("<BBQ")


class QuotientFilter:
    """Counts of fingerprints of ``key_bits`` bits, exact for the fingerprints themselves."""

    def __init__(self, key_bits: int, quotient_bits: int, occupied: np.ndarray, ends: np.ndarray, counters: np.ndarray, slots: np.ndarray):
        self.key_bits, self.quotient_bits = key_bits, quotient_bits
        self.occupied, self.ends, self.counters, self.slots = occupied, ends, counters, slots

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray, key_bits: int) -> QuotientFilter:
        """Of sorted distinct ``keys`` below 2 ** key_bits, each with its count of 1 or more."""
        extra = counts.astype(np.uint64) - np.uint64(1)
        wanted = int(np.ceil((len(keys) + np.count_nonzero(extra)) / LOAD))
        quotient_bits = min(key_bits - 1, max(0, wanted - 1).bit_length())
        bits = key_bits - quotient_bits
        quotients = (keys >> np.uint64(bits)).astype(np.int64) if bits < 64 else np.zeros(len(keys), np.int64)
        mask = np.uint64((1 << bits) - 1)
        # a counter is written in as many digits of a slot's width as it needs, the lowest first
        digits = np.zeros(len(keys), np.int64)
        rest = extra.copy()
        while rest.any():
            digits += rest > 0
            rest = rest >> np.uint64(bits) if bits < 64 else np.zeros_like(rest)
        width = 1 + digits
        run, run_at = np.unique(quotients, return_index=True)
        length = np.add.reduceat(width, run_at) if len(run) else np.zeros(0, np.int64)
        before = np.cumsum(length) - length
        start = before + np.maximum.accumulate(run - before) if len(run) else before
        end = start + length
        place = np.repeat(start - before, np.diff(np.r_[run_at, len(keys)])) + np.cumsum(width) - width
        n = max(1 << quotient_bits, int(end[-1]) if len(end) else 0)
        occupied, ends, counters, slots = np.zeros(1 << quotient_bits, bool), np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, np.uint64)
        occupied[run], ends[end - 1], slots[place] = True, True, keys & mask
        for k in range(int(digits.max(initial=0))):
            more = digits > k
            counters[place[more] + 1 + k], slots[place[more] + 1 + k] = True, (extra[more] >> np.uint64(k * bits)) & mask
        return cls(key_bits, quotient_bits, occupied, ends, counters, slots)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprints, counts) in ascending order."""
        bits = self.key_bits - self.quotient_bits
        run, stop = np.flatnonzero(self.occupied), np.flatnonzero(self.ends) + 1
        start = np.maximum(run, np.r_[0, stop[:-1]]) if len(run) else run
        length = stop - start
        place = np.repeat(start - np.cumsum(length) + length, length) + np.arange(length.sum())
        quotient, counter = np.repeat(run, length), self.counters[place]
        value = self.slots[place]
        key = value[~counter]
        if bits < 64:
            key = key | (quotient[~counter].astype(np.uint64) << np.uint64(bits))
        owner = np.cumsum(~counter) - 1
        first = np.flatnonzero(~counter)
        digit = np.arange(len(place)) - first[owner] - 1 if len(place) else place
        counts = np.ones(len(key), np.uint64)
        if counter.any():
            np.add.at(counts, owner[counter], value[counter] << (digit[counter].astype(np.uint64) * np.uint64(bits)))
        return key, counts

    def merged(self, other: QuotientFilter) -> QuotientFilter:
        """The filter of both multisets: sorted remainders are merged, counts of equal ones added."""
        if self.key_bits != other.key_bits:
            raise ValueError("filters of different fingerprints don't merge")
        (a, m), (b, n) = self.items(), other.items()
        keys, counts = np.concatenate([a, b]), np.concatenate([m, n])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
        return QuotientFilter.of(keys[first], np.add.reduceat(counts, first) if len(first) else counts, self.key_bits)

    def __len__(self) -> int:
        return len(self.slots)

    def pack(self) -> bytes:
        width = -(-(self.key_bits - self.quotient_bits) // 8)
        body = np.ascontiguousarray(self.slots.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])
        return b"".join([_HEAD.pack(self.key_bits, self.quotient_bits, len(self.slots)), *(np.packbits(b).tobytes() for b in (self.occupied, self.ends, self.counters)), body.tobytes()])

    @classmethod
    def unpack(cls, data: bytes) -> QuotientFilter:
        key_bits, quotient_bits, n = _HEAD.unpack_from(data)
        at, fields = _HEAD.size, []
        for size in (1 << quotient_bits, n, n):
            fields.append(np.unpackbits(np.frombuffer(data, np.uint8, -(-size // 8), at), count=size).astype(bool))
            at += -(-size // 8)
        width = -(-(key_bits - quotient_bits) // 8)
        slots = np.zeros((n, 8), np.uint8)
        slots[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
        return cls(key_bits, quotient_bits, *fields, slots.view("<u8").ravel().astype(np.uint64))


def range_bits(n: int, tasks: int) -> int:
    """Ranges grow in number with the fingerprints, so that each holds about as many at every size."""
    return min(32, max(1, (max(n // RANGE_KEYS, 2 * tasks) - 1).bit_length()))


def partition_filters(prints: DataFrame, bits: int) -> DataFrame:
    """(hash_range, filter): each partition's fingerprints as a filter for every range of the leading ``bits``."""
    key_bits = 64 - bits

    def filters(gathered: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(gathered), return_counts=True)
        ranges, at = np.unique(keys >> np.uint64(key_bits), return_index=True)
        ends, rest = np.r_[at[1:], len(keys)].astype(int), keys & np.uint64((1 << key_bits) - 1)
        packed = [QuotientFilter.of(rest[i:j], counts[i:j], key_bits).pack() for i, j in zip(at, ends, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(ranges.astype(np.int64)), pa.array(packed, pa.binary())], names=["hash_range", "filter"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, n = [], 0
        for batch in batches:
            gathered.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            n += batch.num_rows
            if n >= FILTER_KEYS:
                yield filters(gathered)
                gathered, n = [], 0
        if n:
            yield filters(gathered)

    return prints.mapInArrow(run, "hash_range long, filter binary")


def repeated_prints(prints: DataFrame, n: int) -> DataFrame:
    """(fp, n) of the values of ``prints(fp long)``, without nulls, that occur more than once; ``n`` is about its rows.

    A value that very many rows have is one entry of each partition's filter. No values: no rows.
    """
    parts = shuffle_partitions(prints.sparkSession)
    bits = range_bits(n, parts)

    def repeats(hash_range: int, level: list[QuotientFilter]) -> pa.RecordBatch:
        whole = level[0]
        for f in level[1:]:
            whole = whole.merged(f)
        keys, counts = whole.items()
        more = counts > 1
        prefix = np.uint64(hash_range << (64 - bits))
        return pa.RecordBatch.from_arrays([pa.array((keys[more] | prefix).view(np.int64)), pa.array(counts[more].astype(np.int64))], names=["fp", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, level = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                hash_range, data = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if hash_range != held:
                    if level:
                        yield repeats(held, level)
                    held, level = hash_range, []
                level.append(QuotientFilter.unpack(data))
                # equals are merged with equals, so each entry is copied a few times only
                while len(level) > 1 and len(level[-2]) <= 2 * len(level[-1]):
                    last = level.pop()
                    level[-1] = level[-1].merged(last)
        if level:
            yield repeats(held, level)

    return partition_filters(prints.select("fp"), bits).repartition(parts, "hash_range").sortWithinPartitions("hash_range").mapInArrow(run, "fp long, n long")
