"""Counting quotient filters against a counter, and exact duplicates against a loop."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cairn.llm import exact, quotient
from cairn.llm.quotient import QuotientFilter

DOCS = "doc_id long, text string, kept boolean, fp long, row int"


def filter_of(values, bits):
    keys, counts = np.unique(np.array(values, np.uint64), return_counts=True)
    return QuotientFilter.of(keys, counts, bits)


def counted(f):
    return {int(k): int(n) for k, n in zip(*f.items(), strict=True)}


@given(st.lists(st.integers(0, 255), max_size=300), st.lists(st.integers(0, 255), max_size=300))
@settings(max_examples=60, deadline=None)
def test_filters_are_exact_and_merge_without_loss(a, b):
    f, g = filter_of(a, 8), filter_of(b, 8)
    assert counted(f) == Counter(a) and counted(QuotientFilter.unpack(f.pack())) == Counter(a)
    both = f.merged(g)
    assert counted(both) == Counter(a) + Counter(b) == counted(g.merged(f))
    assert list(both.items()[0]) == sorted(set(a) | set(b))


@given(st.lists(st.integers(0, 2**64 - 1), max_size=50))
@settings(max_examples=40, deadline=None)
def test_filters_of_whole_hashes(values):
    assert counted(QuotientFilter.unpack(filter_of(values + values[:3], 64).pack())) == Counter(values + values[:3])


def test_counters_take_as_many_digits_as_they_need():
    keys, counts = np.array([0, 1, 6, 7], np.uint64), np.array([1, 1_000_000, 2, 70_000], np.uint64)
    f = QuotientFilter.of(keys, counts, 3)
    assert counted(f) == {0: 1, 1: 1_000_000, 6: 2, 7: 70_000} and f.key_bits - f.quotient_bits < 10
    assert counted(f.merged(f))[1] == 2_000_000
    with pytest.raises(ValueError, match="don't merge"):
        f.merged(filter_of([1], 4))


def test_runs_that_crowd_one_end_of_the_table():
    values = list(range(2**20 - 500, 2**20)) + [0, 5]
    assert counted(filter_of(values, 20)) == Counter(values)


def test_repeated_prints_over_partitions(spark, monkeypatch):
    monkeypatch.setattr(quotient, "FILTER_KEYS", 700)
    monkeypatch.setattr(quotient, "RANGE_KEYS", 300)
    rng = np.random.default_rng(1)
    values = [int(v) for v in rng.integers(-(2**63), 2**63, 4000)]
    values += values[:500] + [values[7]] * 3000 + [0, -1, -1, 2**63 - 1]
    prints = spark.createDataFrame([(v,) for v in values], "fp long").repartition(7)
    assert {r.fp: r.n for r in quotient.repeated_prints(prints, len(values)).collect()} == {v: n for v, n in Counter(values).items() if n > 1}
    assert quotient.repeated_prints(prints.limit(0), 0).count() == 0


def by_loop(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(d)
    out = Counter()
    for t, ids in groups.items():
        keep = min((d for d in ids if d is not None), default=None)
        stays = 0
        for d in ids:
            first = d == keep and not stays
            stays += first
            out[d, keep, len(ids), first, hashlib.sha256(t.encode()).hexdigest()] += 1
    return out


LONG = "word " * 300_000
ROWS = [
    (1, "a b"), (2, "a  b"), (3, "a\t\n b"), (4, " a b"), (5, "a b "), (6, "a\x0b\x0cb"), (7, "a b"), (8, None), (9, ""), (10, " "), (11, "\n\n"),
    (None, "a b"), (None, "lone"), (None, "lone"), (12, "twice"), (12, "twice"), (12, "thrice"), (13, "é \r x"), (14, "é x"), (15, "A b"), (16, LONG), (17, LONG + "\n"), (18, LONG + "x"), (19, "a\x1cb"), (20, "a\x00 b"),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(d, t, False, 7, 1) for d, t in ROWS], DOCS).repartition(3)
    got = exact.exact_duplicates(docs)
    assert Counter(map(tuple, got.collect())) == by_loop(ROWS)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert exact.exact_duplicates(docs.limit(0)).count() == 0


def test_texts_of_one_fingerprint_are_told_apart(spark, monkeypatch):
    """With a fingerprint of four values nearly all texts collide; bytes decide."""
    monkeypatch.setattr(exact.F, "xxhash64", lambda c: F.pmod(F.crc32(c), F.lit(4)).cast("long"))
    rows = [(k, f"text {k % 37}") for k in range(200)] + [(500, "single")]
    assert Counter(map(tuple, exact.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())) == by_loop(rows)


def test_without_a_broadcast(spark, sf, monkeypatch):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    monkeypatch.setattr("cairn.llm.support.BROADCAST_ROWS", -1)
    assert Counter(map(tuple, exact.exact_duplicates(table).collect())) == by_loop([(r.doc_id, r.text) for r in table.collect()])
