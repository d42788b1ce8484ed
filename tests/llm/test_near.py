"""The pipeline's near-duplicate stage against brute force over five-word shingles at similarity 0.8."""

import random
from collections import Counter, defaultdict

import corpus_pipeline as P
import numpy as np
from cairn.llm import near


def grams(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def kept(texts):
    """Ids that are the smallest of their component."""
    sets, holders, shared = {d: grams(t) for d, t in texts.items()}, defaultdict(list), Counter()
    for d in sorted(sets):
        for g in sets[d]:
            holders[g].append(d)
    for ids in holders.values():
        shared.update((a, b) for k, a in enumerate(ids) for b in ids[k + 1 :])
    label = {d: d for d in sets}
    pairs = [(a, b) for (a, b), n in shared.items() if 5 * n >= 4 * (len(sets[a]) + len(sets[b]) - n)]
    empty = sorted(d for d in sets if not sets[d])
    pairs += list(zip(empty, empty[1:]))
    for _ in sets:
        before = dict(label)
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    return {d for d in label if label[d] == d}


def test_stage_equals_brute_force(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in table.collect()}
    assert {r.doc_id for r in P.near_duplicates(spark, table, sf).collect()} == kept(texts)


def test_stage_finds_worn_copies_and_spares_lesser_ones(spark, sf):
    rng = random.Random(5)
    texts = {None: "no id", 0: "", 1: None, 2: "few words", 3: "Few  words"}
    for k in range(10, 50):
        words = [f"w{rng.randrange(10**6)}" for _ in range(150)]
        texts[k] = " ".join(words)
        for copy, edits in ((100, (40,)), (200, (20, 60, 100)), (300, (10, 30, 50, 70, 90, 110))):
            texts[copy + k] = " ".join("x" if i in edits else w for i, w in enumerate(words))
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = [r.doc_id for r in P.near_duplicates(spark, table, sf).collect()]
    del texts[None]
    assert got.count(None) == 1 and set(got) - {None} == kept(texts)
    assert not set(got) & set(range(110, 150)) and not set(got) & set(range(210, 250)) and set(range(310, 350)) <= set(got)
    assert P.near_duplicates(spark, table.limit(0), sf).count() == 0


def test_chains_across_small_blocks(spark, sf, monkeypatch):
    """Chains whose ends aren't similar, compared in blocks and slots of two."""
    monkeypatch.setattr(near, "BLOCK", 2)
    monkeypatch.setattr(near, "SLOT", 2)
    rng = random.Random(9)
    texts = {}
    for k in range(12):
        words = [f"w{rng.randrange(10**6)}" for _ in range(160)]
        for step in range(9):  # neighbours share 138 to 149 of 156 shingles, ends none
            texts[100 * k + step] = " ".join(words[7 * step :] + [f"n{k}x{i}" for i in range(7 * step)])
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert sorted(r.doc_id for r in P.near_duplicates(spark, table, sf).collect()) == sorted(kept(texts)) == [100 * k for k in range(12)]


def test_hubs_count_shared_shingles():
    base = np.arange(100, dtype=np.uint64)
    hubs = near.Hubs(["a", "b", "c"], ["a", "b", "a"], [base, base[10:], np.arange(500, 520, dtype=np.uint64)])
    assert hubs.similar("x", "x", base[5:]) == ["a", "b"] and hubs.similar("a", "a", base) == ["b"]
    assert hubs.similar("x", "x", base[50:]) == [] and hubs.similar("x", "x", base[:0]) == []


def test_later_stages_follow_the_near_duplicates(spark, sf):
    table = P.materialize(P.boilerplate_lines(spark, P.materialize(P.quality(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)), sf))
    wanted = kept({r.doc_id: r.text for r in table.collect()})
    wanted -= {r.doc_id for r in P.contaminated(table, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in P.run(spark, sf).select("doc_id").distinct().collect()} == wanted
