"""Decontamination against brute force of the 80 % rule."""

import random

from cairn.llm import decontam
from cairn.llm.decontam import contaminated


def accepted(doc, item):
    length = min(13, len(item))
    share = 0.8 if len(item) >= 12 else 1.0
    for start in range(-len(item), len(doc)):
        equal = [0 <= start + k < len(doc) and doc[start + k] == w for k, w in enumerate(item)]
        if any(sum(equal[k : k + length]) >= share * length for k in range(len(item) - length + 1)):
            return True
    return False


def test_equals_brute_force(spark):
    rng = random.Random(3)
    items = {k: [f"t{rng.randrange(400)}" for _ in range(n)] for k, n in enumerate([1, 3, 5, 8, 11, 12, 12, 13, 13, 14, 15, 15, 20, 40])}
    docs = []
    for item in items.values():
        for wrong in (0, 1, 2, 2, 2, 2, 2, 2, 3, 3, 4):
            worn = list(item)
            for at in rng.sample(range(len(item)), min(wrong, len(item))):
                worn[at] = "x"
            docs.append([f"p{rng.randrange(9)}" for _ in range(rng.randrange(4))] + worn + ["q"] * rng.randrange(3))
        docs.append([w for k, w in enumerate(item) if k > 1])
        docs.append(["x" if k % 5 == 4 else w for k, w in enumerate(item)])
    for a in range(15):  # every pair of a 15-token item's words replaced
        docs += [["x" if k in (a, b) else w for k, w in enumerate(items[10])] for b in range(a)]
    wanted = {(d, k) for d, doc in enumerate(docs) for k, item in items.items() if accepted(doc, item)}
    texts = spark.createDataFrame([(d, " ".join(doc)) for d, doc in enumerate(docs)], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(item)) for k, item in items.items()], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in contaminated(texts, bench).collect()} == wanted
    assert len(wanted) > 150


def test_a_long_text_of_one_word_is_split_once(spark):
    """20,000 equal words face an item of equal words at 20,018 places; the work is linear in them."""
    import time

    docs = spark.createDataFrame([(1, "ha " * 20_000), (2, "x " + "ha " * 19), (3, "ha x " * 10_000)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "ha " * 20), (2, "ha x " * 7), (2, "other words " * 7), (3, "ha")], "item_id long, text string")
    began = time.time()
    got = sorted((r.doc_id, r.item_id, r.n_matched, r.doc_start) for r in decontam.contaminated(docs, bench).collect())
    assert got == [(1, 1, 20, 0), (1, 3, 1, 0), (2, 1, 19, 0), (2, 3, 1, 1), (3, 2, 14, 0), (3, 3, 1, 0)]
    assert time.time() - began < 120
