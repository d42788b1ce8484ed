"""The filter audit against a loop over documents, orders and steps."""

import itertools
import re
from collections import Counter

from cairn.llm.audit import audit_filters

DOCS = "doc_id long, text string, source string, words int, failed string"
LABELS = "doc_id long, quality int, toxic int, source string"


def by_loop(docs, labels):
    first = {}
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    rows = []
    for d, t, source in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": d is not None and d > first[t]}
        good, toxic = (d is not None and any(x[0] == d and x[k] == 1 for x in labels) for k in (1, 2))
        rows.append((source or "", {f for f, bad in fails.items() if bad}, good, toxic))
    out = {}
    for part in {r[0] for r in rows}:
        mine, shapley = [r for r in rows if r[0] == part], Counter()
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                before = set(order[: step - 1])
                out[part, "".join(order), step] = [len(left), len(gone), sum(f in r[1] and bool(r[1] & before) for r in mine), sum(r[1] == {f} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for key in [k for k in out if k[0] == part]:
            out[key].append(shapley[key[1][key[2] - 1]])
    return {(*k, *v) for k, v in out.items()}


MANY = " ".join(f"w{k}" for k in range(60))
HALF = " ".join(f"w{k % 39}" for k in range(60))  # exactly 65 of 100
ROWS = [
    (1, MANY, "s"), (2, MANY, "s"), (3, MANY + " #", "t"), (4, HALF, "s"), (5, HALF + " w1", "s"), (6, None, "s"), (7, "", None), (8, " \n\t ", ""), (9, MANY.upper(), "s"), (10, "é" * 95 + "ABCDE", "t"), (11, "é" * 94 + "ABCDE", "t"),
    (None, MANY, "s"), (None, MANY, "s"), (None, "lone |", None), (12, "same row " * 30, "t"), (12, "same row " * 30, "t"), (12, "same row " * 30, "s"), (13, "a b " * 40, "t"), (14, "x " * 40_000 + MANY, "t"), (15, " ".join(map(str, range(20_000))), "t"),
    (16, "a\x1cb " * 49 + "c", "t"), (2, "other text of id 2", "s"),
]
KNOWN = [(1, 1, 0, "z"), (2, 1, 1, "z"), (2, 0, 0, "z"), (3, 0, 1, "z"), (None, 1, 1, "z"), (12, 1, 1, "z"), (99, 1, 1, "z"), (4, None, None, "z"), (5, 2, 1, "z")]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(*r, 3, "x") for r in ROWS], DOCS).repartition(4)
    labels = spark.createDataFrame(KNOWN, LABELS)
    got = audit_filters(docs, labels)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = list(map(tuple, got.collect()))
    assert len(rows) == 3 * 600 and set(rows) == by_loop(ROWS, KNOWN)
    assert audit_filters(docs.limit(0), labels).count() == 0
    assert set(map(tuple, audit_filters(docs, labels.limit(0)).collect())) == by_loop(ROWS, [])


def test_words_stay_in_the_task_that_holds_the_document(spark, sf):
    """One exchange of texts and one of counts: no row of a word travels."""
    from cairn.llm import audit

    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id", "text", "xxhash64(text) AS fp")
    plan = audit.word_counts(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert not [line for line in plan.split("\n") if "Exchange" in line and "word#" in line]
