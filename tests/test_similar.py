"""Set joins, attachment and close names against loops."""

import random
from collections import Counter

from pyspark.sql import functions as F

from cairn.operators import similar


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_close_names_equal_brute_force_from_few_candidates(spark):
    rng = random.Random(3)
    one = ["", "a", "ab", "ba", "aaaa", "aaaaaaaa", "abcabcabc", "banana", "ananab", *("".join(rng.choices("abcdefgh", k=rng.randint(1, 14))) for _ in range(150))]
    two = sorted({*one[:60], *("".join(c for c in w if rng.random() > 0.1) + rng.choice(["", "x", "q"]) for w in one for _ in range(2)), *("".join(rng.choices("abcdefgh", k=rng.randint(3, 14))) for _ in range(300))})
    one = sorted(set(one))
    a, b = spark.createDataFrame([(x,) for x in one], "a string"), spark.createDataFrame([(x,) for x in two], "b string")
    for distance, size in ((1, 2), (2, 2), (2, 3)):
        got = {(r.a, r.b) for r in similar.close_candidates(a, b, distance, size).collect()}
        wanted = {(x, y) for x in one for y in two if edits(x, y) <= distance}
        assert wanted <= got and len(got) < len(one) * len(two) / (12 if distance == 1 else 4)
    best = {(r.q, r.place): (r.name, r.distance) for r in similar.close_names(a.withColumnRenamed("a", "q"), b.withColumnRenamed("b", "name"), "q", "name", 3, 2).collect()}
    for x in one:
        near = sorted((edits(x, y), y) for y in two if edits(x, y) <= 2)[:3]
        assert [best.get((x, k + 1)) for k in range(3)] == [(y, d) for d, y in near] + [None] * (3 - len(near))


def test_close_names_ignores_case_and_nulls(spark):
    asked = spark.createDataFrame([("OKLAND", 1), (None, 2), ("okland", 3)], "q string, k int")
    names = spark.createDataFrame([("Oakland",), ("oakland",), ("Ashland",), (None,)], "name string")
    got = sorted((r.k, r.name, r.distance, r.place) for r in similar.close_names(asked, names, "q", "name", 1).collect())
    assert [g[1:] for g in got] == [("Oakland", 1, 1)] * 2 and [g[0] for g in got] == [1, 3]


def by_loop(pairs):
    taken, out = set(), set()
    for row in sorted({p[0] for p in pairs}):
        free = [(s, t) for r, t, s in pairs if r == row and t not in taken]
        top = [t for s, t in free if s == max(free)[0]]
        if len(top) == 1:
            taken.add(top[0])
            out.add((row, top[0], max(free)[0]))
    return out


def test_attachment_is_the_same_in_rounds_and_in_one_task(spark):
    rng = random.Random(5)
    pairs = sorted({(rng.randrange(120), rng.randrange(60)) for _ in range(500)})
    pairs = [(a, b, rng.randrange(4) / 4) for a, b in pairs]
    frame = spark.createDataFrame(pairs, "row int, target int, score double")
    wanted = by_loop(pairs)
    for remainder in (0, 150, 10**6):
        assert {tuple(r) for r in similar.attach_in_order(frame, "row", "target", "score", remainder).collect()} == wanted
    assert similar.attach_in_order(frame.limit(0), "row", "target", "score").count() == 0


def test_text_is_attached_once(spark):
    rows = [(1, "TX", "A Ban!", "sun farm ban"), (2, "tx", "a ban", "wind ban"), (3, "TX", "a-ban", "wind"), (4, "TX", "Other", ""), (5, "NV", "a ban", "sun"), (6, "OH", "t", "same words"), (7, "OH", "t", None)]
    items = [(10, "TX", "a ban", "farm sun ban near"), (11, "TX", "A ban", "wind ban"), (12, "TX", "other", "x"), (13, "NV", "a ban", "sun a"), (14, "NV", "a ban", "sun b"), (15, "OH", "t", "same words"), (16, "OH", "t", "words same")]
    frame = lambda data, k: spark.createDataFrame(data, f"{k} int, st string, title string, text string").withColumn("words", similar.words_of(F.coalesce("text", F.lit(""))))
    got = {(r.r, r.i) for r in similar.attach_text(frame(rows, "r"), frame(items, "i"), ["st", "title"], "r", "i").collect()}
    assert got == {(1, 10), (2, 11), (4, 12)}  # 3 finds both taken; 5, 6 and 7 find two as good


def test_containing_joins_on_rare_words_only(spark):
    rng = random.Random(8)
    common, vocabulary = [f"c{k}" for k in range(12)], [f"w{k}" for k in range(400)]
    right = {k: common + rng.sample(vocabulary, rng.randint(0, 25)) for k in range(40)} | {99: []}
    left = {k: common + [w for w in right[k % 40] if rng.random() > 0.06] + rng.sample(vocabulary, 10) for k in range(160)}
    frame = lambda sets, k: spark.createDataFrame([(i, sorted(set(w))) for i, w in sets.items()], f"{k} int, words array<string>")
    got = {(r.l, r.r): round(r.score, 9) for r in similar.containing(frame(left, "l"), frame(right, "r"), "l", "r", 0.9).collect()}
    share = {(i, k): len(set(a) & set(b)) / len(set(b)) for i, a in left.items() for k, b in right.items() if b}
    assert got == {k: round(v, 9) for k, v in share.items() if v >= 0.9}
    held = Counter(r.element for r in similar._rarest(frame(right, "r").where("size(words) > 30"), "r", "words", F.lit(3)).collect())
    assert not set(held) & set(common)


def test_close_words_meet_by_few_keys_and_only_close_ones_travel(spark):
    rng = random.Random(13)
    syllables = ["an", "en", "er", "st", "the", "in", "on", "ing", "ei", "ch"]  # few letter pairs, so that any of them is common
    made = sorted({"".join(rng.choices(syllables, k=rng.randint(1, 7))) for _ in range(400)} | {"x" * 400, "x" * 401 + "y", "é" * 9, "e" + "é" * 8})
    one, two = made[::4], made
    a, b = spark.createDataFrame([(x,) for x in one], "a string"), spark.createDataFrame([(x,) for x in two], "b string")
    for distance in (0, 1, 2):
        got = [(r.a, r.b) for r in similar.close_candidates(a, b, distance).collect()]
        assert len(got) == len(set(got)) and set(got) == {(x, y) for x in one for y in two if abs(len(x) - len(y)) <= distance and edits(x, y) <= distance}
    limits = similar.BROADCAST_ROWS
    similar.BROADCAST_ROWS = 0
    try:
        assert sorted((r.a, r.b) for r in similar.close_candidates(a, b, 2).collect()) == sorted(got)
    finally:
        similar.BROADCAST_ROWS = limits
