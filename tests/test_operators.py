import pytest
from pyspark.sql import functions as F

from cairn.operators import derive, joins, matching, places, quality, rollup, scoring, sets, windows


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_rollup_takes_the_weakest_row_and_unanimous_values(spark):
    df = frame(spark, "k int, v string", (1, "verified"), (1, "located"), (2, "verified"), (2, "verified"), (3, None))
    ladder = ("verified", "located", "unverified")
    assert got(df.groupBy("k").agg(rollup.weakest(F.col("v"), ladder), rollup.unanimous(F.col("v")))) == [(1, "located", None), (2, "verified", "verified"), (3, "unverified", None)]


def test_mode_ties_go_to_the_first_name(spark):
    df = frame(spark, "k int, v string", (1, "b"), (1, "a"), (1, "c"), (1, "c"), (2, "b"), (2, "a"))
    assert got(rollup.mode_by(df, ["k"], "v", "m")) == [(1, "c"), (2, "a")]


def test_share_of_nothing_is_null_and_rounds_half_even(spark):
    df = frame(spark, "a int, b int", (0, 0), (1, 16))
    assert [r[0] for r in df.select(rollup.share(F.col("a"), F.col("b"))).collect()] == [None, 0.062]


def test_growth_doesnt_shift_over_gaps(spark):
    df = frame(spark, "k int, y long, v double", (1, 2000, 10.0), (1, 2002, 15.0), (1, 2003, 9.0), (1, 2005, 0.0), (1, 2007, 1.0))
    assert {r.y: r.growth for r in rollup.growth(df, "k", "y", "v", 2).collect()} == {2000: None, 2002: 0.5, 2003: None, 2005: -1.0, 2007: None}


def test_asof_value_never_reads_later_rows_and_takes_ties(spark):
    left = frame(spark, "id int, k int, t timestamp_ntz", *[(1, 1, __import__("datetime").datetime(2024, 1, 3)), (2, 1, __import__("datetime").datetime(2024, 1, 1)), (3, 9, __import__("datetime").datetime(2024, 1, 3))])
    dt = __import__("datetime").datetime
    right = frame(spark, "k int, t timestamp_ntz, v int", (1, dt(2024, 1, 2), 5), (1, dt(2024, 1, 3), 6), (1, dt(2024, 1, 4), 7))
    assert got(joins.asof_value(left, right, ["k"], "t", "t", "v").select("id", "value")) == [(1, 6), (2, None), (3, None)]
    assert got(joins.asof_value(left, right, ["k"], "t", "t", "v", lag="1 day").select("id", "value")) == [(1, 5), (2, None), (3, None)]


def test_asof_count_excludes_ties(spark):
    df = frame(spark, "k int, t int", (1, 1), (1, 2), (1, 2), (1, 3))
    assert got(joins.asof_count(df, ["k"], "t")) == [(1, 1, 0), (1, 2, 1), (1, 2, 1), (1, 3, 3)]


def test_margin_and_claims(spark):
    df = frame(spark, "l int, r int, s double", (1, 10, 0.9), (1, 11, 0.5), (2, 20, 0.6), (2, 21, 0.59), (3, 30, 0.9), (4, 30, 0.8))
    assert got(joins.margin_match(df, "l", "r", "s", 0.1).select("l", "status")) == [(1, "matched"), (2, "ambiguous_margin"), (3, "ambiguous_claim"), (4, "ambiguous_claim")]


def test_nearest_margin_gives_what_all_pairs_give_without_making_them(spark):
    odd = [None, float("nan"), float("inf"), float("-inf")]
    left = frame(spark, "l long, b int, x double", *[(k, k % 4, (k * 37 % 101) * 0.7) for k in range(60)], *[(100 + k, k % 2, v) for k, v in enumerate([*odd, *odd, 1e9, -1e9, 1e9, 5000.0])], (200, 1, 3.0), (200, 1, 55.5), (201, 7, 1.0), (202, None, 1.0), (203, 5, 1.0), (204, 6, 2.0))
    right = frame(spark, "r long, b int, y double", *[((k * 61) % 211, k % 4, (k * 53 % 97) * 0.9) for k in range(211)], *[(300 + k, 0, v) for k, v in enumerate([*odd, None])], (400, 5, None), (401, 5, None), (402, 6, 1.5), (403, 6, None), (404, None, 1.0), (405, 1, 4.0), (406, 1, 4.0))
    score = lambda s, c: F.round(1 / (1 + F.abs(s - c)), 4)
    pairs = left.join(right, "b").select("l", "r", score(F.col("x"), F.col("y")).alias("s"))
    found = joins.nearest_margin(left, right, "b", "l", "r", "x", "y", score, 0.001)
    assert sorted(map(str, found.collect())) == sorted(map(str, joins.margin_match(pairs, "l", "r", "s", 0.001).collect()))
    crowd = spark.range(20_000).select(F.col("id").alias("r"), F.lit(1).alias("b"), (F.col("id") % 40).cast("double").alias("y"))
    many = spark.range(20_000).select(F.col("id").alias("l"), F.lit(1).alias("b"), (1e9 + F.col("id") % 7_000).alias("x"))
    # 400 million pairs, all of score 0
    assert got(joins.nearest_margin(many, crowd, "b", "l", "r", "x", "y", score, 0.001).groupBy("best_id", "best_score", "status").count()) == [(0, 0.0, "ambiguous_margin", 20_000)]


def test_overlay_is_gated_and_takes_the_newest(spark):
    base = frame(spark, "k int, v string", (1, "a"), (2, "b"), (3, "c"))
    review = frame(spark, "k int, v string, d int, access string", (1, "x", 1, "opened"), (1, "y", 2, "opened"), (2, "z", 1, "none"), (9, "q", 1, "opened"))
    assert got(joins.overlay(base, review, "k", ["v"], F.col("access") == "opened", ["d"])) == [(1, "y"), (2, "b"), (3, "c")]
    assert [r.k for r in joins.unknown_keys(review, base, "k").collect()] == [9]


def test_first_other(spark):
    df = frame(spark, "b int, id int, ok boolean", (1, 1, True), (1, 2, True), (1, 3, False), (2, 4, True))
    assert got(joins.first_other(df, ["b"], "id", F.col("ok")).select("id", "sibling")) == [(1, 2), (2, 1), (3, 1), (4, None)]


def test_changes_only(spark):
    df = frame(spark, "k int, t int, s string", (1, 1, "a"), (1, 2, "a"), (1, 3, None), (1, 4, None), (1, 5, "a"))
    assert [r.t for r in windows.changes_only(df, ["k"], ["t"], ["s"]).orderBy("t").collect()] == [1, 3, 5]


def test_ranks_with_ties(spark):
    df = frame(spark, "id int, v int", (1, 5), (2, 5), (3, 9), (4, 1))
    assert got(windows.competition_rank(df, "v").select("id", "rank_all")) == [(1, 2), (2, 2), (3, 1), (4, 4)]
    assert got(windows.midrank_percentile(df, "v").select("id", F.col("pct").cast("double"))) == [(1, 50.0), (2, 50.0), (3, 87.5), (4, 12.5)]


@pytest.mark.parametrize("n", [1, 5, 3222])
def test_normal_scores_equal_the_exact_quantile(spark, n):
    from statistics import NormalDist

    exact = [round(NormalDist().inv_cdf((i - 0.375) / (n + 0.25)), 3) + 0.0 for i in range(1, n + 1)]
    assert [r[0] for r in spark.range(1, n + 1).select(windows.normal_score(F.col("id"), F.lit(n))).collect()] == exact
    assert [r[0] for r in spark.createDataFrame([(0.0,), (1.0,), (None,)], "p double").select(windows.inverse_normal(F.col("p"))).collect()] == [None] * 3


def test_normal_scores_break_ties_by_later_columns(spark):
    df = frame(spark, "k string, v int, u double", ("a", 1, 2.0), ("b", 1, 1.0), ("c", 0, 9.0), ("d", 1, 2.0))
    out = windows.normal_scores(df, [F.col("v"), F.col("u"), F.col("k")])
    assert got(out.select("k", "normal", "decile")) == [("a", 0.299, 6), ("b", -0.299, 3), ("c", -1.049, 1), ("d", 1.049, 8)]
    assert windows.normal_scores(df.limit(0), [F.col("v")]).count() == 0


def test_running_sums_over_many_ranges(spark):
    """Ranges are neither coalesced nor equal here: the order must hold across them, ties and NULLs included."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(3000).select("id", F.when(F.col("id") % 50 > 0, F.pmod(F.col("id") * 7919, F.lit(400))).alias("v"))
        rows = sorted(((r.id, r.v) for r in df.collect()), key=lambda x: (x[1] is not None, x[1] or 0, x[0]))
        assert {r.id: r.priority for r in windows.dense_priority(df, [F.asc("v"), F.asc("id")]).collect()} == {i: n + 1 for n, (i, _) in enumerate(rows)}
        rank = {r.id: r.rank_all for r in windows.competition_rank(df, "v").collect()}
        values = [v for _, v in rows if v is not None]
        assert rank == {i: None if v is None else 1 + sum(x > v for x in values) for i, v in rows}
        plan = windows.dense_priority(df, [F.asc("v")])._jdf.queryExecution().optimizedPlan().toString()
        assert "partitionBy" not in plan
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_matches_stay_on_their_rows_after_a_shuffle(spark, adaptive):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        left = spark.range(400).select("id", (F.col("id") % 3).alias("k"), F.array(F.col("id") % 10, F.when(F.col("id") % 4 == 0, F.col("id") % 20)).alias("s")).repartition(7, F.rand(1))
        right = spark.range(6).select((F.col("id") % 3).alias("k"), F.array(F.col("id"), F.col("id") + 10).alias("t"))
        tags = {k: {v for i in range(6) if i % 3 == k for v in (i, i + 10)} for k in range(3)}
        want = {i: bool(({i % 10} | ({i % 20} if i % 4 == 0 else set())) & tags[i % 3]) for i in range(400)}
        assert {r.id: r.matched for r in joins.overlapping(left, right, "k", "s", "t").collect()} == want
        new = spark.range(300).select("id", (F.col("id") % 5).alias("p"), F.lit("x").alias("t"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("a")).repartition(5, F.rand(2))
        old = frame(spark, "p long, t string, a long", (0, "x", 1), (0, "x", 1), (1, "x", None), (2, "y", 2), (None, "x", 1))
        held = {(0, 1), (1, None)}
        verdict = lambda i: "duplicate" if (i % 5, i % 3 or None) in held else "flagged" if i % 5 < 2 else "new"
        assert {r.id: r.verdict for r in matching.cross_source(new, old, "p", "t", ["a"]).collect()} == {i: verdict(i) for i in range(300)}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_asof_ties_have_a_defined_winner(spark):
    left = frame(spark, "id int, k int, t int", (1, 1, 5))
    right = frame(spark, "k int, t int, v int, e string", (1, 4, 9, "a"), (1, 4, 7, "b"), (1, 3, 99, "z")).repartition(3)
    assert joins.asof_value(left, right, ["k"], "t", "t", "v").first().value == 9
    assert joins.asof_value(left, right, ["k"], "t", "t", "v", tie="e").first().value == 7


def test_three_way_merge(spark):
    side = lambda **v: frame(spark, "k string, v string", *v.items())
    base = side(same="1", mine="1", yours="1", both="1", fight="1", gone="1", cut="1")
    ours = side(same="1", mine="2", yours="1", both="2", fight="2", cut="1", new="9", clash="1")
    theirs = side(same="1", mine="1", yours="3", both="2", fight="3", clash="2")
    out = {r.k: (r.v, r.outcome) for r in sets.three_way_merge(base, ours, theirs, "k", "v").collect()}
    assert out == {"same": ("1", "unchanged"), "mine": ("2", "ours"), "yours": ("3", "theirs"), "both": ("2", "both_same"), "fight": ("1", "disputed"), "gone": (None, "removed"), "cut": (None, "removed"), "new": ("9", "ours"), "clash": (None, "disputed")}


def test_keyed_diff_ignores_order(spark):
    a = frame(spark, "k int, x string, y int", (1, "a", 1), (2, "b", None))
    assert sets.keyed_diff(a, a.orderBy(F.desc("k")), "k", ["x", "y"]).count() == 0
    b = frame(spark, "k int, x string, y int", (2, "c", 3), (3, "d", 4))
    assert got(sets.keyed_diff(a, b, "k", ["x", "y"])) == [(1, "removed", "*"), (2, "modified", "x"), (2, "modified", "y"), (3, "added", "*")]


def test_quarantine_and_first_reason(spark):
    df = frame(spark, "id int, v int", (1, 5), (2, 50), (3, None))
    q = quality.quarantine(df, [("BIG", "HIGH", F.col("v") > 10), ("GONE", "LOW", F.col("v").isNull())])
    assert got(q.select("id", F.array_join("issues", ","), "blocked")) == [(1, "", False), (2, "HIGH:BIG", True), (3, "LOW:GONE", False)]


def test_fill_collapse_counts_a_missing_column(spark):
    before = frame(spark, "a string, b string", *[("x", "y")] * 30)
    after = before.drop("b")
    out = {r.column: r.collapsed for r in quality.fill_collapse(quality.fill_profile(before, ["a", "b"]), quality.fill_profile(after, ["a"])).collect()}
    assert out == {"a": False, "b": True}


def test_parity_reports_nulls(spark):
    a, b = frame(spark, "k int, n int", (1, 1), (2, None)), frame(spark, "k int, n int", (1, 1), (2, 3))
    assert [r.k for r in quality.parity(a, b, "k", "n").collect()] == [2]


def test_stack_and_auc(spark):
    df = frame(spark, "p array<double>", ([1.0, 8.0, 3.0],), ([],), ([90.0, 90.0],))
    assert [r[0] for r in df.select(scoring.stack(F.col("p"))).collect()] == [9.0, 0.0, 100.0]
    auc = scoring.pair_auc(frame(spark, "s double, y int", (0.1, 0), (0.5, 1), (0.5, 0), (0.9, 1)), "s", "y").first()
    assert auc.auc == 0.875


def test_derived_fields(spark):
    day = F.lit("2024-06-15")
    df = frame(spark, "s string, e string", ("active", "2024"), ("active", "2024-05"), ("repealed", None), ("active", None), (None, None))
    assert [r[0] for r in df.select(derive.currency(F.col("s"), F.col("e"), day)).collect()] == ["active", "lapsed", "lifted", "active", "unknown"]
    ends, basis = derive.term_end(F.col("d"), F.col("t"))
    terms = frame(spark, "d string, t string", ("2024-01-31", "a one-time 6-month moratorium"), ("2024-01-01", "until 2024-09-01"), ("2024", "12 months"))
    assert [(str(r[0]), r[1]) for r in terms.select(ends, basis).collect()] == [("2024-07-31", "computed"), ("2024-09-01", "stated"), ("None", None)]
    grade, by, old = derive.check_grade(F.col("s"), F.col("d"), day, {"web": "http", "code": "ordinance", "news": "press"})
    checks = frame(spark, "s string, d string", ("http://x; ordinance; press", "2024-01-01"), ("http://x", "2020-01-01"), ("", None))
    assert [(r[0], r[2]) for r in checks.select(grade, by, old).collect()] == [("A", False), ("C", True), ("U", True)]


def test_sole_contributors(spark):
    df = frame(spark, "i int, p int", (1, 1), (1, 2), (2, 2), (3, 3), (3, 3))
    assert got(derive.sole_contributors(df, "i", "p")) == [(1, 1), (3, 1)]


def test_polygons(spark):
    ring = [(1, 0, n, x, y) for n, (x, y) in enumerate([(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)])]
    edges = places.ring_edges(frame(spark, "id int, ring int, n int, x double, y double", *ring))
    points = frame(spark, "point_id int, px double, py double", (1, 1.0, 1.0), (2, 5.0, 1.0), (3, 1.0, 9.0), (4, -1.0, 2.0))
    assert got(places.points_in_polygons(points, edges)) == [(1, 1)]
    assert got(places.centroids(edges)) == [(1, 2.0, 2.0)]


def test_distance_join_equals_the_cross_product(spark):
    from cairn.functions.scalars import haversine_miles

    a = spark.range(60).select("id", (30 + F.col("id") * 7 % 20).cast("double").alias("lat"), (-90 + F.col("id") * 11 % 30).cast("double").alias("lon"))
    b = a.select(F.col("id").alias("other"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    d = haversine_miles(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))
    near = got(joins.within_distance(a, b, 200.0, d).select("id", "other"))
    assert near == got(a.crossJoin(b).where(d <= 200).select("id", "other"))
