"""Grouped fits against dense ones, folds, and the order of elimination."""

import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.operators import selection as S

NAMES = ["a", "b", "c", "noise"]


def dense(x, y, c):
    """Newton on one dense matrix, by a solver of its own: gradient steps with exact line search would be slower."""
    scale = x.std(axis=0)
    z = np.hstack([np.ones((len(x), 1)), (x - x.mean(axis=0)) / np.where(scale == 0, 1, scale)])
    beta, ridge = np.zeros(z.shape[1]), np.diag([0.0] + [1.0] * x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-z @ beta))
        beta = beta - np.linalg.solve(c * (z.T * (p * (1 - p))) @ z + ridge, c * z.T @ (p - y) + ridge @ beta)
    return beta


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 4)) * [1, 50, 0.01, 1] + [0, 1000, 0, 3]
    y = (rng.random(400) < 1 / (1 + np.exp(-(x[:, 0] - (x[:, 1] - 1000) / 60)))).astype(int)
    return x, y


@pytest.fixture(scope="module")
def rows(spark, data):
    x, y = data
    df = spark.createDataFrame([(k, *map(float, v), int(t)) for k, (v, t) in enumerate(zip(x, y, strict=True))], "k int, a double, b double, c double, noise double, y int")
    return S.cut_lineage(S.stratified_folds(df.repartition(3), F.col("k"), "y", 4, 3))


def test_folds_are_stratified_and_differ_by_repeat(rows, data):
    got = {r.k: r.folds for r in rows.collect()}
    assert len(got) == 400
    for repeat in range(3):
        for label in (0, 1):
            sizes = np.bincount([f[repeat] for k, f in got.items() if data[1][k] == label], minlength=4)
            assert sizes.max() - sizes.min() <= 1
    assert len({tuple(f[r] for _, f in sorted(got.items())) for r in range(3)}) == 3


def test_all_models_at_once_equal_dense_fits(rows, data):
    x, y = data
    folds = {r.k: r.folds for r in rows.collect()}
    models = [S.Model(columns, c, r, f) for columns in (("a", "b"), tuple(NAMES)) for c in (0.01, 1.0, 100.0) for r, f in ((0, 0), (1, 3), (0, -1))]
    for m in S.fit(rows, NAMES, models):
        train = np.array([m.fold < 0 or folds[k][m.repeat] != m.fold for k in range(400)])
        wanted = dense(x[train][:, [NAMES.index(c) for c in m.columns]], y[train], m.c)
        assert np.abs(m.beta - wanted).max() < 1e-6


def test_separable_and_constant_columns(spark):
    df = spark.createDataFrame([(k, float(k), 7.0, int(k >= 20), [k % 2]) for k in range(40)], "k int, a double, b double, y int, folds array<int>")
    (m,) = S.fit(df, ["a", "b"], [S.Model(("a", "b"), 10.0)])
    assert m.coefficients()["b"] == 0 and np.abs(m.beta - dense(np.array([[k, 7.0] for k in range(40)]), np.array([k >= 20 for k in range(40)]), 10.0)).max() < 1e-6


def auc(p, y):
    pos, neg = [a for a, t in zip(p, y, strict=True) if t], [a for a, t in zip(p, y, strict=True) if not t]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def test_aucs_of_all_models_in_one_order(spark):
    rng = np.random.default_rng(1)
    scored = [(m, int(rng.integers(0, 2)), float(rng.integers(0, 8)) / 8) for m in range(5) for _ in range(60)] + [(9, 1, 0.5)]
    got = {r.model: r.auc for r in S.fold_aucs(spark.createDataFrame(scored, "model int, y int, p double")).collect()}
    for m in range(5):
        assert got[m] == pytest.approx(auc([s[2] for s in scored if s[0] == m], [s[1] for s in scored if s[0] == m]))
    assert got[9] is None


def test_elimination_equals_a_loop(rows, data):
    x, y = data
    folds = {r.k: r.folds for r in rows.collect()}
    found = S.select(rows, NAMES, "k", grid=(0.01, 1.0), folds=4, repeats=3)
    at = 0
    for c in (0.01, 1.0):
        columns, mine = list(NAMES), [r for r in found.rounds if r.c == c]
        for r in mine:
            assert list(r.columns) == columns
            coefficients, aucs = {n: [] for n in columns}, []
            for repeat in range(3):
                for fold in range(4):
                    test = np.array([folds[k][repeat] == fold for k in range(400)])
                    use = [NAMES.index(n) for n in columns]
                    beta = dense(x[~test][:, use], y[~test], c)
                    for n, b in zip(columns, beta[1:], strict=True):
                        coefficients[n].append(b)
                    z = (x[test][:, use] - x[~test][:, use].mean(axis=0)) / x[~test][:, use].std(axis=0)
                    aucs.append(auc(beta[0] + z @ beta[1:], y[test]))
            assert r.auc == pytest.approx(statistics.median(aucs)) and r.stable == all(S.sign_stable(v) for v in coefficients.values())
            assert r.dropped == (S.to_drop(coefficients) if len(columns) > 1 else None)
            columns = [n for n in columns if n != r.dropped]
            at += 1
    assert at == len(found.rounds) and found.chosen.stable and {"a", "b"} <= set(found.chosen.columns)
    best = max(r.auc for r in found.rounds)
    assert found.cost == pytest.approx(best - found.chosen.auc) and found.alarm == (found.cost > 0.02)
    kept = S.select(rows, ["noise"], "k", grid=(1.0,), folds=4, repeats=1, always=("a",))
    assert all(r.columns == ("noise",) and "a" in r.models[0].columns for r in kept.rounds)


def test_signs():
    assert S.instability([1.0, -0.5]) == 0.5 and S.instability([0.0, 0.0]) == 1.0 and S.instability([2.0, 1.0]) == 0.0
    assert S.to_drop({"a": [1, -1], "b": [2, -2], "c": [1, 1]}) == "a" and S.to_drop({"b": [1, -1], "a": [-1, 1]}) == "a" and S.to_drop({"c": [1]}) is None


def test_an_alarm_is_raised_by_cost_and_for_want_of_a_stable_round(rows):
    assert S.select(rows, ["a"], "k", grid=(1.0,), folds=4, repeats=1, alarm_at=-1.0).alarm
    even = rows.withColumn("noise", F.pmod(F.hash("k"), F.lit(2)) * 0.0 + F.when(F.col("folds")[0] < 2, F.col("y")).otherwise(1 - F.col("y")))
    shaky = S.select(even, ["noise"], "k", grid=(1.0,), folds=4, repeats=1)
    assert shaky.chosen is None and shaky.cost is None and shaky.alarm and not shaky.rounds[0].stable


def test_predictions_of_all_repeats_are_met_without_an_exchange(spark):
    df = spark.range(90).select(F.col("id").alias("k"), (F.col("id") % 10).alias("g"), (F.col("id") % 3 == 0).cast("int").alias("y"), F.sin("id").alias("x"))
    rows = S.cut_lineage(S.stratified_folds(df, F.col("k"), "y", 3, 2))
    models = S.fit(rows, ["x"], [S.Model(("x",), 1.0, r, f) for r in range(2) for f in range(3)])
    wanted = S.held_out(rows, ["x"], models, "k").groupBy("k").agg(F.round(F.avg("p"), 9).alias("p"))
    found = S.out_of_fold(rows, ["x"], "k", c=1.0, folds=3, repeats=2, others=("g",))
    assert "Exchange" not in found._jdf.queryExecution().toString()
    assert sorted(found.select("k", F.round("p", 9).alias("p")).collect()) == sorted(wanted.collect()) and found.where("g <> k % 10").count() == 0


def test_numbers_of_rows_follow_the_order_over_all_ranges(spark):
    df = spark.range(1000).repartition(7).select("id", F.md5(F.col("id").cast("string")).alias("h"))
    found = S.numbered(df.select("id"), [F.col("id") % 2, "h", F.desc("id")], {"h": F.md5(F.col("id").cast("string"))}).collect()
    hashes = {r.id: r.h for r in df.collect()}
    wanted = sorted(hashes, key=lambda i: (i % 2, hashes[i]))
    assert [r.id for r in sorted(found, key=lambda r: r["__below"])] == wanted and {r["__n"] for r in found} == {1000} and {r["__below"] for r in found} == set(range(1000))
