"""Fits by grouped Newton steps, beside SQL that writes the same steps out."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cairn.operators import selection
from cairn.plans.base import query

FOLDS, REPEATS, C, STEPS = 3, 2, 1.0, 9
TIES = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
Z = ("1", "z1", "z2", "z3")


def _newton_sql() -> str:
    """Stratified folds, standardisation and Newton steps in SQL; a step solves four equations by Cholesky."""
    rank = range(4)
    parts = [
        f"r AS MATERIALIZED (SELECT l_orderkey, l_linenumber, l_orderkey * 1000000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(TIES)}) AS id, CAST(l_returnflag = 'R' AS INT) AS y, l_quantity AS x1, l_extendedprice AS x2, l_discount AS x3 FROM lineitem)",
        f"d AS MATERIALIZED (SELECT r.*, rep, (row_number() OVER (PARTITION BY rep, y ORDER BY md5('0:' || rep || ':' || id), id) - 1) % {FOLDS} AS fold FROM r, range(0, {REPEATS}) g(rep))",
        f"s AS MATERIALIZED (SELECT rep, f, {', '.join(f'avg(x{k}) AS m{k}, stddev_pop(x{k}) AS s{k}' for k in (1, 2, 3))} FROM d, range(0, {FOLDS}) g(f) WHERE fold <> f GROUP BY rep, f)",
        f"t AS MATERIALIZED (SELECT id, l_orderkey, l_linenumber, y, rep, f, fold, {', '.join(f'(x{k} - m{k}) / s{k} AS z{k}' for k in (1, 2, 3))} FROM d JOIN s USING (rep))",
        f"b0 AS (SELECT rep, f, {', '.join(f'0.0::DOUBLE AS b{k}' for k in rank)} FROM s)",
    ]
    p = "1 / (1 + exp(-(b0 + b1 * z1 + b2 * z2 + b3 * z3)))"
    for step in range(STEPS):
        sums = ", ".join([f"sum(e * {Z[i]}) AS g{i}" for i in rank] + [f"sum(w * {Z[i]} * {Z[j]}) AS h{i}{j}" for i in rank for j in range(i + 1)])
        parts.append(f"a{step} AS (SELECT rep, f, {sums} FROM (SELECT rep, f, z1, z2, z3, {p} AS p, p - y AS e, p * (1 - p) AS w FROM t JOIN b{step} USING (rep, f) WHERE fold <> f) GROUP BY rep, f)")
        solve = []
        for i in rank:
            solve.append(f"{C} * g{i} + {f'b{i}' if i else '0'} AS v{i}")
            for j in range(i + 1):
                inner = "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
                value = f"{C} * h{i}{j}{' + 1' if i == j and i else ''}{inner}"
                solve.append(f"sqrt({value}) AS l{i}{j}" if i == j else f"({value}) / l{j}{j} AS l{i}{j}")
        solve += [f"(v{i}{''.join(f' - l{i}{k} * u{k}' for k in range(i))}) / l{i}{i} AS u{i}" for i in rank]
        solve += [f"(u{i}{''.join(f' - l{k}{i} * q{k}' for k in range(i + 1, 4))}) / l{i}{i} AS q{i}" for i in reversed(rank)]
        parts.append(f"b{step + 1} AS MATERIALIZED (SELECT rep, f, {', '.join(f'b{i} - q{i} AS b{i}' for i in rank)} FROM (SELECT *, {', '.join(solve)} FROM a{step} JOIN b{step} USING (rep, f)))")
    return f"WITH {', '.join(parts)} SELECT l_orderkey, l_linenumber, y, round(avg({p}), 6) AS p FROM t JOIN b{STEPS} USING (rep, f) WHERE fold = f GROUP BY id, l_orderkey, l_linenumber, y"


@query(_newton_sql())
def q_model_folds(t):
    """M1, M2: out-of-fold predictions of a standardised logistic regression, the mean over repeats of stratified folds."""
    at = F.row_number().over(W.partitionBy("l_orderkey").orderBy(*TIES))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_orderkey") * 1000000 + at).alias("id"), (F.col("l_returnflag") == "R").cast("int").alias("y"), "l_quantity", "l_extendedprice", "l_discount")
    rows = selection.cut_lineage(selection.stratified_folds(lines, F.col("id"), "y", FOLDS, REPEATS))
    p = selection.out_of_fold(rows, ["l_quantity", "l_extendedprice", "l_discount"], "id", c=C, folds=FOLDS, repeats=REPEATS, others=("l_orderkey", "l_linenumber"))
    return p.select("l_orderkey", "l_linenumber", "y", F.round("p", 6).alias("p"))


@query()
def q_model_selection(t):
    """M3: the rounds of an elimination over customers; the fits are those of q_model_folds, the order is tested against a loop."""
    orders = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.avg("o_totalprice").alias("mean_price"), F.max("o_totalprice").alias("top_price"))
    own = t.customer.select("c_custkey", "c_acctbal", "c_nationkey", (F.col("c_mktsegment") == "BUILDING").cast("int").alias("y"))
    pool = ["c_acctbal", "c_nationkey", "n", "mean_price", "top_price"]
    wide = own.join(orders, "c_custkey", "left").fillna(0, ["n", "mean_price", "top_price"]).select("c_custkey", "y", *(F.col(c).cast("double").alias(c) for c in pool))
    rows = selection.cut_lineage(selection.stratified_folds(wide, F.col("c_custkey"), "y", FOLDS, REPEATS))
    found = selection.select(rows, pool, "c_custkey", grid=(0.01, 1.0), folds=FOLDS, repeats=REPEATS)
    told = [(r.c, len(pool) - len(r.columns), ";".join(r.columns), round(r.auc, 6), r.stable, r.dropped, r is found.chosen, found.alarm) for r in found.rounds]
    return t.spark.createDataFrame(told, "c double, step int, variables string, auc double, stable boolean, dropped string, chosen boolean, alarm boolean")
