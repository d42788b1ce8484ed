"""Scores and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.operators import scoring as O
from cairn.plans.base import query


@query("""
WITH p AS (SELECT l_orderkey, list_reverse_sort(list(l_quantity)) AS p FROM lineitem GROUP BY 1)
SELECT l_orderkey, least(100.0, p[1] + 0.25 * (list_sum(p) - p[1]))::DOUBLE AS score FROM p""")
def q_score_stack(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.collect_list("l_quantity").alias("p")).select("l_orderkey", O.stack(F.col("p")).alias("score"))


@query("""
WITH c AS (SELECT least(1.0, l_discount * 10) AS p, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem)
SELECT CAST(least(floor(p * 5), 4) AS INTEGER) AS bin, count(*) AS n, round(avg(p), 8) AS mean_p, round(avg(y), 8) AS rate FROM c GROUP BY 1""")
def q_calibration(t):
    rows = t.lineitem.select(F.least(F.lit(1.0), F.col("l_discount") * 10).alias("p"), F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"))
    return O.calibration_bins(rows, "p", "y").select("bin", "n", F.round("mean_p", 8).alias("mean_p"), F.round("rate", 8).alias("rate"))


@query("""
WITH c AS (SELECT least(1.0, l_discount * 10) AS p, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS y FROM lineitem), b AS (SELECT least(floor(p * 5), 4) AS bin, count(*) AS n, avg(p) AS mp, avg(y) AS r FROM c GROUP BY 1),
s AS (SELECT count(*) AS n, avg((p - y) * (p - y)) AS brier, avg(y) * (1 - avg(y)) AS base FROM c), e AS (SELECT sum(n * abs(mp - r)) / sum(n) AS ece FROM b)
SELECT n, round(brier, 8) AS brier, round(1 - brier / base, 8) AS skill, round(ece, 8) AS ece, CASE WHEN n >= 60 AND ece <= 0.15 AND 1 - brier / base > 0 THEN 'PROMOTE' ELSE 'HOLD' END AS verdict FROM s, e""")
def q_calibration_gate(t):
    rows = t.lineitem.select(F.least(F.lit(1.0), F.col("l_discount") * 10).alias("p"), F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("y"))
    return O.calibration_gate(rows, "p", "y").select("n", *(F.round(c, 8).alias(c) for c in ("brier", "skill", "ece")), "verdict")


@query("""
WITH r AS (SELECT l_quantity AS s, l_returnflag = 'R' AS y, rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS rk FROM lineitem), a AS (SELECT count(*) FILTER (WHERE y) AS pos, count(*) FILTER (WHERE NOT y) AS neg, sum(rk) FILTER (WHERE y) AS rs FROM r)
SELECT round((rs - pos * (pos + 1) / 2.0) / (pos * neg), 8)::DOUBLE AS auc, pos, neg FROM a""")
def q_pair_auc(t):
    rows = t.lineitem.select(F.col("l_quantity").alias("s"), (F.col("l_returnflag") == "R").cast("int").alias("y"))
    return O.pair_auc(rows, "s", "y").select(F.round("auc", 8).alias("auc"), "pos", "neg")


@query("""
WITH o AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), r AS (SELECT rank() OVER (ORDER BY c_acctbal) + (count(*) OVER (PARTITION BY c_acctbal) - 1) / 2.0 AS a, rank() OVER (ORDER BY n) + (count(*) OVER (PARTITION BY n) - 1) / 2.0 AS b FROM customer JOIN o ON o_custkey = c_custkey)
SELECT round(corr(a, b), 8) AS rho, count(*) AS n FROM r""")
def q_spearman(t):
    n = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"))
    return O.spearman(t.customer.join(n, "c_custkey"), "c_acctbal", "n_orders").select(F.round("rho", 8).alias("rho"), "n")


@query("""
WITH v AS (SELECT c_nationkey AS k, avg(c_acctbal) AS x FROM customer GROUP BY 1), z AS (SELECT k, x - avg(x) OVER () AS z FROM v), e AS (SELECT a.n_nationkey AS a, b.n_nationkey AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey <> b.n_nationkey),
l AS (SELECT e.a, avg(z.z) AS lag FROM e JOIN z ON z.k = e.b GROUP BY 1) SELECT round(sum(z.z * l.lag) / sum(z.z * z.z), 6) AS morans_i, count(*) AS n FROM z JOIN l ON l.a = z.k""")
def q_morans_i(t):
    from cairn.plans.joins import edges

    v = t.customer.groupBy(F.col("c_nationkey").alias("k")).agg(F.avg("c_acctbal").alias("x"))
    return O.morans_i(v, edges(t), "k", "x").select(F.round("morans_i", 6).alias("morans_i"), "n")


CASES = {"base": "8000, 0.05", "rate:low": "8000, 0.03", "rate:high": "8000, 0.08", "scale:low": "6000, 0.05", "scale:high": "9000, 0.05"}


@query(" UNION ALL ".join(f"SELECT p_type, '{n}' AS \"case\", round(count(*) * {v.split(', ')[0]} * (1 - 1 / power(1 + {v.split(', ')[1]}, 3)), 6)::DOUBLE AS value FROM part GROUP BY 1" for n, v in CASES.items()))
def q_param_grid(t):
    n = t.part.groupBy("p_type").agg(F.count("*").alias("n"))
    cost = lambda p: F.round(F.col("n") * p["scale"] * (1 - 1 / F.pow(F.lit(1 + p["rate"]), F.lit(3))), 6)
    return O.sensitivity(n, cost, {"scale": 8000.0, "rate": 0.05}, {"rate": (0.03, 0.08), "scale": (6000.0, 9000.0)}).select("p_type", "case", "value")


@query("SELECT c_custkey, round(n / (n + 5.0) * rate + (1 - n / (n + 5.0)) * 0.5, 6)::DOUBLE AS shrunk FROM (SELECT o_custkey AS c_custkey, count(*) AS n, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS rate FROM orders GROUP BY 1)")
def q_shrinkage(t):
    r = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)).alias("rate"))
    return r.select("c_custkey", F.round(O.shrink(F.col("rate"), F.lit(0.5), F.col("n"), 5.0), 6).alias("shrunk"))
