"""The record score of customers as places, their orders as instruments and projects, beside the rubric in SQL."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cairn.operators.record_score import record_scores
from cairn.plans.base import query
from cairn.plans.rules import listed, pick

LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
TECHNOLOGIES = ("solar", "wind", "battery_storage")
CURRENCY = ("in_force", "unknown", "pending", "lapsed_unconfirmed", "")
OUTCOMES = ("blocked_confirmed", "blocked_unverified", "restricted_conditional", "advanced_confirmed", "advanced_unverified", "pending")


def severity(x: str) -> str:
    return f"CASE {x} WHEN 4 THEN 60.0 WHEN 3 THEN 35.0 WHEN 2 THEN 12.0 WHEN 1 THEN 3.0 ELSE 0.0 END::DOUBLE"


def strength(x: str) -> str:
    return f"CASE {x} WHEN 'in_force' THEN 1.0 WHEN 'unknown' THEN 0.6 WHEN 'pending' THEN 0.3 WHEN 'lapsed_unconfirmed' THEN 0.25 ELSE 0.0 END::DOUBLE"


_WORTH = "CASE o_orderkey % 6 WHEN 0 THEN 12 WHEN 1 THEN 6 WHEN 2 THEN 3 WHEN 3 THEN -6 WHEN 4 THEN -3 ELSE 0 END"
_TERM = "CASE WHEN term = 'temporary' AND sev >= 3 THEN round(least(1.0::DOUBLE, least(0.95::DOUBLE, 0.6::DOUBLE + 0.1::DOUBLE * ext + 0.1::DOUBLE * months / 12) * CASE WHEN drafting = 'active' THEN 0.8::DOUBLE ELSE 1 END)::DECIMAL(18, 8), 4)::DOUBLE ELSE 1 END"
_WHERE = "CASE WHEN wide THEN 1.0::DOUBLE ELSE 0.35::DOUBLE END"


def _record(points: str, name: str) -> str:
    """A place's points from a table (node, id, sev, cur, wide, p)."""
    return f"""{name}_s AS (SELECT *, p * CASE WHEN row_number() OVER (PARTITION BY node ORDER BY p DESC, wide DESC) = 1 THEN 1.0::DOUBLE ELSE 0.25::DOUBLE END AS share FROM {points}),
{name}_b AS (SELECT node, least(80.0::DOUBLE, coalesce(sum(share) FILTER (WHERE wide), 0) + least(30.0::DOUBLE, coalesce(sum(share) FILTER (WHERE NOT wide), 0))) AS base, max(p) FILTER (WHERE sev = 4 AND cur = 'in_force' AND wide) AS floor FROM {name}_s GROUP BY node),
{name} AS (SELECT e.node, round(greatest(coalesce(floor, 0), coalesce(base, 0) + least(25, plus) + organized - least(20, minus, 0.5::DOUBLE * coalesce(base, 0)))::DECIMAL(18, 8), 2)::DOUBLE AS points FROM e LEFT JOIN {name}_b b ON b.node = e.node)"""


SCORE = f"""
WITH l AS (SELECT *, l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(LINE_ORDER)}) AS seq FROM lineitem),
r AS (SELECT l_orderkey AS id, seq, {listed("l_linenumber % 3", TECHNOLOGIES)} AS tech, 1 + l_quantity::INT % 4 AS sev, {listed("l_suppkey % 5", CURRENCY)} AS cur, l_returnflag = 'A' AS verified, CASE WHEN l_partkey % 9 = 0 THEN 'permanent' WHEN l_partkey % 2 = 0 THEN 'temporary' ELSE '' END AS term,
  l_linenumber % 3 AS ext, round(l_discount * 100)::DOUBLE AS months, CASE l_suppkey % 7 WHEN 0 THEN 'active' WHEN 1 THEN 'adopted' ELSE '' END AS drafting FROM l WHERE l_orderkey IN (SELECT o_orderkey FROM orders)),
i AS (SELECT id, list_sort(list(DISTINCT tech)) AS techs, max(sev) AS sev, coalesce(arg_min(cur, seq) FILTER (WHERE cur <> ''), 'unknown') AS cur, id % 3 = 0 AS wide, 'j' || id % 4 AS place, bool_or(verified) AS verified,
  CASE WHEN bool_or(term = 'permanent') THEN 'permanent' WHEN bool_or(term = 'temporary') THEN 'temporary' END AS term, max(ext) AS ext, max(months) AS months, CASE WHEN bool_or(drafting = 'adopted') THEN 'adopted' WHEN bool_or(drafting = 'active') THEN 'active' END AS drafting FROM r GROUP BY id),
c AS (SELECT c_custkey AS node, 'S' || c_nationkey AS state, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS profile, c_custkey % 2 = 0 AS checked, (c_custkey % 4)::DOUBLE AS organized FROM customer),
p AS (SELECT i.*, o_custkey AS node, state FROM i JOIN orders ON o_orderkey = id JOIN c ON c.node = o_custkey),
j AS (SELECT o_custkey AS node, sum(greatest({_WORTH}, 0))::DOUBLE AS plus, sum(greatest(-({_WORTH}), 0))::DOUBLE AS minus, bool_or(o_orderkey % 6 IN (0, 3)) AS confirmed, count(*) AS projects FROM orders GROUP BY 1),
e AS (SELECT c.*, coalesce(plus, 0) AS plus, coalesce(minus, 0) AS minus, coalesce(confirmed, false) AS confirmed, coalesce(projects, 0) AS projects FROM c LEFT JOIN j ON j.node = c.node),
lp AS (SELECT node, id, sev, cur, wide, {severity("sev")} * (1 + 0.1::DOUBLE * greatest(len(techs) - 1, 0)) * {strength("cur")} * {_WHERE} * {_TERM} AS p FROM p),
{_record("lp", "loc")},
u AS (SELECT 'S' || n_nationkey AS state, unnest(['solar', 'wind', 'battery_storage']) AS tech, unnest([2, 1, 3]) AS ceiling, unnest([true, false, false]) AS county_only, unnest([true, true, n_nationkey % 4 = 0]) AS bounds FROM nation WHERE n_nationkey % 2 = 0),
x AS (SELECT p.node, p.id, t.tech, p.sev, least(p.sev, coalesce(min(ceiling), p.sev)) AS own, coalesce(bool_or(bounds), false) AS bounded FROM p, LATERAL (SELECT unnest(p.techs) AS tech) t LEFT JOIN u ON u.state = p.state AND u.tech = t.tech AND (p.wide OR NOT county_only) GROUP BY p.node, p.id, t.tech, p.sev),
y AS (SELECT node, id, max(own) AS top, bool_or(own < sev) AS hit, bool_and(bounded) AS bounded FROM x GROUP BY node, id),
z AS (SELECT p.* EXCLUDE (sev), CASE WHEN hit THEN top ELSE sev END AS sev, hit, CASE WHEN NOT bounded THEN 'one:' || p.id WHEN wide THEN 'county' ELSE 'place:' || place END AS grp, {strength("cur")} AS w FROM p JOIN y USING (node, id)),
g AS (SELECT node, grp, count(*) AS merged, arg_max(id, (sev, w, id)) AS id, max(sev) AS sev, arg_max(cur, (w, cur)) AS cur, bool_or(wide) AS wide, arg_max(coalesce(term, ''), (sev, w, id)) AS term, arg_max(ext, (sev, w, id)) AS ext, arg_max(months, (sev, w, id)) AS months, arg_max(coalesce(drafting, ''), (sev, w, id)) AS drafting, bool_or(hit) AS hit FROM z GROUP BY node, grp),
h AS (SELECT node, grp, tech, max(own) AS own FROM z JOIN x USING (node, id) GROUP BY node, grp, tech),
k AS (SELECT node, grp, count(*) AS n, list_reverse_sort(list({severity("own")})) AS pts FROM h GROUP BY node, grp),
bp AS (SELECT node, id, sev, cur, wide, CASE WHEN merged > 1 OR hit THEN pts[1] + 0.1::DOUBLE * coalesce(list_sum(pts[2:]), 0) ELSE {severity("sev")} * (1 + 0.1::DOUBLE * greatest(n - 1, 0)) END * {strength("cur")} * {_WHERE} * {_TERM} AS p FROM g JOIN k USING (node, grp)),
{_record("bp", "rec")},
v AS (SELECT node, count(*) AS instruments, bool_or(verified) AS verified FROM p GROUP BY node),
a AS (SELECT e.*, loc.points AS local_points, rec.points AS record_points, coalesce(instruments, 0) AS instruments, coalesce(verified, false) OR confirmed AS sure FROM e JOIN loc USING (node) JOIN rec USING (node) LEFT JOIN v USING (node)),
d AS (SELECT node, CAST(least(10, 1 + (10 * (row_number() OVER (ORDER BY profile, node) - 1)) // count(*) OVER ()) AS INT) AS profile_decile FROM c WHERE profile IS NOT NULL),
m AS (SELECT profile_decile, sum(local_points::DECIMAL(18, 2))::DOUBLE / count(*) AS mean FROM a JOIN d USING (node) GROUP BY 1),
q AS (SELECT a.*, profile_decile, round(coalesce(mean, 0)::DECIMAL(18, 8), 2)::DOUBLE AS profile_points, CASE WHEN instruments + projects > 0 THEN 'record' WHEN checked THEN 'negative_check' ELSE 'profile_only' END AS basis,
  CASE WHEN instruments + projects > 0 THEN CASE WHEN sure THEN 0.9 ELSE 0.7 END WHEN checked THEN 0.5 ELSE 0 END::DOUBLE AS evidence_weight FROM a LEFT JOIN d USING (node) LEFT JOIN m USING (profile_decile)),
s AS (SELECT *, round((evidence_weight * record_points + (1 - evidence_weight) * profile_points)::DECIMAL(18, 8), 2)::DOUBLE AS combined FROM q)
SELECT node, CASE WHEN basis = 'profile_only' THEN 'no_record' WHEN combined >= 60 THEN 'prohibitive' WHEN combined >= 35 THEN 'restrictive' WHEN combined >= 15 THEN 'mixed' ELSE 'open' END AS tier, combined,
  CAST(least(10, 1 + (10 * (row_number() OVER (ORDER BY combined, coalesce(profile, -1), node) - 1)) // count(*) OVER ()) AS INT) AS combined_decile, basis, evidence_weight, record_points, local_points, round((local_points - record_points)::DECIMAL(18, 8), 2)::DOUBLE AS preemption_points, profile_decile, profile_points, instruments, projects FROM s
"""


@query(SCORE)
def q_record_scores(t):
    """Severity, currency, jurisdiction, breadth and terms, local and state caps, stacking, projects, priors, tiers and tenths."""
    at = F.row_number().over(W.partitionBy("l_orderkey").orderBy(*LINE_ORDER))
    lines = t.lineitem.withColumn("seq", F.col("l_orderkey") * 1000 + at).join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("node")), "l_orderkey")
    level = (1 + F.round("l_quantity").cast("int") % 4).cast("int")
    rows = lines.select(
        F.col("l_orderkey").alias("instrument_id"), "seq", "node", pick(F.col("l_linenumber") % 3, TECHNOLOGIES).alias("technology"), level.alias("severity"), F.concat(F.lit("t"), level).alias("restriction_type"), pick(F.col("l_suppkey") % 5, CURRENCY).alias("currency"),
        F.when(F.col("l_orderkey") % 3 == 0, "County").otherwise("Town").alias("jurisdiction_type"), F.concat(F.lit("J"), F.col("l_orderkey") % 4).alias("jurisdiction"), (F.col("l_returnflag") == "A").alias("verified"),
        F.when(F.col("l_partkey") % 9 == 0, "permanent").when(F.col("l_partkey") % 2 == 0, "temporary").otherwise("").alias("term"), (F.col("l_linenumber") % 3).cast("int").alias("extensions"), F.round(F.col("l_discount") * 100).alias("months_in_force"), F.when(F.col("l_suppkey") % 7 == 0, "active").when(F.col("l_suppkey") % 7 == 1, "adopted").otherwise("").alias("drafting"),
    )
    places = t.customer.select(F.col("c_custkey").alias("node"), F.concat(F.lit("S"), "c_nationkey").alias("state"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("profile"), (F.col("c_custkey") % 2 == 0).alias("checked"), (F.col("c_custkey") % 4).cast("double").alias("organized"))
    projects = t.orders.select(F.col("o_custkey").alias("node"), pick(F.col("o_orderkey") % 6, OUTCOMES).alias("outcome"))
    rule = lambda tech, ceiling, binds, bounds: F.struct(F.lit(tech).alias("technology"), F.lit(ceiling).alias("ceiling"), F.lit(binds).alias("binds"), bounds.alias("bounds"))
    each = F.array(rule("solar", 2, "county", F.lit(True)), rule("wind", 1, "both", F.lit(True)), rule("battery_storage", 3, "both", F.col("n_nationkey") % 4 == 0))
    rules = t.nation.where("n_nationkey % 2 = 0").select(F.concat(F.lit("S"), "n_nationkey").alias("state"), F.concat(F.lit("R"), "n_nationkey").alias("label"), F.inline(each))
    return record_scores(rows, places, projects, rules)
