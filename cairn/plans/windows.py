"""Ranks, percentiles, deciles, waves, samples, changes."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from cairn.operators import windows as O
from cairn.plans.base import money, query


@query("""
SELECT c_custkey, rank() OVER (ORDER BY c_acctbal DESC) AS rank_all, rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS rank_nation,
  round(100 * (rank() OVER (ORDER BY c_acctbal) - 1 + 0.5 * count(*) OVER (PARTITION BY c_acctbal)) / count(*) OVER (), 1)::DOUBLE AS pct FROM customer""")
def q_rank_pct(t):
    from pyspark.sql import Window as W

    ranked = O.midrank_percentile(O.competition_rank(t.customer, "c_acctbal"), "c_acctbal")
    nation = F.rank().over(W.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"))).cast("long")
    return ranked.select("c_custkey", F.col("rank_all").cast("long").alias("rank_all"), nation.alias("rank_nation"), F.col("pct").cast("double").alias("pct"))


@query("""
WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS rn, count(*) OVER () AS n FROM customer), d AS (SELECT c_custkey, CAST(least(10, 1 + floor(10 * (rn - 1) / n)) AS INTEGER) AS decile FROM r),
v AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS value FROM orders GROUP BY 1)
SELECT decile, count(*) AS n, CAST(sum(CAST(coalesce(value, 0) AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS mean_value FROM d LEFT JOIN v ON o_custkey = c_custkey GROUP BY 1""")
def q_decile_prior(t):
    ranked = O.deciles(t.customer.select("c_custkey", "c_acctbal"), [F.col("c_acctbal"), F.col("c_custkey")]).select("c_custkey", "decile")
    value = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(money("o_totalprice").alias("value"))
    return ranked.join(value, "c_custkey", "left").groupBy("decile").agg(F.count("*").alias("n"), (money(F.coalesce("value", F.lit(0.0))) / F.count("*")).alias("mean_value"))


BLOM = ", ".join(f"({i}, {round(NormalDist().inv_cdf((i - 0.375) / 25.25), 3) + 0.0}::DOUBLE)" for i in range(1, 26))


@query(f"""
WITH v AS (SELECT s_nationkey AS k, count(*) // 5 AS n FROM supplier GROUP BY 1), r AS (SELECT n_nationkey, row_number() OVER (ORDER BY coalesce(n, 0), n_regionkey, n_nationkey) AS rn FROM nation LEFT JOIN v ON k = n_nationkey), b(rn, normal) AS (VALUES {BLOM})
SELECT n_nationkey, normal, CAST(1 + (10 * (rn - 1)) // 25 AS INTEGER) AS decile FROM r JOIN b USING (rn)""")
def q_normal_scores(t):
    """W4 over the 25 nations: the oracle's scores are literal values."""
    n = t.supplier.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.floor(F.count("*") / 5).alias("n"))
    rows = t.nation.join(n, "n_nationkey", "left").select("n_nationkey", "n_regionkey", F.coalesce("n", F.lit(0)).alias("n"))
    return O.normal_scores(rows, [F.col("n"), F.col("n_regionkey"), F.col("n_nationkey")]).select("n_nationkey", "normal", "decile")


@query("""
WITH x AS (SELECT *, lag(o_orderstatus) OVER w AS before, row_number() OVER w AS rn FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
SELECT o_custkey, o_orderkey, o_orderstatus FROM x WHERE rn = 1 OR before <> o_orderstatus""")
def q_change_only(t):
    return O.changes_only(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderstatus"]).select("o_custkey", "o_orderkey", "o_orderstatus")


@query("""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS price FROM orders ORDER BY price DESC NULLS LAST, o_orderkey LIMIT 50)
SELECT o_orderkey, price, CAST(row_number() OVER (ORDER BY price DESC NULLS LAST, o_orderkey) AS INTEGER) AS position, CAST((row_number() OVER (ORDER BY price DESC NULLS LAST, o_orderkey) - 1) // 8 + 1 AS INTEGER) AS wave FROM o""")
def q_waves_topk(t):
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_totalprice")).alias("price"))
    return O.top_waves(rows, [F.desc_nulls_last("price"), F.asc("o_orderkey")], 50, 8)


@query("SELECT c_custkey, c_name FROM customer ORDER BY sha256(concat('seed-1', c_custkey::VARCHAR)) LIMIT 40")
def q_sample_hash(t):
    return O.hash_sample(t.customer.select("c_custkey", "c_name"), "c_custkey", "seed-1", 40)


@query("""
WITH recent AS (SELECT DISTINCT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-30 18:00:00'), r AS (SELECT event_id, event_type, user_id, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rn FROM events WHERE user_id NOT IN (SELECT user_id FROM recent))
SELECT event_id, event_type, user_id, CAST(rn AS INTEGER) AS position FROM r WHERE rn <= 5""")
def q_pick_batch(t):
    recent = t.events.where("ts >= TIMESTAMP_NTZ '2024-01-30 18:00:00'").select("user_id").distinct()
    return O.quota(t.events, "event_type", [F.desc("value"), F.asc("event_id")], 5, recent, "user_id").select("event_id", "event_type", "user_id", "position")


@query("""
SELECT o_orderkey, CAST(row_number() OVER (ORDER BY CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 WHEN 'F' THEN 3 ELSE 4 END, o_totalprice DESC, o_orderkey) AS INTEGER) AS priority FROM orders WHERE o_orderpriority = '1-URGENT' OR o_totalprice > 400000""")
def q_worklist_priority(t):
    rows = t.orders.where("o_orderpriority = '1-URGENT' OR o_totalprice > 400000")
    return O.dense_priority(rows, [O.enum_order(F.col("o_orderstatus"), ("P", "O", "F")), F.desc("o_totalprice"), F.asc("o_orderkey")]).select("o_orderkey", "priority")


@query("""
SELECT c_custkey, CASE WHEN last >= DATE '2001-01-01' THEN 'within_12' WHEN last >= DATE '2000-01-01' THEN 'within_24' WHEN last IS NOT NULL THEN 'older' ELSE 'undated' END AS bucket
FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate)::DATE AS last FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def q_age_buckets(t):
    from cairn.functions.scalars import months_before

    as_of = F.lit("2002-01-01").cast("date")
    last = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").cast("date").alias("last"))
    bucket = F.when(F.col("last") >= months_before(as_of, 12), "within_12").when(F.col("last") >= months_before(as_of, 24), "within_24").when(F.col("last").isNotNull(), "older").otherwise("undated")
    return t.customer.join(last, "c_custkey", "left").select("c_custkey", bucket.alias("bucket"))


@query("SELECT date_trunc('hour', ts)::VARCHAR AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def q_event_windows(t):
    """An extension, not reference parity: tumbling windows over events, as a batch."""
    counted = t.events.groupBy(F.window(F.col("ts").cast("timestamp"), "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return counted.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n")
