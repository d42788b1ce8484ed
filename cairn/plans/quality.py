"""Profiles, gates, quarantine, routing and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.operators import quality as O
from cairn.plans.base import query

FILLS = "SELECT '{c}' AS \"column\", count(*) AS n_rows, count(nullif(trim({e}), '')) AS n_filled FROM orders"
BEFORE = " UNION ALL ".join(FILLS.format(c=c, e=e) for c, e in (("status", "CASE WHEN o_orderkey % 3 = 0 THEN '  ' ELSE o_orderstatus END"), ("priority", "o_orderpriority"), ("note", "CASE WHEN o_orderkey % 50 = 0 THEN 'x' END")))
AFTER = " UNION ALL ".join(FILLS.format(c=c, e=e) + " WHERE o_orderkey % 2 = 0" for c, e in (("status", "CASE WHEN o_orderkey % 3 > 0 THEN '' ELSE o_orderstatus END"), ("priority", "o_orderpriority")))


def editions(t):
    k = F.col("o_orderkey")
    before = t.orders.select(F.when(k % 3 == 0, "  ").otherwise(F.col("o_orderstatus")).alias("status"), F.col("o_orderpriority").alias("priority"), F.when(k % 50 == 0, "x").alias("note"))
    after = t.orders.where(k % 2 == 0).select(F.when(k % 3 > 0, "").otherwise(F.col("o_orderstatus")).alias("status"), F.col("o_orderpriority").alias("priority"))
    return before, after


@query(BEFORE)
def q_fill_profile(t):
    return O.fill_profile(editions(t)[0], ["status", "priority", "note"])


@query(f"""
WITH b AS ({BEFORE}), a AS ({AFTER}) SELECT b."column", b.n_filled AS before, a.n_filled AS after, b.n_filled >= 20 AND coalesce(a.n_filled / a.n_rows, 0) < b.n_filled / b.n_rows * 0.8 AS collapsed FROM b LEFT JOIN a USING ("column")""")
def q_fill_collapse(t):
    before, after = editions(t)
    return O.fill_collapse(O.fill_profile(before, before.columns), O.fill_profile(after, after.columns)).select("column", "before", "after", "collapsed")


@query("""
SELECT 'l_quantity' AS "column", count(*) FILTER (WHERE l_quantity < 5) AS below, count(*) FILTER (WHERE l_quantity > 45) AS above, count(*) FILTER (WHERE l_quantity <> floor(l_quantity)) AS fractional, count(*) FILTER (WHERE l_quantity IS NULL) AS nulls FROM lineitem
UNION ALL SELECT 'l_discount', count(*) FILTER (WHERE l_discount < 0.01), count(*) FILTER (WHERE l_discount > 0.08), 0, count(*) FILTER (WHERE l_discount IS NULL) FROM lineitem""")
def q_qc_bounds(t):
    return O.bounds_problems(t.lineitem, {"l_quantity": (5, 45, True), "l_discount": (0.01, 0.08, False)})


@query("""
WITH q AS (SELECT o_orderkey, list_filter([CASE WHEN o_totalprice > 400000 THEN 'HIGH:PRICE_HIGH' END, CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'LOW:STATUS_VOCAB' END, CASE WHEN o_orderdate >= TIMESTAMP '2001-01-01' THEN 'MEDIUM:DATE_LATE' END, CASE WHEN o_totalprice < 1500 THEN 'CRITICAL:PRICE_LOW' END], lambda x: x IS NOT NULL) AS issues FROM orders)
SELECT o_orderkey, array_to_string(issues, ',') AS issues, len(list_filter(issues, lambda x: x LIKE 'HIGH:%' OR x LIKE 'CRITICAL:%')) > 0 AS blocked FROM q""")
def q_qc_quarantine(t):
    rules = [("PRICE_HIGH", "HIGH", F.col("o_totalprice") > 400000), ("STATUS_VOCAB", "LOW", ~F.col("o_orderstatus").isin("F", "O")), ("DATE_LATE", "MEDIUM", F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")), ("PRICE_LOW", "CRITICAL", F.col("o_totalprice") < 1500)]
    return O.quarantine(t.orders, rules).select("o_orderkey", F.array_join("issues", ",").alias("issues"), "blocked")


@query("""
WITH h AS (SELECT CASE WHEN l_quantity < 3 THEN 'too_small' WHEN l_returnflag = 'R' THEN 'returned' WHEN l_shipdate < o_orderdate THEN 'ships_before_order' END AS reason FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT coalesce(reason, 'kept') AS route, count(*) AS n FROM h GROUP BY 1""")
def q_hold_route(t):
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    reason = O.first_reason([("too_small", F.col("l_quantity") < 3), ("returned", F.col("l_returnflag") == "R"), ("ships_before_order", F.col("l_shipdate") < F.col("o_orderdate"))], "kept")
    return j.groupBy(reason.alias("route")).agg(F.count("*").alias("n"))


@query("""
WITH l AS (SELECT c_nationkey AS nation, count(DISTINCT l_orderkey) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey WHERE l_returnflag <> 'R' GROUP BY 1), o AS (SELECT c_nationkey AS nation, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1)
SELECT nation, coalesce(l.n, 0) AS extracted, coalesce(o.n, 0) AS reported, CASE WHEN coalesce(o.n, 0) = 0 THEN coalesce(l.n, 0) > 0 ELSE abs(coalesce(l.n, 0) - o.n) > o.n * 0.02 END AS gap FROM l FULL JOIN o USING (nation)""")
def q_reconcile_counts(t):
    owners = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("c_nationkey").alias("nation"))
    shipped = t.lineitem.where("l_returnflag <> 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    mine = owners.join(shipped, "o_orderkey", "left_semi").groupBy("nation").agg(F.count("*").alias("n"))
    return O.reconcile_counts(mine, owners.groupBy("nation").agg(F.count("*").alias("n")), "nation", "n")


@query("""
WITH r AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'Good ' ELSE 'bad' END AS a, CASE WHEN doc_id % 9 = 0 THEN NULL WHEN toxic = 1 AND quality = 1 THEN 'bad' WHEN quality = 1 THEN 'good' ELSE 'bad' END AS b FROM labels)
SELECT CASE WHEN b IS NULL THEN 'not_read' WHEN a = b THEN 'equal' WHEN lower(trim(a)) = b THEN 'format_only' ELSE 'disputed' END AS outcome, count(*) AS n FROM r GROUP BY 1""")
def q_two_readers(t):
    a = F.when(F.col("quality") == 1, "Good ").otherwise("bad")
    b = F.when(F.col("doc_id") % 9 == 0, None).when((F.col("toxic") == 1) & (F.col("quality") == 1), "bad").when(F.col("quality") == 1, "good").otherwise("bad")
    return t.labels.groupBy(O.agreement(a, b).alias("outcome")).agg(F.count("*").alias("n"))


@query("""
WITH s AS (SELECT n_nationkey AS k, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS customers, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey AND c_acctbal < 0) AS debtors, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal > 4000) AS rich FROM nation)
SELECT k, CASE WHEN customers = 0 THEN 'unknown' WHEN debtors > 8 AND rich > 2 THEN 'contested' WHEN debtors > 8 THEN 'weak' WHEN rich > 2 THEN 'strong' ELSE 'ordinary' END AS category FROM s""")
def q_typology(t):
    c = t.customer.groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("customers"), F.count_if(F.col("c_acctbal") < 0).alias("debtors"))
    s = t.supplier.groupBy(F.col("s_nationkey").alias("k")).agg(F.count_if(F.col("s_acctbal") > 4000).alias("rich"))
    j = t.nation.select(F.col("n_nationkey").alias("k")).join(c, "k", "left").join(s, "k", "left").na.fill(0)
    weak, strong = F.col("debtors") > 8, F.col("rich") > 2
    return j.select("k", O.first_reason([("unknown", F.col("customers") == 0), ("contested", weak & strong), ("weak", weak), ("strong", strong)], "ordinary").alias("category"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'pending' WHEN o_totalprice < 50000 THEN 'too_small' WHEN o_orderdate >= TIMESTAMP '2001-06-01' THEN 'too_recent' END AS withheld,
  CASE WHEN o_orderstatus <> 'P' AND o_totalprice >= 50000 AND o_orderdate < TIMESTAMP '2001-06-01' THEN date_diff('day', o_orderdate::DATE, DATE '2002-01-01') END AS span_days FROM orders""")
def q_ledger_withhold(t):
    reason = O.first_reason([("pending", F.col("o_orderstatus") == "P"), ("too_small", F.col("o_totalprice") < 50000), ("too_recent", F.col("o_orderdate") >= F.lit("2001-06-01").cast("timestamp_ntz"))])
    days = F.date_diff(F.lit("2002-01-01").cast("date"), F.col("o_orderdate").cast("date")).cast("long")
    return t.orders.select("o_orderkey", reason.alias("withheld"), F.when(reason.isNull(), days).alias("span_days"))


@query("SELECT c_nationkey AS k, count(*) + CASE WHEN c_nationkey % 6 = 0 THEN 1 ELSE 0 END AS computed, count(*) AS published FROM customer WHERE c_nationkey % 6 = 0 GROUP BY 1")
def q_parity_gate(t):
    published = t.customer.groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n"))
    computed = published.withColumn("n", F.col("n") + F.when(F.col("k") % 6 == 0, 1).otherwise(0))
    return O.parity(computed, published, "k", "n")
