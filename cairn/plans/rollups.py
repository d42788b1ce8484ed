"""Rollups, star summaries and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.operators import rollup as R
from cairn.operators.sets import record_places, tagged_union
from cairn.plans.base import money, query

M = "CAST(sum(CAST({} AS DECIMAL(18,4))) AS DOUBLE)".format


@query("""
SELECT l_orderkey, max(l_quantity) AS max_quantity, min(l_shipdate)::DATE AS first_ship, list_sort(list_distinct(list(l_returnflag))) AS flags,
  CASE max(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END) WHEN 1 THEN 'A' WHEN 2 THEN 'N' ELSE 'R' END AS weakest_flag,
  max(l_quantity) >= 40 AS is_severe, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey""")
def q_instrument_rollup(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.max("l_quantity").alias("max_quantity"), F.min("l_shipdate").cast("date").alias("first_ship"), R.sorted_set(F.col("l_returnflag")).alias("flags"), R.weakest(F.col("l_returnflag"), ("A", "N", "R")).alias("weakest_flag"), (F.max("l_quantity") >= 40).alias("is_severe"), F.count("*").alias("n_rows"))


@query("""
WITH u AS (SELECT 'order' AS source, o_orderstatus AS status, o_custkey AS cust, o_totalprice > 200000 AS large FROM orders
  UNION ALL SELECT 'line', l_linestatus, l_suppkey, l_quantity >= 40 FROM lineitem)
SELECT source, status, count(*) AS n, count(*) FILTER (WHERE large) AS n_large, count(DISTINCT cust) AS n_parties, count(DISTINCT cust) FILTER (WHERE large) AS n_large_parties FROM u GROUP BY ALL""")
def q_headline_by_class(t):
    orders = t.orders.select(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("cust"), (F.col("o_totalprice") > 200000).alias("large"))
    lines = t.lineitem.select(F.col("l_linestatus").alias("status"), F.col("l_suppkey").alias("cust"), (F.col("l_quantity") >= 40).alias("large"))
    u = tagged_union({"order": orders, "line": lines}, "source")
    return u.groupBy("source", "status").agg(F.count("*").alias("n"), F.count_if("large").alias("n_large"), F.count_distinct("cust").alias("n_parties"), F.count_distinct(F.when(F.col("large"), F.col("cust"))).alias("n_large_parties"))


SPINE = f"""
SELECT n.n_nationkey, n.n_name, n.n_regionkey, coalesce(c.n_customers, 0) AS n_customers, coalesce(c.n_debtors, 0) AS n_debtors, coalesce(s.n_suppliers, 0) AS n_suppliers,
  s.max_balance, coalesce(o.n_orders, 0) AS n_orders, o.revenue,
  CASE WHEN coalesce(o.n_open, 0) > 0 THEN 'has_records' WHEN coalesce(c.n_customers, 0) > 0 THEN 'checked_none' ELSE 'not_examined' END AS coverage
FROM nation n LEFT JOIN (SELECT c_nationkey, count(*) AS n_customers, count(*) FILTER (WHERE c_acctbal < 0) AS n_debtors FROM customer GROUP BY 1) c ON c.c_nationkey = n.n_nationkey
LEFT JOIN (SELECT s_nationkey, count(*) AS n_suppliers, max(s_acctbal) AS max_balance FROM supplier GROUP BY 1) s ON s.s_nationkey = n.n_nationkey
LEFT JOIN (SELECT c_nationkey, count(*) AS n_orders, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_open, {M('o_totalprice')} AS revenue FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1) o ON o.c_nationkey = n.n_nationkey"""


@query(SPINE)
def q_spine_summary(t):
    """Pre-aggregated sides onto a small spine; the one large join is orders to customers on their key."""
    customers = t.customer.groupBy("c_nationkey").agg(F.count("*").alias("n_customers"), F.count_if(F.col("c_acctbal") < 0).alias("n_debtors"))
    suppliers = t.supplier.groupBy("s_nationkey").agg(F.count("*").alias("n_suppliers"), F.max("s_acctbal").alias("max_balance"))
    per_customer = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "O").alias("open"), F.sum(F.col("o_totalprice").cast("decimal(18,4)")).alias("price"))
    orders = per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("o_nationkey")).agg(F.sum("n").alias("n_orders"), F.sum("open").alias("n_open"), F.sum("price").cast("double").alias("revenue"))
    s = t.nation.join(customers, F.col("n_nationkey") == F.col("c_nationkey"), "left").join(suppliers, F.col("n_nationkey") == F.col("s_nationkey"), "left").join(orders, F.col("n_nationkey") == F.col("o_nationkey"), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    coverage = F.when(F.coalesce("n_open", F.lit(0)) > 0, "has_records").when(F.coalesce("n_customers", F.lit(0)) > 0, "checked_none").otherwise("not_examined")
    return s.select("n_nationkey", "n_name", "n_regionkey", zero("n_customers"), zero("n_debtors"), zero("n_suppliers"), "max_balance", zero("n_orders"), "revenue", coverage.alias("coverage"))


@query(f"""
WITH s AS ({SPINE}) SELECT r_name, count(s.n_nationkey) AS n_nations, CAST(coalesce(sum(n_orders), 0) AS BIGINT) AS n_orders, count(*) FILTER (WHERE coverage = 'has_records') AS n_with_records, max(max_balance) AS max_balance
FROM region LEFT JOIN s ON s.n_regionkey = r_regionkey GROUP BY r_name""")
def q_state_summary(t):
    s = q_spine_summary(t)
    return t.region.join(s, F.col("r_regionkey") == F.col("n_regionkey"), "left").groupBy("r_name").agg(F.count("n_nationkey").alias("n_nations"), F.coalesce(F.sum("n_orders"), F.lit(0)).alias("n_orders"), F.count_if(F.col("coverage") == "has_records").alias("n_with_records"), F.max("max_balance").alias("max_balance"))


@query("""
SELECT (SELECT count(*) FROM documents) AS universe, (SELECT count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)) AS with_records,
  (SELECT count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) AS examined, (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS with_neither""")
def q_coverage_totals(t):
    """A4: one aggregate over flags in place of four subqueries."""
    flags = t.labels.groupBy("doc_id").agg(F.max(F.col("toxic") == 1).alias("record"))
    u = t.documents.select("doc_id").join(flags, "doc_id", "left")
    return u.agg(F.count("*").alias("universe"), F.count_if("record").alias("with_records"), F.count("record").alias("examined"), F.count_if(F.col("record").isNull()).alias("with_neither"))


@query("""
SELECT source, CASE WHEN toxic = 1 THEN 'has_records' WHEN l.doc_id IS NOT NULL THEN 'checked_none' ELSE 'not_examined' END AS coverage, count(*) AS n
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY ALL""")
def q_coverage_status(t):
    j = t.documents.select("doc_id", "source").join(t.labels.withColumn("seen", F.lit(True)), "doc_id", "left")
    return j.groupBy("source", F.when(F.col("toxic") == 1, "has_records").when(F.col("seen"), "checked_none").otherwise("not_examined").alias("coverage")).agg(F.count("*").alias("n"))


@query("""
WITH r AS (SELECT p_partkey, p_brand, concat(p_type, ';', p_brand, '; ;', p_type) AS places FROM part),
x AS (SELECT p_partkey, p_brand, trim(unnest(string_split(places, ';'))) AS place FROM r)
SELECT p_partkey, place, bool_or(place = p_brand) AS is_primary FROM x WHERE place IN (SELECT DISTINCT p_brand FROM part WHERE p_size > 10) GROUP BY ALL""")
def q_record_county_explode(t):
    from cairn.functions.scalars import split_list

    records = t.part.select("p_partkey", "p_brand", split_list(F.concat("p_type", F.lit(";"), "p_brand", F.lit("; ;"), "p_type")).alias("places"))
    valid = t.part.where("p_size > 10").select(F.col("p_brand").alias("place")).distinct()
    return record_places(records, "p_partkey", "places", "p_brand", valid, "place")


@query("""
WITH u AS (SELECT o_custkey AS party, 'order' AS role, o_orderpriority AS ref, o_orderdate AS d FROM orders UNION ALL SELECT l_suppkey, 'line', nullif(l_returnflag, 'N'), l_shipdate FROM lineitem
  UNION ALL SELECT c_custkey, 'customer', c_mktsegment, NULL FROM customer)
SELECT party, role, ref, count(*) AS n, max(d)::DATE AS latest FROM u WHERE ref IS NOT NULL GROUP BY ALL""")
def q_evidence_links(t):
    orders = t.orders.select(F.col("o_custkey").alias("party"), F.col("o_orderpriority").alias("ref"), F.col("o_orderdate").alias("d"))
    lines = t.lineitem.select(F.col("l_suppkey").alias("party"), F.nullif("l_returnflag", F.lit("N")).alias("ref"), F.col("l_shipdate").alias("d"))
    customers = t.customer.select(F.col("c_custkey").alias("party"), F.col("c_mktsegment").alias("ref"))
    u = tagged_union({"order": orders, "line": lines, "customer": customers}, "role").where("ref IS NOT NULL")
    return u.groupBy("party", "role", "ref").agg(F.count("*").alias("n"), F.max("d").cast("date").alias("latest"))


@query("""
SELECT o_custkey, CASE WHEN count(DISTINCT o_orderpriority) = 1 THEN min(o_orderpriority) END AS only_priority,
  (SELECT o2.o_orderstatus FROM orders o2 WHERE o2.o_custkey = o.o_custkey GROUP BY o2.o_orderstatus ORDER BY count(*) DESC, o2.o_orderstatus LIMIT 1) AS usual_status
FROM orders o GROUP BY o_custkey""")
def q_unanimous_and_mode(t):
    only = t.orders.groupBy("o_custkey").agg(R.unanimous(F.col("o_orderpriority")).alias("only_priority"))
    return only.join(R.mode_by(t.orders, ["o_custkey"], "o_orderstatus", "usual_status"), "o_custkey")


@query("SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS latest_priority, max(o_orderdate)::DATE AS latest FROM orders GROUP BY o_custkey")
def q_argmax_latest(t):
    return t.orders.groupBy("o_custkey").agg(R.latest(F.col("o_orderpriority"), F.col("o_orderdate"), F.col("o_orderkey")).alias("latest_priority"), F.max("o_orderdate").cast("date").alias("latest"))


@query("""
SELECT o_orderkey, coalesce(list(l_partkey ORDER BY l_partkey) FILTER (WHERE l_partkey IS NOT NULL), []) AS parts,
  coalesce(string_agg(DISTINCT l_returnflag, '; ' ORDER BY l_returnflag), '') AS flags FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def q_ordered_lists(t):
    j = t.orders.select("o_orderkey").join(t.lineitem.select("l_orderkey", "l_partkey", "l_returnflag"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return j.groupBy("o_orderkey").agg(R.sorted_list(F.col("l_partkey")).alias("parts"), F.array_join(R.sorted_set(F.col("l_returnflag")), "; ").alias("flags"))


@query("SELECT o_orderkey, (SELECT first(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey) FROM lineitem WHERE l_orderkey = o_orderkey) AS first_part FROM orders")
def q_correlated_first(t):
    first = t.lineitem.groupBy("l_orderkey").agg(F.min_by("l_partkey", F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("first_part"))
    return t.orders.select("o_orderkey").join(first, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", "first_part")


@query("SELECT CASE WHEN o_orderkey % 7 > 0 THEN date_trunc('month', o_orderdate)::DATE END AS month, count(*) AS n, count(DISTINCT o_custkey) AS n_customers FROM orders GROUP BY 1")
def q_cohort_month(t):
    month = F.when(F.col("o_orderkey") % 7 > 0, F.trunc("o_orderdate", "month"))
    return t.orders.groupBy(month.alias("month")).agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("n_customers"))


@query("""
WITH x AS (SELECT CASE WHEN l_returnflag = 'R' THEN year(l_shipdate) END AS a, CASE WHEN o_orderkey % 2 = 0 THEN year(o_orderdate) END AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT coalesce(a, b) AS year, CASE WHEN a IS NOT NULL THEN 'ship' WHEN b IS NOT NULL THEN 'order' ELSE 'none' END AS basis, count(*) AS n FROM x GROUP BY ALL""")
def q_year_basis(t):
    a, b = F.when(F.col("l_returnflag") == "R", F.year("l_shipdate")), F.when(F.col("o_orderkey") % 2 == 0, F.year("o_orderdate"))
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return j.groupBy(F.coalesce("a", "b").alias("year"), F.when(F.col("a").isNotNull(), "ship").when(F.col("b").isNotNull(), "order").otherwise("none").alias("basis")).agg(F.count("*").alias("n"))


@query(f"""
WITH s AS (SELECT n_regionkey AS region, n_name, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey), n AS (SELECT region, n_name, avg(CASE WHEN c_acctbal < 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS rate FROM s GROUP BY ALL)
SELECT n_name, round((sum(rate) OVER (PARTITION BY region) - rate) / nullif(count(*) OVER (PARTITION BY region) - 1, 0), 6) AS loo FROM n""")
def q_loo_share(t):
    rates = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_regionkey", "n_name").agg(F.avg(F.when(F.col("c_acctbal") < 0, 1.0).otherwise(0.0)).alias("rate"))
    return R.leave_one_out(rates, "n_regionkey", F.col("rate"), "loo").select("n_name", F.round("loo", 6).alias("loo"))


@query("""
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderdate < DATE '2001-06-01') AS n_old,
  round_even(count(*) FILTER (WHERE o_orderdate < DATE '2001-06-01' AND o_orderstatus = 'F') / nullif(count(*) FILTER (WHERE o_orderdate < DATE '2001-06-01' AND o_orderstatus IN ('F', 'O')), 0), 3) AS decided_rate FROM orders GROUP BY 1""")
def q_decided_rate(t):
    old = F.col("o_orderdate") < F.lit("2001-06-01").cast("date")
    decided, all_ = F.count_if(old & (F.col("o_orderstatus") == "F")), F.count_if(old & F.col("o_orderstatus").isin("F", "O"))
    return t.orders.groupBy("o_orderpriority").agg(F.count_if(old).alias("n_old"), R.share(decided, all_).alias("decided_rate"))


YEARLY = f"SELECT c_nationkey AS nation, year(o_orderdate) AS year, {M('o_totalprice')} AS revenue FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) <> 1997 GROUP BY ALL"


@query(f"WITH y AS ({YEARLY}) SELECT y.nation, y.year, y.revenue, round(y.revenue / nullif(b.revenue, 0) - 1, 5) AS growth FROM y LEFT JOIN y b ON b.nation = y.nation AND b.year = y.year - 2")
def q_growth_n(t):
    j = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).withColumn("year", F.year("o_orderdate").cast("long")).where("year <> 1997")
    yearly = j.groupBy(F.col("c_nationkey").alias("nation"), "year").agg(money("o_totalprice").alias("revenue"))
    return R.growth(yearly, "nation", "year", "revenue", 2)


@query("""
WITH c AS (SELECT p_brand, p_size % 3 AS k, count(*) AS n FROM part GROUP BY ALL), t AS (SELECT p_brand, sum(n) AS total FROM c GROUP BY 1)
SELECT t.p_brand, v.kind, round(coalesce(c.n, 0) / t.total, 6) AS share FROM t CROSS JOIN (VALUES ('k0', 0), ('k1', 1), ('k2', 2)) v(kind, k) LEFT JOIN c ON c.p_brand = t.p_brand AND c.k = v.k""")
def q_unpivot_pivot(t):
    kinds = ("k0", "k1", "k2")
    wide = R.pivot_shares(t.part.withColumn("kind", F.concat(F.lit("k"), (F.col("p_size") % 3).cast("string"))), "p_brand", "kind", kinds, F.lit(1))
    return R.unpivot(wide, "p_brand", kinds, "kind", "share")


@query("""
SELECT l_orderkey, coalesce(sum(CASE WHEN l_linenumber = 1 THEN CAST(l_quantity AS BIGINT) END), sum(CAST(l_quantity AS BIGINT)))::BIGINT AS quantity FROM lineitem GROUP BY 1""")
def q_total_preferred(t):
    lines = t.lineitem.select("l_orderkey", F.when(F.col("l_linenumber") == 1, "TOTAL").otherwise("part").alias("mode"), F.round("l_quantity").cast("long").alias("q"))
    return R.pick_total(lines, ["l_orderkey"], "mode", "TOTAL", "q", "quantity")
