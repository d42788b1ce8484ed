"""Matching, summaries and record rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.functions import scalars as S
from cairn.operators import derive as D
from cairn.operators import matching as M
from cairn.operators import summaries as A
from cairn.plans.base import query


@query()
def q_greedy_dedupe(t):
    """All events by user and by amount. No SQL: a recursion over every row is too slow; a test holds it against a loop."""
    rows = t.events.select("event_id", F.concat(F.lit("u"), F.col("user_id")).alias("u"), F.concat(F.lit("h"), F.round(F.col("value") * 100).cast("long")).alias("h"))
    return M.greedy_dedupe(rows, ["u", "h"], "event_id").select("event_id")


@query("""
WITH c AS (SELECT *, c_custkey % 7 AS tech FROM customer), n AS (SELECT * FROM c WHERE c_acctbal <= 8000), e AS (SELECT DISTINCT c_nationkey, tech, c_mktsegment FROM c WHERE c_acctbal > 8000),
j AS (SELECT n.c_custkey, bool_or(n.c_mktsegment = e.c_mktsegment) AS agree FROM n JOIN e USING (c_nationkey, tech) GROUP BY 1)
SELECT n.c_custkey, CASE WHEN agree THEN 'duplicate' WHEN agree IS NOT NULL THEN 'flagged' ELSE 'new' END AS verdict FROM n LEFT JOIN j USING (c_custkey)""")
def q_cross_source(t):
    rows = t.customer.withColumn("tech", F.col("c_custkey") % 7)
    return M.cross_source(rows.where("c_acctbal <= 8000"), rows.where("c_acctbal > 8000"), "c_nationkey", "tech", ["c_mktsegment"]).select("c_custkey", "verdict")


@query("""
SELECT p_brand AS place, count(DISTINCT p_type) AS n_instruments, count(DISTINCT p_type) FILTER (WHERE big) AS n_big FROM (SELECT p_brand, p_type, max(p_size) OVER (PARTITION BY p_brand, p_type) > 45 AS big FROM part) GROUP BY 1""")
def q_place_tally(t):
    return A.place_tally(t.part.withColumn("places", F.array("p_brand")), "p_type", "places", {"n_big": F.col("p_size") > 45})


@query("""
WITH u AS (SELECT lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS url, 'page' AS entity FROM pages UNION ALL SELECT source || '.example', 'doc' FROM documents)
SELECT url, count(*) AS n, list_sort(list_distinct(list(entity))) AS entities FROM u GROUP BY 1""")
def q_source_registry(t):
    pages = t.pages.select(F.lower(F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1)).alias("host"))
    docs = t.documents.select(F.concat("source", F.lit(".example")).alias("host"))
    return A.source_registry({"page": (pages, ["host"]), "doc": (docs, ["host"])})


@query("""
WITH s AS (SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL), m AS (SELECT l_orderkey, first(l_returnflag ORDER BY n DESC, l_returnflag) AS status FROM s GROUP BY 1)
SELECT l_orderkey, list_sort(list_distinct(list(l_linestatus))) AS technologies, sum(CAST(l_quantity AS BIGINT))::DOUBLE AS mw, count(*) AS units, min(m.status) AS status FROM lineitem JOIN m USING (l_orderkey) GROUP BY 1""")
def q_plant_rollup(t):
    units = t.lineitem.select("l_orderkey", F.col("l_linestatus").alias("technology"), F.round("l_quantity").alias("mw"), F.col("l_returnflag").alias("status"), F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"))
    return A.plants(units, "l_orderkey").select("l_orderkey", "technologies", "mw", "units", "status")


@query("""
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_size ELSE 0 END::DOUBLE + CASE WHEN p_partkey % 3 = 0 THEN 7 ELSE 0 END AS solar, CASE WHEN p_size % 2 = 1 THEN p_size ELSE 0 END::DOUBLE AS wind FROM part""")
def q_pivot_pairs(t):
    rows = t.part.select("p_partkey", F.when(F.col("p_size") % 2 == 0, "solar").otherwise("wind").alias("t1"), F.col("p_size").alias("a1"), F.when(F.col("p_partkey") % 3 == 0, "solar").alias("t2"), F.lit(7).alias("a2"))
    return A.pivot_pairs(rows, "p_partkey", [("t1", "a1"), ("t2", "a2")], ("solar", "wind"))


@query("""
WITH r AS (SELECT o_custkey, o_orderpriority AS v, min((o_orderdate, o_orderkey)) AS o FROM orders GROUP BY ALL) SELECT o_custkey, string_agg(v, '; ' ORDER BY o) AS o_orderpriority FROM r GROUP BY 1""")
def q_merged_cells(t):
    rows = t.orders.withColumn("at", F.struct("o_orderdate", "o_orderkey"))
    return A.merged_cells(rows, ["o_custkey"], ["o_orderpriority"], "at")


@query("""
SELECT 'nation' AS frame, count(*) AS n, count(*) FILTER (WHERE c_acctbal < 0) AS debtors FROM customer UNION ALL SELECT 'state', count(*), count(*) FILTER (WHERE c_acctbal < 0) FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT 'self', count(*), count(*) FILTER (WHERE c_acctbal < 0) FROM customer WHERE c_nationkey = 3""")
def q_comparison_frames(t):
    rows = t.customer.withColumn("place", F.col("c_nationkey").cast("string"))
    return A.comparison_frames(rows, "c_mktsegment", "place", "3", "BUILDING", {"debtors": F.col("c_acctbal") < 0})


@query("""
SELECT p.event_id, count(e.event_id) FILTER (WHERE e.event_type = 'view') AS views, count(e.event_id) FILTER (WHERE e.event_type = 'error') AS errors
FROM (SELECT event_id, user_id, date_trunc('day', ts) AS d FROM events WHERE event_type = 'purchase') p LEFT JOIN events e ON e.user_id = p.user_id AND date_trunc('day', e.ts) < p.d GROUP BY 1""")
def q_snapshot_features(t):
    days = t.events.withColumn("d", F.date_trunc("day", "ts"))
    asked = days.where("event_type = 'purchase'").select("event_id", "user_id", "d")
    out = A.snapshot_features(asked, days.select("user_id", "d", "event_type"), "user_id", "d", {"views": F.col("event_type") == "view", "errors": F.col("event_type") == "error"})
    return out.select("event_id", "views", "errors")


@query("""
WITH r AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'repealed' END AS status, CASE WHEN o_orderkey % 4 > 0 THEN substr(CAST(o_orderdate::DATE AS VARCHAR), 1, CASE WHEN o_orderkey % 2 = 0 THEN 4 ELSE 10 END) END AS e FROM orders)
SELECT o_orderkey, CASE WHEN status = 'repealed' THEN 'lifted' WHEN coalesce(CASE length(e) WHEN 4 THEN (e || '-12-31')::DATE ELSE e::DATE END < DATE '1998-06-15', FALSE) THEN 'lapsed' WHEN status = 'active' THEN 'active' ELSE 'unknown' END AS currency FROM r""")
def q_currency(t):
    k, d = F.col("o_orderkey"), F.col("o_orderdate").cast("date").cast("string")
    status = F.when(k % 3 == 0, "active").when(k % 3 == 1, "repealed")
    end = F.when(k % 4 > 0, F.substring(d, F.lit(1), F.when(k % 2 == 0, 4).otherwise(10)))
    return t.orders.select("o_orderkey", D.currency(status, end, F.lit("1998-06-15")).alias("currency"))


@query("SELECT p_partkey, (DATE '2024-01-31' + to_months(CAST(p_size % 14 + 1 AS INTEGER)))::DATE AS ends_on, 'computed' AS basis FROM part")
def q_term_end(t):
    ends, basis = D.term_end(F.lit("2024-01-31"), F.concat(F.lit("a "), (F.col("p_size") % 14 + 1).cast("string"), F.lit("-month pause")))
    return t.part.select("p_partkey", ends.alias("ends_on"), basis.alias("basis"))


@query("""
WITH w AS (SELECT o_custkey, count(DISTINCT o_orderpriority) AS n, min(o_orderpriority) AS p FROM orders GROUP BY 1) SELECT c_nationkey, bool_or(o_totalprice > 450000) AS has_severe, min(CASE WHEN o_totalprice > 450000 THEN year(o_orderdate) END)::INTEGER AS first_year,
  min(CASE WHEN o_totalprice > 450000 THEN year(o_orderdate) END) BETWEEN 1996 AND 1998 AS in_window, count(DISTINCT CASE WHEN o_totalprice > 450000 THEN o_orderpriority END) = 1 AS one_source FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def q_risk_window(t):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_nationkey", "o_totalprice", F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("source"))
    return D.risk_window(rows, "c_nationkey", F.col("o_totalprice") > 450000, "y", 1996, 1998)


@query("WITH p AS (SELECT DISTINCT l_orderkey AS i, l_partkey AS p FROM lineitem WHERE l_quantity > 49), l AS (SELECT p, min(i) AS i FROM p GROUP BY 1 HAVING count(*) = 1) SELECT i, count(*) AS n_sole FROM l GROUP BY 1")
def q_sole_contributors(t):
    return D.sole_contributors(t.lineitem.where("l_quantity > 49").select(F.col("l_orderkey").alias("i"), F.col("l_partkey").alias("p")), "i", "p")


@query("""
SELECT o_orderkey, q FROM (SELECT o_orderkey, unnest(list_filter([CASE WHEN o_totalprice < 200000 THEN 'large' END, CASE WHEN o_orderstatus <> 'F' THEN 'decided' END, CASE WHEN o_orderpriority = '5-LOW' THEN 'pressing' END], lambda x: x IS NOT NULL)) AS q FROM orders)""")
def q_findings(t):
    asks = {"large": F.col("o_totalprice") >= 200000, "decided": F.col("o_orderstatus") == "F", "pressing": F.col("o_orderpriority") != "5-LOW"}
    return D.findings(t.orders, "o_orderkey", asks).withColumnRenamed("question", "q")


@query("""
SELECT s_suppkey, lower(s_name) AS key, CASE WHEN s_acctbal < 0 THEN 'low' WHEN s_acctbal <= 3000 THEN 'mid' WHEN s_acctbal <= 99999 THEN 'high' END AS bin, CASE WHEN s_suppkey % 2 = 0 THEN 'HB ' || s_suppkey END AS bill FROM supplier""")
def q_more_keys(t):
    bins = ((-99999.0, -0.000001, "low"), (0.0, 3000.0, "mid"), (3000.000001, 99999.0, "high"))
    bill = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("see H.B. 00"), F.col("s_suppkey").cast("string"))).otherwise("none")
    return t.supplier.select("s_suppkey", S.group_key(F.concat(F.lit("The "), F.col("s_name"), F.lit(", Inc."))).alias("key"), S.bin_for(F.col("s_acctbal"), bins).alias("bin"), S.bill_number(bill).alias("bill"))
