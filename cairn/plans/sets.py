"""Set algebra, diffs and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.operators import sets as O
from cairn.plans.base import query


@query("""
WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'P'), b AS (SELECT DISTINCT user_id AS k FROM events WHERE event_type = 'error')
SELECT 'union' AS op, k FROM (SELECT k FROM a UNION SELECT k FROM b) UNION ALL SELECT 'intersect', k FROM (SELECT k FROM a INTERSECT SELECT k FROM b) UNION ALL SELECT 'except', k FROM (SELECT k FROM a EXCEPT SELECT k FROM b)""")
def q_set_ops(t):
    a = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k"))
    b = t.events.where("event_type = 'error'").select(F.col("user_id").alias("k"))
    return O.tagged_union({"union": a.union(b).distinct(), "intersect": a.intersect(b), "except": a.subtract(b)}, "op").select("op", "k")


@query("""
WITH base AS (SELECT o_orderkey AS k, o_orderstatus AS v FROM orders WHERE o_orderkey % 11 <> 0),
ours AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS v FROM orders WHERE o_orderkey % 7 <> 0),
theirs AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 15 = 0 THEN 'X' WHEN o_orderkey % 10 = 0 THEN 'Y' ELSE o_orderstatus END AS v FROM orders WHERE o_orderkey % 13 <> 0),
j AS (SELECT k, b.v AS b, o.v AS o, t.v AS t, b.v IS NOT NULL AS hb, o.v IS NOT NULL AS ho, t.v IS NOT NULL AS ht FROM base b FULL JOIN ours o USING (k) FULL JOIN theirs t USING (k)),
m AS (SELECT *, CASE WHEN NOT hb AND ho AND ht THEN CASE WHEN o = t THEN 'both_same' ELSE 'disputed' END WHEN NOT hb AND ho THEN 'ours' WHEN NOT hb AND ht THEN 'theirs' WHEN NOT ho AND NOT ht THEN 'removed'
  WHEN NOT ho THEN CASE WHEN b = t THEN 'removed' ELSE 'conflict' END WHEN NOT ht THEN CASE WHEN b = o THEN 'removed' ELSE 'conflict' END
  WHEN o = t THEN CASE WHEN b = o THEN 'unchanged' ELSE 'both_same' END WHEN b = o THEN 'theirs' WHEN b = t THEN 'ours' ELSE 'disputed' END AS outcome FROM j)
SELECT k, CASE WHEN outcome IN ('ours', 'both_same', 'unchanged') THEN o WHEN outcome = 'theirs' THEN t WHEN outcome IN ('disputed', 'conflict') THEN b END AS v, outcome FROM m""")
def q_three_way_merge(t):
    k, s = F.col("o_orderkey"), F.col("o_orderstatus")
    base = t.orders.where(k % 11 != 0).select(k.alias("k"), s.alias("v"))
    ours = t.orders.where(k % 7 != 0).select(k.alias("k"), F.when(k % 5 == 0, "X").otherwise(s).alias("v"))
    theirs = t.orders.where(k % 13 != 0).select(k.alias("k"), F.when(k % 15 == 0, "X").when(k % 10 == 0, "Y").otherwise(s).alias("v"))
    return O.three_way_merge(base, ours, theirs, "k", "v")


@query("""
WITH new AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 > 0 THEN o_orderpriority END AS p FROM orders WHERE o_orderkey % 3 > 0), old AS (SELECT o_orderkey AS k, o_orderstatus AS p FROM orders WHERE o_orderkey % 5 > 0)
SELECT new.k, coalesce(new.p, old.p) AS p, 'new' AS origin FROM new LEFT JOIN old ON old.k = new.k UNION ALL SELECT k, p, 'old' FROM old WHERE k NOT IN (SELECT k FROM new)""")
def q_edition_merge(t):
    k = F.col("o_orderkey")
    new = t.orders.where(k % 3 > 0).select(k.alias("k"), F.when(k % 4 > 0, F.col("o_orderpriority")).alias("p"))
    return O.edition_merge(new, t.orders.where(k % 5 > 0).select(k.alias("k"), F.col("o_orderstatus").alias("p")), "k", ["p"])


@query("""
WITH b AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_orderpriority AS p FROM orders WHERE o_orderkey % 6 > 0), a AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 0 THEN 'X' ELSE o_orderstatus END AS s, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderpriority END AS p FROM orders WHERE o_orderkey % 7 > 0)
SELECT k, 'added' AS change, '*' AS "column" FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT k, 'removed', '*' FROM b WHERE k NOT IN (SELECT k FROM a)
UNION ALL SELECT k, 'modified', 's' FROM a JOIN b USING (k) WHERE a.s IS DISTINCT FROM b.s UNION ALL SELECT k, 'modified', 'p' FROM a JOIN b USING (k) WHERE a.p IS DISTINCT FROM b.p""")
def q_keyed_diff(t):
    k = F.col("o_orderkey")
    before = t.orders.where(k % 6 > 0).select(k.alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p"))
    after = t.orders.where(k % 7 > 0).select(k.alias("k"), F.when(k % 4 == 0, "X").otherwise(F.col("o_orderstatus")).alias("s"), F.when(k % 10 > 0, F.col("o_orderpriority")).alias("p"))
    return O.keyed_diff(before, after, "k", ["s", "p"])
