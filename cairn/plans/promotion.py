"""Promotion of reviewed rows, and two more worklists, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.operators import outcomes as O
from cairn.operators import promotion
from cairn.plans.base import query
from cairn.plans.rules import listed, pick


@query("""
WITH a AS (SELECT user_id AS node, count(*) AS requests, max(ts)::DATE AS last_requested FROM events GROUP BY 1), k AS (SELECT o_custkey AS node, max(o_orderdate)::DATE AS checked FROM orders GROUP BY 1)
SELECT a.node, CASE WHEN checked IS NULL THEN 'no check on record' ELSE 'check of ' || checked || ' is stale (more than 365 days old)' END AS reason, requests, last_requested FROM a LEFT JOIN k ON k.node = a.node
WHERE a.node NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 2000) AND NOT coalesce(datediff('day', checked, DATE '2002-01-01') <= 365, false)""")
def q_negative_worklist(t):
    """Users as places asked about, orders as checks."""
    requests = t.events.select(F.col("user_id").alias("node"), F.col("ts").cast("date").alias("day"))
    checks = t.orders.select(F.col("o_custkey").alias("node"), F.col("o_orderdate").cast("date").alias("checked_on"))
    return O.negative_worklist(requests, checks, t.customer.where("c_acctbal < 2000").select(F.col("c_custkey").alias("node")), "2002-01-01")


@query("""
WITH i AS (SELECT p_partkey AS instrument_id, p_partkey * 3 % 1500 AS node, CASE WHEN p_size % 7 > 0 THEN DATE '1999-01-01' + CAST(p_size * 40 AS INT) END AS enacted FROM part WHERE p_size > 30), e AS (SELECT a.c_custkey AS a, b.c_custkey AS b FROM customer a JOIN customer b ON abs(a.c_custkey - b.c_custkey) IN (1, 7))
SELECT DISTINCT b AS node, instrument_id, enacted FROM i JOIN e ON a = node WHERE enacted BETWEEN DATE '2003-06-30' - INTERVAL 18 MONTH AND DATE '2003-06-30' AND b NOT IN (SELECT node FROM i) AND b NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def q_adjacency_worklist(t):
    """Places next to a recent instrument, without one of their own and without a check."""
    node = t.customer.select(F.col("c_custkey").alias("a"))
    edges = node.select("a", F.explode(F.array(*(F.col("a") + d for d in (-7, -1, 1, 7)))).alias("b")).join(node.withColumnRenamed("a", "b"), "b")
    rows = t.part.where("p_size > 30").select(F.col("p_partkey").alias("instrument_id"), (F.col("p_partkey") * 3 % 1500).alias("node"), F.when(F.col("p_size") % 7 > 0, F.date_add(F.lit("1999-01-01").cast("date"), (F.col("p_size") * 40).cast("int"))).alias("enacted"))
    return O.adjacency_worklist(rows, edges, t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("node")), "2003-06-30")


LISTS = ("setback (wind); noise limit", "moratorium", "cap on acreage (solar+storage); ban", "fence", "", "overlay_zone (solar)")
STATED = ("active", "pending", "extended", "lifted", "")
SOLD = ("solar", "wind; solar", "battery_storage", "hydro", "wind")


def queue(t, turn: int = 0):
    """A reviewed row of each order's number; ``turn`` gives the statuses to other rows."""
    k = F.col("o_orderkey")
    return t.orders.select(
        k.alias("queue_id"), F.when(k % 17 == 0, "snippet").when(k % 19 == 0, "").otherwise("opened").alias("access"), pick(k % 6, LISTS).alias("mechanisms"), pick(k % 5, SOLD).alias("technology"), pick((F.floor(k / 7) + turn) % 5, STATED).alias("status"), F.when(k % 23 == 0, "2024").otherwise("2024-05").alias("end_date"),
        F.when(k % 13 == 0, "4").otherwise("").alias("severity_score"), F.format_string("%d feet", (k % 4000).cast("long")).alias("mechanism_detail"), F.when(k % 29 == 0, " ").otherwise("a rule").alias("description"), F.lit("VA").alias("state"), F.when(k % 31 == 0, "ftp://a").otherwise("https://a.org").alias("source_url"),
    )


_OWN = "CASE WHEN m = 0 THEN CASE WHEN tech = 'wind' THEN ['setback (wind)', 'noise limit'] ELSE ['noise limit'] END WHEN m = 1 THEN ['moratorium'] WHEN m = 2 THEN CASE WHEN tech = 'wind' THEN ['ban'] ELSE ['cap on acreage (solar+storage)', 'ban'] END WHEN m = 5 AND tech = 'solar' THEN ['overlay_zone (solar)'] ELSE []::VARCHAR[] END"


def promotion_sql(turn: int, tag: str = "") -> str:
    """The rules in SQL: table s{tag} has a row per technology, r{tag} the problem of each row."""
    return f"""q{tag} AS (SELECT o_orderkey AS k, o_orderkey % 6 AS m, o_orderkey % 4000 AS feet, CASE WHEN o_orderkey % 17 = 0 THEN 'snippet' WHEN o_orderkey % 19 = 0 THEN '' ELSE 'opened' END AS access, {listed("o_orderkey % 5", SOLD)} AS sold, {listed(f"(o_orderkey // 7 + {turn}) % 5", STATED)} AS status FROM orders),
x{tag} AS (SELECT *, unnest(CASE sold WHEN 'wind; solar' THEN ['wind', 'solar'] ELSE [sold] END) AS tech FROM q{tag}), y{tag} AS (SELECT *, {_OWN} AS own FROM x{tag}),
z{tag} AS (SELECT *, CASE WHEN m = 2 THEN 4 WHEN m = 1 AND status IN ('active', 'extended') THEN 4 WHEN m = 0 AND tech = 'wind' AND feet >= 2640 THEN 3 ELSE 2 END AS score,
  CASE WHEN m = 2 THEN 'ban/prohibition' WHEN m = 1 AND status IN ('active', 'extended') THEN 'in-force moratorium' WHEN m = 0 AND tech = 'wind' AND feet >= 2640 THEN 'wind setback ' || feet || ' ft' ELSE 'restricting mechanism (default)' END AS basis,
  CASE m WHEN 0 THEN CASE WHEN tech = 'wind' THEN 'setback' ELSE 'noise_limit' END WHEN 1 THEN 'moratorium' WHEN 2 THEN 'ban' ELSE 'zoning_restriction' END AS driver FROM y{tag}),
s{tag} AS (SELECT *, CASE WHEN status = 'pending' AND score > 2 THEN 2 ELSE score END AS final, CASE WHEN status = 'pending' AND score > 2 THEN basis || '; capped at 2 (pending)' ELSE basis END AS said FROM z{tag}),
p{tag} AS (SELECT k, any_value(status) AS status, any_value(CASE WHEN access <> 'opened' THEN 'access is ' || CASE WHEN access = '' THEN 'blank' ELSE access END || '; the source has to be opened or archived first' WHEN m = 3 THEN 'unknown mechanism(s) fence' WHEN m = 4 THEN 'mechanisms is blank'
  WHEN status = '' THEN 'status '''' is not one of the vocabulary' WHEN status = 'lifted' THEN 'status lifted: the instrument is no longer in force' WHEN k % 23 = 0 THEN 'end_date must be YYYY-MM or YYYY-MM-DD' WHEN sold = 'hydro' THEN 'technology must be among solar, wind, battery_storage' END) AS early,
  string_agg(tech, ', ' ORDER BY tech DESC) FILTER (WHERE len(own) = 0) AS bare, arg_max('typed severity_score 4 conflicts with the computed ' || final || ' for ' || tech, tech) FILTER (WHERE k % 13 = 0 AND final <> 4) AS typed FROM s{tag} GROUP BY k),
r{tag} AS (SELECT k, status, CASE WHEN early IS NOT NULL THEN early WHEN bare IS NOT NULL THEN 'no mechanism applies to ' || bare WHEN typed IS NOT NULL THEN typed WHEN k % 29 = 0 AND k % 31 = 0 THEN 'missing description, source_url (not http(s))' WHEN k % 29 = 0 THEN 'missing description' WHEN k % 31 = 0 THEN 'missing source_url (not http(s))' END AS problem FROM p{tag}),
f{tag} AS (SELECT k, tech, 'VA' AS state, 'a rule' AS description, 'https://a.org' AS source_url, s{tag}.status, driver AS restriction_type, CAST(final AS VARCHAR) AS severity_score, said AS severity_basis, array_to_string(own, ', ') AS mechanisms FROM s{tag} JOIN r{tag} USING (k) WHERE problem IS NULL)"""


@query(f"WITH {promotion_sql(0)} SELECT k AS queue_id, problem FROM r")
def q_promotion_problems(t):
    """Why a row of the queue stays there, the first of ten reasons."""
    return promotion.judged(queue(t)).select("queue_id", "problem")


@query(f"WITH {promotion_sql(0)} SELECT k AS queue_id, tech AS technology, restriction_type, CAST(severity_score AS INT) AS severity_score, severity_basis, mechanisms FROM f")
def q_promoted(t):
    """The seed rows, one per technology, scored on the mechanisms that apply to it."""
    return promotion.promoted(queue(t)).select("queue_id", "technology", "restriction_type", "severity_score", "severity_basis", "mechanisms")


COLUMNS = ("state", "description", "source_url", "status", "restriction_type", "severity_score", "severity_basis", "mechanisms")
_BEFORE, _AFTER = (", ".join(f"coalesce({side}.{c}, '')" for c in COLUMNS) for side in ("a", "b"))


@query(f"""
WITH {promotion_sql(0)}, {promotion_sql(1, "2")}, a AS (SELECT f.* FROM f JOIN r2 USING (k) WHERE r2.problem IS NULL OR r2.status IN ('lifted', 'expired')),
j AS (SELECT coalesce(a.k, b.k) AS queue_id, coalesce(a.tech, b.tech) AS technology, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' ELSE 'changed' END AS kind, unnest([{", ".join(f"'{c}'" for c in COLUMNS)}]) AS col, unnest([{_BEFORE}]) AS before, unnest([{_AFTER}]) AS after FROM a FULL JOIN f2 b ON a.k = b.k AND a.tech = b.tech)
SELECT queue_id, technology, kind, col AS "column", before, after FROM j WHERE before <> after""")
def q_resynced(t):
    """What a second promotion, with statuses moved on, changes of the first one's rows."""
    return promotion.resynced(promotion.promoted(queue(t)), queue(t, turn=1))


FAMILIES = ("mn", "sabin", "nrel", "queue", "x")
VERDICTS = ("confirmed", "contradicts", "")


@query(f"""
WITH h AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'cases' ELSE 'restrictions' END AS entity, list_filter([CASE WHEN o_orderkey % 2 = 0 THEN 'A' END, CASE WHEN o_orderkey % 5 = 0 THEN 'B' END], lambda x: x IS NOT NULL) AS codes FROM orders),
q AS (SELECT CASE WHEN c_custkey % 4 = 0 THEN 'pending' ELSE c_mktsegment END AS status, 'n' || c_nationkey AS entity FROM customer),
c AS (SELECT CASE p_partkey % 5 WHEN 0 THEN 'Moratorium Nation' WHEN 1 THEN 'Sabin' WHEN 2 THEN 'NREL' WHEN 3 THEN 'review queue' ELSE 'other' END AS f, CASE p_partkey % 3 WHEN 0 THEN 'confirmed' WHEN 1 THEN 'contradicts' ELSE 'no_verdict' END AS v, CASE WHEN p_size > 25 THEN 'opened' ELSE 'unknown' END AS a FROM part)
SELECT 'quarantine' AS section, 'by_entity' AS measure, entity AS key, count(*) AS n FROM h GROUP BY entity UNION ALL SELECT 'quarantine', 'by_blocking_code', code, count(*) FROM (SELECT unnest(codes) AS code FROM h) GROUP BY code
UNION ALL SELECT 'review', 'by_status', status, count(*) FROM q GROUP BY status UNION ALL SELECT 'review', 'by_entity', entity, count(*) FROM q GROUP BY entity
UNION ALL SELECT 'evidence', 'checked', f, count(*) FROM c GROUP BY f UNION ALL SELECT 'evidence', 'verdict', f || '/' || v, count(*) FROM c GROUP BY f, v UNION ALL SELECT 'evidence', 'access', f || '/' || a, count(*) FROM c GROUP BY f, a
UNION ALL SELECT 'trail', 'by_action', event_type, count(*) FROM events GROUP BY event_type UNION ALL SELECT 'trail', 'by_file', 'u' || user_id % 9, count(*) FROM events GROUP BY user_id % 9
UNION ALL SELECT 'trail', 'days', '', count(DISTINCT ts::DATE) FROM events""")
def q_operations(t):
    """What lies in quarantine, in review, in evidence and on the trail."""
    from cairn.operators.summaries import operations_summary

    k, p = F.col("o_orderkey"), F.col("p_partkey")
    issue = lambda code, severity, when: F.when(when, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity")))
    held = t.orders.select(F.when(k % 3 == 0, "cases").otherwise("restrictions").alias("entity"), F.array_compact(F.array(issue("A", "HIGH", k % 2 == 0), issue("B", "CRITICAL", k % 5 == 0), issue("C", "LOW", k % 7 == 0))).alias("issues"))
    reviewed = t.customer.select(F.when(F.col("c_custkey") % 4 == 0, " ").otherwise(F.col("c_mktsegment")).alias("review_status"), F.concat(F.lit("n"), "c_nationkey").alias("entity_type"))
    checks = t.part.select(F.concat_ws(":", pick(p % 5, FAMILIES), p).alias("instrument_id"), pick(p % 3, VERDICTS).alias("verdict"), F.when(F.col("p_size") > 25, "opened").alias("access"))
    trail = t.events.select(F.col("event_type").alias("action"), F.concat(F.lit("u"), F.col("user_id") % 9).alias("file"), F.col("ts").cast("date").cast("string").alias("decided_on"))
    return operations_summary(held, reviewed, checks, trail)
