"""Severity, outcomes, publishing, worklists and intake over whole tables, each beside the rule in SQL."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cairn.functions import scalars as S
from cairn.operators import models, sets
from cairn.operators import outcomes as O
from cairn.plans.base import query
from cairn.plans.files import _fresh
from cairn.plans.rules import STATUSES, listed, pick
from cairn.sources import sinks
from cairn.sources.engine import Engine

KINDS = (("ban", "setback"), ("ban_or_moratorium",), ("moratorium", "height_limit"), ("setback", "noise_limit"), ("height_limit", "setback"), ("noise_limit",), ("size_cap",), ("siting_standard", "zoning_restriction"))
TECHNOLOGIES = ("wind", "solar", "battery_storage")


@query(f"""
WITH p AS (SELECT p_partkey, p_partkey % 8 AS m, p_size * 100 AS feet, p_size % 9 + 1 AS h, 30 + p_size % 20 AS db, {listed("p_size % 3", TECHNOLOGIES)} AS tech, {listed("p_partkey % 5", STATUSES)} AS status FROM part),
r AS (SELECT *, status IN ('active', 'extended', 'unknown') AS force FROM p),
s AS (SELECT *, CASE WHEN m = 0 THEN 'ban' WHEN m = 1 AND force THEN 'ban_or_moratorium' WHEN m = 2 AND force THEN 'moratorium' WHEN tech = 'wind' AND m IN (3, 4) AND (feet >= 2640 OR h >= 5) THEN 'setback' WHEN tech = 'wind' AND m IN (2, 4) THEN 'height_limit'
  WHEN tech = 'wind' AND m IN (3, 5) AND db <= 35 THEN 'noise_limit' WHEN tech <> 'wind' AND m IN (3, 4) AND feet >= 1000 THEN 'setback' END AS rule FROM r),
u AS (SELECT *, CASE WHEN rule IN ('ban', 'ban_or_moratorium', 'moratorium') THEN 4 WHEN rule IS NULL THEN 2 ELSE 3 END AS score, CASE rule WHEN 'ban' THEN 'ban/prohibition' WHEN 'ban_or_moratorium' THEN 'ban or moratorium (the source does not say which)' WHEN 'moratorium' THEN 'in-force moratorium'
  WHEN 'setback' THEN CASE WHEN tech = 'wind' THEN 'wind setback ' || feet || ' ft / ' || h || 'x height' ELSE tech || ' setback ' || feet || ' ft' END WHEN 'height_limit' THEN 'wind height limit' WHEN 'noise_limit' THEN 'wind noise limit ' || db || ' dBA' ELSE 'restricting mechanism (default)' END AS basis FROM s)
SELECT p_partkey, CASE WHEN status = 'pending' THEN 2 ELSE score END AS score, CASE WHEN status = 'pending' AND score > 2 THEN basis || '; capped at 2 (pending)' ELSE basis END AS basis,
  coalesce(rule, CASE m WHEN 0 THEN 'ban' WHEN 1 THEN 'ban_or_moratorium' WHEN 2 THEN 'moratorium' WHEN 3 THEN 'setback' WHEN 4 THEN 'height_limit' WHEN 5 THEN 'noise_limit' WHEN 6 THEN 'size_cap' ELSE 'zoning_restriction' END) AS driver FROM u""")
def q_severity(t):
    """A restriction of each part, its numbers in the text."""
    n, k = F.col("p_size"), F.col("p_partkey")
    types = F.get(F.array(*(F.array(*map(F.lit, kinds)) for kinds in KINDS)), (k % 8).cast("int"))
    text = F.format_string("Setback of %d feet, %d times the height; %d dBA", n * 100, n % 9 + 1, n % 20 + 30)
    score, basis, driver = O.restriction_severity(types, pick(n % 3, TECHNOLOGIES), pick(k % 5, STATUSES), text)
    return t.part.select("p_partkey", score.alias("score"), basis.alias("basis"), driver.alias("driver"))


RULINGS = ("ruled_for_opposition", "ruled_for_developer", "settled", "dismissed")
ENDS = ("blocked_unverified", "advanced_unverified", "pending", "blocked_confirmed", "needs_review")


@query(f"""
WITH c AS (SELECT l_orderkey AS k, l_linenumber * 1000000 + l_partkey AS seq, 'case ' || l_partkey AS name, {listed("l_suppkey % 4", RULINGS)} AS status FROM lineitem),
r AS (SELECT k, arg_min(name, seq) FILTER (WHERE status = 'ruled_for_opposition') AS b, arg_min(name, seq) FILTER (WHERE status = 'ruled_for_developer') AS a FROM c GROUP BY k),
p AS (SELECT o_orderkey, {listed("o_orderkey % 5", ENDS)} AS old, o_orderkey % 3 = 0 AS litigated, b, a FROM orders LEFT JOIN r ON k = o_orderkey),
f AS (SELECT *, CASE WHEN old = 'blocked_unverified' AND b IS NOT NULL THEN 'blocked_confirmed' WHEN old = 'advanced_unverified' AND a IS NOT NULL THEN 'advanced_confirmed' ELSE old END AS outcome, CASE WHEN old = 'blocked_unverified' THEN b WHEN old = 'advanced_unverified' THEN a END AS named FROM p)
SELECT o_orderkey, outcome, CASE WHEN named IS NOT NULL THEN 'court_ruling: ' || named WHEN old LIKE '%_unverified' THEN 'outcome_label_only' ELSE 'none' END AS finality_evidence, CASE WHEN outcome LIKE 'blocked_%' THEN 4 WHEN litigated THEN 3 WHEN outcome LIKE 'advanced_%' THEN 1 ELSE 2 END AS severity FROM f""")
def q_final_outcomes(t):
    """Orders as projects, their lines as cases; the first ruling that fits confirms."""
    cases = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("seq"), F.concat(F.lit("case "), "l_partkey").alias("case_name"), pick(F.col("l_suppkey") % 4, RULINGS).alias("case_status"))
    projects = t.orders.select("o_orderkey", pick(F.col("o_orderkey") % 5, ENDS).alias("outcome"), (F.col("o_orderkey") % 3 == 0).alias("litigated"))
    return O.finalize_outcomes(projects, cases, "o_orderkey").select("o_orderkey", "outcome", "finality_evidence", "severity")


ACCESS = ("opened", "archived", "snippet", "")


@query(f"""
WITH c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'r' || c_custkey % 3 END AS rev, 'r' || c_custkey % 5 AS drafter, CASE WHEN c_custkey % 11 = 0 THEN ' ' ELSE 'https://a.org' END AS url, {listed("c_custkey % 4", ACCESS)} AS access,
  CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'confirmed' ELSE 'unclear' END AS verdict, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE '' END AS note, CASE WHEN c_custkey % 13 > 0 THEN '2024-01-01' END AS day FROM customer)
SELECT k, CASE WHEN rev = '' THEN 'no recorded review' WHEN rev = drafter THEN 'self-review: the reviewer drafted the row' WHEN trim(url) = '' THEN 'no statute URL' WHEN access NOT IN ('opened', 'archived') THEN 'review saw the statute only as ' || CASE WHEN access = '' THEN 'nothing recorded' ELSE access END
  WHEN verdict <> 'confirmed' THEN 'review verdict ' || CASE WHEN verdict = '' THEN 'blank' ELSE verdict END || CASE WHEN note <> '' THEN ': ' || note ELSE '' END WHEN day IS NULL THEN 'review has no date' END AS held FROM c""")
def q_policy_gate(t):
    """Why each row is held, the first reason that applies."""
    k = F.col("c_custkey")
    reviewer, drafter = F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("r"), k % 3)), F.concat(F.lit("r"), k % 5)
    verdict = pick(k % 3, ("", "confirmed", "unclear"))
    why = O.hold_reason(reviewer, drafter, F.when(k % 11 == 0, " ").otherwise("https://a.org"), pick(k % 4, ACCESS), verdict, F.when(k % 2 == 0, F.col("c_name")).otherwise(""), F.when(k % 13 > 0, "2024-01-01"))
    return t.customer.select(k.alias("k"), why.alias("held"))


AS_OF = "2002-06-30"


@query(f"""
WITH p AS (SELECT o_custkey AS record_id, o_orderkey AS seq, 'S' || o_custkey % 7 AS state, 'P' || o_orderkey % 100 AS project_name, {listed("o_orderkey % 5", ENDS)} AS outcome, CASE WHEN o_orderkey % 9 > 0 THEN o_orderdate::DATE END AS event_day, CASE WHEN o_orderkey % 4 = 0 THEN 'yes' ELSE 'no' END AS has_litigation,
  CASE WHEN o_orderkey % 31 = 0 THEN 'retired' END AS facility_conflict, CASE WHEN o_orderkey % 6 = 0 THEN 'denied' ELSE '' END AS decision_language FROM orders),
f AS (SELECT * FROM p WHERE outcome <> 'blocked_confirmed' QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY seq) = 1),
g AS (SELECT *, datediff('day', event_day, DATE '{AS_OF}') AS age FROM f WHERE record_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0))
SELECT record_id, outcome, CAST(age AS INT) AS age_days, coalesce(outcome = 'pending' AND age > 365, false) AS overdue,
  row_number() OVER (ORDER BY facility_conflict IS NULL, list_position(['blocked_unverified', 'advanced_unverified', 'needs_review', 'pending'], outcome), decision_language = '', has_litigation <> 'yes', year(event_day) NULLS LAST, state, project_name, record_id) AS priority FROM g""")
def q_outcome_worklist(t):
    """What to settle next among customers' first open orders."""
    k = F.col("o_orderkey")
    projects = t.orders.select(
        F.col("o_custkey").alias("record_id"), k.alias("seq"), F.concat(F.lit("S"), F.col("o_custkey") % 7).alias("state"), F.concat(F.lit("P"), k % 100).alias("project_name"), pick(k % 5, ENDS).alias("outcome"), F.when(k % 9 > 0, F.col("o_orderdate").cast("date")).alias("event_day"),
        F.when(k % 4 == 0, "yes").otherwise("no").alias("has_litigation"), F.when(k % 31 == 0, "retired").alias("facility_conflict"), F.when(k % 6 == 0, "denied").otherwise("").alias("decision_language"),
    )
    return O.outcome_worklist(projects, t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("record_id")), AS_OF).select("record_id", "outcome", "age_days", "overdue", "priority")


LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
EVIDENCE = ("compiled_flagged", "compiled_record", "report_citation", "primary_source")
PENDING = ("active", "extended", "pending")


@query(f"""
WITH l AS (SELECT *, l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(LINE_ORDER)}) AS seq FROM lineitem),
r AS (SELECT l_partkey AS id, seq, l_suppkey AS place, CASE WHEN seq % 2 = 0 THEN 'wind' ELSE 'solar' END AS technology, l_orderkey AS node, CASE WHEN l_returnflag = 'A' THEN 'multi' ELSE 'renewables_only' END AS scope, CASE WHEN l_quantity >= 49 THEN 3 ELSE 1 + l_linenumber % 2 END AS severity,
  {listed("seq % 3", PENDING)} AS status, l_shipdate::DATE AS day, CASE WHEN seq % 97 = 0 THEN 'lapsed_unconfirmed' ELSE 'in_force' END AS currency, {listed("seq % 4", EVIDENCE)} AS evidence, seq % 5 = 0 AS verified, CASE WHEN seq % 10 = 0 THEN 'u' || seq ELSE '' END AS url, 'S' || l_suppkey % 9 AS state FROM l),
e AS (SELECT r.* FROM r WHERE currency = 'lapsed_unconfirmed' OR (evidence <> 'primary_source' AND id NOT IN (SELECT p_partkey FROM part WHERE p_size > 25))),
g AS (SELECT id, arg_min(scope, seq) AS scope, arg_min(severity, seq) AS severity, arg_min(status, seq) AS status, arg_min(day, seq) AS day, arg_min(currency, seq) AS currency, arg_min(evidence, seq) AS evidence, arg_min(state, seq) AS state, arg_min(url, seq) AS url, string_agg(DISTINCT technology, ';' ORDER BY technology) AS techs FROM e GROUP BY id),
m AS (SELECT id, max(severity) AS sev FROM r WHERE scope = 'renewables_only' GROUP BY id), a AS (SELECT DISTINCT r.id, node, sev FROM r JOIN m USING (id) WHERE scope = 'renewables_only'),
n AS (SELECT node, count(*) AS n, count(*) FILTER (WHERE sev >= 3) AS s FROM a GROUP BY node),
i AS (SELECT id, CASE WHEN max(sev) >= 3 AND bool_or(s = 1) THEN 'sole_severe' WHEN bool_or(n = 1) THEN 'sole_record' ELSE '' END AS impact FROM a JOIN n USING (node) GROUP BY id),
h AS (SELECT place, technology, arg_min(id, seq) AS sibling, arg_min(url, seq) AS url FROM r WHERE verified AND url <> '' GROUP BY 1, 2),
b AS (SELECT r.id, arg_min(sibling, seq) AS sibling, arg_min(h.url, seq) AS sib_url FROM r JOIN h USING (place, technology) WHERE NOT verified AND sibling <> r.id GROUP BY r.id),
j AS (SELECT g.*, coalesce(impact, '') AS impact, sibling, coalesce(nullif(url, ''), sib_url, '') AS located, datediff('day', day, DATE '{AS_OF}') AS age FROM g LEFT JOIN i USING (id) LEFT JOIN b USING (id))
SELECT id AS instrument_id, techs AS technologies, currency, evidence AS evidence_level, severity, impact AS county_impact, located AS located_url,
  array_to_string(list_filter([CASE WHEN currency = 'lapsed_unconfirmed' THEN 'end date passed with no confirmed extension' END, CASE WHEN status = 'pending' AND age > 120 THEN 'pending ' || age || ' days, past 120' END, CASE WHEN sibling IS NOT NULL THEN 'primary source held by ' || sibling END], lambda x: x IS NOT NULL), '; ') AS flags,
  row_number() OVER (ORDER BY currency <> 'lapsed_unconfirmed', coalesce(list_position(['compiled_flagged', 'compiled_record', 'report_citation'], evidence), 9), scope <> 'renewables_only', CASE impact WHEN 'sole_severe' THEN 0 WHEN 'sole_record' THEN 1 ELSE 2 END, severity DESC, list_position(['active', 'extended', 'pending'], status), state, id) AS priority FROM j""")
def q_restriction_worklist(t):
    """Lines as rows of instruments, orders as the counties they touch; impacts, siblings, flags and priority."""
    at = F.row_number().over(W.partitionBy("l_orderkey").orderBy(*LINE_ORDER))
    q = F.col("seq")
    rows = t.lineitem.withColumn("seq", F.col("l_orderkey") * 1000 + at).select(
        F.col("l_partkey").alias("instrument_id"), "seq", F.col("l_suppkey").alias("place"), F.when(q % 2 == 0, "wind").otherwise("solar").alias("technology"), F.col("l_orderkey").alias("node"), F.when(F.col("l_returnflag") == "A", "multi").otherwise("renewables_only").alias("scope"),
        F.when(F.col("l_quantity") >= 49, 3).otherwise(1 + F.col("l_linenumber") % 2).alias("severity"), pick(q % 3, PENDING).alias("status"), F.col("l_shipdate").cast("date").alias("status_day"), F.when(q % 97 == 0, O.LAPSED).otherwise("in_force").alias("currency"),
        pick(q % 4, EVIDENCE).alias("evidence_level"), (q % 5 == 0).alias("verified"), F.when(q % 10 == 0, F.concat(F.lit("u"), q)).otherwise("").alias("url"), F.concat(F.lit("S"), F.col("l_suppkey") % 9).alias("state"),
    )
    checked = t.part.where("p_size > 25").select(F.col("p_partkey").alias("instrument_id"))
    return O.restriction_worklist(rows, checked, AS_OF).select("instrument_id", "technologies", "currency", "evidence_level", F.col("severity").cast("int").alias("severity"), "county_impact", "located_url", "flags", "priority")


@query("""
WITH l AS (SELECT event_type || user_id % 3 AS s, event_id AS seq, substr(CAST(ts AS VARCHAR), 1, 10) AS day, CASE WHEN event_id % 5 = 0 THEN 'HTTP ' || event_id ELSE '' END AS error, CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 3 = 0 THEN 'unchanged' ELSE 'raw/' || event_id END AS path FROM events)
SELECT s AS source_id, count(*) AS requests, count(*) FILTER (WHERE error = '' AND path NOT IN ('', 'unchanged')) AS stored, count(*) FILTER (WHERE error = '' AND path = 'unchanged') AS unchanged, count(*) FILTER (WHERE error <> '') AS failed, max(day) AS last_fetch,
  max(day) FILTER (WHERE error = '' AND path NOT IN ('', 'unchanged')) AS last_changed, arg_max(day || ': ' || error, seq) FILTER (WHERE error <> '') AS last_error FROM l GROUP BY s""")
def q_intake(t):
    """Requests by source, from events."""
    k = F.col("event_id")
    log = t.events.select(F.concat("event_type", F.col("user_id") % 3).alias("source_id"), k.alias("seq"), F.col("ts").cast("string").alias("fetch_date"), F.when(k % 5 == 0, F.concat(F.lit("HTTP "), k)).otherwise("").alias("error"), F.when(k % 7 == 0, "").when(k % 3 == 0, "unchanged").otherwise(F.concat(F.lit("raw/"), k)).alias("local_path"))
    return O.intake(log)


@query("""
WITH p AS (SELECT p_partkey, p_partkey % 6 AS m, p_size AS n, p_size::DOUBLE AS x FROM part)
SELECT p_partkey, CASE m WHEN 0 THEN [x] WHEN 1 THEN [x, (n || '.5')::DOUBLE * 1000] WHEN 2 THEN []::DOUBLE[] WHEN 3 THEN [(n || '500')::DOUBLE * 0.001::DOUBLE] WHEN 4 THEN [x, 0.5 * 1000] ELSE []::DOUBLE[] END AS low,
  CASE m WHEN 0 THEN [x] WHEN 1 THEN [(n + 5)::DOUBLE, (n || '.5')::DOUBLE * 1000] WHEN 2 THEN []::DOUBLE[] WHEN 3 THEN [(n || '500')::DOUBLE * 0.001::DOUBLE] WHEN 4 THEN [(n + 1)::DOUBLE, 0.5 * 1000] ELSE []::DOUBLE[] END AS high,
  CASE m WHEN 0 THEN x * 0.8 <= 20 AND 20 <= x * 1.2 WHEN 1 THEN x * 0.8 <= 20 AND 20 <= (n + 5) * 1.2 WHEN 3 THEN (x + 0.5) * 0.8 <= 20 AND 20 <= (x + 0.5) * 1.2 WHEN 4 THEN x * 0.8 <= 20 AND 20 <= (n + 1) * 1.2 ELSE false END AS agrees FROM p""")
def q_capacity_list(t):
    """every amount of a text, ranges and units; and whether 20 MW agrees with one."""
    n, m = F.col("p_size"), F.col("p_partkey") % 6
    texts = [F.format_string("%d MW", n), F.format_string("about %d-%d MW, later %d.5 GW", n, n + 5, n), F.format_string("%d turbines", n), F.format_string("%d,500 kW", n), F.format_string("%d to %d MW and .5 gw", n, n + 1)]
    s = F.coalesce(*(F.when(m == k, x) for k, x in enumerate(texts)))
    found = S.capacities(s)
    return t.part.select("p_partkey", F.transform(found, lambda r: r["low"]).alias("low"), F.transform(found, lambda r: r["high"]).alias("high"), S.capacity_agrees(s, F.lit(20.0)).alias("agrees"))


@query("""
WITH g AS (SELECT c_custkey AS k, c_name AS name, 'fresh' AS court, 'needs_docket_research' AS status FROM customer WHERE c_acctbal > 0),
e AS (SELECT c_custkey AS k, 'old' AS name, CASE WHEN (c_custkey + n) % 3 = 0 THEN 'court ' || n ELSE ' ' END AS court, CASE WHEN (c_custkey + n) % 5 = 0 THEN 'confirmed' ELSE 'needs_docket_research' END AS status FROM customer, range(1, 4) r(n) WHERE c_custkey % 2 = 0 AND n <= 1 + c_custkey % 3)
SELECT g.k, g.name, coalesce(nullif(trim(e.court), ''), g.court) AS court, coalesce(e.status, g.status) AS status FROM g LEFT JOIN e USING (k)
UNION ALL SELECT k, name, court, status FROM e WHERE k NOT IN (SELECT k FROM g) AND (trim(court) <> '' OR status <> 'needs_docket_research')""")
def q_kept_review(t):
    """reviewers' cells survive a rebuild, split rows stay split, worked-on rows that are gone stay."""
    k, n = F.col("k"), F.col("n")
    generated = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.lit("fresh").alias("court"), F.lit("needs_docket_research").alias("status"))
    split = t.customer.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.explode(F.sequence(F.lit(1), (1 + F.col("c_custkey") % 3).cast("int"))).alias("n"))
    existing = split.select("k", F.lit("old").alias("name"), F.when((k + n) % 3 == 0, F.concat(F.lit("court "), n)).otherwise(" ").alias("court"), F.when((k + n) % 5 == 0, "confirmed").otherwise("needs_docket_research").alias("status"))
    return sets.keep_review(generated, existing, "k", ["court", "status"], "status", ("needs_docket_research",))


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name AS shown, CAST(row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS VARCHAR) AS place FROM customer")
def q_download(t):
    """SNK12: all rows of a query as CSV, read back as text."""
    folder = _fresh(t)
    sinks.publish({"downloaded": t.customer}, f"{folder}/published")
    Engine(t.spark, f"{folder}/published").download("SELECT c_custkey, c_name AS shown, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS place FROM downloaded", f"{folder}/csv")
    return t.spark.read.option("header", True).csv(f"{folder}/csv")


def _lines(t):
    at = F.row_number().over(W.partitionBy("l_orderkey").orderBy(*LINE_ORDER))
    return t.lineitem.select((F.col("l_orderkey") * 1000 + at).alias("id"), F.year("l_shipdate").alias("year"), "l_quantity", "l_extendedprice", "l_discount", (F.col("l_returnflag") == "R").cast("int").alias("y"))


@query()
def q_forward_holdout(t):
    """M5: fitted on the years before 1999, said of the others; tested for leaks beside it."""
    return models.forward_holdout(_lines(t), ["l_quantity", "l_extendedprice", "l_discount"], "y", "year", 1999).select("id", "year", "y", F.round("p", 4).alias("p"))


@query()
def q_learners(t):
    """M4, M6, M7: out-of-fold by boosted trees, by logistic regression over squares and products, and the latter recalibrated."""
    columns = ["l_quantity", "l_discount"]
    rows = models.folded(_lines(t).select("id", "y", *columns), "y", F.col("id"), 2)
    boosted = models.out_of_fold(rows, columns, 2, kind="boosted").select(F.lit("boosted").alias("kind"), "id", "y", "p")
    squares = models.out_of_fold(rows, columns, 2, degree=2)
    again = models.recalibrate(squares.select("id", "y", "p"), "p", "y", F.col("id"), folds=2)
    both = boosted.unionByName(squares.select(F.lit("squares").alias("kind"), "id", "y", "p")).unionByName(again.select(F.lit("recalibrated").alias("kind"), "id", "y", "p"))
    return both.select("kind", "id", "y", F.round("p", 3).alias("p"))
