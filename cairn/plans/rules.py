"""Fixed rules, over records made of the cells of whole tables; every branch is reached."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.functions import scalars as S
from cairn.operators import rules as R
from cairn.operators.scoring import morans_p
from cairn.operators.windows import running_sum
from cairn.plans.base import query


def values(t, columns: str, rows: str):
    return t.spark.sql(f"SELECT * FROM VALUES {rows} AS v({columns})")


TODAY = "1998-06-30"
URLS = ("https://a.org/x", "ftp://a.org/x", "http://localhost", "")
STATUSES = ("active", "pending", "gone", "extended", "unknown")


def listed(n: str, values: tuple[str, ...]) -> str:
    """SQL for the value at a number."""
    return "CASE " + n + " " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(values)) + " END"


def pick(n, values: tuple[str, ...]):
    return F.get(F.array(*map(F.lit, values)), n.cast("int"))


@query(f"""
WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderdate::DATE AS d FROM orders),
r AS (SELECT k, CASE c % 5 WHEN 0 THEN 'NV' WHEN 1 THEN NULL ELSE 'TX' END AS state, CASE WHEN c % 7 > 0 THEN 25.0 + c % 30 END AS lat, {listed("k % 4", URLS)} AS url, {listed("k % 5", STATUSES)} AS status,
  CASE k % 3 WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '%Y-%m') ELSE strftime(d, '%m/%d/%Y') END AS enacted, CASE WHEN k % 2 = 0 THEN strftime(d + INTERVAL 200 DAY, '%Y-%m') ELSE '' END AS ends, CASE WHEN k % 6 = 0 THEN strftime(d + INTERVAL 400 DAY, '%Y-%m-%d') ELSE '' END AS checked,
  k % 4 + 1 AS severity, k % 7 = 0 AS contradicts, k % 14 = 0 AS snippet, CASE k % 11 WHEN 0 THEN 'data_center_only' WHEN 1 THEN 'all' ELSE 'renewables_only' END AS scope FROM o),
i AS (SELECT k, list_filter([
  CASE WHEN state = 'TX' AND lat NOT BETWEEN 25.8 AND 36.5 THEN 'COORD_OUTSIDE_STATE:HIGH:latitude/longitude' END, CASE WHEN url IN ('ftp://a.org/x', 'http://localhost') THEN 'SOURCE_URL_INVALID:HIGH:source_url' END,
  CASE WHEN status = 'gone' THEN 'STATUS_VOCAB:HIGH:status' END, CASE WHEN scope = 'all' THEN 'STATUS_VOCAB:HIGH:scope' END, CASE WHEN contains(enacted, '/') THEN 'DATE_UNPARSEABLE:LOW:date_enacted_iso' WHEN enacted > substr('{TODAY}', 1, length(enacted)) THEN 'DATE_IN_FUTURE:HIGH:date_enacted_iso' END,
  CASE WHEN status = 'pending' AND severity > 2 THEN 'SEVERITY_STATUS:MEDIUM:severity_score' END, CASE WHEN contradicts THEN CASE WHEN snippet THEN 'PRIMARY_SOURCE_CONTRADICTS:MEDIUM:primary_source_url' ELSE 'PRIMARY_SOURCE_CONTRADICTS:HIGH:primary_source_url' END END,
  CASE WHEN status IN ('active', 'extended') AND ends <> '' AND ends < '1998-06' AND NOT (checked <> '' AND substr(checked, 1, 7) >= ends) THEN 'END_DATE_PASSED:MEDIUM:current_end_date_iso' END, CASE WHEN scope = 'data_center_only' THEN 'SCOPE_DATA_CENTER_ONLY:HIGH:scope' END], lambda x: x IS NOT NULL) AS found FROM r),
p AS (SELECT k, list_filter([CASE WHEN k % 6 = 4 THEN 'STATUS_VOCAB:HIGH:outcome' END, CASE WHEN k % 6 = 3 THEN 'STATUS_VOCAB:HIGH:verification' END, CASE WHEN k % 6 IN (0, 2) AND k % 5 > 1 THEN 'CONFIRMED_NO_EVIDENCE:HIGH:outcome' END], lambda x: x IS NOT NULL) AS found FROM o)
SELECT 'r' || k AS id, array_to_string(found, ';') AS issues, contains(array_to_string(found, ';'), ':HIGH:') AS blocked FROM i UNION ALL SELECT 'p' || k, array_to_string(found, ';'), len(found) > 0 FROM p""")
def q_qc_codes(t):
    """A restriction and a project made of each order's numbers and dates; every code but LINK_MISSING, which q_missing_links has."""
    k, c, d = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate").cast("date")
    day = lambda x, form="yyyy-MM-dd": F.date_format(x, form)
    records = t.orders.select(
        F.concat(F.lit("r"), k).alias("id"), F.when(c % 5 == 0, "NV").when(c % 5 > 1, "TX").alias("state"), F.when(c % 7 > 0, 25.0 + c % 30).alias("latitude"), F.lit(-97.0).alias("longitude"), pick(k % 4, URLS).alias("source_url"), pick(k % 5, STATUSES).alias("status"),
        F.when(k % 3 == 0, day(d)).when(k % 3 == 1, day(d, "yyyy-MM")).otherwise(day(d, "MM/dd/yyyy")).alias("date_enacted_iso"), F.when(k % 2 == 0, day(F.date_add(d, 200), "yyyy-MM")).otherwise("").alias("current_end_date_iso"), F.when(k % 6 == 0, day(F.date_add(d, 400))).otherwise("").alias("status_checked_on"),
        (k % 4 + 1).alias("severity_score"), F.when(k % 7 == 0, "contradicts").otherwise("").alias("primary_source_verdict"), F.when(k % 14 == 0, "snippet").otherwise("opened").alias("primary_source_access"), F.when(k % 11 == 0, "data_center_only").when(k % 11 == 1, "all").otherwise("renewables_only").alias("scope"),
    )
    boxes = t.region.where("r_regionkey = 0").select(F.lit("TX").alias("state"), F.lit(25.8).alias("south"), F.lit(-106.7).alias("west"), F.lit(36.5).alias("north"), F.lit(-93.5).alias("east"))
    outcome = pick(k % 6, ("blocked_confirmed", "pending", "advanced_confirmed", "pending", "done", "blocked_unverified"))
    projects = t.orders.select(F.concat(F.lit("p"), k).alias("id"), outcome.alias("outcome"), F.when(k % 6 == 3, "maybe").otherwise("verified").alias("verification"), F.when(k % 5 == 0, "court_ruling:7").when(k % 5 == 1, "resolution of the board").when(k % 5 == 2, "news").alias("finality_evidence"))
    both = R.qc_findings(records, "restrictions", TODAY, boxes).select("id", "issues", "blocked").unionByName(R.qc_findings(projects, "contested_projects", TODAY).select("id", "issues", "blocked"))
    return both.select("id", F.array_join(F.transform("issues", lambda i: F.concat_ws(":", i["code"], i["severity"], i["field"])), ";").alias("issues"), "blocked")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 7 <> 0 AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def q_missing_links(t):
    """Orders whose customer isn't published; a blank link breaks nothing."""
    cases = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(F.col("o_custkey").cast("string")).alias("link"))
    return R.missing_links(cases, t.customer.where("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("id")), "link", "id").select("o_orderkey")


TECHS = ("solar", "hydro", "wind", "wind; solar", "battery_storage", "")
OUTCOMES = ("blocked_confirmed", "pending", "needs_review", "advanced_unverified", "odd", "advanced_confirmed", "restricted_conditional")


def projects(t):
    """A project of each order's numbers and dates, with its queue match."""
    k, d = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    day = lambda x, form="yyyy-MM-dd": F.date_format(x, form)
    return t.orders.select(
        k.alias("id"), pick(k % 6, TECHS).alias("technology"), F.when(k % 10 == 0, "Off-shore one").otherwise("Ridge").alias("project_name"), pick(k % 7, OUTCOMES).alias("outcome"),
        F.when(k % 4 == 0, day(d)).when(k % 4 == 1, day(d, "yyyy-MM")).when(k % 4 == 2, day(d, "yyyy")).otherwise("spring").alias("event_date_text"),
        F.when(k % 5 == 0, day(F.date_sub(d, 100))).when(k % 5 == 1, day(F.date_sub(d, 60), "yyyy-MM")).otherwise("").alias("first_request_date"), F.when(k % 3 == 0, "strong").otherwise("possible").alias("match"), F.when(k % 13 == 0, "withdrawn").otherwise("").alias("conflict"),
        F.when(k % 8 < 4, day(F.date_add(d, 50))).when(k % 8 < 6, day(F.date_add(d, 30), "yyyy-MM")).when(k % 8 == 6, day(d, "yyyy")).otherwise(day(F.date_sub(d, 200))).alias("resolution_date"),
        F.when(k % 9 == 0, "").when(k % 9 == 1, "big").when(k % 9 == 2, "1,250").when(k % 9 == 3, "-3").otherwise((k % 300 + 1).cast("string")).alias("capacity_mw"), F.when(k % 2 == 0, "strong").otherwise("").alias("facility_match"), (k % 50).cast("string").alias("facility_capacity_mw"), F.lit("42.5").alias("queue_capacity_mw"),
    )


LEDGER = f"""
WITH o AS (SELECT o_orderkey AS k, o_orderdate::DATE AS d FROM orders),
r AS (SELECT k, {listed("k % 6", ("solar", "", "wind", "wind", "battery_storage", ""))} AS tech, k % 10 = 0 AS offshore, {listed("k % 7", OUTCOMES)} AS outcome,
  CASE k % 4 WHEN 0 THEN d WHEN 1 THEN date_trunc('month', d)::DATE WHEN 2 THEN date_trunc('year', d)::DATE END AS event, CASE k % 4 WHEN 0 THEN 'day' WHEN 1 THEN 'month' WHEN 2 THEN 'year' END AS event_p,
  CASE k % 5 WHEN 0 THEN (d - INTERVAL 100 DAY)::DATE WHEN 1 THEN date_trunc('month', d - INTERVAL 60 DAY)::DATE END AS asked, CASE k % 5 WHEN 0 THEN 'day' WHEN 1 THEN 'month' END AS asked_p, k % 3 = 0 AS strong, k % 13 = 0 AS conflict,
  CASE WHEN k % 8 < 4 THEN (d + INTERVAL 50 DAY)::DATE WHEN k % 8 < 6 THEN date_trunc('month', d + INTERVAL 30 DAY)::DATE WHEN k % 8 = 7 THEN (d - INTERVAL 200 DAY)::DATE END AS done, k % 8 IN (4, 5) AS done_month,
  CASE WHEN k % 9 = 2 THEN 1250.0 WHEN k % 9 > 3 THEN k % 300 + 1.0 END AS own, CASE WHEN k % 2 = 0 AND k % 50 > 0 THEN k % 50 END AS plant FROM o),
s AS (SELECT *, CASE WHEN tech <> '' AND NOT (offshore AND tech = 'wind') THEN tech END AS priced, outcome IN ('blocked_confirmed', 'advanced_confirmed', 'restricted_conditional') AS decided, strong AND asked IS NOT NULL AS by_request, coalesce(event_p IN ('day', 'month'), false) AS by_event FROM r),
u AS (SELECT *, CASE WHEN by_request THEN asked WHEN by_event THEN event END AS start, CASE WHEN by_request THEN 'queue_request' WHEN by_event THEN 'event_date' END AS start_source, CASE WHEN (CASE WHEN by_request THEN asked_p ELSE event_p END) = 'month' THEN datediff('day', CASE WHEN by_request THEN asked ELSE event END, last_day(CASE WHEN by_request THEN asked ELSE event END)) ELSE 0 END AS slack,
  CASE WHEN decided THEN done ELSE DATE '2002-06-30' END AS stop, CASE WHEN decided AND done_month THEN datediff('day', done, last_day(done)) ELSE 0 END AS stop_slack,
  coalesce(own, plant, CASE WHEN strong THEN 42.5 END)::DOUBLE AS mw, CASE WHEN own IS NOT NULL THEN 'record' WHEN plant IS NOT NULL THEN 'federal_plant_inventory' WHEN strong THEN 'queue_request' END AS mw_source FROM s),
v AS (SELECT *, datediff('day', start, stop) AS span FROM u),
w AS (SELECT *, greatest(1, span - slack) AS low, span + stop_slack AS high, CASE WHEN priced IS NULL THEN 'technology_not_priced' WHEN outcome = 'needs_review' THEN 'outcome_needs_review' WHEN outcome = 'advanced_unverified' THEN 'outcome_unverified' WHEN NOT decided AND outcome <> 'pending' THEN 'outcome_needs_review'
  WHEN start IS NULL AND asked IS NOT NULL AND NOT strong THEN 'start_from_possible_queue_match' WHEN start IS NULL AND event_p = 'year' THEN 'start_year_precision' WHEN start IS NULL THEN 'no_start_date' WHEN start_source = 'queue_request' AND conflict THEN 'queue_match_conflict' WHEN stop IS NULL THEN 'no_end_date' WHEN span < 1 THEN 'nonpositive_span' WHEN mw IS NULL THEN 'no_capacity_mw' END AS reason FROM v)
"""


@query(LEDGER + "SELECT k AS id, priced, start_source, CAST(span AS INT) AS span, CAST(low AS INT) AS low, CAST(high AS INT) AS high, mw, mw_source, reason FROM w")
def q_withheld(t):
    """As of 2002-06-30; the ten reasons, and spans by the precision of their ends, over a project for each order."""
    return R.withheld(projects(t), "2002-06-30").select("id", F.col("priced_technology").alias("priced"), "start_source", F.col("span_days").alias("span"), F.col("span_days_low").alias("low"), F.col("span_days_high").alias("high"), "mw", "mw_source", F.col("withheld_reason").alias("reason"))


PHRASES = """('Prime farmland and bird habitat near the wells'), ('It was fired, in view of the vote'), ('views across the lake; GLARE, shadow flicker and noise'),
('property values, haul routes, airport radar, wetlands'), ('tribal sacred site, infrasound, thermal runaway'), ('ratepayers pay for decommissioning'), (NULL)"""
_TAGS = ", ".join(f"CASE WHEN regexp_matches(lower(text), '{p}') THEN '{n}' END" for n, p in sorted(R.CONCERNS.items()))


@query(f"""
WITH s AS (SELECT 'p' AS kind, text FROM (VALUES {PHRASES}) v(text) UNION ALL SELECT 'd', text FROM documents)
SELECT kind, array_to_string(list_filter([{_TAGS}], lambda x: x IS NOT NULL), ';') AS tags, count(*) AS n FROM s GROUP BY 1, 2""")
def q_concern_table(t):
    """the sixteen concerns, over phrases and all documents."""
    both = values(t, "text", PHRASES).select(F.lit("p").alias("kind"), "text").unionByName(t.documents.select(F.lit("d").alias("kind"), "text"))
    return both.select("kind", F.array_join(R.concerns(F.col("text")), ";").alias("tags")).groupBy("kind", "tags").agg(F.count("*").alias("n"))


@query("""
SELECT p_partkey, CASE m WHEN 0 THEN greatest(n * 1000 + 500, 2640) WHEN 1 THEN n * 10 WHEN 2 THEN (n + 0.5) * 5280 WHEN 4 THEN n * 10 ELSE 0 END::DOUBLE AS feet, CASE m WHEN 0 THEN 1 + (n % 9 + 1) / 10.0 WHEN 2 THEN n % 7 + 2 ELSE 0 END::DOUBLE AS height, CASE m WHEN 0 THEN 40 + n % 9 WHEN 3 THEN 30 + n ELSE 0 END::DOUBLE AS db
FROM (SELECT p_partkey, p_partkey % 6 AS m, p_size AS n FROM part)""")
def q_setbacks(t):
    """distances, not spacings; height multiples; the lowest noise limit; numbers from parts."""
    n, m = F.col("p_size"), F.col("p_partkey") % 6
    texts = [
        F.format_string("Setback of %d,500 feet or one-half mile, 1.%d times the total tip height; %d dBA by day and %d dBA at night", n, n % 9 + 1, n % 9 + 50, n % 9 + 40),
        F.format_string("%d,200 ft from another solar facility, %d ft from homes", n, n * 10),
        F.format_string("%d.5 miles and %dx the turbine height", n, n % 7 + 2),
        F.format_string("Limit %d db; towers %d00 feet from each other", n + 30, n),
        F.format_string("%d feet between the facility and any residence", n * 10),
    ]
    s = F.coalesce(*(F.when(m == k, text) for k, text in enumerate(texts)))
    return t.part.select("p_partkey", R.setback_feet(s).alias("feet"), R.height_multiple(s).alias("height"), R.least_decibels(s).alias("db"))


@query("""
SELECT p_partkey, CASE m WHEN 0 THEN 'ban_moratorium;setback' WHEN 1 THEN 'zoning' WHEN 2 THEN 'height;noise;standard' WHEN 3 THEN 'size' ELSE '' END AS families,
  CASE m WHEN 0 THEN 'hb' || n || ';sb' || k WHEN 1 THEN 'pa' || n WHEN 3 THEN 'ab' || n || '-2;sb' || n ELSE '' END AS bills FROM (SELECT p_partkey, p_partkey % 5 AS m, p_size AS n, p_partkey % 9000 + 1 AS k FROM part)""")
def q_mechanisms(t):
    """F29, with numbers from parts."""
    n, k, m = F.col("p_size"), F.col("p_partkey") % 9000 + 1, F.col("p_partkey") % 5
    told = F.when(m == 0, "Moratorium (use), setback/buffer").when(m == 1, "Overlay zoning, land use").when(m == 2, "noise,height , shadow flicker").when(m == 3, F.format_string("cap on %d acres", n))
    named = F.when(m == 0, F.format_string("H.B. %d and Senate Bill %d; HB %d", n, k, n)).when(m == 1, F.format_string("under Public Act %d", n)).when(m == 2, "none").when(m == 3, F.format_string("A.B. %d-2, SB%d", n, n)).otherwise("")
    return t.part.select("p_partkey", F.array_join(R.families(told), ";").alias("families"), F.array_join(R.bills(named), ";").alias("bills"))


@query("""
SELECT p_partkey, CASE m WHEN 0 THEN 1.0 WHEN 1 THEN round((length(k::VARCHAR) + 10.0) / (length(k::VARCHAR) + 11), 6) WHEN 3 THEN 0.666667 END::DOUBLE AS score, CASE m WHEN 0 THEN 'name' WHEN 1 THEN 'spelling' WHEN 3 THEN 'name' END AS basis FROM (SELECT p_partkey, p_partkey % 5 AS m, p_partkey AS k FROM part)""")
def q_name_scores(t):
    """the words of parts' names, turned round and among generic ones; spelling where words don't decide."""
    k, m = F.col("p_partkey").cast("string"), F.col("p_partkey") % 5
    turned = F.array_join(F.reverse(F.split("p_name", " ")), " ")
    a = F.when(m == 0, F.concat("p_name", F.lit(" Wind Farm"))).when(m == 1, F.concat(F.lit("Garrison x"), k, F.lit("j"))).when(m == 2, F.concat(F.lit("Prairie "), k)).when(m == 3, F.concat(F.lit("Big Oak c"), k))
    b = F.when(m == 0, F.concat(F.lit("The "), turned, F.lit(" Solar LLC"))).when(m == 1, F.concat(F.lit("Garrison x"), k, F.lit("t"))).when(m == 3, F.concat(F.lit("Big Oak v"), k, F.lit(" Run"))).otherwise("Ocean")
    return R.name_scores(t.part.select("p_partkey", a.alias("a"), b.alias("b")), "a", "b").select("p_partkey", F.round("score", 6).alias("score"), "basis")


@query("""
WITH z AS (SELECT c_nationkey AS a, avg(c_acctbal) - (SELECT avg(x) FROM (SELECT avg(c_acctbal) AS x FROM customer GROUP BY c_nationkey)) AS z FROM customer GROUP BY 1),
r AS (SELECT k, a, z, row_number() OVER (PARTITION BY k ORDER BY a) AS at, row_number() OVER (PARTITION BY k ORDER BY CASE WHEN k > 0 THEN md5('0:' || k || ':' || a) END NULLS FIRST, a) AS f FROM z, range(0, 200) g(k)),
m AS (SELECT x.k, x.a, y.z FROM r x JOIN r y ON x.k = y.k AND x.at = y.f), e AS (SELECT a.n_nationkey AS a, b.n_nationkey AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey <> b.n_nationkey),
l AS (SELECT k, e.a, avg(z) AS lag FROM e JOIN m ON m.a = e.b GROUP BY 1, 2), i AS (SELECT m.k, count(*) AS n, count(*) / count(lag) * sum(z * coalesce(lag, 0)) / sum(z * z) AS i FROM m LEFT JOIN l ON m.k = l.k AND m.a = l.a GROUP BY 1), o AS (SELECT * FROM i WHERE k = 0)
SELECT round(o.i, 6) AS morans_i, round((count(*) FILTER (WHERE i.i >= o.i - 1e-9) + 1) / 200.0, 6)::DOUBLE AS p, round(-1.0 / (o.n - 1), 6)::DOUBLE AS expected, o.n FROM o, i WHERE i.k > 0 GROUP BY o.i, o.n""")
def q_morans_p(t):
    """A39 with its permutation p."""
    from cairn.plans.joins import edges

    v = t.customer.groupBy(F.col("c_nationkey").alias("k")).agg(F.avg("c_acctbal").alias("x"))
    return morans_p(v, edges(t), "k", "x", permutations=199).select(*(F.round(c, 6).alias(c) for c in ("morans_i", "p", "expected")), "n")


@query("SELECT s_suppkey, CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS miles FROM supplier ORDER BY 2 NULLS LAST, 1 LIMIT 12")
def q_nearest_first(t):
    """Twelve nearest; the limit is the feature."""
    return R.nearest_first(t.supplier.select("s_suppkey", F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")).alias("miles")), "miles", "s_suppkey")


SHOWN = "CASE WHEN s_nationkey > 3 THEN s_name ELSE ' ' END"


@query(f"SELECT s_suppkey, {SHOWN} AS shown, row_number() OVER (ORDER BY nullif(trim({SHOWN}), '') DESC NULLS LAST, s_suppkey) AS place FROM supplier")
def q_toggled(t):
    """Blanks come last in a descending order too; the place in the order is a column of the result."""
    rows = t.supplier.select("s_suppkey", F.when(F.col("s_nationkey") > 3, F.col("s_name")).otherwise(" ").alias("shown"))
    placed = running_sum(rows, [R.blanks_last(rows, "shown", descending=True), F.col("s_suppkey")], F.lit(1))
    return placed.select("s_suppkey", "shown", (F.col("__below") + 1).alias("place"))


@query("""
SELECT o_orderkey, CASE m WHEN 0 THEN CASE WHEN n = 1 THEN 'Sabin 2025 (not in 2026 edition)' ELSE 'Sabin 2026' END WHEN 1 THEN 'Moratorium Nation' WHEN 2 THEN 'NREL' WHEN 3 THEN 'review queue' ELSE 'other' END AS family,
  CASE n WHEN 0 THEN 'A ban' WHEN 1 THEN 'x y' WHEN 2 THEN NULL ELSE 'z' || o_orderkey END AS shown, CASE v WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS rank, CASE v WHEN 0 THEN 'verified' WHEN 1 THEN 'located' ELSE 'unverified' END AS name
FROM (SELECT o_orderkey, o_orderkey % 5 AS m, o_orderkey % 4 AS n, o_orderkey % 3 AS v FROM orders)""")
def q_record_functions(t):
    """The functions that ad-hoc SQL over records calls, over a record for each order."""
    S.register_sql_functions(t.spark)
    k = F.col("o_orderkey")
    texts = F.when(k % 4 == 0, F.concat(F.lit("A ban [VERIFY number at "), k, F.lit("]"))).when(k % 4 == 1, "x [VERIFY a] y").when(k % 4 == 2, " [VERIFY]").otherwise(F.concat(F.lit("z"), k))
    iid = F.concat(pick(k % 5, ("sabin:", "mn:", "nrel:", "queue:", "q")), k)
    t.orders.select(k, iid.alias("iid"), F.when(k % 4 == 1, "2025-06").otherwise("2026-01").alias("edition"), texts.alias("s"), F.when(k % 3 == 0, "verified").when(k % 3 == 1, "located").alias("v")).createOrReplaceTempView("records_by_functions")
    return t.spark.sql("SELECT o_orderkey, source_family(iid, edition) AS family, reader_text(s) AS shown, verification_rank(v) AS rank, verification_name(verification_rank(v)) AS name FROM records_by_functions")
