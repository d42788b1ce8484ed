"""The cost ledger, rate card, scenarios and sensitivity, at rates made of the parts table."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.operators import cost
from cairn.plans.base import query
from cairn.plans.rules import LEDGER, projects

AS_OF = "2002-06-30"


def anchors(t):
    """A registry of rates from the extremes of sizes and prices of parts, a third of them for each technology."""
    n = F.col("p_partkey") % 3
    tech = F.when(n == 0, "solar").when(n == 1, "wind").otherwise("battery_storage")
    lo, hi = F.col("lo").cast("double"), F.col("hi").cast("double")
    own = t.part.groupBy(tech.alias("tech")).agg(F.min("p_size").alias("lo"), F.max("p_size").alias("hi"), (F.min("p_retailprice") * 1000).alias("plo"), (F.max("p_retailprice") * 1000).alias("phi"))
    entry = lambda base, low, high: F.struct(F.lit(base).alias("base"), low.alias("value_low"), high.alias("value_high"))
    each = [entry("capex_per_mw", F.col("plo"), F.col("phi")), entry("fixed_om_kw_year", lo, hi)]
    energy = [entry("capacity_factor", F.lit(0.2), 0.25 + hi / 1000), entry("ppa_price_mwh", 20 + lo, 30 + hi)]
    listed = F.when(F.col("tech") == "battery_storage", F.array(*each, entry("capacity_price_kw_month", 4 + lo, 6 + hi))).otherwise(F.array(*each, *energy))
    mine = own.select("tech", F.inline(listed)).select(F.concat_ws("_", "base", "tech").alias("anchor_id"), "value_low", "value_high", F.when(F.col("tech") == "solar", "2001-01-01").otherwise("2030-01-01").alias("reverify_by"))
    m = F.col("m").cast("double")
    shared = F.array(entry("construction_escalation", F.lit(0.02), 0.02 + m / 1000), entry("project_life_years", F.lit(20.0), 20 + m / 5), entry("carrying_rate", F.lit(0.05), 0.05 + m / 1000), entry("predevelopment_share", F.lit(0.01), 0.01 + m / 1000), entry("credit_rate_wind", F.lit(0.3), F.lit(0.3)))
    all_ = t.part.groupBy().agg(F.max("p_size").alias("m")).select(F.inline(shared)).select(F.col("base").alias("anchor_id"), "value_low", "value_high", F.lit("2030-01-01").alias("reverify_by"))
    return mine.unionByName(all_).withColumn("confidence", F.when(F.col("anchor_id").startswith("c"), "published").otherwise("assumption")).withColumn("source_url", F.lit("https://a.org/rates"))


RATES = """p AS (SELECT CASE p_partkey % 3 WHEN 0 THEN 'solar' WHEN 1 THEN 'wind' ELSE 'battery_storage' END AS tech, min(p_size)::DOUBLE AS lo, max(p_size)::DOUBLE AS hi, min(p_retailprice) * 1000 AS cx0, max(p_retailprice) * 1000 AS cx1 FROM part GROUP BY 1),
n AS (SELECT tech, cx0, cx1, lo AS om0, hi AS om1, 0.2::DOUBLE AS cf0, 0.25::DOUBLE + hi / 1000 AS cf1, 20 + lo AS pp0, 30 + hi AS pp1, 4 + lo AS cp0, 6 + hi AS cp1, 0.02::DOUBLE AS es0, 0.02::DOUBLE + m / 1000 AS es1, 20::DOUBLE AS li0, 20 + m / 5 AS li1, 0.05::DOUBLE AS ra0, 0.05::DOUBLE + m / 1000 AS ra1, 0.01::DOUBLE AS sh0, 0.01::DOUBLE + m / 1000 AS sh1
  FROM p, (SELECT max(p_size)::DOUBLE AS m FROM part))"""


def earned(mw: str, cf: str, pp: str, cp: str) -> str:
    return f"CASE WHEN tech = 'battery_storage' THEN {mw} * 1000 * {cp} * 12 ELSE {mw} * {cf} * 8760 * {pp} END"


def given_up(mw: str, revenue: str, om: str, life: str, rate: str, months: str) -> str:
    return f"greatest(0, {revenue} - {mw} * 1000 * {om}) * (1 - power(1 + {rate}, -{life})) / {rate} * (1 - power(1 + {rate}, -({months} / 12)))"


def slipped(mw: str, m0: str, m1: str) -> dict[str, tuple[str, str]]:
    r0, r1 = earned(mw, "cf0", "pp0", "cp0"), earned(mw, "cf1", "pp1", "cp1")
    e = tuple(f"({mw} * cx{i} * es{i} * {m} / 12)" for i, m in ((0, m0), (1, m1)))
    d = tuple(f"{pick}({', '.join(given_up(mw, r, f'om{1 - i}', f'li{i}', rate, m) for rate in ('ra0', 'ra1'))})" for i, pick, r, m in ((0, "least", f"({r0})", m0), (1, "greatest", f"({r1})", m1)))
    return {"escalation": e, "deferral_cost": d, "delay_cost": tuple(f"({a} + {b})" for a, b in zip(e, d, strict=True)), "gross_revenue_deferred": (f"(({r0}) * {m0} / 12)", f"(({r1}) * {m1} / 12)")}


def ends(name: str, values: tuple[str, str], when: str = "true") -> str:
    return ", ".join(f"CASE WHEN {when} THEN CAST(round_even({v}, 0) AS BIGINT) END AS {name}_{end}" for v, end in zip(values, ("low", "high"), strict=True))


_S = slipped("mw", "(low / 30.44::DOUBLE)", "(high / 30.44::DOUBLE)")
_BLOCKED = "reason IS NULL AND outcome = 'blocked_confirmed'"
_BUILT = "reason IS NULL AND outcome <> 'blocked_confirmed'"
_RISK = ("(mw * cx0 * sh0)", "(mw * cx1 * sh1)")


@query(
    LEDGER
    + f""", {RATES}
SELECT k AS id, reason, {ends("capex", ("mw * cx0", "mw * cx1"), "reason IS NULL")}, {ends("escalation_cost", _S["escalation"], _BUILT)}, {ends("block_sunk_cost", _RISK, _BLOCKED)}, {ends("deferred_revenue_exposure", _S["gross_revenue_deferred"], _BUILT)}, {ends("deferral_npv_cost", _S["deferral_cost"], _BUILT)},
  {ends("total_economic_cost", tuple(f"CASE WHEN outcome = 'blocked_confirmed' THEN {a} ELSE {b} END" for a, b in zip(_RISK, _S["delay_cost"], strict=True)), "reason IS NULL")},
  CASE WHEN reason IS NULL THEN CASE WHEN priced <> 'solar' THEN '' WHEN outcome = 'blocked_confirmed' THEN 'capex_per_mw_solar' ELSE 'capacity_factor_solar;capex_per_mw_solar;fixed_om_kw_year_solar;ppa_price_mwh_solar' END END AS stale_anchors FROM (SELECT * EXCLUDE (tech) FROM w) w LEFT JOIN n ON n.tech = priced"""
)
def q_cost_ledger(t):
    """The figures of every project that isn't withheld."""
    figures = ("capex", "escalation_cost", "block_sunk_cost", "deferred_revenue_exposure", "deferral_npv_cost", "total_economic_cost")
    return cost.ledger(projects(t), anchors(t), AS_OF).select("id", F.col("withheld_reason").alias("reason"), *(f"{f}_{end}" for f in figures for end in ("low", "high")), "stale_anchors")


_ONE = slipped("1", "1::DOUBLE", "1::DOUBLE")


@query(f"""
WITH {RATES}
SELECT tech AS technology, {ends("capex_per_mw", ("cx0", "cx1"))}, {ends("escalation_per_mw_month", _ONE["escalation"])}, {ends("deferral_cost_per_mw_month", _ONE["deferral_cost"])}, {ends("delay_cost_per_mw_month", _ONE["delay_cost"])}, {ends("gross_revenue_deferred_per_mw_month", _ONE["gross_revenue_deferred"])},
  {ends("capital_at_risk_per_mw", ("cx0 * sh0", "cx1 * sh1"))}, {ends("credit_at_deadline_per_mw", ("cx0 * 0.3::DOUBLE", "cx1 * 0.3::DOUBLE"), "tech = 'wind'")}, CASE WHEN tech = 'solar' THEN 'capacity_factor_solar;capex_per_mw_solar;fixed_om_kw_year_solar;ppa_price_mwh_solar' ELSE '' END AS stale_anchors FROM n""")
def q_rate_card(t):
    """R19."""
    return cost.rate_card(anchors(t), AS_OF, credit=("wind", "solar"))


@query(f"""
WITH {RATES}
SELECT tech AS technology, 100::DOUBLE AS mw, CAST(months AS INT) AS slip_months, {", ".join(ends(k, v) for k, v in slipped("100", "months::DOUBLE", "months::DOUBLE").items())} FROM n, (SELECT unnest([3, 6, 12, 18, 24]) AS months)""")
def q_scenarios(t):
    """Five slips of a project of 100 MW."""
    return cost.scenarios(anchors(t), AS_OF)


_IDS = {"capex_per_mw": "cx", "construction_escalation": "es", "fixed_om_kw_year": "om", "project_life_years": "li", "capacity_factor": "cf", "ppa_price_mwh": "pp", "capacity_price_kw_month": "cp", "carrying_rate": "ra"}
_SHARED = ("construction_escalation", "project_life_years", "carrying_rate")


def _varied(base: str) -> str:
    short = _IDS[base]
    at = {end: ", ".join(f"{f'{s}{end}' if s == short else f'({s}0 + {s}1) / 2'} AS {s}0, {f'{s}{end}' if s == short else f'({s}0 + {s}1) / 2'} AS {s}1" for s in _IDS.values()) for end in (0, 1)}
    delay = slipped("100", "12::DOUBLE", "12::DOUBLE")["delay_cost"][0]
    where = "tech = 'battery_storage'" if base == "capacity_price_kw_month" else "tech <> 'battery_storage'" if base in ("capacity_factor", "ppa_price_mwh") else "true"
    name = f"'{base}'" if base in _SHARED else f"'{base}_' || tech"
    kind = "published" if base.startswith("c") else "assumption"
    low, high = (f"(SELECT tech, {delay} AS v FROM (SELECT tech, {at[end]} FROM n))" for end in (0, 1))
    return f"SELECT tech AS technology, {name} AS anchor_id, '{kind}' AS confidence, CAST(round_even(a.v, 0) AS BIGINT) AS delay_cost_at_anchor_low, CAST(round_even(b.v, 0) AS BIGINT) AS delay_cost_at_anchor_high, CAST(round_even(abs(b.v - a.v), 0) AS BIGINT) AS swing FROM {low} a JOIN {high} b USING (tech) WHERE {where}"


@query(f"WITH {RATES} " + " UNION ALL ".join(map(_varied, _IDS)))
def q_rate_sensitivity(t):
    """One rate at its ends, the others at their middles."""
    return cost.anchor_sensitivity(anchors(t), AS_OF)


@query("SELECT CASE p_partkey % 4 WHEN 0 THEN 'a' || p_partkey WHEN 1 THEN 'b' || p_partkey WHEN 2 THEN 'c' || p_partkey END AS anchor_id, CASE p_partkey % 4 WHEN 0 THEN 'needs 0 <= value_low <= value_high' WHEN 1 THEN 'published anchor needs a source_url' WHEN 2 THEN 'confidence must be published or assumption' END AS problem FROM part WHERE p_partkey % 4 < 3")
def q_anchor_problems(t):
    """Parts as further entries of the registry, each wrong in one way; the registry itself is whole."""
    n, k = F.col("p_partkey") % 4, F.col("p_partkey").cast("string")
    more = t.part.where("p_partkey % 4 < 3").select(
        F.concat(F.when(n == 0, "a").when(n == 1, "b").otherwise("c"), k).alias("anchor_id"), F.when(n == 0, 2.0).otherwise(1.0).alias("value_low"), F.lit(1.5).alias("value_high"), F.lit("2030-01-01").alias("reverify_by"),
        F.when(n == 1, "published").when(n == 2, "guess").otherwise("assumption").alias("confidence"), F.lit(None).cast("string").alias("source_url"),
    )
    return cost.anchor_problems(anchors(t).unionByName(more))
