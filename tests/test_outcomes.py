"""Severity, outcomes, worklists and figures by hand-made rows."""

import pytest
from pyspark.sql import functions as F

from cairn.functions import scalars as S
from cairn.operators import cost, matching, promotion, sets
from cairn.operators import outcomes as O


def test_severity_names_its_basis_and_driver(spark):
    def judge(types, tech, status, text):
        df = spark.createDataFrame([(types, tech, status, text)], "types array<string>, tech string, status string, text string")
        return tuple(df.select(*O.restriction_severity(*(F.col(c) for c in df.columns))).first())

    assert judge(["setback", "ban"], "solar", "pending", "") == (2, "ban/prohibition; capped at 2 (pending)", "ban")
    assert judge(["moratorium", "setback"], "solar", "pending", "1,500 feet") == (2, "solar setback 1500 ft; capped at 2 (pending)", "setback")
    assert judge(["setback", "height_limit"], "wind", "active", "5,250 feet and 1.1 times the height") == (3, "wind setback 5250 ft / 1.1x height", "setback")
    assert judge(["setback", "height_limit"], "wind", "active", "500 feet") == (3, "wind height limit", "height_limit")
    assert judge(["noise_limit"], "wind", "active", "35 dBA") == (3, "wind noise limit 35 dBA", "noise_limit")
    assert judge(["siting_standard", "size_cap"], "wind", "active", None) == (2, "restricting mechanism (default)", "size_cap")


def test_rulings_confirm_the_first_that_fits(spark):
    projects = spark.createDataFrame([(1, "blocked_unverified", False), (2, "advanced_unverified", True), (3, "advanced_unverified", True), (4, "pending", None)], "k int, outcome string, litigated boolean")
    cases = spark.createDataFrame([(1, 2, "B", "ruled_for_opposition"), (1, 1, "A", "ruled_for_opposition"), (1, 0, "Z", "ruled_for_developer"), (2, 1, None, "ruled_for_developer"), (3, 1, "C", "settled")], "k int, seq int, case_name string, case_status string")
    got = {r.k: (r.outcome, r.finality_evidence, r.severity) for r in O.finalize_outcomes(projects, cases, "k").collect()}
    assert got == {1: ("blocked_confirmed", "court_ruling: A", 4), 2: ("advanced_confirmed", "court_ruling:", 3), 3: ("advanced_unverified", "outcome_label_only", 3), 4: ("pending", "none", 2)}


def test_impacts_and_siblings(spark):
    places = spark.createDataFrame([("a", 1, 3), ("b", 1, 1), ("c", 2, 1), ("d", 3, 3), ("e", 3, 4), ("d", 3, 2)], "instrument_id string, node int, severity int")
    assert {r.instrument_id: r.county_impact for r in O.county_impacts(places).collect()} == {"a": "sole_severe", "b": "", "c": "sole_record", "d": "", "e": ""}
    rows = spark.createDataFrame([("v", 1, "p", "wind", True, "u1"), ("w", 2, "p", "wind", True, "u2"), ("x", 3, "p", "wind", False, ""), ("v", 4, "p", "wind", False, ""), ("y", 5, "p", "solar", None, "")], "instrument_id string, seq int, place string, technology string, verified boolean, url string")
    assert [tuple(r) for r in O.sibling_sources(rows).collect()] == [("x", "v", "u1")]


def test_capacities(spark):
    texts = {"160": [(160, 160)], "35-40 MW, then 1.2 GW": [(35, 40), (1200, 1200)], "22 turbines of 3 MW": [], "4,700 kW to 5 MW": [(4.7, 4.7), (5, 5)], "0 MW": [], "2 – 3": [(2, 3)], None: []}
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for r in df.select("s", S.capacities(F.col("s")).alias("c"), S.capacity_agrees(F.col("s"), F.lit(42.0)).alias("agrees"), S.capacity_differs(F.col("s"), F.lit(42.0)).alias("differs")).collect():
        assert [(round(x.low, 9), round(x.high, 9)) for x in r.c] == texts[r.s]
        assert r.agrees == (r.s == "35-40 MW, then 1.2 GW") and r.differs == (r.s in ("160", "2 – 3", "4,700 kW to 5 MW"))


def test_review_is_kept(spark):
    new = spark.createDataFrame([(1, "n1", None, "todo"), (2, "n2", "c", "todo")], "k int, name string, court string, status string")
    old = spark.createDataFrame([(1, "o", "x", "todo"), (1, "o", " ", "done"), (3, "o3", "y", "todo"), (4, "o4", "", "todo"), (5, "o5", None, "done"), (6, "o6", None, "")], "k int, name string, court string, status string")
    got = sorted(tuple(r) for r in sets.keep_review(new, old, "k", ["court", "status"], "status", ("todo",)).fillna("-").collect())
    assert got == [(1, "n1", "-", "done"), (1, "n1", "x", "todo"), (2, "n2", "c", "todo"), (3, "o3", "y", "todo"), (5, "o5", "-", "done")]


def test_greedy_dedupe_is_the_same_in_rounds_and_in_one_task(spark):
    rows = [(k, f"u{k * 7 % 40}" if k % 5 else None, f"h{k * 3 % 50}", k) for k in range(200)]
    df = spark.createDataFrame(rows, "n int, u string, h string, x int")
    seen, wanted = set(), set()
    for n, u, h, _ in rows:
        mine = {("u", u), ("h", h)} - {("u", None)}
        if not mine & seen:
            seen |= mine
            wanted.add(n)
    for remainder in (0, 50, 10**6):
        assert {r.n for r in matching.greedy_dedupe(df, ["u", "h"], "n", remainder).collect()} == wanted


ANCHORS = [
    ("capex_per_mw_solar", 1000.0, 2000.0), ("capex_per_mw", 3000.0, 4000.0), ("construction_escalation", 0.02, 0.04), ("fixed_om_kw_year", 0.01, 0.02), ("project_life_years", 20.0, 30.0), ("capacity_factor", 0.2, 0.3),
    ("ppa_price_mwh", 20.0, 30.0), ("capacity_price_kw_month_battery_storage", 5.0, 8.0), ("carrying_rate", 0.05, 0.1), ("predevelopment_share", 0.01, 0.02),
]


@pytest.fixture(scope="module")
def anchors(spark):
    return spark.createDataFrame([(*a, "assumption", "2020-01-01" if a[0] == "carrying_rate" else "2030-01-01", None) for a in ANCHORS], "anchor_id string, value_low double, value_high double, confidence string, reverify_by string, source_url string")


def npv(revenue, om, life, rate, months, mw=10):
    net = max(0.0, revenue - mw * 1000 * om)
    return net * (1 - (1 + rate) ** -life) / rate * (1 - (1 + rate) ** -(months / 12))


def test_ledger_figures(spark, anchors):
    rows = [("a", "solar", "blocked_confirmed", "2024-01-01", "2024-04-01", "10"), ("b", "solar", "pending", "2024-01-01", "", "10"), ("c", "battery_storage", "pending", "2024-01-01", "", "10"), ("d", "solar", "pending", "2024-01-01", "", "")]
    df = spark.createDataFrame(rows, "id string, technology string, outcome string, event_date_text string, resolution_date string, capacity_mw string")
    got = {r.id: r for r in cost.ledger(df, anchors, "2024-06-30").collect()}
    a, b, c, d = (got[k] for k in "abcd")
    assert (a.capex_low, a.capex_high, a.block_sunk_cost_low, a.total_economic_cost_high, a.escalation_cost_low, a.stale_anchors) == (10_000, 20_000, 100, 400, None, "")
    months = 181 / 30.44
    assert b.escalation_cost_low == round(10_000 * 0.02 * months / 12) and b.stale_anchors == "carrying_rate" and b.block_sunk_cost_low is None
    low = min(npv(10 * 0.2 * 8760 * 20, 0.02, 20, r, months) for r in (0.05, 0.1))
    high = max(npv(10 * 0.3 * 8760 * 30, 0.01, 30, r, months) for r in (0.05, 0.1))
    assert (b.deferral_npv_cost_low, b.deferral_npv_cost_high) == (round(low), round(high)) and b.total_economic_cost_low == round(10_000 * 0.02 * months / 12 + low)
    assert c.deferred_revenue_exposure_high == round(10 * 1000 * 8 * 12 * months / 12) and c.capex_low == 30_000
    assert d.withheld_reason == "no_capacity_mw" and d.capex_low is None and d.stale_anchors is None


def test_card_scenarios_and_sensitivity(anchors):
    card = {r.technology: r for r in cost.rate_card(anchors, "2024-06-30").collect()}
    assert card["solar"].capex_per_mw_low == 1000 and card["wind"].capex_per_mw_low == 3000 and card["wind"].capital_at_risk_per_mw_high == 80 and card["solar"].credit_at_deadline_per_mw_low is None
    grid = cost.scenarios(anchors, "2024-06-30").collect()
    assert len(grid) == 15 and all(r.delay_cost_low <= r.delay_cost_high for r in grid)
    moved = {(r.technology, r.anchor_id): r for r in cost.anchor_sensitivity(anchors, "2024-06-30").collect()}
    assert ("solar", "capex_per_mw_solar") in moved and ("wind", "capex_per_mw") in moved and ("wind", "capacity_price_kw_month_battery_storage") not in moved and ("battery_storage", "capacity_factor") not in moved
    one = moved["wind", "construction_escalation"]
    assert one.swing == pytest.approx(100 * 3500 * 0.02, abs=1)


def test_a_registry_with_gaps(spark, anchors):
    bad = spark.createDataFrame([("capex_per_mw", 2.0, 1.0, "guess", "soon", None), ("x", 1.0, 2.0, "published", "2030-01-01", "a.org")], anchors.schema)
    got = {(r.anchor_id, r.problem) for r in cost.anchor_problems(anchors.where("anchor_id <> 'predevelopment_share'").unionByName(bad)).collect()}
    assert got == {("capex_per_mw", "needs 0 <= value_low <= value_high"), ("capex_per_mw", "confidence must be published or assumption"), ("capex_per_mw", "reverify_by must be a day"), ("capex_per_mw", "duplicate id"), ("x", "published anchor needs a source_url"), *((f"predevelopment_share_{t}", "missing") for t in ("solar", "wind", "battery_storage"))}
    assert cost.anchor_problems(anchors).count() == 0


QUEUE = "queue_id int, access string, mechanisms string, technology string, status string, end_date string, severity_score string, mechanism_detail string, description string, state string, source_url string"


def queued(spark, *rows):
    base = {"access": "opened", "mechanisms": "setback", "technology": "wind", "status": "active", "end_date": "", "severity_score": "", "mechanism_detail": "", "description": "d", "state": "VA", "source_url": "https://a.org"}
    return spark.createDataFrame([(k, *(base | given).values()) for k, given in enumerate(rows)], QUEUE)


def test_promotion_says_what_is_missing(spark):
    cases = [
        ({}, None), ({"access": "snippet"}, "access is snippet; the source has to be opened or archived first"), ({"mechanisms": "setback; fence"}, "unknown mechanism(s) fence"), ({"mechanisms": " ; "}, "mechanisms is blank"), ({"status": "lifted"}, "status lifted: the instrument is no longer in force"),
        ({"end_date": "2024"}, "end_date must be YYYY-MM or YYYY-MM-DD"), ({"technology": "wind; hydro"}, "technology must be among solar, wind, battery_storage"), ({"technology": "solar;wind", "mechanisms": "ban (wind)"}, "no mechanism applies to solar"),
        ({"severity_score": "4"}, "typed severity_score 4 conflicts with the computed 2 for wind"), ({"state": " ", "source_url": "a.org"}, "missing state, source_url (not http(s))"), ({"status": None}, "status '' is not one of the vocabulary"),
    ]
    got = {r.queue_id: r.problem for r in promotion.judged(queued(spark, *(c for c, _ in cases))).collect()}
    assert got == {k: p for k, (_, p) in enumerate(cases)}


def test_each_technology_is_scored_on_its_own_mechanisms(spark):
    rows = promotion.promoted(queued(spark, {"technology": "solar; battery_storage;wind", "mechanisms": "setback; ban (storage); height limit (wind+solar)", "mechanism_detail": "1,200 feet"})).collect()
    assert {r.technology: (r.restriction_type, r.severity_score, r.mechanisms) for r in rows} == {"solar": ("setback", 3, "setback, height limit (wind+solar)"), "battery_storage": ("ban", 4, "setback, ban (storage)"), "wind": ("height_limit", 3, "setback, height limit (wind+solar)")}


def test_promoting_again_changes_only_what_changed(spark):
    seeds = promotion.promoted(queued(spark, {}, {"technology": "wind;solar"}, {}, {}))
    later = queued(spark, {"mechanisms": "ban"}, {"technology": "solar;battery_storage"}, {"status": "expired"}, {"access": "snippet", "mechanisms": "ban"})
    got = {(r.queue_id, r.technology, r.kind, r.column) for r in promotion.resynced(seeds, later).collect()}
    assert {(q, t, k) for q, t, k, _ in got} == {(0, "wind", "changed"), (1, "wind", "removed"), (1, "battery_storage", "added"), (2, "wind", "removed")}
    assert {c for q, _, _, c in got if q == 0} == {"restriction_type", "severity_score", "severity_basis", "mechanisms"}


def test_negative_and_adjacency_worklists(spark):
    requests = spark.createDataFrame([(1, "2024-01-01"), (1, "2024-02-01"), (2, "2024-01-01"), (3, "2024-01-01"), (4, "2024-01-01"), (None, "2024-01-01")], "node int, day string")
    checks = spark.createDataFrame([(2, "2024-03-01"), (2, "2020-01-01"), (3, "2022-01-01")], "node int, checked_on string")
    got = O.negative_worklist(requests, checks, spark.createDataFrame([(4,)], "node int"), "2024-06-30").collect()
    assert sorted((r.node, r.reason, r.requests, str(r.last_requested)) for r in got) == [(1, "no check on record", 2, "2024-02-01"), (3, "check of 2022-01-01 is stale (more than 365 days old)", 1, "2024-01-01")]
    instruments = spark.createDataFrame([("a", 1, "2024-01-01"), ("b", 5, "2020-01-01"), ("c", 6, None)], "instrument_id string, node int, enacted string").withColumn("enacted", F.col("enacted").cast("date"))
    edges = spark.createDataFrame([(1, 2), (1, 3), (1, 5), (5, 7), (6, 8)], "a int, b int")
    assert [(r.node, r.instrument_id) for r in O.adjacency_worklist(instruments, edges, spark.createDataFrame([(3,)], "node int"), "2024-06-30").collect()] == [(2, "a")]
