"""The record score by hand: points, terms, stacking, caps of a state, approvals and priors."""

import pytest
from pyspark.sql import functions as F

from cairn.operators import record_score as R

ROW = "instrument_id string, seq int, node int, technology string, severity int, restriction_type string, currency string, jurisdiction_type string, jurisdiction string, verified boolean, term string, extensions int, months_in_force double, drafting string"
RULE = "state string, label string, technology string, ceiling int, binds string, bounds boolean"


def row(i, node, tech="solar", severity=4, seq=0, kind="County", currency="in_force", where="Here", verified=False, term="", ext=0, months=0.0, drafting=""):
    return (i, seq, node, tech, severity, "t", currency, kind, where, verified, term, ext, months, drafting)


def scores(spark, rows, rules=(), projects=(), places=None):
    nodes = places or [(n, "S", None, False, 0.0) for n in sorted({r[2] for r in rows})]
    got = R.record_scores(spark.createDataFrame(list(rows), ROW), spark.createDataFrame(nodes, "node int, state string, profile double, checked boolean, organized double"), spark.createDataFrame(list(projects), "node int, outcome string"), spark.createDataFrame(list(rules), RULE))
    return {r.node: r for r in got.collect()}


def test_points_terms_and_stack(spark):
    rows = [
        row("a", 1), row("b", 2, severity=3), row("c", 2, severity=2), row("d", 3, kind="Town"), row("e", 4, tech="solar", severity=2), row("e", 4, tech="wind", severity=3, seq=1),
        row("f", 5, term="temporary", ext=1, months=12.0), row("g", 6, term="temporary", ext=9, drafting="active"), row("h", 7, term="temporary", severity=2), row("i", 8, currency="pending"), row("j", 9, currency=""),
        *(row(f"k{n}", 10, kind="Town") for n in range(9)),
    ]
    points = {n: r.record_points for n, r in scores(spark, rows).items()}
    assert points == {1: 60.0, 2: 38.0, 3: 21.0, 4: 38.5, 5: 48.0, 6: 45.6, 7: 12.0, 8: 18.0, 9: 36.0, 10: 30.0}


def test_an_instrument_of_several_rows(spark):
    rows = [row("a", 1, "wind", 2, 3, currency="", kind="", where="", term="", drafting="active"), row("a", 1, "solar", 3, 5, currency="pending", kind="Town", where="X", term="temporary", ext=2), row("a", 2, "wind", 3, 9, currency="in_force", kind="County", where="Y", verified=True, drafting="adopted")]
    r = R.instruments(spark.createDataFrame(rows, ROW)).first()
    assert (r.technologies, r.severity, r.currency, r.jurisdiction_type, r.jurisdiction, r.verified, r.term, r.extensions, r.drafting) == (["solar", "wind"], 3, "pending", "Town", "X", True, "temporary", 2, "adopted")


def test_projects_add_and_take_away_but_not_below_a_ban(spark):
    rows = [row("a", 1, severity=3), row("b", 2)]
    done = scores(spark, rows, projects=[(1, "blocked_confirmed"), (1, "advanced_confirmed"), (2, "advanced_confirmed"), (2, "advanced_confirmed"), (3, "x")])
    assert done[1].record_points == 41.0 and done[2].record_points == 60.0 and done[1].evidence_weight == 0.9 and done[1].projects == 2


def test_a_state_s_law_caps_technologies_and_merges_what_it_bounds(spark):
    rules = [("S", "law", "solar", 2, "both", True), ("S", "law", "wind", 1, "county", True), ("T", "other", "solar", 1, "both", True)]
    rows = [row("a", 1), row("a", 1, "battery_storage", seq=1), row("b", 2, "wind"), row("c", 3, "wind", kind="Town"), row("d", 4), row("e", 4, severity=3), row("f", 4, "wind", severity=1)]
    got = scores(spark, rows, rules)
    assert got[1].record_points == 61.2 and got[1].local_points == 66.0  # storage in full, solar capped at 2
    assert got[2].record_points == 3.0 and got[2].preemption_points == 57.0
    assert got[3].record_points == 21.0  # the rule binds counties only
    assert got[4].record_points == pytest.approx(12.3) and got[4].instruments == 3  # three capped rules of one county count as one
    placed = R.instruments(spark.createDataFrame(rows, ROW)).withColumns({"county_wide": F.lit(True), "state": F.lit("S"), "node": F.lit(1)})
    by = {r.instrument_id: (r.severity, r.preempted_by, r.bounded) for r in R.preempted(placed, spark.createDataFrame(rules, RULE)).collect()}
    assert by["a"] == (4, ["law"], False) and by["b"] == (1, ["law"], True) and by["d"] == (2, ["law"], True)


def test_priors_tiers_and_bases(spark):
    places = [(n, "S", float(n), n == 19, 0.0) for n in range(20)] + [(20, "S", None, False, 0.0)]
    got = scores(spark, [row("a", 18, verified=True), row("b", 0, severity=3)], places=places)
    assert got[18].profile_decile == 10 and got[18].profile_points == 30.0 and got[18].combined == 57.0 and got[18].tier == "restrictive"
    assert (got[19].basis, got[19].combined, got[19].tier) == ("negative_check", 15.0, "mixed")
    assert (got[1].basis, got[1].tier, got[1].combined) == ("profile_only", "no_record", 17.5) and got[20].combined == 0 and got[20].profile_decile is None
    assert got[0].evidence_weight == 0.7 and got[0].combined == 29.75
    assert sorted(r.combined_decile for r in got.values()).count(10) == 2


def test_instruments_are_gathered_once_for_both_scores(spark, monkeypatch):
    written, cut = [], R.cut_lineage
    monkeypatch.setattr(R, "cut_lineage", lambda df: written.append(df.columns) or cut(df))
    kinds = "instrument_id long, seq long, node long, technology string, severity int, restriction_type string, currency string, jurisdiction_type string, jurisdiction string, verified boolean, term string, extensions int, months_in_force double, drafting string"
    one = (1, 1, 5, "wind", 3, "ban", "in_force", "County", "J", True, "permanent", 0, 0.0, "")
    rows = spark.createDataFrame([one], kinds)
    places = spark.createDataFrame([(5, "S", 1.0, True, 0.0), (6, "S", 2.0, False, 0.0)], "node long, state string, profile double, checked boolean, organized double")
    projects = spark.createDataFrame([], "node long, outcome string")
    rules = spark.createDataFrame([], "state string, label string, technology string, ceiling int, binds string, bounds boolean")
    found = R.record_scores(rows, places, projects, rules)
    assert [(r.node, r.instruments) for r in found.orderBy("node").collect()] == [(5, 1), (6, 0)]
    assert len(written) == 1 and "technologies" in written[0]
