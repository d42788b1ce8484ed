"""How restrictive a place is on its own record, from 0 to 100, capped where a state's law overrules local rules.

Instruments are points: severity x currency x kind of government x breadth over technologies x, for a pause, its term. A place's
points stack: the largest in full, the others in part. Blocked projects add, approved ones take away. Places with little evidence lean
on the mean of places that resemble them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators.windows import deciles
from cairn.sources.scratch import cut_lineage


@dataclass(frozen=True)
class Rubric:
    """The weights; the defaults are a starting point that a caller replaces."""

    severity: tuple[tuple[int, float], ...] = ((4, 60.0), (3, 35.0), (2, 12.0), (1, 3.0))
    currency: tuple[tuple[str, float], ...] = (("in_force", 1.0), ("unknown", 0.6), ("pending", 0.3), ("lapsed_unconfirmed", 0.25))
    county_types: tuple[str, ...] = ("County", "Parish", "Borough")
    county_weight: float = 1.0
    other_weight: float = 0.35
    technologies: tuple[str, ...] = ("solar", "wind", "battery_storage")
    per_extra_technology: float = 0.1
    others_weight: float = 0.25
    local_cap: float = 30.0
    cap: float = 80.0
    term_base: float = 0.6
    term_per_extension: float = 0.1
    term_per_year: float = 0.1
    term_max: float = 0.95
    term_drafting: float = 0.8
    term_from_severity: int = 3
    outcomes: tuple[tuple[str, float], ...] = (("blocked_confirmed", 12.0), ("blocked_unverified", 6.0), ("restricted_conditional", 3.0), ("advanced_confirmed", -6.0), ("advanced_unverified", -3.0))
    blocked_cap: float = 25.0
    approval_cap: float = 20.0
    approval_share: float = 0.5
    tiers: tuple[tuple[str, float], ...] = (("prohibitive", 60.0), ("restrictive", 35.0), ("mixed", 15.0), ("open", 0.0))
    verified_weight: float = 0.9
    record_weight: float = 0.7
    checked_weight: float = 0.5


def _weight(value: Column, pairs: tuple[tuple, ...]) -> Column:
    return F.coalesce(*(F.when(value == k, F.lit(float(w))) for k, w in pairs), F.lit(0.0))


def _rounded(x: Column, places: int = 2) -> Column:
    """Half up in decimals, so that sums that differ in their last bits agree."""
    return F.round(x.cast("decimal(18,8)"), places).cast("double")


def instruments(rows: DataFrame) -> DataFrame:
    """One row per instrument of rows(instrument_id, seq, technology, severity, restriction_type, currency, jurisdiction_type, jurisdiction, verified, term, extensions, months_in_force, drafting).

    Its technologies sorted; the highest severity, and the type of the first row (by seq) that has it; the first filled currency
    and jurisdiction; verified if a row is; permanent before temporary before any other term; the most extensions and months;
    adopted before active drafting.
    """
    first = lambda c: F.min_by(c, F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col("seq")))
    has = lambda c, v: F.bool_or(F.coalesce(F.col(c) == v, F.lit(False)))
    return rows.groupBy("instrument_id").agg(
        F.array_sort(F.collect_set(F.coalesce("technology", F.lit("")))).alias("technologies"), F.max("severity").alias("severity"), F.min_by("restriction_type", F.struct(-F.col("severity"), "seq")).alias("restriction_type"),
        F.coalesce(first("currency"), F.lit("unknown")).alias("currency"), first("jurisdiction_type").alias("jurisdiction_type"), F.coalesce(first("jurisdiction"), F.lit("")).alias("jurisdiction"), F.bool_or(F.coalesce("verified", F.lit(False))).alias("verified"),
        F.when(has("term", "permanent"), "permanent").when(has("term", "temporary"), "temporary").otherwise(first("term")).alias("term"), F.coalesce(F.max("extensions"), F.lit(0)).alias("extensions"), F.coalesce(F.max("months_in_force"), F.lit(0.0)).alias("months_in_force"),
        F.when(has("drafting", "adopted"), "adopted").when(has("drafting", "active"), "active").alias("drafting"),
    )


def term_factor(r: Rubric) -> Column:
    """What a temporary, severe instrument counts of its points: more with each extension and year, less while rules are drafted; 1 for all others."""
    f = F.least(F.lit(r.term_max), r.term_base + r.term_per_extension * F.col("extensions") + r.term_per_year * F.col("months_in_force") / 12)
    f = _rounded(F.least(F.lit(1.0), F.when(F.col("drafting") == "active", f * r.term_drafting).otherwise(f)), 4)
    return F.when((F.col("term") == "temporary") & (F.col("severity") >= r.term_from_severity), f).otherwise(1.0)


def instrument_points(r: Rubric) -> Column:
    """Points of a row with severity, capped (an array of severities by technology where a law caps some, else null), technologies, currency and the rest."""
    where = F.when(F.col("county_wide"), r.county_weight).otherwise(r.other_weight)
    known = F.size(F.array_intersect("technologies", F.array(*map(F.lit, r.technologies))))
    broad = _weight(F.col("severity"), r.severity) * (1 + r.per_extra_technology * F.greatest(known - 1, F.lit(0)))
    each = F.reverse(F.array_sort(F.transform(F.filter("capped", lambda c: c["technology"].isin(*r.technologies)), lambda c: _weight(c["severity"], r.severity))))
    # the highest technology in full and each other in part, so that a cap never raises a score
    capped = F.get(each, F.lit(0)) + r.per_extra_technology * F.aggregate(F.slice(each, 2, F.greatest(F.size(each) - 1, F.lit(0))), F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(each) > 0, capped).otherwise(broad) * _weight(F.col("currency"), r.currency) * where * term_factor(r)


def preempted(placed: DataFrame, rules: DataFrame) -> DataFrame:
    """``placed(node, state, county_wide, technologies, severity, …)`` with severity capped by rules(state, label, technology, ceiling, binds, bounds), and: capped, preempted_by, bounded.

    A rule reaches an instrument's technology if it names it and binds its kind of government (county, non_county or both).
    Each technology counts at the lowest ceiling that reaches it; the instrument's severity is then its highest technology's.
    bounded: a rule that bounds the whole rulebook reaches every technology. Rules are gathered per state and met by equality.
    """
    lists = rules.groupBy("state").agg(F.collect_list(F.struct("technology", "ceiling", "label", "binds", "bounds")).alias("__rules"))
    rows = placed.join(lists, "state", "left").withColumn("__rules", F.coalesce("__rules", F.array().cast(lists.schema["__rules"].dataType)))
    binds = lambda x: (x["binds"] == "both") | F.when(F.col("county_wide"), x["binds"] == "county").otherwise(x["binds"] == "non_county")
    reach = lambda t: F.filter("__rules", lambda x: (x["technology"] == t) & binds(x))
    low = lambda t: F.array_min(F.transform(reach(t), lambda x: x["ceiling"]))
    each = F.transform("technologies", lambda t: F.struct(t.alias("technology"), F.least(F.col("severity"), F.coalesce(low(t), F.col("severity"))).alias("severity"), F.transform(F.filter(reach(t), lambda x: x["ceiling"] == low(t)), lambda x: x["label"]).alias("by")))
    out = rows.withColumn("__each", each)
    lowered = F.filter("__each", lambda e: e["severity"] < F.col("severity"))
    out = out.withColumn("preempted_by", F.array_sort(F.array_distinct(F.flatten(F.transform(lowered, lambda e: e["by"])))))
    out = out.withColumn("bounded", (F.size("technologies") > 0) & F.forall("technologies", lambda t: F.exists(reach(t), lambda x: x["bounds"])))
    hit = F.size("preempted_by") > 0
    plain = F.transform("__each", lambda e: F.struct(e["technology"].alias("technology"), e["severity"].alias("severity")))
    out = out.withColumns({"capped": F.when(hit, plain), "__top": F.array_max(F.transform("__each", lambda e: e["severity"])), "own": plain})
    return out.withColumn("severity", F.when(hit, F.col("__top")).otherwise(F.col("severity"))).drop("__rules", "__each", "__top")


def merged(rows: DataFrame, r: Rubric) -> DataFrame:
    """Bounded instruments of one government in a place count as one: the highest, with all technologies at their highest capped severity and the strongest currency.

    A county's bounded instruments are one group, another government's those of its name. Rows as ``preempted`` gives them.
    """
    group = F.when(~F.col("bounded"), F.concat(F.lit("one:"), F.col("instrument_id").cast("string"))).when(F.col("county_wide"), "county").otherwise(F.concat(F.lit("place:"), F.lower("jurisdiction")))
    weight = _weight(F.col("currency"), r.currency)
    rank = F.struct("severity", weight.alias("w"), "instrument_id")
    kept = [c for c in rows.columns if c not in ("node", "currency", "capped", "own", "technologies", "verified", "preempted_by", "bounded")]
    whole = rows.withColumn("__group", group).groupBy("node", "__group").agg(
        F.max_by(F.struct(*kept), rank).alias("top"), F.count("*").alias("merged"), F.max_by("currency", F.struct(weight.alias("w"), "currency")).alias("currency"), F.bool_or("verified").alias("verified"), F.max_by("capped", rank).alias("capped"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("technologies")))).alias("technologies"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("preempted_by")))).alias("preempted_by"), F.flatten(F.collect_list("own")).alias("own"),
    )
    highest = F.transform("technologies", lambda t: F.struct(t.alias("technology"), F.array_max(F.transform(F.filter("own", lambda o: o["technology"] == t), lambda o: o["severity"])).alias("severity")))
    return whole.select("node", "top.*", "merged", "currency", "verified", "technologies", "preempted_by", F.when(F.col("merged") > 1, highest).otherwise(F.col("capped")).alias("capped"))


def stacked(points: Column, r: Rubric) -> Column:
    """The stack of an array of (points, instrument_id, county_wide): the largest in full, the others in part; what local governments add is capped, and so is the whole."""
    ordered = F.reverse(F.array_sort(F.transform(points, lambda p: F.struct(p["points"].alias("points"), p["county_wide"].alias("county_wide")))))
    shares = F.transform(ordered, lambda p, k: F.struct((p["points"] * F.when(k == 0, 1.0).otherwise(r.others_weight)).alias("share"), p["county_wide"].alias("county_wide")))
    total = lambda wide: F.aggregate(F.filter(shares, lambda s: s["county_wide"] == F.lit(wide)), F.lit(0.0), lambda a, s: a + s["share"])
    return F.least(F.lit(r.cap), total(True) + F.least(F.lit(r.local_cap), total(False)))


def _records(scored: DataFrame, places: DataFrame, r: Rubric, name: str) -> DataFrame:
    """(node, <name>, instrument points, blocked points, approval credit): the points of each place from scored instruments and its projects' points."""
    lists = scored.groupBy("node").agg(
        F.collect_list(F.struct("points", "instrument_id", "county_wide")).alias("p"),
        F.max(F.when((F.col("severity") == 4) & (F.col("currency") == "in_force") & F.col("county_wide"), F.col("points"))).alias("floor"),
        F.max_by("instrument_id", F.struct("points", F.lit(0))).alias("top"),
    )
    rows = places.join(lists, "node", "left").withColumn("base", F.when(F.col("p").isNotNull(), stacked(F.col("p"), r)).otherwise(0.0))
    added, credit = F.least(F.lit(r.blocked_cap), F.col("plus")), F.least(F.lit(r.approval_cap), F.col("minus"), r.approval_share * F.col("base"))
    # a moratorium or ban in force county-wide outweighs earlier approvals
    total = F.greatest(F.coalesce("floor", F.lit(0.0)), F.col("base") + added + F.col("organized") - credit)
    return rows.select("node", _rounded(total).alias(name), _rounded(F.col("base")).alias(f"{name}_instruments"), _rounded(added).alias(f"{name}_blocked"))


def record_scores(rows: DataFrame, places: DataFrame, projects: DataFrame, rules: DataFrame, r: Rubric | None = None) -> DataFrame:
    """Per place record_points, local_points (as if nothing were capped), preemption_points, basis, evidence_weight, profile_points, combined, tier and combined_decile.

    ``rows`` are those of ``instruments`` with node, a row for each county of a row. ``places(node, state, profile, checked, organized)``: profile is
    the resemblance score or null, checked whether somebody looked and found nothing, organized points of opposition.
    ``projects(node, outcome)``. ``rules`` as ``preempted`` takes them. Profile points are the mean local_points of all places of the same
    tenth of the profile, so a cap in one state moves no other's prior. Places without record, check or profile have tier no_record.

    Instruments of one place are gathered (a place has few), never those of a state; all the rest are equality joins and partial aggregates.
    """
    r = r or Rubric()
    county = F.coalesce(F.col("jurisdiction_type").isin(*r.county_types), F.lit(False))
    one = instruments(rows).withColumn("county_wide", county)
    # read for the local score, the capped one and the counts: written once
    placed = cut_lineage(rows.select("instrument_id", "node").distinct().join(one, "instrument_id").join(places.select("node", "state"), "node"))
    scored = lambda df: df.withColumn("points", instrument_points(r))
    bare = placed.withColumn("capped", F.lit(None).cast("array<struct<technology:string,severity:int>>"))
    worth = _weight(F.col("outcome"), r.outcomes)
    sums = projects.groupBy("node").agg(F.sum(F.greatest(worth, F.lit(0.0))).alias("plus"), F.sum(F.greatest(-worth, F.lit(0.0))).alias("minus"), F.bool_or(F.col("outcome").endswith("_confirmed")).alias("confirmed"), F.count("*").alias("projects"))
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
    base = places.join(sums, "node", "left").select("node", "state", "profile", F.coalesce("checked", F.lit(False)).alias("checked"), zero("organized"), zero("plus"), zero("minus"), F.coalesce("confirmed", F.lit(False)).alias("confirmed"), F.coalesce("projects", F.lit(0)).alias("projects"))
    local = _records(scored(bare), base, r, "local_points")
    bound = _records(scored(merged(preempted(placed.withColumn("severity", F.col("severity").cast("int")), rules), r)), base, r, "record_points")
    held = placed.groupBy("node").agg(F.count("*").alias("instruments"), F.bool_or("verified").alias("verified"))
    out = base.join(local, "node").join(bound, "node").join(held, "node", "left")
    has = F.coalesce("instruments", F.lit(0)) + F.col("projects") > 0
    sure = F.coalesce("verified", F.lit(False)) | F.col("confirmed")
    basis = F.when(has, "record").when(F.col("checked"), "negative_check").otherwise("profile_only")
    weight = F.when(has, F.when(sure, r.verified_weight).otherwise(r.record_weight)).when(F.col("checked"), r.checked_weight).otherwise(0.0)
    out = out.withColumns({"basis": basis, "evidence_weight": weight, "preemption_points": _rounded(F.col("local_points") - F.col("record_points"))})
    tenth = deciles(out.where("profile IS NOT NULL").select("node", "profile"), [F.col("profile"), F.col("node")], "profile_decile").select("node", "profile_decile")
    out = out.join(tenth, "node", "left")
    # ten means
    means = out.where("profile_decile IS NOT NULL").groupBy("profile_decile").agg((F.sum(F.col("local_points").cast("decimal(18,2)")).cast("double") / F.count("*")).alias("mean"))
    out = out.join(F.broadcast(means), "profile_decile", "left").withColumn("profile_points", _rounded(F.coalesce("mean", F.lit(0.0))))
    w = F.col("evidence_weight")
    out = out.withColumn("combined", _rounded(w * F.col("record_points") + (1 - w) * F.col("profile_points")))
    tier = F.lit(r.tiers[-1][0])
    for label, least in reversed(r.tiers[:-1]):
        tier = F.when(F.col("combined") >= least, label).otherwise(tier)
    out = out.withColumn("tier", F.when(F.col("basis") == "profile_only", "no_record").otherwise(tier))
    ranked = deciles(out, [F.col("combined"), F.coalesce("profile", F.lit(-1.0)), F.col("node")], "combined_decile")
    return ranked.select("node", "tier", "combined", "combined_decile", "basis", "evidence_weight", "record_points", "local_points", "preemption_points", "profile_decile", "profile_points", F.coalesce("instruments", F.lit(0)).alias("instruments"), "projects")
