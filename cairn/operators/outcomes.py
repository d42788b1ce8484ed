"""How severe a restriction is and why, and what a project came to once rulings are linked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators.rules import height_multiple, least_decibels, setback_feet

# Kinds of restrictions, the most severe first; statuses in force; thresholds; what a ruling confirms.
TYPE_ORDER = ("ban", "ban_or_moratorium", "moratorium", "height_limit", "setback", "noise_limit", "size_cap", "zoning_restriction", "siting_standard", "other")
IN_FORCE = ("active", "extended", "unknown")
WIND_FEET, WIND_HEIGHTS, OTHER_FEET, QUIET = 2640, 5, 1000, 35
CONFIRMING = {"blocked_unverified": ("ruled_for_opposition", "blocked_confirmed"), "advanced_unverified": ("ruled_for_developer", "advanced_confirmed")}


def _plain(x: Column) -> Column:
    """A number without a trailing zero: 5 for 5.0, 1.1 for 1.1."""
    return F.regexp_replace(x.cast("string"), r"\.0$", "")


def restriction_severity(types: Column, technology: Column, status: Column, text: Column) -> tuple[Column, Column, Column]:
    """(score from 2 to 4, the basis in words, the type that drives it).

    A ban, or a moratorium in force, is 4. For wind a setback of half a mile or five heights, a height limit, or a noise limit of
    35 dB or less is 3; for other technologies a setback of 1,000 feet is. All else is 2, and so is what is only pending. The
    driving type is the one whose rule fired, else the most severe of the list; ``types`` isn't empty.
    """
    has = lambda t: F.array_contains(types, t)
    feet, heights, noise = setback_feet(text), height_multiple(text), least_decibels(text)
    wind, force = technology == "wind", status.isin(*IN_FORCE)
    far = F.array_join(F.array_compact(F.array(F.when(feet != 0, F.concat(feet.cast("long").cast("string"), F.lit(" ft"))), F.when(heights != 0, F.concat(_plain(heights), F.lit("x height"))))), " / ")
    rules = [
        ("ban", has("ban"), 4, F.lit("ban/prohibition")),
        ("ban_or_moratorium", has("ban_or_moratorium") & force, 4, F.lit("ban or moratorium (the source does not say which)")),
        ("moratorium", has("moratorium") & force, 4, F.lit("in-force moratorium")),
        ("setback", wind & has("setback") & ((feet >= WIND_FEET) | (heights >= WIND_HEIGHTS)), 3, F.concat(F.lit("wind setback "), far)),
        ("height_limit", wind & has("height_limit"), 3, F.lit("wind height limit")),
        ("noise_limit", wind & has("noise_limit") & (noise > 0) & (noise <= QUIET), 3, F.concat(F.lit("wind noise limit "), _plain(noise), F.lit(" dBA"))),
        ("setback", ~wind & has("setback") & (feet >= OTHER_FEET), 3, F.concat(technology, F.lit(" setback "), feet.cast("long").cast("string"), F.lit(" ft"))),
    ]
    score, basis, driver = F.lit(2), F.lit("restricting mechanism (default)"), F.get(F.array_intersect(F.array(*map(F.lit, TYPE_ORDER)), types), F.lit(0))
    for kind, fires, points, words in reversed(rules):
        score, basis, driver = F.when(fires, points).otherwise(score), F.when(fires, words).otherwise(basis), F.when(fires, kind).otherwise(driver)
    capped = (status == "pending") & (score > 2)
    return F.when(capped, 2).otherwise(score), F.when(capped, F.concat(basis, F.lit("; capped at 2 (pending)"))).otherwise(basis), driver


def project_severity(outcome: Column, litigated: Column) -> Column:
    """4 blocked, 3 litigated, 1 advanced, else 2."""
    return F.when(outcome.startswith("blocked_"), 4).when(F.coalesce(litigated, F.lit(False)), 3).when(outcome.startswith("advanced_"), 1).otherwise(2)


def finalize_outcomes(projects: DataFrame, cases: DataFrame, key: str) -> DataFrame:
    """``projects`` with ``outcome`` as rulings confirm it, finality_evidence and severity.

    An unverified outcome is confirmed by a linked case decided that way, the first by ``cases(key, seq, case_name, case_status)``;
    it is then evidence, by name. Without one the label alone is, and other outcomes have none. ``projects`` has key, outcome
    and litigated. Only the two rulings that can confirm are kept of a project's cases, as minima, before the join.
    """
    first = lambda ruling: F.min_by(F.coalesce("case_name", F.lit("")), F.when(F.col("case_status") == ruling, F.col("seq")))
    rulings = cases.where(F.col("case_status").isin(*(r for r, _ in CONFIRMING.values()))).groupBy(key).agg(*(first(r).alias(f"__{o}") for o, (r, _) in CONFIRMING.items()))
    joined = projects.join(rulings, key, "left")
    old = F.col("outcome")
    named = F.coalesce(*(F.when(old == o, F.col(f"__{o}")) for o in CONFIRMING))
    confirmed = F.coalesce(*(F.when((old == o) & F.col(f"__{o}").isNotNull(), to) for o, (_, to) in CONFIRMING.items()))
    evidence = F.when(named.isNotNull(), F.trim(F.concat(F.lit("court_ruling: "), named))).when(old.isin(*CONFIRMING), "outcome_label_only").otherwise("none")
    out = joined.withColumns({"__new": F.coalesce(confirmed, old), "finality_evidence": evidence}).drop("outcome", *(f"__{o}" for o in CONFIRMING)).withColumnRenamed("__new", "outcome")
    return out.withColumn("severity", project_severity(F.col("outcome"), F.col("litigated")))


READ = ("opened", "archived")


def hold_reason(reviewer: Column, drafter: Column, url: Column, access: Column, verdict: Column, note: Column, reviewed_on: Column) -> Column:
    """Why a policy may not be published; null if it may. It needs a review by somebody else, of the statute itself, that confirms it, with its day."""
    s = lambda c: F.coalesce(F.trim(c), F.lit(""))
    said = F.when(s(note) != "", F.concat(F.lit(": "), F.substring(s(note), 1, 300))).otherwise("")
    other = lambda c, blank: F.when(s(c) == "", blank).otherwise(s(c))
    reasons = [
        (F.lit("no recorded review"), s(reviewer) == ""),
        (F.lit("self-review: the reviewer drafted the row"), s(reviewer) == s(drafter)),
        (F.lit("no statute URL"), s(url) == ""),
        (F.concat(F.lit("review saw the statute only as "), other(access, "nothing recorded")), ~s(access).isin(*READ)),
        (F.concat(F.lit("review verdict "), other(verdict, "blank"), said), s(verdict) != "confirmed"),
        (F.lit("review has no date"), s(reviewed_on) == ""),
    ]
    return F.coalesce(*(F.when(held, why) for why, held in reasons))


# Tiers of outcomes and evidence in their order, and days after which to look again.
OUTCOME_TIERS = ("blocked_unverified", "advanced_unverified", "needs_review", "pending")
EVIDENCE_TIERS = ("compiled_flagged", "compiled_record", "report_citation")
IMPACTS = ("sole_severe", "sole_record")
STATUS_ORDER = ("active", "extended", "pending")
STALE_OUTCOME_DAYS, STALE_PENDING_DAYS, SEVERE = 365, 120, 3
LAPSED = "lapsed_unconfirmed"


def _place(value: Column, order: tuple[str, ...]) -> Column:
    return F.coalesce(*(F.when(value == v, k) for k, v in enumerate(order)), F.lit(len(order)))


def outcome_worklist(projects: DataFrame, resolved: DataFrame, as_of: str) -> DataFrame:
    """Projects whose outcome needs settling, with age_days, overdue and priority from 1.

    ``projects(record_id, seq, state, project_name, outcome, event_day, has_litigation, facility_conflict, decision_language)``; of a record's rows the first
    by seq counts, and ``resolved(record_id)`` are left out. A contradicting plant inventory goes first, then the tier, stated
    decisions, litigation, the earliest year (none last), state and name. The order is global and cut into ranges.
    """
    from cairn.operators.windows import running_sum

    columns = [c for c in projects.columns if c != "record_id"]
    first = projects.where(F.col("outcome").isin(*OUTCOME_TIERS)).groupBy("record_id").agg(F.min_by(F.struct(*columns), "seq").alias("r")).select("record_id", "r.*")
    rows = first.join(resolved.select("record_id").distinct(), "record_id", "left_anti")
    age = F.datediff(F.lit(as_of).cast("date"), F.col("event_day").cast("date"))
    rows = rows.withColumns({"age_days": age, "overdue": F.coalesce((F.col("outcome") == "pending") & (age > STALE_OUTCOME_DAYS), F.lit(False))})
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    order = [blank("facility_conflict"), _place(F.col("outcome"), OUTCOME_TIERS), blank("decision_language"), F.coalesce(F.col("has_litigation"), F.lit("")) != "yes", F.year(F.col("event_day").cast("date")).asc_nulls_last(), F.coalesce("state", F.lit("")), F.coalesce("project_name", F.lit("")), F.col("record_id")]
    return running_sum(rows, order, F.lit(1)).withColumn("priority", F.col("__below") + 1).drop("__below", "__n")


def county_impacts(places: DataFrame) -> DataFrame:
    """(instrument_id, county_impact): sole_severe if it is severe and the only severe one somewhere, else sole_record if it is the only one somewhere, else blank.

    ``places(instrument_id, node, severity)``. Per-node counts and minima are partial aggregates; no node's instruments are gathered.
    """
    severity = places.groupBy("instrument_id").agg(F.max("severity").alias("severity"))
    at = places.select("instrument_id", "node").distinct().join(severity, "instrument_id")
    severe = F.when(F.col("severity") >= SEVERE, F.col("instrument_id"))
    nodes = at.groupBy("node").agg(F.count("*").alias("n"), F.min("instrument_id").alias("one"), F.count(severe).alias("m"), F.min(severe).alias("one_severe"))
    lone = nodes.where("n = 1").select(F.col("one").alias("instrument_id"), F.lit(1).alias("rank")).unionByName(nodes.where("m = 1").select(F.col("one_severe").alias("instrument_id"), F.lit(0).alias("rank")))
    best = lone.groupBy("instrument_id").agg(F.min("rank").alias("rank"))
    return severity.join(best, "instrument_id", "left").select("instrument_id", F.when(F.col("rank") == 0, IMPACTS[0]).when(F.col("rank") == 1, IMPACTS[1]).otherwise("").alias("county_impact"))


def sibling_sources(rows: DataFrame) -> DataFrame:
    """(instrument_id, sibling, url) for unverified instruments whose place and technology a verified one with a source has too.

    ``rows(instrument_id, seq, place, technology, verified, url)``. A place's first verified row holds the source; an instrument
    takes the first of its rows that has one from another instrument.
    """
    held = rows.where(F.col("verified") & (F.coalesce("url", F.lit("")) != "")).groupBy("place", "technology").agg(F.min_by(F.struct(F.col("instrument_id").alias("sibling"), "url"), "seq").alias("h"))
    met = rows.where(~F.coalesce("verified", F.lit(False))).join(held, ["place", "technology"]).where(F.col("h.sibling") != F.col("instrument_id"))
    return met.groupBy("instrument_id").agg(F.min_by("h", "seq").alias("h")).select("instrument_id", "h.sibling", "h.url")


def restriction_worklist(rows: DataFrame, checked: DataFrame, as_of: str) -> DataFrame:
    """One row per instrument that a reviewer should read: flags and priority from 1.

    ``rows(instrument_id, seq, place, technology, node, scope, severity, status, status_day, currency, evidence_level, verified, url, state)``. A lapsed
    instrument is listed whatever its evidence and even if checked; others only at a tier of evidence below a primary source,
    and if ``checked(instrument_id)`` hasn't them. Lapsed ones go first, then tier, scope, the impact on counties, severity
    downwards, status, state and id. The impact counts all rows of the scope renewables_only.
    """
    from cairn.operators.windows import running_sum

    lapsed = F.col("currency") == LAPSED
    listed = rows.join(checked.select("instrument_id", F.lit(True).alias("__seen")).distinct(), "instrument_id", "left").where(F.coalesce(lapsed, F.lit(False)) | (F.col("__seen").isNull() & F.col("evidence_level").isin(*EVIDENCE_TIERS)))
    kept = ("scope", "severity", "status", "status_day", "currency", "evidence_level", "state", "url")
    one = listed.groupBy("instrument_id").agg(F.min_by(F.struct(*kept), "seq").alias("r"), F.array_join(F.array_sort(F.collect_set("technology")), ";").alias("technologies")).select("instrument_id", "technologies", "r.*")
    impacts = county_impacts(rows.where("scope = 'renewables_only'").select("instrument_id", "node", "severity"))
    joined = one.join(impacts, "instrument_id", "left").join(sibling_sources(rows).withColumnRenamed("url", "sibling_url"), "instrument_id", "left")
    age = F.datediff(F.lit(as_of).cast("date"), F.col("status_day").cast("date"))
    flags = F.array_join(F.array_compact(F.array(
        F.when(lapsed, "end date passed with no confirmed extension"),
        F.when((F.col("status") == "pending") & (age > STALE_PENDING_DAYS), F.format_string(f"pending %d days, past {STALE_PENDING_DAYS}", age)),
        F.when(F.col("sibling").isNotNull(), F.concat(F.lit("primary source held by "), F.col("sibling").cast("string"))),
    )), "; ")
    out = joined.select("instrument_id", "technologies", *(c for c in kept if c != "url"), F.coalesce("county_impact", F.lit("")).alias("county_impact"), F.coalesce(F.nullif("url", F.lit("")), "sibling_url", F.lit("")).alias("located_url"), flags.alias("flags"))
    order = [~F.coalesce(F.col("currency") == LAPSED, F.lit(False)), _place(F.col("evidence_level"), EVIDENCE_TIERS), F.coalesce(F.col("scope"), F.lit("")) != "renewables_only", _place(F.col("county_impact"), IMPACTS), F.col("severity").desc_nulls_last(), _place(F.col("status"), STATUS_ORDER), F.coalesce("state", F.lit("")), F.col("instrument_id")]
    return running_sum(out, order, F.lit(1)).withColumn("priority", F.col("__below") + 1).drop("__below", "__n")


def intake(log: DataFrame) -> DataFrame:
    """Per source its requests, how many were stored, unchanged or failed, the last days, and the last error with its day.

    ``log(source_id, seq, fetch_date, error, local_path)``: a row per request. All of it is one partial aggregate.
    """
    s = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit(""))
    day, failed = F.nullif(F.substring(s("fetch_date"), 1, 10), F.lit("")), s("error") != ""
    unchanged, stored = ~failed & (s("local_path") == "unchanged"), ~failed & ~s("local_path").isin("", "unchanged")
    said = F.concat(F.coalesce(day, F.lit("None")), F.lit(": "), F.substring(s("error"), 1, 160))
    return log.groupBy("source_id").agg(F.count("*").alias("requests"), F.count_if(stored).alias("stored"), F.count_if(unchanged).alias("unchanged"), F.count_if(failed).alias("failed"), F.max(day).alias("last_fetch"), F.max(F.when(stored, day)).alias("last_changed"), F.max_by(said, F.when(failed, F.col("seq"))).alias("last_error"))


def negative_worklist(requests: DataFrame, checks: DataFrame, restricted: DataFrame, as_of: str, stale_days: int = 365) -> DataFrame:
    """(node, reason, requests, last_requested): places asked about with nothing published and no fresh check.

    ``requests(node, day)``, ``checks(node, checked_on)``, ``restricted(node)``; days as ISO text or dates. A check is stale after
    ``stale_days``; a place whose newest check is stale says so. Blank places are left out.
    """
    newest = checks.groupBy("node").agg(F.max(F.col("checked_on").cast("date")).alias("checked"))
    asked = requests.where("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("requests"), F.max(F.col("day").cast("date")).alias("last_requested"))
    rows = asked.join(restricted.select("node").distinct(), "node", "left_anti").join(newest, "node", "left")
    fresh = F.coalesce(F.datediff(F.lit(as_of).cast("date"), F.col("checked")) <= stale_days, F.lit(False))
    reason = F.when(F.col("checked").isNull(), "no check on record").otherwise(F.concat(F.lit("check of "), F.col("checked").cast("string"), F.lit(f" is stale (more than {stale_days} days old)")))
    return rows.where(~fresh).select("node", reason.alias("reason"), "requests", "last_requested")


def adjacency_worklist(instruments: DataFrame, edges: DataFrame, checked: DataFrame, as_of: str, months: int = 18) -> DataFrame:
    """(node, instrument_id, enacted): unexamined places next to one that enacted an instrument within the window.

    ``instruments(instrument_id, node, enacted)``: a row per place of an instrument, enacted a date or null; ``edges(a, b)``: neighbours; ``checked(node)``.
    A place with an instrument of its own, or a check, is left out; each other is listed once for each instrument.
    """
    today = F.lit(as_of).cast("date")
    recent = instruments.where(F.col("enacted").between(F.add_months(today, -months), today)).select("instrument_id", "node", "enacted")
    seen = recent.join(edges.select(F.col("a").alias("node"), "b").distinct(), "node").groupBy(F.col("b").alias("node"), "instrument_id").agg(F.max("enacted").alias("enacted"))
    known = instruments.select("node").unionByName(checked.select("node")).distinct()
    return seen.join(known, "node", "left_anti")
