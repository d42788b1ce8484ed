"""Fixed rules over records: quality findings, withheld figures, tags and distances in texts, how alike two names are."""

from __future__ import annotations

from difflib import SequenceMatcher
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.functions.scalars import in_box
from cairn.operators.quality import first_reason

# The vocabularies, prefixes and outcomes that the rules compare with.
VOCABULARY = {
    "restrictions": {
        "status": ("active", "extended", "pending", "unknown"),
        "scope": ("renewables_only", "multi_sector_data_centers", "data_center_only"),
        "evidence_level": ("primary_source", "compiled_record", "compiled_flagged", "report_citation"),
        "verification": ("verified", "located", "unverified"),
        "currency": ("in_force", "lapsed_unconfirmed", "pending", "unknown"),
        "state_limits_local": ("yes", "no", "unknown", ""),
    },
    "contested_projects": {
        "outcome": ("blocked_confirmed", "blocked_unverified", "restricted_conditional", "advanced_confirmed", "advanced_unverified", "pending", "needs_review"),
        "verification": ("verified", "unverified"),
    },
    "cases": {
        "case_status": ("", "pending", "dismissed", "ruled_for_developer", "ruled_for_opposition", "settled", "withdrawn"),
        "verification": ("verified", "unverified"),
    },
}
DERIVED = ("scope", "evidence_level", "verification", "currency", "state_limits_local")
FINAL_EVIDENCE = "^(court_ruling|resolution)"
PRICED = ("solar", "wind", "battery_storage")
DECIDED = ("blocked_confirmed", "advanced_confirmed", "restricted_conditional")
UNVERIFIED = ("blocked_unverified", "advanced_unverified")
OFFSHORE = r"(?i)\boff-?shore\b"

# Concerns and the patterns that name them.
CONCERNS = {
    "farmland": r"\b(farmland|farm land|agricultur\w*|prime farm\w*|cropland|rural character)\b",
    "wildlife": r"\b(wildlife|birds?|bats?|eagles?|habitats?|endangered|migrat\w*|whales?|fisher(y|ies|men))\b",
    "property_value": r"\b(property|home|land) values?\b",
    "viewshed": r"\b(viewshed|visual impacts?|aesthetic\w*|scenic|eyesore|views? (of|from|across) the "
    r"(lake|mountains?|ridge\w*|valley|ocean|bay|sound|landscape|countryside|hills?|river|shore\w*))\b",
    "water": r"\b(water (use|usage|supply|quality|table|rights)|aquifers?|groundwater|runoff|drainage|wells)\b",
    "noise": r"\b(noise|decibels?|dba|sound (levels?|limits?))\b",
    "tribal_cultural": r"\b(tribal|tribes?|sacred|cultural resources?|archaeolog\w*|historic (district|site|preservation|resources?))\b",
    "traffic": r"\b(traffic|truck traffic|road damage|haul routes?)\b",
    "health": r"\b(health|infrasound|cancer|asthma)\b",
    "fire_safety": r"\b(fire|fires|thermal runaway|explosions?|toxic (gas|fumes|smoke)|emergency respon\w*)\b",
    "decommissioning": r"\bdecommission\w*\b",
    "grid_cost": r"\b(ratepayers?|electric(ity)? (bills?|rates|prices)|utility bills?|rate increases?)\b",
    "wetlands": r"\b(wetlands?|floodplains?|erosion)\b",
    "military_aviation": r"\b(radar|military|aviation|airports?|faa)\b",
    "shadow_flicker": r"\b(shadow )?flicker\b",
    "glare": r"\bglare\b",
}

#: Pieces of which every match of a concern's pattern holds one: they are sought as plain bytes, and the pattern only where one is found.
CONCERN_PIECES = {
    "farmland": ("farm", "agricultur", "cropland", "rural character"),
    "wildlife": ("wildlife", "bird", "bat", "eagle", "habitat", "endangered", "migrat", "whale", "fisher"),
    "property_value": ("property value", "home value", "land value"),
    "viewshed": ("viewshed", "visual impact", "aesthetic", "scenic", "eyesore", "view of the", "view from the", "view across the", "views of the", "views from the", "views across the"),
    "water": ("water ", "aquifer", "groundwater", "runoff", "drainage", "wells"),
    "noise": ("noise", "decibel", "dba", "sound l"),
    "tribal_cultural": ("tribal", "tribe", "sacred", "cultural resource", "archaeolog", "historic "),
    "traffic": ("traffic", "road damage", "haul route"),
    "health": ("health", "infrasound", "cancer", "asthma"),
    "fire_safety": ("fire", "thermal runaway", "explosion", "toxic ", "emergency respon"),
    "decommissioning": ("decommission",),
    "grid_cost": ("ratepayer", "electric", "utility bill", "rate increase"),
    "wetlands": ("wetland", "floodplain", "erosion"),
    "military_aviation": ("radar", "military", "aviation", "airport", "faa"),
    "shadow_flicker": ("flicker",),
    "glare": ("glare",),
}

# Families of mechanisms, the first that matches a part; kinds of bills; words that say nothing of a name.
FAMILIES = {
    "ban_moratorium": "ban|moratori|pause|extension|prohibit",
    "setback": "setback|buffer",
    "height": "height",
    "noise": "noise",
    "size": "cap on|area limit|size",
    "zoning": "zoning|overlay|ag_land|land preservation|use",
    "standard": "flicker|visual|viewshed",
}
BILL = (
    r"(?i)\b(s\.?\s?b\.?|h\.?\s?b\.?|l\.?\s?d\.?|senate bill|house bill|assembly bill|a\.?\s?b\.?|"
    r"public act(?: no\.?)?|act(?: no\.?)?|law|p\.?\s?a\.?)\s*([0-9]{1,4}(?:-[0-9]{1,4})?)\b"
)
BILL_KINDS = {"senatebill": "sb", "housebill": "hb", "assemblybill": "ab", "publicact": "pa", "publicactno": "pa", "actno": "act"}
GENERIC_WORDS = (
    "project", "projects", "solar", "wind", "energy", "farm", "farms", "center", "centre", "facility", "facilities", "power", "llc", "inc", "the",
    "of", "and", "park", "plant", "station", "storage", "battery", "generating", "renewable", "renewables", "array", "company", "co", "a", "in", "at",
    "on", "for", "i", "ii", "iii", "iv", "1", "2", "3", "4", "phase", "llcs", "s", "proposed", "utility", "scale", "pv", "photovoltaic", "bess",
    "system", "systems", "resource", "area", "offshore", "transmission", "line", "county", "township", "town", "city", "mw", "megawatt",
)

ISO = r"^\d{4}(-\d{2}(-\d{2})?)?$"
URL = r"^https?://[^\s/]+\.[^\s]+$"
ISSUES = "array<struct<code:string,severity:string,field:string>>"


def _cells(df: DataFrame):
    """A column's trimmed text, blank for NULL and for a column that isn't there."""
    have = set(df.columns)
    return lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in have else F.lit("")


def qc_findings(df: DataFrame, entity: str, today: str, boxes: DataFrame | None = None, block_at: tuple[str, ...] = ("HIGH", "CRITICAL")) -> DataFrame:
    """``df`` with all issues of a row, in the order of the rules, and whether one blocks it.

    ``boxes``: (state, south, west, north, east), one row a state. A state without a box, and missing
    coordinates, break no rule. Dates are compared at the precision they are given in.
    """
    cell, have, rules = _cells(df), set(df.columns), []
    rule = lambda code, severity, field, when: rules.append(F.when(when, F.struct(F.lit(code).alias("code"), (severity if isinstance(severity, Column) else F.lit(severity)).alias("severity"), F.lit(field).alias("field"))))
    after = lambda c: cell(c) > F.substring(F.lit(today), F.lit(1), F.length(cell(c)))
    rows = df
    if boxes is not None and {"latitude", "longitude", "state"} <= have:
        sides = ("south", "west", "north", "east")
        free = "__box"
        while free in have:
            free += "_"
        box = boxes.select(F.col("state").alias(f"{free}_state"), F.struct(*sides).alias(free))
        rows = df.join(box, F.col("state") == F.col(f"{free}_state"), "left")
        lat, lon = (F.col(c).try_cast("double") for c in ("latitude", "longitude"))
        rule("COORD_OUTSIDE_STATE", "HIGH", "latitude/longitude", ~in_box(lat, lon, tuple(F.col(free)[c] for c in sides)))
    for c in ("source_url", "case_source_url", "primary_source_url"):
        rule("SOURCE_URL_INVALID", "HIGH", c, (cell(c) != "") & ~cell(c).rlike(URL))
    for c, allowed in VOCABULARY.get(entity, {}).items():
        if c in have or c not in DERIVED:
            rule("STATUS_VOCAB", "HIGH", c, ~cell(c).isin(*allowed))
    for c in ("date_enacted_iso", "current_end_date_iso", "filing_date"):
        rule("DATE_UNPARSEABLE", "LOW", c, (cell(c) != "") & ~cell(c).rlike(ISO))
        if c != "current_end_date_iso":
            rule("DATE_IN_FUTURE", "HIGH", c, cell(c).rlike(ISO) & after(c))
    if entity == "restrictions":
        rule("SEVERITY_STATUS", "MEDIUM", "severity_score", (cell("status") == "pending") & (cell("severity_score").try_cast("int") > 2))
    rule("PRIMARY_SOURCE_CONTRADICTS", F.when(cell("primary_source_access") == "snippet", "MEDIUM").otherwise("HIGH"), "primary_source_url", cell("primary_source_verdict") == "contradicts")
    if entity == "restrictions":
        end, checked = cell("current_end_date_iso"), cell("status_checked_on")
        confirmed = checked.rlike(ISO) & (F.substring(checked, F.lit(1), F.length(end)) >= end)
        rule("END_DATE_PASSED", "MEDIUM", "current_end_date_iso", cell("status").isin("active", "extended") & end.rlike(ISO) & (end < F.substring(F.lit(today), F.lit(1), F.length(end))) & ~confirmed)
        rule("SCOPE_DATA_CENTER_ONLY", "HIGH", "scope", cell("scope") == "data_center_only")
    if entity == "contested_projects":
        rule("CONFIRMED_NO_EVIDENCE", "HIGH", "outcome", cell("outcome").endswith("_confirmed") & ~cell("finality_evidence").rlike(FINAL_EVIDENCE))
    found = rows.withColumn("issues", F.array_compact(F.array(*rules)).cast(ISSUES))
    return found.select(*(f"`{c}`" for c in df.columns), "issues", F.exists("issues", lambda i: i["severity"].isin(*block_at)).alias("blocked"))


def missing_links(cases: DataFrame, published: DataFrame, link: str, key: str) -> DataFrame:
    """R11, LINK_MISSING: cases whose link is filled and names no published record."""
    named = cases.where(F.trim(F.coalesce(F.col(link), F.lit(""))) != "")
    return named.join(published.select(F.col(key).alias(link)).distinct(), link, "left_anti").select(*cases.columns)


def partial_date(s: Column) -> tuple[Column, Column]:
    """The first day a partial date can mean, and its precision (day, month, year); NULL for anything else."""
    s = F.trim(s)
    day = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), s).when(s.rlike(r"^\d{4}-\d{2}$"), F.concat(s, F.lit("-01"))).when(s.rlike(r"^\d{4}$"), F.concat(s, F.lit("-01-01"))).try_cast("date")
    return day, F.when(day.isNotNull(), F.when(F.length(s) == 10, "day").when(F.length(s) == 7, "month").otherwise("year"))


def _megawatts(s: Column) -> Column:
    x = F.regexp_replace(s, ",", "").try_cast("double")
    return F.when(x > 0, x)


def withheld(projects: DataFrame, as_of: str) -> DataFrame:
    """What a project's span and capacity are priced on, and the first of ten reasons that withholds a figure.

    One row a project, its queue match already joined (first_request_date, match, conflict, queue_capacity_mw).
    Columns that aren't there count as blank. Adds priced_technology, span_kind, start_date, start_source,
    end_date, span_days, span_days_low, span_days_high, mw, mw_source, withheld_reason. Values after the
    reason in the order of the rules are given too, where the record has them.
    """
    cell = _cells(projects)
    techs = F.filter(F.transform(F.split(cell("technology"), ";"), lambda x: F.trim(x)), lambda x: x != "")
    text = F.concat_ws(" ", cell("project_name"), cell("description"), cell("long_description"))
    priced = (F.size(techs) > 0) & F.forall(techs, lambda x: x.isin(*PRICED)) & ~(F.array_contains(techs, "wind") & text.rlike(OFFSHORE))
    asked, asked_precision = partial_date(cell("first_request_date"))
    event, event_precision = partial_date(cell("event_date_text"))
    done, done_precision = partial_date(cell("resolution_date"))
    fine = lambda p: F.coalesce(p.isin("day", "month"), F.lit(False))
    strong = cell("match") == "strong"
    by_request, by_event = strong & fine(asked_precision), fine(event_precision)
    decided = cell("outcome").isin(*DECIDED)
    slack = lambda d, p: F.when(p == "month", F.datediff(F.last_day(d), d)).otherwise(0)
    sizes = {
        "record": _megawatts(cell("capacity_mw")),
        "federal_plant_inventory": F.when(cell("facility_match") == "strong", _megawatts(cell("facility_capacity_mw"))),
        "queue_request": F.when(strong, _megawatts(cell("queue_capacity_mw"))),
    }
    out = projects.withColumns({
        "priced_technology": F.when(priced, F.try_element_at(techs, F.lit(1))),
        "span_kind": F.when(decided, "request_to_decision").when(cell("outcome") == "pending", "accrued_to_date"),
        "start_date": F.when(by_request, asked).when(by_event, event),
        "start_source": F.when(by_request, "queue_request").when(by_event, "event_date"),
        "__start_slack": F.when(by_request, slack(asked, asked_precision)).otherwise(slack(event, event_precision)),
        "end_date": F.when(~decided, F.lit(as_of).cast("date")).when(fine(done_precision), done),
        "__end_slack": F.when(decided, slack(done, done_precision)).otherwise(0),
        "mw": F.coalesce(*sizes.values()),
        "mw_source": F.coalesce(*(F.when(v.isNotNull(), k) for k, v in sizes.items())),
    })
    out = out.withColumn("span_days", F.datediff("end_date", "start_date"))
    reasons = [
        ("technology_not_priced", F.col("priced_technology").isNull()),
        ("outcome_needs_review", cell("outcome") == "needs_review"),
        ("outcome_unverified", cell("outcome").isin(*UNVERIFIED)),
        ("outcome_needs_review", F.col("span_kind").isNull()),
        ("start_from_possible_queue_match", F.col("start_date").isNull() & (cell("first_request_date") != "") & ~strong),
        ("start_year_precision", F.col("start_date").isNull() & F.coalesce(event_precision == "year", F.lit(False))),
        ("no_start_date", F.col("start_date").isNull()),
        ("queue_match_conflict", (F.col("start_source") == "queue_request") & (cell("conflict") != "")),
        ("no_end_date", F.col("end_date").isNull()),
        ("nonpositive_span", F.col("span_days") < 1),
        ("no_capacity_mw", F.col("mw").isNull()),
    ]
    out = out.withColumn("span_days_low", F.greatest(F.lit(1), F.col("span_days") - F.col("__start_slack"))).withColumn("span_days_high", F.col("span_days") + F.col("__end_slack"))
    return out.withColumn("withheld_reason", first_reason(reasons)).drop("__start_slack", "__end_slack")


def concerns(s: Column) -> Column:
    """the concerns a text names, sorted."""
    holds = lambda low, n: reduce(or_, (F.contains(low, F.lit(piece)) for piece in CONCERN_PIECES[n]))
    named = lambda low: F.array_compact(F.array(*(F.when(holds(low, n) & low.rlike(p), F.lit(n)) for n, p in sorted(CONCERNS.items()))))
    # a list of one: the text is lower-cased once for all that is sought in it
    return F.get(F.transform(F.array(F.lower(s)), named), F.lit(0))


# Facilities that a distance may lie between, which makes it a spacing and no setback; numbers; numbers in words.
_FACILITY = r"(?:bess|batter(?:y|ies)|sites?|facilit(?:y|ies)|systems?|turbines?|towers?|arrays?|projects?|wecs)\b"
_NUMBER = r"(\d{1,3}(?:,\d{3})+|\d+(?:\.\d+)?)"
_WORDS = {"one": 1.0, "two": 2.0, "three": 3.0, "four": 4.0, "five": 5.0, "half": 0.5, "one-half": 0.5}
_SPACING = (
    rf"(?![^\w;]*(?:\w+[^\w;]+){{0,3}}?(?:(?:from|to|of)\s+(?:another|(?:any\s+)?other)\s+(?:[\w-]+\s+){{0,2}}?{_FACILITY}"
    rf"|(?:from|of)\s+each\s+other(?!\s*[a-z])|between\s+(?:[\w-]+\s+){{0,2}}?{_FACILITY}(?!\s+(?:and|or|to)\b)))"
)


def _found(s: Column, pattern: str) -> Column:
    return F.transform(F.regexp_extract_all(F.lower(s), F.lit(pattern), F.lit(1)), lambda x: F.regexp_replace(x, ",", "").try_cast("double"))


def setback_feet(s: Column) -> Column:
    """the largest distance in feet or miles, in feet; spacings between facilities don't count; 0 if none."""
    words = F.regexp_extract_all(F.lower(s), F.lit(rf"\b(one-half|half|one|two|three|four|five)[\s-]+(?:a\s+)?miles?\b{_SPACING}"), F.lit(1))
    value = F.create_map(*(F.lit(x) for pair in _WORDS.items() for x in pair))
    feet = _found(s, rf"{_NUMBER}[\s-]*(?:feet|foot|ft\b){_SPACING}")
    miles = F.concat(_found(s, rf"{_NUMBER}[\s-]*miles?\b{_SPACING}"), F.transform(words, lambda w: F.try_element_at(value, w)))
    return F.coalesce(F.array_max(F.concat(feet, F.transform(miles, lambda m: m * 5280))), F.lit(0.0))


def height_multiple(s: Column) -> Column:
    """the largest multiple of a height; 0 if none."""
    return F.coalesce(F.array_max(_found(s, r"(\d+(?:\.\d+)?)\s*(?:x|times)\s+(?:the\s+)?(?:\w+\s+){0,3}height")), F.lit(0.0))


def least_decibels(s: Column) -> Column:
    """the smallest noise limit; 0 if none."""
    return F.coalesce(F.array_min(_found(s, r"(\d{2})\s*db")), F.lit(0.0))


def families(s: Column) -> Column:
    """the families of the mechanisms in a list cell, sorted; remarks in brackets don't count."""
    parts = F.transform(F.split(F.lower(F.coalesce(s, F.lit(""))), ","), lambda p: F.trim(F.regexp_replace(p, r"\([^)]*\)", "")))
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(parts, lambda p: first_reason([(n, p.rlike(x)) for n, x in FAMILIES.items()])))))


def bills(s: Column) -> Column:
    """kind and number of every bill a text names, sorted."""
    named = F.create_map(*(F.lit(x) for pair in BILL_KINDS.items() for x in pair))
    part = lambda i: F.regexp_extract_all(s, F.lit(BILL), F.lit(i))
    kind = lambda k: F.regexp_replace(F.lower(k), "[^a-z]", "")
    return F.array_sort(F.array_distinct(F.zip_with(part(1), part(2), lambda k, n: F.concat(F.coalesce(F.try_element_at(named, kind(k)), kind(k)), n))))


def name_words(s: Column) -> Column:
    """the distinct words of a name that tell it from others."""
    return F.array_distinct(F.array_except(F.split(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " "), " "), F.array(*map(F.lit, ["", *GENERIC_WORDS]))))


def overlap(a: Column, b: Column) -> Column:
    """shared words over the words of the shorter name; 0 where one has none."""
    return F.coalesce(F.size(F.array_intersect(a, b)) / F.nullif(F.least(F.size(a), F.size(b)), F.lit(0)), F.lit(0.0))


def plain_name(s: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(s), "’", "'"), "[^a-z0-9]+", " "))


@F.pandas_udf(T.DoubleType())
def spelling(a: pd.Series, b: pd.Series) -> pd.Series:
    """ratio of matching blocks of letters, which no built-in expression gives; call it on candidates only."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def name_scores(pairs: DataFrame, a: str, b: str, least_words: float = 0.6, least_spelling: float = 0.88) -> DataFrame:
    """``score`` and ``basis`` of each pair of names: shared words, else spelling, else NULL.

    A check of candidates, which come from a blocked join. Spelling is compared only where words don't decide and the
    lengths allow the ratio: twice the shorter over both is the most that it can be.
    """
    rows = pairs.withColumn("__words", overlap(name_words(F.col(a)), name_words(F.col(b))))
    x, y = plain_name(F.col(a)), plain_name(F.col(b))
    open_ = (F.col("__words") < least_words) & (2 * F.least(F.length(x), F.length(y)) >= least_spelling * (F.length(x) + F.length(y)))
    rows = rows.withColumn("__spelling", spelling(F.when(open_, x), F.when(open_, y)))
    by_words, by_spelling = F.col("__words") >= least_words, F.col("__spelling") >= least_spelling
    scored = rows.withColumn("score", F.when(by_words, F.col("__words")).when(by_spelling, F.col("__spelling"))).withColumn("basis", F.when(by_words, "name").when(by_spelling, "spelling"))
    return scored.drop("__words", "__spelling")


def blanks_last(df: DataFrame, column: str, descending: bool = False) -> Column:
    """A sort key of a column, either way with blanks last."""
    value = F.col(column)
    if dict(df.dtypes)[column] == "string":
        value = F.when(F.trim(value) != "", value)
    return value.desc_nulls_last() if descending else value.asc_nulls_last()


def toggled(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """Sorted either way, blanks last in both."""
    return df.orderBy(blanks_last(df, column, descending))


def nearest_first(df: DataFrame, distance: str, *ties: str, cap: int = 12) -> DataFrame:
    """The nearest rows, unknown distances last; a top-k."""
    return df.orderBy(F.col(distance).asc_nulls_last(), *ties).limit(cap)
