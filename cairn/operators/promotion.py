"""Reviewed queue rows that are complete, read and scored become seed rows, one per technology; and what a later run changes of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.scalars import split_list
from cairn.operators.lint import cell_changes
from cairn.operators.outcomes import READ, restriction_severity
from cairn.sources.scratch import cut_lineage

# Mechanisms and the type of restriction that each is; technologies, and the short names that qualifiers use; statuses.
MECHANISMS = {
    "ban/prohibition": "ban",
    "ban": "ban",
    "primary use prohibition": "ban",
    "moratorium": "moratorium",
    "pause on new projects": "moratorium",
    "ban or moratorium": "ban_or_moratorium",
    "extension": "moratorium",
    "height_limit": "height_limit",
    "height limit": "height_limit",
    "height restriction": "height_limit",
    "height limit with resident permission": "height_limit",
    "setback": "setback",
    "setback rules": "setback",
    "buffer zone": "setback",
    "noise_limit": "noise_limit",
    "noise limit": "noise_limit",
    "cap on acreage": "size_cap",
    "cap on project size": "size_cap",
    "cap on area": "size_cap",
    "area limit": "size_cap",
    "cap on capacity": "size_cap",
    "cap on project area": "size_cap",
    "zoning_restriction": "zoning_restriction",
    "zoning restriction": "zoning_restriction",
    "overlay_zone": "zoning_restriction",
    "ag_land_exclusion": "zoning_restriction",
    "zoning regulation update": "zoning_restriction",
    "land preservation program": "zoning_restriction",
    "shadow_flicker_limit": "siting_standard",
    "visual_impact_rule": "siting_standard",
    "refusal to sign agreements": "other",
    "extended_producer_responsibility": "other",
}
TECHNOLOGIES = ("solar", "wind", "battery_storage")
SHORT = {"storage": "battery_storage"}
STATUSES = ("active", "extended", "pending", "unknown", "lifted", "expired")
GONE = ("lifted", "expired")
REQUIRED = ("state", "description", "source_url")


def _s(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c).cast("string")), F.lit(""))


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in pairs.items() for x in pair))


def mechanism_name(m: Column) -> Column:
    """'setback (wind)' as 'setback'."""
    return F.trim(F.regexp_replace(m, r"\s*\(([^)]*)\)\s*$", ""))


def applies(m: Column, technology: Column) -> Column:
    """Whether a mechanism holds for a technology: it has no qualifier, or one that names it, as in "setback (solar+storage)"."""
    inside = F.regexp_extract(m, r"\(([^)]*)\)\s*$", 1)
    named = F.transform(F.split(inside, r"\+"), lambda t: F.coalesce(F.try_element_at(_map(SHORT), F.trim(t)), F.trim(t)))
    return ~m.rlike(r"\([^)]*\)\s*$") | F.array_contains(named, technology)


def judged(queue: DataFrame) -> DataFrame:
    """``queue`` with ``seeds``, an array of (technology, restriction_type, severity_score, severity_basis, mechanisms), and ``problem``, null if they may be published.

    The first problem counts: a source that wasn't read; a mechanism outside the vocabulary, or none; a status that is blank,
    unknown to the vocabulary or no longer in force; an end date of another form than YYYY-MM[-DD]; a technology outside the
    vocabulary, or none; a technology without a mechanism; a typed score that differs from the computed one; a blank required
    field, or a source that isn't http(s). ``queue`` has queue_id, access, mechanisms, technology, status, end_date,
    severity_score, mechanism_detail and the required fields, as text.
    """
    listed, techs, status = split_list(_s("mechanisms")), F.array_distinct(split_list(F.lower(_s("technology")))), _s("status")
    text = F.trim(F.concat_ws(" ", _s("mechanism_detail"), _s("description")))
    known = _map(MECHANISMS)

    def seed(t: Column) -> Column:
        own = F.filter("__mechanisms", lambda m: applies(m, t))
        types = F.array_distinct(F.transform(own, lambda m: F.try_element_at(known, mechanism_name(m))))
        score, basis, driver = restriction_severity(types, t, status, text)
        return F.struct(t.alias("technology"), driver.alias("restriction_type"), score.alias("severity_score"), basis.alias("severity_basis"), F.array_join(own, ", ").alias("mechanisms"))

    # an outer explode of one array keeps a value as it is, where a projection would be written out in every expression that uses it
    once = lambda df, name, value: df.select("*", F.explode_outer(F.array(value)).alias(name))
    rows = once(once(queue, "__mechanisms", listed), "__techs", techs)
    unknown = F.filter("__mechanisms", lambda m: F.try_element_at(known, mechanism_name(m)).isNull())
    rows = once(rows.withColumn("__unknown", unknown), "seeds", F.transform("__techs", seed))
    bare = F.transform(F.filter("seeds", lambda s: s["mechanisms"] == ""), lambda s: s["technology"])
    typed = _s("severity_score")
    conflict = F.filter("seeds", lambda s: (typed != "") & (typed != s["severity_score"].cast("string")))
    gaps = F.array_compact(F.array(*(F.when(_s(c) == "", F.lit(c)) for c in REQUIRED), F.when((_s("source_url") != "") & ~_s("source_url").rlike("^https?://"), F.lit("source_url (not http(s))"))))
    join = lambda a: F.array_join(a, ", ")
    problems = [
        (~_s("access").isin(*READ), F.concat(F.lit("access is "), F.when(_s("access") == "", "blank").otherwise(_s("access")), F.lit("; the source has to be opened or archived first"))),
        (F.size("__unknown") > 0, F.concat(F.lit("unknown mechanism(s) "), join("__unknown"))),
        (F.size("__mechanisms") == 0, F.lit("mechanisms is blank")),
        (~status.isin(*STATUSES), F.concat(F.lit("status '"), status, F.lit("' is not one of the vocabulary"))),
        (status.isin(*GONE), F.concat(F.lit("status "), status, F.lit(": the instrument is no longer in force"))),
        ((_s("end_date") != "") & ~_s("end_date").rlike(r"^\d{4}-\d{2}(-\d{2})?$"), F.lit("end_date must be YYYY-MM or YYYY-MM-DD")),
        ((F.size("__techs") == 0) | (F.size(F.array_except("__techs", F.array(*map(F.lit, TECHNOLOGIES)))) > 0), F.lit("technology must be among " + ", ".join(TECHNOLOGIES))),
        (F.size(bare) > 0, F.concat(F.lit("no mechanism applies to "), join(bare))),
        (F.size(conflict) > 0, F.concat(F.lit("typed severity_score "), typed, F.lit(" conflicts with the computed "), F.get(conflict, F.lit(0))["severity_score"].cast("string"), F.lit(" for "), F.get(conflict, F.lit(0))["technology"])),
        (F.size(gaps) > 0, F.concat(F.lit("missing "), join(gaps))),
    ]
    return rows.withColumn("problem", F.coalesce(*(F.when(bad, why) for bad, why in problems))).drop("__mechanisms", "__techs", "__unknown")


def promoted(queue: DataFrame) -> DataFrame:
    """The seed rows of the queue rows without a problem: queue_id, the required fields, status, and one row per technology."""
    return _seeds(judged(queue))


def _seeds(told: DataFrame) -> DataFrame:
    fine = told.where("problem IS NULL")
    return fine.select("queue_id", *REQUIRED, F.trim("status").alias("status"), F.inline("seeds"))


def resynced(seeds: DataFrame, queue: DataFrame) -> DataFrame:
    """(queue_id, technology, kind, column, before, after): what promoting ``queue`` again changes of the published ``seeds``.

    Rows of a queue row that is gone from the queue stay as they are. One that is no longer in force, or no longer lists a technology,
    loses those rows; one that has a problem of another kind isn't touched.
    """
    told = cut_lineage(judged(queue))
    settled = told.where(F.col("problem").isNull() | F.trim("status").isin(*GONE)).select("queue_id")
    return cell_changes(seeds.join(settled, "queue_id", "left_semi"), _seeds(told), ["queue_id", "technology"])
