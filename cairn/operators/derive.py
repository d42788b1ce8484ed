"""Rule-based fields of records: scope, evidence, currency, terms, severity, checks. Expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.scalars import latest_day, latest_text_date, not_after, split_list, strict_date
from cairn.operators.quality import first_reason

READ = ("opened", "archived")


def scope(text: Column, sectors: Column) -> Column:
    """R1."""
    low = F.lower(text)
    renewable = low.rlike(r"\b(solar|wind|battery|storage)\b") | F.arrays_overlap(sectors, F.array(*map(F.lit, ("solar", "wind", "storage"))))
    center = low.rlike(r"data cent(er|re)") | F.array_contains(sectors, "data_center")
    return first_reason([("multi", renewable & center), ("data_center_only", center), ("renewables_only", renewable)])


def verification(url: Column, access: Column, reviewer: Column) -> Column:
    """R2: verified needs a source that was read and a reviewer; located needs a source."""
    found = F.coalesce(url, F.lit("")) != ""
    return F.when(found & access.isin(*READ) & (F.coalesce(reviewer, F.lit("")) != ""), "verified").when(found, "located").otherwise("unverified")


def currency(status: Column, end: Column, as_of: Column) -> Column:
    """Lapsed once its end has passed at the end's own precision; lifted by status; unknown without either."""
    ended = not_after(end, as_of) & (latest_day(end) < as_of.cast("date"))
    return F.when(status.isin("lifted", "repealed"), "lifted").when(F.coalesce(ended, F.lit(False)), "lapsed").when(status == "active", "active").otherwise("unknown")


def status_as_of(text: Column, *dates: Column) -> Column:
    """The latest of the dates a text names and some date cells."""
    return F.array_max(F.array_compact(F.array(latest_text_date(text), *(F.nullif(d, F.lit("")) for d in dates))))


def state_context(instruments: DataFrame, policies: DataFrame, state: str = "state", tech: str = "technology") -> DataFrame:
    """Yes if a policy of the state covers the technology, no if its policies don't, unknown without policies."""
    covered = policies.groupBy(state).agg(F.array_distinct(F.flatten(F.collect_list("technologies"))).alias("__t"))
    return instruments.join(covered, state, "left").withColumn("context", F.when(F.col("__t").isNull(), "unknown").when(F.array_contains("__t", F.col(tech)), "yes").otherwise("no")).drop("__t")


def term_end(enacted: Column, text: Column) -> tuple[Column, Column]:
    """(ends_on, basis): an explicit end date, else a number of months, days or years from the enactment."""
    low = F.lower(text)
    explicit = strict_date(F.regexp_extract(low, r"(?:until|through|expires? on|ending)\s+(\d{4}-\d{2}-\d{2})", 1))
    n = F.regexp_extract(low, r"(\d{1,3})[\s-]*(day|month|year)s?", 1).try_cast("int")
    unit = F.regexp_extract(low, r"(\d{1,3})[\s-]*(day|month|year)s?", 2)
    start = strict_date(enacted)
    counted = F.when(unit == "day", F.date_add(start, n)).when(unit == "month", F.add_months(start, n)).when(unit == "year", F.add_months(start, n * 12))
    return F.coalesce(explicit, counted), F.when(explicit.isNotNull(), "stated").when(counted.isNotNull(), "computed")


def severity(types: Column, status: Column) -> Column:
    """4 for a ban in force down to 1 for anything merely proposed."""
    has = lambda t: F.array_contains(types, t)
    return F.when(status == "proposed", 1).when(has("ban"), 4).when(has("moratorium"), 3).when(F.size(types) > 0, 2).otherwise(1)


def check_grade(sources: Column, checked_on: Column, as_of: Column, families: dict[str, str], stale_days: int = 365) -> tuple[Column, Column, Column]:
    """(grade, recheck_by, stale) of a negative check by the kinds of sources it looked at."""
    kinds = F.array_distinct(F.array_compact(F.transform(split_list(sources), lambda s: F.coalesce(*(F.when(F.lower(s).rlike(p), F.lit(k)) for k, p in families.items())))))
    day = strict_date(checked_on)
    grade = F.when(day.isNull() | (F.size(kinds) == 0), "U").when(F.size(kinds) >= 3, "A").when(F.size(kinds) == 2, "B").otherwise("C")
    by = F.date_add(day, stale_days)
    return grade, by, F.coalesce(by < as_of.cast("date"), F.lit(True))


def sanitized(value: Column, allowed: tuple[str, ...]) -> tuple[Column, Column]:
    """The value if it is in the vocabulary, else NULL and a note."""
    known = value.isin(*allowed)
    return F.when(known, value), F.when(~known, F.concat(F.lit("not in vocabulary: "), value))


def promoted(queue: DataFrame, technologies: str, complete: Column) -> DataFrame:
    """Complete queue rows, one per technology."""
    return queue.where(complete).withColumn("technology", F.explode(split_list(F.col(technologies))))


def diffusion_tier(restricted: Column, neighbours: Column, severe: Column, recent: Column) -> Column:
    """0 alone, 1 a neighbour, 2 several, 3 a severe one, 4 a recent severe one."""
    return F.when(restricted, 0).when(severe & recent, 4).when(severe, 3).when(neighbours >= 2, 2).when(neighbours == 1, 1).otherwise(0)


def findings(rows: DataFrame, key: str, questions: dict[str, Column]) -> DataFrame:
    """One row per failed question per record."""
    failed = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(q)) for q, ok in questions.items())))
    return rows.select(key, F.explode(failed).alias("question"))


def risk_window(rows: DataFrame, key: str, severe: Column, year: str, first: int, last: int) -> DataFrame:
    """Whether a key ever had a severe record, the first year, and whether that lies in the window."""
    first_year = F.min(F.when(severe, F.col(year)))
    return rows.groupBy(key).agg(F.bool_or(severe).alias("has_severe"), first_year.alias("first_year"), first_year.between(first, last).alias("in_window"), (F.count_distinct(F.when(severe, F.col("source"))) == 1).alias("one_source"))


def sole_contributors(places: DataFrame, instrument: str, place: str) -> DataFrame:
    """Instruments that are the only one in some place; per-place counts are partial aggregates."""
    lone = places.groupBy(place).agg(F.count_distinct(instrument).alias("n"), F.min(instrument).alias(instrument)).where("n = 1")
    return lone.groupBy(instrument).agg(F.count("*").alias("n_sole"))
