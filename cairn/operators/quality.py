"""Profiles and gates. A gate returns its findings; the caller raises before anything is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.scalars import blank_to_null


def fill_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_rows, n_filled): one aggregate over all columns, then turned long."""
    counts = df.agg(F.count("*").alias("__n"), *(F.count(blank_to_null(F.col(c).cast("string"))).alias(c) for c in columns))
    return counts.unpivot("__n", columns, "column", "n_filled").select("column", F.col("__n").alias("n_rows"), "n_filled")


def fill_collapse(before: DataFrame, after: DataFrame, drop_to: float = 0.8, min_filled: int = 20) -> DataFrame:
    """Columns whose fill rate fell below ``drop_to`` of what it was; a missing column fills nothing."""
    j = before.select("column", F.col("n_rows").alias("rows_before"), F.col("n_filled").alias("before")).join(after.select("column", F.col("n_rows").alias("rows_after"), F.col("n_filled").alias("after")), "column", "left")
    rate = lambda n, d: F.coalesce(F.col(n), F.lit(0)) / F.nullif(F.col(d), F.lit(0))
    j = j.withColumn("rate_before", rate("before", "rows_before")).withColumn("rate_after", F.coalesce(rate("after", "rows_after"), F.lit(0.0)))
    return j.withColumn("collapsed", (F.col("before") >= min_filled) & (F.col("rate_after") < F.col("rate_before") * drop_to))


def bounds_problems(df: DataFrame, rules: dict[str, tuple[float, float, bool]]) -> DataFrame:
    """Per column the values below and above its bounds, the non-integers where integers are due, and the nulls."""
    aggs = []
    for c, (low, high, whole) in rules.items():
        x = F.col(c).cast("double")
        parts = (F.count_if(x < low), F.count_if(x > high), F.count_if((x != F.floor(x)) & F.lit(whole)), F.count_if(x.isNull()))
        aggs.append(F.struct(F.lit(c).alias("column"), *(p.alias(n) for p, n in zip(parts, ("below", "above", "fractional", "nulls"), strict=True))).alias(c))
    return df.agg(*aggs).select(F.explode(F.array(*rules)).alias("r")).select("r.*")


def issue_codes(rules: list[tuple[str, str, Column]]) -> Column:
    """The codes of the rules a row breaks, as 'SEVERITY:CODE', in rule order."""
    return F.array_compact(F.array(*(F.when(condition, F.lit(f"{severity}:{code}")) for code, severity, condition in rules)))


def quarantine(df: DataFrame, rules: list[tuple[str, str, Column]], block_at: tuple[str, ...] = ("HIGH", "CRITICAL")) -> DataFrame:
    """Issues and whether they block the row."""
    return df.withColumn("issues", issue_codes(rules)).withColumn("blocked", F.exists("issues", lambda i: F.split(i, ":")[0].isin(*block_at)))


def first_reason(reasons: list[tuple[str, Column]], otherwise: str | None = None) -> Column:
    """The first reason that applies."""
    out = F.lit(otherwise)
    for name, condition in reversed(reasons):
        out = F.when(condition, F.lit(name)).otherwise(out)
    return out


def parity(computed: DataFrame, published: DataFrame, key: str, value: str) -> DataFrame:
    """SNK6: figures that two computations disagree on, NULL-safe; empty when all agree."""
    j = computed.select(key, F.col(value).alias("computed")).join(published.select(key, F.col(value).alias("published")), key, "full")
    return j.where(~F.col("computed").eqNullSafe(F.col("published")))


def reconcile_counts(mine: DataFrame, reported: DataFrame, key: str, n: str, tolerance: float = 0.02) -> DataFrame:
    """Extracted against reported counts; a gap beyond the tolerance, or any against a reported 0."""
    j = mine.select(key, F.col(n).alias("extracted")).join(reported.select(key, F.col(n).alias("reported")), key, "full").na.fill(0, ["extracted", "reported"])
    gap = F.when(F.col("reported") == 0, F.col("extracted") > 0).otherwise(F.abs(F.col("extracted") - F.col("reported")) > F.col("reported") * tolerance)
    return j.withColumn("gap", gap)


def guard_min_rows(df: DataFrame, key: str, least: int) -> DataFrame:
    """Keys with fewer rows than a release must have."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") < least)


def agreement(a: Column, b: Column) -> Column:
    """Equal, format_only when letters and digits agree, else disputed; a missing reading is not_read."""
    squash = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    return F.when(a.isNull() | b.isNull(), "not_read").when(a == b, "equal").when(squash(a) == squash(b), "format_only").otherwise("disputed")
