"""Rollups: many rows of one thing to one row, deterministic whatever the row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sorted_set(c: Column) -> Column:
    """A1, A10: the distinct non-null values, sorted; empty, not NULL, when there are none."""
    return F.array_sort(F.collect_set(c))


def sorted_list(c: Column) -> Column:
    return F.array_sort(F.collect_list(c))


def flat_set(c: Column) -> Column:
    """The distinct values of list cells, sorted."""
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))


def weakest(c: Column, ladder: tuple[str, ...]) -> Column:
    """The worst step of a ladder (best first) that any row stands on; an unknown step is the worst."""
    steps = F.array(*map(F.lit, ladder))
    rank = F.coalesce(F.nullif(F.array_position(steps, c), F.lit(0)), F.lit(len(ladder)))
    return F.element_at(steps, F.max(rank).cast("int"))


def unanimous(c: Column) -> Column:
    """The value if all rows agree, else NULL."""
    return F.when(F.count_distinct(c) == 1, F.min(c))


def latest(value: Column, *order: Column) -> Column:
    """The value of the row that is last by ``order``."""
    return F.max_by(value, F.struct(*order))


def share(part: Column, whole: Column, digits: int = 3) -> Column:
    """Half-even rounded; nothing out of nothing is NULL."""
    return F.bround(part / F.nullif(whole, F.lit(0)), digits)


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def mode_by(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """The commonest value per key, the alphabetically first of equals. Counts before it groups."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("__n"))
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("__n"), F.col(value))).alias(out))


def pick_total(df: DataFrame, keys: list[str], mode: str, total: str, value: str, out: str) -> DataFrame:
    """The TOTAL rows of a key where it has any, else the sum of all its rows; two partial sums, no window."""
    is_total = F.col(mode) == total
    return df.groupBy(*keys).agg(F.coalesce(F.sum(F.when(is_total, F.col(value))), F.sum(value)).alias(out))


def leave_one_out(df: DataFrame, group: str, value: Column, out: str) -> DataFrame:
    """The mean of the others of a group. The group sums are a small aggregate joined back."""
    sums = df.groupBy(group).agg(F.sum(value).alias("__s"), F.count(value).alias("__n"))
    return df.join(sums, group).withColumn(out, (F.col("__s") - value) / F.nullif(F.col("__n") - 1, F.lit(0))).drop("__s", "__n")


def growth(df: DataFrame, key: str, year: str, value: str, n: int, digits: int = 5) -> DataFrame:
    """Change over n years by a self-join on the year, so gaps don't shift it; NULL without a base."""
    base = df.select(key, (F.col(year) + n).alias(year), F.col(value).alias("__base"))
    return df.join(base, [key, year], "left").withColumn("growth", F.round(F.col(value) / F.nullif(F.col("__base"), F.lit(0.0)) - 1, digits)).drop("__base")


def pivot_shares(df: DataFrame, key: str, kind: str, kinds: tuple[str, ...], value: Column) -> DataFrame:
    """One share of the total per kind; a missing kind is 0, a key without a total is dropped."""
    wide = df.groupBy(key).agg(*(F.sum(F.when(F.col(kind) == k, value).otherwise(0)).alias(k) for k in kinds), F.sum(value).alias("__total"))
    return wide.where(F.col("__total") > 0).select(key, *(F.round(F.col(k) / F.col("__total"), 6).alias(k) for k in kinds))


def unpivot(df: DataFrame, key: str, columns: tuple[str, ...], name: str, value: str) -> DataFrame:
    """A42."""
    return df.unpivot(key, list(columns), name, value)
