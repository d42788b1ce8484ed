"""Keyed tables against one another: diffs, merges, editions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyed_diff(before: DataFrame, after: DataFrame, key: str, tracked: list[str]) -> DataFrame:
    """(key, change, column): added and removed keys, and one row per changed cell. Order is no change."""
    b = before.select(key, F.struct(*tracked).alias("__b"))
    a = after.select(key, F.struct(*tracked).alias("__a"))
    both = b.join(a, key, "full")
    cells = F.array_compact(F.array(*(F.when(~F.col(f"__b.{c}").eqNullSafe(F.col(f"__a.{c}")), F.lit(c)) for c in tracked)))
    change = F.when(F.col("__b").isNull(), "added").when(F.col("__a").isNull(), "removed").otherwise("modified")
    listed = F.when(F.col("__b").isNull() | F.col("__a").isNull(), F.array(F.lit("*"))).otherwise(cells)
    return both.select(key, change.alias("change"), F.explode(listed).alias("column"))


def schema_diff(before: DataFrame, after: DataFrame) -> list[tuple[str, str]]:
    b, a = before.columns, after.columns
    return [("dropped", c) for c in b if c not in a] + [("added", c) for c in a if c not in b]


def three_way_merge(base: DataFrame, ours: DataFrame, theirs: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, outcome) by two full joins on the key.

    unchanged, ours, theirs, both_same; disputed if both sides give different values, conflict if one changes
    what the other removes; deletions agreed or untouched by the other side vanish as removed.
    """
    side = lambda df, n: df.select(key, F.col(value).alias(n), F.lit(True).alias(f"has_{n}"))
    j = side(base, "b").join(side(ours, "o"), key, "full").join(side(theirs, "t"), key, "full")
    b, o, t = (F.coalesce(F.col(f"has_{n}"), F.lit(False)) for n in "bot")
    same = lambda x, y: F.col(x).eqNullSafe(F.col(y))
    outcome = (
        F.when(~b & o & t, F.when(same("o", "t"), "both_same").otherwise("disputed"))
        .when(~b & o, "ours").when(~b & t, "theirs")
        .when(~o & ~t, "removed")
        .when(~o, F.when(same("b", "t"), "removed").otherwise("conflict"))
        .when(~t, F.when(same("b", "o"), "removed").otherwise("conflict"))
        .when(same("o", "t"), F.when(same("b", "o"), "unchanged").otherwise("both_same"))
        .when(same("b", "o"), "theirs").when(same("b", "t"), "ours").otherwise("disputed")
    )
    kept = F.when(outcome.isin("ours", "both_same", "unchanged"), F.col("o")).when(outcome == "theirs", F.col("t")).when(outcome.isin("disputed", "conflict"), F.col("b"))
    return j.select(key, kept.alias(value), outcome.alias("outcome"))


def edition_merge(new: DataFrame, old: DataFrame, key: str, carried: list[str]) -> DataFrame:
    """The new edition, blank cells carried from the old one, and the old rows that it lacks."""
    prior = old.select(key, *(F.col(c).alias(f"__{c}") for c in carried))
    filled = new.join(prior, key, "left").select(*(F.coalesce(c, f"__{c}").alias(c) if c in carried else F.col(c) for c in new.columns), F.lit("new").alias("origin"))
    return filled.unionByName(old.join(new, key, "left_anti").select(*new.columns, F.lit("old").alias("origin")))


def keep_review(generated: DataFrame, existing: DataFrame, key: str, kept: list[str], status: str, untouched: tuple[str, ...]) -> DataFrame:
    """The generated rows with what reviewers wrote on the existing ones of their key, and worked-on rows that are no longer generated.

    A key with several existing rows (a reviewer split it) keeps them all: each takes the generated row, and its own cells of
    ``kept`` where they are filled. An existing row of a key that isn't generated stays as it is if a cell of ``kept`` other than
    ``status`` is filled or its status isn't one of ``untouched`` or blank. Blank counts as null. Generated keys are distinct.
    """
    filled = lambda c: F.when(F.trim(F.col(c).cast("string")) != "", F.col(c))
    prior = existing.select(F.col(key).alias("__key"), *(filled(c).alias(f"__{c}") for c in kept))
    merged = generated.join(prior, F.col(key) == F.col("__key"), "left").select(*(F.coalesce(f"__{c}", c).alias(c) if c in kept else F.col(c) for c in generated.columns))
    worked = F.coalesce(filled(status), F.lit("")).isin("", *untouched) == F.lit(False)
    for c in kept:
        if c != status:
            worked = worked | filled(c).isNotNull()
    left = existing.where(worked).join(generated.select(key), key, "left_anti")
    return merged.unionByName(left.select(*generated.columns))


def tagged_union(parts: dict[str, DataFrame], tag: str) -> DataFrame:
    """Rows of several tables with the name of theirs; missing columns are NULL."""
    out = None
    for name, df in parts.items():
        df = df.withColumn(tag, F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def record_places(records: DataFrame, record_id: str, places: str, primary: str, valid: DataFrame, place: str) -> DataFrame:
    """A record's list of places as rows in the known universe, is_primary if any row says so."""
    rows = records.select(record_id, F.explode(places).alias(place), F.col(primary).alias("__p"))
    return rows.join(valid, place).groupBy(record_id, place).agg(F.bool_or(F.col(place) == F.col("__p")).alias("is_primary"))
