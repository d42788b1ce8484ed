"""Ranking and change detection. A global order is cut into ranges, so that no task sees the whole column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cairn.sources.scratch import cut_lineage


def running_sum(df: DataFrame, order: list[Column], add: Column, below: str = "__below", total: str = "__n") -> DataFrame:
    """The sum of ``add`` over the rows before each row in a global order, and over all rows.

    Rows are range-partitioned by the order and written with the number of their range, so that a lost task can't
    number them anew; sums within a range then need only that range, and what lies before it comes from a table of
    one row per range. Equal rows of the order share a range. NULLs come where the order puts them.
    """
    ranged = cut_lineage(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()).withColumn("__add", add.cast("long")))
    sums = ranged.groupBy("__range").agg(F.sum("__add").alias("__sum"))
    earlier = F.sum("__sum").over(W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1))
    offsets = sums.select("__range", F.coalesce(earlier, F.lit(0)).alias("__offset"), F.sum("__sum").over(W.partitionBy()).alias(total))
    within = F.sum("__add").over(W.partitionBy("__range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    placed = ranged.withColumn("__within", F.coalesce(within, F.lit(0))).join(F.broadcast(offsets), "__range")
    return placed.select(*df.columns, (F.col("__offset") + F.col("__within")).alias(below), total)


def numbered(df: DataFrame, order: list[Column | str], made: dict[str, Column] | None = None, out: str = "__below") -> DataFrame:
    """The number of rows before each row in a global order: ``running_sum`` of ones, for one exchange less.

    A range is sorted where it arrives and its rows are numbered there, as they are written; the counts of the ranges before it are
    added. Columns of the order named in ``made`` don't travel: they are evaluated to deal rows out, and again to sort.
    """
    made = made or {}
    ranged = df.repartitionByRange(*(made.get(c, c) if isinstance(c, str) else c for c in order))
    ranged = (ranged.withColumns(made) if made else ranged).sortWithinPartitions(*order).withColumns({"__range": F.spark_partition_id(), "__within": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    ranged = cut_lineage(ranged.select(*df.columns, "__range", "__within"))
    sums = ranged.groupBy("__range").agg(F.count("*").alias("__sum"))
    earlier = F.sum("__sum").over(W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1))
    offsets = sums.select("__range", F.coalesce(earlier, F.lit(0)).alias("__offset"), F.sum("__sum").over(W.partitionBy()).alias("__n"))
    return ranged.join(F.broadcast(offsets), "__range").select(*df.columns, (F.col("__offset") + F.col("__within")).alias(out), "__n")


def by_value_counts(df: DataFrame, value: str) -> DataFrame:
    """Rows per value, with the rows below it: what ranks and percentiles need.

    Values are counted by a partial aggregate first, so what is ordered are distinct values.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("__same"))
    return running_sum(counts, [F.col(value)], F.col("__same"))


def competition_rank(df: DataFrame, value: str, out: str = "rank_all") -> DataFrame:
    """One plus the rows with a greater value."""
    c = by_value_counts(df, value)
    return df.join(c.select(value, (F.col("__n") - F.col("__below") - F.col("__same") + 1).alias(out)), value, "left")


def midrank_percentile(df: DataFrame, value: str, out: str = "pct") -> DataFrame:
    """100 (below + same / 2) / n, one decimal."""
    c = by_value_counts(df, value)
    return df.join(c.select(value, F.round((F.col("__below") + F.col("__same") * 0.5) * 100 / F.col("__n"), 1).alias(out)), value, "left")


def decile(rank: Column, n: Column) -> Column:
    """min(10, 1 + floor(10 i / n)) on a 0-based order."""
    return F.least(F.lit(10), F.floor((rank - 1) * 10 / n) + 1).cast("int")


def deciles(df: DataFrame, order: list[Column], out: str = "decile") -> DataFrame:
    """Tenths of all rows by a global order."""
    return numbered(df, order).withColumn(out, decile(F.col("__below") + 1, F.col("__n"))).drop("__below", "__n")


# Acklam's rational approximation of the inverse normal, highest power first, for the middle and the tails.
MIDDLE_TOP = (-39.69683028665376, 220.9460984245205, -275.9285104469687, 138.3577518672690, -30.66479806614716, 2.506628277459239)
MIDDLE_BOTTOM = (-54.47609879822406, 161.5858368580409, -155.6989798598866, 66.80131188771972, -13.28068155288572, 1.0)
TAIL_TOP = (-0.007784894002430293, -0.3223964580411365, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783)
TAIL_BOTTOM = (0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416, 1.0)
TAIL = 0.02425


def _polynomial(x: Column, powers: tuple[float, ...]) -> Column:
    value = F.lit(powers[0])
    for c in powers[1:]:
        value = value * x + c
    return value


def inverse_normal(p: Column) -> Column:
    """The standard normal quantile of 0 < p < 1, to a relative error of about 1e-9; NULL outside."""
    q = p - 0.5
    r = q * q
    near = q * _polynomial(r, MIDDLE_TOP) / _polynomial(r, MIDDLE_BOTTOM)
    t = F.sqrt(-2 * F.ln(F.least(p, 1 - p)))
    far = _polynomial(t, TAIL_TOP) / _polynomial(t, TAIL_BOTTOM)
    z = F.when(p < TAIL, far).when(p > 1 - TAIL, -far).otherwise(near)
    return F.when((p > 0) & (p < 1), z)


def normal_score(rank: Column, n: Column) -> Column:
    """Blom's score of a 1-based rank, three decimals."""
    return F.round(inverse_normal((rank - 0.375) / (n + 0.25)), 3) + 0.0


def normal_scores(df: DataFrame, order: list[Column], out: str = "normal", out_decile: str = "decile") -> DataFrame:
    """Blom's score and the tenth of each row by a global order, whose later columns break ties."""
    ranked = numbered(df, order)
    rank = F.col("__below") + 1
    return ranked.withColumn(out, normal_score(rank, F.col("__n"))).withColumn(out_decile, decile(rank, F.col("__n"))).drop("__below", "__n")


def changes_only(df: DataFrame, keys: list[str], order: list[str], state: list[str]) -> DataFrame:
    """Rows whose state differs from the one before of their key."""
    w = W.partitionBy(*keys).orderBy(*order)
    before = df.withColumn("__b", F.lag(F.struct(*state)).over(w))
    return before.where(F.col("__b").isNull() | ~F.struct(*state).eqNullSafe(F.col("__b"))).drop("__b")


def top_waves(df: DataFrame, order: list[Column], n: int, wave: int) -> DataFrame:
    """The first n rows, numbered, in waves. The limit comes first, so the window sees n rows."""
    top = df.orderBy(*order).limit(n)
    return top.withColumn("position", F.row_number().over(W.orderBy(*order))).withColumn("wave", F.floor((F.col("position") - 1) / wave).cast("int") + 1)


def hash_sample(df: DataFrame, row_id: str, seed: str, n: int) -> DataFrame:
    """The n rows with the smallest SHA-256 of seed and id; the same draw on every engine."""
    return df.withColumn("__h", F.sha2(F.concat(F.lit(seed), F.col(row_id).cast("string")), 256)).orderBy("__h").limit(n).drop("__h")


def quota(df: DataFrame, group: str, order: list[Column], n: int, recent: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """The first n rows per group, without keys attempted lately."""
    rows = df.join(recent, key, "left_anti") if recent is not None else df
    return rows.withColumn("position", F.row_number().over(W.partitionBy(group).orderBy(*order))).where(F.col("position") <= n)


def dense_priority(df: DataFrame, order: list[Column], out: str = "priority") -> DataFrame:
    """1..n over a worklist."""
    return numbered(df, order).withColumn(out, (F.col("__below") + 1).cast("int")).drop("__below", "__n")


def enum_order(c: Column, values: tuple[str, ...]) -> Column:
    """The place of a value in a fixed order, unknown ones last."""
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, values)), c), F.lit(0)), F.lit(len(values) + 1))
