"""Joins beyond plain equality: as-of, interval, unique, blocked, margin, overlay, neighbour."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cairn.operators.windows import running_sum
from cairn.sources.scratch import cut_lineage


def asof_value(left: DataFrame, right: DataFrame, keys: list[str], left_at: str, right_at: str, value: str, *, lag: str | None = None, tie: str | None = None, out: str = "value") -> DataFrame:
    """For each left row the last right value of its key at or before its time less ``lag``.

    Both sides are united and read once in order: linear, with no range join. ``lag`` is an interval such as '1 day'.
    Of right rows of one key and time the one with the greatest ``tie`` counts, or else the one with the greatest value.
    """
    at = F.col(left_at) - F.expr(f"INTERVAL {lag}") if lag else F.col(left_at)
    by = right.schema[tie or value].dataType
    a = left.withColumn("__at", at).withColumn("__left", F.lit(True)).withColumn("__value", F.lit(None).cast(right.schema[value].dataType)).withColumn("__tie", F.lit(None).cast(by))
    b = right.select(*keys, F.col(right_at).alias("__at"), F.lit(False).alias("__left"), F.col(value).alias("__value"), F.col(tie or value).alias("__tie"))
    order = W.partitionBy(*keys).orderBy("__at", "__left", "__tie").rowsBetween(W.unboundedPreceding, 0)
    both = a.unionByName(b, allowMissingColumns=True).withColumn(out, F.last("__value", ignorenulls=True).over(order))
    return both.where("__left").drop("__at", "__left", "__value", "__tie")


def asof_count(df: DataFrame, keys: list[str], at: str, out: str = "n_before") -> DataFrame:
    """Rows of the same key strictly before; ties don't count one another."""
    return df.withColumn(out, F.rank().over(W.partitionBy(*keys).orderBy(at)) - 1)


def interval_points(spans: DataFrame, start: str, end: str, unit: str = "month") -> DataFrame:
    """One row per month end ``at`` with start <= at < end; each span lists its own points, so the join is an explode."""
    months = F.transform(F.sequence(F.trunc(start, unit), F.trunc(end, unit), F.expr("INTERVAL 1 MONTH")), lambda d: F.last_day(d))
    return spans.withColumn("at", F.explode(months)).where((F.col("at") >= F.col(start)) & (F.col("at") < F.col(end)))


def unique_match(left: DataFrame, right: DataFrame, key: str, right_id: str) -> DataFrame:
    """The one right row with the key, or a reason there is none. Candidates are counted before the join."""
    counted = right.groupBy(key).agg(F.count("*").alias("__n"), F.min(right_id).alias("__id"))
    found = left.join(counted, key, "left")
    method = F.when(F.col("__n").isNull(), "no_match").when(F.col("__n") > 1, "ambiguous").otherwise("unique")
    return found.withColumn("method", method).withColumn("match_id", F.when(F.col("__n") == 1, F.col("__id"))).drop("__n", "__id")


def cascade_match(left: DataFrame, left_id: str, steps: list[tuple[str, Column, DataFrame, Column]], right_id: str) -> DataFrame:
    """The first step, in order, that has exactly one candidate for a row.

    A step is (name, left key, right table, right key). Each right side is one row per key, so the left rows are read
    once and joined step by step without growing.
    """
    tried, ids, names = left, [], []
    for n, (name, left_key, right, right_key) in enumerate(steps):
        one = right.select(right_key.alias(f"__k{n}"), F.col(right_id).alias("__id")).groupBy(f"__k{n}").agg(F.count_distinct("__id").alias("__n"), F.min("__id").alias(f"__id{n}")).where("__n = 1").drop("__n")
        tried = tried.join(one, left_key == F.col(f"__k{n}"), "left")
        ids.append(F.col(f"__id{n}"))
        names.append(F.when(F.col(f"__id{n}").isNotNull(), name))
    return tried.select(left_id, F.coalesce(*ids).alias("match_id"), F.coalesce(*names, F.lit("no_match")).alias("method"))


def margin_match(scored: DataFrame, left_id: str, right_id: str, score: str, margin: float) -> DataFrame:
    """Best candidate if it leads by ``margin`` and nobody else claims it; otherwise ambiguous.

    One window ranks a left row's candidates; claims are counted once, over the winners.
    """
    order = W.partitionBy(left_id).orderBy(F.desc(score), right_id)
    ranked = scored.withColumn("__rn", F.row_number().over(order)).withColumn("__next", F.lead(score).over(order)).where("__rn = 1")
    return _claimed(ranked.select(left_id, F.col(right_id).alias("best_id"), F.col(score).alias("best_score"), "__next"), margin).drop("__next")


def _claimed(best: DataFrame, margin: float) -> DataFrame:
    """``best(…, best_id, best_score, __next)`` with status; __next is the score of the second candidate."""
    leads = F.coalesce(F.col("best_score") - F.col("__next") >= margin, F.lit(True))
    claims = F.count(F.when(leads, 1)).over(W.partitionBy("best_id"))
    return best.withColumn("status", F.when(~leads, "ambiguous_margin").when(claims > 1, "ambiguous_claim").otherwise("matched"))


def _finite(c: str) -> Column:
    return F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))


def _two_best(entries: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, score, n, first, __next): the highest score of entries(keys, score, n, first), null ones last, its candidates and their smallest id, and the score after it."""
    each = entries.groupBy(*keys, "score").agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    order = W.partitionBy(*keys).orderBy(F.desc("score"))
    second = F.when(F.col("n") > 1, F.col("score")).otherwise(F.lead("score").over(order))
    return each.withColumns({"__next": second, "__rn": F.row_number().over(order)}).where("__rn = 1").drop("__rn")


def nearest_margin(left: DataFrame, right: DataFrame, block: str, left_id: str, right_id: str, left_value: str, right_value: str, score: Callable[[Column, Column], Column], margin: float) -> DataFrame:
    """J15 for a score that never rises with the distance of two numbers: ``margin_match`` over all pairs of a block, without making them.

    The distinct values of both sides are put in one global order, cut into ranges. The two values below and the two above
    hold the best and the second score, found by their place. Where values further on round to the best score as well, the smallest
    id among them comes from minima over runs of 1, 2, 4, … values, so many equal scores cost steps and no pairs. Values that have
    no place in the order (null, NaN, infinite) are a few per block and are scored with all of them.
    """
    values = right.where(F.col(block).isNotNull()).groupBy(F.col(block).alias("block"), F.col(right_value).cast("double").alias("v")).agg(F.count("*").alias("n"), F.min(right_id).alias("first"))
    wanted = left.where(F.col(block).isNotNull()).select(F.col(block).alias("block"), F.col(left_value).cast("double").alias("s")).distinct()
    both = values.where(_finite("v")).withColumn("is_left", F.lit(0)).unionByName(wanted.where(_finite("s")).select("block", F.col("s").alias("v"), F.lit(1).alias("is_left")), allowMissingColumns=True)
    placed = cut_lineage(running_sum(both, [F.col("block"), F.col("v"), F.col("is_left")], 1 - F.col("is_left"), "at").drop("__n"))
    there = placed.where("is_left = 0").select("at", "block", "v", "n", "first")
    here = placed.where("is_left = 1").select("block", F.col("v").alias("s"), "at")
    scored = lambda df: df.withColumn("score", score(F.col("s"), F.col("v")))
    near = here.withColumnRenamed("at", "__at").withColumn("k", F.explode(F.array(*map(F.lit, (-2, -1, 0, 1))))).withColumn("at", F.col("__at") + F.col("k"))
    near = cut_lineage(scored(near.join(there, ["at", "block"])).select("block", "s", "__at", "k", "score", "n", "first"))
    odd, any_ = values.where(~_finite("v")), wanted.where(~_finite("s"))
    entries = near.unionByName(scored(wanted.where(_finite("s")).join(odd, "block")), allowMissingColumns=True).unionByName(scored(any_.join(values, "block")), allowMissingColumns=True).select("block", "s", "score", "n", "first")
    best = cut_lineage(_two_best(entries, ["block", "s"]))
    # values beyond the two of a side are looked at only where the outer one of these has the best score
    outer = near.where("k IN (-2, 1)").join(best.select("block", "s", F.col("score").alias("best")), ["block", "s"]).where("score = best")
    walks = outer.select("block", "s", "best", F.when(F.col("k") < 0, -1).otherwise(1).alias("side"), (F.col("__at") + F.when(F.col("k") < 0, -3).otherwise(2)).alias("at"))
    more = _smallest_along(there, walks.withColumn("at", F.col("at") * F.col("side")), score)
    best = best.join(more.groupBy("block", F.col("s").alias("__s")).agg(F.min("least").alias("least")).withColumnRenamed("block", "__b"), (F.col("block") == F.col("__b")) & (F.col("s") == F.col("__s")), "left")
    best = best.select(F.col("block").alias("__block"), "s", "score", "n", F.least("first", "least").alias("first"), "__next")
    met = left.join(best, (F.col(block) == F.col("__block")) & F.col(left_value).cast("double").eqNullSafe(F.col("s"))).select(left_id, "score", "n", "first", "__next")
    # rows of one id stand for it together
    seconds = met.where("n = 1 AND __next IS NOT NULL").select(left_id, F.col("__next").alias("score"), F.lit(1).cast("long").alias("n"), F.lit(None).cast(met.schema["first"].dataType).alias("first"))
    found = _two_best(met.drop("__next").unionByName(seconds), [left_id])
    return _claimed(found.select(left_id, F.col("first").alias("best_id"), F.col("score").alias("best_score"), "__next"), margin).drop("__next")


def _smallest_along(there: DataFrame, walks: DataFrame, score: Callable[[Column, Column], Column]) -> DataFrame:
    """(block, s, least): for each of walks(block, s, best, side, at) the smallest ``first`` of the values that follow from place ``at`` on and have the score ``best``.

    Runs of 1, 2, 4, … values with their smallest id and last value are made while some walk passes a whole run, then walked in
    shorter and shorter ones. Side -1 counts places downwards.
    """
    walks = cut_lineage(walks.withColumn("least", F.lit(None).cast(there.schema["first"].dataType)))
    if walks.isEmpty():
        return walks.select("block", "s", "least")
    sides = there.withColumn("side", F.explode(F.array(F.lit(-1), F.lit(1)))).join(walks.select("block").distinct(), "block", "left_semi")
    level = cut_lineage(sides.select("block", "side", (F.col("at") * F.col("side")).alias("at"), F.col("first").alias("run"), F.col("v").alias("end")))
    levels = []

    def step(runs: DataFrame, length: int) -> DataFrame:
        passed = F.coalesce(score(F.col("s"), F.col("end")) == F.col("best"), F.lit(False))
        met = walks.join(runs, ["block", "side", "at"], "left").withColumn("passed", passed)
        return cut_lineage(met.select("block", "s", "best", "side", (F.col("at") + F.when(F.col("passed"), length).otherwise(0)).alias("at"), F.when(F.col("passed"), F.least("least", "run")).otherwise(F.col("least")).alias("least"), "passed"))

    while True:
        levels.append(level)
        walked = step(level, 1 << (len(levels) - 1))
        walks = walked.drop("passed")
        if walked.where("passed").isEmpty():
            break
        after = level.select("block", "side", (F.col("at") - (1 << (len(levels) - 1))).alias("at"), F.col("run").alias("__run"), F.col("end").alias("__end"))
        level = cut_lineage(level.join(after, ["block", "side", "at"]).select("block", "side", "at", F.least("run", "__run").alias("run"), F.col("__end").alias("end")))
    for k in reversed(range(len(levels) - 1)):
        walks = step(levels[k], 1 << k).drop("passed")
    return walks.select("block", "s", "least")


def overlay(base: DataFrame, review: DataFrame, key: str, columns: list[str], gate: Column, newest: list[str]) -> DataFrame:
    """The newest admitted review row of a key overrides the base columns it fills."""
    order = F.struct(*newest)
    chosen = review.where(gate).groupBy(key).agg(*(F.max_by(c, order).alias(f"__{c}") for c in columns))
    joined = base.join(chosen, key, "left")
    return joined.select(*(F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in base.columns))


def unknown_keys(review: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """Review rows that name nothing; an error for the caller to raise."""
    return review.join(base, key, "left_anti")


def overlapping(left: DataFrame, right: DataFrame, key: str, left_set: str, right_set: str) -> DataFrame:
    """Left rows with a flag whether some right row of the key shares a value.

    The sets are exploded to (key, value) pairs and met by equality, so a block of m and n rows costs m + n. What is
    met is each distinct (key, set), so rows need no number of their own. A NULL key, set or value meets nothing.
    """
    pairs = right.select(F.col(key).alias("__k"), F.explode(right_set).alias("__v")).distinct()
    sets = left.select(F.col(key).alias("__k"), F.col(left_set).alias("__s")).distinct()
    met = sets.withColumn("__v", F.explode("__s")).join(pairs, ["__k", "__v"], "left_semi").select("__k", "__s", F.lit(True).alias("__met")).distinct()
    joined = left.join(met, (F.col(key) == F.col("__k")) & (F.col(left_set) == F.col("__s")), "left")
    return joined.select(*left.columns, F.coalesce("__met", F.lit(False)).alias("matched"))


def neighbours(edges: DataFrame, rows: DataFrame, node: str, exclude: DataFrame | None = None) -> DataFrame:
    """Rows seen from each neighbour of their node, less the nodes in ``exclude``."""
    seen = edges.withColumnRenamed("a", node).join(rows, node).withColumnRenamed("b", "neighbour")
    return seen.join(exclude.withColumnRenamed(node, "neighbour"), "neighbour", "left_anti") if exclude is not None else seen


def region_edges(nodes: DataFrame, node: str, region: str) -> DataFrame:
    """A symmetric edge list (a, b): nodes of one region, without self-loops."""
    left, right = nodes.select(F.col(node).alias("a"), F.col(region).alias("r")), nodes.select(F.col(node).alias("b"), F.col(region).alias("r"))
    return left.join(right, "r").where("a <> b").select("a", "b")


def first_other(df: DataFrame, block: list[str], row_id: str, wanted: Column) -> DataFrame:
    """For each row the first wanted row of its block with another id.

    Only a block's two smallest wanted ids can be the answer, so those two are aggregated and joined back.
    """
    two = df.where(wanted).groupBy(*block).agg(F.min(row_id).alias("__first"))
    later = df.where(wanted).join(two, block).where(F.col(row_id) > F.col("__first")).groupBy(*block).agg(F.min(row_id).alias("__second"))
    joined = df.join(two, block, "left").join(later, block, "left")
    return joined.withColumn("sibling", F.when(F.col("__first") != F.col(row_id), F.col("__first")).otherwise(F.col("__second"))).drop("__first", "__second")


def first_wins(df: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """W6, J26 for one key: the first row of each key by an explicit order, NULLs first; rows without a key all stay.

    A minimum, not a sort of each key: what a task knows to be later doesn't travel, so a stock key of very many rows is one row of each task.
    """
    keyed = df.withColumn("__k", key)
    first = keyed.where("__k IS NOT NULL").groupBy("__k").agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("__r"))
    return first.select("__r.*").unionByName(keyed.where("__k IS NULL").drop("__k"))


def within_distance(a: DataFrame, b: DataFrame, miles: float, distance: Column, cell: float = 1.0) -> DataFrame:
    """Pairs of a(lat, lon) and b(lat2, lon2) at most ``miles`` apart.

    b goes to the grid cells its circle can reach, a to its own: an equality join, then the exact distance.
    Valid away from the poles and the date line.
    """
    reach = miles / 69.0
    wide = F.lit(reach) / F.greatest(F.cos(F.radians(F.abs("lat2") + reach)), F.lit(0.05))
    cells = lambda c, r: F.sequence(F.floor((F.col(c) - r) / cell), F.floor((F.col(c) + r) / cell))
    spread = b.withColumn("__y", F.explode(cells("lat2", F.lit(reach)))).withColumn("__x", F.explode(cells("lon2", wide)))
    placed = a.withColumn("__y", F.floor(F.col("lat") / cell)).withColumn("__x", F.floor(F.col("lon") / cell))
    return placed.join(spread, ["__y", "__x"]).withColumn("miles", distance).where(F.col("miles") <= miles).drop("__y", "__x")
