"""Scores, ledgers and model evaluation as column algebra and small aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cairn.operators.windows import by_value_counts, running_sum
from cairn.sources.scratch import cut_lineage


def stack(points: Column, rest: float = 0.25, cap: float = 100.0) -> Column:
    """The largest of an array of points in full, the others weighted, all capped."""
    ordered = F.reverse(F.array_sort(points))
    others = F.aggregate(F.slice(ordered, 2, F.greatest(F.size(ordered) - 1, F.lit(0))), F.lit(0.0), lambda a, x: a + x)
    return F.least(F.lit(cap), F.coalesce(F.get(ordered, F.lit(0)), F.lit(0.0)) + others * rest)


def smoothed_share(part: Column, whole: Column, prior: float = 0.8, weight: int = 5) -> Column:
    """A33."""
    return (part + weight * prior) / (whole + weight)


def shrink(record: Column, prior: Column, n: Column, k: float) -> Column:
    """Weight n / (n + k) on the record, the rest on the prior."""
    w = n / (n + k)
    return w * record + (1 - w) * prior


def calibration_bins(df: DataFrame, p: str, y: str, bins: int = 5) -> DataFrame:
    """Equal-width bins, the last one closed: n, mean prediction, observed rate."""
    b = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).cast("int")
    return df.where(f"{p} IS NOT NULL AND {y} IS NOT NULL").groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.avg(p).alias("mean_p"), F.avg(F.col(y).cast("double")).alias("rate"))


def calibration_gate(df: DataFrame, p: str, y: str, max_ece: float = 0.15, min_n: int = 60) -> DataFrame:
    """Brier score, skill over the base rate, expected calibration error, PROMOTE or HOLD."""
    bins = calibration_bins(df, p, y)
    ece = bins.agg((F.sum(F.col("n") * F.abs(F.col("mean_p") - F.col("rate"))) / F.sum("n")).alias("ece"))
    brier = df.agg(F.count("*").alias("n"), F.avg(F.pow(F.col(p) - F.col(y), 2)).alias("brier"), (F.avg(F.col(y).cast("double")) * (1 - F.avg(F.col(y).cast("double")))).alias("base"))
    both = brier.join(F.broadcast(ece))
    skill = 1 - F.col("brier") / F.nullif(F.col("base"), F.lit(0.0))
    return both.select("n", "brier", skill.alias("skill"), "ece", F.when((F.col("n") >= min_n) & (F.col("ece") <= max_ece) & (skill > 0), "PROMOTE").otherwise("HOLD").alias("verdict"))


def pair_auc(df: DataFrame, score: str, y: str) -> DataFrame:
    """The rank-sum form, ties at half; ranks come from counts per distinct score."""
    counts = df.groupBy(score).agg(F.sum(F.col(y).cast("long")).alias("pos"), F.count("*").alias("n"))
    pairs = running_sum(counts, [F.col(score)], F.col("n") - F.col("pos")).withColumn("won", F.col("pos") * (F.col("__below") + (F.col("n") - F.col("pos")) * 0.5))
    total = pairs.agg(F.sum("won").alias("won"), F.sum("pos").alias("pos"), F.sum(F.col("n") - F.col("pos")).alias("neg"))
    return total.select((F.col("won") / F.nullif(F.col("pos") * F.col("neg"), F.lit(0))).alias("auc"), "pos", "neg")


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """The correlation of mid-ranks."""
    rows = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("__a"), F.col(b).alias("__b"))
    mid = lambda c: by_value_counts(rows, c).select(c, (F.col("__below") + (F.col("__same") + 1) / 2).alias(f"{c}r"))
    ranked = rows.join(mid("__a"), "__a").join(mid("__b"), "__b")
    return ranked.agg(F.corr("__ar", "__br").alias("rho"), F.count("*").alias("n"))


def morans_i(values: DataFrame, edges: DataFrame, node: str, value: str) -> DataFrame:
    """Row-standardised contiguity: z . Wz / z . z over nodes that have neighbours."""
    mean = values.agg(F.avg(value).alias("__m"))
    z = values.join(F.broadcast(mean)).select(node, (F.col(value) - F.col("__m")).alias("z"))
    lag = edges.join(z.select(F.col(node).alias("b"), F.col("z").alias("zb")), "b").groupBy("a").agg(F.avg("zb").alias("lag"))
    met = z.join(lag, z[node] == lag["a"])
    return met.agg((F.sum(F.col("z") * F.col("lag")) / F.sum(F.col("z") * F.col("z"))).alias("morans_i"), F.count("*").alias("n"))


def morans_p(values: DataFrame, edges: DataFrame, node: str, value: str, permutations: int = 999, seed: str = "0") -> DataFrame:
    """(morans_i, p, expected, n): I over all nodes, and the one-sided share of shuffles that reach it.

    A shuffle puts the values of the nodes in the order of MD5 over (seed, shuffle, node), so it is the same on
    every engine; shuffle 0 is the data. Nodes are places: shuffles are spread over tasks, each sorts the nodes once.
    A node without neighbours has lag 0. A constant value has no I.
    """
    mean = values.agg(F.avg(value).alias("__m"))
    z = values.join(F.broadcast(mean)).select(F.col(node).alias("a"), (F.col(value) - F.col("__m")).alias("z"))
    runs = z.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(permutations))))
    key = F.when(F.col("k") > 0, F.md5(F.concat_ws(":", F.lit(seed), F.col("k").cast("string"), F.col("a").cast("string"))))
    place = lambda *by: F.row_number().over(W.partitionBy("k").orderBy(*by))
    ranked = runs.withColumn("at", place("a")).withColumn("from", place(key.asc_nulls_first(), "a"))
    moved = ranked.select("k", "a", "at").join(ranked.select("k", F.col("from").alias("at"), "z"), ["k", "at"]).select("k", "a", "z")
    known = edges.select("a", "b").distinct()
    lags = known.join(moved.select("k", F.col("a").alias("b"), F.col("z").alias("zb")), "b").groupBy("k", "a").agg(F.avg("zb").alias("lag"))
    # written once, as it is read both for the data's own value and for the others'
    stats = cut_lineage(moved.join(lags, ["k", "a"], "left").groupBy("k").agg((F.count("*") / F.count("lag") * F.sum(F.col("z") * F.coalesce("lag", F.lit(0.0))) / F.nullif(F.sum(F.col("z") * F.col("z")), F.lit(0.0))).alias("i"), F.count("*").alias("n")))
    seen = F.max(F.when(F.col("k") == 0, F.col("i")))
    # sums of the same terms in another order differ in the last digits: equal within 1e-9 counts as reached
    both = stats.agg(seen.alias("i"), F.max("n").alias("n")).join(stats.where("k > 0").select(F.col("i").alias("other")), how="left")
    reached = F.count_if(F.col("other") >= F.col("i") - 1e-9)
    return both.groupBy("i", "n").agg(((reached + 1) / F.lit(permutations + 1)).alias("p")).select(F.col("i").alias("morans_i"), "p", (F.lit(-1.0) / (F.col("n") - 1)).alias("expected"), "n")


def npv_deferral(amount: Column, years: Column, low: float, high: float) -> tuple[Column, Column]:
    """what deferring an amount costs at either end of a rate range, smaller first."""
    cost = lambda r: amount * (1 - 1 / F.pow(F.lit(1 + r), years))
    return F.least(cost(low), cost(high)), F.greatest(cost(low), cost(high))


def sensitivity(df: DataFrame, result, base: dict[str, float], ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """One-at-a-time: the result with each parameter at its ends and the others at base."""
    cases = [("base", base)] + [(f"{k}:{end}", base | {k: v}) for k, ends in ranges.items() for end, v in zip(("low", "high"), ends, strict=True)]
    return df.withColumn("case", F.explode(F.array(*(F.struct(F.lit(n).alias("name"), result(p).alias("value")) for n, p in cases)))).select(*df.columns, F.col("case.name").alias("case"), F.col("case.value").alias("value"))
