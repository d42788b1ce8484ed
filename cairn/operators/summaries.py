"""Summaries of inventories, queues and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def place_tally(rows: DataFrame, instrument: str, places: str, flags: dict[str, Column]) -> DataFrame:
    """Per place the distinct instruments, and those of which any row has a flag."""
    per = rows.withColumn("place", F.explode(places)).groupBy("place", instrument).agg(*(F.bool_or(c).alias(n) for n, c in flags.items()))
    return per.groupBy("place").agg(F.count("*").alias("n_instruments"), *(F.count_if(n).alias(n) for n in flags))


def source_registry(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """(url, n, entities) over several url columns, most cited first."""
    out = None
    for entity, (df, columns) in tables.items():
        for c in columns:
            part = df.select(F.nullif(F.trim(c), F.lit("")).alias("url"), F.lit(entity).alias("entity")).where("url IS NOT NULL")
            out = part if out is None else out.unionByName(part)
    return out.groupBy("url").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("entity")).alias("entities")).orderBy(F.desc("n"), "url")


def plants(units: DataFrame, key: str) -> DataFrame:
    """Generators to plants: technologies, total MW, units, first month of operating ones, commonest status."""
    status = units.groupBy(key, "status").agg(F.count("*").alias("n")).groupBy(key).agg(F.min_by("status", F.struct(-F.col("n"), F.col("status"))).alias("status"))
    sums = units.groupBy(key).agg(F.array_sort(F.collect_set("technology")).alias("technologies"), F.sum("mw").alias("mw"), F.count("*").alias("units"), F.min(F.when(F.col("status") == "operating", F.struct("year", "month"))).alias("since"), F.max(F.when(F.col("status") == "planned", F.struct("year", "month"))).alias("due"))
    return sums.join(status, key).select(key, "technologies", "mw", "units", "status", F.coalesce("since.year", "due.year").alias("year"), F.coalesce("since.month", "due.month").alias("month"))


def projects(turbines: DataFrame, key: str, county: str) -> DataFrame:
    """Turbines to projects: commonest county, first year, mean position to five decimals."""
    usual = turbines.groupBy(key, county).agg(F.count("*").alias("n")).groupBy(key).agg(F.min_by(county, F.struct(-F.col("n"), F.col(county))).alias(county))
    return turbines.groupBy(key).agg(F.min("year").alias("year"), F.round(F.avg("lat"), 5).alias("lat"), F.round(F.avg("lon"), 5).alias("lon"), F.count("*").alias("turbines")).join(usual, key)


def pivot_pairs(rows: DataFrame, key: str, pairs: list[tuple[str, str]], kinds: tuple[str, ...]) -> DataFrame:
    """Up to n (type, amount) pairs of a row as one column per kind."""
    listed = F.array(*(F.struct(F.col(t).alias("t"), F.col(a).cast("double").alias("a")) for t, a in pairs))
    amount = lambda k: F.aggregate(F.filter(listed, lambda p: (p["t"] == k) & p["a"].isNotNull()), F.lit(0.0), lambda s, p: s + p["a"])
    return rows.select(key, *(amount(k).alias(k) for k in kinds))


def merged_cells(rows: DataFrame, keys: list[str], columns: list[str], order: str, sep: str = "; ") -> DataFrame:
    """One row per key; the differing values of a cell in first-seen order."""
    def cell(c: str) -> Column:
        seen = F.array_sort(F.collect_list(F.when(F.col(c) != "", F.struct(F.col(order).alias("o"), F.col(c).alias("v")))))
        return F.array_join(F.array_distinct(F.transform(seen, lambda s: s["v"])), sep).alias(c)

    return rows.groupBy(*keys).agg(*(cell(c) for c in columns))


def scored_groups(features: DataFrame, keys: list[str], points: Column, least: float) -> DataFrame:
    """Groups whose features score enough, with their drivers."""
    g = features.withColumn("__p", points).groupBy(*keys).agg(F.sum("__p").alias("score"), F.max_by("feature", F.struct("__p", "feature")).alias("driver"), F.count("*").alias("n_features"))
    return g.where(F.col("score") >= least)


def dropped_by_reason(rows: DataFrame, reason: Column) -> DataFrame:
    """Rows by the reason they were dropped for; kept ones under 'kept'."""
    return rows.groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def comparison_frames(rows: DataFrame, state: str, place: str, here: str, here_state: str, flags: dict[str, Column]) -> DataFrame:
    """The same counts for the nation, a state and a place, from one pass over tagged rows."""
    frames = F.array_compact(F.array(F.lit("nation"), F.when(F.col(state) == here_state, F.lit("state")), F.when(F.col(place) == here, F.lit("self"))))
    return rows.withColumn("frame", F.explode(frames)).groupBy("frame").agg(F.count("*").alias("n"), *(F.count_if(c).alias(n) for n, c in flags.items()))


def snapshot_features(requests: DataFrame, events: DataFrame, key: str, at: str, kinds: dict[str, Column]) -> DataFrame:
    """For each request the events of its key strictly before it, by kind.

    Events are pre-summed per (key, time), united with the requests and accumulated once in time order; a request comes
    before events of its own time, so nothing dated then enters.
    """
    from pyspark.sql import Window as W

    per = events.groupBy(key, F.col(at).alias("__at")).agg(*(F.count_if(c).alias(f"__{n}") for n, c in kinds.items())).withColumn("__req", F.lit(1))
    asked = requests.withColumn("__at", F.col(at)).withColumn("__req", F.lit(0))
    w = W.partitionBy(key).orderBy("__at", "__req").rowsBetween(W.unboundedPreceding, -1)
    both = asked.unionByName(per, allowMissingColumns=True)
    counted = both.select("*", *(F.coalesce(F.sum(f"__{n}").over(w), F.lit(0)).alias(n) for n in kinds))
    return counted.where("__req = 0").select(*requests.columns, *kinds)


def operations_summary(held: DataFrame, queue: DataFrame, checks: DataFrame, trail: DataFrame) -> DataFrame:
    """(section, measure, key, n): what other jobs wrote, counted; each section is one partial aggregate.

    quarantine: rows of held(entity, issues) by entity, and their issues of HIGH or CRITICAL severity by code. review: rows of
    queue(review_status, entity_type) by status (blank: pending) and by entity. evidence: rows of checks(instrument_id, verdict, access) by the
    family that an id's prefix names, by family and verdict (blank: no_verdict), and by family and access (blank: unknown).
    trail: rows of trail(action, file, decided_on) by action and by file, and the distinct days.
    """
    s = lambda c, blank="": F.when(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == "", F.lit(blank)).otherwise(F.trim(F.col(c).cast("string")))

    def section(df: DataFrame, name: str, measures: dict[str, Column]) -> DataFrame:
        each = df.select(F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), k.alias("key")) for m, k in measures.items()))).alias("m"))
        return each.groupBy(F.lit(name).alias("section"), "m.measure", "m.key").agg(F.count("*").alias("n"))

    blocking = held.select(F.explode("issues").alias("i")).where(F.col("i.severity").isin("HIGH", "CRITICAL")).select("i.code")
    prefix = F.split(s("instrument_id"), ":")[0]
    family = F.when(prefix == "mn", "Moratorium Nation").when(prefix == "sabin", "Sabin").when(prefix == "nrel", "NREL").when(prefix == "queue", "review queue").otherwise("other")
    parts = [
        section(held, "quarantine", {"by_entity": s("entity")}),
        section(blocking, "quarantine", {"by_blocking_code": F.col("code")}),
        section(queue, "review", {"by_status": s("review_status", "pending"), "by_entity": s("entity_type")}),
        section(checks, "evidence", {"checked": family, "verdict": F.concat_ws("/", family, s("verdict", "no_verdict")), "access": F.concat_ws("/", family, s("access", "unknown"))}),
        section(trail, "trail", {"by_action": s("action"), "by_file": s("file")}),
        trail.select(s("decided_on").alias("d")).where("d <> ''").agg(F.count_distinct("d").alias("n")).select(F.lit("trail").alias("section"), F.lit("days").alias("measure"), F.lit("").alias("key"), "n"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
