"""Record matching within blocks, and deduplication whose result depends on an order."""

from __future__ import annotations

from collections.abc import Iterator
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cairn.operators.similar import close_names
from cairn.sources.scratch import cut_lineage

__all__ = ["best_level", "blocked_candidates", "close_names", "cross_source", "demote_multiple", "fill_from_linked", "greedy_dedupe", "hold_duplicates", "last_success", "mentions"]


#: Undecided rows that one task settles in order; more of them are settled in rounds.
REMAINDER = 500_000


def _kept_in_order(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = sorted((r for f in frames for r in zip(f["at"].tolist(), f["keys"].tolist(), strict=True)), key=itemgetter(0))
    seen, kept = set(), []
    for at, keys in rows:
        mine = {(k, v) for k, v in enumerate(keys) if v is not None}
        if not mine & seen:
            seen |= mine
            kept.append(at)
    yield pd.DataFrame({"at": pd.Series(kept, dtype=object)})


def greedy_dedupe(rows: DataFrame, keys: list[str], order: str, remainder: int = REMAINDER) -> DataFrame:
    """J26 with several keys: rows in order, each kept if no kept row before it shares a key; dropped rows register nothing.

    That is the first maximal independent set of the rows that share keys. Each round keeps the rows that come first
    under all their keys and drops those sharing a key with a kept one. Once ``remainder`` rows are left, one task settles them
    in order by their keys alone, so a long chain of clashes doesn't take a round each. ``order`` is unique and NULL keys clash with nothing.
    """
    rest, kept = rows, None
    add = lambda new: new if kept is None else kept.unionByName(new)
    while rest.count() > remainder:
        marked = rest
        for k in keys:
            first = rest.where(F.col(k).isNotNull()).groupBy(k).agg(F.min(order).alias(f"__{k}"))
            marked = marked.join(first, k, "left")
        wins = F.lit(True)
        for k in keys:
            wins = wins & F.coalesce(F.col(f"__{k}") == F.col(order), F.lit(True))
        new = cut_lineage(marked.where(wins).select(*rows.columns))
        kept = add(new)
        left = rest
        for k in keys:
            left = left.join(new.where(F.col(k).isNotNull()).select(k).distinct(), k, "left_anti")
        rest = cut_lineage(left.join(new.select(order), order, "left_anti").select(*rows.columns))
    narrow = rest.select(F.col(order).alias("at"), F.array(*(F.col(k).cast("string") for k in keys)).alias("keys")).coalesce(1)
    stay = narrow.mapInPandas(_kept_in_order, f"at {rows.schema[order].dataType.simpleString()}")
    return add(rest.join(stay.withColumnRenamed("at", order), order, "left_semi").select(*rows.columns))


def blocked_candidates(left: DataFrame, right: DataFrame, block: str, left_core: str, right_core: str, *, least_shared: int = 4) -> DataFrame:
    """Pairs of a block whose name cores are equal, or one holds the other and they share a word of ``least_shared`` letters.

    Pairs meet on (block, shared word), so two rows of a block that share no word never meet; a word that very many rows of a
    block have is skewed, which adaptive joins split.
    """
    a = left.withColumn("__w", F.explode(left_core))
    b = right.withColumn("__w", F.explode(right_core))
    pairs = a.join(b, [block, "__w"]).drop("__w").distinct()
    both = F.array_intersect(left_core, right_core)
    small = F.least(F.size(left_core), F.size(right_core))
    equal = (F.size(both) == F.size(left_core)) & (F.size(both) == F.size(right_core))
    subset = (F.size(both) == small) & F.exists(both, lambda w: F.length(w) >= least_shared)
    return pairs.withColumn("level", F.when(equal, "strong").when(subset, "possible")).where("level IS NOT NULL")


def demote_multiple(pairs: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """A left row with several strong partners has only possible ones; partners are counted after alias fold-in."""
    strong = pairs.where("level = 'strong'").groupBy(left_id).agg(F.count_distinct(right_id).alias("__n"))
    joined = pairs.join(strong, left_id, "left")
    return joined.withColumn("level", F.when((F.col("level") == "strong") & (F.col("__n") > 1), "possible").otherwise(F.col("level"))).drop("__n")


def best_level(pairs: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """One row per left id with its best level and the partners at that level."""
    rank = F.when(F.col("level") == "strong", 0).otherwise(1)
    best = pairs.groupBy(left_id).agg(F.min(rank).alias("__r"))
    at = pairs.join(best, left_id).where(rank == F.col("__r"))
    return at.groupBy(left_id).agg(F.min("level").alias("level"), F.array_sort(F.collect_set(right_id)).alias("partners"))


def cross_source(new: DataFrame, existing: DataFrame, place: str, tech: str, same: list[str]) -> DataFrame:
    """New rows as duplicate (a row of the place and technology agrees on ``same``, NULLs too), flagged (one is there but differs) or new.

    Both questions are equality joins with distinct keys, so no pairs of a place are formed.
    """
    there = existing.select(F.col(place).alias("__p"), F.col(tech).alias("__t"), F.lit(True).alias("__there")).distinct()
    exact = existing.select(F.col(place).alias("__q"), F.col(tech).alias("__u"), *(F.col(c).alias(f"__{i}") for i, c in enumerate(same)), F.lit(True).alias("__agree")).distinct()
    at = (F.col(place) == F.col("__q")) & (F.col(tech) == F.col("__u"))
    for i, c in enumerate(same):
        at = at & F.col(c).eqNullSafe(F.col(f"__{i}"))
    seen = new.join(exact, at, "left").join(there, (F.col(place) == F.col("__p")) & (F.col(tech) == F.col("__t")), "left")
    verdict = F.when(F.col("__agree"), "duplicate").when(F.col("__there"), "flagged").otherwise("new")
    return seen.select(*new.columns, verdict.alias("verdict"))


def hold_duplicates(rows: DataFrame, seed: DataFrame, keys: list[str], row_id: str) -> DataFrame:
    """The first seed row of the same keys, named as the reason to hold a row."""
    first = seed.groupBy(*keys).agg(F.min(row_id).alias("held_for"))
    return rows.join(first, keys, "left")


def fill_from_linked(rows: DataFrame, linked: DataFrame, key: str, columns: list[str], order: str) -> DataFrame:
    """Blanks filled from the last linked row of the key."""
    last = linked.groupBy(key).agg(*(F.max_by(c, order).alias(f"__{c}") for c in columns))
    return rows.join(last, key, "left").select(*(F.coalesce(F.nullif(c, F.lit("")), f"__{c}").alias(c) if c in columns else F.col(c) for c in rows.columns))


def mentions(texts: DataFrame, names: DataFrame, block: str, text: str, name: str) -> DataFrame:
    """Texts that hold a name of their block followed by 'County', as whole words."""
    first = F.regexp_extract_all(F.lower(text), F.lit(r"\b([a-z.' -]+?) county\b"), F.lit(1))
    heard = texts.withColumn("__m", F.explode(first))
    words = heard.withColumn("__k", F.explode(F.transform(F.sequence(F.lit(1), F.size(F.split("__m", " "))), lambda k: F.array_join(F.slice(F.reverse(F.split("__m", " ")), 1, k), " "))))
    keyed = names.withColumn("__k", F.array_join(F.reverse(F.split(F.lower(name), " ")), " "))
    return words.join(keyed, [block, "__k"]).drop("__m", "__k").distinct()


def last_success(log: DataFrame, keys: list[str], at: str, value: str, ok: Column) -> DataFrame:
    """W8."""
    return log.where(ok).groupBy(*keys).agg(F.max_by(value, at).alias(value))
