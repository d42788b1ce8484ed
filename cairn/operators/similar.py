"""Set-similarity and edit-distance joins: few rare pieces propose pairs, all pieces decide; and one-to-one attachment."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, groupby, pairwise
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cairn.sources.scratch import cut_lineage

#: Undecided candidate pairs that one task settles in order; more of them are settled in rounds.
REMAINDER = 500_000
#: A side of a join is broadcast only after its rows and bytes were counted and found to be at most this many.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20


def words_of(text: str | Column) -> Column:
    """The distinct words of a text, lower-cased."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0)))


def _rarest(sets: DataFrame, key: str, elements: str, keep: Column) -> DataFrame:
    """(key, element): of each set the ``keep`` elements that the fewest sets hold, ties by element."""
    each = sets.select(key, keep.alias("keep"), F.explode(elements).alias("element"))
    held = each.groupBy("element").agg(F.count("*").alias("held"))
    place = F.row_number().over(W.partitionBy(key).orderBy("held", "element"))
    return each.join(held, "element").withColumn("place", place).where("place <= keep").select(key, "element")


def containing(left: DataFrame, right: DataFrame, left_id: str, right_id: str, least: float) -> DataFrame:
    """(left_id, right_id, score): left sets that hold at least the share ``least`` of a right set's words; score is that share.

    Both are (id, words) with distinct words. A left set that holds all but n words of a right one holds one of any n + 1 of
    them, so only the n + 1 rarest words of each right set are joined on: common words pair nothing. Empty right sets
    are in no pair.
    """
    sets = right.where(F.size("words") > 0).select(right_id, F.col("words").alias("wanted"))
    missing = F.size("wanted") - F.ceil(F.lit(least) * F.size("wanted") - 1e-9).cast("int")
    index = _rarest(sets, right_id, "wanted", missing + 1)
    proposed = left.select(left_id, F.explode("words").alias("element")).join(index, "element").select(left_id, right_id).distinct()
    checked = proposed.join(left.select(left_id, "words"), left_id).join(sets, right_id)
    return checked.select(left_id, right_id, (F.size(F.array_intersect("words", "wanted")) / F.size("wanted")).alias("score")).where(F.col("score") >= least)


def _in_order(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    pairs = sorted((p for f in frames for p in zip(f["row"].tolist(), f["target"].tolist(), f["score"].tolist(), strict=True)), key=itemgetter(0))
    taken, won = set(), []
    for row, offers in groupby(pairs, key=itemgetter(0)):
        free = [(score, target) for _, target, score in offers if target not in taken]
        best = max((score for score, _ in free), default=None)
        top = [target for score, target in free if score == best]
        if len(top) == 1:
            won.append((row, top[0], best))
            taken.add(top[0])
    yield pd.DataFrame(won, columns=["row", "target", "score"])


def attach_in_order(pairs: DataFrame, row: str, target: str, score: str, remainder: int = REMAINDER) -> DataFrame:
    """(row, target, score): rows in ascending order each take the target of their strictly best score, which is then gone for later rows.

    A row can be decided once no undecided row before it wants any of its targets. Each round decides all those rows
    at once: the best of several equal scores is nobody's, and a row left with one target takes it. Rounds go on until
    ``remainder`` pairs are left, which one task settles in order, so a long chain of rows doesn't take a round each.
    Pairs are distinct; scores aren't null.
    """
    names = pairs.select(F.col(row).alias("row"), F.col(target).alias("target"), F.col(score).cast("double").alias("score"))
    rest, won = cut_lineage(names), []
    shape = f"row {names.schema['row'].dataType.simpleString()}, target {names.schema['target'].dataType.simpleString()}, score double"
    while (n := rest.count()) > remainder:
        first = rest.groupBy("target").agg(F.min("row").alias("first"))
        ready = rest.join(first, "target").groupBy("row").agg(F.bool_and(F.col("row") == F.col("first")).alias("ready")).where("ready").select("row")
        theirs = rest.join(ready, "row", "left_semi")
        best = theirs.groupBy("row").agg(F.max("score").alias("score"))
        top = theirs.join(best, ["row", "score"]).groupBy("row", "score").agg(F.min("target").alias("target"), F.count("*").alias("n")).where("n = 1")
        won.append(cut_lineage(top.select("row", "target", "score")))
        rest = cut_lineage(rest.join(ready, "row", "left_anti").join(won[-1].select("target"), "target", "left_anti").select("row", "target", "score"))
    if n or not won:
        won.append(rest.coalesce(1).mapInPandas(_in_order, shape))
    out = won[0]
    for more in won[1:]:
        out = out.unionByName(more)
    return out.select(F.col("row").alias(row), F.col("target").alias(target), F.col("score").alias(score))


def attach_text(rows: DataFrame, items: DataFrame, keys: list[str], row: str, item: str) -> DataFrame:
    """Each row with the one item of its keys, or with the item whose words are strictly the most alike (Jaccard); items are used once.

    Both frames have the ``keys`` (compared with white space and signs evened out), and ``words``, arrays of distinct words;
    no words on either side are alike by 0. Rows whose key has one item left take it whatever it says.
    """
    even = lambda c: F.trim(F.regexp_replace(F.lower(F.col(c).cast("string")), "[^a-z0-9]+", " ")).alias(c)
    left = rows.select(F.col(row), *map(even, keys), F.col("words").alias("__a"))
    right = items.select(F.col(item), *map(even, keys), F.col("words").alias("__b"))
    both = F.size(F.array_intersect("__a", "__b"))
    alike = F.coalesce(both / F.nullif(F.size("__a") + F.size("__b") - both, F.lit(0)), F.lit(0.0))
    return attach_in_order(left.join(right, keys).select(row, item, alike.alias("score")), row, item, "score")


def _shortened(words: DataFrame, text: str, times: int, longest: int) -> DataFrame:
    """(text, key): of each text of up to ``longest`` characters the hashes of it and of all that is left after taking out up to ``times``, one row a choice."""
    choices = sorted((c for n in range(times + 1) for c in combinations(range(1, longest + 1), n)), key=lambda c: c[-1:])
    outs = F.array(*(F.array(*map(F.lit, (0,) * (times - len(c)) + c)) for c in choices))
    # the choices are in the order of their last place, so a text's own come first
    own = F.get(F.array(*(F.lit(sum(c[-1:] <= (n,) for c in choices)) for n in range(longest + 1))), F.length(text))
    rows = words.where(F.length(text) <= longest).select(text, F.explode(F.slice(outs, F.lit(1), own)).alias("out"))
    ends = [F.lit(0), *(F.get("out", F.lit(k)) for k in range(times)), F.lit(longest + 1)]
    kept = [F.substring(text, i + 1, F.greatest(j - i - 1, F.lit(0))) for i, j in pairwise(ends)]
    return rows.select(text, F.xxhash64(F.lit("left"), F.concat(*kept)).alias("key"))


def _parts(words: DataFrame, text: str, distance: int, long: int, places: list[tuple[int, int, int]]) -> DataFrame:
    """(text, key): of each text and place (longer, part, shift) the piece that a string shorter by ``longer`` has as that of its distance + 1 parts, were it shifted so."""
    rows = words.where(F.length(text) >= long).select(text, F.explode(F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(("longer", "part", "shift"), p, strict=True))) for p in places))).alias("p"))
    rows = rows.select(text, "p.*").withColumn("length", F.length(text) - F.col("longer")).where(F.col("length") >= long)
    start, stop = (F.floor(F.col("length") * part / (distance + 1)).cast("int") for part in (F.col("part"), F.col("part") + 1))
    at = start + F.col("shift")
    stands = (at >= 0) & (stop + F.col("shift") <= F.length(text))
    return rows.where(stands).select(text, F.xxhash64("length", "part", F.substring(text, at + 1, stop - start)).alias("key"))


def close_candidates(a: DataFrame, b: DataFrame, distance: int = 2, size: int = 3) -> DataFrame:
    """(a, b): every pair of the distinct strings ``a(a)`` and ``b(b)`` within the edit distance, and no others.

    A string ``a`` is cut into distance + 1 parts; edits leave one of them whole in ``b``. There is a whole part k, counted from
    0, before which lie exactly k edits (the first at which the edits so far fall below the parts so far), so in ``b`` it is shifted
    by k at most, and the edits left bound its shift against the end: for distance 2 a string ``b`` has 19 such places over all lengths.
    Strings too short for parts of ``size`` letters share what is left of each after taking out letters instead. Pairs that
    share a key are compared at once, so none but close ones travel. ``a``'s keys are written once, counted, and broadcast if few.
    """
    long = (distance + 1) * size
    places = [(longer, k, shift) for longer in range(-distance, distance + 1) for k in range(distance + 1) for shift in range(-k, k + 1) if abs(longer - shift) <= distance - k]

    def keyed(words: DataFrame, name: str, at: list[tuple[int, int, int]]) -> DataFrame:
        return _parts(words, name, distance, long, at).unionByName(_shortened(words, name, distance, long - 1 + distance))

    one = cut_lineage(keyed(a, "a", [p for p in places if p[0] == p[2] == 0]))
    n, width = one.agg(F.count("*"), F.sum(F.octet_length("a") + 16)).first()
    if n <= BROADCAST_ROWS and (width or 0) <= BROADCAST_BYTES:
        one = F.broadcast(one)
    # a string takes many times the work that its bytes suggest, so their number of tasks isn't left to adaptive execution;
    # dealt by a hash, as a repartition by what ``b`` is grouped by already would be left out
    dealt = b.repartition(int(b.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("b"))
    met = keyed(dealt, "b", places).join(one, "key").where((F.abs(F.length("a") - F.length("b")) <= distance) & (F.levenshtein("a", "b", distance) >= 0))
    return met.select("a", "b").distinct()


def close_names(asked: DataFrame, names: DataFrame, asked_name: str, name: str, n: int = 3, distance: int = 2) -> DataFrame:
    """of each asked name the n names nearest by edit distance, none beyond ``distance``; ties by name. Letter case doesn't count.

    Both frames are written once, as each is read twice.
    """
    keyed = lambda df, c, k: df.withColumn(k, F.lower(c))
    a, b = cut_lineage(keyed(asked, asked_name, "__a")), cut_lineage(keyed(names, name, "__b"))
    distinct = lambda df, k, as_: df.where(F.col(k).isNotNull()).select(F.col(k).alias(as_)).distinct()
    pairs = close_candidates(distinct(a, "__a", "a"), distinct(b, "__b", "b"), distance)
    near = pairs.withColumn("distance", F.levenshtein("a", "b", distance))
    best = near.withColumn("__rank", F.rank().over(W.partitionBy("a").orderBy("distance"))).where(F.col("__rank") <= n).withColumnsRenamed({"a": "__a", "b": "__b"})
    scored = a.join(best, "__a").join(b, "__b").drop("__a", "__b", "__rank")
    return scored.withColumn("place", F.row_number().over(W.partitionBy(asked_name).orderBy("distance", name))).where(F.col("place") <= n)
