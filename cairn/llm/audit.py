"""How quality filters interact: what each removes, at each place of every order, from counts by the set of filters failed.

Words are exploded and aggregated by (document, word), then by document, for totals and distincts. The flags of the
other filters and the labels are joined to that. Which filters a document fails is a number below 32; a part's 32
counts of documents by that number give every figure of every order, so nothing is read again for each order.
"""

from __future__ import annotations

import itertools
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.support import bounded, materialize

FILTERS = "ABCDE"
MIN_WORDS = 50
#: In hundredths: distinct words of all words, capitals of all characters.
DISTINCT, CAPITALS = 65, 5
WORD_END = r"[\x20\x09-\x0D]+"
#: A document's rows are dealt by this many salts, as rows that repeat an id and a text would otherwise share a task.
SALTS = 64


def word_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, words, distinct_words) for each doc_id and text; rows that repeat both count once.

    Texts are dealt out by document before they are exploded, so that both aggregations stay within a task and
    no (document, word) row travels. Each row adds one null word, which counts the rows themselves.
    """
    dealt = docs.select("doc_id", "fp", F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt"), "text").repartition("doc_id", "fp", "salt")
    words = F.filter(F.split("text", WORD_END), lambda w: w != "")
    by_word = dealt.select("doc_id", "fp", "salt", F.explode(F.array_append(words, F.lit(None).cast("string"))).alias("word")).groupBy("doc_id", "fp", "salt", "word").agg(F.count("*").alias("n"))
    of_word = lambda known: F.sum(F.when(F.col("word").isNotNull() if known else F.col("word").isNull(), F.col("n")))
    by_document = by_word.groupBy("doc_id", "fp", "salt").agg(of_word(True).alias("n"), of_word(False).alias("rows"), F.count("word").alias("distinct_words"))
    whole = by_document.groupBy("doc_id", "fp").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"), F.max("distinct_words").alias("distinct_words"))
    return whole.select("doc_id", "fp", F.coalesce(F.expr("n div rows"), F.lit(0)).alias("words"), "distinct_words")


def failed_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, good, toxic) for every row of ``docs``; failed has bit k for the filter FILTERS[k]."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text")).withColumn("fp", F.xxhash64("text"))
    capitals = 100 * F.length(F.regexp_replace("text", "[^A-Z]+", "")) > CAPITALS * F.length("text")
    flags = materialize(docs.select("doc_id", "fp", "part", F.unhex(F.sha2("text", 256)).alias("digest"), capitals.alias("c"), F.col("text").rlike("[#$%&*|]").alias("d")))
    copies = materialize(flags.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    named = labels.select(F.col("doc_id").cast("long"), "quality", "toxic").where("doc_id IS NOT NULL")
    known = named.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    counts = word_counts(docs).withColumnsRenamed({"doc_id": "id", "fp": "print"})
    rows = flags.join(counts, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("fp") == F.col("print")), "left").join(bounded(copies), "digest", "left").join(known, "doc_id", "left")
    words, distinct = (F.coalesce(c, F.lit(0)) for c in ("words", "distinct_words"))
    fails = [words < MIN_WORDS, 100 * distinct < DISTINCT * words, F.col("c"), F.col("d"), F.col("doc_id") > F.col("first")]
    failed = sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))
    return rows.select("part", failed.alias("failed"), F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def steps() -> list[dict]:
    """The filter at each step of every order as a bit, and those before it as bits."""
    found = []
    for order in itertools.permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            found.append({"filter_order": "".join(order), "step": step, "bit": bit, "before": before})
            before |= bit
    return found


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per (part, filter_order, step): kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A part is a value of ``source``. A document that fails k filters is removed by the first of them in the order,
    which is each of the k in 120 / k orders: that share is its part of a filter's ``shapley``.

    Null text: empty, no words. Null source: the empty string. A null doc_id has no place in the order of ids, so its row
    never fails E and makes nobody fail; it has no label. Rows that repeat an id and a text are each counted, as of one
    text. Labels that repeat an id: it is good (toxic) if one row says so. A text without words fails A and not B.
    Other columns are ignored. An empty table gives no rows.
    """
    of = failed_filters(docs, labels).groupBy("part", "failed").agg(F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    column = lambda c, m: F.coalesce(F.sum(F.when(F.col("failed") == m, F.col(c))), F.lit(0)).alias(f"{c}_{m}")
    counts = ("n", "good", "toxic")
    parts = of.groupBy("part").agg(*(column(c, m) for c in counts for m in range(1 << len(FILTERS))))
    arrays = parts.select("part", *(F.array(*(f"{c}_{m}" for m in range(1 << len(FILTERS)))).alias(c) for c in counts))
    every = F.from_json(F.lit(json.dumps(steps())), "array<struct<filter_order: string, step: int, bit: int, before: int>>")
    orders = sum(1 for _ in itertools.permutations(FILTERS))

    def total(counted: str, where: str, weight: str = "1") -> Column:
        return F.expr(f"aggregate(sequence(0, {(1 << len(FILTERS)) - 1}), 0L, (sum, m) -> sum + IF({where}, {counted}[m] * {weight}, 0L))")

    here = "(m & bit) <> 0 AND (m & before) = 0"
    return arrays.select("*", F.inline(every)).select(
        "part", "filter_order", "step",
        total("n", "(m & (before | bit)) = 0").alias("kept"),
        total("n", here).alias("removed"),
        total("n", "(m & bit) <> 0 AND (m & before) <> 0").alias("redundant"),
        total("n", "m = bit").alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
        total("n", "(m & bit) <> 0", f"({orders} div greatest(bit_count(m), 1))").alias("shapley"),
    )
