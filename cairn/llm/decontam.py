"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A fixed mask names the tokens of a short span that are hashed; the others are ignored. Of 13 tokens at most two may
differ, and wherever the two are, MASK_13 has a place among the 13 where it reads none of them (likewise the two masks
of MASKS_12 among 12 tokens). Hashes of test and training seeds are joined, and every alignment with a hit is
verified token by token, so candidate search reaches every overlap that verification accepts.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.support import bounded, materialize

#: Items of fewer tokens are matched whole, every token equal.
SPAN = 12
#: Offsets of the tokens that a mask reads.
MASK_13 = (0, 1, 3, 6, 7)
MASKS_12 = ((0, 1, 2, 4, 5), (0, 1, 2, 3, 4))
#: An overlap is so many tokens (a whole item if that is shorter) of which at least this share agree.
OVERLAP = 13
AGREE = 0.8


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def masks_for(size: int) -> tuple[tuple[int, ...], ...]:
    """The masks of an item of ``size`` tokens; a short one is a single mask that ignores nothing."""
    return (MASK_13,) if size >= OVERLAP else MASKS_12 if size >= SPAN else (tuple(range(size)),)


def seeds(texts: DataFrame, key: str, words: str, at: str, masks: list[tuple[int, ...]]) -> DataFrame:
    """(key, at, hash): for every position ``at`` of the array ``words`` the hash of what each mask reads there.

    The array is zipped with its own shifts, exploded, and hashed row by row, which stays in generated code; outer
    explodes, as Spark would compute an inner one's array a second time to filter out empty ones.
    """
    found = []
    for mask in masks:
        shifted = [F.slice(words, o + 1, F.greatest(F.size(words), F.lit(1))).alias(f"w{o}") for o in mask]
        placed = texts.select(key, F.posexplode_outer(F.arrays_zip(*shifted)).alias(at, "z")).where(F.col(f"z.w{mask[-1]}").isNotNull())
        found.append(placed.select(key, at, F.xxhash64(F.lit(str(mask)), *(F.col(f"z.w{o}") for o in mask)).alias("hash")))
    return functools.reduce(DataFrame.unionByName, found)


def item_seeds(items: DataFrame) -> tuple[DataFrame | None, list[tuple[int, ...]]]:
    """(item_id, item_at, hash) of ``items(item_id, item)`` and the masks in use; no seeds without items."""
    size = F.size("item")
    sizes = [r[0] for r in items.where(size > 0).select(F.least(size, F.lit(OVERLAP))).distinct().collect()]
    found = [seeds(items.where(F.least(size, F.lit(OVERLAP)) == n), "item_id", "item", "item_at", list(masks_for(n))) for n in sizes]
    return functools.reduce(DataFrame.unionByName, found) if found else None, sorted({m for n in sizes for m in masks_for(n)})


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_matched, item_tokens, doc_start): items of which a document holds an overlap.

    One row per document and item: the alignment with most equal tokens, the earliest of equal ones.
    doc_start is the token of the document at which the item would start (it may be negative).

    Null and empty texts hold nothing, and items without a token match nothing. Items of fewer than SPAN tokens
    must stand whole. A document's alignments are gathered in one row; there are at most as many as it has tokens for each
    item. Rows without an id are left out, on either side. Repeated rows give one result; rows that
    share a doc_id are searched each. No documents or no items: no rows. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    items = materialize(benchmark.select(F.col("item_id").cast("long"), tokens(F.col("text").cast("string")).alias("item")).where("item_id IS NOT NULL AND item IS NOT NULL").distinct())
    wanted, masks = item_seeds(items)
    if wanted is None:
        return docs.limit(0).select("doc_id", *(F.lit(None).cast("long").alias(c) for c in ("item_id", "n_matched", "item_tokens", "doc_start")))
    split = docs.select("doc_id", tokens(F.col("text")).alias("words"))
    hits = seeds(split, "doc_id", "words", "doc_at", masks).join(bounded(materialize(wanted)), "hash")
    aligned = materialize(hits.select("doc_id", "item_id", (F.col("doc_at") - F.col("item_at")).alias("doc_start")).distinct())

    # a document is split into tokens once, whatever the number of its alignments; only the tokens that face an item go on
    sizes = items.select("item_id", F.size("item").alias("n")).distinct()
    gathered = materialize(aligned.join(bounded(sizes), "item_id").groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "doc_start", "n")).alias("at")))
    words = docs.join(bounded(gathered), "doc_id").select("doc_id", "at", F.explode_outer(F.array(tokens(F.col("text")))).alias("words"))
    part = lambda a: F.slice("words", F.greatest(a["doc_start"], F.lit(0)) + 1, F.greatest(a["n"] + F.least(a["doc_start"], F.lit(0)), F.lit(0)))
    parts = words.select("doc_id", F.explode_outer(F.transform("at", lambda a: F.struct(a["item_id"].alias("item_id"), a["doc_start"].alias("doc_start"), a["n"].alias("n"), part(a).alias("part")))).alias("p")).select("doc_id", "p.*")
    texts = parts.join(bounded(items.withColumn("n", F.size("item"))), ["item_id", "n"])
    facing = F.concat(F.array_repeat(F.lit(None).cast("string"), F.greatest(-F.col("doc_start"), F.lit(0))), F.col("part"))
    equal = F.zip_with("item", facing, lambda w, x: F.when(w == x, 1).otherwise(0))
    length = F.least(F.size("equal"), F.lit(OVERLAP))
    stretch = F.transform(F.sequence(F.lit(1), F.size("equal") - length + 1), lambda i: F.aggregate(F.slice("equal", i, length), F.lit(0), lambda a, x: a + x))
    checked = texts.select("doc_id", "item_id", "doc_start", F.size("item").alias("item_tokens"), equal.alias("equal")).withColumn("best", F.array_max(stretch)).where(F.col("best") >= F.when(F.size("equal") < SPAN, F.lit(1.0)).otherwise(AGREE) * length)
    summed = checked.withColumn("n_matched", F.aggregate("equal", F.lit(0), lambda a, x: a + x))
    best = summed.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("n_matched", "item_tokens", "doc_start"), F.struct("n_matched", -F.col("doc_start"))).alias("m"))
    return best.select("doc_id", "item_id", *(F.col(f"m.{c}").cast("long").alias(c) for c in ("n_matched", "item_tokens", "doc_start")))
