"""Exact duplicates: counting quotient filters find the fingerprints that occur again, and only those texts are compared."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.quotient import repeated_prints
from cairn.llm.support import bounded, materialize

#: Runs of white space that aren't one space already: replaced by one space, they give the same text as replacing every run.
UNEVEN_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs(doc_id, text)``.

    Texts are equal if they are the same bytes after replacing each run of ASCII white space by one space. Fingerprints
    of 64 bits are counted in filters; rows whose fingerprint occurs once are alone. The texts of the others are grouped by
    their bytes, each partition's first, so a group of very many copies sends one row from each. A group's name
    in the join back is its fingerprint and SHA-256.

    keep_id is the smallest doc_id of the group, and its row is kept; of several such rows one is. A null doc_id comes after
    all others: a group of such rows alone has a null keep_id and keeps one. A null text counts as empty, and empty texts
    are equal. Other columns are ignored. An empty table gives no rows.
    """
    text = F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), UNEVEN_SPACE, " ")
    texts = docs.select(F.col("doc_id").cast("long"), text.alias("text")).withColumn("fp", F.xxhash64("text"))
    marks = materialize(texts.select("doc_id", "fp", F.sha2("text", 256).alias("text_sha256"), F.monotonically_increasing_id().alias("row")))
    again = bounded(materialize(repeated_prints(marks, marks.count()).select("fp")))
    groups = texts.join(again, "fp", "left_semi").groupBy("fp", "text").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = materialize(groups.select("fp", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"))
    name = ["fp", "text_sha256"]
    firsts = marks.join(bounded(groups), name).where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    stays = materialize(firsts.groupBy(*name, "keep_id", "group_size").agg(F.min("row").alias("stays")))
    alone = F.col("group_size").isNull()
    return marks.join(bounded(stays), name, "left").select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.when(alone, True).otherwise(F.col("row") == F.col("stays")).alias("kept"), "text_sha256",
    )
