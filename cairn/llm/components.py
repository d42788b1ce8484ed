"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.support import discard, materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step on rows (a, b) with a > b: hang each node's neighbours on their smallest one.

    The minimum is a partial aggregate and is written before it is joined, so that the join
    can split a node that has very many neighbours.
    """
    around = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    least = materialize(around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")))
    joined = around.join(least, "a")
    if large:
        hung = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        hung = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    out = materialize(hung.where(F.col("a") > F.col("b")).distinct())
    discard(least)
    return out


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``: the smallest node reachable.

    Links are undirected; repeated links, self links and links with a null end are allowed and
    change nothing (a node with only such links isn't returned). No links: no rows.
    """
    ends = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    links = materialize(links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(*ends).distinct())
    before = _state(links)
    while before[0]:
        large = _star(links, large=True)
        small = _star(large, large=False)
        discard(links)
        discard(large)
        links, after = small, _state(small)
        if after == before:
            break
        before = after
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
