"""Removal of boilerplate lines by their frequency relative to the site they stand on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.support import BROADCAST_ROWS, bounded, materialize

#: A line on more than this share of a site's pages, and on at least MIN_PAGES of them, is boilerplate.
RATIO = 0.08
MIN_PAGES = 5


def _key(line: Column) -> Column:
    """128 bits that stand for a line."""
    return F.struct(F.xxhash64(line).alias("x"), F.xxhash64(F.lit("line"), line).alias("y"))


def boilerplate(docs: DataFrame, *, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, keys): the keys of each site's boilerplate lines.

    A page counts once for a line, however often it holds it; repeated rows are pages of their own.
    Counts are partial sums before the shuffle, so a site with a third of all pages is no hot key; a
    site has at most (lines per page) / ratio boilerplate lines, which bounds the collected array.
    """
    pages = docs.select(F.col(host).cast("string").alias("host"), F.split(F.col(text).cast("string"), "\n").alias("lines")).where("host IS NOT NULL")
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    lines = pages.select("host", F.explode(F.array_distinct("lines")).alias("line")).where("line <> ''")
    counts = lines.groupBy("host", _key(F.col("line")).alias("key")).agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    common = materialize(counts).join(bounded(materialize(totals)), "host").where(F.col("n") > F.lit(ratio) * F.col("pages"))
    return common.groupBy("host").agg(F.array_sort(F.collect_list("key")).alias("keys"))


def drop_boilerplate(docs: DataFrame, *, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``docs`` with boilerplate lines cut from ``text``, and the columns n_lines and n_dropped.

    Lines are what newlines separate, compared whole; blank lines stay. Columns of ``docs`` called n_lines or
    n_dropped, in any case, are replaced, others pass through, whatever their names. Null text stays null with no lines; an empty text is one
    blank line. A null host has no site: its rows stay whole. Ties at the ratio stay (the share must exceed
    it). An empty table gives no rows. A text all of whose lines go becomes empty; no row is dropped.
    """
    host_at, text_at = docs.columns.index(host), docs.columns.index(text)
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))  # names of the caller's can't clash with those below
    site, body = F.col(f"c{host_at}").cast("string"), F.col(f"c{text_at}").cast("string")
    found = materialize(boilerplate(plain.select(site.alias("host"), body.alias("text")), host="host", text="text", ratio=ratio, min_pages=min_pages))
    # a site's row may hold many keys: the keys are what is counted before a broadcast
    if (found.agg(F.sum(F.size("keys"))).first()[0] or 0) <= BROADCAST_ROWS:
        found = F.broadcast(found)
    lines = F.split(body, "\n")
    rest = F.when(F.col("keys").isNull(), lines).otherwise(F.filter(lines, lambda x: ~F.array_contains("keys", _key(x))))
    out = plain.join(found, site == F.col("host"), "left").withColumn("rest", rest)
    size = lambda c: F.when(body.isNull(), F.lit(0)).otherwise(F.coalesce(F.size(c), F.lit(0))).cast("long")
    kept = [k for k, c in enumerate(docs.columns) if c.lower() not in ("n_lines", "n_dropped")]
    changed = [F.array_join("rest", "\n") if k == text_at else F.col(f"c{k}") for k in kept]
    cut = out.select(*(c.alias(f"c{k}") for k, c in zip(kept, changed, strict=True)), size(lines).alias("n_lines"), (size(lines) - size(F.col("rest"))).alias("n_dropped"))
    return cut.toDF(*(docs.columns[k] for k in kept), "n_lines", "n_dropped")
