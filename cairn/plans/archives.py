"""Archives, workbooks, compressed text and topologies: written from whole tables, read back by the archive source."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cairn.plans.base import query
from cairn.plans.files import _fresh
from cairn.sources import archives, readers, sinks

TEXT = "CAST(c_custkey AS VARCHAR) AS c_custkey, c_name"


def text(*columns: str):
    return [F.col(c).cast("string").alias(c) for c in columns]


@query(f"SELECT {TEXT}, 'nation_' || c_nationkey || '.zip' AS file, 'part_' || c_custkey % 3 || '.csv' AS member FROM customer")
def q_zip_members(t):
    """SRC10, SRC14: every matching member of every archive is a partition; other members are left alone."""
    path = _fresh(t)
    rows = t.customer.select(*text("c_custkey", "c_name"), F.format_string("nation_%d.zip", "c_nationkey").alias("file"), F.format_string("part_%d.csv", (F.col("c_custkey") % 3).cast("int")).alias("member"))
    archives.write_archives(rows, path, "file", "member", ["c_custkey", "c_name"])
    back = archives.read_archives(t.spark, path, member=r"part_\d+\.csv", columns=["c_name", "c_custkey"])
    return back.select("c_custkey", "c_name", F.regexp_extract("source_file", "[^/]+$", 0).alias("file"), F.col("source_member").alias("member"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier")
def q_gazetteer(t):
    """SRC7: one tab-separated member of each archive, with white space around its names; the exact header is asked for."""
    path = _fresh(t)
    rows = t.supplier.select(F.col("s_suppkey").cast("string").alias(" s_suppkey "), F.col("s_name").alias("s_name  "), *text("s_nationkey"), F.format_string("gaz_%d.zip", (F.col("s_nationkey") % 4).cast("int")).alias("file"), F.lit("2024_gaz.txt").alias("member"))
    archives.write_archives(rows, path, "file", "member", [" s_suppkey ", "s_name  ", "s_nationkey"], sep="\t")
    return archives.read_archives(t.spark, path, member=r".*gaz\.txt", one=True, sep="\t", columns=["s_suppkey", "s_name", "s_nationkey"], exact=True).drop(*archives.PLACE)


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus AS sheet FROM orders WHERE o_orderstatus IN ('F', 'O')")
def q_sheets(t):
    """SRC11-SRC13: two sheets of each workbook, under a disclaimer, by header search; the status is checked against its vocabulary."""
    path = _fresh(t)
    rows = t.orders.select(*text("o_orderkey", "o_orderstatus", "o_custkey", "o_orderpriority"), F.regexp_replace(F.concat("o_orderpriority", F.lit(".xlsx")), "[^A-Za-z0-9.]+", "_").alias("file"))
    archives.write_workbooks(rows, path, "file", "o_orderstatus", ["o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority"], title="Inventory as of June 1998")
    back = archives.read_archives(t.spark, path, sheet="F|O", header="o_orderkey", columns=["o_orderkey", "o_orderstatus", "o_custkey"], vocabulary={"o_orderstatus": ["F", "O"]})
    return back.select("o_orderkey", "o_orderstatus", "o_custkey", F.col("source_member").alias("sheet"))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, c_name AS name FROM nation JOIN customer ON c_nationkey = n_nationkey")
def q_gzip_or_plain(t):
    """SRC18: text that may or may not be compressed, told apart by its first bytes and not by its name."""
    path = _fresh(t)
    rows = t.customer.select(F.col("c_nationkey").cast("string").alias("n_nationkey"), F.col("c_name").alias("name"))
    for odd, codec in ((0, "none"), (1, "gzip")):
        rows.where(F.col("n_nationkey").cast("int") % 2 == odd).write.mode("append").option("header", True).option("compression", codec).csv(path)
    return archives.read_archives(t.spark, path, columns=["n_nationkey", "name"]).drop(*archives.PLACE)


@query("SELECT CAST(s_suppkey AS VARCHAR) AS id, CAST(n AS INT) AS n, 10.0 + 2 * (s_suppkey % 50 + CASE WHEN n IN (2, 3) THEN 1 ELSE 0 END)::DOUBLE AS x, 2.0 * (s_suppkey // 50 + CASE WHEN (s_suppkey % 2 = 0 AND n IN (3, 4)) OR (s_suppkey % 2 = 1 AND n IN (1, 2, 5)) THEN 1 ELSE 0 END)::DOUBLE AS y FROM supplier, range(1, 6) g(n)")
def q_topology(t):
    """SRC17: a square for each supplier as a delta-encoded arc; odd ones walk theirs backwards, from its other end."""
    path = _fresh(t)
    odd = F.col("s_suppkey") % 2 == 1
    x, y = (F.col("s_suppkey") % 50).cast("double"), F.floor(F.col("s_suppkey") / 50).cast("double")
    deltas = lambda steps, first: F.array(F.array(*first), *(F.array(F.lit(float(a)), F.lit(float(b))) for a, b in steps))
    # backwards from (0, 1): right, down, left, up; forwards an even one goes right, up, left, down
    arc = F.when(odd, deltas([(0, -1), (1, 0), (0, 1), (-1, 0)], (x, y + 1))).otherwise(deltas([(1, 0), (0, 1), (-1, 0), (0, -1)], (x, y)))
    at = F.row_number().over(W.orderBy("s_suppkey")) - 1
    placed = t.supplier.select("s_suppkey", arc.alias("arc"), at.alias("at"), odd.alias("odd"))
    shape = F.struct(F.col("s_suppkey").cast("string").alias("id"), F.lit("Polygon").alias("type"), F.array(F.array(F.when(F.col("odd"), -F.col("at") - 1).otherwise(F.col("at")))).alias("arcs"))
    # a topology is one document
    whole = placed.groupBy().agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "arc"))), lambda s: s["arc"]).alias("arcs"), F.collect_list(shape).alias("shapes"))
    frame = F.struct(F.array(F.lit(2.0), F.lit(2.0)).alias("scale"), F.array(F.lit(10.0), F.lit(0.0)).alias("translate"))
    whole.select(F.to_json(F.struct(F.lit("Topology").alias("type"), frame.alias("transform"), "arcs", F.struct(F.struct(F.col("shapes").alias("geometries")).alias("counties")).alias("objects")))).write.text(path)
    return readers.topology_rings(t.spark, path, "counties").select("id", "n", "x", "y")


@query("SELECT o_orderpriority, CAST(count(*) AS VARCHAR) AS n, CAST(count(DISTINCT o_custkey) AS VARCHAR) AS customers FROM orders GROUP BY 1")
def q_columns_and_rows(t):
    """SNK2 written and SRC3 read: a small summary as columns and rows, and rows as a staging table."""
    small = sinks.columns_and_rows(t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("customers")))
    rows = [dict(zip(small["columns"], (str(v) for v in r), strict=True)) for r in small["rows"]]
    return readers.from_rows(t.spark, rows, ["o_orderpriority", "n", "customers"])
