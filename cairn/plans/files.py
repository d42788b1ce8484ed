"""Readers and sinks: each query writes whole tables to the shared folder, reads them back and gives what came back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cairn.plans.base import query
from cairn.sources import readers, sinks
from cairn.sources.engine import Engine
from cairn.sources.scratch import shared_folder


def _fresh(t) -> str:
    return f"{shared_folder(t.spark)}/files-{uuid.uuid4().hex}"


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CASE WHEN c_acctbal > 0 THEN c_name || ', \"the first\"' END AS c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer")
def q_csv_round_trip(t):
    """SNK7 written, SRC1 and SRC2 read: text cells, quotes doubled, NULL as blank."""
    path = _fresh(t)
    sinks.write_csv(t.customer.select("c_nationkey", F.when(F.col("c_acctbal") > 0, F.concat("c_name", F.lit(', "the first"'))).alias("c_name"), "c_custkey"), path, ["c_custkey", "c_name"])
    back = readers.read_staged_csv(t.spark, path)
    return back.select("c_custkey", F.nullif("c_name", F.lit("")).alias("c_name"), "c_nationkey")


@query("SELECT c_nationkey, count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM customer GROUP BY 1")
def q_json_partitions(t):
    """SNK3 and SNK8: one JSON partition a nation, a record a line."""
    path = _fresh(t)
    sinks.write_partitions(t.customer.select("c_custkey", "c_name", "c_nationkey"), path, "c_nationkey")
    back = t.spark.read.schema("c_custkey long, c_name string, c_nationkey int").json(path)
    return back.groupBy("c_nationkey").agg(F.count("*").alias("n"), F.sum("c_custkey").alias("keys"))


@query("SELECT 'customer' AS entity, CAST(c_custkey AS VARCHAR) AS record_id, CAST(c_nationkey AS VARCHAR) AS \"partition\" FROM customer UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR), CAST(s_nationkey AS VARCHAR) FROM supplier UNION ALL SELECT 'nation', CAST(n_nationkey AS VARCHAR), CAST(n_nationkey AS VARCHAR) FROM nation")
def q_record_index(t):
    """SNK4."""
    return sinks.record_index({"customer": (t.customer, "c_custkey", "c_nationkey"), "supplier": (t.supplier, "s_suppkey", "s_nationkey"), "nation": (t.nation, "n_nationkey", "n_nationkey")})


@query("SELECT n_nationkey AS id, n_name AS name, NULL::VARCHAR AS note FROM nation UNION ALL SELECT r_regionkey + 100, r_name, 'region' FROM region")
def q_appended(t):
    """SNK9: a column that came later is NULL in older rows."""
    path = _fresh(t)
    sinks.append_rows(t.nation.select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name")), path)
    sinks.append_rows(t.region.select((F.col("r_regionkey") + 100).cast("long").alias("id"), F.col("r_name").alias("name"), F.lit("region").alias("note")), path)
    return sinks.read_appended(t.spark, path)


@query("SELECT DISTINCT sha256(text) AS sha256, length(text) AS n FROM documents WHERE text IS NOT NULL AND sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE lang = 'de' AND text IS NOT NULL)")
def q_content_store(t):
    """SNK10: contents by digest, less those stored before (here all German ones)."""
    known = t.documents.where("lang = 'de' AND text IS NOT NULL").select(F.sha2("text", 256).alias("sha256"))
    return sinks.content_rows(t.documents.where("text IS NOT NULL").select(F.col("text").alias("content")), known).select("sha256", F.length("content").alias("n"))


@query("SELECT * FROM (VALUES ('o_orderkey', 'integer'), ('o_totalprice', 'number'), ('day', 'date'), ('o_orderstatus', 'string'), ('none', 'string')) v(field, type)")
def q_inferred_types(t):
    """SNK11 over all orders as text."""
    return sinks.inferred_types(t.orders.select(F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderstatus", F.lit("").alias("none")))


@query("SELECT r_name, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def q_published_sql(t):
    """SNK1, SNK5, SRC4, X6: published behind a gate, registered by its manifest, asked in SQL."""
    path = _fresh(t)
    sinks.publish({"published_nation": t.nation, "published_region": t.region}, path, gates=[t.nation.where("n_regionkey IS NULL")])
    return Engine(t.spark, path).sql("SELECT r_name, count(*) AS n FROM published_nation JOIN published_region ON n_regionkey = r_regionkey GROUP BY 1")


@query("SELECT CAST(n_nationkey AS VARCHAR) AS source_id, 'https://h/' || n_name || '?page=' || p AS url FROM nation, range(1, 3) g(p)")
def q_requests(t):
    """SRC20: a request for each parameter set of a source."""
    sets = F.array(*(F.create_map(F.lit("place"), F.col("n_name"), F.lit("page"), F.lit(p)) for p in ("1", "2")))
    return readers.expand_requests(t.nation.select(F.col("n_nationkey").cast("string").alias("source_id"), F.lit("https://h/{place}?page={page}").alias("url"), sets.alias("params")))


@query("SELECT event_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def q_unseen(t):
    """SRC22: rows of a feed whose key isn't known."""
    return readers.unseen(t.events, t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("user_id")), ["user_id"]).select("event_id")


@query("SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS n FROM documents WHERE text IS NOT NULL")
def q_json_cells(t):
    """SRC5: a JSON array cell; a NULL text's cell is no JSON and gives an empty array."""
    cells = t.documents.select("doc_id", "text", F.coalesce(F.to_json(F.split("text", " ")), F.lit("[bad")).alias("words"))
    return readers.json_list(cells, "words").where("text IS NOT NULL").select("doc_id", F.size("words").alias("n"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name FROM customer WHERE c_nationkey = 5")
def q_delimited(t):
    """SRC6: pipes, headers stripped, rows of one kind kept."""
    path = _fresh(t)
    t.customer.select(F.col("c_custkey").alias(" key "), F.col("c_name").alias("name "), F.col("c_nationkey").alias("nation")).write.option("header", True).option("sep", "|").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return readers.read_delimited(t.spark, path, "|", lambda df: F.trim("nation") == "5").select("key", "name")


@query("SELECT 'tab' AS kind, CAST(n_nationkey AS VARCHAR) AS key, n_name || ', land' AS name FROM nation UNION ALL SELECT 'comma', CAST(n_nationkey AS VARCHAR), n_name FROM nation")
def q_sniffed(t):
    """SRC8: the same reader over a file with tabs and one with commas."""
    parts = []
    for kind, sep, name in (("tab", "\t", F.concat("n_name", F.lit(", land"))), ("comma", ",", F.col("n_name"))):
        path = f"{_fresh(t)}-{kind}"
        t.nation.select(F.col("n_nationkey").alias("key"), name.alias("name")).write.option("header", True).option("sep", sep).csv(path)
        parts.append(readers.read_sniffed(t.spark, path).select(F.lit(kind).alias("kind"), "key", "name"))
    return parts[0].unionByName(parts[1])


@query("SELECT CAST(s_suppkey AS VARCHAR) AS key, CAST(s_nationkey AS VARCHAR) AS nation FROM supplier")
def q_tokens(t):
    """SRC9: columns by the place of a token, blank lines skipped."""
    path = _fresh(t)
    t.supplier.select(F.explode(F.array(F.concat(F.lit("  "), "s_suppkey", F.lit("   x\t"), "s_nationkey", F.lit(" ")), F.lit("  "))).alias("value")).write.text(path)
    return readers.read_tokens(t.spark, path, {"key": 0, "nation": 2})


@query("SELECT n_nationkey AS id, n_name AS name FROM nation")
def q_json_answers(t):
    """SRC15: the items of saved answers, one answer a region."""
    path = _fresh(t)
    answers = t.nation.groupBy("n_regionkey").agg(F.to_json(F.struct(F.collect_list(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))).alias("results"))).alias("value"))
    answers.repartition("n_regionkey").select("value", "n_regionkey").write.partitionBy("n_regionkey").text(path)
    return readers.read_json_pages(t.spark, f"{path}/*/*", "results", "id int, name string")


@query("SELECT page_id, r, CASE r WHEN 0 THEN 'Key;Length' ELSE page_id || ';' || length(url) END AS cells FROM pages, range(0, 2) g(r)")
def q_page_tables(t):
    """SRC16: the tables of pages, here of one made for every row."""
    html = F.concat(F.lit("<h2>Facts</h2><table><tr><th>Key<th>Length</tr><tr><td> "), F.col("page_id").cast("string"), F.lit("<td>"), F.length("url").cast("string"), F.lit("</tr></table>"))
    found = readers.html_tables(t.pages.select("page_id", html.alias("h")), "page_id", "h")
    place, cells = found.columns[2], found.columns[3]
    return found.select("page_id", F.col(place).cast("long").alias("r"), F.array_join(cells, ";").alias("cells"))
