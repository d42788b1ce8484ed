"""Attachment that uses targets up, and close names."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.operators import similar
from cairn.plans.base import query

WORDS = "list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))"


@query(f"""
WITH RECURSIVE dw AS (SELECT doc_id, unnest({WORDS}) AS x FROM documents), iw AS (SELECT item_id, len({WORDS}) AS n, unnest({WORDS}) AS x FROM benchmark),
p AS (SELECT doc_id, item_id, count(*)::DOUBLE / n AS score FROM dw JOIN iw USING (x) GROUP BY doc_id, item_id, n HAVING count(*)::DOUBLE / n >= 0.9),
o AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS k, list({{'i': item_id, 's': score}}) AS offers FROM p GROUP BY doc_id),
w AS (SELECT 0::BIGINT AS k, []::BIGINT[] AS taken, NULL::BIGINT AS doc_id, NULL::BIGINT AS item_id, NULL::DOUBLE AS score
  UNION ALL SELECT k, CASE WHEN item IS NULL THEN taken ELSE list_append(taken, item) END, doc_id, item, top FROM (
    SELECT o.k, w.taken, o.doc_id, list_max(list_transform(free, lambda f: f.s)) AS top, CASE WHEN len(list_filter(free, lambda f: f.s = list_max(list_transform(free, lambda g: g.s)))) = 1 THEN list_filter(free, lambda f: f.s = list_max(list_transform(free, lambda g: g.s)))[1].i END AS item
    FROM w JOIN o ON o.k = w.k + 1, LATERAL (SELECT list_filter(o.offers, lambda f: NOT list_contains(w.taken, f.i)) AS free)))
SELECT doc_id, item_id, round(score, 6) AS score FROM w WHERE item_id IS NOT NULL""")
def q_attach_consumed(t):
    """Documents in order take the item they hold best, each item once."""
    pairs = similar.containing(t.documents.select("doc_id", similar.words_of("text").alias("words")), t.benchmark.select("item_id", similar.words_of("text").alias("words")), "doc_id", "item_id", 0.9)
    return similar.attach_in_order(pairs, "doc_id", "item_id", "score").select("doc_id", "item_id", F.round("score", 6).alias("score"))


LINES = "SELECT l_orderkey, l_returnflag, l_orderkey * 1000000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS id, l_linenumber, list_distinct([l_linestatus, 'q' || floor(l_quantity / 10)::INT, 'd' || round(l_discount * 100)::INT, 's' || l_suppkey % 5]) AS w FROM lineitem"


@query(f"""
WITH RECURSIVE l AS (SELECT * FROM ({LINES})), a AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY id) AS k FROM l WHERE l_linenumber % 2 = 1), b AS (SELECT * FROM l WHERE l_linenumber % 2 = 0),
o AS (SELECT a.l_orderkey, a.l_returnflag, a.k, a.id, list({{'i': b.id, 's': coalesce(len(list_intersect(a.w, b.w))::DOUBLE / len(list_distinct(list_concat(a.w, b.w))), 0)}}) AS offers FROM a JOIN b USING (l_orderkey, l_returnflag) GROUP BY ALL),
w AS (SELECT l_orderkey, l_returnflag, 0::BIGINT AS k, []::BIGINT[] AS taken, NULL::BIGINT AS id, NULL::BIGINT AS item, NULL::DOUBLE AS score FROM (SELECT DISTINCT l_orderkey, l_returnflag FROM o)
  UNION ALL SELECT l_orderkey, l_returnflag, k, CASE WHEN item IS NULL THEN taken ELSE list_append(taken, item) END, id, item, top FROM (
    SELECT o.l_orderkey, o.l_returnflag, o.k, w.taken, o.id, list_max(list_transform(free, lambda f: f.s)) AS top, CASE WHEN len(list_filter(free, lambda f: f.s = list_max(list_transform(free, lambda g: g.s)))) = 1 THEN list_filter(free, lambda f: f.s = list_max(list_transform(free, lambda g: g.s)))[1].i END AS item
    FROM w JOIN o ON o.k = w.k + 1 AND o.l_orderkey = w.l_orderkey AND o.l_returnflag = w.l_returnflag, LATERAL (SELECT list_filter(o.offers, lambda f: NOT list_contains(w.taken, f.i)) AS free)))
SELECT id, item, round(score, 6) AS score FROM w WHERE item IS NOT NULL""")
def q_attach_lines(t):
    """J31 in blocks: odd lines of an order take the even line of their flag that is the most alike, each once."""
    from pyspark.sql import Window as W

    at = F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"))
    marks = F.array_distinct(F.array("l_linestatus", F.concat(F.lit("q"), F.floor(F.col("l_quantity") / 10).cast("int")), F.concat(F.lit("d"), F.round(F.col("l_discount") * 100).cast("int")), F.concat(F.lit("s"), F.col("l_suppkey") % 5)))
    lines = t.lineitem.select("l_orderkey", "l_returnflag", (F.col("l_orderkey") * 1000000 + at).alias("id"), "l_linenumber", marks.alias("words"))
    odd, even = lines.where("l_linenumber % 2 = 1"), lines.where("l_linenumber % 2 = 0").withColumnRenamed("id", "item")
    found = similar.attach_text(odd, even, ["l_orderkey", "l_returnflag"], "id", "item")
    return found.select("id", "item", F.round("score", 6).alias("score"))


@query(f"""
WITH a AS (SELECT DISTINCT unnest({WORDS}) AS a FROM benchmark), b AS (SELECT DISTINCT unnest({WORDS}) AS b FROM documents),
p AS (SELECT a, b, levenshtein(a, b) AS distance FROM a JOIN b ON abs(length(a) - length(b)) <= 2 WHERE levenshtein(a, b) <= 2),
r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY distance, b) AS place FROM p)
SELECT a, b, CAST(distance AS INT) AS distance, CAST(place AS INT) AS place FROM r WHERE place <= 4""")
def q_close_words(t):
    """for each word of the benchmark the four nearest words of all documents, within two edits."""
    words = lambda df, c: df.select(F.explode(similar.words_of("text")).alias(c)).distinct()
    return similar.close_names(words(t.benchmark, "a"), words(t.documents, "b"), "a", "b", n=4, distance=2)
