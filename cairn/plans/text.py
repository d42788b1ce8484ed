"""Text, date, URL and key rules over documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.functions import scalars as S
from cairn.operators import joins as J
from cairn.plans.base import query

URL = """
WITH n AS (SELECT page_id, regexp_replace(url, '#.*$', '') AS bare FROM pages),
h AS (SELECT page_id, regexp_extract(bare, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)', 1) AS head, bare FROM n),
p AS (SELECT page_id, lower(head) AS head, regexp_replace(regexp_extract(substr(bare, length(head) + 1), '^([^?]*)', 1), '/+$', '') AS path, regexp_extract(bare, '\\?(.*)$', 1) AS query FROM h),
k AS (SELECT *, list_filter(string_split(query, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|fbclid|gclid|mc_cid|mc_eid|ref)(=|$)')) AS kept FROM p),
u AS (SELECT page_id, head || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS normal, regexp_replace(head || path || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END, '^https?://(www\\.)?', 'http://') AS key FROM k)
"""


@query(URL + "SELECT page_id, normal, key FROM u")
def q_url_norm(t):
    return t.pages.select("page_id", S.normalize_url(F.col("url")).alias("normal"), S.url_key(F.col("url")).alias("key"))


@query(URL + ", v AS (SELECT page_id, regexp_replace(key, '/[0-9]+$', '') AS key FROM u) SELECT min(page_id) AS page_id, key FROM v GROUP BY key")
def q_dedupe_known(t):
    rows = t.pages.select("page_id", F.regexp_replace(S.url_key(F.col("url")), "/[0-9]+$", "").alias("key"))
    return J.first_wins(rows, F.col("key"), ["page_id"])


@query("WITH h AS (SELECT doc_id, substr(array_to_string(regexp_extract_all(lower(text), '[a-z0-9]+'), ' '), 1, 200) AS key FROM documents) SELECT min(doc_id) AS doc_id, sha256(key) AS key FROM h GROUP BY key")
def q_dedupe_headline(t):
    rows = t.documents.select("doc_id", S.headline_key(F.col("text")).alias("key"))
    return J.first_wins(rows, F.col("key"), ["doc_id"]).select("doc_id", F.sha2("key", 256).alias("key"))


@query("""
SELECT doc_id FROM documents WHERE lang = 'en' AND source IN ('src1', 'src2', 'src3', 'src5') AND contains(lower(text), 'the') AND contains(lower(text), 'and') AND contains(lower(text), 'ing')""")
def q_facets(t):
    low = F.lower("text")
    terms = [F.instr(low, w) > 0 for w in ("the", "and", "ing")]
    return t.documents.where((F.col("lang") == "en") & F.col("source").isin("src1", "src2", "src3", "src5") & terms[0] & terms[1] & terms[2]).select("doc_id")


TAGS = {"article": r"(^|\s)(the|der|le|el)(\s|$)", "licence": r"licen[cs]e", "marks": r"[*%$#&]{3}", "shout": "!!"}


@query("WITH g AS (SELECT unnest(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(lower(text), '{p}') THEN '{n}' END" for n, p in TAGS.items()) + "], lambda x: x IS NOT NULL)) AS tag FROM documents) SELECT tag, count(*) AS n FROM g GROUP BY 1")
def q_concern_tags(t):
    return t.documents.select(F.explode(S.keyword_tags(F.col("text"), TAGS)).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


PARTIAL = "SELECT o_orderkey, substr(CAST(o_orderdate::DATE AS VARCHAR), 1, CASE o_orderkey % 3 WHEN 0 THEN 4 WHEN 1 THEN 7 ELSE 10 END) AS s FROM orders"


def partial(t):
    k = F.col("o_orderkey") % 3
    return t.orders.select("o_orderkey", F.substring(F.col("o_orderdate").cast("date").cast("string"), F.lit(1), F.when(k == 0, 4).when(k == 1, 7).otherwise(10)).alias("s"))


@query(f"""
WITH p AS ({PARTIAL}) SELECT o_orderkey, s, CASE length(s) WHEN 10 THEN s::DATE END AS exact, CASE length(s) WHEN 4 THEN (s || '-12-31')::DATE WHEN 7 THEN last_day((s || '-01')::DATE) ELSE s::DATE END AS latest, s <= substr('1998-07-15', 1, length(s)) AS passed FROM p""")
def q_partial_dates(t):
    s = F.col("s")
    return partial(t).select("o_orderkey", "s", S.strict_date(s).alias("exact"), S.latest_day(s).alias("latest"), S.not_after(s, F.lit("1998-07-15")).alias("passed"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate::DATE AS VARCHAR) ELSE substr(CAST(o_orderdate::DATE AS VARCHAR), 1, 7) END AS latest FROM orders""")
def q_text_dates(t):
    d = F.col("o_orderdate").cast("date")
    said = F.when(F.col("o_orderkey") % 4 == 0, "undated").when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("seen May 1990, adopted "), d.cast("string"))).otherwise(F.concat(F.lit("1990-01; since "), F.date_format(d, "MMMM yyyy")))
    return t.orders.select("o_orderkey", S.latest_text_date(said).alias("latest"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 4 <> 0 THEN CASE WHEN p_size % 4 = 1 THEN p_size ELSE p_size * CASE WHEN p_size % 4 = 2 THEN 0.001 ELSE 1000.0 END END END::DOUBLE AS low,
  CASE WHEN p_size % 4 <> 0 THEN CASE WHEN p_size % 4 = 1 THEN p_size + 5 ELSE p_size * CASE WHEN p_size % 4 = 2 THEN 0.001 ELSE 1000.0 END END END::DOUBLE AS high FROM part""")
def q_capacity_parse(t):
    n, size = F.col("p_size") % 4, F.col("p_size").cast("string")
    said = F.when(n == 0, F.concat(size, F.lit(" acres"))).when(n == 1, F.concat(F.lit("about "), size, F.lit("-"), (F.col("p_size") + 5).cast("string"), F.lit(" MW"))).when(n == 2, F.concat(size, F.lit(" kW"))).otherwise(F.concat(size, F.lit(" GW")))
    low, high = S.capacity(said)
    return t.part.select("p_partkey", low.alias("low"), high.alias("high"))


@query("SELECT c_custkey, lpad(c_custkey::VARCHAR, 6, '0') AS key, 'cus_' || substr(sha1(c_custkey || '|' || c_mktsegment), 1, 10) AS id, list_position(['BUILDING', 'MACHINERY'], c_mktsegment) - 1 AS level, round(CASE WHEN c_acctbal >= 0 THEN ln(1 + c_acctbal) END, 6) AS log_balance, regexp_replace(lower(c_name), '[^a-z0-9]', '', 'g') AS squashed FROM customer")
def q_keys(t):
    return t.customer.select("c_custkey", S.padded_key(F.col("c_custkey"), 6).alias("key"), S.stable_id("cus_", F.col("c_custkey").cast("string"), F.col("c_mktsegment")).alias("id"), S.level_index(F.col("c_mktsegment"), ("BUILDING", "MACHINERY")).cast("int").alias("level"), S.transform_number(F.col("c_acctbal"), "log1p").alias("log_balance"), S.squash(F.col("c_name")).alias("squashed"))


@query("""
WITH d AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(substr(text, 1, length(text))), '[a-z0-9]+')) AS w FROM documents), i AS (SELECT item_id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) AS w FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS x FROM d), iw AS (SELECT item_id, len(w) AS n, unnest(w) AS x FROM i), s AS (SELECT doc_id, item_id, count(*)::DOUBLE / n AS score FROM dw JOIN iw USING (x) GROUP BY doc_id, item_id, n),
r AS (SELECT *, row_number() OVER w AS rn, lead(score) OVER w AS nxt FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY score DESC, item_id))
SELECT doc_id, item_id, round(score, 6) AS score FROM r WHERE rn = 1 AND (nxt IS NULL OR score > nxt) AND score >= 0.9""")
def q_attach_tiebreak(t):
    """Documents that hold nine tenths of an item's words; of several items the strictly best one attaches."""
    from cairn.operators.similar import containing, words_of

    pairs = containing(t.documents.select("doc_id", words_of("text").alias("words")), t.benchmark.select("item_id", words_of("text").alias("words")), "doc_id", "item_id", 0.9)
    best = pairs.groupBy("doc_id").agg(F.max("score").alias("score"))
    top = pairs.join(best, ["doc_id", "score"]).groupBy("doc_id", "score").agg(F.min("item_id").alias("item_id"), F.count("*").alias("n")).where("n = 1")
    return top.select("doc_id", "item_id", F.round("score", 6).alias("score"))


@query("SELECT CAST(regexp_extract(url, '^([a-z]+)://', 1) AS VARCHAR) AS scheme, count(*) AS n, count(*) FILTER (WHERE contains(url, '#')) AS n_fragment FROM pages GROUP BY 1")
def q_sql_functions(t):
    """Rules registered as SQL functions, called from SQL text over a view."""
    S.register_sql_functions(t.spark)
    t.pages.createOrReplaceTempView("pages_by_scheme")
    return t.spark.sql("SELECT blank_to_null(regexp_extract(url, '^([a-z]+)://', 1)) AS scheme, count(*) AS n, count_if(contains(url, '#')) AS n_fragment FROM pages_by_scheme GROUP BY 1")


@query("WITH h AS (SELECT doc_id, sha256(text) AS h FROM documents) SELECT h AS content_hash, min(doc_id) AS first_id, count(*) AS n_seen, count(*) > 1 AS had_unchanged FROM h GROUP BY 1")
def q_incremental_parse(t):
    """ST1-ST3 as a batch: what the streaming job's state holds after reading everything."""
    return t.documents.groupBy(F.sha2("text", 256).alias("content_hash")).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_seen"), (F.count("*") > 1).alias("had_unchanged"))
