"""The registered query of every operator here: production parameters, whole tables, full results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.annulus import CLUSTERS, COMPONENTS, ROUNDS, SCALE, cluster_vectors
from cairn.llm.audit import CAPITALS, DISTINCT, FILTERS, MIN_WORDS, audit_filters
from cairn.llm.chat import format_chats, loss_text, read_back
from cairn.llm.decontam import contaminated
from cairn.llm.exact import exact_duplicates
from cairn.llm.html import extract_text
from cairn.llm.licenses import scan_licenses
from cairn.llm.lines import MIN_PAGES, RATIO, drop_boilerplate
from cairn.llm.packing import pack_documents
from cairn.llm.quality import score_quality
from cairn.llm.simhash import simhash_components
from cairn.llm.substrings import remove_repeats
from cairn.llm.vectors import link_vectors


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_boilerplate(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "text")


OP2_SQL = f"""
WITH d AS (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM documents),
p AS (SELECT source, line, count(*) AS n FROM (SELECT source, unnest(list_distinct(ls)) AS line FROM d) WHERE line <> '' GROUP BY source, line),
t AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
b AS (SELECT p.source, list(p.line) AS bad FROM p JOIN t ON p.source = t.source WHERE p.n >= {MIN_PAGES} AND p.n > {RATIO} * t.pages GROUP BY p.source),
k AS (SELECT d.doc_id, d.ls, list_filter(d.ls, lambda x: b.bad IS NULL OR NOT list_contains(b.bad, x)) AS kept FROM d LEFT JOIN b ON d.source = b.source)
SELECT doc_id, CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(kept) AS BIGINT) AS n_dropped, array_to_string(kept, chr(10)) AS text FROM k
"""


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    extra = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.explode(F.array(*(F.struct(F.lit(k).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(odd).alias("text")) for k, r in enumerate(("user", "assistant"))))).alias("t"))
    chats = format_chats(turns.unionByName(extra.select("conv_id", "t.*")))
    said = F.array_join(F.transform(read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = loss_text(F.col("segments"))
    return chats.select("conv_id", F.size(read_back(F.col("formatted"))).cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


OP5_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS before,
  length(regexp_replace(text, '[<\\[]', '..', 'g')) AS text_chars, length(regexp_replace(role, '[<\\[]', '..', 'g')) AS role_chars FROM t),
s AS (SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
  coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
  CAST(sum(text_chars + CASE WHEN before IS DISTINCT FROM role THEN role_chars + 13 ELSE 6 END) AS BIGINT) AS formatted_chars
  FROM o GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM s
"""


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = simhash_components(table(spark, sf_dir, "documents"))
    return marked.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text")


def op11_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_BITS = " + ".join(f"(CASE WHEN {{}} LIKE '%{f}%' THEN {1 << k} ELSE 0 END)" for k, f in enumerate(FILTERS))
OP11_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
l AS (SELECT doc_id AS id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, CAST(len(ws) < {MIN_WORDS} AS INT) + 2 * CAST(100 * len(list_distinct(ws)) < {DISTINCT} * len(ws) AS INT) + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {CAPITALS} * length(t) AS INT)
  + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(doc_id > first, false) AS INT) AS m, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM w LEFT JOIN l ON doc_id = id),
c AS (SELECT part, m, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM m GROUP BY part, m),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT filter_order, CAST(k AS INT) AS step, {_BITS.format(*["filter_order[k]"] * 5)} AS bit, {_BITS.format(*["substr(filter_order, 1, k - 1)"] * 5)} AS before FROM o, range(1, 6) r(k))
SELECT part, filter_order, step, CAST(sum(n) FILTER (WHERE m & (before | bit) = 0) AS BIGINT) AS kept, CAST(sum(n) FILTER (WHERE m & bit <> 0 AND m & before = 0) AS BIGINT) AS removed,
  CAST(sum(n) FILTER (WHERE m & bit <> 0 AND m & before <> 0) AS BIGINT) AS redundant, CAST(sum(n) FILTER (WHERE m = bit) AS BIGINT) AS unique_fails,
  CAST(sum(good) FILTER (WHERE m & bit <> 0 AND m & before = 0) AS BIGINT) AS good_lost, CAST(sum(toxic) FILTER (WHERE m & bit <> 0 AND m & before = 0) AS BIGINT) AS toxic_lost
FROM c, s GROUP BY part, filter_order, step, bit, before
"""
OP11_SQL = f"""
WITH r AS ({OP11_SQL})
SELECT part, filter_order, step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed, coalesce(redundant, 0) AS redundant, coalesce(unique_fails, 0) AS unique_fails, coalesce(good_lost, 0) AS good_lost,
  coalesce(toxic_lost, 0) AS toxic_lost, CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, filter_order[step]) AS BIGINT) AS shapley FROM r
"""


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def _lloyd_sql() -> str:
    """The rounds of op12 written out: d * 8 + c orders by distance, then by number."""
    parts = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor({SCALE} * CAST(e AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0)""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), x) - 1 AS c, x AS y FROM v ORDER BY sha256('3:' || vec_id), x LIMIT {CLUSTERS})",
    ]
    for k in range(ROUNDS + 1):
        parts.append(f"a{k} AS MATERIALIZED (SELECT r, min(CAST(list_sum(list_transform(list_zip(x, y), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) * {CLUSTERS} + c) AS best FROM v, c{k} GROUP BY r)")
        if k < ROUNDS:
            sums = f"SELECT best % {CLUSTERS} AS c, i, sum(x[i]) AS s, count(*) AS n FROM a{k} JOIN v USING (r), range(1, {COMPONENTS + 1}) g(i) GROUP BY 1, 2"
            parts.append(f"c{k + 1} AS MATERIALIZED (SELECT c, coalesce(z, y) AS y FROM c{k} LEFT JOIN (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS z FROM ({sums}) GROUP BY c) USING (c))")
    at = f"SELECT r, best % {CLUSTERS} AS c, best // {CLUSTERS} AS d FROM a{ROUNDS}"
    return f"""WITH {", ".join(parts)} SELECT vec_id, CAST(c AS INT) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(y, ',')) AS centroid_sha256 FROM ({at}) JOIN v USING (r) JOIN c{ROUNDS} USING (c)"""


def op13_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM d
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_lines": op2_lines,
    "op3_substrings": op3_substrings,
    "op4_licenses": op4_licenses,
    "op5_chat": op5_chat,
    "op6_decontamination": op6_decontamination,
    "op7_simhash": op7_simhash,
    "op8_vectors": op8_vectors,
    "op9_quality": op9_quality,
    "op10_html": op10_html,
    "op11_filters": op11_filters,
    "op12_clusters": op12_clusters,
    "op13_exact": op13_exact,
}

ORACLES: dict[str, str] = {
    "op2_lines": OP2_SQL,
    "op5_chat": OP5_SQL,
    "op11_filters": OP11_SQL,
    "op12_clusters": _lloyd_sql(),
    "op13_exact": OP13_SQL,
}
