"""Streams replayed in several runs over whole tables, equal to SQL over the whole table at once."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.plans.base import query
from cairn.plans.files import _fresh
from cairn.streaming.attempts import buckets_for, run_attempts

RUNS, RECHECK, MOST = 3, 3, 3


@query(f"""
WITH RECURSIVE e AS (SELECT 'u' || user_id AS url, event_id AS id, ts AS w, user_id % 11 = 0 AS redirect, event_type <> 'error' AS answered, event_type = 'purchase' AND event_id % 7 = 0 AS found, event_type IN ('click', 'view') AS saved FROM events),
o AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY w, id) AS k FROM e),
s AS (SELECT url, 0::BIGINT AS k, 'new' AS status, 0 AS attempts, NULL::TIMESTAMP AS requested, NULL::TIMESTAMP AS w, false AS told FROM (SELECT DISTINCT url FROM o)
  UNION ALL SELECT url, k, CASE kind WHEN 'still' THEN status WHEN 'none' THEN CASE WHEN status = 'new' THEN 'not_archived' ELSE status END WHEN 'refused' THEN CASE WHEN status = 'requested' THEN status ELSE 'not_archived' END ELSE kind END,
    attempts + CASE WHEN kind = 'requested' THEN 1 ELSE 0 END, CASE WHEN kind = 'requested' THEN now ELSE requested END, now, kind <> 'still'
  FROM (SELECT o.url, o.k, s.status, s.attempts, s.requested, o.w AS now, CASE WHEN o.redirect THEN 'unresolved_redirect' WHEN s.status = 'requested' AND o.w < s.requested + INTERVAL {RECHECK} DAY THEN 'still' WHEN NOT o.answered THEN 'none' WHEN o.found THEN 'archived'
      WHEN s.attempts >= {MOST} THEN 'failed' WHEN o.saved THEN 'requested' ELSE 'refused' END AS kind
    FROM s JOIN o ON o.url = s.url AND o.k = s.k + 1 WHERE s.status NOT IN ('archived', 'failed', 'unresolved_redirect'))),
r AS (SELECT url, requested + INTERVAL {RECHECK} DAY AS w, attempts FROM s WHERE told AND status = 'requested' AND requested = w)
SELECT url, w AS "at", status, attempts FROM s WHERE told
UNION ALL SELECT url, w, 'due', attempts FROM r WHERE w <= (SELECT max(ts) FROM events)""")
def q_attempt_log(t):
    """ST5: lookups of addresses arrive in three runs that share a checkpoint; state and timers carry over."""
    folder = _fresh(t)
    lookups = t.events.select(
        F.concat(F.lit("u"), "user_id").alias("url"), F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("at"), (F.col("user_id") % 11 == 0).alias("redirect"), (F.col("event_type") != "error").alias("answered"),
        ((F.col("event_type") == "purchase") & (F.col("event_id") % 7 == 0)).alias("found"), F.col("event_type").isin("click", "view").alias("saved"),
    )
    first, last, addresses = lookups.agg(F.min("at"), F.max("at"), F.approx_count_distinct("url")).first()
    schema, source = lookups.schema, f"{folder}/in"
    lookups.limit(0).write.parquet(source)
    for run in range(RUNS if first else 0):
        after, until = first + (last - first) / RUNS * run, first + (last - first) / RUNS * (run + 1)
        within = (F.col("at") >= F.lit(after)) & ((F.col("at") < F.lit(until)) if run < RUNS - 1 else F.lit(True))
        lookups.where(within).write.mode("append").parquet(source)
        run_attempts(t.spark.readStream.schema(schema).parquet(source), f"{folder}/out", f"{folder}/state", recheck_days=RECHECK, max_attempts=MOST, buckets=buckets_for(addresses)).awaitTermination()
    return t.spark.read.schema("url string, at timestamp, status string, attempts int").parquet(f"{folder}/out") if first else t.spark.createDataFrame([], "url string, at timestamp, status string, attempts int")
