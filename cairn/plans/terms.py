"""Terms of pauses and what changed between snapshots, over cells made from whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.operators import lint, terms
from cairn.plans.base import query

AS_OF = "2003-06-30"


@query(f"""
WITH o AS (SELECT o_orderkey AS id, o_orderkey % 10 AS m, o_orderdate::DATE AS d FROM orders),
f AS (SELECT id, m, d, CASE WHEN m IN (0, 1, 2, 3, 8, 9) THEN 'temporary' WHEN m IN (4, 6) THEN 'permanent' WHEN m = 5 THEN 'unclear' END AS term,
  CASE m WHEN 0 THEN strftime(d + INTERVAL 6 MONTH, '%Y-%m-%d') WHEN 1 THEN strftime(d + INTERVAL 24 MONTH, '%Y-%m-%d') WHEN 2 THEN strftime(d + INTERVAL 720 DAY, '%Y-%m-%d') WHEN 3 THEN '2001-12' WHEN 8 THEN '2000-03' END AS ends_on,
  CASE m WHEN 0 THEN 'term' WHEN 1 THEN 'term' WHEN 2 THEN 'text' WHEN 3 THEN 'record' WHEN 8 THEN 'term' END AS ends_on_basis, CASE m WHEN 2 THEN 1 WHEN 3 THEN 2 - CASE WHEN d IN (DATE '2001-03-05', DATE '2002-06-07') THEN 1 ELSE 0 END WHEN 9 THEN 1 ELSE CASE WHEN m IN (0, 1, 8) THEN 0 END END AS extensions,
  CASE m WHEN 2 THEN strftime(d + INTERVAL 360 DAY, '%Y-%m-%d') WHEN 3 THEN '2002-06-07' END AS last_extended_on, CASE m WHEN 3 THEN 'active' WHEN 9 THEN 'adopted' END AS drafting,
  CASE m WHEN 3 THEN 'The council is drafting a zoning ordinance;' WHEN 9 THEN 'The board adopted the new ordinance, ending the moratorium.' END AS drafting_note,
  CASE WHEN m = 8 THEN DATE '1999-09-01' WHEN m = 9 THEN date_trunc('month', d)::DATE WHEN m <> 7 THEN d END AS start FROM o),
g AS (SELECT *, least(DATE '{AS_OF}', coalesce(CASE WHEN length(ends_on) = 7 THEN last_day((ends_on || '-01')::DATE) ELSE ends_on::DATE END, DATE '{AS_OF}')) AS stop FROM f)
SELECT id, term, ends_on, ends_on_basis, CAST(extensions AS INT) AS extensions, last_extended_on, drafting, drafting_note,
  CASE WHEN start <= DATE '{AS_OF}' THEN round(greatest((year(stop) - year(start)) * 12 + month(stop) - month(start) + (day(stop) - day(start)) / 30.4::DOUBLE, 0.0), 1) END AS months_in_force FROM g""")
def q_terms(t):
    """Ends by record, text and stated term, extensions, drafting, over a record for each order."""
    m, day = F.col("m"), F.col("d")
    o = t.orders.select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 10).alias("m"), F.col("o_orderdate").cast("date").alias("d"))
    texts = {
        0: F.lit("A 6-month moratorium on solar farms."),
        1: F.lit("Adopted a moratorium on wind for two years; it may be extended."),
        2: F.concat(F.lit("A one-year moratorium. It was extended on "), F.date_add(day, 360).cast("string"), F.lit(" until "), F.date_format(F.date_add(day, 720), "MMMM d, yyyy"), F.lit(".")),
        3: F.lit("The council is drafting a zoning ordinance; extended on March 5, 2001 and renewed on June 7, 2002."),
        4: F.lit("Solar farms are prohibited."),
        5: F.lit("Ban / Moratorium (wind). No wind."),
        6: F.lit("Ban / Moratorium (wind). Wind turbines are not allowed."),
        7: F.lit("A setback until 2002-01-01."),
        8: F.lit("In September 1999 the county enacted a 6-month moratorium."),
        9: F.lit("A one-year moratorium. The board adopted the new ordinance, ending the moratorium."),
    }
    text = F.coalesce(*(F.when(m == k, v) for k, v in texts.items()))
    kind = F.when(m.isin(0, 1, 2, 3, 8, 9), "moratorium").when(m == 4, "ban").when(m.isin(5, 6), "ban_or_moratorium").otherwise("setback")
    enacted = F.when(m == 8, "").when(m == 9, F.date_format(day, "yyyy-MM")).otherwise(day.cast("string"))
    rows = o.select("id", kind.alias("restriction_type"), F.when(m == 9, "extended").otherwise("active").alias("status"), enacted.alias("date_enacted_iso"), F.when(m == 3, "2001-12").otherwise("").alias("current_end_date_iso"), text.alias("text"))
    return terms.with_terms(rows, AS_OF).select("id", "term", "ends_on", "ends_on_basis", "extensions", "last_extended_on", "drafting", "drafting_note", "months_in_force")


CELLS = """
WITH c AS (SELECT c_custkey AS k, c_custkey % 12 AS m FROM customer),
b AS (SELECT k, 'snippet' AS access, 'http://a.org/' || k || ' tried 2001-02-03' AS note, 'agent:a (r1)' AS reviewer, 'agent:b' AS drafted_by, '2001-02-03' AS checked_on FROM c WHERE m <> 10),
h AS (SELECT k, CASE WHEN m IN (1, 2, 10) THEN 'opened' WHEN m = 3 THEN 'seen' ELSE 'snippet' END AS access, CASE m WHEN 4 THEN 'gone' WHEN 2 THEN 'http://a.org/' || k || ' tried 2001-02-03; says no' WHEN 11 THEN 'http://a.org/' || k || ' tried 2001-02-03 — again' ELSE 'http://a.org/' || k || ' tried 2001-02-03' END AS note,
  CASE m WHEN 5 THEN '' WHEN 6 THEN 'Agent:B (r2)' WHEN 7 THEN 'agent:a (1) + agent:a (2)' ELSE 'agent:a (r1)' END AS reviewer, 'agent:b' AS drafted_by, CASE m WHEN 8 THEN '2031-01-01' ELSE '2001-02-03' END AS checked_on FROM c WHERE m <> 9),
g AS (SELECT k, CASE WHEN k % 24 < 12 THEN TIMESTAMP '2001-03-01 10:00:00' ELSE TIMESTAMP '2001-01-01 00:00:00' END AS logged FROM c WHERE m IN (1, 2, 3, 10) AND k % 5 > 0)
"""


def cells(t):
    k, m = F.col("k"), F.col("m")
    c = t.customer.select(F.col("c_custkey").alias("k"), (F.col("c_custkey") % 12).alias("m"))
    note = F.concat(F.lit("http://a.org/"), k.cast("string"), F.lit(" tried 2001-02-03"))
    who = F.lit("agent:b").alias("drafted_by")
    base = c.where("m <> 10").select("k", F.lit("snippet").alias("access"), note.alias("note"), F.lit("agent:a (r1)").alias("reviewer"), who, F.lit("2001-02-03").alias("checked_on"))
    access = F.when(m.isin(1, 2, 10), "opened").when(m == 3, "seen").otherwise("snippet")
    later = F.when(m == 4, "gone").when(m == 2, F.concat(note, F.lit("; says no"))).when(m == 11, F.concat(note, F.lit(" — again"))).otherwise(note)
    reviewer = F.when(m == 5, "").when(m == 6, "Agent:B (r2)").when(m == 7, "agent:a (1) + agent:a (2)").otherwise("agent:a (r1)")
    head = c.where("m <> 9").select("k", access.alias("access"), later.alias("note"), reviewer.alias("reviewer"), who, F.when(m == 8, "2031-01-01").otherwise("2001-02-03").alias("checked_on"))
    log = c.where("m IN (1, 2, 3, 10) AND k % 5 > 0").select("k", F.when(k % 24 < 12, F.lit("2001-03-01 10:00:00")).otherwise("2001-01-01 00:00:00").cast("timestamp").alias("at"))
    return base, head, log


@query(CELLS + """
SELECT k, CASE WHEN b.k IS NULL THEN 'added' WHEN h.k IS NULL THEN 'removed' ELSE 'changed' END AS kind, col AS "column", before, after FROM b FULL JOIN h USING (k),
  LATERAL (SELECT unnest(['access', 'note', 'reviewer', 'drafted_by', 'checked_on']) AS col, unnest([coalesce(b.access, ''), coalesce(b.note, ''), coalesce(b.reviewer, ''), coalesce(b.drafted_by, ''), coalesce(b.checked_on, '')]) AS before,
    unnest([coalesce(h.access, ''), coalesce(h.note, ''), coalesce(h.reviewer, ''), coalesce(h.drafted_by, ''), coalesce(h.checked_on, '')]) AS after) WHERE before <> after""")
def q_cell_changes(t):
    """The cells that differ between two snapshots."""
    base, head, _ = cells(t)
    return lint.cell_changes(base, head, ["k"])


@query(CELLS + r""", j AS (SELECT h.*, b.k IS NULL AS fresh, coalesce(b.access, '') AS was, coalesce(b.note, '') AS said, logged FROM h LEFT JOIN b USING (k) LEFT JOIN g USING (k) WHERE b.k IS NULL OR (b.access, b.note, b.reviewer, b.drafted_by, b.checked_on) <> (h.access, h.note, h.reviewer, h.drafted_by, h.checked_on)),
w AS (SELECT *, list_transform(string_split(reviewer, ' + '), lambda r: lower(trim(regexp_replace(r, '\s*\(.*$', '')))) AS who FROM j)
SELECT k, 'E' AS level, 'ACCESS' AS code, 'access' AS "column" FROM w WHERE access NOT IN ('opened', 'archived', 'snippet')
UNION ALL SELECT k, 'E', 'READ_NO_NOTE', 'access' FROM w WHERE access IN ('opened', 'archived') AND (note = '' OR (NOT fresh AND was NOT IN ('opened', 'archived') AND note = said))
UNION ALL SELECT k, 'W', 'SNIPPET_NO_TRIES', 'access' FROM w WHERE access = 'snippet' AND NOT (contains(note, 'http') AND regexp_matches(note, '\d{4}-\d{2}-\d{2}'))
UNION ALL SELECT k, 'E', 'NO_REVIEWER', 'reviewer' FROM w WHERE reviewer = ''
UNION ALL SELECT k, 'E', 'SELF_REVIEW', 'reviewer' FROM w WHERE reviewer <> '' AND (lower(trim(regexp_replace(reviewer, '\s*\(.*$', ''))) = drafted_by OR len(list_distinct(who)) < len(who))
UNION ALL SELECT k, 'E', 'NO_LOG', 'access' FROM w WHERE access <> was AND (logged IS NULL OR logged::DATE < checked_on::DATE)
UNION ALL SELECT k, 'W', 'NOTE_REWRITTEN', 'note' FROM w WHERE NOT fresh AND NOT contains(note, said)
UNION ALL SELECT k, 'W', 'EMDASH', 'note' FROM w WHERE contains(substr(note, CASE WHEN starts_with(note, said) THEN length(said) + 1 ELSE 1 END), '—')
UNION ALL SELECT k, 'E', 'DATE', 'checked_on' FROM w WHERE checked_on::DATE > DATE '2003-06-30'
UNION ALL SELECT k, 'W', 'REMOVED', NULL FROM b WHERE k NOT IN (SELECT k FROM h)""")
def q_lint(t):
    """Changed rows against ten codes; the access log is joined by key and day."""
    base, head, log = cells(t)
    return lint.lint(base, head, ["k"], AS_OF, log=log)
