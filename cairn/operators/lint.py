"""What changed between two snapshots, cell by cell, and whether each change was made as it should be."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds of access that mean a source was read, columns that hold notes and dates, forms of them.
ACCESS = ("opened", "archived", "snippet")
READ = ("opened", "archived")
NOTES = ("note", "evidence_note", "reviewer_notes", "review_note", "draft_note")
DATES = ("checked_on", "reviewed_on", "drafted_on", "evidence_date", "date")
PARTIAL = r"^\d{4}(-\d{2}(-\d{2})?)?$"
#: Levels of the codes: errors stop a merge, warnings don't.
LEVELS = {"ACCESS": "E", "READ_NO_NOTE": "E", "SNIPPET_NO_TRIES": "W", "NO_REVIEWER": "E", "SELF_REVIEW": "E", "NO_LOG": "E", "NOTE_REWRITTEN": "W", "EMDASH": "W", "DATE": "E", "REMOVED": "W"}


def cell_changes(base: DataFrame, head: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, kind, column, before, after): one row per cell that differs, as text; blank and null are the same.

    kind is added, removed or changed. A column that only ``head`` has counts as blank in ``base``, and one that it lost isn't
    looked at. Keys are distinct in both, and compared null-safe.
    """
    columns = [c for c in head.columns if c not in keys]
    text = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit(""))
    cells = lambda df: F.map_from_arrays(F.array(*map(F.lit, columns)), F.array(*(text(c) if c in df.columns else F.lit("") for c in columns)))
    sides = [df.select(*(F.col(k).alias(f"{k}{tag}") for k in keys), cells(df).alias(f"cells{tag}")) for df, tag in ((base, "__b"), (head, "__h"))]
    on = None
    for k in keys:
        same = F.col(f"{k}__b").eqNullSafe(F.col(f"{k}__h"))
        on = same if on is None else on & same
    both = sides[0].join(sides[1], on, "full")
    kind = F.when(F.col("cells__b").isNull(), "added").when(F.col("cells__h").isNull(), "removed").otherwise("changed")
    of = lambda tag, c: F.coalesce(F.try_element_at(f"cells{tag}", c), F.lit(""))
    each = both.select(*(F.coalesce(f"{k}__h", f"{k}__b").alias(k) for k in keys), kind.alias("kind"), F.explode(F.array(*map(F.lit, columns))).alias("column"), "cells__b", "cells__h")
    return each.select(*keys, "kind", "column", of("__b", F.col("column")).alias("before"), of("__h", F.col("column")).alias("after")).where("before <> after")


def signer(signature: Column) -> Column:
    """Who signed, without the note of a run: 'agent:x-1 (first pass)' and 'agent:x-1 (second)' are one."""
    return F.lower(F.trim(F.regexp_replace(signature, r"\s*\(.*$", "")))


def lint(base: DataFrame, head: DataFrame, keys: list[str], as_of: str, *, log: DataFrame | None = None, required: tuple[str, ...] = ("reviewer",)) -> DataFrame:
    """(keys, level, code, column): what is wrong with each row of ``head`` that is new or changed, and rows that are gone.

    ACCESS: an access that isn't a known kind. READ_NO_NOTE: read, without a note, or newly read with the notes as they were.
    SNIPPET_NO_TRIES: a snippet whose note names no address and day. NO_REVIEWER: a column of ``required`` is blank.
    SELF_REVIEW: the reviewer drafted the row, or both of two readings joined by ' + ' are one signer's. NO_LOG: the access
    changed, and ``log(keys, at)`` has no line for the row from checked_on (or ever, if blank) up to ``as_of``.
    NOTE_REWRITTEN: a note lost what it said. EMDASH: a note gained a long dash. DATE: not a partial date, or a day after
    ``as_of``. REMOVED: the row is gone. Columns that ``head`` doesn't have raise nothing.

    The changed cells are gathered per row (as many as there are columns) and joined to their row and the last log line.
    """
    have = [c for c in head.columns if c not in keys]
    changes = cell_changes(base, head, keys)
    null_safe = lambda a, b: [F.col(f"{a}{k}").eqNullSafe(F.col(f"{b}{k}")) for k in keys]
    touched = changes.where("kind <> 'removed'").groupBy(*keys).agg(F.max("kind").alias("__kind"), F.map_from_entries(F.collect_list(F.struct("column", "before"))).alias("__before"))
    text = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) if c in have else F.lit("")
    rows = head.select(*(F.col(k).alias(f"h__{k}") for k in keys), *have).join(touched.select(*(F.col(k).alias(f"t__{k}") for k in keys), "__kind", "__before"), _all(null_safe("h__", "t__")))
    if log is not None:
        seen = log.where(F.col("at").cast("date") <= F.lit(as_of).cast("date")).groupBy(*keys).agg(F.max(F.col("at").cast("date")).alias("__logged"))
        rows = rows.join(seen.select(*(F.col(k).alias(f"l__{k}") for k in keys), "__logged"), _all(null_safe("h__", "l__")), "left")
    old = lambda c: F.when(F.col("__kind") == "added", "").otherwise(F.coalesce(F.try_element_at("__before", F.lit(c)), text(c)))
    new_row = F.col("__kind") == "added"
    notes = [c for c in NOTES if c in have]
    note, old_note = F.concat_ws(" ", *map(text, notes)) if notes else F.lit(""), F.concat_ws(" ", *map(old, notes)) if notes else F.lit("")
    access, was = text("access"), old("access")
    reads, read_before = access.isin(*READ), was.isin(*READ)
    reviewer, drafter = text("reviewer"), text("drafted_by")
    halves = F.transform(F.split(reviewer, r" \+ "), signer)
    checked = text("checked_on").try_cast("date")
    unlogged = (F.col("__logged").isNull() | F.coalesce(F.col("__logged") < checked, F.lit(False))) if log is not None else F.lit(False)
    rules = [
        ("ACCESS", "access", (access != "") & ~access.isin(*ACCESS)),
        ("READ_NO_NOTE", "access", F.lit(bool(notes)) & reads & ((F.trim(note) == "") | (~new_row & ~read_before & (note == old_note)))),
        ("SNIPPET_NO_TRIES", "access", F.lit(bool(notes)) & (access == "snippet") & ~(F.contains(note, F.lit("http")) & note.rlike(r"\d{4}-\d{2}-\d{2}"))),
        *(("NO_REVIEWER", c, text(c) == "") for c in required if c in have),
        ("SELF_REVIEW", "reviewer", (reviewer != "") & (((drafter != "") & (signer(reviewer) == signer(drafter))) | (F.size(F.array_distinct(halves)) < F.size(halves)))),
        ("NO_LOG", "access", (access != was) & unlogged),
        *(("NOTE_REWRITTEN", c, ~new_row & (old(c) != "") & ~F.contains(text(c), old(c))) for c in notes),
        *(("EMDASH", c, F.contains(F.when(F.startswith(text(c), old(c)), F.substr(text(c), F.length(old(c)) + 1)).otherwise(text(c)), F.lit("—"))) for c in notes),
        *(("DATE", c, (text(c) != "") & (~text(c).rlike(PARTIAL) | F.coalesce((F.length(text(c)) == 10) & (text(c).try_cast("date").isNull() | (text(c).try_cast("date") > F.lit(as_of).cast("date"))), F.lit(False)))) for c in DATES if c in have),
    ]
    found = F.filter(F.array(*(F.struct(F.lit(LEVELS[code]).alias("level"), F.lit(code).alias("code"), F.lit(c).alias("column"), F.coalesce(bad, F.lit(False)).alias("bad")) for code, c, bad in rules)), lambda r: r["bad"])
    out = rows.select(*(F.col(f"h__{k}").alias(k) for k in keys), F.explode(found).alias("f")).select(*keys, "f.level", "f.code", "f.column")
    gone = base.select(*keys).exceptAll(head.select(*keys)).distinct().select(*keys, F.lit("W").alias("level"), F.lit("REMOVED").alias("code"), F.lit(None).cast("string").alias("column"))
    return out.unionByName(gone)


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out
