"""Terms of pauses by hand-made records, and the lint of changed rows."""

from cairn.operators import lint
from cairn.operators.terms import with_terms

COLUMNS = "restriction_type string, status string, date_enacted_iso string, current_end_date_iso string, text string"


def derive(spark, text, kind="moratorium", status="active", enacted="2023-01-31", end=""):
    return with_terms(spark.createDataFrame([(kind, status, enacted, end, text)], COLUMNS), "2024-06-30").first()


def test_ends(spark):
    def ends(*a, **k):
        r = derive(spark, *a, **k)
        return r.ends_on, r.ends_on_basis, r.months_in_force

    assert ends("x", end="2023-07-31") == ("2023-07-31", "record", 6.0)
    assert ends("runs through approximately March 1, 2024") == ("2024-03-01", "text", 13.0)
    assert ends("until March 2024; expires in May 2024") == ("2024-05", "text", 16.0)
    assert ends("until 2023-02-30") == (None, None, 17.0)
    assert ends("a one-month moratorium") == ("2023-02-28", "term", 0.9)
    assert ends("a moratorium on wind for a period of six months") == ("2023-07-31", "term", 6.0)
    assert ends("a 2-year moratorium, since extended") == (None, None, 17.0)
    assert ends("In June 2023, a 6-month moratorium", enacted="") == ("2023-12", "term", 7.0)
    assert ends("a 6-month moratorium", enacted="2023") == (None, None, None)
    assert ends("a 6-month moratorium", enacted="2025-01-01") == ("2025-07-01", "term", None)


def test_terms_and_extensions(spark):
    term = lambda t, k: derive(spark, t, kind=k).term
    assert [term("No solar.", "ban"), term("a temporary ban", "ban"), term("Ban / Moratorium (wind); not allowed", "ban_or_moratorium"), term("x", "ban_or_moratorium"), term("x", "setback")] == ["permanent", "temporary", "permanent", "unclear", None]

    def extended(text, **k):
        r = derive(spark, text, **k)
        return r.extensions, r.last_extended_on

    assert extended("It was extended on 2023-06-01 to 2023-12-01. Extended again December 5, 2023; renewed 2023-06-01.") == (2, "2023-12-05")
    assert extended("It may be extended on 2023-06-01.") == (0, None)
    assert extended("It may be extended, and was extended on 2023-06-01.") == (1, "2023-06-01")
    assert extended("Extended from 2023-06-01 until 2024-01-01, first adopted 2023-01-31.") == (1, None)
    assert extended("x", status="extended") == (1, None)
    assert extended("extended on February 30, 2023") == (1, None)


def test_drafting(spark):
    r = derive(spark, "The board is studying rules. The county is developing a wind ordinance. It was lifted.")
    assert (r.drafting, r.drafting_note) == ("adopted", "It was lifted.")
    r = derive(spark, "A pause. The county is developing a wind ordinance.")
    assert (r.drafting, r.drafting_note) == ("active", "The county is developing a wind ordinance.")
    assert derive(spark, None, kind=None).drafting is None and derive(spark, None).ends_on is None


FIELDS = "k int, access string, note string, reviewer string, drafted_by string, checked_on string"


def test_changes_and_new_columns(spark):
    base = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "c", "y"), (None, "d", "z")], "k int, v string, old string")
    head = spark.createDataFrame([(1, "a ", ""), (2, "b", "n"), (4, None, "m"), (None, "e", None)], "k int, v string, new string")
    got = sorted(((r.k, r.kind, r.column, r.before, r.after) for r in lint.cell_changes(base, head, ["k"]).collect()), key=str)
    assert got == sorted([(2, "changed", "new", "", "n"), (3, "removed", "v", "c", ""), (4, "added", "new", "", "m"), (None, "changed", "v", "d", "e")], key=str)


def test_codes(spark):
    note = "http://a.org tried 2024-01-02"
    row = lambda k, access="snippet", n=note, reviewer="agent:a (1)", drafter="agent:b", day="2024-01-02": (k, access, n, reviewer, drafter, day)
    base = [row(k) for k in range(1, 12)]
    head = [row(1), row(2, "opened"), row(3, "opened", note + "; says no"), row(4, "read"), row(5, n="lost"), row(6, reviewer=""), row(7, reviewer="AGENT:B (2)"), row(8, reviewer="x (1) + X (2)"), row(9, day="2024-13-01"), row(10, day="May 2024"), row(12, "archived", "")]
    log = [(3, "2024-02-01 00:00:00"), (4, "2024-01-01 00:00:00"), (2, "2030-01-01 00:00:00"), (12, "2024-01-02 08:00:00")]
    frames = [spark.createDataFrame(x, FIELDS) for x in (base, head)]
    logs = spark.createDataFrame(log, "k int, at string")
    got = {(r.k, r.code) for r in lint.lint(*frames, ["k"], "2024-06-30", log=logs).collect()}
    assert got == {(2, "READ_NO_NOTE"), (2, "NO_LOG"), (4, "ACCESS"), (4, "NO_LOG"), (5, "SNIPPET_NO_TRIES"), (5, "NOTE_REWRITTEN"), (6, "NO_REVIEWER"), (7, "SELF_REVIEW"), (8, "SELF_REVIEW"), (9, "DATE"), (10, "DATE"), (11, "REMOVED"), (12, "READ_NO_NOTE")}
    assert not {r.code for r in lint.lint(*frames, ["k"], "2024-06-30").collect()} & {"NO_LOG"}
