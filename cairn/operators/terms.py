"""How long a pause runs, how often it was extended, and whether the rules it waits for are being drafted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds of pauses, number words and the patterns that the fields rest on.
PAUSES = ("moratorium", "ban", "ban_or_moratorium")
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
MONTH = "january|february|march|april|may|june|july|august|september|october|november|december|jan|feb|mar|apr|jun|jul|aug|sept?|oct|nov|dec"
DATE = rf"(\d{{4}}-\d{{2}}-\d{{2}}|(?:{MONTH})\.?\s+\d{{1,2}},?\s+\d{{4}})"
END = rf"(?i)\b(?:through|until|runs? (?:to|through|until)|expires?(?: on)?|expiring(?: on)?|ends?(?: on)?|to approximately|to about)\s+(?:approximately\s+|about\s+)?{DATE}"
END_MONTH = rf"(?i)\b(?:through|until|runs? (?:to|through|until)|expires?(?: in)?|expiring(?: in)?)\s+(?:the end of\s+)?(?:{MONTH})\.?\s+\d{{4}}\b(?!\s*-)"
MONTH_YEAR = rf"(?i)\b({MONTH})\.?\s+(\d{{4}})\b(?!\s*-)"
ACTED_TO = rf"(?i)\b(?:to|through|until|from|as of)\s+(?:approximately\s+|about\s+|its\s+)?{DATE}"
NUMBERS = (("one", 1), ("two", 2), ("three", 3), ("four", 4), ("six", 6), ("nine", 9), ("twelve", 12), ("eighteen", 18), ("twenty-four", 24))
_N = r"(\d{1,2}|one|two|three|four|six|nine|twelve|eighteen|twenty-four)"
TERM = rf"(?i)\b{_N}[- ](year|month)s?\b(?=[^.;]{{0,40}}\bmoratori)|\bmoratori(?:um|a)\b[^.;]{{0,30}}\bfor (?:a period of )?{_N} (year|month)s?\b"
SENTENCE = r"(?<=[.;])\s+"
EXTENDED = r"(?i)\b(extended|renewed|extends|renews|extension of|re-?adopted)\b"
CONDITIONAL = r"(?i)\b(may be|can be|could be|unless|if|or it is|would be|to be|if not)\s+(further\s+)?(extended|renewed)\b|\bunless\b[^.]*\bextended\b"
REALLY_EXTENDED = r"(?i)\b(was|were|has been|have been) (further )?(extended|renewed)\b"
TEMPORARY = r"(?i)\b(moratori(um|a)|temporar(y|ily)|pause|\d+[- ]month|one[- ]year|six[- ]month|twelve[- ]month|expires?|until (the )?(adoption|county|city|town|board))\b"
PROHIBITED = r"(?i)\b(prohibit(s|ed|ing)?|banned|bans|not (be )?(permitted|allowed)|may not be (sited|located|built|constructed)|outright ban)\b"
LABEL = r"(?i)ban\s*/\s*moratorium(\s*\([^)]*\))?|rules?:[^;]*"
DRAFTING = (
    r"(?i)\b(draft(s|ed|ing)?|develop(s|ing)?|prepar(e|es|ing)|stud(y|ies|ying)|consider(s|ing)?|reviewing|review and update|writ(e|es|ing)|work(s|ing)? on|time to (study|draft|develop|adopt|prepare|review|consider|write|update|weigh))"
    r"\b[^.;]{0,80}\b(ordinance|regulations?|standards|zoning( code)?|code|amendments?|rules)\b|\bpending (regulatory review|(the )?(adoption|completion) of)\b|\b(need|needs) to draft\b"
)
ADOPTED = (
    r"(?i)\b(adopted|enacted|approved|passed)\b[^.;]{0,60}\b(new |its |the )?(regulations?|ordinance|zoning|code|standards)\b[^.;]{0,80}\b(end(ing|ed|s)?|lift(ed|ing)?|replac(ed|ing)|superseding|official(ly)?)\b"
    r"|\b(moratorium|it) (was|were) (lifted|repealed|rescinded|replaced)\b"
)
NOTE_CHARACTERS = 240


def _blank(c: str) -> Column:
    return F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))


def _found(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _month(name: Column) -> Column:
    return F.lpad(F.array_position(F.array(*map(F.lit, MONTHS)), F.substring(F.lower(name), 1, 3)).cast("string"), 2, "0")


def iso_day(token: Column) -> Column:
    """'2026-10-14' or 'October 14, 2026' as an ISO day; null for a day that doesn't exist."""
    word = rf"(?i)^({MONTH})\.?\s+(\d{{1,2}}),?\s+(\d{{4}})$"
    spelled = F.concat_ws("-", _found(token, word, 3), _month(_found(token, word, 1)), F.lpad(_found(token, word, 2), 2, "0"))
    day = F.when(token.rlike(r"^\d{4}-\d{2}-\d{2}$"), token).when(token.rlike(word), spelled)
    return F.when(day.try_cast("date").isNotNull(), day)


def first_month(text: Column) -> Column:
    """The first month and year that a text names, as YYYY-MM."""
    year = _found(text, MONTH_YEAR, 2)
    return F.when(year.isNotNull(), F.concat_ws("-", year, _month(_found(text, MONTH_YEAR, 1))))


def _starts(partial: Column) -> Column:
    return F.when(partial.rlike(r"^\d{4}-\d{2}$"), F.concat(partial, F.lit("-01")).try_cast("date")).when(partial.rlike(r"^\d{4}-\d{2}-\d{2}$"), partial.try_cast("date"))


def _ends(partial: Column) -> Column:
    return F.when(partial.rlike(r"^\d{4}-\d{2}$"), F.last_day(_starts(partial))).otherwise(_starts(partial))


def stated_end(enacted: Column, text: Column) -> Column:
    """The end of a stated term ("a one-year moratorium") counted from the enactment, at the enactment's own precision.

    Without an enactment of at least a month the first month that the text names counts.
    """
    number = F.lower(F.coalesce(_found(text, TERM, 1), _found(text, TERM, 3)))
    unit = F.lower(F.coalesce(_found(text, TERM, 2), _found(text, TERM, 4)))
    n = F.coalesce(*(F.when(number == w, k) for w, k in NUMBERS), number.try_cast("int"))
    start = F.when(enacted.rlike(r"^\d{4}-\d{2}(-\d{2})?$"), enacted).otherwise(first_month(text))
    end = F.add_months(_starts(start), F.when(unit == "year", n * 12).otherwise(n))
    # add_months keeps the day where the month has it, and else takes the month's last
    return F.when(F.length(start) == 7, F.date_format(end, "yyyy-MM")).otherwise(F.date_format(end, "yyyy-MM-dd"))


def extensions(text: Column, enacted: Column) -> tuple[Column, Column]:
    """(described, days): whether a sentence says that the pause was extended, and the distinct days on which it was, sorted.

    Sentences are folded in order into one state. A sentence that only says it may be extended doesn't count; days that an
    extension runs to or from, and the enactment's, aren't days on which one was made.
    """

    def fold(state: Column, sentence: Column) -> Column:
        counts = sentence.rlike(EXTENDED) & (~sentence.rlike(CONDITIONAL) | sentence.rlike(REALLY_EXTENDED))
        acted = F.regexp_replace(F.regexp_replace(sentence, END, " "), ACTED_TO, " ")
        days = F.filter(F.transform(F.regexp_extract_all(acted, F.lit(rf"(?i){DATE}"), F.lit(1)), iso_day), lambda d: d.isNotNull() & ~F.coalesce(d == enacted, F.lit(False)))
        return F.when(counts, F.struct(F.lit(True).alias("described"), F.array_union(state["days"], days).alias("days"))).otherwise(state)

    start = F.struct(F.lit(False).alias("described"), F.array().cast("array<string>").alias("days"))
    state = F.aggregate(F.split(text, SENTENCE), start, fold)
    return state["described"], F.array_sort(state["days"])


def drafting(text: Column) -> tuple[Column, Column]:
    """(adopted, active or null; the sentence it rests on): the first sentence that says rules were adopted, else are drafted."""
    said = lambda p: F.get(F.filter(F.split(text, SENTENCE), lambda s: s.rlike(p)), F.lit(0))
    done, active = said(ADOPTED), said(DRAFTING)
    return F.when(done.isNotNull(), "adopted").when(active.isNotNull(), "active"), F.substring(F.trim(F.coalesce(done, active)), 1, NOTE_CHARACTERS)


def with_terms(rows: DataFrame, as_of: str) -> DataFrame:
    """``rows`` with term, ends_on, ends_on_basis, extensions, last_extended_on, months_in_force, drafting and drafting_note.

    ``rows`` has restriction_type, status, date_enacted_iso, current_end_date_iso and text, all strings that may be blank. Rows
    that aren't a pause or a ban get nulls. The end of a temporary one is that of the record; else the first "until <day>" of
    the text, else the latest "until <month>"; else, if it was never extended, the end of the stated term. Its basis says which.
    Months run from the enactment (or, by a stated term without one, the first month of the text) to ``as_of`` or an end
    before it. All of it is expressions on one row.
    """
    text, enacted, end = F.coalesce("text", F.lit("")), F.coalesce(_blank("date_enacted_iso"), F.lit("")), _blank("current_end_date_iso")
    kind, status, today = F.trim("restriction_type"), F.coalesce(F.trim("status"), F.lit("")), F.lit(as_of).cast("date")
    pause = F.coalesce(kind.isin(*PAUSES), F.lit(False))
    cues = F.regexp_replace(text, LABEL, " ")
    temporary = cues.rlike(TEMPORARY) | end.isNotNull()
    term = F.when(kind == "moratorium", "temporary").when(temporary, "temporary").when(kind == "ban", "permanent").when(cues.rlike(PROHIBITED), "permanent").otherwise("unclear")
    out = rows.withColumn("term", F.when(pause, term))
    mine = F.coalesce(F.col("term") == "temporary", F.lit(False))
    months = F.transform(F.regexp_extract_all(text, F.lit(END_MONTH), F.lit(0)), first_month)
    by_text = F.coalesce(iso_day(_found(text, END, 1)), F.array_max(months))
    described, days = extensions(text, enacted)
    out = out.withColumns({"__described": described, "__days": days, "__text_end": by_text})
    made = F.when(F.size("__days") > 0, F.size("__days")).when(F.col("__described"), 1).otherwise(0)
    made = F.when(status == "extended", F.greatest(made, F.lit(1))).otherwise(made)
    stated = F.when((made == 0) & (status != "extended"), stated_end(enacted, text))
    out = out.withColumns({"extensions": F.when(mine, made), "last_extended_on": F.when(mine, F.array_max("__days")), "ends_on": F.when(mine, F.coalesce(end, "__text_end", stated))})
    basis = F.when(end.isNotNull(), "record").when(F.col("__text_end").isNotNull(), "text").when(F.col("ends_on").isNotNull(), "term")
    out = out.withColumn("ends_on_basis", F.when(mine, basis))
    start = F.coalesce(_starts(enacted), F.when(F.col("ends_on_basis") == "term", _starts(first_month(text))))
    stop = F.least(today, F.coalesce(_ends(F.col("ends_on")), today))
    ran = (F.year(stop) - F.year(start)) * 12 + F.month(stop) - F.month(start) + (F.day(stop) - F.day(start)) / 30.4
    value, note = drafting(text)
    out = out.withColumns({"months_in_force": F.when(pause & (start <= today), F.round(F.greatest(ran, F.lit(0.0)), 1)), "drafting": F.when(mine, value), "drafting_note": F.when(mine, note)})
    return out.drop("__described", "__days", "__text_end")
