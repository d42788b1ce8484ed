"""Scalar rules as Column expressions: blanks, lists, partial dates, keys, URLs, numbers in text.

Everything here runs inside the JVM; nothing is a Python UDF. ``as_of`` is always a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
TRACKING = ("fbclid", "gclid", "mc_cid", "mc_eid", "ref")


def blank_to_null(s: Column) -> Column:
    """A blank or white cell is missing."""
    return F.nullif(F.trim(F.coalesce(s, F.lit(""))), F.lit(""))


def split_list(s: Column, sep: str = ";") -> Column:
    """cells that hold lists; parts are trimmed and blank ones dropped."""
    return F.filter(F.transform(F.split(F.coalesce(s, F.lit("")), sep), lambda x: F.trim(x)), lambda x: x != "")


def strict_date(s: Column) -> Column:
    """A DATE only from a full ISO date; a year or a month alone is NULL, never its first day."""
    return F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), s.try_cast("date"))


def rounded_int(s: Column) -> Column:
    return F.round(s.try_cast("double")).cast("int")


def tri_state(s: Column) -> Column:
    """yes/no text to a boolean, anything else NULL."""
    low = F.lower(F.trim(s))
    return F.when(low.isin("true", "yes"), True).when(low.isin("false", "no"), False)


def latest_day(s: Column) -> Column:
    """the last day a partial ISO date can mean."""
    return F.when(s.rlike(r"^\d{4}$"), F.concat(s, F.lit("-12-31")).try_cast("date")).when(s.rlike(r"^\d{4}-\d{2}$"), F.last_day(F.concat(s, F.lit("-01")).try_cast("date"))).otherwise(strict_date(s))


def not_after(s: Column, as_of: Column) -> Column:
    """a partial date compares with a day at its own precision."""
    return s <= F.substring(as_of.cast("string"), F.lit(1), F.length(s))


def months_before(day: Column, n: int) -> Column:
    """clamps to the end of a shorter month."""
    return F.add_months(day, -n)


def months_between_days(start: Column, end: Column) -> Column:
    """months plus days/30.4, one decimal."""
    months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    return F.round(months + (F.dayofmonth(end) - F.dayofmonth(start)) / 30.4, 1)


def text_dates(s: Column) -> Column:
    """F8: all dates a text names, 'June 2023' and ISO forms, as partial ISO strings."""
    iso = F.regexp_extract_all(s, F.lit(r"\b((?:19|20)\d{2}-\d{2}(?:-\d{2})?)\b"), F.lit(1))
    named = F.regexp_extract_all(F.lower(s), F.lit(r"\b((?:" + "|".join(MONTHS) + r")\s+(?:19|20)\d{2})\b"), F.lit(1))
    number = lambda m: F.lpad(F.array_position(F.array(*map(F.lit, MONTHS)), F.regexp_extract(m, r"^[a-z]+", 0)).cast("string"), 2, "0")
    return F.concat(iso, F.transform(named, lambda m: F.concat_ws("-", F.regexp_extract(m, r"\d{4}$", 0), number(m))))


def latest_text_date(s: Column) -> Column:
    return F.array_max(text_dates(s))


def normalize_url(url: Column) -> Column:
    """lower-case scheme and host, no fragment, no trailing slash; the query stays."""
    bare = F.regexp_replace(url, r"#.*$", "")
    head = F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)", 1)
    rest = F.substring(bare, F.length(head) + 1, F.length(bare))
    path, query = F.regexp_extract(rest, r"^([^?]*)", 1), F.regexp_extract(rest, r"(\?.*)$", 1)
    return F.concat(F.lower(head), F.regexp_replace(path, r"/+$", ""), query)


def strip_tracking(url: Column) -> Column:
    """the query without tracking parameters."""
    base, query = F.regexp_extract(url, r"^([^?]*)", 1), F.regexp_extract(url, r"\?(.*)$", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(utm_[^=]*|" + "|".join(TRACKING) + r")(=|$)"))
    return F.concat(base, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def url_key(url: Column) -> Column:
    """what two spellings of one address share."""
    return F.regexp_replace(strip_tracking(normalize_url(url)), r"^https?://(www\.)?", "http://")


#: Characters of a long text that are looked at for its headline, fewest first; a text in which they don't hold enough words is read whole.
HEADS = (1000, 16000)


def headline_key(s: Column, n: int = 200) -> Column:
    """F16: the lower-case words of a text, joined by a space and cut to ``n`` characters.

    Long texts are read from the front only as far as needed: what stands before the last word of a head is as in the whole.
    """
    words = lambda t: F.regexp_extract_all(F.lower(t), F.lit("[a-z0-9]+"), F.lit(0))
    out = F.array_join(words(s), " ")
    for size in reversed(HEADS):
        head = words(F.substring(s, 1, size))
        before = F.array_join(F.slice(head, 1, F.greatest(F.size(head) - 1, F.lit(0))), " ")
        out = F.when((F.length(s) > size) & (F.length(before) >= n), before).otherwise(out)
    return F.substring(out, 1, n)


def squash(s: Column) -> Column:
    """letters and digits only."""
    return F.regexp_replace(F.lower(s), "[^a-z0-9]", "")


def place_key(name: Column) -> Column:
    """a place name without its kind, 'saint' as 'st'."""
    low = F.regexp_replace(F.lower(F.trim(name)), r"\s+(county|parish|borough|township|city|town|village)$", "")
    return squash(F.regexp_replace(F.regexp_replace(low, r"^(county|city|town|village) of\s+", ""), r"\bsaint\b", "st"))


def name_core(name: Column, noise: tuple[str, ...]) -> Column:
    """the distinct words of a name minus noise words, sorted."""
    words = F.filter(F.split(F.lower(name), "[^a-z0-9]+"), lambda w: w != "")
    return F.array_sort(F.array_except(F.array_distinct(words), F.array(*map(F.lit, noise))))


def known_tokens(s: Column, order: tuple[str, ...]) -> Column:
    """the known tokens of a list cell in canonical order."""
    return F.array_intersect(F.array(*map(F.lit, order)), split_list(F.lower(s)))


def keyword_tags(s: Column, table: dict[str, str]) -> Column:
    """the names of the patterns a text matches, sorted."""
    return F.array_compact(F.array(*(F.when(F.lower(s).rlike(p), F.lit(n)) for n, p in sorted(table.items()))))


def sentences(s: Column) -> Column:
    """F25."""
    return F.filter(F.split(s, r"(?<=[.;])\s+"), lambda x: x != "")


def first_number(s: Column) -> Column:
    """F3."""
    return F.nullif(F.regexp_extract(s, r"\d+(?:\.\d+)?", 0), F.lit("")).try_cast("double")


def capacity(s: Column) -> tuple[Column, Column]:
    """low and high MW of the first amount in a text; kW and GW are scaled, other units refused."""
    pattern = r"(\d+(?:\.\d+)?)(?:\s*(?:-|to)\s*(\d+(?:\.\d+)?))?\s*(kw|mw|gw)\b"
    low = F.lower(s)
    unit = F.regexp_extract(low, pattern, 3)
    scale = F.when(unit == "kw", 0.001).when(unit == "mw", 1.0).when(unit == "gw", 1000.0)
    first = F.regexp_extract(low, pattern, 1).try_cast("double")
    second = F.coalesce(F.regexp_extract(low, pattern, 2).try_cast("double"), first)
    return F.least(first, second) * scale, F.greatest(first, second) * scale


def capacities(s: Column) -> Column:
    """all amounts of a text as (low, high) in MW; a text in other units has none, a number without a unit is in MW."""
    low = F.regexp_replace(F.lower(F.coalesce(s, F.lit(""))), ",", "")
    group = lambda k: F.regexp_extract_all(low, F.lit(r"(\d*\.?\d+)(?:\s*(?:-|to|–)\s*(\d*\.?\d+))?\s*(gw|mw|kw)?"), F.lit(k))

    def amount(z: Column) -> Column:
        scale = F.when(z["u"] == "gw", 1000.0).when(z["u"] == "kw", 0.001).otherwise(1.0)
        first = z["a"].try_cast("double")
        return F.struct((first * scale).alias("low"), (F.coalesce(F.nullif(z["b"], F.lit("")).try_cast("double"), first) * scale).alias("high"))

    found = F.filter(F.transform(F.arrays_zip(group(1).alias("a"), group(2).alias("b"), group(3).alias("u")), amount), lambda r: r["low"] > 0)
    return F.when(low.rlike("turbine|acre|home|panel|household|module|mwh"), F.filter(found, lambda _: F.lit(False))).otherwise(found)


def capacity_agrees(s: Column, mw: Column) -> Column:
    """whether a size lies within a fifth of some amount of the text; false without either."""
    return F.coalesce(F.exists(capacities(s), lambda r: (r["low"] * 0.8 <= mw) & (mw <= r["high"] * 1.2)), F.lit(False))


def capacity_differs(s: Column, mw: Column) -> Column:
    """whether a size is under a third or over three times every amount of the text; false without either."""
    given = capacities(s)
    return F.coalesce((F.size(given) > 0) & ~F.exists(given, lambda r: (r["low"] / 3 <= mw) & (mw <= r["high"] * 3)), F.lit(False))


def largest_feet(s: Column) -> Column:
    """the largest number of feet a text names."""
    return F.array_max(F.transform(F.regexp_extract_all(F.regexp_replace(F.lower(s), ",", ""), F.lit(r"(\d+(?:\.\d+)?)\s*(?:feet|foot|ft)\b"), F.lit(1)), lambda x: x.cast("double")))


def jaccard(a: Column, b: Column) -> Column:
    """F28; two empty sets have none."""
    return F.size(F.array_intersect(a, b)) / F.nullif(F.size(F.array_union(a, b)), F.lit(0))


def stable_id(prefix: str, *parts: Column, length: int = 10) -> Column:
    """a prefix and the head of a SHA-1 over parts joined by '|'."""
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.concat_ws("|", *parts)), 1, length))


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """F31, on a sphere of 7917.6 miles across."""
    r = F.radians
    half = F.pow(F.sin((r(lat2) - r(lat1)) / 2), 2) + F.cos(r(lat1)) * F.cos(r(lat2)) * F.pow(F.sin((r(lon2) - r(lon1)) / 2), 2)
    return F.lit(7917.6) * F.asin(F.sqrt(half))


def transform_number(x: Column, kind: str) -> Column:
    """identity, log1p of non-negative, log10 of positive numbers, six decimals."""
    out = {"identity": x, "log1p": F.when(x >= 0, F.log1p(x)), "log10": F.when(x > 0, F.log10(x))}[kind]
    return F.round(out, 6)


def level_index(x: Column, levels: tuple[str, ...]) -> Column:
    """position from 0 in a list of levels, else NULL."""
    return F.nullif(F.array_position(F.array(*map(F.lit, levels)), x), F.lit(0)) - 1


def padded_key(x: Column, width: int) -> Column:
    """digits padded to a width; a float's '.0' goes; anything else is NULL."""
    s = F.regexp_replace(F.trim(x.cast("string")), r"\.0$", "")
    return F.when(s.rlike(rf"^\d{{1,{width}}}$"), F.lpad(s, width, "0"))


def map_value(s: Column, key: Column) -> Column:
    """one value of a 'k:v;k:v' cell."""
    return F.try_element_at(F.str_to_map(s, F.lit(";"), F.lit(":")), key).try_cast("double")


def plain_dashes(s: Column) -> Column:
    """all dashes as hyphens, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(s, "[‐-―−]", "-"), r"\s+", " "))


def strip_tags(s: Column) -> Column:
    """F42."""
    return F.trim(F.regexp_replace(F.regexp_replace(s, "<[^>]+>", " "), r"\s+", " "))


def in_box(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> Column:
    """Inside a box (south, west, north, east); NULL without coordinates, (0, 0) counting as none."""
    known = lat.isNotNull() & lon.isNotNull() & ~((lat == 0) & (lon == 0))
    return F.when(known, lat.between(box[0], box[2]) & lon.between(box[1], box[3]))


#: Rules that SQL text may call.
SQL_FUNCTIONS = (
    "split_list(s STRING) RETURNS ARRAY<STRING> RETURN filter(transform(split(coalesce(s, ''), ';'), x -> trim(x)), x -> x <> '')",
    "blank_to_null(s STRING) RETURNS STRING RETURN nullif(trim(coalesce(s, '')), '')",
    "strict_date(s STRING) RETURNS DATE RETURN CASE WHEN s RLIKE '^[0-9]{4}-[0-9]{2}-[0-9]{2}$' THEN try_cast(s AS DATE) END",
    "nullif_blank(s STRING) RETURNS STRING RETURN nullif(trim(coalesce(s, '')), '')",
    r"reader_text(s STRING) RETURNS STRING RETURN nullif(trim(coalesce(regexp_replace(s, '\\s*\\[VERIFY\\b[^\\]]*\\]', ''), '')), '')",
    "source_family(iid STRING, edition STRING) RETURNS STRING RETURN CASE WHEN iid LIKE 'sabin:%' THEN CASE WHEN edition = '2025-06' THEN 'Sabin 2025 (not in 2026 edition)' ELSE 'Sabin 2026' END "
    "WHEN iid LIKE 'nrel:%' THEN 'NREL' WHEN iid LIKE 'mn:%' THEN 'Moratorium Nation' WHEN iid LIKE 'queue:%' THEN 'review queue' ELSE 'other' END",
    "verification_rank(v STRING) RETURNS INT RETURN CASE coalesce(v, '') WHEN 'verified' THEN 0 WHEN 'located' THEN 1 ELSE 2 END",
    "verification_name(r INT) RETURNS STRING RETURN CASE r WHEN 0 THEN 'verified' WHEN 1 THEN 'located' ELSE 'unverified' END",
    "squash(s STRING) RETURNS STRING RETURN regexp_replace(lower(s), '[^a-z0-9]', '')",
)


def register_sql_functions(spark: SparkSession) -> None:
    for text in SQL_FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {text}")


def month_span(start: Column, end: Column) -> tuple[Column, Column]:
    """the fewest and most days between two partial dates; at least one."""
    first = lambda s: F.concat(s, F.substring(F.lit("-01-01"), F.length(s) - 3, F.lit(6))).try_cast("date")
    low = F.datediff(first(end), latest_day(start))
    high = F.datediff(latest_day(end), first(start))
    return F.greatest(low, F.lit(1)), F.greatest(high, F.lit(1))


def group_key(name: Column) -> Column:
    """an organisation's name without its article, legal form, lead-in and marks."""
    low = F.regexp_replace(F.lower(F.trim(name)), r"[.,'’\"()]", "")
    low = F.regexp_replace(low, r"^(the|citizens for|friends of)\s+", "")
    return F.trim(F.regexp_replace(F.regexp_replace(low, r"\s+(inc|llc|ltd|corp)$", ""), r"\s+", " "))


def decision_words(s: Column) -> Column:
    """the words of a decision a text uses, sorted; none if it says the decision isn't final."""
    found = F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(s), F.lit(r"\b(approved|denied|rejected|withdrawn|granted)\b"), F.lit(1))))
    return F.when(F.lower(s).rlike(r"\b(pending|tabled|postponed|recommended)\b"), F.array().cast("array<string>")).otherwise(found)


def bill_number(s: Column) -> Column:
    """a bill's chamber and number, 'HB 12' for 'H.B. 0012'."""
    pattern = r"\b([HS])\.?\s?([BRJ])\.?\s*0*(\d{1,5})\b"
    return F.when(s.rlike(pattern), F.concat(F.regexp_extract(s, pattern, 1), F.regexp_extract(s, pattern, 2), F.lit(" "), F.regexp_extract(s, pattern, 3)))


def dollars(mw: Column, per_mw: tuple[float, float], rate: float, years: Column) -> tuple[Column, Column]:
    """an amount range per MW escalated over some years."""
    grown = lambda v: F.round(mw * v * F.pow(F.lit(1 + rate), years), 2)
    return grown(per_mw[0]), grown(per_mw[1])


def plain_json(row: Column) -> Column:
    """a struct as JSON, dates in ISO form, null fields left out."""
    return F.to_json(row, {"ignoreNullFields": "true", "dateFormat": "yyyy-MM-dd"})


def bin_for(x: Column, bins: tuple[tuple[float, float, str], ...]) -> Column:
    """The first bin that holds a number."""
    out = F.lit(None).cast("string")
    for low, high, name in reversed(bins):
        out = F.when(x.between(low, high), F.lit(name)).otherwise(out)
    return out


def all_equal(wanted: dict[str, str]) -> Column:
    """A condition from a configuration's column -> value pairs."""
    out = F.lit(True)
    for c, v in wanted.items():
        out = out & (F.col(c) == v)
    return out
