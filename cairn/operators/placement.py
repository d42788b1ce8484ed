"""Which counties a record touches, by eight methods in order; the first that answers names its method."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.scalars import squash

# Words, codes and patterns that decide where a record lies.
SPLIT = r"(?i),|;|&|\(|\)|\band\b"
SEVERAL = r"(?i),|;|&|\(|\band\b"
COUNTY_WORD = r"(?i)\b(?:counties|county|various)\b"
QUALIFIER = r"(?i)\s*\((?![^)]*\b(?:count|parish|borough))[^)]*\)"
NAMED_COUNTY = r"(?i)\b(?:county|parish)\s*$"
PREFIX = r"(?i)^(?:city|town|township|village|borough|municipality)\s+of\s+"
SUFFIX = (
    r"(?i)\s+(?:charter township|township|town|city and borough|consolidated government|unified government|metropolitan government|metro government|urban county"
    r"|city|village|borough|municipality|plantation|grant|purchase|location|gore|reservation|cdp|comunidad|zona urbana|precinct|district|unorganized territory)"
    r"(?:\s*\([^)]*\))?$"
)
CITY_COUNTIES = (("honolulu", "HI", "15003"), ("san francisco", "CA", "06075"), ("denver", "CO", "08031"), ("broomfield", "CO", "08014"), ("philadelphia", "PA", "42101"))


def county_key(name: Column) -> Column:
    """Letters and digits only, 'saint' as 'st', without a final County or Parish: 'De Witt County' and 'DeWitt' are one."""
    low = F.regexp_replace(F.regexp_replace(F.lower(F.trim(name)), r"\bsaint ", "st "), r"\bste\. ", "ste ")
    return squash(F.regexp_replace(low, r"\s+(?:county|parish)$", ""))


def town_key(name: Column) -> Column:
    """'Village of Teutopolis' and 'Teutopolis village' as 'teutopolis', 'St. Clair' as 'st clair'."""
    bare = F.lower(F.regexp_replace(F.regexp_replace(F.trim(name), PREFIX, ""), SUFFIX, ""))
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(bare, r"saint ", "st "), r"[.']", ""), r"\s+", " "))


def said_counties(text: Column) -> Column:
    """All that a text may be calling '<Name> County': the one to four words before County or Parish, as county keys."""
    before = F.regexp_extract_all(F.lower(text), F.lit(r"((?:[^\s,;:()]+\s+){1,4})(?=(?:county|parish)\b)"), F.lit(1))
    words = lambda run: F.filter(F.split(run, r"\s+"), lambda w: w != "")
    tails = lambda run: F.transform(F.sequence(F.lit(1), F.size(words(run))), lambda k: county_key(F.array_join(F.slice(words(run), -k, k), " ")))
    return F.array_distinct(F.flatten(F.transform(before, tails)))


def place_records(records: DataFrame, counties: DataFrame, towns: DataFrame, points: DataFrame, overrides: DataFrame) -> DataFrame:
    """(record_id, fips, method): an array of counties and how they were found, in this order:

    ``name`` the one county a record names, also where a town's name ends in County, or is a consolidated city-county;
    ``names`` the parts of a list of counties; ``point`` the county its coordinates lie in; ``place`` a town in one county of
    its state; ``place_text`` a town in several, of which the text names exactly one as "<Name> County"; ``place_ambiguous``
    such a town that nothing settles, left without a county; ``source_fips`` a county code that the source gives;
    ``override`` a reviewer's county, which goes before all others. Else no counties and no method.

    ``records(record_id, state, county, town, text, source_fips)``: county is null where the record isn't tied to one.
    ``counties(state, county, fips)`` may have several spellings of a county. ``towns(state, place, fips)``: place is a
    ``town_key``, with a row for each county. ``points(record_id, fips)``: counties by coordinates.
    ``overrides(record_id, fips)``. Each method is an equality join to a table of one row per key, so records aren't
    multiplied; record ids are distinct.
    """
    upper = lambda c: F.upper(F.trim(c))
    known = counties.select(upper("state").alias("st"), county_key(F.col("county")).alias("ck"), "fips").groupBy("st", "ck").agg(F.min("fips").alias("fips"))
    codes = counties.select("fips").distinct()
    at = towns.select(upper("state").alias("st"), F.col("place").alias("tk"), "fips").distinct()
    several = at.groupBy("st", "tk").agg(F.array_sort(F.collect_set("fips")).alias("hits"))
    listed = records.sparkSession.createDataFrame(CITY_COUNTIES, "tk string, st string, listed string")

    county, town = F.nullif(F.trim("county"), F.lit("")), F.nullif(F.trim("town"), F.lit(""))
    mistyped = F.when(F.col("county").isNull() & F.coalesce(town.rlike(NAMED_COUNTY), F.lit(False)), town)
    named = F.coalesce(county, mistyped)
    base = records.select("record_id", upper("state").alias("st"), named.alias("named"), F.when(mistyped.isNull(), town).alias("town"), F.coalesce("text", F.lit("")).alias("text"), F.trim("source_fips").alias("code"))
    bare = F.trim(F.regexp_replace("named", QUALIFIER, ""))
    base = base.withColumn("ck", F.when(~bare.rlike(SEVERAL), county_key(bare))).withColumn("tk", town_key(F.col("town")))

    one = base.join(known.withColumnRenamed("fips", "by_name"), ["st", "ck"], "left")
    # a city with the county's name under one government: listed, or said to be "City and County of <Name>"
    city = base.where("tk IS NOT NULL").select("record_id", "st", "tk", F.lower(F.concat_ws(" ", "town", "text")).alias("said"), county_key(F.col("tk")).alias("ck"))
    spoken = F.regexp_replace("said", r"\s+", " ")
    whole = lambda before, after: F.instr(F.concat(F.lit(" "), F.regexp_replace(spoken, "[^a-z0-9 ]+", " "), F.lit(" ")), F.concat(F.lit(before), F.regexp_replace("tk", "[^a-z0-9 ]+", " "), F.lit(after))) > 0
    joint = city.join(known, ["st", "ck"]).join(at, ["st", "tk", "fips"], "left_semi").where(whole(" city and county of ", " ") | whole(" ", " city and county "))
    cities = city.join(F.broadcast(listed), ["st", "tk"], "left").join(joint.select("record_id", "fips"), "record_id", "left").select("record_id", F.coalesce("listed", "fips").alias("by_city")).where("by_city IS NOT NULL")

    listing = F.when(F.col("named").rlike(r"(?i)^\s*various\b"), F.col("named")).otherwise(bare)
    parts = base.select("record_id", "st", F.posexplode(F.split(listing, SPLIT)).alias("at", "part"))
    parts = parts.select("record_id", "st", "at", county_key(F.regexp_replace("part", COUNTY_WORD, "")).alias("ck")).join(known, ["st", "ck"])
    first = parts.groupBy("record_id", "fips").agg(F.min("at").alias("at"))
    lists = first.groupBy("record_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "fips"))), lambda s: s["fips"]).alias("by_names"))

    spots = points.groupBy("record_id").agg(F.min("fips").alias("by_point"))
    settled = overrides.groupBy("record_id").agg(F.array_sort(F.collect_set("fips")).alias("by_override"))
    text_keys = base.where("tk IS NOT NULL").join(several.where("size(hits) > 1"), ["st", "tk"]).select("record_id", "st", F.explode(said_counties(F.col("text"))).alias("ck"), "hits")
    told = text_keys.join(known, ["st", "ck"]).where(F.array_contains("hits", F.col("fips"))).groupBy("record_id").agg(F.collect_set("fips").alias("told"))

    out = one.join(cities, "record_id", "left").join(lists, "record_id", "left").join(spots, "record_id", "left").join(several, ["st", "tk"], "left").join(told, "record_id", "left").join(settled, "record_id", "left")
    out = out.join(codes.select(F.col("fips").alias("code"), F.lit(True).alias("code_known")), "code", "left")
    hits, code = F.coalesce(F.size("hits"), F.lit(0)), F.coalesce("code_known", F.lit(False))
    methods = [
        ("override", F.col("by_override").isNotNull(), F.col("by_override")),
        ("name", F.coalesce("by_name", "by_city").isNotNull(), F.array(F.coalesce("by_name", "by_city"))),
        ("names", F.col("by_names").isNotNull(), F.col("by_names")),
        ("point", F.col("by_point").isNotNull(), F.array("by_point")),
        ("place", hits == 1, F.col("hits")),
        ("place_text", (hits > 1) & (F.size("told") == 1), F.col("told")),
        ("place_ambiguous", (hits > 1) & ~code, F.array().cast("array<string>")),
        ("source_fips", code, F.array("code")),
    ]
    fips, method = F.lit(None).cast("array<string>"), F.lit(None).cast("string")
    for name, answers, value in reversed(methods):
        fips, method = F.when(answers, value).otherwise(fips), F.when(answers, name).otherwise(method)
    return out.select("record_id", F.coalesce(fips, F.array().cast("array<string>")).alias("fips"), method.alias("method"))


def placed_by_coordinates(records: DataFrame, edges: DataFrame, cell: float) -> DataFrame:
    """points(record_id, fips) for ``place_records``: records(record_id, longitude, latitude) in polygons of edges(id, …)."""
    from cairn.operators.places import points_in_polygons

    return points_in_polygons(records.select(F.col("record_id").alias("point_id"), F.col("longitude").cast("double").alias("px"), F.col("latitude").cast("double").alias("py")), edges, cell).select(F.col("point_id").alias("record_id"), F.col("id").cast("string").alias("fips"))


# Windows and the number of neighbours that make a cluster.
WINDOW_MONTHS, CLUSTER = 18, 3


def diffusion(instruments: DataFrame, edges: DataFrame, unresolved: DataFrame, as_of: str, nodes: DataFrame, *, months: int = WINDOW_MONTHS, cluster: int = CLUSTER) -> DataFrame:
    """(node, neighbours, recent, newest, unresolved, tier): what the counties next to each node have on record.

    ``instruments(instrument_id, node, enacted)``: a row for each county of an instrument, enacted a date or null.
    ``edges(a, b)``: neighbours, both ways. ``unresolved(node)``: nodes with a pending or unverified record of their own.
    A neighbour counts if it has an instrument that the node itself doesn't share, and is recent if one of those was
    enacted within ``months`` before ``as_of``. Tier 1: a recent neighbour, and something unresolved here; 2: ``cluster``
    neighbours or more; 3: a recent neighbour; 4: any neighbour; 0: none. Each row of ``nodes(node)`` gives one row.

    The frontier is one step: instruments meet the neighbours of their counties by equality, and those that also stand in the
    node itself are taken out by an anti-join on (instrument, node).
    """
    own = instruments.select("instrument_id", "node").distinct()
    dated = instruments.groupBy("instrument_id", "node").agg(F.max(F.col("enacted").cast("date")).alias("enacted"))
    seen = edges.select("a", "b").where("a <> b").distinct().join(dated.withColumnRenamed("node", "b"), "b")
    theirs = seen.join(own.withColumnRenamed("node", "a"), ["instrument_id", "a"], "left_anti")
    since = F.add_months(F.lit(as_of).cast("date"), -months)
    each = theirs.groupBy("a", "b").agg(F.max("enacted").alias("newest"))
    around = each.groupBy("a").agg(F.count("*").alias("neighbours"), F.count_if(F.col("newest") >= since).alias("recent"), F.max("newest").alias("newest"))
    here = nodes.select("node").distinct().join(around.withColumnRenamed("a", "node"), "node", "left").join(unresolved.select("node", F.lit(True).alias("open")).distinct(), "node", "left")
    n, fresh, open_ = F.coalesce("neighbours", F.lit(0)), F.coalesce("recent", F.lit(0)), F.coalesce("open", F.lit(False))
    tier = F.when((fresh > 0) & open_, 1).when(n >= cluster, 2).when(fresh > 0, 3).when(n > 0, 4).otherwise(0)
    return here.select("node", n.alias("neighbours"), fresh.alias("recent"), "newest", open_.alias("unresolved"), tier.alias("tier"))
