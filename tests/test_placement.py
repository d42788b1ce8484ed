"""The placement cascade method by method, names in text, and diffusion."""

from pyspark.sql import functions as F

from cairn.operators import placement as P
from cairn.operators.places import locate_names, named_spans

COUNTIES = [("TX", "Travis", "48453"), ("TX", "Travis County", "48453"), ("TX", "De Witt", "48123"), ("TX", "Oak", "48001"), ("TX", "Saint Clair", "48002"), ("HI", "Honolulu", "15003"), ("LA", "Orleans", "22071"), ("LA", "Oak", "22001"), ("TX", "Fair and Square", "48009")]
TOWNS = [("TX", "round rock", "48453"), ("TX", "springfield", "48001"), ("TX", "springfield", "48123"), ("LA", "orleans", "22071"), ("LA", "oak", "22071"), ("TX", "st jo", "48002")]


def place(spark, **given):
    fields = {"state": "TX", "county": None, "town": None, "text": None, "source_fips": None} | given
    records = spark.createDataFrame([(1, *(fields[c] for c in ("state", "county", "town", "text", "source_fips")))], "record_id int, state string, county string, town string, text string, source_fips string")
    counties, towns = spark.createDataFrame(COUNTIES, "state string, county string, fips string"), spark.createDataFrame(TOWNS, "state string, place string, fips string")
    points = spark.createDataFrame([(1, fields["point"])] if "point" in given else [], "record_id int, fips string")
    overrides = spark.createDataFrame([(1, fields["override"])] if "override" in given else [], "record_id int, fips string")
    (r,) = P.place_records(records, counties, towns, points, overrides).collect()
    return r.fips, r.method


def test_each_method(spark):
    cases = [
        ({"county": "travis"}, (["48453"], "name")),
        ({"county": "DeWitt County"}, (["48123"], "name")),
        ({"county": "St Clair (solar and battery storage)"}, (["48002"], "name")),
        ({"town": "Travis County", "county": None}, (["48453"], "name")),
        ({"town": "Honolulu", "state": "hi"}, (["15003"], "name")),
        ({"town": "Orleans", "state": "LA", "text": "the city  and county of Orleans"}, (["22071"], "name")),
        ({"town": "Oak", "state": "LA", "text": "city and county of oak"}, (["22071"], "place")),  # the place lies in another county
        ({"county": "Travis, Oak; Nowhere and Travis counties"}, (["48453", "48001"], "names")),
        ({"county": "Various (Oak, De Witt)"}, (["48001", "48123"], "names")),
        ({"county": "Travis (parts of Oak County)"}, (["48453"], "names")),
        ({"county": "Atlantis", "point": "48001"}, (["48001"], "point")),
        ({"town": "City of Round Rock"}, (["48453"], "place")),
        ({"town": "Saint Jo village"}, (["48002"], "place")),
        ({"town": "Springfield township", "text": "in De Witt County, near Travis County"}, (["48123"], "place_text")),
        ({"town": "Springfield", "text": "of Oak County and De Witt parish"}, ([], "place_ambiguous")),
        ({"town": "Springfield", "text": "Live Oak lies elsewhere"}, ([], "place_ambiguous")),
        ({"town": "Springfield", "source_fips": "48001"}, (["48001"], "source_fips")),
        ({"town": "Springfield", "source_fips": "99999"}, ([], "place_ambiguous")),
        ({"town": "Nowhere", "source_fips": "22071"}, (["22071"], "source_fips")),
        ({"town": "Nowhere"}, ([], None)),
        ({"county": " "}, ([], None)),
        ({"county": "Travis", "override": "48001"}, (["48001"], "override")),
    ]
    for given, wanted in cases:
        assert place(spark, **given) == wanted, given


def test_longest_names_from_left_to_right(spark):
    names = spark.createDataFrame([("York", 1), ("New York", 2), ("New York City", 3), ("City Hall", 4), ("Hall", 5), ("york", 6), ("Hall of New York", 7), ("a b c d", 8)], "name string, place_id int")
    texts = spark.createDataFrame([(1, "New York City Hall"), (2, "new york, city hall"), (3, "York; Hall"), (4, "old new"), (5, None), (6, "new york hall of new york city"), (7, "a b c d")], "text_id int, text string")
    got = sorted((r.text_id, r.start, r.words, r.places, r.place_id) for r in named_spans(texts, names, 3).collect())
    assert got == [(1, 0, 3, 1, 3), (1, 3, 1, 1, 5), (2, 0, 3, 1, 3), (2, 3, 1, 1, 5), (3, 0, 1, 2, 1), (3, 1, 1, 1, 5), (6, 0, 2, 1, 2), (6, 2, 1, 1, 5), (6, 4, 3, 1, 3)]
    far = sorted((r.text_id, r.start, r.words) for r in named_spans(texts, names, 4).where("text_id IN (6, 7)").collect())
    assert far == [(6, 0, 2), (6, 2, 4), (7, 0, 4)]
    verdicts = {r.text_id: (r.place_id, r.verdict) for r in locate_names(texts, names, longest=3, roundup=3).collect()}
    assert verdicts == {1: (None, "several"), 2: (None, "several"), 3: (5, "placed"), 4: (None, "none"), 5: (None, "none"), 6: (None, "roundup"), 7: (None, "none")}


def test_tiers(spark):
    edges = [(a, b) for x, y in ((1, 2), (1, 3), (1, 4), (5, 6), (7, 8), (9, 10), (11, 12)) for a, b in ((x, y), (y, x))]
    instruments = [("i2", 2, "2020-01-01"), ("i3", 3, None), ("i4", 4, "2019-01-01"), ("i6", 6, "2024-01-01"), ("i8", 8, "2023-01-01"), ("s", 9, "2024-01-01"), ("s", 10, "2024-01-01"), ("i12", 12, "2010-01-01"), ("i12", 12, "2010-02-01")]
    frame = spark.createDataFrame(instruments, "instrument_id string, node int, enacted string")
    nodes = spark.createDataFrame([(k,) for k in (1, 5, 7, 9, 11, 12, 99)], "node int")
    got = P.diffusion(frame, spark.createDataFrame(edges, "a int, b int"), spark.createDataFrame([(5,), (1,)], "node int"), "2024-06-30", nodes)
    assert {r.node: (r.neighbours, r.recent, r.tier) for r in got.collect()} == {1: (3, 0, 2), 5: (1, 1, 1), 7: (1, 1, 3), 9: (0, 0, 0), 11: (1, 0, 4), 12: (0, 0, 0), 99: (0, 0, 0)}
    assert {str(r.newest) for r in got.where(F.col("node") == 11).collect()} == {"2010-02-01"}
