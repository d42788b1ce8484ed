from difflib import SequenceMatcher

from pyspark.sql import functions as F

from cairn.operators import rules as R
from cairn.operators.scoring import morans_p


def test_toggled_puts_blanks_last_either_way(spark):
    df = spark.createDataFrame([("b",), (" ",), ("a",), (None,)], "s string")
    assert [r.s for r in R.toggled(df, "s").collect()][:2] == ["a", "b"]
    assert [r.s for r in R.toggled(df, "s", descending=True).collect()][:2] == ["b", "a"]


def test_nearest_first_keeps_the_nearest(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else float(i)) for i in range(30)], "id int, miles double")
    assert [r.id for r in R.nearest_first(df, "miles", "id", cap=3).collect()] == [1, 2, 4]
    assert R.nearest_first(df, "miles", "id", cap=25).collect()[-1].miles is None


def test_spelling_is_the_ratio_of_matching_blocks(spark):
    pairs = [("garrison buje", "garrison butte"), ("atlandc shores", "atlantic shores"), ("", ""), (None, "x")]
    got = [r.s for r in spark.createDataFrame(pairs, "a string, b string").select(R.spelling("a", "b").alias("s")).collect()]
    assert got[:3] == [SequenceMatcher(None, *p).ratio() for p in pairs[:3]] and got[3] is None


def test_rules_take_empty_tables_and_missing_columns(spark):
    none = spark.createDataFrame([], "id string, outcome string")
    assert R.qc_findings(none, "contested_projects", "2026-01-01").count() == R.withheld(none, "2026-01-01").count() == 0
    bare = spark.createDataFrame([("x",)], "id string")
    assert [i.field for i in R.qc_findings(bare, "contested_projects", "2026-01-01").first().issues] == ["outcome"]
    assert R.withheld(bare, "2026-01-01").first().withheld_reason == "technology_not_priced"


def test_morans_p_is_small_for_a_gradient_and_not_for_noise(spark):
    line = spark.range(40).select(F.col("id").cast("int").alias("k"), F.col("id").cast("double").alias("x"), F.pmod(F.xxhash64("id"), F.lit(97)).cast("double").alias("y"))
    edges = spark.range(39).select(F.col("id").cast("int").alias("a"), (F.col("id") + 1).cast("int").alias("b"))
    edges = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    steep, noise = (morans_p(line, edges, "k", c, permutations=99).first() for c in ("x", "y"))
    assert steep.morans_i > 0.8 and steep.p == 0.01 and noise.p > 0.05 and steep.n == 40
    assert abs(steep.expected + 1 / 39) < 1e-12


RECORDS = [
    ("r1", "TX", 31.0, -97.0, "https://a.org/x", "active", "2024-05-01", "2024-12", "", 3, "", "", "renewables_only"),
    ("r2", "TX", 45.0, -97.0, "ftp://a.org/x", "active", "2026-07", "2027", "", 3, "", "", "data_center_only"),
    ("r3", "NV", 45.0, -97.0, "", "pending", "05/01/2024", "", "", 3, "contradicts", "snippet", "renewables_only"),
    ("r4", "TX", 0.0, 0.0, "http://localhost", "gone", "2026", "2026", "", 1, "contradicts", "opened", "renewables_only"),
    ("r5", "TX", None, None, "http://b.gov/y", "extended", "2026-06-30", "2025-12", "2026-01-15", None, "confirmed", "", "all"),
    ("r6", None, 31.0, -97.0, None, "unknown", None, None, None, None, None, None, "renewables_only"),
]
FOUND = {
    "r1": ["END_DATE_PASSED:MEDIUM"],
    "r2": ["COORD_OUTSIDE_STATE:HIGH", "SOURCE_URL_INVALID:HIGH", "DATE_IN_FUTURE:HIGH", "SCOPE_DATA_CENTER_ONLY:HIGH"],
    "r3": ["DATE_UNPARSEABLE:LOW", "SEVERITY_STATUS:MEDIUM", "PRIMARY_SOURCE_CONTRADICTS:MEDIUM"],
    "r4": ["SOURCE_URL_INVALID:HIGH", "STATUS_VOCAB:HIGH", "PRIMARY_SOURCE_CONTRADICTS:HIGH"],
    "r5": ["STATUS_VOCAB:HIGH"],
    "r6": [],
}


def test_quality_codes_record_by_record(spark):
    """As of 2026-06-30; r4's end year isn't over, r5's end was confirmed afterwards, r3's state has no box."""
    names = "id string, state string, latitude double, longitude double, source_url string, status string, date_enacted_iso string, current_end_date_iso string, status_checked_on string, severity_score int, primary_source_verdict string, primary_source_access string, scope string, __box int"
    boxes = spark.createDataFrame([("TX", 25.8, -106.7, 36.5, -93.5)], "state string, south double, west double, north double, east double")
    got = R.qc_findings(spark.createDataFrame([(*r, 1) for r in RECORDS], names), "restrictions", "2026-06-30", boxes)
    assert got.columns[-3:] == ["__box", "issues", "blocked"]
    assert {r.id: [f"{i.code}:{i.severity}" for i in r.issues] for r in got.collect()} == FOUND
    assert {r.id for r in got.where("blocked").collect()} == {"r2", "r4", "r5"}


def test_spans_and_reasons_project_by_project(spark):
    rows = [
        ("a", "solar", "blocked_confirmed", "2024-01-10", "2024-03", "10", "", "", ""),
        ("b", "hydro", "pending", "2024-01-10", "", "10", "", "", ""),
        ("i", "wind", "pending", "2024", "", "10", "2023-05-05", "possible", ""),
        ("j", "wind", "pending", "2024-01", "", "10", "2023-05-05", "strong", "withdrawn"),
        ("l", "wind", "advanced_confirmed", "2024-02-30", "2024-01-10", "10", "2024-02", "strong", ""),
        ("o", "battery_storage", "pending", "2024-02", "", "", "2023-11", "strong", ""),
    ]
    df = spark.createDataFrame(rows, "id string, technology string, outcome string, event_date_text string, resolution_date string, capacity_mw string, first_request_date string, match string, conflict string").withColumn("queue_capacity_mw", F.lit("42.5"))
    got = {r.id: (r.start_source, r.span_days, r.span_days_low, r.span_days_high, r.mw, r.withheld_reason) for r in R.withheld(df, "2024-06-30").collect()}
    assert got == {
        "a": ("event_date", 51, 51, 81, 10.0, None),
        "b": ("event_date", 172, 172, 172, 10.0, "technology_not_priced"),
        "i": (None, None, 1, None, 10.0, "start_from_possible_queue_match"),
        "j": ("queue_request", 422, 422, 422, 10.0, "queue_match_conflict"),
        "l": ("queue_request", -22, 1, -22, 10.0, "nonpositive_span"),
        "o": ("queue_request", 242, 213, 242, 42.5, None),
    }


def test_distances_and_names_in_hand_made_texts(spark):
    texts = ["Setback of 1,500 feet or one-half mile, 1.1 times the total tip height; 55 dBA by day and 45 dBA at night", "1,200 ft from another solar facility, 500 ft from homes", "300 feet between the facility and any residence", None]
    s = spark.createDataFrame([(t,) for t in texts], "s string").select(R.setback_feet(F.col("s")), R.height_multiple(F.col("s")), R.least_decibels(F.col("s")))
    assert [tuple(r) for r in s.collect()] == [(2640.0, 1.1, 45.0), (500.0, 0.0, 0.0), (300.0, 0.0, 0.0), (0.0, 0.0, 0.0)]
    names = spark.createDataFrame([("Blue Ridge Wind Farm", "Ridge Blue Solar LLC"), ("Garrison Buje", "Garrison Bute"), ("Prairie", "Ocean"), (None, "Ocean")], "a string, b string")
    assert [(round(r.score, 6) if r.score else None, r.basis) for r in R.name_scores(names, "a", "b").collect()] == [(1.0, "name"), (0.923077, "spelling"), (None, None), (None, None)]


def test_every_match_of_a_concern_holds_one_of_its_pieces(spark):
    import itertools
    import re
    from re import _parser as parser

    def said(part):
        """Texts that a pattern matches, all branches of it and each repeat at its least and once more."""
        kinds = []
        for op, value in part:
            name = str(op)
            if name == "LITERAL":
                kinds.append([chr(value)])
            elif name == "BRANCH":
                kinds.append([x for b in value[1] for x in said(b)])
            elif name == "SUBPATTERN":
                kinds.append(said(value[-1]))
            elif name == "MAX_REPEAT":
                kinds.append([x for n in (value[0], value[0] + 1) for x in map("".join, itertools.product(said(value[2]), repeat=n))])
            elif name == "IN":
                kinds.append(["q"])
            else:
                assert name == "AT"
        return ["".join(x) for x in itertools.product(*kinds)]

    assert set(R.CONCERN_PIECES) == set(R.CONCERNS)
    texts = [(n, x) for n, p in R.CONCERNS.items() for x in said(parser.parse(p))]
    assert all(re.search(R.CONCERNS[n], x) and any(piece in x for piece in R.CONCERN_PIECES[n]) for n, x in texts)
    found = spark.createDataFrame(texts, "n string, text string").select("n", "text", R.concerns(F.upper("text")).alias("tags")).collect()
    assert [(r.text, r.tags) for r in found] == [(r.text, [n for n, p in sorted(R.CONCERNS.items()) if re.search(p, r.text)]) for r in found]
