import datetime as dt

import pytest
from pyspark.sql import functions as F

from cairn.functions import scalars as S


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize(("s", "want"), [("2024", None), ("2024-05", None), ("2024-05-06", dt.date(2024, 5, 6)), ("2024-13-01", None), (None, None), ("", None)])
def test_only_full_dates_are_dates(spark, s, want):
    assert one(spark, S.strict_date, s) == want


@pytest.mark.parametrize(("s", "want"), [("2024", dt.date(2024, 12, 31)), ("2024-02", dt.date(2024, 2, 29)), ("2024-02-03", dt.date(2024, 2, 3)), ("x", None)])
def test_latest_day_of_partial_dates(spark, s, want):
    assert one(spark, S.latest_day, s) == want


def test_partial_dates_compare_at_their_own_precision(spark):
    for s, want in (("2024", True), ("2024-06", True), ("2024-06-15", False), ("2023-12-31", True)):
        assert one(spark, lambda x: S.not_after(x, F.lit("2024-06-14")), s) is want


def test_lists_blanks_and_tri_state(spark):
    assert one(spark, S.split_list, " a; ;b;;a") == ["a", "b", "a"]
    assert one(spark, S.split_list, None) == []
    assert one(spark, S.blank_to_null, "  ") is None
    assert [one(spark, S.tri_state, v) for v in ("Yes", "false", "maybe", None)] == [True, False, None, None]


def test_text_dates(spark):
    assert one(spark, S.latest_text_date, "in June 2023 and 2022-01-05") == "2023-06"
    assert one(spark, S.latest_text_date, "none") is None


def test_urls(spark):
    assert one(spark, S.normalize_url, "HTTPS://Www.Ex.org/A/?q=1#top") == "https://www.ex.org/A?q=1"
    assert one(spark, S.url_key, "HTTPS://www.ex.org/A/?utm_source=x&q=1&fbclid=2#t") == "http://ex.org/A?q=1"
    assert one(spark, S.url_key, "http://ex.org/A?ref=n") == "http://ex.org/A"


def test_amounts_and_keys(spark):
    low, high = S.capacity(F.col("x"))
    df = spark.createDataFrame([("35-40 MW",), ("2 GW",), ("500 kW plant",), ("9 acres",)], "x string").select(low, high)
    assert [tuple(r) for r in df.collect()] == [(35.0, 40.0), (2000.0, 2000.0), (0.5, 0.5), (None, None)]
    assert one(spark, lambda x: S.padded_key(x, 5), "1001.0") == "01001"
    assert one(spark, lambda x: S.padded_key(x, 5), "ab") is None
    assert one(spark, S.place_key, "Saint Mary Parish") == "stmary"
    assert one(spark, lambda x: S.map_value(x, F.lit("wind")), "solar:50;wind:5") == 5.0
    assert one(spark, S.largest_feet, "1,000 feet or 300 ft") == 1000.0


def test_boxes_are_tri_state(spark):
    df = spark.createDataFrame([(1.0, 1.0), (9.0, 1.0), (0.0, 0.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(S.in_box(F.col("a"), F.col("b"), (0, 0, 5, 5))).collect()] == [True, False, None, None]


def test_haversine(spark):
    got = spark.range(1).select(S.haversine_miles(F.lit(40.0), F.lit(-75.0), F.lit(41.0), F.lit(-75.0))).first()[0]
    assert abs(got - 69.09) < 0.05
