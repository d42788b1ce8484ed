import datetime as dt

from pyspark.sql import functions as F

from cairn.streaming import incremental as I


def test_ingest_keeps_each_content_once_over_runs(spark, tmp_path):
    schema = "source string, hash string, seq int"
    src, out, ck = (str(tmp_path / d) for d in ("in", "out", "ck"))

    def add(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(src)

    def run():
        I.ingest(spark.readStream.schema(schema).parquet(src), out, ck, ["source", "hash"], ["seq"]).awaitTermination()
        return sorted((r.source, r.hash, r.seq) for r in spark.read.parquet(out).collect())

    add(("a", "h1", 1), ("a", "h1", 2), ("b", "h1", 3))
    assert run() == [("a", "h1", 1), ("b", "h1", 3)]
    add(("a", "h1", 4), ("a", "h2", 5))
    assert run() == [("a", "h1", 1), ("a", "h2", 5), ("b", "h1", 3)]
    assert run() == [("a", "h1", 1), ("a", "h2", 5), ("b", "h1", 3)]


def test_change_history(spark):
    old = spark.createDataFrame([("k", 1, "a"), ("m", 1, "z")], "key string, day int, s string")
    new = spark.createDataFrame([("k", 2, "a"), ("m", 2, "y"), ("n", 2, "x"), ("n", 2, "b")], "key string, day int, s string")
    assert sorted((r.key, r.s) for r in I.change_history(new, old, ["key"], "day", ["s"]).collect()) == [("m", "y"), ("n", "x")]


def test_stale_and_leads(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2023, 1, 1)), (3, None)], "id int, d date")
    assert sorted(r.id for r in I.stale(df, "d", "2024-06-01", 365).collect()) == [2, 3]
    old = spark.createDataFrame([(1, "t", "kept")], "k int, title string, note string")
    new = spark.createDataFrame([(1, "u", "lost"), (2, "v", None)], "k int, title string, note string")
    assert sorted(tuple(r) for r in I.merge_leads(old, new, "k", ["note"]).collect()) == [(1, "u", "kept"), (2, "v", None)]


def test_attempt_states(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = [("a", True)] + [("b", False)] * 4 + [("c", False)]
    spark.createDataFrame(rows, "url string, ok boolean").coalesce(1).write.parquet(src)
    q = I.attempt_states(spark.readStream.schema("url string, ok boolean").parquet(src)).writeStream.outputMode("update").format("memory").queryName("attempts").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.url: (r.status, r.attempts) for r in spark.table("attempts").collect()} == {"a": ("archived", 1), "b": ("failed", 3), "c": ("requested", 1)}


def test_windowed_counts(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 5), "x"), (dt.datetime(2024, 1, 1, 0, 50), "x"), (dt.datetime(2024, 1, 1, 3), "y")], "ts timestamp, k string").coalesce(1).write.parquet(src)
    q = I.windowed_counts(spark.readStream.schema("ts timestamp, k string").parquet(src), "ts", "k").writeStream.outputMode("complete").format("memory").queryName("counted").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.n for r in spark.table("counted").where(F.col("k") == "x").collect()) == [2]
