import pytest
from pyspark.errors import PySparkException
from pyspark.ml.feature import Imputer, PolynomialExpansion, StandardScaler, VectorAssembler
from pyspark.sql import functions as F

from cairn.functions import scalars as S
from cairn.operators import matching, models, summaries
from cairn.sources import plugins


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def test_greedy_dedupe_registers_only_kept_rows(spark):
    df = frame(spark, "n int, u string, h string", (1, "u1", "h1"), (2, "u2", "h1"), (3, "u2", "h3"), (4, None, None), (5, None, "h3"), (6, None, None))
    assert sorted(r.n for r in matching.greedy_dedupe(df, ["u", "h"], "n").collect()) == [1, 3, 4, 6]
    assert matching.greedy_dedupe(df.limit(0), ["u", "h"], "n").count() == 0


def test_greedy_query_equals_a_loop(spark, sf):
    from cairn.plans import registry

    seen, kept = set(), set()
    for r in spark.read.parquet(f"{sf}/events.parquet").selectExpr("event_id", "user_id AS u", "CAST(round(value * 100) AS long) AS h").orderBy("event_id").collect():
        keys = {k for k in (("u", r.u), ("h", r.h)) if k[1] is not None}
        if not keys & seen:
            seen |= keys
            kept.add(r.event_id)
    assert {r.event_id for r in registry.QUERIES["q_greedy_dedupe"](spark, sf).collect()} == kept


def test_blocked_matching(spark):
    a = frame(spark, "id int, st string, core array<string>", (1, "x", ["sun", "hill"]), (2, "x", ["hill"]), (3, "y", ["hill"]), (4, "x", ["a"]))
    b = frame(spark, "pid int, st string, pcore array<string>", (10, "x", ["hill", "sun"]), (11, "x", ["hill", "sun"]), (12, "x", ["a", "b"]))
    pairs = matching.blocked_candidates(a, b, "st", "core", "pcore")
    assert sorted((r.id, r.pid, r.level) for r in pairs.collect()) == [(1, 10, "strong"), (1, 11, "strong"), (2, 10, "possible"), (2, 11, "possible")]
    graded = matching.demote_multiple(pairs, "id", "pid")
    assert {(r.id, r.level, tuple(r.partners)) for r in matching.best_level(graded, "id", "pid").collect()} == {(1, "possible", (10, 11)), (2, "possible", (10, 11))}


def test_lookups(spark):
    rows = frame(spark, "k int, v string", (1, ""), (2, "x"), (3, None))
    linked = frame(spark, "k int, v string, o int", (1, "a", 1), (1, "b", 2), (3, "c", 1))
    assert sorted(tuple(r) for r in matching.fill_from_linked(rows, linked, "k", ["v"], "o").collect()) == [(1, "b"), (2, "x"), (3, "c")]
    held = matching.hold_duplicates(rows, frame(spark, "k int, id string", (1, "z"), (1, "y")), ["k"], "id")
    assert {r.k: r.held_for for r in held.collect()} == {1: "y", 2: None, 3: None}
    log = frame(spark, "s string, t int, h string, ok boolean", ("a", 1, "x", True), ("a", 2, "y", False), ("b", 1, "z", False))
    assert [tuple(r) for r in matching.last_success(log, ["s"], "t", "h", F.col("ok")).collect()] == [("a", "x")]


def test_names_in_text(spark):
    texts = frame(spark, "id int, st string, body string", (1, "x", "a ban in Saint Mary County and Oak county"), (2, "y", "Oak County"), (3, "x", "Soak county"))
    names = frame(spark, "st string, name string", ("x", "Saint Mary"), ("x", "Oak"), ("x", "Mary"))
    assert sorted((r.id, r.name) for r in matching.mentions(texts, names, "st", "body", "name").collect()) == [(1, "Mary"), (1, "Oak"), (1, "Saint Mary")]
    close = matching.close_names(frame(spark, "q string", ("Okland",)), frame(spark, "name string", ("Oakland",), ("Ashland",), ("Perry",)), "q", "name", 1)
    assert close.first().name == "Oakland"


def test_more_scalars(spark):
    low, high = S.month_span(F.lit("2024"), F.lit("2024-03-05"))
    assert tuple(spark.range(1).select(low, high).first()) == (1, 64)
    words = frame(spark, "s string", ("approved, then denied",), ("denial recommended; denied",)).select(S.decision_words(F.col("s")))
    assert [r[0] for r in words.collect()] == [["approved", "denied"], []]
    assert spark.range(1).select(S.plain_json(F.struct(F.lit(1).alias("a"), F.lit(None).cast("int").alias("b")))).first()[0] == '{"a":1}'
    assert tuple(spark.range(1).select(*S.dollars(F.lit(10.0), (1.0, 2.0), 0.1, F.lit(2))).first()) == (12.1, 24.2)


def test_summaries(spark):
    t = frame(spark, "k int, county string, year int, lat double, lon double", (1, "a", 2001, 1.0, 2.0), (1, "b", 2000, 3.0, 2.0), (1, "b", 2002, 2.0, 2.0))
    assert tuple(summaries.projects(t, "k", "county").select("year", "lat", "county").first()) == (2000, 2.0, "b")
    f = frame(spark, "k int, feature string, p double", (1, "ban", 3.0), (1, "setback", 1.0), (2, "setback", 1.0))
    assert [tuple(r) for r in summaries.scored_groups(f, ["k"], F.col("p"), 2.0).collect()] == [(1, 4.0, "ban", 2)]
    assert {r.reason: r.n for r in summaries.dropped_by_reason(f, F.when(F.col("p") < 2, "low")).collect()} == {"low": 2, "kept": 1}


def test_plugins(spark, tmp_path):
    @plugins.extractor("lines")
    def lines(content):
        return [{"line": x} for x in content.decode().split("\n")]

    raw = frame(spark, "source_id string, content_hash string, content binary", ("lines", "h1", bytearray(b"a\nb")), ("gone", "h2", bytearray(b"")))
    out = plugins.extract(raw).collect()
    assert sorted(r.fields["line"] for r in out if r.fields) == ["a", "b"] and [r.error for r in out if r.error] == ["KeyError: 'gone'"]
    path = str(tmp_path / "v")
    frame(spark, "fips string, kind string, x string", ("1001.0", "a", "5"), ("02002", "b", "7"), ("zz", "a", "1")).write.parquet(path)
    v = plugins.Variable("x", path, "fips", "x", where={"kind": "a"}, high=6)
    assert [tuple(r) for r in plugins.variable(spark, v).collect()] == [("01001", "x", 5.0)]
    with pytest.raises(PySparkException, match="out of bounds"):
        plugins.variable(spark, plugins.Variable("x", path, "fips", "x", high=6)).collect()
    asked = frame(spark, "k int, year int", (1, 2010), (1, 2004))
    series = frame(spark, "k int, year int, v double", (1, 2005, 1.0), (1, 2008, 2.0), (1, 2009, 3.0))
    assert {r.year: r.got for r in plugins.model_input(asked, series, ["k"], "year", "v", 2, "got").collect()} == {2010: 2.0, 2004: None}


def test_models_dont_leak(spark):
    df = spark.range(400).select(F.col("id"), (F.rand(1) * 2 - 1).alias("x"), F.when(F.col("id") % 17 > 0, F.rand(2)).alias("z"), (2000 + F.col("id") % 10).alias("year")).withColumn("y", (F.col("x") + 0.3 * F.randn(3) > 0).cast("int"))
    out = models.cross_predict(df, ["x", "z"], "y", F.col("id"), folds=3)
    assert out.count() == 400 and models.auc(out, "y") > 0.9
    later = models.forward_holdout(df, ["x", "z"], "y", "year", 2007)
    assert later.where("year < 2007").count() == 0 and models.auc(later, "y") > 0.85
    assert "x" in models.stable_columns(df, ["x", "z"], "y", F.col("id"), 3)


def test_fits_read_their_rows_from_a_table_and_not_through_what_made_them(spark):
    df = spark.range(300).select("id", (F.col("id") % 7 > 2).cast("int").alias("y"), (F.col("id") % 7 + F.col("id") % 3).cast("double").alias("x")).groupBy("id", "y").agg(F.max("x").alias("x"))
    made = models.cross_predict(df, ["x"], "y", F.col("id"), folds=2)
    assert "Aggregate" in df._jdf.queryExecution().toString() and "Aggregate" not in made._jdf.queryExecution().toString()
    assert made.count() == 300


def test_equal_rows_are_fitted_as_one_with_their_number(spark, monkeypatch):
    df = spark.range(4000).select("id", (F.col("id") % 7).cast("double").alias("x"), F.when(F.col("id") % 5 > 0, F.col("id") % 3).cast("double").alias("z"), (F.xxhash64("id") % 9 > F.col("id") % 7 - 3).cast("int").alias("y"))
    read, fit = [], models.Pipeline.fit

    def counted(self, dataset):
        read.append((dataset.count(), dataset.agg(F.sum("weight")).first()[0]))
        return fit(self, dataset)

    monkeypatch.setattr(models.Pipeline, "fit", counted)
    made = {kind: models.cross_predict(df, ["x", "z"], "y", F.col("id"), folds=2, kind=kind, degree=degree).select("id", "fold", "p").cache() for kind, degree in (("boosted", 1), ("logistic", 2))}
    assert max(n for n, _ in read) <= 70 and [sum(w for _, w in read[k : k + 2]) for k in (0, 2)] == [4000, 4000]
    rows = df.withColumn("label", F.col("y").cast("double")).withColumn("fold", models.fold_of(F.col("id"), 2)).withColumn("weight", F.lit(1.0)).cache()
    # the fit of all rows one by one, standardised beforehand
    whole = {"boosted": models.GBTClassifier(maxIter=20, maxDepth=3, seed=7), "logistic": models.LogisticRegression(regParam=0.01, maxIter=50)}
    for kind, classifier in whole.items():
        filled = [Imputer(strategy="median", inputCols=["x", "z"], outputCols=["fx", "fz"]), VectorAssembler(inputCols=["fx", "fz"], outputCol="raw")]
        wide = [PolynomialExpansion(degree=2 if kind == "logistic" else 1, inputCol="raw", outputCol="poly"), StandardScaler(withMean=True, inputCol="poly", outputCol="features"), classifier]
        for k in range(2):
            wanted = models.predict(fit(models.Pipeline(stages=[*filled, *wide]), rows.where(F.col("fold") != k)), rows.where(F.col("fold") == k)).select("id", F.col("p").alias("q"))
            both = wanted.join(made[kind].where(F.col("fold") == k), "id", "full")
            assert both.where("p IS NULL OR q IS NULL").count() == 0 and both.agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0] < 1e-4


def test_many_distinct_rows_are_scored_one_by_one_to_the_same_end(spark, monkeypatch):
    df = spark.range(300).select("id", F.when(F.col("id") % 4 > 0, F.col("id") % 11).cast("double").alias("x"), (F.col("id") % 11 > 4).cast("int").alias("y"), (2000 + F.col("id") % 9).alias("year"))
    run = lambda: [sorted(f.select("id", F.round("p", 9)).collect()) for f in (models.cross_predict(df, ["x"], "y", F.col("id"), folds=3), models.forward_holdout(df, ["x"], "y", "year", 2005))]
    few = run()
    monkeypatch.setattr(models, "FEW", 0)
    assert run() == few and [len(f) for f in few] == [300, df.where("year >= 2005").count()]
    net = models.cross_predict(df, ["x"], "y", F.col("id"), folds=2, kind="mlp")
    assert net.count() == 300 and models.auc(net, "y") > 0.8


def test_medians_are_those_of_all_rows(spark):
    nan = float("nan")
    rows = frame(spark, "a double, b int, c double, weight double", (1.0, 1, None, 3.0), (2.0, None, nan, 2.0), (9.0, 4, None, 1.0), (nan, 7, None, 2.0), (None, None, None, 5.0))
    assert models.medians(rows, ["a", "b", "c"]) == {"a": 1.5, "b": 2.5, "c": 0.0} and models.medians(rows, []) == {}
