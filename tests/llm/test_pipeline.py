"""Every stage, and the whole, over odd rows and over none: nulls, empty and long texts, repeated rows, extra and clashing columns."""

import shutil
from collections import Counter

import corpus_pipeline as P
import pytest

LONG = " ".join(f"w{k % 977}x{k}" for k in range(20_000))
WORDS = "der Rat hat heute über den neuen Plan der Stadt lange beraten und dann mit großer Mehrheit beschlossen was nun folgt"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id long, fp string"


@pytest.fixture(scope="module")
def folder(spark, sf, tmp_path_factory):
    """The test tables with documents of our own: readable ones from the table, and odd ones."""
    path = tmp_path_factory.mktemp("odd")
    for name in ("labels", "benchmark"):
        shutil.copy(f"{sf}/{name}.parquet", path)
    good = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    odd = [(None, None, None, None), (None, WORDS, "de", "s"), (None, WORDS, "de", "s"), (9001, None, "de", "s"), (9002, "", None, "s"), (9003, " \n\t\n ", "de", None), (9004, LONG, "en", "s"), (9005, LONG, "en", "s"), (9006, WORDS, "de", "s"), (9006, WORDS, "de", "s"), (9006, WORDS + " noch mehr", "de", "s"), (9007, "ha " * 5000, "en", "s")]
    rows = [(*r, len(r[1] or ""), 0.5, 1, "x") for r in good + odd]
    spark.createDataFrame(rows, COLUMNS).repartition(5).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], COLUMNS).write.parquet(f"{path}/none/documents.parquet")
    for name in ("labels", "benchmark"):
        shutil.copy(f"{sf}/{name}.parquet", path / "none")
    return str(path)


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_stages_keep_columns_and_only_drop_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        out = P.materialize(stage(spark, docs, folder))
        assert out.columns == docs.columns and out.schema == docs.schema, name
        if name == "line dedup":
            assert out.count() == docs.count() and out.where("n_chars <> length(text)").count() == 0
        else:
            assert not rows(out) - rows(docs), name
        # rows without an id can't be matched to a decision
        assert out.where("doc_id IS NULL").count() == docs.where("doc_id IS NULL").count(), name


def test_near_duplicates_of_odd_rows(spark, folder):
    out = P.near_duplicates(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    kept = Counter(r.doc_id for r in out.where("doc_id > 9000 OR doc_id IS NULL").collect())
    assert kept[9004] == 1 and kept[9005] == 0 and kept[9007] == 1 and kept[None] == 3
    assert kept[9001] + kept[9002] + kept[9003] <= 1  # equal, empty sets; another empty text may stand for them
    assert kept[9006] == 2  # of the rows of one id and text one stays


def test_packing_takes_every_row(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    pieces = P.packing(spark, docs, folder)
    empty = [r for r in pieces.where("doc_id IN (9001, 9002)").collect()]
    assert {(r.doc_id, r.length, r.doc_tokens) for r in empty} == {(9001, 1, 1), (9002, 1, 1)}
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").distinct().collect()}


def test_the_whole_over_odd_rows_and_over_none(spark, folder):
    packed = P.run(spark, folder)
    assert packed.where("length < 1 OR length > 4096").count() == 0 and packed.where("doc_id IS NULL").count() >= 3
    assert P.run(spark, f"{folder}/none").count() == 0
    nothing = spark.read.parquet(f"{folder}/none/documents.parquet")
    for name, stage in P.STAGES:
        assert stage(spark, nothing, f"{folder}/none").count() == 0, name
