"""The corpus pipeline: five operators in turn over documents, each stage's rows written and reread.

Every stage but the last returns the columns of documents. A null text counts as empty. Rows without a doc_id can't
be matched to a decision and stay; rows that share a doc_id share its decisions. An empty table passes through empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.decontam import contaminated
from cairn.llm.lines import drop_boilerplate
from cairn.llm.near import similar_components
from cairn.llm.packing import pack_documents
from cairn.llm.quality import score_quality
from cairn.llm.queries import tokenizer_path
from cairn.llm.support import bounded, materialize


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id isn't among the few ``dropped`` ones."""
    return docs.join(bounded(materialize(dropped.select("doc_id").distinct())), "doc_id", "left_anti").select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier predicts to be of label 0."""
    scored = score_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return without(docs, scored.where("predicted = 0"))


def boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut boilerplate lines of each source; n_chars follows the text."""
    cut = drop_boilerplate(docs)
    return cut.select(*(F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each component of five-word Jaccard similarity 0.8.

    Operator 7's ball hashing proposes links between SimHash fingerprints of five-word shingles; as few pairs near the
    threshold lie within its 4 bits, MinHash bands propose the rest, and exact sets decide. Of rows that share id and
    text one stays.
    """
    stay = materialize(without(docs, similar_components(docs).where("doc_id <> component_id")))
    again = bounded(materialize(stay.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").select("doc_id")))
    return stay.join(again, "doc_id", "left_anti").unionByName(stay.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a passage of the benchmark."""
    return without(docs, contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, with their token ids."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality", quality),
    ("line dedup", boilerplate_lines),
    ("simhash near-dedup", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The stages apply a trained classifier, fingerprints and a tokenizer: no SQL expresses them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
