"""Plug-ins as configuration: extractors by source, variables and model inputs by manifest."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.scalars import all_equal, level_index, padded_key, transform_number
from cairn.operators.joins import asof_value

Extractor = Callable[[bytes], list[dict]]
_EXTRACTORS: dict[str, Extractor] = {}
LEADS = "source_id string, content_hash string, fields map<string,string>, error string"


def extractor(source_id: str):
    """Register a function from raw bytes to records."""

    def register(f: Extractor) -> Extractor:
        _EXTRACTORS[source_id] = f
        return f

    return register


def extract(raw: DataFrame) -> DataFrame:
    """Records of raw(source_id, content_hash, content); an exception becomes an error row to retry, not a failed job."""
    known = dict(_EXTRACTORS)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for source, digest, content in zip(frame["source_id"], frame["content_hash"], frame["content"], strict=True):
                try:
                    out += [(source, digest, {k: str(v) for k, v in r.items()}, None) for r in known[source](bytes(content))]
                except Exception as e:
                    out.append((source, digest, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["source_id", "content_hash", "fields", "error"])

    return raw.select("source_id", "content_hash", "content").mapInPandas(run, LEADS)


@dataclass
class Variable:
    """One published variable: where it comes from and what it may look like."""

    name: str
    path: str
    key: str
    column: str
    width: int = 5
    where: dict[str, str] = field(default_factory=dict)
    transform: str = "identity"
    levels: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None


def variable(spark: SparkSession, v: Variable) -> DataFrame:
    """(key, variable, value); a value outside its bounds raises when it is read."""
    df = spark.read.parquet(v.path).where(all_equal(v.where))
    raw = F.col(v.column)
    value = level_index(raw, v.levels).cast("double") if v.levels else transform_number(raw.try_cast("double"), v.transform)
    bad = F.lit(False)
    if v.low is not None:
        bad = bad | (value < v.low)
    if v.high is not None:
        bad = bad | (value > v.high)
    checked = F.when(F.coalesce(bad, F.lit(False)), F.raise_error(F.lit(f"{v.name} is out of bounds")).cast("double")).otherwise(value)
    return df.select(padded_key(F.col(v.key), v.width).alias("key"), F.lit(v.name).alias("variable"), checked.alias("value")).where("key IS NOT NULL")


def model_input(requests: DataFrame, series: DataFrame, keys: list[str], year: str, value: str, lag_years: int, out: str) -> DataFrame:
    """The latest value of a yearly series not younger than ``lag_years`` before a request."""
    shifted = requests.withColumn("__y", F.col(year) - lag_years)
    dated = series.withColumn("__t", F.col(year))
    return asof_value(shifted, dated, keys, "__y", "__t", value, out=out).drop("__y")
