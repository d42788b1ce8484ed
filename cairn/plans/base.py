"""How a query is registered: a function of the tables, and SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The Parquet tables of a folder as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of ``Tables`` under its name, with its oracle."""

    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def money(c: Column | str) -> Column:
    """A sum that doesn't depend on the order of its rows."""
    return F.sum((F.col(c) if isinstance(c, str) else c).cast("decimal(18,4)")).cast("double")
