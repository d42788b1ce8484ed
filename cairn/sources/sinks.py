"""Sinks: staged, checked, then renamed; deterministic row order; a manifest of what was published."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class GateFailed(RuntimeError):
    """A publish gate found differences; nothing was replaced."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def row_hash(df: DataFrame) -> str:
    """A digest of a table's rows whatever their order or files: what stands for byte equality."""
    value = F.xxhash64(*(F.col(c) for c in df.columns))
    n, total, mixed = df.agg(F.count("*"), F.sum(value.cast("decimal(20,0)")), F.bit_xor(value)).first()
    return f"{n}:{total}:{mixed}"


def publish(tables: dict[str, DataFrame], folder: str, gates: list[DataFrame] = (), kinds: dict[str, str] | None = None) -> DataFrame:
    """SNK1, SNK5, SNK6: writes all to a staging folder, runs the gates, then swaps it in.

    A gate is a frame of differences that must be empty. A move that fails is undone. Rows are range-sorted, not gathered in one file.
    Returns the manifest (name, kind, rows, bytes).
    """
    spark = next(iter(tables.values())).sparkSession
    staging = f"{folder.rstrip('/')}.staging-{uuid.uuid4().hex}"
    for gate in gates:
        if found := gate.limit(5).collect():
            raise GateFailed(f"{len(found)} or more differences: {found}")
    rows = []
    for name, df in tables.items():
        path = f"{staging}/{name}.parquet"
        df.orderBy(*df.columns).write.option("compression", "zstd").parquet(path)
        p, fs = _fs(spark, path)
        rows.append((name, (kinds or {}).get(name, "table"), spark.read.parquet(path).count(), fs.getContentSummary(p).getLength()))
    manifest = spark.createDataFrame(rows, "name string, kind string, rows long, bytes long")
    manifest.coalesce(1).write.json(f"{staging}/manifest.json")
    target, fs = _fs(spark, folder)
    old, _ = _fs(spark, f"{staging}.old")
    there = fs.exists(target)
    if there and not fs.rename(target, old):
        raise OSError(f"{folder} could not be moved away; it is as before, the new edition is in {staging}")
    if not fs.rename(_fs(spark, staging)[0], target):
        if there and not fs.rename(old, target):
            raise OSError(f"the old edition of {folder} is in {staging}.old")
        raise OSError(f"{folder} could not be replaced; the new edition is in {staging}")
    if there:
        fs.delete(old, True)
    return manifest


def columns_and_rows(df: DataFrame, limit: int = 10_000) -> dict:
    """SNK2: a small summary as columns and rows; a frame beyond the limit is refused."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows")
    return {"columns": df.columns, "rows": [list(r) for r in rows]}


def write_partitions(df: DataFrame, path: str, key: str) -> None:
    """SNK3: one JSON partition per key; only partitions that are written are replaced."""
    df.repartition(key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", True).partitionBy(key).json(path)


def record_index(tables: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """SNK4: (entity, record_id, partition) over several tables."""
    parts = [df.select(F.lit(name).alias("entity"), F.col(i).cast("string").alias("record_id"), F.col(p).cast("string").alias("partition")) for name, (df, i, p) in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ordered_columns(df: DataFrame, preferred: list[str]) -> DataFrame:
    """SNK7: preferred columns first, the rest as they came; NULL as blank."""
    names = [c for c in preferred if c in df.columns] + [c for c in df.columns if c not in preferred]
    return df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in names))


def write_csv(df: DataFrame, path: str, preferred: list[str] = ()) -> None:
    ordered_columns(df, list(preferred)).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def append_rows(df: DataFrame, path: str) -> None:
    """SNK9: appends; new columns are NULL in older rows when read with mergeSchema."""
    df.write.mode("append").parquet(path)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def content_rows(raw: DataFrame, stored: DataFrame | None) -> DataFrame:
    """SNK10: contents not stored yet, keyed by their SHA-256."""
    keyed = raw.withColumn("sha256", F.sha2("content", 256)).dropDuplicates(["sha256"])
    return keyed.join(stored.select("sha256"), "sha256", "left_anti") if stored is not None else keyed


def inferred_types(df: DataFrame) -> DataFrame:
    """SNK11: for text columns the narrowest type that all filled cells cast to, in one aggregate."""
    aggs = []
    for c in df.columns:
        v = F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
        fits = lambda t, v=v: F.count(v) == F.count(F.when(v.try_cast(t).isNotNull(), 1))
        aggs.append(F.when(F.count(v) == 0, "string").when(fits("bigint"), "integer").when(fits("double"), "number").when(F.count(v) == F.count_if(v.rlike(r"^\d{4}-\d{2}-\d{2}$")), "date").otherwise("string").alias(c))
    wide = df.agg(*aggs).withColumn("__k", F.lit(1))
    return wide.unpivot("__k", df.columns, "field", "type").drop("__k")
