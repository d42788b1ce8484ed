"""Shared helpers: lineage-cutting tables, size-checked joins, bounded Arrow output."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A side of a join is broadcast only after its rows and bytes were counted and found to be at most this many.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir. Where that is unset a local session, as in tests, gets a temporary one; a cluster has to name one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="cairn-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cairn_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by ``materialize`` that nothing reads any more."""
    path = getattr(df, "_cairn_path", None)
    if path:
        jvm = df.sparkSession._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        hadoop_path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _width(name: str, kind: T.DataType) -> Column:
    """About the bytes that a value takes."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(name), F.lit(0)) + 8
    if isinstance(kind, T.ArrayType):
        each = F.lit(8) if not isinstance(kind.elementType, (T.StringType, T.StructType)) else F.lit(24)
        return F.greatest(F.size(name), F.lit(0)) * each + 16
    return F.lit(8)


def bounded(table: DataFrame, rows: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Mark a materialized ``table`` for broadcasting if a count shows its rows and bytes small; else leave the join to the shuffle."""
    width = sum((_width(f"`{f.name}`", f.dataType) for f in table.schema), F.lit(0))
    n, size = table.agg(F.count("*"), F.sum(width.cast("long"))).first()
    small = n <= (BROADCAST_ROWS if rows is None else rows) and (size or 0) <= (BROADCAST_BYTES if max_bytes is None else max_bytes)
    return F.broadcast(table) if small else table


def rows_of(batch: pa.RecordBatch, names: list[str]):
    """Rows of an Arrow batch as tuples, a few hundred at a time so that long texts aren't all unpacked at once."""
    columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
    for i in range(0, batch.num_rows, 256):
        yield from zip(*(c.slice(i, 256).to_pylist() for c in columns), strict=True)


class Out:
    """Collects output rows and hands them out as Arrow batches of bounded bytes."""

    def __init__(self, schema: pa.Schema, max_bytes: int = 8 << 20):
        self.schema, self.max_bytes, self.rows, self.bytes = schema, max_bytes, [], 0

    def add(self, row: tuple, size: int = 64) -> bool:
        """True once the batch is full: the caller then yields ``flush()``."""
        self.rows.append(row)
        self.bytes += size
        return self.bytes >= self.max_bytes

    def flush(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(self.schema)
        self.rows, self.bytes = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
