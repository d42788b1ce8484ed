"""Incremental jobs on Structured Streaming: file sources with checkpoints, foreachBatch sinks, keyed state.

The reference behaviour is batch with durable state; here the state is the stream's checkpoint and
Parquet tables that a batch anti-joins. ``as_of`` is passed in, never read from the clock.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def new_contents(batch: DataFrame, history: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """ST1-ST3: rows whose keys neither history nor an earlier row of the batch has."""
    unseen = batch.join(history.select(*keys), keys, "left_anti")
    return unseen.withColumn("__rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("__rn = 1").drop("__rn")


def ingest(stream: DataFrame, out: str, checkpoint: str, keys: list[str], order: list[str], *, max_batches: bool = True):
    """ST2-ST4: reads what is there, keeps each key once over all runs, and resumes where it stopped.

    A batch that is run again after a failure overwrites its own partition, so each row is written once.
    """
    schema = stream.schema
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        history = read_or_empty(spark, out, schema.add("batch", "long") if "batch" not in schema.names else schema).where(F.col("batch") != batch_id)
        new_contents(batch, history, keys, order).withColumn("batch", F.lit(batch_id).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if max_batches else writer).start()


def change_history(batch: DataFrame, history: DataFrame, keys: list[str], at: str, state: list[str]) -> DataFrame:
    """ST6: rows to append: the state differs from the key's last one; a second change of a day replaces the first."""
    last = history.groupBy(*keys).agg(F.max_by(F.struct(*state), at).alias("__last"))
    newest = batch.withColumn("__rn", F.row_number().over(W.partitionBy(*keys, at).orderBy(*(F.desc(s) for s in state)))).where("__rn = 1").drop("__rn")
    return newest.join(last, keys, "left").where(F.col("__last").isNull() | ~F.struct(*state).eqNullSafe(F.col("__last"))).drop("__last")


def stale(df: DataFrame, checked: str, as_of: str, days: int) -> DataFrame:
    """ST7."""
    return df.where(F.col(checked).isNull() | (F.col(checked) < F.date_sub(F.lit(as_of).cast("date"), days)))


ATTEMPTS = "url string, status string, attempts int, result string"


def attempt_states(results: DataFrame, max_attempts: int = 3) -> DataFrame:
    """ST5: per URL new -> requested -> archived or failed, as keyed streaming state.

    ``results(url, ok)`` is a stream of attempts. The state is (attempts, status); archived and failed are final.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        attempts, status = state.get if state.exists else (0, "new")
        for frame in frames:
            for ok in frame["ok"]:
                if status in ("archived", "failed"):
                    break
                attempts += 1
                status = "archived" if ok else "failed" if attempts >= max_attempts else "requested"
        state.update((attempts, status))
        yield pd.DataFrame({"url": [key[0]], "status": [status], "attempts": [attempts]})

    return results.groupBy("url").applyInPandasWithState(step, "url string, status string, attempts int", "attempts int, status string", "update", GroupStateTimeout.NoTimeout)


def windowed_counts(events: DataFrame, at: str, key: str, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """An extension, not reference parity: tumbling counts with a watermark for late rows."""
    return events.withWatermark(at, late).groupBy(F.window(at, size), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")


def merge_leads(old: DataFrame, new: DataFrame, key: str, carried: list[str]) -> DataFrame:
    """ST8: new values win where given, review columns of the old row stay."""
    o = old.select(key, *(F.col(c).alias(f"__{c}") for c in old.columns if c != key))
    both = new.join(o, key, "full")
    pick = lambda c: F.coalesce(f"__{c}", c) if c in carried else F.coalesce(c, f"__{c}")
    return both.select(key, *(pick(c).alias(c) for c in new.columns if c != key))
