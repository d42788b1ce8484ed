"""Near-duplicate embeddings by Euclidean p-stable hashing and exact cosine checks.

Normalised vectors are projected on Gaussian directions, shifted and quantised; ``k`` such values
name a bucket of one table. A pair that collides in any of the tables is checked by its exact
cosine, in the first table where it collides only, so no pair is counted twice.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.components import connected_components
from cairn.llm.support import bounded, materialize, shuffle_partitions

COSINE = 0.95
#: Width of a quantisation step, in standard deviations of a unit vector's projection.
WIDTH = 2.0
#: A pair exactly at the threshold is missed with this probability at most; closer pairs far less often.
MISS = 0.002
#: Random vectors that share a bucket, about.
BUCKET = 40
#: Larger buckets are compared in blocks of this many, each pair of blocks by itself.
BLOCK = 4096


def collision(distance: float, width: float = WIDTH) -> float:
    """Probability that one quantised projection agrees for two points at ``distance``."""
    r = width / distance
    return math.erf(r / math.sqrt(2)) - math.sqrt(2 / math.pi) / r * (1 - math.exp(-r * r / 2))


def plan(n: int, cosine: float = COSINE) -> tuple[int, int]:
    """Values per bucket, and tables: buckets stay small as n grows, and the tables make up the recall."""
    far, near = collision(math.sqrt(2)), collision(math.sqrt(2 - 2 * cosine))
    k = max(4, math.ceil(math.log(max(n, 2) / BUCKET) / -math.log(far)))
    return k, math.ceil(math.log(MISS) / math.log(1 - near**k))


def unit(blob) -> np.ndarray:
    v = np.frombuffer(blob, np.float64)
    return v / np.linalg.norm(v)


def scaled(v: np.ndarray) -> np.ndarray:
    """``v`` by a power of two that brings its largest component to 0.5 to 1: the same direction to the last bit, and a norm that neither overflows nor vanishes."""
    return np.ldexp(v, -np.frexp(np.abs(v).max())[1])


def hashed(reps: DataFrame, k: int, tables: int) -> DataFrame:
    """(rep, n, vector, hashes): the scaled vector as float64 bytes and its bucket in every table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        families: dict[int, tuple] = {}
        salt = np.random.default_rng(7).integers(1, 1 << 62, k, dtype=np.int64) | 1
        for batch in batches:
            vectors = [scaled(np.asarray(v, np.float64)) for v in batch.column(2).to_pylist()]
            out = []
            for v in vectors:
                if len(v) not in families:
                    rng = np.random.default_rng(len(v))
                    families[len(v)] = rng.standard_normal((len(v), tables * k)), rng.uniform(0, WIDTH, tables * k)
                directions, shift = families[len(v)]
                cells = np.floor(((v / np.linalg.norm(v)) @ directions + shift) / WIDTH).astype(np.int64)
                out.append((cells.reshape(tables, k) * salt).sum(axis=1) * 1_000_003 + len(v))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([v.tobytes() for v in vectors], pa.binary()), pa.array([h.tolist() for h in out], pa.list_(pa.int64()))], names=["rep", "n", "vector", "hashes"])

    return reps.select("rep", "n", "embedding").mapInArrow(run, "rep long, n long, vector binary, hashes array<long>")


def _bucket_links(t: int, rep: np.ndarray, n: np.ndarray, block: np.ndarray, crossing: bool, x: np.ndarray, h: np.ndarray, cosine: float):
    """Links found in one bucket: what each row adds to its count, and a star for each group."""
    ai, bi = [], []
    for i in range(0, len(x), 2048):
        found = np.argwhere(x[i : i + 2048] @ x[i:].T >= cosine)
        a, b = found[:, 0] + i, found[:, 1] + i
        keep = (a < b) & ((block[a] != block[b]) if crossing else True)
        ai.append(a[keep])
        bi.append(b[keep])
    a, b = np.concatenate(ai), np.concatenate(bi)
    if t:
        new = np.concatenate([~(h[a[i : i + 65536], :t] == h[b[i : i + 65536], :t]).any(axis=1) for i in range(0, len(a), 65536)] or [np.zeros(0, bool)])
        a, b = a[new], b[new]
    links = np.zeros(len(rep), np.int64)
    np.add.at(links, a, n[b])
    np.add.at(links, b, n[a])
    label = rep.copy()
    while len(a):
        before = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        if (before == label).all():
            break
    hit = np.flatnonzero(links)
    return rep[hit], label[hit], links[hit]


def vector_links(points: DataFrame, cosine: float) -> DataFrame:
    """(a, b, links): per bucket what a row adds to the link count of representative a, and a star link to b."""
    spark = points.sparkSession
    placed = points.select("rep", "n", "vector", "hashes", F.posexplode("hashes").alias("t", "bucket"))
    sizes = points.select(F.posexplode("hashes").alias("t", "bucket")).groupBy("t", "bucket").count().where(F.col("count") > BLOCK)
    large = bounded(materialize(sizes.select("t", "bucket", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))))
    split = placed.join(large, ["t", "bucket"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    cells = split.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keyed = cells.select("t", "bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "rep", "n", "vector", "hashes")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def whole(last: bool):
            rows = pa.Table.from_batches(held).combine_chunks()
            key = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in ("t", "bucket", "low", "high")])
            ends = [*(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1), len(rows)]
            out, at = ([], [], []), 0
            for end in ends if last else ends[:-1]:
                if end - at > 1:
                    part = rows.slice(at, end - at)
                    x = np.stack([unit(v.as_buffer()) for v in part.column("vector")])
                    h = part.column("hashes").combine_chunks().flatten().to_numpy().reshape(len(x), -1)
                    found = _bucket_links(int(key[0, at]), *(part.column(c).to_numpy().copy() for c in ("rep", "n", "block")), bool(key[2, at] != key[3, at]), x, h, cosine)
                    for mine, new in zip(out, found, strict=True):
                        mine.append(new)
                at = end
            held[:] = rows.slice(at).to_batches()
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["a", "b", "links"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                if sum(b.num_rows for b in held) >= BLOCK:
                    yield from whole(False)
        if held:
            yield from whole(True)

    parts = shuffle_partitions(spark)
    key = ["t", "bucket", "low", "high"]
    return keyed.repartition(parts, *key).sortWithinPartitions(*key).mapInArrow(meet, "a long, b long, links long")


def link_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors(vec_id, embedding)``.

    Two rows are linked if the cosine of their embeddings in double precision reaches ``cosine``; each
    link found is exact, and a pair exactly at the threshold is found with probability 1 - MISS or more.
    Equal embeddings are one representative, whatever their number, so copies are never paired up.

    Vectors are scaled first, so that finite ones of any size are compared. Embeddings that are null, empty or zero, or hold null or non-finite values, link with nothing; so do
    rows without a vec_id, whose component is null. Lengths may differ; different lengths don't link. Rows that
    repeat a vec_id count as vectors of their own. An empty table gives no rows. Other columns are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"))
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    nonzero = F.exists("embedding", lambda x: x != 0)
    valid = F.coalesce(F.col("vec_id").isNotNull() & ~odd & nonzero, F.lit(False))
    rows = materialize(rows.withColumn("key", F.when(valid, F.col("embedding"))).select("vec_id", "key"))
    reps = materialize(rows.where("key IS NOT NULL").groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")).withColumnRenamed("key", "embedding"))
    count = reps.count()
    points = materialize(hashed(reps, *plan(count, cosine)))
    found = materialize(vector_links(points, cosine))
    totals = found.groupBy("a").agg(F.sum("links").alias("links"))
    named = connected_components(found.select("a", "b"))
    known = materialize(reps.join(totals, F.col("rep") == F.col("a"), "left").drop("a").join(named, F.col("rep") == F.col("node"), "left").select(F.col("embedding").alias("rep_key"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    out = rows.join(known, F.col("key") == F.col("rep_key"), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
