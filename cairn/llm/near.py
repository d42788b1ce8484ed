"""Near-duplicates by the Jaccard similarity of word shingles: SimHash balls and MinHash bands propose, exact sets decide.

Documents of equal shingle sets are one node. Nodes whose SimHash fingerprints are links of the ball hashing, or that
share a band of their MinHash signatures, are joined to candidate components, as stars; a component of links
at the threshold lies within one of them, but for pairs that neither proposes. First the stars' own pairs are
verified, which settles most components. In those that still fall apart, the nodes outside the largest part are dealt
into blocks of bounded size, and every node is compared with every block. No task holds more sets than a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.components import connected_components
from cairn.llm.simhash import DISTANCE, bit_counts, fingerprint_links, majority
from cairn.llm.support import bounded, materialize, shuffle_partitions

SHINGLE = 5
#: Similarity at which two documents are linked, as a fraction so that it is compared in whole numbers.
SIMILAR = (4, 5)
#: A pair at the threshold shares no band with probability (1 - 0.8 ** 4) ** 16 = 0.0002.
BANDS, ROWS = 16, 4
SEED = 42
_rng = np.random.default_rng(SEED)
_XOR, _ODD = (_rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) for _ in range(2))
_ODD = _ODD * np.uint64(2) + np.uint64(1)
#: Shingles whose permuted values are held at a time.
SLICE = 4096
#: Nodes of a block that others are compared with, and nodes that one task compares with one block.
BLOCK = 64
SLOT = 128


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of ASCII-lower-cased word shingles; a text of fewer words is one shingle, one of none has none."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - SHINGLE + 1)
    return np.unique(np.array([xxhash.xxh64_intdigest(b" ".join(words[i : i + SHINGLE]), SEED) for i in range(n)], np.uint64))


def bands(grams: np.ndarray) -> list[int]:
    """A signed key for each band of the MinHash signature; none for an empty set."""
    if not len(grams):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(grams), SLICE):
        least = np.minimum(least, ((grams[i : i + SLICE, None] ^ _XOR) * _ODD).min(axis=0))
    return [int(np.uint64(xxhash.xxh64_intdigest(least[k * ROWS : (k + 1) * ROWS].tobytes(), k)).view(np.int64)) for k in range(BANDS)]


def node(grams: np.ndarray) -> str:
    return xxhash.xxh128_hexdigest(grams.tobytes())


class Hubs:
    """An inverted index of some nodes' sets, with which other sets are compared one at a time."""

    def __init__(self, names: list[str], labels: list[str], sets: list[np.ndarray]):
        self.names, self.labels = names, labels
        self.size = np.array([len(s) for s in sets])
        self.gram, at = np.unique(np.concatenate(sets), return_inverse=True)
        order = np.argsort(at, kind="stable")
        self.holder = np.repeat(np.arange(len(sets)), self.size)[order]
        self.start = np.searchsorted(at[order], np.arange(len(self.gram) + 1))

    def similar(self, name: str, label: str, grams: np.ndarray) -> list[str]:
        """The hubs at the threshold, one for each label that isn't the set's own."""
        at = np.searchsorted(self.gram, grams)
        at = at[self.gram[np.minimum(at, len(self.gram) - 1)] == grams] if len(self.gram) else at[:0]
        n = self.start[at + 1] - self.start[at]
        places = np.repeat(self.start[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
        shared = np.bincount(self.holder[places], minlength=len(self.names))
        least, most = SIMILAR
        found = {}
        for k in np.flatnonzero((shared > 0) & ((most + least) * shared >= least * (self.size + len(grams)))):
            if self.names[k] != name and self.labels[k] != label:
                found.setdefault(self.labels[k], self.names[k])
        return list(found.values())


def _sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, node, fp, bands): fp is the SimHash of the distinct shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = (shingles(batch.column(1)[i].as_py()) for i in range(batch.num_rows))
            rows = [(node(s), np.uint64(majority(bit_counts(s), len(s))).view(np.int64), bands(s)) for s in sets]
            nodes, fps, keys = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.string()), pa.array(fps, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "node", "fp", "bands"])

    return docs.mapInArrow(run, "doc_id long, node string, fp long, bands array<long>")


def _sets(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                sets = [shingles(t.as_py()) for t in batch.column(0)[i : i + 64]]
                yield pa.RecordBatch.from_arrays([pa.array([node(s) for s in sets], pa.string()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "grams"])

    return docs.select("text").mapInArrow(run, "node string, grams binary")


def _verified(hubs: DataFrame, members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) at the threshold between the members and hubs of each cell; both are (cell, node, label), few hubs to a cell.

    Pairs of one label are left out, and a member gets one link for each label among its cell's hubs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, names, labels, own, index = None, [], [], [], None
        for batch in batches:
            links = []
            for i in range(batch.num_rows):
                cell, role, name, label = (batch.column(k)[i].as_py() for k in range(4))
                grams = np.frombuffer(batch.column(4)[i].as_buffer(), np.uint64)
                if cell != held:
                    held, names, labels, own, index = cell, [], [], [], None
                if role == 0:
                    names.append(name)
                    labels.append(label)
                    own.append(grams.copy())
                elif names:
                    index = index or Hubs(names, labels, own)
                    links += [(name, hub) for hub in index.similar(name, label, grams)]
            a, b = zip(*links, strict=True) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], names=["a", "b"])

    rows = hubs.withColumn("role", F.lit(0)).unionByName(members.withColumn("role", F.lit(1))).join(sets, "node").select("cell", "role", "node", "label", "grams")
    parts = shuffle_partitions(sets.sparkSession)
    return rows.repartition(parts, "cell").sortWithinPartitions("cell", "role").mapInArrow(run, "a string, b string")


def _dealt(column: str, n: str, size: int) -> Column:
    """A number below ceil(n / size) for each row."""
    return F.pmod(F.xxhash64(column), F.ceil(F.col(n) / size)).cast("int")


def _spread(n: str, size: int) -> Column:
    """All the numbers that ``_dealt`` gives."""
    return F.explode(F.sequence(F.lit(0), F.ceil(F.col(n) / size).cast("int") - 1))


def _star_links(stars: DataFrame, sets: DataFrame) -> DataFrame:
    """Verified links of ``stars(a, b)``, where b is the hub; a crowded hub meets its members in several cells."""
    sizes = materialize(stars.groupBy("b").agg(F.count("*").alias("n")))
    cell = F.concat_ws("/", "b", "slot").alias("cell")
    members = stars.join(sizes, "b").withColumn("slot", _dealt("a", "n", SLOT)).select(cell, F.col("a").alias("node"), F.col("a").alias("label"))
    hubs = sizes.withColumn("slot", _spread("n", SLOT)).select(cell, F.col("b").alias("node"), F.col("b").alias("label"))
    return _verified(hubs, members, sets)


def _open_links(candidates: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Verified links between nodes of one candidate component and different labels."""
    named = candidates.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    parts = materialize(named.groupBy("candidate", "label").agg(F.count("*").alias("n")))
    whole = parts.groupBy("candidate").agg(F.sum("n").alias("n"), F.count("*").alias("labels"), F.max_by("label", F.struct("n", "label")).alias("largest"), F.max("n").alias("most"))
    open_ = materialize(whole.where("labels > 1").select("candidate", "largest", "n", (F.col("n") - F.col("most")).alias("outer_n")))
    inside = named.join(open_, "candidate")
    # every node meets every block of nodes outside the largest part; blocks are copied to slots of nodes
    placed = inside.withColumn("slot", _dealt("node", "n", SLOT)).withColumn("block", _spread("outer_n", BLOCK))
    cell = F.concat_ws("/", "candidate", "block", "slot").alias("cell")
    members = placed.select(cell, "node", "label")
    outer = inside.where("label <> largest").withColumn("block", _dealt("node", "outer_n", BLOCK)).withColumn("slot", _spread("n", SLOT))
    return _verified(outer.select(cell, "node", "label"), members, sets)


def similar_components(docs: DataFrame) -> DataFrame:
    """(doc_id, component_id) for every row of ``docs(doc_id, text)``.

    component_id is the smallest doc_id reachable by links between documents whose sets of five-word
    shingles have a Jaccard similarity of 0.8 at least. Null and empty texts have equal, empty sets. Repeated rows each
    return a row. A null doc_id keeps its row and can't be a component's name; a component of such rows alone
    has a null id. Other columns are ignored. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    marked = materialize(_sketches(docs))
    nodes = materialize(marked.groupBy("node").agg(F.min("doc_id").alias("first"), F.first("fp").alias("fp"), F.first("bands").alias("bands")).where("size(bands) > 0"))
    placed = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    heads = placed.groupBy("band", "key").agg(F.min("node").alias("head"), F.count("*").alias("n")).where("n > 1")
    banded = placed.join(heads, ["band", "key"]).select(F.col("node").alias("a"), F.col("head").alias("b"))
    leads = materialize(nodes.groupBy("fp").agg(F.min("node").alias("lead")))
    balls = fingerprint_links(leads.select("fp"), DISTANCE).withColumnsRenamed({"a": "x", "b": "y"})
    near = balls.join(leads.select(F.col("fp").alias("x"), F.col("lead").alias("a")), "x").join(leads.select(F.col("fp").alias("y"), F.col("lead").alias("b")), "y")
    equal = nodes.join(leads, "fp").select(F.col("node").alias("a"), F.col("lead").alias("b"))
    stars = materialize(banded.unionByName(near.select("a", "b")).unionByName(equal).where("a <> b").distinct())

    candidates = materialize(connected_components(stars).withColumnRenamed("component", "candidate"))
    wanted = bounded(materialize(nodes.join(candidates, "node").select(F.col("first").alias("doc_id")).where("doc_id IS NOT NULL").distinct()))
    texts = docs.join(wanted, "doc_id", "left_semi").unionByName(docs.where("doc_id IS NULL"))
    sets = materialize(_sets(texts).join(bounded(candidates.select("node")), "node", "left_semi").dropDuplicates(["node"]))
    labels = materialize(connected_components(_star_links(stars, sets)).withColumnRenamed("component", "label"))
    more = materialize(_open_links(candidates, labels, sets))
    label_of = lambda end: labels.select(F.col("node").alias(end), F.col("label").alias(f"label_{end}"))
    joined = more.join(label_of("a"), "a", "left").join(label_of("b"), "b", "left").select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    merged = materialize(connected_components(joined).select(F.col("node").alias("label"), F.col("component").alias("merged")))

    all_nodes = marked.groupBy("node").agg(F.min("doc_id").alias("first"))
    named = all_nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")).join(merged, "label", "left")
    named = materialize(named.select("node", "first", F.coalesce("merged", "label").alias("component")))
    least = materialize(named.groupBy("component").agg(F.min("first").alias("component_id")))
    lookup = materialize(named.join(least, "component").select("node", "component_id"))
    return marked.join(lookup, "node").select("doc_id", "component_id")
