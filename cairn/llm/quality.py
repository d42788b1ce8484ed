"""Quality classifier: naive Bayes support vectors over n-grams of bytes and of words.

Indicators of the byte n-grams of a text, and of which words of a word n-gram are equal, are scaled by the log-ratio of their smoothed class
counts, and a linear hinge-loss model of the scaled, length-normalised indicators is fitted by
dual coordinate descent. Margins become probabilities by a logistic fit on rows kept out of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.support import materialize

#: At most so many labelled rows are fitted on: those with the smallest hashes of their ids.
SAMPLE_ROWS = 6000
#: Of these, the first whose indicators take at most so many bytes in all (four each) go to the driver.
SAMPLE_BYTES = 256 << 20
#: Features are n-gram hashes modulo 2^FEATURE_BITS.
FEATURE_BITS = 18
GRAMS = (2, 3, 4)
#: Bytes of a text hashed at a time.
SLICE = 1 << 20
#: Word n-grams count by their pattern alone: which of their words are equal.
PATTERN_WORDS = 4


def patterns(words: list[bytes]) -> np.ndarray:
    """A number for every equality pattern that runs of 2 to PATTERN_WORDS words show."""
    same = {d: np.fromiter(map(eq, words, words[d:]), np.int64, max(0, len(words) - d)) for d in range(1, PATTERN_WORDS)}
    found = []
    for n in range(2, PATTERN_WORDS + 1):
        size = len(words) - n + 1
        if size > 0:
            code = np.full(size, n, np.int64)
            for i in range(1, n):
                for j in range(i):
                    code = 2 * code + same[i - j][j : j + size]
            found.append(np.unique(code))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def features(text: str | None) -> np.ndarray:
    """Sorted distinct feature numbers of a whole text."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    shift = np.uint32(32 - FEATURE_BITS)
    found = []
    for i in range(0, len(raw), SLICE):
        part = raw[i : i + SLICE + max(GRAMS) - 1].astype(np.uint32)
        for n in GRAMS:
            # a gram belongs to the slice it starts in
            size = min(SLICE, len(part) - n + 1)
            if size > 0:
                h = np.full(size, n, np.uint32)
                for k in range(n):
                    h = h * np.uint32(0x01000193) + part[k : k + size]
                found.append(np.unique((h * np.uint32(0x9E3779B1)) >> shift))
    if not found:
        return np.zeros(0, np.uint32)
    found.append(patterns(raw.tobytes().split()).astype(np.uint32) * np.uint32(0x85EBCA6B) >> shift)
    ordered = np.sort(np.concatenate(found))
    return ordered[np.r_[True, ordered[1:] != ordered[:-1]]]


@dataclass
class Model:
    """weights[f] is for indicator f of a text with n indicators, to be divided by sqrt(n)."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, found: np.ndarray) -> float:
        return float(self.weights[found].sum() / max(1, len(found)) ** 0.5 + self.bias)

    def score(self, found: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(found) + self.offset, -30, 30))))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    counts = np.ones((2, 1 << FEATURE_BITS))
    for found, y in zip(rows, labels, strict=True):
        counts[int(y), found] += 1
    counts /= counts.sum(axis=1, keepdims=True)
    return np.log(counts[1] / counts[0])


def dual_coordinate_descent(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, cost: float = 1.0, epochs: int = 15) -> tuple[np.ndarray, float]:
    """Weights and bias of a hinge-loss model with rows weighted so that both classes count alike."""
    y = np.where(labels > 0, 1.0, -1.0)
    share = np.array([(labels == 0).mean(), (labels == 1).mean()])
    limit = cost * 0.5 / share[labels.astype(int)]
    scaled = [ratios[f] / max(1, len(f)) ** 0.5 for f in rows]
    square = np.array([s @ s + 1 for s in scaled])
    alpha, w, bias = np.zeros(len(rows)), np.zeros(1 << FEATURE_BITS), 0.0
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            f, x = rows[i], scaled[i]
            gradient = y[i] * (w[f] @ x + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), limit[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[f] += step * x
                bias += step
                alpha[i] = new
    return w, bias


def logistic_fit(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton's method, with targets drawn in from 0 and 1."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.c_[margins, np.ones(len(margins))]
    theta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p) - 1e-6 * theta)
        theta += np.clip(step, -5, 5)
        if abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """Every fourth row is for the logistic fit, if it has both classes. With one class only, the score is its smoothed share."""
    calibrate = np.arange(len(rows)) % 4 == 3
    if len(rows) < 8 or min(np.bincount(labels[~calibrate], minlength=2)) == 0:
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        return Model(np.zeros(1 << FEATURE_BITS, np.float32), 0.0, 0.0, float(np.log(share / (1 - share))))
    learn = np.flatnonzero(~calibrate)
    chosen = [rows[i] for i in learn]
    ratios = log_count_ratios(chosen, labels[learn])
    w, bias = dual_coordinate_descent(chosen, labels[learn], ratios)
    model = Model((w * ratios).astype(np.float32), float(bias), 1.0, 0.0)
    if min(np.bincount(labels[calibrate], minlength=2)) < 3:
        model.slope = 2.0  # too few to fit on: the margin's sign decides
        return model
    margins = np.array([model.margin(rows[i]) for i in np.flatnonzero(calibrate)])
    model.slope, model.offset = logistic_fit(margins, labels[calibrate])
    return model


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on the labelled rows of the learning fold, at most ``sample_rows`` of them and ``sample_bytes`` of indicators.

    Fold 1 of crc32(doc_id as text) mod 3 is held out. Rows without a 0/1 label or an id are left out; of
    differing labels for one id the smaller counts, and of differing texts the one whose indicators sort first.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    labelled = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).where("quality IN (0, 1) AND doc_id IS NOT NULL").where(fold != 1)
    sample = labelled.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(batch.column(1)[i].as_py()).tobytes() for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.binary())], names=["doc_id", "quality", "found"])

    drawn = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "quality").mapInArrow(run, "doc_id long, quality int, found binary")
    drawn = materialize(drawn.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("found").alias("found")))
    ordered = drawn.select(F.xxhash64("doc_id").alias("h"), F.length("found").alias("size")).orderBy("h").collect()
    fits = int(np.searchsorted(np.cumsum([r.size for r in ordered]), sample_bytes, side="right"))
    rows = drawn.where(F.xxhash64("doc_id") <= ordered[fits - 1].h).collect() if fits else []
    rows.sort(key=lambda r: (r.doc_id * 0x9E3779B97F4A7C15 % (1 << 64), r.found))
    return fit([np.frombuffer(r.found, np.uint32) for r in rows], np.array([r.quality for r in rows], dtype=np.int64))


def score_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs(doc_id, text)``.

    score is the probability of label 1 from the text alone; predicted is 1 from 0.5 on. Null text
    scores as empty, and an empty text by the bias. A null doc_id is not held out. Repeated rows score alike.
    Without labels of both classes every score is the smoothed share of label 1. An empty table gives no
    rows. Other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.value.score(features(batch.column(1)[i].as_py())) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
