"""Quality by Naive Bayes support vectors.

Features are indicators of n-grams: of lower-case words (one and two), and of word shapes (one to three), where a shape
is a word's last byte, whether its first two bytes are capitals, and whether it repeats a word just before it; and of
the shares of repeated lines and of repeated five-word windows, in tenths.  Each is hashed to one of PLACES places.
Indicators are scaled by the log ratio of their smoothed counts in the two classes, and a linear model with hinge loss is
fitted on them by dual coordinate descent.  Margins of left-out folds calibrate the scores.

At most EXAMPLES labelled documents with EXAMPLE_BYTES of text in all are used, chosen by a hash of their ids.

Edge cases: a null or empty text, or one without words, has the bias alone; with one class or none among the examples
every score is the smoothed rate of label 1.  A label that is null is none; an id with several labels is good if one says
so.  Rows with equal or null ids are scored each by itself; very long texts are one row like others; other columns do not
matter; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm import kernels as K
from quarrymill.llm.labelled import held_out, platt, training_sample
from quarrymill.llm.work import table

EXAMPLES = 8_000
EXAMPLE_BYTES = 24 << 20
SHAPES = 1 << 16
PLACES = SHAPES + (1 << 18)
COST = 0.1
EPOCHS = 20


def features(part: K.Slice) -> list[np.ndarray]:
    """Sorted places of each document's features; place 0 is the bias."""
    starts, ends, lo, hi = part.words()
    hashes = part.word_hashes(starts, ends)
    n = len(starts)
    shape = part.data[ends - 1].astype(np.uint64) if n else np.zeros(0, np.uint64)
    capital = lambda b: (b >= 65) & (b <= 90)
    after = np.minimum(starts + 1, np.maximum(ends - 1, 0))
    if n:
        shape |= (capital(part.data[starts]) & capital(part.data[after]) & (ends - starts > 1)).astype(np.uint64) << K._U(8)
    place = np.arange(n)
    first = np.repeat(lo, hi - lo) if len(lo) else place
    for bit, reach in ((9, (1,)), (10, (2, 3, 4, 5))):
        again = np.zeros(n, bool)
        for r in reach:
            again[r:] |= (hashes[r:] == hashes[:-r]) & (place[r:] - r >= first[r:])
        shape |= again.astype(np.uint64) << K._U(bit)
    grams = []
    for size in (1, 2, 3):
        g = np.full(max(n - size + 1, 0), size, np.uint64)
        for i in range(size):
            g = K.mix(g * K._U(31) + shape[i : n - size + 1 + i])
        grams.append((size, (g % K._U(SHAPES - 64)).astype(np.int64) + 64))
    low = part.word_hashes(starts, ends, lower=True)
    for size in (1, 2):
        grams.append((size, (K.mix(K.word_windows(low, size) + K._U(size)) % K._U(PLACES - SHAPES)).astype(np.int64) + SHAPES))
    windows = K.word_windows(hashes, 5)
    breaks = np.flatnonzero(part.data == 10)
    line_sums = K.prefix(K._BYTES[part.data], K._BASE)
    out = []
    for i, (a, b) in enumerate(zip(lo.tolist(), hi.tolist())):
        found = [np.zeros(1, np.int64), *(g[a : b - size + 1] for size, g in grams if b - a >= size)]
        if b - a >= 5:
            m = b - a - 4
            found.append(np.array([1 + 10 * (m - len(np.unique(windows[a : b - 4]))) // m]))
        x, y = int(part.lo[i]), int(part.hi[i])
        cuts = breaks[np.searchsorted(breaks, x) : np.searchsorted(breaks, y)]
        if len(cuts) >= 3:
            begin, end = np.concatenate([[x], cuts + 1]), np.concatenate([cuts, [y]])
            full = end > begin
            lines = K.spans(line_sums, K._BASE, begin[full], end[full])
            if len(lines):
                found.append(np.array([16 + 10 * (len(lines) - len(np.unique(lines))) // len(lines)]))
        out.append(np.unique(np.concatenate(found)))
    return out


def ratios(rows: list[np.ndarray], y: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """Log ratios of the smoothed shares of each place in the two classes."""
    counts = [np.full(PLACES, smooth), np.full(PLACES, smooth)]
    for x, label in zip(rows, y.tolist()):
        counts[int(label)][x] += 1
    out = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    out[0] = 1.0
    return out


def descend(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, cost: float, epochs: int, seed: int = 0) -> np.ndarray:
    """Weights of the hinge-loss model over scaled indicators, by dual coordinate descent; classes weigh alike."""
    sign = np.where(y > 0, 1.0, -1.0)
    share = np.where(y > 0, y.mean(), 1 - y.mean())
    most = cost * 0.5 / share
    values = [scale[x] for x in rows]
    norms = np.array([v @ v for v in values])
    w, alpha = np.zeros(PLACES), np.zeros(len(rows))
    r = np.random.default_rng(seed)
    for _ in range(epochs):
        largest = 0.0
        for i in r.permutation(len(rows)).tolist():
            x, v = rows[i], values[i]
            slope = sign[i] * (w[x] @ v) - 1
            new = min(max(alpha[i] - slope / norms[i], 0.0), most[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                w[x] += step * v
                largest = max(largest, abs(new - alpha[i]) * norms[i])
                alpha[i] = new
        if largest < 0.01:
            break
    return w


@dataclass
class Model:
    weights: np.ndarray
    a: float
    b: float

    def score(self, x: np.ndarray) -> float:
        z = self.a * float(self.weights[x].sum()) + self.b
        return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def train(rows: list[np.ndarray], y: np.ndarray, folds: int = 3) -> Model:
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
        return Model(np.zeros(PLACES), 1.0, float(np.log(rate / (1 - rate))))
    margins = np.zeros(len(y))
    for k in range(folds):
        fit = [i for i in range(len(y)) if i % folds != k]
        ours = y[fit]
        if ours.min() == ours.max():
            continue
        scale = ratios([rows[i] for i in fit], ours)
        w = descend([rows[i] for i in fit], ours, scale, COST, EPOCHS) * scale
        for i in range(k, len(y), folds):
            margins[i] = w[rows[i]].sum()
    scale = ratios(rows, y)
    return Model(descend(rows, y, scale, COST, EPOCHS) * scale, *platt(margins, y))


def _featured(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [x for part in K.slices(batch.column("text")) for x in features(part)]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", out: F.Column | None = None, bound: int = EXAMPLES, size: int = EXAMPLE_BYTES) -> Model:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([x.astype(np.int32).tobytes() for x in _featured(batch)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), found], ["doc_id", "y", "x"])

    sample = training_sample(docs, labels, label, F.lit(False) if out is None else out, bound, size)
    rows = sample.mapInArrow(make, "doc_id bigint, y int, x binary").collect()  # bounded by `bound` and `size`
    rows.sort(key=lambda r: (r.doc_id, r.x))
    return train([np.frombuffer(r.x, np.int32).astype(np.int64) for r in rows], np.array([r.y for r in rows], float))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([model.score(x) for x in _featured(batch)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(make, "doc_id bigint, score double")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), held_out(4, 2)
    model = fit(docs, table(spark, sf_dir, "labels"), "quality", out)
    return scored(docs, model).select(
        "doc_id", F.coalesce(out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )
