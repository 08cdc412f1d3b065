"""Bounded samples of labelled documents, and calibration of scores."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.work import crc32_of_id


def held_out(modulus: int, remainder: int, column: str = "doc_id") -> F.Column:
    return crc32_of_id(column) % modulus == remainder


#: Bytes of text that examples have in all, at most; what is learned from them is sent to workers.
EXAMPLE_BYTES = 48 << 20


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, out: F.Column, bound: int, size: int = EXAMPLE_BYTES
) -> DataFrame:
    """doc_id, text and y of labelled documents, in the order of a hash of their ids, as many as fit both bounds: at most
    `bound` ids, and texts of at most `size` bytes; none that is held out.

    An id that has several labels counts as labelled 1 if one of them is 1.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~out)
    chosen = known.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    joined = texts.join(F.broadcast(chosen), "doc_id")  # `bound` rows of two numbers at most
    sizes = joined.groupBy("doc_id").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("n"))
    sizes = sizes.orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()  # as many
    total = np.cumsum(sizes.column("n").to_numpy())
    if not len(total) or total[-1] <= size:
        return joined
    over = sizes.column("doc_id").to_numpy()[total > size]
    gone = docs.sparkSession.createDataFrame(pa.table({"doc_id": over}))
    return joined.join(F.broadcast(gone), "doc_id", "left_anti")


def platt(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """a, b of 1 / (1 + exp(-(a * margin + b))), with smoothed targets, by Newton's method."""
    n1, n0 = float(y.sum()), float((1 - y).sum())
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones(len(margins))], 1)
    w = np.array([0.0, np.log((n1 + 1) / (n0 + 1))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (target - p) - 1e-6 * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 1e-6)), float(w[1])


def isotonic(x: np.ndarray, positive: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps (x, rate) that fit counts by x; pools adjacent violators."""
    order = np.argsort(x, kind="stable")
    stack: list[list[float]] = []
    for i in order.tolist():
        if stack and stack[-1][0] == x[i]:
            stack[-1][1] += positive[i]
            stack[-1][2] += total[i]
        else:
            stack.append([float(x[i]), float(positive[i]), float(total[i])])
        while len(stack) > 1 and stack[-2][1] * stack[-1][2] >= stack[-1][1] * stack[-2][2]:
            last = stack.pop()
            stack[-1] = [last[0], stack[-1][1] + last[1], stack[-1][2] + last[2]]
    return np.array([s[0] for s in stack]), np.array([(s[1] + 0.1) / (s[2] + 0.2) for s in stack])
