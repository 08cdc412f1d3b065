"""Nearest vectors of a stated query set, block against block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarrymill.session import checkpointed


#: Query blocks in all tasks at once, up to which they are sent there; more are joined to the vectors' blocks by a shuffle.
SENT_BLOCKS = 64


def _blocks(rows: DataFrame, size: int, ids: str, data: str) -> DataFrame:
    """Blocks of vectors of one length; rows without a usable vector (null, empty, or with a null) are left out."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame = frame[frame["id"].notna()]
            for n in sorted(set(frame["n"])):
                of = frame[frame["n"] == n]
                for i in range(0, len(of), size):
                    part = of.iloc[i : i + size]
                    x = np.stack([np.asarray(v, np.float64) for v in part["v"]])
                    yield pd.DataFrame({ids: [part["id"].to_numpy(np.int64).tobytes()], data: [x.tobytes()], "dim": [n]})

    usable = rows.where("v is not null and size(v) > 0 and not exists(v, x -> x is null)").select("id", "v", F.size("v").alias("n"))
    return usable.mapInPandas(run, f"{ids} binary, {data} binary, dim int")


def cosine_topk(vectors: DataFrame, queries: DataFrame, k: int = 5, size: int = 512) -> DataFrame:
    """query, id, cosine, rank: for each query its k nearest others of the same length, by the cosine to nine places and
    the smaller id among equals.  Zero vectors have a cosine of zero; null vectors, and those with nulls, are left out.

    The stated queries are held in blocks against blocks of all vectors; each block of vectors gives k rows a query.
    """
    left, right = _blocks(queries, size, "qi", "qv"), _blocks(vectors, size, "ii", "iv")
    left = checkpointed(left.withColumn("q", F.monotonically_increasing_id()))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                q, i = np.frombuffer(r.qi, np.int64), np.frombuffer(r.ii, np.int64)
                x, y = (np.frombuffer(v).reshape(len(n), -1) for v, n in ((r.qv, q), (r.iv, i)))
                norms = np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(y, axis=1)[None]
                cos = np.where(norms > 0, x @ y.T / np.where(norms > 0, norms, 1), 0.0)
                cos[q[:, None] == i[None]] = -np.inf
                best = np.lexsort((np.broadcast_to(i, cos.shape), -np.round(cos, 9)), axis=1)[:, :k]
                rows = np.repeat(np.arange(len(q)), best.shape[1])
                out = pd.DataFrame({"query": q[rows], "id": i[best.ravel()], "cosine": cos[rows, best.ravel()]})
                yield out[np.isfinite(out["cosine"])]

    if left.count() <= SENT_BLOCKS:
        both = right.join(F.broadcast(left), "dim")
    else:  # each block of vectors goes to the task of each block of queries of its length
        at = left.select("q", F.col("dim").alias("of"))
        both = right.join(at, F.col("dim") == F.col("of")).drop("dim", "of").join(left, "q")
    found = both.select("qi", "qv", "ii", "iv").mapInPandas(run, "query bigint, id bigint, cosine double")
    order = Window.partitionBy("query").orderBy(F.desc(F.round("cosine", 9)), "id")
    return found.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= k)
