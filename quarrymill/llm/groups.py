"""What operators on pairs share: groups that are dealt to tasks in blocks, and the ids of components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.work import Work


def in_blocks(rows: DataFrame, key: str, uid: str, blocks: Column) -> DataFrame:
    """Adds `task`: rows of one `key` that fit into one block share a task, larger groups have a task for each pair of
    blocks, so that any two rows meet in one task and no task holds more than two blocks."""
    block = F.pmod(F.xxhash64(F.lit(7), F.col(uid)), F.col("n_blocks"))
    spread = rows.withColumn("n_blocks", F.greatest(blocks.cast("bigint"), F.lit(1).cast("bigint"))).withColumn("block", block)
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_blocks") - 1)))
    pair = F.xxhash64(F.col(key), F.least("block", "other"), F.greatest("block", "other"))
    return spread.withColumn("task", F.when(F.col("n_blocks") == 1, F.col(key)).otherwise(pair)).drop("n_blocks", "block", "other")


def local_roots(links: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the first row that links reach."""
    n = len(links)
    root = np.full(n, -1)
    for i in range(n):
        if root[i] >= 0:
            continue
        root[i] = i
        front = np.array([i])
        while len(front):
            front = np.flatnonzero(links[front].any(0) & (root < 0))
            root[front] = i
    return root


def with_smallest(work: Work, rows: DataFrame, id_column: str) -> DataFrame:
    """Adds component_id, the smallest id of the rows with the same `root`; kept, whether that is the row's own id; and
    stays, whether the row is the one of them that stays: the first by id (nulls last) and uid.

    The groups' first rows are kept, so that the join back has them as they are and a large group is split over tasks."""
    first = F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), F.col("uid").alias("uid"))
    low = work.table(rows.groupBy(F.col("root").alias("of")).agg(F.min(first).alias("low")), "smallest")
    return rows.join(low, rows.root == low.of).withColumns(
        {"component_id": F.col("low.id"), "kept": F.col(id_column).eqNullSafe(F.col("low.id")), "stays": F.col("uid") == F.col("low.uid")}
    ).drop("of", "low")
