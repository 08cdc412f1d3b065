"""Positions over a whole table, without gathering it in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarrymill.session import checkpointed


def positions(df: DataFrame, order: list[str], out: str = "before", then: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Adds the number of earlier rows.

    `then` makes other rows of each, in place and in order, before they are numbered: ranges are found by a pass over `df`,
    in which it has no part.

    Rows are dealt by ranges of `order`, sorted and kept with Spark's own row numbers, whose upper part is the range and
    whose lower one the place in it; the ranges' counts, one row each, are summed and sent to all.  There is one shuffle.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = then(dealt) if then else dealt
    dealt = checkpointed(dealt.withColumn("__row", F.monotonically_increasing_id()))
    part, place = F.shiftright("__row", 33), F.col("__row").bitwiseAND((1 << 33) - 1)
    counts = dealt.groupBy(part.alias("__of")).agg(F.count("*").alias("n"))
    earlier = Window.orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)  # over a row for each range
    base = counts.select("__of", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__base"))
    placed = dealt.join(F.broadcast(base), part == F.col("__of"))
    return placed.withColumn(out, (F.col("__base") + place).cast("bigint")).drop("__row", "__of", "__base")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deals out the rows of a scan that has fewer tasks than there are cores; a scan that has as many is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
