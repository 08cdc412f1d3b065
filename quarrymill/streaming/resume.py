"""Incremental work: what is pending, and a file stream that keeps its place."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def pending(rows: DataFrame, processed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the processed ones; a null key is never processed."""
    return rows.join(processed.select(key).where(processed[key].isNotNull()).distinct(), key, "left_anti")


def resume(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, work: Callable[[DataFrame], DataFrame]) -> None:
    """Works on the files of `source` (JSON lines) that have not been, appends the results to `target` as Parquet, and
    returns when none is left.  A batch that is done again after a failure writes over its own part."""

    def write(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).json(source)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
