"""Sessions, and the one way to cut a lineage."""

from __future__ import annotations

import tempfile

#: Where Spark runs in one process, or on this machine alone.
_LOCAL = ("local", "local-cluster")

from pyspark.sql import DataFrame, SparkSession


def build(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName("quarrymill")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir.  Where it is unset a local session, as in tests, gets a temporary one; a cluster
    has no folder that all of it sees but the one it names, so that there it is an error."""
    found = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not found:
        if spark.sparkContext.master.split("[")[0] not in _LOCAL:
            raise ValueError("spark.checkpoint.dir is not set; it names a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="checkpoint-")
        spark.conf.set("spark.checkpoint.dir", found)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, kept in the shared folder (`checkpoint_dir`)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
