"""Staged tables in the folder that all executors share, and the helpers that iterative operators need."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm import kernels
from quarrymill.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which a cluster has to name; a local session, as in tests, gets a temporary one."""
    return checkpoint_dir(spark)


#: Bytes of an Arrow batch, where the session names no bound: texts vary a thousandfold in length, so that a bound on rows
#: alone is none on memory.  A longer text is a batch of its own.
_BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


class Work:
    """Tables of one run of an operator.  They cut the lineage: a lost executor costs no more than the step it was at.

    `result` keeps an operator's rows by a reliable checkpoint and deletes the staged tables.  Spark's cleaner deletes the
    checkpoint with the DataFrame where the session has spark.cleaner.referenceTracking.cleanCheckpoints, as those of
    `session.build` do; else it stays in the shared folder, whose owner clears it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        if spark.conf.get(_BATCH[0], None) is None:
            spark.conf.set(*_BATCH)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        schema = df.schema
        del df
        self.release()
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(f"{self.root}/{name}")

    def result(self, df: DataFrame) -> DataFrame:
        out = df.checkpoint(eager=True)
        self.close()
        return out

    def close(self) -> None:
        self._delete(self.root)
        self.release()

    def release(self) -> None:
        """Lets Spark's cleaner drop the shuffle files of finished steps, which it does once their plans are garbage."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def components(work: Work, edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for each node of the edges (a, b): root is the smallest node that links reach; roots have no row.

    Every round points each node at its smallest neighbour and its other neighbours at that one, then halves the paths
    by one step of pointer jumping, until each node has one parent and no parent has one.  Groups are never gathered:
    a star's centre costs one row per leaf, which adaptive execution splits.  Null ends and loops are no links.
    """
    state = work.table(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("a is not null and b is not null and u <> v").distinct(),
        f"{name}-0",
    )
    step = 0
    while True:
        low = state.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        near = (
            state.join(low, "u")
            .select("u", "v", "m")
            .select(F.explode(F.array(
                F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
            )).alias("e"))
            .select("e.*").where("u <> v").distinct()
        )
        near = work.table(near, f"{name}-near-{step}")
        up = near.groupBy(F.col("u").alias("p")).agg(F.min("v").alias("q"), F.count("*").alias("n"))
        moved = near.join(up, near.v == up.p, "left")
        after = work.table(
            moved.select("u", F.coalesce("q", "v").alias("v"), F.col("q").isNotNull().alias("jumped")).distinct(),
            f"{name}-{step + 1}",
        )
        work.drop(f"{name}-{step}", f"{name}-near-{step}")
        done = after.agg(F.max("jumped"), F.count("*"), F.count_distinct("u")).first()
        state = after.select("u", "v")
        step += 1
        if not done[0] and done[1] == done[2]:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, least: int = 1) -> Iterator[pa.Table]:
    """Cuts a partition that is sorted by `key` where the key changes; each table holds whole groups of `least` rows."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < least:
            continue
        whole = pa.Table.from_batches(held).combine_chunks()
        keys = whole.column(key).to_numpy()
        cut = len(keys) - 1
        while cut > 0 and keys[cut - 1] == keys[-1]:
            cut -= 1
        if cut:
            yield whole.slice(0, cut)
            held, rows = whole.slice(cut).to_batches(), whole.num_rows - cut
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def arrow_rows(df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Maps every Arrow batch to one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = make(batch)
            if out is not None:
                yield out

    return df.mapInArrow(run, schema)


#: Tables that tasks leave in their Python worker for later ones.
WORKER_TABLES: list[dict] = [kernels._powers]


def release_memory() -> None:
    """Gives a Python worker's free memory back at the end of a task: workers stay, and the next stage may be the JVM's.

    Tables that earlier tasks left, such as a tokenizer's, go too.
    """
    for left in WORKER_TABLES:
        left.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def tidy(make: Callable) -> Callable:
    """The same map over batches, which gives its memory back at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from make(batches)
        release_memory()

    return run


def crc32_of_id(column: str = "doc_id") -> F.Column:
    """crc32 of the id's decimal text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))
