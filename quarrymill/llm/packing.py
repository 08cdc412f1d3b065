"""Mixture-controlled packing by deficit round-robin.

Each source is a queue of its documents in ascending doc_id.  In each round, which is one window long, every queue is
granted a quantum, its share of a window, and sends a packet of that many tokens, cut out of its documents wherever it
ends; queues whose quantum is below LEAST_PACKET save their grants until they cover a packet of that size.  What is
granted and not sent (fractions of a token, or of a packet) is the queue's deficit, carried on.  With queues that wait
all the time (all documents are there from the start) a packet's round has a closed form, the tokens through its end
over the quantum, rounded up, so that the rounds of all windows are found in parallel and deficits carry over windows
and partitions alike.  Packets in order of round and source form one stream that is cut at every window, so that only
the last window can be short, and every window holds the target proportions to a token for each source (to a packet
for sources with small shares), as long as no queue is empty.

Shares are the sources' token counts unless given; a queue that runs empty leaves its share to the others.

Edge cases: a null or empty text is the end id alone; a null source is a source of its own; documents with equal or
null ids are packed each by itself, in the order of their texts' places in the input; very long texts are cut like
others; other columns do not matter; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarrymill.llm.tokens import END_ID, Encoder, default_vocabulary, text_parts
from quarrymill.llm.work import Work, table

WINDOW = 4096
LEAST_PACKET = 64
#: Rows of a table of sources or of tasks' sums up to which it is sent to all tasks; larger ones are joined by a shuffle.
SENT_ROWS = 100_000


def tokenized(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """uid, doc_id, queue, n, ids: little-endian integers, of 16 bits where all ids of the text fit, else of 32; `queue`
    is a hash of the source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, uid = Encoder.of(vocabulary), TaskContext.get().partitionId() << 33
        end = np.array([end_id], "<u4").tobytes()
        for whole in batches:
            for batch in text_parts(whole, "text"):
                found = [x + end for x in encoder.encode(batch.column("text").to_pylist())]
                ids = [np.frombuffer(x, "<u4") for x in found]
                rows = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(uid, uid + rows)), batch.column("doc_id"), batch.column("queue"),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([x.astype("<u2").tobytes() if x.max() < 65536 else x.tobytes() for x in ids], pa.binary()),
                    ],
                    ["uid", "doc_id", "queue", "n", "ids"],
                )
                uid += rows

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), queue_of(F.col("source").cast("string")).alias("queue"), "text"
    ).mapInArrow(run, "uid bigint, doc_id bigint, queue bigint, n bigint, ids binary")


def queue_of(source: F.Column) -> F.Column:
    return F.xxhash64(source.isNull(), source)


def _sent(small: DataFrame) -> DataFrame:
    """Marked to be sent to all tasks if it is small."""
    return F.broadcast(small) if small.limit(SENT_ROWS + 1).count() <= SENT_ROWS else small


def with_sums(work: Work, df: DataFrame, name: str, order: list[str], value: str, within: list[str]) -> DataFrame:
    """Adds `before`: the sum of `value` over the earlier rows of the same `within` (integers), in the order of `order`.

    Rows are dealt by ranges of `order` (which begins with `within`), so that a large group lies on many tasks; each
    task sums its own rows, and the sums of one task's groups, a few rows each, are summed and joined to them.
    """
    columns = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, total = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in within] or [np.zeros(n, np.int64)])
            values = batch.column(value).to_numpy()
            fresh = np.ones(n, bool)
            fresh[1:] = (keys[:, 1:] != keys[:, :-1]).any(0)
            if last is not None:
                fresh[0] = (keys[:, 0] != last).any()
            sums = np.concatenate([[total], total + np.cumsum(values)])
            first = np.maximum.accumulate(np.where(fresh, np.arange(n), -1))
            sums_before = sums[:-1] - np.where(first >= 0, sums[np.maximum(first, 0)], 0)
            last, total = keys[:, -1], int(sums_before[-1] + values[-1])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(np.full(n, part, np.int64)), pa.array(sums_before)],
                [*columns, "part", "local"],
            )

    schema = ", ".join(f"{c} {t}" for c, t in df.dtypes) + ", part bigint, local bigint"
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)
    dealt = work.table(dealt, name)
    each = dealt.groupBy(*within, "part").agg(F.sum(value).alias("n"))
    frame = Window.partitionBy(*within).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    keyed = {f"__{c}": F.col(c) for c in [*within, "part"]}
    base = each.withColumn("base", F.coalesce(F.sum("n").over(frame), F.lit(0))).withColumns(keyed).select(*keyed, "base")
    same = F.lit(True)
    for c in [*within, "part"]:
        same = same & dealt[c].eqNullSafe(base[f"__{c}"])
    return dealt.join(_sent(base), same).select(*columns, (F.col("base") + F.col("local")).alias("before"))


def pack(
    work: Work, docs: DataFrame, weights: dict[str, float] | None = None, window: int = WINDOW,
    vocabulary: str | None = None, end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: uid, doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, round, deficit.

    `deficit` is what was left of the queue's grants after the piece's packet.
    """
    tokens = work.table(tokenized(docs, vocabulary or default_vocabulary(), end_id), "tokens")
    lengths = tokens.select("queue", "doc_id", "uid", "n")
    waiting = with_sums(work, lengths, "queue", ["queue", "doc_id", "uid"], "n", ["queue"])
    totals = work.table(tokens.groupBy("queue").agg(F.sum("n").alias("total")), "totals")
    if weights is None:
        asked = F.col("total").cast("double")
    else:
        pairs = [x for k, w in weights.items() for x in (queue_of(F.lit(k)), F.lit(float(w)))]
        asked = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("queue")), F.lit(0.0)) if pairs else F.lit(0.0)
        asked = F.greatest(asked, F.lit(1e-6))  # sources without a share come last, but come
    every = totals.agg(F.sum(asked)).first()[0] or 1.0
    quanta = totals.select(F.col("queue").alias("of"), (asked * (window / every)).alias("quantum"))
    # Packet k of a queue has its tokens from floor(k * size) up to floor((k + 1) * size).
    cut = lambda k: F.floor((k) * F.col("packet") + 1e-9)
    packets = (
        waiting.join(_sent(quanta), F.col("queue") == F.col("of"))
        .withColumn("packet", F.greatest(F.col("quantum"), F.lit(float(min(LEAST_PACKET, window)))))
        .withColumn("k", F.explode(F.sequence(
            F.greatest(F.floor(F.col("before") / F.col("packet")) - 1, F.lit(0).cast("bigint")),
            F.floor((F.col("before") + F.col("n")) / F.col("packet")),
        )))
        .withColumn("from", F.greatest(F.col("before"), cut(F.col("k"))))
        .withColumn("through", F.least(F.col("before") + F.col("n"), cut(F.col("k") + 1)))
        .where(F.col("through") > F.col("from"))
        .withColumn("round", F.ceil((F.col("k") + 1) * F.col("packet") / F.col("quantum") - 1e-9).cast("bigint"))
        .select(
            "round", "queue", "through", "uid", (F.col("from") - F.col("before")).alias("start"),
            (F.col("through") - F.col("from")).alias("size"),
            F.greatest(F.lit(0.0), F.col("round") * F.col("quantum") - F.col("through")).alias("deficit"),
        )
    )
    stream = with_sums(work, packets, "stream", ["round", "queue", "through"], "size", [])
    cuts = F.sequence(F.expr(f"before div {window}"), F.expr(f"(before + size - 1) div {window}"))
    pieces = (
        stream.withColumn("sequence_id", F.explode(cuts))
        .withColumn("a", F.greatest(F.col("before"), F.col("sequence_id") * window))
        .withColumn("b", F.least(F.col("before") + F.col("size"), (F.col("sequence_id") + 1) * window))
        .select(
            "uid", (F.col("start") + F.col("a") - F.col("before")).alias("start"), (F.col("b") - F.col("a")).alias("length"),
            "sequence_id", (F.col("a") - F.col("sequence_id") * window).alias("offset"), "round", "deficit",
        )
    )
    names = ("start", "length", "sequence_id", "offset", "round", "deficit")
    whole = pieces.groupBy("uid").agg(F.collect_list(F.struct(*names)).alias("pieces"))  # no more than a text has
    joined = tokens.select("uid", "doc_id", "n", "ids").join(whole, "uid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = []
            pieces = batch.column("pieces")
            bounds, flat = pieces.offsets.to_numpy().tolist(), pieces.values.flatten()
            starts, sizes = flat[0].to_numpy().tolist(), flat[1].to_numpy().tolist()
            counts = batch.column("n").to_numpy().tolist()
            lo, hi = bounds[0], bounds[-1]
            owner = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            for i in range(batch.num_rows):
                data = batch.column("ids")[i].as_py()
                ids = np.frombuffer(data, "<u2" if len(data) == 2 * counts[i] else "<u4").astype("<u4").data.cast("B")
                crc += [zlib.crc32(ids[4 * starts[j] : 4 * (starts[j] + sizes[j])]) for j in range(bounds[i], bounds[i + 1])]
            columns = dict(zip(names, (x.slice(lo, hi - lo) for x in flat)))
            columns |= {k: batch.column(k).take(pa.array(owner)) for k in ("uid", "doc_id")}
            columns |= {"doc_tokens": batch.column("n").take(pa.array(owner)), "ids_crc32": pa.array(crc, pa.int64())}
            yield pa.RecordBatch.from_arrays([columns[c] for c in out], list(out))

    out = ("uid", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "round", "deficit")
    schema = ", ".join(f"{c} {'double' if c == 'deficit' else 'bigint'}" for c in out)
    return joined.mapInArrow(run, schema)


def packed(docs: DataFrame, **options) -> DataFrame:
    """`pack` with its rows kept and its staged tables deleted."""
    work = Work(docs.sparkSession, "packing")
    return work.result(pack(work, docs, **options).drop("uid"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
