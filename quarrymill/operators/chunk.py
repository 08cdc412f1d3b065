"""Overlapping chunks of paragraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.functions import text as T
from quarrymill.operators.order import positions


def chunked(c: Column, target: int = 2500, overlap: int = 300) -> Column:
    """Paragraphs folded to chunks: one is closed where the next paragraph would take it over the target, and the next
    begins with its last characters."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("now"))

    def step(state: Column, paragraph: Column) -> Column:
        now = state["now"]
        closes = (F.length(now) + F.length(paragraph) > target) & (now != "")
        tail = F.when(F.length(now) > overlap, F.right(now, F.lit(overlap))).otherwise(now)
        joined = F.when(now != "", F.concat(now, F.lit("\n\n"), paragraph)).otherwise(paragraph)
        return F.struct(
            F.when(closes, F.concat(state["done"], F.array(T.strip(now)))).otherwise(state["done"]).alias("done"),
            F.when(closes, F.concat(tail, F.lit("\n\n"), paragraph)).otherwise(joined).alias("now"),
        )

    def finish(state: Column) -> Column:
        rest = T.strip(state["now"])
        return F.when(state["now"] != "", F.concat(state["done"], F.array(rest))).otherwise(state["done"])

    return F.aggregate(F.split(c, "\n\n", -1), start, step, finish)


def chunk_documents(docs: DataFrame, target: int = 2500, overlap: int = 300) -> DataFrame:
    """doc_id, text -> a row per chunk, with its place in the document and, from 1, over all documents."""

    def each(rows: DataFrame) -> DataFrame:
        folded = rows.select("doc_id", chunked(F.col("text"), target, overlap).alias("chunks"))
        return folded.select("doc_id", F.size("chunks").cast("bigint").alias("total_chunks"), F.posexplode("chunks").alias("at", "text"))

    return positions(docs.select("doc_id", "text"), ["doc_id"], then=each).select(
        "doc_id", (F.col("before") + 1).alias("chunk_id"), (F.col("at") + 1).cast("bigint").alias("chunk_index"), "total_chunks", "text",
        T.word_count(F.col("text")).alias("word_count"),
    )
