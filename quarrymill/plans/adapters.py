"""The driver tables in the shapes of the pipeline: documents, questions and answers, chats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarrymill.operators.order import spread

LANGUAGES = ("en", "fr")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").alias("idx"), "text", "source", "lang"), "doc_id")


def doc_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question of a document's first line, and the rest as its answer."""
    at = F.instr("text", "\n")
    rows = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"), "doc_id")
    return rows.select(
        F.col("doc_id").alias("idx"), F.substring_index("text", "\n", 1).alias("instruction"),
        F.when(at > 0, F.substring("text", at + 1, F.lit(2**31 - 1))).otherwise("").alias("response"), "source",
        F.concat(F.lit("topic"), F.col("doc_id") % 4).alias("category"),
        F.concat(F.lit("level"), F.col("doc_id") % 3).alias("difficulty"), F.col("lang").alias("language"),
    )


def conv_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant's turn that follows."""
    turns = table(spark, sf_dir, "conversations")
    user = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("instruction"))
    reply = turns.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    return user.join(reply, ["conv_id", "turn"])


def variations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each pair of a conversation with the next one, as if that were rewritten from it."""
    order = Window.partitionBy("conv_id").orderBy("turn")
    nxt = F.lead(F.struct("instruction", "response")).over(order)
    rows = conv_qa(spark, sf_dir).withColumn("next", nxt).where("next is not null")
    return rows.select(
        "conv_id", "turn", F.col("instruction").alias("original_q"), F.col("response").alias("original_a"),
        F.col("next.instruction").alias("q"), F.col("next.response").alias("a"),
    )


def chat(qa: DataFrame) -> DataFrame:
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    return qa.withColumn("messages", F.array(turn("user", "instruction"), turn("assistant", "response")))
