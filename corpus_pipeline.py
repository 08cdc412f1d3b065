"""A corpus pipeline: documents in, packed pieces of training sequences out.

Each stage works on what the one before it kept, which is written as Parquet and read again; all but the last return the
columns of `documents`.

Edge cases: a null or empty text is scored like texts without known words and fails the rules; repeated rows are near
duplicates of one another, of which one stays; rows with equal or null ids are rows of their own; very long texts are
one row like others; ties are broken by id, then by place; other columns, whatever their names, pass through the first
four stages; an empty table gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarrymill.llm import minhash, packing, quality_rules, suffix_dedup, toxicity
from quarrymill.llm.work import Work, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicated(docs, width=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic), ("quality_rules", apply_rules), ("minhash", drop_near_duplicates),
    ("suffix_dedup", cut_repeats), ("packing", pack),
]

#: Difference covers, learned scores and tokenizers have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Work(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        docs = work.table(stage(spark, docs, sf_dir), name)
        if before:
            work.drop(before)
        before = name
    return work.result(docs)
