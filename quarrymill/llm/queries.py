"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarrymill.llm import bpe, embeddings, minhash, packing, quality_classifier, quality_rules, substring_dedup, suffix_dedup, tokens, toxicity
from quarrymill.llm import sql as S


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": toxicity.op1,
        "op2_embedding_dedup": embeddings.op2,
        "op3_substring_dedup": substring_dedup.op3,
        "op4_quality_classifier": quality_classifier.op4,
        "op5_token_ids": tokens.op5,
        "op6_minhash": minhash.op6,
        "op7_packing": packing.op7,
        "op8_suffix_dedup": suffix_dedup.op8,
        "op9_bpe": bpe.op9,
        "op10_quality_rules": quality_rules.op10,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_embedding_dedup": S.EMBEDDINGS,
        "op3_substring_dedup": S.SUBSTRINGS,
        "op6_minhash": S.MINHASH,
        "op8_suffix_dedup": S.SUFFIXES,
        "op10_quality_rules": quality_rules.OP10_SQL,
    }
