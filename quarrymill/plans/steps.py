"""The pipeline's steps by number, and which of those asked for can run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarrymill.plans.queries import QUERIES

#: Number, query and what it does.
STEPS: dict[int, tuple[str, str]] = {
    1: ("doc_clean_filter", "extract and clean documents"), 2: ("chunk_documents", "cut chunks"), 3: ("qa_generation_gate", "gate generated pairs"),
    4: ("qa_sorted_final", "gate, deduplicate and sort"), 5: ("profile_lengths", "profile"), 6: ("translate_pairs", "translate pairs"),
    7: ("augment_pairs", "vary pairs"), 8: ("comprehensive_stats", "merge languages"), 9: ("cleaning_metadata", "clean and publish"),
}


def reachable(asked: list[int], steps: dict[int, tuple[str, str]] = STEPS) -> dict[int, bool]:
    """Whether each step asked for is a known one whose query is there."""
    return {n: n in steps and steps[n][0] in QUERIES for n in asked}


def run(spark: SparkSession, sf_dir: str, asked: list[int], sink: Callable[[str, DataFrame], None]) -> dict[int, bool]:
    """Gives each step's rows to `sink` and stops at the first that can't run."""
    done = {}
    for n, there in reachable(asked).items():
        done[n] = there
        if not there:
            break
        name = STEPS[n][0]
        sink(name, QUERIES[name](spark, sf_dir))
    return done
