"""The cleaning pipeline of chat data: clean, reject with reasons, score, deduplicate, balance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.functions import gates as G
from quarrymill.functions import text as T
from quarrymill.operators import dedup, merge
from quarrymill.plans import adapters
from quarrymill.session import checkpointed


def cleaned(qa: DataFrame, languages=("en", "fr")) -> DataFrame:
    """Rows of the languages with cleaned question and answer."""
    rows = qa.where(F.col("language").isin(*languages))
    clean = (T.clean_text(F.col(c), F.col("language")).alias(n) for c, n in (("instruction", "q"), ("response", "a")))
    return rows.select("idx", "language", *clean)


def judged(rows: DataFrame, vocabularies: dict[str, tuple[str, ...]]) -> DataFrame:
    """Adds the first failing rule and the score; rows of other languages are left out."""
    rows = rows.where(F.col("language").isin(*vocabularies))
    return rows.withColumns({
        "reason": G.cleaning_reason(F.col("q"), F.col("a"), vocabularies, F.col("language")),
        "score": G.quality_score(F.col("q"), F.col("a"), vocabularies, F.col("language")),
    })


def premium(qa: DataFrame, vocabularies: dict[str, tuple[str, ...]], least: float = 7.0, percent: int = 85) -> DataFrame:
    """idx, language, q, a, score of what remains: chats of another shape than question and answer go, then what a rule
    rejects or scores below `least`, then exact and near-duplicate questions; languages are balanced.

    Spark computes a cleaned text once (its NFC is a call that Spark does not repeat), so that only what passes is kept.
    """
    chats = adapters.chat(qa).where(~G.structure_failed(F.col("messages")))
    good = judged(cleaned(chats, tuple(vocabularies)), vocabularies).where(F.col("reason").isNull() & (F.col("score") >= least))
    good = checkpointed(good.select("idx", "language", "q", "a", "score"))
    first = dedup.first_of_key(good.withColumn("key", F.concat_ws(":", "language", T.fuzzy_hash(F.col("q")))), "key").select("idx")
    rows = good.join(first, "idx", "left_semi")
    stays = dedup.greedy_kept(rows.select("idx", F.col("q").alias("text"), "language"), percent, "language").where("kept")
    stays = checkpointed(stays.select("idx"))
    places = merge.balanced(rows.select("idx", "language").join(stays, "idx", "left_semi"))
    return good.join(places.select("idx"), "idx", "left_semi")


def metadata(kept: DataFrame, least: float = 7.0, percent: int = 85, words: int = 20) -> DataFrame:
    """One row on a cleaned set: rows by language, thresholds, average scores."""
    of = lambda language: F.col("language") == language
    score = lambda language: F.coalesce(F.avg(F.when(of(language), F.col("score"))), F.lit(0.0))
    return kept.agg(
        F.count("*").alias("total_examples"), F.count_if(of("fr")).alias("french_examples"), F.count_if(of("en")).alias("english_examples"),
        F.lit(least).alias("quality_threshold"), F.lit(percent / 100).alias("similarity_threshold"), F.lit(words).cast("bigint").alias("min_answer_words"),
        score("fr").alias("avg_quality_score_fr"), score("en").alias("avg_quality_score_en"),
    )
