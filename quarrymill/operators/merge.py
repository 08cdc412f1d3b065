"""Unions of sources, balancing, shuffling and splitting."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarrymill.functions import text as T
from quarrymill.operators.order import positions
from quarrymill.session import checkpointed


def union_in_order(*sources: DataFrame) -> DataFrame:
    """All rows; `part` keeps the sources' order before idx."""
    parts = [s.withColumn("part", F.lit(i)) for i, s in enumerate(sources)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def merge_stats(qa: DataFrame) -> DataFrame:
    """Per language: rows, share, floor averages of words, average of periods, and rows of 60, 80 and 100 words."""
    w = T.word_count(F.col("response"))
    each = qa.groupBy("language").agg(
        F.count("*").alias("n"), F.sum(T.word_count(F.col("instruction"))).alias("q"), F.sum(w).alias("a"),
        F.avg(T.period_count(F.col("response"))).alias("avg_periods"), *(F.count_if(w >= k).alias(f"words_{k}") for k in (60, 80, 100)),
    )
    every = F.sum("n").over(Window.partitionBy())  # over one row per language
    return each.select(
        "language", "n", (F.col("n") * 100.0 / every).alias("percent"), F.expr("q div n").alias("avg_question_words"),
        F.expr("a div n").alias("avg_response_words"), "avg_periods", "words_60", "words_80", "words_100",
    )


def balanced(qa: DataFrame) -> DataFrame:
    """The first N rows of each language, N being the smallest language's count."""
    counts = qa.groupBy("language").agg(F.count("*").alias("n"))
    ranked = positions(qa.select("language", "idx"), ["language", "idx"])
    starts = ranked.groupBy("language").agg(F.min("before").alias("start"))
    least = counts.agg(F.min("n").alias("least"))
    place = ranked.join(F.broadcast(starts), "language").crossJoin(F.broadcast(least))  # one row per language, and one
    return qa.join(place.where("before - start < least").select("idx"), "idx", "left_semi")


def shuffled(rows: DataFrame, seed: int = 42) -> DataFrame:
    """idx and its position in an order by a hash of seed and idx, which any engine can compute."""
    keyed = rows.select("idx", F.md5(F.concat(F.lit(f"{seed}:"), F.col("idx").cast("string"))).alias("key"))
    return positions(keyed, ["key", "idx"], "position").select("idx", "key", "position")


def split(rows: DataFrame, test: float = 0.05, val: float = 0.15, seed: int = 42) -> DataFrame:
    """idx and split, of exact sizes: test first, then val of the rest."""
    placed = shuffled(rows, seed)
    n = placed.count()
    n_test = math.ceil(test * n - 1e-9)
    n_val = math.ceil(val / (1 - test) * (n - n_test) - 1e-9)
    kind = F.when(F.col("position") < n_test, "test").when(F.col("position") < n_test + n_val, "val").otherwise("train")
    return placed.select("idx", kind.alias("split"))


def comprehensive_stats(merged: DataFrame, **sizes: DataFrame) -> DataFrame:
    """section, key, value: totals, languages, lengths by language, histograms of the fields that any row has,
    augmentation ratio, long answers, and the sizes of the named inputs.

    Texts are counted once: rows are combined by their values first, and the combined ones count for each of their sections.
    """
    w, q, p = T.word_count(F.col("response")), T.word_count(F.col("instruction")), T.period_count(F.col("response"))
    fields = {"categories": ("category", "unknown"), "difficulties": ("difficulty", "unknown"), "augmentation_types": ("augmentation_type", "original")}
    pair = lambda section, key, there=True: F.struct(F.lit(section).alias("section"), key.alias("key"), F.lit(there).alias("there"))
    of = [pair("all", F.lit("")), pair("languages", F.coalesce("language", F.lit("unknown")))]
    for section, (field, missing) in fields.items():
        if field in merged.columns:
            of.append(F.struct(F.lit(section).alias("section"), F.coalesce(field, F.lit(missing)).alias("key"), F.col(field).isNotNull().alias("there")))
    values = ["language", *(f for f, _ in fields.values() if f in merged.columns)]
    parts = merged.select(*values, q.alias("q"), w.alias("w"), p.alias("p")).groupBy(*values).agg(
        F.count("*").alias("n"), F.sum("q").alias("q"), F.sum("w").alias("w"), F.sum("p").alias("p"), F.count("p").alias("of_p"), F.min("w").alias("low"),
        F.max("w").alias("high"), *(F.count_if(F.col("w") >= k).alias(f"over_{k}") for k in (60, 80, 100)),
    )
    sums = [F.sum(c).alias(c) for c in ("n", "q", "w", *(f"over_{k}" for k in (60, 80, 100)))]
    each = parts.withColumn("of", F.explode(F.array(*of))).groupBy("of.section", "of.key").agg(
        *sums, F.try_divide(F.sum("p"), F.sum("of_p")).alias("p"), F.min("low").alias("low"), F.max("high").alias("high"), F.bool_or("of.there").alias("there"),
    )
    each = checkpointed(each)  # a row for each value
    total = F.broadcast(each.where("section = 'all'").select(F.col("n").alias("total"), "over_60", "over_80", "over_100"))
    any_of = F.broadcast(each.groupBy("section").agg(F.bool_or("there").alias("any")))
    row = lambda section, key, value: F.struct(F.lit(section).alias("section"), F.lit(key).alias("key"), F.expr(value).cast("double").alias("value"))

    def exploded(df: DataFrame, *rows: F.Column) -> DataFrame:
        return df.select(F.explode(F.array(*rows)).alias("r")).select("r.*")

    counts = each.join(any_of, "section").where("section <> 'all' and any").select("section", "key", F.col("n").cast("double").alias("value"))
    by_language = each.where("section = 'languages'")
    share = by_language.crossJoin(total.select("total")).selectExpr("'language_percentages' as section", "key", "cast(n * 100.0D / total as double) as value")
    lengths = exploded(by_language, *(
        F.struct(F.concat(F.lit("length_"), "key").alias("section"), F.lit(k).alias("key"), F.expr(v).cast("double").alias("value")) for k, v in (
            ("count", "n"), ("avg_instruction_words", "q div n"), ("avg_response_words", "w div n"), ("avg_response_sentences", "p"),
            ("min_response_words", "low"), ("max_response_words", "high"))
    ))
    quality = exploded(total, row("total", "pairs", "total"), *(row("quality", f"pairs_above_{k}_words", f"over_{k}") for k in (60, 80, 100)),
                       row("quality", "high_quality_percentage", "over_60 * 100.0D / total"))
    ratio = each.join(any_of, "section").where("section = 'augmentation_types' and any and key = 'original'").crossJoin(total.select("total"))
    ratio = ratio.selectExpr("'composition' as section", "'augmentation_ratio' as key", "cast(total / n as double) as value")
    given = [df.agg(F.count("*").cast("double").alias("value")).select(F.lit("original_sizes").alias("section"), F.lit(k).alias("key"), "value") for k, df in sizes.items()]
    return reduce(DataFrame.unionByName, [counts, share, lengths, quality, ratio, *given])
