"""Histograms, length statistics and reports as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.functions import text as T

# Half-open bounds of the histograms.
WORD_BINS = ((0, 30), (30, 50), (50, 80), (80, 120), (120, 1000))
SENTENCE_BINS = ((0, 3), (3, 5), (5, 8), (8, 12), (12, 100))


def count_if(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def histogram(qa: DataFrame, *fields: str) -> DataFrame:
    """field, value, n and the first row of the value, for all fields in one pass; missing values are `unknown`."""
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f), F.lit("unknown")).alias("value")) for f in fields))
    each = qa.select("idx", F.explode(pairs).alias("p")).groupBy("p.field", "p.value")
    return each.agg(F.count("*").alias("n"), F.min("idx").alias("first_idx"))


def length_stats(rows: DataFrame, **measures: Column) -> DataFrame:
    """metric, mean, min, max, median (halfway between the middle two)."""
    aggregates = []
    for name, c in measures.items():
        parts = (F.lit(name).alias("metric"), F.avg(c).alias("mean"), F.min(c).alias("min"), F.max(c).alias("max"), F.median(c).alias("median"))
        aggregates.append(F.struct(*parts))
    return rows.agg(F.array(*aggregates).alias("all")).select(F.explode("all").alias("s")).select("s.*")


def bins(rows: DataFrame, value: Column, bounds) -> DataFrame:
    """low, high, n, percent of each bin, empty ones too; what lies beyond the last is in none."""
    counts = [F.struct(
        F.lit(a).cast("bigint").alias("low"), F.lit(b).cast("bigint").alias("high"), count_if((value >= a) & (value < b)).alias("n"),
        F.count("*").alias("total")
    ) for a, b in bounds]
    found = rows.agg(F.array(*counts).alias("all")).select(F.explode("all").alias("s")).select("s.*")
    return found.select("low", "high", "n", F.when(F.col("total") > 0, F.col("n") * 100.0 / F.col("total")).alias("percent"))


def tiers(qa: DataFrame) -> DataFrame:
    """Three tiers that leave gaps between them."""
    w, s = T.word_count(F.col("response")), T.period_count(F.col("response"))
    return qa.agg(
        count_if((w >= 80) & (s >= 5)).alias("high"), count_if((w >= 50) & (w < 80) & (s >= 3) & (s < 5)).alias("medium"),
        count_if((w < 50) | (s < 3)).alias("low"), F.count("*").alias("total"),
    )


def recommendations(qa: DataFrame) -> DataFrame:
    """advice: one row for each that applies."""
    w, s = F.col("w"), F.col("s")
    counted = qa.select(
        T.word_count(F.col("response")).alias("w"), T.period_count(F.col("response")).alias("s"), T.question_type(F.col("instruction")).alias("kind"), "source",
    )
    # combined by its few kinds and sources, so that a text is counted once and travels nowhere
    parts = counted.groupBy("kind", "source").agg(
        F.sum(w).alias("words"), F.count(w).alias("counted"), F.count("*").alias("n"), count_if((w < 50) | (s < 3)).alias("low"), count_if((w >= 80) & (s >= 5)).alias("high")
    )
    totals = parts.agg(
        F.try_divide(F.sum("words"), F.sum("counted")).alias("mean"), F.sum("n").alias("n"), F.sum("low").alias("low"), F.sum("high").alias("high"),
        F.count_distinct("kind").alias("types"), F.count_distinct("source").alias("sources"),
    )
    rules = (
        ("short_responses", "mean < 60"), ("many_low_quality", "low / n > 0.3"), ("few_question_types", "types < 5"),
        ("few_sources", "sources < 5 and n > 100"), ("quality_good", "mean >= 70 and high / n > 0.6"),
        ("size_excellent", "n >= 1000"), ("size_good", "n >= 500 and n < 1000"), ("size_modest", "n < 500"),
    )
    advice = F.array_compact(F.array(*(F.when(F.expr(c), F.lit(name)) for name, c in rules)))
    return totals.where("n > 0").select(F.explode(advice).alias("advice"))


def diagnostics(qa: DataFrame) -> DataFrame:
    """Lengths of question and answer together, and repeated questions."""
    n = F.length("instruction") + F.length("response")
    sizes = qa.agg(
        F.count("*").alias("n"), F.avg(n).alias("mean"), F.stddev_pop(n).alias("std"), F.min(n).cast("bigint").alias("min"),
        F.max(n).cast("bigint").alias("max"), F.median(n).alias("median"), count_if(n < 50).alias("below_50"),
        count_if(n > 3000).alias("above_3000"), count_if(n > 5000).alias("above_5000"),
    )
    key = T.strip(F.lower("instruction"))
    twice = qa.groupBy(key.alias("q")).count().where("count > 1").agg(F.count("*").alias("repeated_questions"))
    return sizes.crossJoin(F.broadcast(twice))  # one row each


def dataset_stats(qa: DataFrame, by: str = "language") -> DataFrame:
    """Per dataset: rows, and floor average, least and most words of questions and answers."""
    q, a = T.word_count(F.col("instruction")), T.word_count(F.col("response"))
    found = qa.groupBy(by).agg(F.count("*").alias("total_pairs"), *(
        f(c).alias(f"{k}_{n}") for n, c in (("instruction_words", q), ("response_words", a)) for k, f in (("sum", F.sum), ("min", F.min), ("max", F.max))
    ))
    names = [f"{k}_{n}" for n in ("instruction_words", "response_words") for k in ("min", "max")]
    averages = [F.expr(f"sum_{n} div total_pairs").alias(f"avg_{n}") for n in ("instruction_words", "response_words")]
    return found.select(by, "total_pairs", *averages, *names)


def fields_present(rows: DataFrame, *fields: str) -> DataFrame:
    """field, present: whether any row has it; a column that is not there is in none."""
    there = [F.struct(F.lit(f).alias("field"), (F.coalesce(F.bool_or(F.col(f).isNotNull()), F.lit(False)) if f in rows.columns else F.lit(False)).alias("present")) for f in fields]
    return rows.agg(F.array(*there).alias("all"), F.count("*").alias("n")).select(F.explode("all").alias("s")).select("s.*")


def run_counters(items: DataFrame, pairs: DataFrame, item: str) -> DataFrame:
    """One row: items, those that gave a pair and those that gave none, the success rate in percent, pairs, their floor
    average per successful item, and pairs per item."""
    good = pairs.groupBy(item).agg(F.count("*").alias("made"))
    each = items.select(item).distinct().join(good, item, "left")
    found = each.agg(F.count("*").alias("completed"), F.count_if(F.col("made").isNull()).alias("failed"), F.coalesce(F.sum("made"), F.lit(0)).alias("pairs"))
    return found.selectExpr(
        "completed", "completed - failed as succeeded", "failed", "(completed - failed) * 100.0D / completed as success_rate", "pairs",
        "pairs div greatest(1, completed - failed) as avg_per_item", "cast(pairs as double) / completed as expansion",
    )


def rejections(judged: DataFrame, reason: str = "reason") -> DataFrame:
    """One row: attempts, accepted, rejected and the acceptance rate in percent; `ok` is an accepted attempt."""
    ok = F.count_if(F.col(reason) == "ok")
    found = judged.agg(F.count("*").alias("attempts"), ok.alias("accepted"))
    return found.selectExpr("attempts", "accepted", "attempts - accepted as rejected", "accepted * 100.0D / greatest(1, attempts) as acceptance_rate")


def top_reasons(judged: DataFrame, n: int = 5, reason: str = "reason") -> DataFrame:
    """The n most frequent reasons of rejection, by name among equals; a number at a reason's end is no part of its name."""
    name = F.regexp_replace(reason, "_-?[0-9.]+$", "").alias("reason")
    return judged.where(F.col(reason) != "ok").groupBy(name).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason").limit(n)


def row_at(rows: DataFrame, place: int, *order: str) -> DataFrame:
    """The row at a place in the order, or the last if there are fewer; no more than place + 1 rows are gathered."""
    first = rows.orderBy(*order).limit(place + 1)
    return first.orderBy(*(F.desc(c) for c in order)).limit(1)


def sample_of_each(rows: DataFrame, by: str, seed: int = 42, key: str = "idx") -> DataFrame:
    """One row of each group, chosen by a hash of seed and key."""
    mark = F.struct(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), F.col(key))
    return rows.groupBy(by).agg(F.min_by(F.struct(*rows.columns), mark).alias("r")).select("r.*")


def progress(total: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """One row: how many of the items are done, and the share in percent."""
    left = done.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__done", F.lit(True))
    found = total.select(key).join(left, key, "left").agg(F.count("__done").alias("completed"), F.count("*").alias("total"))
    return found.withColumn("progress_percent", F.col("completed") * 100.0 / F.greatest(F.col("total"), F.lit(1)))


def loss_class(ratio: Column) -> Column:
    """How far a test loss lies above the training loss."""
    return F.when(ratio < 1.2, "excellent").when(ratio < 1.5, "good").when(ratio < 2.0, "fair").when(ratio.isNotNull(), "poor")


def training_estimate(rows: DataFrame, share: float = 0.8, batch: int = 4, accumulation: int = 4, epochs: int = 2, every: int = 200, seconds: float = 2.0) -> DataFrame:
    """One row: steps an epoch, all steps, evaluations, and hours at so many seconds a step."""
    steps = F.floor(F.count("*") * share / (batch * accumulation)).cast("bigint")
    found = rows.agg(steps.alias("steps_per_epoch")).withColumn("total_steps", F.col("steps_per_epoch") * epochs)
    return found.withColumns({"evaluations": F.expr(f"total_steps div {every}"), "hours": F.col("total_steps") * seconds / 3600.0})


def report_bars(rows: DataFrame, percent: str = "percent") -> DataFrame:
    """Adds a text bar of one block for every two percent."""
    return rows.withColumn("bar", F.repeat(F.lit("█"), (F.col(percent) / 2).cast("int")))
