"""Generators and translators behind one protocol, with a deterministic one that needs no service.

Real services are not implemented; `Generator` is where they go.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.functions import gates as G
from quarrymill.functions import outputs
from quarrymill.functions import text as T
from quarrymill.session import checkpointed

#: Kind of question, its level and the task, for each strategy.
STRATEGIES = (
    ("definition", "beginner", "Ask what the central notions mean and explain each with an example."),
    ("process", "intermediate", "Ask how the steps described here are carried out, and answer step by step."),
    ("problem-solving", "advanced", "Put a situation that needs a decision, and work out its solution."),
    ("comparison", "intermediate", "Ask how two things named here differ, and weigh them against each other."),
)
SHOWN = 2000


class Generator(Protocol):
    def __call__(self, prompt: str, attempt: int) -> str:
        """The output, or an empty text for a failure."""


def local_generator(prompt: str, attempt: int) -> str:
    """A JSON array whose content follows from the prompt."""
    mark = hashlib.md5(f"{prompt}:{attempt}".encode()).hexdigest()
    words = " ".join(w for w in prompt.split()[-60:] if w.isalpha()) or "nothing given"
    sentence = f"Statement {{}} about {mark[:6]} explains several details: {words}."
    answer = " ".join(sentence.format(i) for i in range(8)).replace('"', "")
    return f'```json\n[{{"instruction": "What does passage {mark[:8]} say in detail?", "response": "{answer}"}},]\n```'


def prompts(chunks: DataFrame, shown: int = SHOWN) -> DataFrame:
    """A prompt for each chunk and strategy, each with its own task."""
    kinds = F.array(*(F.struct(F.lit(a).alias("category"), F.lit(b).alias("difficulty"), F.lit(c).alias("task")) for a, b, c in STRATEGIES))
    rows = chunks.withColumn("kind", F.explode(kinds))
    text = F.format_string("%s Questions and answers (%s, %s) as a JSON array, on this text:\n%s", "kind.task", "kind.category", "kind.difficulty", F.substring("text", 1, shown))
    return rows.select("chunk_id", "document", "kind.category", "kind.difficulty", text.alias("prompt"))


def generated(rows: DataFrame, generator: Generator, attempts: int = 3) -> DataFrame:
    """Adds `output`: the first that is not empty within so many attempts; null where all failed."""
    columns = rows.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [next((x for i in range(attempts) if (x := generator(p, i))), None) for p in frame["prompt"]]
            yield frame[columns].assign(output=found)

    return rows.mapInPandas(run, ", ".join(f"{c} {t}" for c, t in rows.dtypes) + ", output string")


def qa_from_chunks(chunks: DataFrame, generator: Generator = local_generator) -> DataFrame:
    """Pairs that pass the generation gate, with the document as their source."""
    made = generated(prompts(chunks), generator).where("output is not null")
    found = outputs.parsed(made, "output", "chunk_id", "document")
    passed = found.where(G.generation_reason(F.col("instruction"), F.col("response")).isNull())
    return passed.withColumnRenamed("document", "source")


def translated(rows: DataFrame, translator: Callable[[str], str], *columns: str, width: int = 4500, attempts: int = 3) -> DataFrame:
    """Adds <column>_translated and `status`: failed where a part was not translated, whose own text then stands."""

    def one(text: str) -> tuple[str, bool]:
        parts, ok = [], True
        for i in range(0, max(len(text), 1), width):
            part = text[i : i + width]
            for _ in range(attempts):
                try:
                    parts.append(translator(part))
                    break
                except Exception:  # a service's failure; the row says so
                    continue
            else:
                parts.append(part)
                ok = False
        return " ".join(parts), ok

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fine = [True] * len(frame)
            for c in columns:
                found = [one(t or "") for t in frame[c]]
                frame[f"{c}_translated"] = [t for t, _ in found]
                fine = [a and b for a, (_, b) in zip(fine, found)]
            yield frame.assign(status=["ok" if x else "failed" for x in fine])

    added = "".join(f", {c}_translated string" for c in columns)
    return rows.mapInPandas(run, ", ".join(f"{c} {t}" for c, t in rows.dtypes) + added + ", status string")


def paragraphs_kept(text: F.Column, least: int = 20) -> F.Column:
    """Paragraphs of a text that are worth a translation."""
    return F.filter(F.split(text, "\n\n", -1), lambda p: F.length(T.strip(p)) >= least)


def translated_documents(rows: DataFrame, translator: Callable[[str], str], text: str = "text", language: str = "detected", width: int = 4500) -> DataFrame:
    """Adds `translated`: the text as it is where the language is English, else its paragraphs of 20 characters and more,
    each translated in parts of `width` characters; a paragraph with a part that fails is left out."""
    columns = rows.columns

    def one(paragraph: str) -> str | None:
        try:
            return " ".join(translator(paragraph[i : i + width]) for i in range(0, len(paragraph), width))
        except Exception:  # a service's failure
            return None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for given, lang, parts in zip(frame[text], frame[language], frame["__parts"]):
                done = [one(p) for p in parts] if parts is not None and lang != "english" else []
                found.append(given if lang == "english" else "\n\n".join(x for x in done if x is not None))
            yield frame[columns].assign(translated=found)

    parts = rows.withColumn("__parts", F.when(F.col(language) != "english", paragraphs_kept(F.col(text))))
    return parts.mapInPandas(run, ", ".join(f"{c} {t}" for c, t in rows.dtypes) + ", translated string")


def translated_pairs(qa: DataFrame, translator: Callable[[str], str], width: int = 4500) -> DataFrame:
    """Both fields translated, and `ok`: no part failed, and the translations are long enough."""
    made = translated(qa, translator, "instruction", "response", width=width)
    long_enough = G.translation_ok(F.col("instruction_translated"), F.col("response_translated"))
    return made.withColumn("ok", (F.col("status") == "ok") & long_enough)


def backing_off(call: Callable[[str], str | None], attempts: int = 3, pause: float = 2.0, factor: float = 1.5, sleep=time.sleep) -> Generator:
    """A generator that calls a service again after a failure (an exception, or None), with growing pauses; an empty answer
    is an answer."""

    def generator(prompt: str, attempt: int) -> str:
        wait = pause
        for i in range(attempts):
            try:
                found = call(prompt)
            except Exception:  # a service's failure
                found = None
            if found is not None:
                return found.strip()
            if i < attempts - 1:
                sleep(wait)
                wait *= factor
        return ""

    return generator


#: Ways to vary a pair: the prompt, and what becomes of the output.
VARIATIONS = ("professional_paraphrase", "expert_reformulation", "contextual_variation")


def variation_prompt(strategy: F.Column) -> F.Column:
    q, a = F.col("instruction"), F.col("response")
    say = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    return (
        F.when(strategy == VARIATIONS[0], say("Put this question in other words and write nothing else:\n\n", q))
        .when(strategy == VARIATIONS[1], say("Put this answer in other words and keep all it says.\n\nQuestion: ", q, "\n\nAnswer:\n", a))
        .otherwise(say("Write this question and answer anew, with an example from practice.\n\nQuestion: ", q, "\nAnswer: ", a, "\n\nNew question:"))
    )


def varied(strategy: F.Column, output: F.Column) -> F.Column:
    """Struct q, a of the new pair; null where the output is of no use."""
    pair = lambda x, y: F.struct(x.alias("q"), y.alias("a"))
    of = lambda value, made: T.let(value, lambda x: F.when(x.isNotNull(), made(x)))
    return (
        F.when(strategy == VARIATIONS[0], of(T.clean_generated_question(output), lambda q: pair(q, F.col("response"))))
        .when(strategy == VARIATIONS[1], of(T.clean_generated_answer(output), lambda a: pair(F.col("instruction"), a)))
        .when(strategy == VARIATIONS[2], of(T.split_question_answer(output), lambda x: pair(x["instruction"], x["response"])))
    )


def augmented(qa: DataFrame, generator: Generator, key: str = "idx", strategies=VARIATIONS, attempts: int = 3) -> tuple[DataFrame, DataFrame]:
    """Accepted variations (key, augmentation_type, attempt, instruction, response) and all attempts (key,
    augmentation_type, attempt, reason: `ok`, `generation_failed`, or the gate's).

    Each strategy is tried until a variation is accepted.  All attempts are one pass: the next one asks for what the one
    before it did not get accepted, and what is kept are the attempts, without the texts that they began with.
    """
    kinds = F.explode(F.array(*map(F.lit, strategies))).alias("augmentation_type")
    rows = qa.select(key, "instruction", "response", kinds).withColumn("prompt", variation_prompt(F.col("augmentation_type")))
    waits = F.lit(True)
    for attempt in range(attempts):
        output, new, reason = f"output_{attempt}", f"new_{attempt}", f"reason_{attempt}"
        rows = rows.withColumn(output, _asked(generator, attempt)(F.when(waits, F.col("prompt"))))
        made = varied(F.col("augmentation_type"), F.col(output))
        rows = rows.select(*rows.columns, F.explode(F.array(made)).alias(new)).drop(output)  # made once, judged by many rules
        found = G.variation_reason(F.col(f"{new}.q"), F.col(f"{new}.a"), F.col("instruction"), F.col("response"))
        found = F.when(F.col(new).isNull(), "generation_failed").otherwise(F.coalesce(found, F.lit("ok")))
        rows = rows.select(*rows.columns, F.explode(F.array(F.when(waits, found))).alias(reason))
        waits = F.coalesce(F.col(reason) != "ok", F.lit(False))
    tries = F.array(*(F.struct(
        F.lit(i).alias("attempt"), F.col(f"reason_{i}").alias("reason"), F.when(F.col(f"reason_{i}") == "ok", F.col(f"new_{i}")).alias("new")
    ) for i in range(attempts)))
    done = checkpointed(rows.select(key, "augmentation_type", F.filter(tries, lambda t: t["reason"].isNotNull()).alias("tries")))
    each = done.select(key, "augmentation_type", F.explode("tries").alias("t"))
    accepted = each.where("t.reason = 'ok'").select(
        key, "augmentation_type", "t.attempt", F.col("t.new.q").alias("instruction"), F.col("t.new.a").alias("response")
    )
    return accepted, each.select(key, "augmentation_type", "t.attempt", "t.reason")


def _asked(generator: Generator, attempt: int):
    """The generator as a function of a column of prompts; null is not asked for."""

    def run(prompts: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else generator(p, attempt) or None for p in prompts], dtype=object)

    return F.pandas_udf(run, "string").asNondeterministic()
