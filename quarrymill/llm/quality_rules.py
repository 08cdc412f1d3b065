"""Quality rules as a ledger of bitmasks, in DataFrame expressions only.

`ledger` evaluates every rule once and keeps each document's measurements and a mask of the rules that it fails.
A policy is a versioned mask: documents are kept by it where none of its bits is set, so that a change of policy, and
the ablation of each of its rules, read the ledger and never the texts again.

Edge cases: a null text has no words, like an empty one or one of white space alone, and fails `too_few_words`.
Repeated rows are judged each by itself.  Lines count as equal by their whole content.  Further columns of the input
do not matter, whatever their names; an empty table gives an empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACES = " \\t\\n\\u000b\\f\\r"
_GAP = "[\\x20\\x09-\\x0D]+"
_WINDOW = 5

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_echo_words",
)

#: Failure conditions over the measurements; a rule's bit is its place.
RULES = (
    ("too_few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbol_heavy", "100 * n_symbols > 10 * n_words"),
    ("duplicate_lines", "n_lines >= 4 and 100 * n_dup_lines > 40 * n_lines"),
    ("echoed_words", "n_words >= 10 and 100 * n_echo_words > 30 * n_words"),
)
BASE = ("too_few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """A named and versioned choice of rules."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << i for i, (name, _) in enumerate(RULES) if name in self.rules)


BASE_POLICY = Policy("base", 1, BASE)
DEFAULT_POLICY = Policy("default", 1, tuple(name for name, _ in RULES))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def measured(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id as `doc_id` and MEASURES."""
    base = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("t"))
    trimmed = F.expr(f"btrim(t, '{_SPACES}')")
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _GAP, -1))
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    read = base.select(
        "doc_id",
        F.transform(words, lambda x: F.xxhash64(x)).alias("h"),
        F.length(F.regexp_replace("t", _GAP, "")).cast("bigint").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", "#*$%&|<>", ""))).cast("bigint").alias("n_symbols"),
        lines.alias("lines"),
    )
    # A window is the hash of its words' hashes; within one text equal 64-bit hashes mean equal words.
    starts = F.sequence(F.lit(0), F.size("h") - _WINDOW)
    window = F.when(
        F.size("h") >= _WINDOW,
        F.transform(starts, lambda i: F.xxhash64(*(F.get("h", i + k) for k in range(_WINDOW)))),
    )
    read = read.select(
        "doc_id", "word_chars", "n_symbols",
        F.size("h").cast("bigint").alias("n_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size(F.filter("h", lambda x, i: x == F.get("h", i - 1))).cast("bigint").alias("n_echo_words"),
        window.alias("w"),
    )
    # Only texts with a repeated window sort theirs.
    order = F.when(
        F.size(F.array_distinct("w")) < F.size("w"),
        F.array_sort(F.transform("w", lambda x, i: F.struct(x.alias("x"), i.alias("i")))),
    )
    twice = F.filter(
        "o", lambda s, j: (F.get("o", j - 1)["x"] == s["x"]) | (F.coalesce(F.get("o", j + 1)["x"] == s["x"], F.lit(False)))
    )
    read = read.withColumn("o", order).drop("w")
    read = read.withColumn("p", F.array_sort(F.transform(twice, lambda s: s["i"]))).drop("o")
    reach = F.transform("p", lambda x, j: F.least(F.lit(_WINDOW), F.coalesce(F.get("p", j + 1) - x, F.lit(_WINDOW))))
    return read.select(
        "doc_id", *(F.coalesce(_sum(reach), F.lit(0)).cast("bigint").alias(m) if m == "n_repeat_words" else m for m in MEASURES)
    )


def ledger(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`measured`, and `failures`: bit i is set where the document fails RULES[i]."""
    bits = [F.when(F.expr(condition), F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, condition) in enumerate(RULES)]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    # A filter on `failures` must not move below the measurements, where it would compute them again for every word:
    # optimizers move none past a column that depends on the row's place.
    placed = F.when(F.monotonically_increasing_id() >= 0, mask.cast("bigint"))
    return measured(docs, id_column, text_column).withColumn("failures", placed)


def passes(policy: Policy) -> Column:
    return F.col("failures").bitwiseAND(F.lit(policy.mask)) == 0


def apply_policy(book: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with the policy's name, version and verdict."""
    return book.withColumns({
        "policy": F.lit(policy.name), "policy_version": F.lit(policy.version), "kept": passes(policy),
    })


def ablation(book: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of the policy: documents that fail it, that fail it alone, and that are kept without it.

    Counts of the distinct masks come first, at most 2**rules rows, so that one shuffle of a few rows serves all rules.
    """
    masks = book.groupBy("failures").agg(F.count("*").alias("n"))
    rules = F.array(*(
        F.struct(F.lit(name).alias("rule"), F.lit(1 << i).cast("bigint").alias("bit"))
        for i, (name, _) in enumerate(RULES) if name in policy.rules
    ))
    seen = F.col("failures").bitwiseAND(F.lit(policy.mask))
    each = masks.select("n", seen.alias("f"), F.explode(rules).alias("r")).select("n", "f", "r.*")

    def count(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("bigint")

    return each.groupBy("rule").agg(
        count(F.col("f").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        count(F.col("f") == F.col("bit")).alias("n_failed_alone"),
        count(F.col("f").bitwiseAND(F.bitwise_not("bit")) == 0).alias("n_kept_without"),
    )


def filter_documents(docs: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """The documents that the policy keeps, with all their columns; text never leaves its partition."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    packed = docs.select(whole.alias("doc_id"), F.col("text"))
    return ledger(packed).where(passes(policy)).select("doc_id.*")


def op10(spark, sf_dir: str) -> DataFrame:
    """Columns: doc_id, n_words, the four base measurements, base_failed, kept, failures."""
    from quarrymill.llm.work import table

    book = ledger(table(spark, sf_dir, "documents"))
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes(BASE_POLICY)).alias("base_failed"), passes(DEFAULT_POLICY).alias("kept"), "failures",
    )


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
z AS (SELECT doc_id, unnest(list_zip(range(1, len(w) + 1), w, w[2:], w[3:], w[4:], w[5:])) AS z FROM d),
g AS (SELECT doc_id, z[1] AS i, [z[2], z[3], z[4], z[5], z[6]] AS g FROM z WHERE z[6] IS NOT NULL),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
c AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM (SELECT doc_id, i, unnest(range(0, 5)) AS j FROM r) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         len(list_filter(list_zip(w, w[2:]), lambda x: x[1] = x[2])) AS n_echo_words
  FROM d LEFT JOIN c USING (doc_id)),
f AS (
  SELECT *, CAST(CASE WHEN n_words < 10 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END
    + CASE WHEN n_lines >= 4 AND 100 * n_dup_lines > 40 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN n_words >= 10 AND 100 * n_echo_words > 30 * n_words THEN 16 ELSE 0 END AS BIGINT) AS failures
  FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, (failures & 3) <> 0 AS base_failed, failures = 0 AS kept, failures
FROM f
"""
