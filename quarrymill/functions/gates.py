"""Gates over questions and answers.  Each gives one reason column: the first rule that fails, null where none does."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarrymill.functions import text as T

# Subject words; vocabularies are parameters of the rules that use them.
KEYWORDS = {
    "en": (
        "scrum", "agile", "sprint", "backlog", "project", "management", "stakeholder", "requirement", "risk", "scope",
        "schedule", "budget", "team", "deliverable", "milestone", "kanban", "waterfall", "iteration", "planning",
        "estimation", "velocity", "burndown", "retrospective", "product owner", "scrum master", "pmp", "pmbok", "gantt", "wbs",
    ),
    "fr": (
        "scrum", "agile", "sprint", "backlog", "projet", "gestion", "partie prenante", "exigence", "risque", "portée",
        "calendrier", "équipe", "livrable", "jalon", "kanban", "itération", "planification", "estimation", "vélocité",
        "rétrospective", "product owner", "scrum master", "cascade", "méthodologie",
    ),
}


def first_failure(*rules: tuple[str, Column]) -> Column:
    """The name of the first condition that holds; null conditions do not."""
    out = F.when(F.coalesce(rules[0][1], F.lit(False)), rules[0][0])
    for name, failed in rules[1:]:
        out = out.when(F.coalesce(failed, F.lit(False)), name)
    return out


def generation_reason(q: Column, a: Column) -> Column:
    q, a = T.strip(F.coalesce(q, F.lit(""))), T.strip(F.coalesce(a, F.lit("")))
    return first_failure(
        ("question_short", F.length(q) < 20), ("answer_short", F.length(a) < 150), ("few_words", T.word_count(a) < 50),
        ("few_sentences", T.period_count(a) < 5), ("generic", T.phrases_present(F.lower(a), T.GENERIC) > 3),
        ("few_content_words", T.content_word_count(a) < 25),
    )


def final_reason(q: Column, a: Column) -> Column:
    return first_failure(
        ("empty", (F.coalesce(q, F.lit("")) == "") | (F.coalesce(a, F.lit("")) == "")), ("question_short", F.length(q) < 15),
        ("answer_short", F.length(a) < 80), ("few_words", T.word_count(a) < 30), ("few_sentences", T.period_count(a) < 3),
    )


def translation_ok(q: Column, a: Column) -> Column:
    return F.coalesce((F.length(q) > 10) & (F.length(a) > 50), F.lit(False))


def variation_reason(q: Column, a: Column, original_q: Column, original_a: Column, similarity: Column | None = None) -> Column:
    """The lenient gate of rewritten pairs; `similarity` is a model's, where there is one."""
    same = T.containment(T.word_set(original_q), T.word_set(q))
    rest = F.replace(F.lower(a), F.lower(q), F.lit(""))
    rules = [
        ("instruction_too_short", T.word_count(q) < 3), ("response_too_short", T.word_count(a) < 30),
        ("not_a_question", ~T.is_question(q)), ("identical_response", T.strip(a) == T.strip(original_a)),
        ("too_similar", same > 0.98),
    ]
    if similarity is not None:
        rules += [("semantic_too_similar", similarity > 0.97), ("semantic_too_different", similarity < 0.20)]
    triple = F.length(a) - F.length(F.replace(a, F.lit("\n\n\n"), F.lit("")))
    rules += [
        ("poor_quality_phrases", T.phrases_present(F.lower(a), T.WORN) > 3), ("malformed_response", triple / 3 > 2),
        ("response_repeats_question", F.lower(a).contains(F.lower(q)) & (T.word_count(rest) < 20)),
    ]
    return first_failure(*rules)


def entity_loss(original: Column, kept: Column) -> Column:
    """Whether, of more than two entities, less than half are left."""
    left = F.size(F.array_intersect(original, kept)) / F.size(original)
    return F.when(F.size(original) > 2, left < 0.5).otherwise(False)


def structure_failed(messages: Column) -> Column:
    first, second = F.get(messages, 0), F.get(messages, 1)
    ok = (
        (F.size(messages) == 2) & (first["role"] == "user") & (second["role"] == "assistant")
        & (first["content"] != "") & (second["content"] != "")
    )
    return ~F.coalesce(ok, F.lit(False))


def length_rules(q: Column, a: Column) -> list[tuple[str, Column]]:
    return [
        ("question_length", ~F.length(q).between(15, 800)), ("answer_length", ~F.length(a).between(50, 2500)),
        ("question_words", ~T.word_count(q).between(5, 150)), ("answer_words", ~T.word_count(a).between(20, 500)),
    ]


def keywords_in(low: Column, keywords, language: Column | None = None) -> Column:
    """How many of the keywords occur in a text in lower case; `keywords` may be one vocabulary, or one for each language."""
    if language is None:
        return T.phrases_present(low, keywords)
    out = F.lit(0).cast("bigint")
    for name, words in keywords.items():
        out = F.when(language == name, T.phrases_present(low, words)).otherwise(out)
    return out


def keywords_present(c: Column, keywords, language: Column | None = None) -> Column:
    return T.let(F.lower(c), lambda low: keywords_in(low, keywords, language))


def cleaning_reason(q: Column, a: Column, keywords, language: Column | None = None) -> Column:
    """The first of all rules after cleaning, in their order."""
    return first_failure(
        *length_rules(q, a),
        ("incomplete", ~T.ends_sentence(a)), ("low_info", T.low_information(a)), ("structure_bad", ~T.has_structure(a)),
        ("grammar", ~T.grammar_ok(q)), ("off_subject", keywords_present(F.concat(q, F.lit(" "), a), keywords, language) < 1),
        ("placeholders", T.has_placeholder(q) | T.has_placeholder(a)), ("repetitive", T.is_repetitive(a)),
    )


def quality_score(q: Column, a: Column, keywords, language: Column | None = None) -> Column:
    def less(condition: Column, points: float) -> Column:
        return F.when(F.coalesce(condition, F.lit(False)), points).otherwise(0.0)

    def by_lower(low: Column) -> Column:
        # "xxx" and "todo" have no blank, so that they are in both texts joined by one if they are in either
        found = keywords_in(F.when(q.isNotNull() & a.isNotNull(), low), keywords, language)
        open_ = T.let(q, T.is_bracketed) | T.let(a, T.is_bracketed) | T.is_unfinished(low)
        return less(found < 2, 2.0) + less(open_, 3.0)

    def by_words(w: Column) -> Column:
        return less(F.array_size(w) < 20, 2.0) + less(F.array_size(w) > 500, 1.0) + less(T.repeats_thrice(w), 2.0)

    taken = (
        less(T.word_count(q) < 5, 2.0) + T.let(T.words(a), by_words)  # an answer is cut into words once
        + T.let(F.lower(F.concat_ws(" ", q, a)), by_lower)  # and both are put into lower case once
        + less(~T.has_sentences(a), 1.5) + less(~T.let(T.strip(a), T.ends_sentence), 1.0)
    )
    return F.greatest(F.lit(0.0), F.lit(10.0) - taken)
