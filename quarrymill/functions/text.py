"""Text functions as Column expressions, with Unicode classes that mean the same in Spark, DuckDB and Python."""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space and word characters, as a regular expression's classes.
SPACES = r"\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS, NOT_WS = f"[{SPACES}]", f"[^{SPACES}]"
#: The same classes for Spark alone.  Java asks the parts of a class one by one: here single characters below 256, which are one
#: part, then a range that few others are in; the classes above take ten questions for each letter.
_BLANK = r"\t\n\x{b}\f\r\x{1c}\x{1d}\x{1e}\x{1f} \x{85}\x{a0}[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]"
_WS, _NOT_WS = f"[{_BLANK}]", f"[^{_BLANK}]"
#: The same white space, as characters.
BLANKS = "".join(chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace())
WORD, NOT_WORD = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"
#: Where a word begins or ends.
EDGE = f"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"

# Words and phrases that the rules look for.
FRENCH = ("le", "la", "les", "de", "et", "dans", "pour", "est", "que", "une", "des", "sont")
ENGLISH = ("the", "and", "is", "in", "to", "of", "a", "are", "that", "for")
GENERIC = (
    "it is important", "there are many", "it depends", "in general", "it can be", "there is a", "this is a", "these are",
)
WORN = ("as i mentioned", "as mentioned earlier", "like i said", "as i said before")
QUESTION_WORDS = ("what", "how", "why", "when", "where", "who", "which", "can", "could", "should", "would", "is", "are", "does", "do")
QUESTION_PREFIXES = ("Question:", "Q:", "Answer:", "A:", "Rewritten:", "Here's", "Here is")
ANSWER_PREFIXES = ("Answer:", "A:", "Here's", "Here is", "Reformulated")
FREE_PREFIXES = ("Question:", "Q:", "Answer:", "A:", "New")
TERMS = (
    ("scrum", "Scrum"), ("agile", "Agile"), ("kanban", "Kanban"), ("product owner", "Product Owner"),
    ("scrum master", "Scrum Master"),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once; lambdas compute what they name for every element otherwise."""
    return F.get(F.transform(F.array(value), body), 0)


def long(c: Column) -> Column:
    return c.cast("bigint")


def replaced(c: Column, *pairs: tuple[str, str]) -> Column:
    for pattern, by in pairs:
        c = F.regexp_replace(c, pattern, by)
    return c


def where_any(c: Column, parts: tuple[str, ...], change: Callable[[Column], Column]) -> Column:
    """change(c) for texts with one of the parts, without which it changes nothing; looking for parts costs far less than
    matching at every place."""
    return let(c, lambda x: F.when(reduce(or_, (x.contains(p) for p in parts)), change(x)).otherwise(x))


def swapped(c: Column, part: str, by: str) -> Column:
    """`replace` compares whole parts at every place, `contains` only where the first byte is the same."""
    return where_any(c, (part,), lambda x: F.replace(x, F.lit(part), F.lit(by)))


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(BLANKS))


def n_chars(c: Column) -> Column:
    return long(F.length(c))


def word_count(c: Column) -> Column:
    """Between two blanks a text splits to its words and an empty part at either end; matching words one by one takes
    about ten times as long."""
    return long(F.array_size(F.split(F.concat(F.lit(" "), c, F.lit(" ")), f"{_WS}+", -1)) - 2)


def words(c: Column) -> Column:
    return F.array_remove(F.split(c, f"{_WS}+", -1), "")


def word_set(c: Column) -> Column:
    return F.array_distinct(words(F.lower(c)))


def period_count(c: Column) -> Column:
    return long(F.length(c) - F.length(F.replace(c, F.lit("."), F.lit(""))))


def ends_sentence(c: Column) -> Column:
    return c.endswith(".") | c.endswith("!") | c.endswith("?")


def sentences(c: Column) -> Column:
    return F.transform(F.split(c, "[.!?]+", -1), strip)


def has_sentences(c: Column) -> Column:
    """Two sentences or more that are not blank: a part ends at marks and all marks and blanks after them, so that only the
    first one may be blank, and the second one or the rest empty."""
    parts = F.split(c, f"[.!?][{_BLANK}.!?]*+", 3)
    return let(parts, lambda ps: F.size(F.filter(ps, lambda s, i: F.when(i == 0, strip(s)).otherwise(s) != "")) >= 2)


def content_word_count(c: Column) -> Column:
    """Words of more than four characters."""
    return long(F.size(F.filter(words(c), lambda w: F.length(w) > 4)))


def phrases_present(c: Column, phrases) -> Column:
    """How many of the phrases occur."""
    return sum((c.contains(p).cast("bigint") for p in phrases), F.lit(0).cast("bigint"))


def detect_language(c: Column) -> Column:
    head = F.lower(F.substring(c, 1, 800))
    french, english = (phrases_present(head, [f" {w} " for w in ws]) for ws in (FRENCH, ENGLISH))
    arabic = F.regexp_count(head, F.lit("[\\x{0600}-\\x{06FF}]")) > 20
    return F.when(arabic, "arabic").when(french > english + 2, "french").otherwise("english")


def clean_document(c: Column) -> Column:
    """Blank runs of three and more become two; characters above Latin-1 go, but for white space."""
    c = where_any(c, ("\n\n\n",), lambda x: replaced(x, ("\\n{3,}", "\n\n")))
    above = (f"[\\x{{100}}-\\x{{10ffff}}&&{_NOT_WS}]", "")
    return strip(let(c, lambda x: F.when(F.octet_length(x) > F.length(x), replaced(x, above)).otherwise(x)))


def short_key(c: Column, n: int = 70) -> Column:
    return F.substring(replaced(F.lower(c), (f"{NOT_WORD}+", "")), 1, n)


def normalized(c: Column) -> Column:
    return strip(replaced(F.lower(c), (f"[^\\p{{L}}\\p{{N}}_{SPACES}]", ""), (f"{_WS}+", " ")))


def fuzzy_hash(c: Column) -> Column:
    return F.md5(normalized(c))


def compose(c: Column) -> Column:
    """NFC, by the ICU library that comes with Spark, and without zero-width spaces and byte-order marks."""
    nfc = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(False))
    return swapped(swapped(F.when(c.isNotNull(), nfc), chr(0x200B), ""), chr(0xFEFF), "")


def drop_links(c: Column) -> Column:
    mail = f"{EDGE}[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Z|a-z]{{2,}}{EDGE}"
    c = where_any(c, ("://", "www."), lambda x: replaced(x, (f"https?://{_NOT_WS}+|www\\.{_NOT_WS}+", "")))
    return where_any(c, ("@",), lambda x: replaced(x, (mail, "")))


def tidy_marks(c: Column) -> Column:
    """Single blanks, none before a mark and one after it, at the end a full stop where no sentence ends.

    The rules are: runs of blanks become one; blanks before marks go; a mark that something follows gets a blank; then equal
    marks become one, blanks before full stops and commas go, and blanks after marks become one.  After the third there are
    no two marks side by side, and before a mark there is nothing but that rule's blank, which full stops and commas lose
    again.  So the first two rules are one match, for texts that need it, and the others one of marks with the blanks after
    them.  Marks are looked for, being rarer than blanks, and those that have one blank after them are left.
    """
    marks = ".,!?;:"

    def joined(x: Column) -> Column:
        # a run is looked at from its first blank only
        runs = replaced(x, (f"{_WS}(?<!{_WS}{{2}}){_WS}*+(?=[{marks}])|( ) ++", "$1"))
        return F.when(x.contains("  ") | x.rlike(f"[{marks}](?<={_WS}[{marks}])"), runs).otherwise(x)

    c = let(swapped(c, "\t", " "), joined)
    c = strip(replaced(c, (f"([{marks}])(?! [^{_BLANK}{marks}]|[.,]|\\z){_WS}*+", "$1 ")))
    return let(c, lambda x: F.when((x != "") & ~ends_sentence(x), F.concat(x, F.lit("."))).otherwise(x))


def tidy_capitals(c: Column) -> Column:
    def raised(x: Column) -> Column:
        first = F.substring(x, 1, 1)
        return F.when(first.rlike("\\p{Ll}"), F.concat(F.upper(first), F.substring(x, 2, 2**31 - 1))).otherwise(x)

    def name(low: Column, a: str, b: str) -> Callable[[Column], Column]:
        # what stands before a term is looked at where the term is, not at every place
        return lambda x: F.when(low.contains(a), replaced(x, (f"(?i){a}(?<!{WORD}{a})(?!{WORD})", b))).otherwise(x)

    def named(x: Column, low: Column) -> Column:
        for a, b in TERMS:
            x = let(x, name(low, a, b))
        return x

    return let(let(c, raised), lambda x: let(F.lower(x), lambda low: named(x, low)))


def clean_text(c: Column, language: Column | str) -> Column:
    """The whole cleaning of questions and answers, for a language or a column of languages; null becomes empty."""
    c = tidy_capitals(tidy_marks(drop_links(compose(F.coalesce(c, F.lit(""))))))

    def quoted(x: Column) -> Column:
        x = where_any(x, ("«",), lambda y: replaced(y, (f"«{_WS}*", "« ")))
        return swapped(where_any(x, ("»",), lambda y: replaced(y, (f"{_WS}*»", " »"))), "' ", "'")

    if isinstance(language, str):
        return strip(quoted(c) if language == "fr" else c)
    return strip(let(c, lambda x: F.when(language == "fr", quoted(x)).otherwise(x)))


def is_bracketed(x: Column) -> Column:
    """Something in brackets, or an ellipsis."""
    pairs = (x.contains(a) & x.contains(b) & x.rlike(f"\\{a}[^\\n]*?\\{b}") for a, b in ("[]", "{}"))
    return reduce(or_, pairs) | (x.contains("<") & x.rlike("<[^\\n]*?>")) | x.contains("...")


def is_unfinished(low: Column) -> Column:
    """Words that stand for others, in a text in lower case."""
    return low.contains("xxx") | low.contains("todo")


def has_placeholder(c: Column) -> Column:
    return let(c, lambda x: is_bracketed(x) | let(F.lower(x), is_unfinished))


def repeats_thrice(w: Column) -> Column:
    """Ten words or more, and a sequence of three that occurs three times.

    Sequences are compared where three of their hashes are equal: those of one such hash, and all only if these differ.
    Hashes are sorted where two of them are left when each is taken once.
    """

    def thrice(ranked: Column) -> Column:
        return F.filter(ranked, lambda x, i: x == F.get(ranked, i + 2))

    def same(places: Column) -> Column:
        grams = F.transform(places, lambda i: F.array_join(F.slice(w, i + 1, 3), " "))
        return F.size(let(F.sort_array(grams), thrice)) > 0

    def confirmed(h: Column, found: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - 3)
        return let(F.get(found, 0), lambda one: F.when(one.isNull(), False).otherwise(
            same(F.filter(places, lambda i: F.get(h, i) == one)) | same(places)
        ))

    def judged(h: Column) -> Column:
        again = F.size(h) - F.size(F.array_distinct(h)) > 1
        return F.when(again, let(let(F.sort_array(h), thrice), lambda found: confirmed(h, found))).otherwise(False)

    hashes = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) >= 10, let(hashes, judged)).otherwise(False)


def is_repetitive(c: Column) -> Column:
    return let(words(c), repeats_thrice)


def has_echo(c: Column) -> Column:
    """Two equal words of more than three characters side by side, in any case."""

    def echoed(w: Column) -> Column:
        return F.exists(F.sequence(F.lit(0), F.size(w)), lambda i: F.coalesce(
            (F.get(w, i) == F.get(w, i + 1)) & (F.length(F.get(w, i)) > 3), F.lit(False)
        ))

    return let(words(F.lower(c)), echoed)


def grammar_ok(c: Column) -> Column:
    return ~has_echo(c) & F.forall(sentences(c), lambda s: (s == "") | s.rlike("^\\p{Lu}"))


def low_information(c: Column) -> Column:
    low = strip(F.lower(c))
    return low.rlike("^(?:(?:yes|no|maybe|it depends|oui|non|peut-être|ça dépend)\\.?|[^\\n]{1,30})\\n?\\z") | low.rlike(
        "^(?:i don't know|je ne sais pas)"
    )


def has_structure(c: Column, least: int = 2) -> Column:
    return F.size(F.filter(sentences(c), lambda s: F.length(s) > 10)) >= least


def question_type(c: Column) -> Column:
    low = F.lower(c)
    kind = F.when(low.startswith("what"), "What")
    for w in ("how", "why", "when", "where"):
        kind = kind.when(low.startswith(w), w.capitalize())
    for w in ("define", "explain", "describe"):
        kind = kind.when(F.substring(low, 1, 20).contains(w), w.capitalize())
    return kind.otherwise("Other")


def is_question(c: Column) -> Column:
    c = strip(c)
    return c.contains("?") | F.lower(c).rlike(f"^({'|'.join(QUESTION_WORDS)})")


def jaccard(a: Column, b: Column) -> Column:
    """Of word sets; zero where one is empty."""
    both = F.size(F.array_intersect(a, b)).cast("double")
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / F.size(F.array_union(a, b)))


def containment(of: Column, inside: Column) -> Column:
    return F.when(F.size(of) > 0, F.size(F.array_intersect(of, inside)).cast("double") / F.size(of))


def cosine(a: Column, b: Column) -> Column:
    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda s, v: s + v)

    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm == 0, 0.0).otherwise(dot(a, b) / norm)


def entities(c: Column) -> Column:
    """Words of capitals and joined capitalized words, in lower case, in order of the alphabet."""
    capitals = F.filter(F.split(c, f"{NOT_WORD}+", -1), lambda w: w.rlike("^[A-Z]{2,}$"))
    camel = F.regexp_extract_all(c, F.lit("[A-Z][a-z]+(?:[A-Z][a-z]+)+"), 0)
    return F.sort_array(F.array_distinct(F.transform(F.concat(capitals, camel), lambda x: F.lower(x))))


def _without(c: Column, prefixes) -> Column:
    def cut(p: str) -> Callable[[Column], Column]:
        return lambda x: F.when(x.startswith(p), strip(F.substring(x, len(p) + 1, 2**31 - 1))).otherwise(x)

    for p in prefixes:  # each step names its text once; as plain columns the steps would double with every prefix
        c = let(c, cut(p))
    return strip(F.trim(c, F.lit("\"'")))


def clean_generated_question(c: Column) -> Column:
    """A generator's question without its trimmings; null where too little is left."""
    out = strip(F.split(_without(strip(c), QUESTION_PREFIXES), "\n", 2)[0])
    return let(out, lambda x: F.when((F.length(c) > 10) & (word_count(x) >= 3), x))


def clean_generated_answer(c: Column) -> Column:
    return F.when(word_count(c) >= 40, _without(strip(c), ANSWER_PREFIXES))


def split_question_answer(c: Column) -> Column:
    """Struct of question and answer found in free text; null where there is none."""

    def full(xs: Column) -> Column:
        return F.array_join(F.filter(xs, lambda x: x != ""), " ")

    def asks(x: Column) -> Column:
        return (F.length(x) > 15) & (x.contains("?") | F.lower(x).rlike("^(how|what|when|why|where)"))

    def found(lines: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(lines) - 1)
        q_at = F.get(F.filter(places, lambda i: asks(F.get(lines, i))), 0)
        return let(q_at, lambda q: let(
            F.get(F.filter(places, lambda i: (i > q) & (F.length(F.get(lines, i)) > 50)), 0), lambda a: chosen(lines, q, a)
        ))

    def chosen(lines: Column, q: Column, a: Column) -> Column:
        first = F.get(F.filter(F.slice(lines, 1, 5), lambda x: F.length(x) > 15), 0)
        spare = F.coalesce(first, F.get(lines, q))
        split = F.struct(F.get(lines, q).alias("q"), full(F.slice(lines, a + 1, F.size(lines))).alias("a"))
        rest = let(spare, lambda s: F.struct(s.alias("q"), full(F.filter(lines, lambda x: x != s)).alias("a")))
        return F.when(a.isNotNull(), split).otherwise(rest)

    def finish(x: Column) -> Column:
        x = strip(F.trim(x, F.lit("\"'")))
        for p in FREE_PREFIXES:
            x = strip(F.replace(x, F.lit(p), F.lit("")))
        return x

    def checked(pair: Column) -> Column:
        usable = (F.length(c) > 30) & pair["q"].isNotNull() & (word_count(pair["a"]) >= 50)
        return F.when(usable, F.struct(finish(pair["q"]).alias("instruction"), finish(pair["a"]).alias("response")))

    return let(let(F.transform(F.split(c, "\n", -1), strip), found), checked)


def chat_template(messages: Column) -> Column:
    """Training text of user and assistant turns; other roles are skipped."""
    part = F.transform(messages, lambda m: F.when(
        m["role"] == "user", F.concat(F.lit("<s>[INST] "), m["content"], F.lit(" [/INST]"))
    ).when(m["role"] == "assistant", F.concat(F.lit(" "), m["content"], F.lit("</s>"))).otherwise(""))
    return F.array_join(part, "")


def last_reply(c: Column) -> Column:
    """The first block of what follows the last instruction."""
    return F.split(strip(F.substring_index(c, "[/INST]", -1)), "\n\n", 2)[0]


def slices(c: Column, width: int = 4500) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.length(c) / width), F.lit(1)).cast("int") - 1),
        lambda i: F.substring(c, i * width + 1, F.lit(width)),
    )
