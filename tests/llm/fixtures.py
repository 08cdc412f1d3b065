"""Small tables with nulls, ties, repeated rows, very long texts and clashing names."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, part string, u string"


def words(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n)]


def texts() -> list[str | None]:
    base, passage = words(1, 300), words(2, 60)
    out: list[str | None] = [
        None, "", " \t\n", "one", "One two", " ".join(base), " ".join(base), " ".join(base).upper(),
        " ".join(base[:150] + ["changed"] + base[151:]), " ".join(base[:280]),
        " ".join(words(3, 80) + passage + words(4, 50)), " ".join(words(5, 10) + passage),
        " ".join(passage + passage), "again " * 300, "x" * 5000, "été naïve 中文 \U0001f600 caf́e İstanbul \x1cq\x85r",
        "a <|endoftext|> b<|startoftext|>'s it's don't 12345 **!!", "line one\nline one\nline two\n\nline one\n",
        " ".join(words(6, 20_000)), "one", " ".join(passage[:34]), " ".join(passage[:35]), " ".join(words(7, 9) + passage[:35]),
    ]
    return out + [" ".join(words(100 + i, 40 + 7 * i)) for i in range(20)]


def documents(spark, rows=None):
    made = texts() if rows is None else rows
    data = [(i * 3 + 1, t, "en", None if i % 7 == 0 else f"src{i % 3}", len(t or ""), "n", "p", "u") for i, t in enumerate(made)]
    return spark.createDataFrame(data, SCHEMA)
