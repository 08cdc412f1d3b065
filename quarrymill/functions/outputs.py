"""Questions and answers from a generator's JSON-like outputs.

An output is scanned for JSON values with Python's own decoder: the first list of objects, or else every object that has
both a question and an answer.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

FIELDS = ("instruction", "response", "category", "difficulty")
DEFAULTS = ("", "", "general", "intermediate")

_DECODER = json.JSONDecoder()
_CONTROLS = dict.fromkeys([*range(0x20), *range(0x7F, 0xA0)])
#: A string, or a comma with nothing but white space before a closing bracket.
_STRING_OR_COMMA = re.compile(r'"(?:[^"\\]|\\.)*"|,\s*(?=[\]}])')
_LIST = re.compile(r"\[\s*\{")


def readable(output: str | None, keep_quotes: bool = True) -> str:
    """The output without code fences, control characters and commas that close a list.

    Unless `keep_quotes`, escaped quotes become bare ones, as the rule that is reproduced here has it; texts with quotes
    can't be read then.
    """
    text = (output or "").replace("```json", "").replace("```", "")
    if not keep_quotes:
        text = text.replace('\\"', '"')
    return _STRING_OR_COMMA.sub(lambda m: "" if m[0][0] == "," else m[0], text.translate(_CONTROLS))


def _value_at(text: str, place: int):
    try:
        return _DECODER.raw_decode(text, place)
    except ValueError:
        return None, place


def pairs(output: str | None, strict: bool = False) -> list[dict]:
    """Objects of the first list of objects, those one list further in too; else the single objects with both fields.

    If `strict`, escaped quotes stay as JSON has them.
    """
    text = readable(output, strict)
    found: list[dict] = []
    if start := _LIST.search(text):
        for item in _value_at(text, start.start())[0] or ():
            found += [x for x in (item if isinstance(item, list) else [item]) if isinstance(x, dict)]
    place = text.find("{") if not found else -1
    while place >= 0:
        value, end = _value_at(text, place)
        if isinstance(value, dict) and {"instruction", "response"} <= value.keys():
            found.append(value)
        else:
            end = place + 1
        place = text.find("{", end)
    return found


def parsed(df: DataFrame, output: str, *keep: str, strict: bool = False) -> DataFrame:
    """A row for each pair of each output; missing category and difficulty get their defaults."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for given in frame.itertuples(index=False):
                for i, x in enumerate(pairs(getattr(given, output), strict)):
                    rows.append([*(getattr(given, c) for c in keep), i, *(str(x.get(f, d)) for f, d in zip(FIELDS, DEFAULTS))])
            yield pd.DataFrame(rows, columns=[*keep, "pair", *FIELDS])

    kinds = dict(df.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in keep), "pair bigint", *(f"{f} string" for f in FIELDS)])
    return df.select(*keep, output).mapInPandas(run, schema)
