"""JSON arrays in model answers, whole or cut off."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKEN = regex.compile(r'"(?:[^"\\]|\\.)*+(?:"|$)|[\[\]{}]', regex.DOTALL)


def json_array(text: str | None) -> str | None:
    """The first array in a text; cut off, it ends after its last whole object. None where there is neither.

    One pass over strings and brackets: brackets in strings don't count.
    """
    start = text.find("[") if text else -1
    if start < 0:
        return None
    square = curly = 0
    whole = -1
    for m in TOKEN.finditer(text, start):
        match m[0]:
            case "[":
                square += 1
            case "]":
                square -= 1
                if not square:
                    return text[start : m.end()]
            case "{":
                curly += 1
            case "}":
                curly -= 1
                if square == 1 and not curly:
                    whole = m.end()
    return text[start:whole] + "]" if whole > start else None


@F.pandas_udf(T.StringType())
def salvaged(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield s.map(json_array)


ITEMS = "array<struct<object:string,canonical:string>>"


def answer_body(text: Column) -> Column:
    """What a code fence holds, or the text."""
    inner = F.regexp_extract(text, r"(?s)```(?:json)?\s*(.+?)\s*```", 1)
    return F.when(inner != "", inner).otherwise(text)


def label_items(text: Column) -> Column:
    """The items with an object in an answer's array; null where there is no array."""
    items = F.from_json(salvaged(answer_body(text)), ITEMS)
    return F.filter(items, lambda x: x.isNotNull() & x["object"].isNotNull())
