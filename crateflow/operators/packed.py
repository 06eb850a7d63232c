"""Problem 6: several values packed in one field become one row per value with its place.

Method: a quote-aware finite-state tokenizer. It tracks the open quote, escapes and bracket depth and emits a
value at every delimiter that stands outside quotes and brackets. A doubled quote inside quotes is that quote;
a backslash before a delimiter, quote or backslash takes the next character as text, except that two
backslashes outside quotes are a delimiter themselves (a usual frame separator). A field that is a whole JSON
array is read as one, with JSON's escapes. A quote or bracket that never closes is ordinary text.

Defined cases: null, empty and blank fields give no row; empty pieces are dropped and not counted; values
are trimmed and keep their case; a value written twice is two values; rows repeated under one key count once (of
different fields under one key the smallest counts); rows without key stay, each distinct field once; fields of any length are read whole, in one pass.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DELIMITERS = ",;|/\t\n\r·•"
QUOTES = {'"': '"', "'": "'", "“": "”", "„": "“", "«": "»", "‘": "’"}
BRACKETS = {"(": ")", "[": "]", "{": "}"}


def _closing(s: str, i: int, close: str, delims: frozenset[str]) -> int:
    """Place of the quote that closes the one at i: the first, not doubled or escaped, with only space before the next delimiter or the end; -1 if none."""
    n, j = len(s), i + 1
    while j < n:
        if s[j] == "\\" and j + 1 < n:
            j += 2
        elif s[j] == close:
            if close == s[i] and j + 1 < n and s[j + 1] == close:
                j += 2
                continue
            k = j + 1
            while k < n and s[k] in "  ":
                k += 1
            if k == n or s[k] in delims or s.startswith("\\\\", k):
                return j
            j += 1
        else:
            j += 1
    return -1


def _unquoted(s: str, quote: str, close: str) -> str:
    out, j = [], 0
    while j < len(s):
        if s[j] == "\\" and j + 1 < len(s):
            out.append(s[j + 1])
            j += 2
        elif quote == close and s.startswith(close * 2, j):
            out.append(close)
            j += 2
        else:
            out.append(s[j])
            j += 1
    return "".join(out)


def tokenize(s: str | None, delimiters: str = DELIMITERS, nested: bool = True) -> list[str]:
    """Values of one packed field, in their order; without ``nested``, brackets are ordinary text."""
    if s is None or not s.strip():
        return []
    body = s.strip()
    if body[0] == "[" and body[-1] == "]":
        try:
            got = json.loads(body)
            if isinstance(got, list):
                return [x for x in (str(v).strip() for v in got if v is not None) if x]
        except ValueError:
            pass
    delims = frozenset(delimiters)
    out: list[str] = []
    piece: list[str] = []
    shut: list[str] = []
    missing: set[str] = set()
    i, n, fresh = 0, len(s), True
    last = {c: s.rfind(c) for c in BRACKETS.values()}

    def emit() -> None:
        v = "".join(piece).strip()
        if v:
            out.append(v)
        piece.clear()

    while i < n:
        c = s[i]
        if fresh and c in QUOTES and c not in missing:
            end = _closing(s, i, QUOTES[c], delims)
            if end >= 0:
                piece.append(_unquoted(s[i + 1 : end], c, QUOTES[c]))
                i, fresh = end + 1, False
                continue
            missing.add(c)
        if c == "\\" and i + 1 < n:
            if s[i + 1] == "\\" and not shut:
                emit()
                i, fresh = i + 2, True
                continue
            if s[i + 1] in delims or s[i + 1] in QUOTES or s[i + 1] == "\\":
                piece.append(s[i + 1])
                i, fresh = i + 2, False
                continue
        if c in delims and not shut:
            emit()
            i, fresh = i + 1, True
            continue
        if shut and c == shut[-1]:
            shut.pop()
        elif nested and c in BRACKETS and last[BRACKETS[c]] > i:
            shut.append(BRACKETS[c])
        piece.append(c)
        fresh = fresh and c.isspace()
        i += 1
    if shut:  # a bracket that never closes
        return tokenize(s, delimiters, nested=False)
    emit()
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def tokens_udf(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in it:
        yield s.map(lambda v: tokenize(v), na_action=None)


def split_packed(df: DataFrame, key: str, field: str, ordinal: str = "ord", value: str = "value") -> DataFrame:
    """One row (key, ordinal from 1, value) for each value of ``field``; rows of one key with the same field count once.

    Only (key, field) travel: equal rows collapse map-side, the tokenizer runs after that, narrow, on Arrow batches.
    """
    rows = df.select(F.col(key).alias("k"), F.col(field).cast("string").alias("f")).where("f IS NOT NULL AND trim(f) <> ''")
    rows = rows.groupBy("k", F.when(F.col("k").isNull(), F.col("f"))).agg(F.min("f").alias("f"))
    return rows.select("k", F.posexplode(tokens_udf("f"))).select(F.col("k").alias(key), (F.col("pos") + 1).cast("int").alias(ordinal), F.col("col").alias(value))


def packed_values(c: Column) -> Column:
    """The values of a packed field as an array."""
    return tokens_udf(c)
