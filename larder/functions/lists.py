"""List and JSON columns."""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRINGS = T.ArrayType(T.StringType())
_QUOTES = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}
# A flat list of quoted texts whose escapes JSON and Python literals read alike. The possessive
# quantifiers keep the match free of recursion on long texts.
_ESCAPE = r"""\\(?:[nrtbf"'\\]|u(?![dD][89a-fA-F]))"""
_TEXT = rf"""(?:'(?:[^'\\]|{_ESCAPE})*+'|"(?:[^"\\]|{_ESCAPE})*+")"""
_FLAT_LIST = rf"(?s)^\s*+\[(?:\s*+{_TEXT}\s*+(?:,|(?=\])))*+\s*+\]\s*+$"


def _read_literal(text: str | None) -> list[str] | None:
    if text is None:
        return None
    try:
        value = ast.literal_eval(text)
    except (ValueError, SyntaxError, MemoryError, RecursionError):
        return None
    if not isinstance(value, (list, tuple)):
        return None
    return [None if item is None else str(item) for item in value]


@F.pandas_udf(_STRINGS)
def _literal_list(texts: pd.Series) -> pd.Series:
    return texts.map(_read_literal, na_action=None)


def quick_list(c: Column) -> Column:
    """A list literal read by the JSON reader; null where it needs the exact reader."""
    return F.when(c.rlike(_FLAT_LIST), F.from_json(c, _STRINGS, _QUOTES))


def parse_py_list(c: Column, exact: bool = True) -> Column:
    """A list literal in text, Python or JSON quoting, as an array; null if it is neither.

    Rows the JSON reader handles never reach Python: the exact reader is handed null for them.
    """
    quick = quick_list(c)
    if not exact:
        return quick
    return F.coalesce(quick, _literal_list(F.when(quick.isNull(), c)))


def lowercase_sort(c: Column) -> Column:
    """Stable sort of a list, case ignored."""
    keyed = F.transform(
        c, lambda x, i: F.struct(F.lower(x).alias("k"), i.alias("i"), x.alias("v"))
    )
    return F.transform(F.array_sort(keyed), lambda s: s["v"])


def wrap_json(c: Column, key: str) -> Column:
    """``{"<key>": [...]}`` as text."""
    return F.to_json(F.struct(c.alias(key)), {"ignoreNullFields": "false"})


def unwrap_json(c: Column, key: str) -> Column:
    return F.from_json(c, T.StructType([T.StructField(key, _STRINGS)]))[key]


def dump_json(c: Column) -> Column:
    """A bare list as JSON text."""
    return F.to_json(c)


def split_commas(c: Column) -> Column:
    """Parts between commas, untrimmed, empty parts kept."""
    return F.split(c, ",", -1)


def join_ingredients(c: Column) -> Column:
    """The one text an ingredient list is tagged as."""
    return F.array_join(c, " ... ")


def distinct_items(c: Column) -> Column:
    return F.array_distinct(c)
