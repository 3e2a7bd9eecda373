"""Untyped records: sanitizing to fixed keys, overlaying, table-wide defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.schemas import SANITIZED_KEYS

_INT_TEXT = r"^\s*[+-]?\d+(_\d+)*\s*$"
_OTHER_NUMBER = r"^(-?\d[\d.eE+-]*|true|false)$"
_NO_ITEMS = "cast(array() as array<string>)"


def _kind(value: Column) -> Column:
    """Type name of a value. Slow to build, so asked only where the value's text is ambiguous."""
    return F.schema_of_variant(value)


def _raw_text(value: Column) -> Column:
    """Text of any value, JSON for a list or object; null if absent or null."""
    return F.try_variant_get(value, "$", "string")


def _spelled(text: Column, value: Column) -> Column:
    """The text, with truth values as ``True`` and ``False``."""
    truth = text.isin("true", "false") & (_kind(value) == "BOOLEAN")
    return F.when(truth, F.initcap(text)).otherwise(text)


def _as_text(text: Column, value: Column) -> Column:
    return F.coalesce(_spelled(text, value), F.lit(""))


def _as_int(text: Column, value: Column) -> Column:
    """Whole part of a number, 1 or 0 of a truth value, a whole number in text; else 0.

    Read from the value's text where that is plain: a cast that fails inside VARIANT is costly.
    """
    whole = F.trim(F.replace(text, F.lit("_"))).try_cast("bigint")
    other = text.rlike(_OTHER_NUMBER) & (_kind(value) != "STRING")
    number = F.when(text.rlike(_INT_TEXT), whole).when(
        other, F.try_variant_get(value, "$", "bigint")
    )
    return F.coalesce(number, F.lit(0).cast("bigint"))


def _as_list(text: Column, value: Column) -> Column:
    """A list as it is, elements as text; anything else becomes the one element of a list."""
    items = F.when(text.startswith("["), F.try_variant_get(value, "$", "array<variant>"))
    single = _spelled(text, value)
    return F.coalesce(
        F.transform(items, lambda v: _spelled(_raw_text(v), v)),
        F.when(single.isNotNull(), F.array(single)),
        F.expr(_NO_ITEMS),
    )


_READ = {"text": _as_text, "int": _as_int, "list": _as_list}


def _nested(text: Column, value: Column) -> Column:
    """A list or object, where a number belongs: kept as 0, but reported."""
    found = text.rlike(r"^[\[{]") & _kind(value).rlike("^(ARRAY|OBJECT)")
    return F.coalesce(found, F.lit(False))


def sanitize(
    df: DataFrame,
    record: str,
    keep: Sequence[str] = (),
    keys: Mapping[str, str] = SANITIZED_KEYS,
) -> DataFrame:
    """Fixed keys with fixed types from a VARIANT column, empty values for absent ones.

    Other keys are dropped. ``coerced`` tells that a list or object stood where a number belongs.
    """
    # The record is taken apart once, then each value's text; the types follow in a third step.
    shape = "struct<" + ",".join(f"`{key}`:variant" for key in keys) + ">"
    apart = df.select(*keep, F.try_variant_get(F.col(record), "$", shape).alias("_values"))
    values = {key: F.col(f"_values.`{key}`") for key in keys}
    texts = apart.select(
        *keep, "_values", *(_raw_text(v).alias(f"_text_{key}") for key, v in values.items())
    )
    parts = {key: (F.col(f"_text_{key}"), v) for key, v in values.items()}
    coerced = F.lit(False)
    for key, kind in keys.items():
        if kind == "int":
            coerced = coerced | _nested(*parts[key])
    columns = [_READ[kind](*parts[key]).alias(key) for key, kind in keys.items()]
    return texts.select(*keep, *columns, coerced.alias("coerced"))


def sanitize_json(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """As ``sanitize``, from a JSON text column. Unreadable text gives the empty record."""
    return sanitize(df.withColumn("_record", F.try_parse_json(text)), "_record", keep)


def overlay(base: DataFrame, extra: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Join on ``on``; a column both sides have takes the ``extra`` side where it is set.

    ``extra`` must hold one row per ``on`` value, read from a table rather than just aggregated or
    joined: then a value that very many ``base`` rows share is split over tasks by adaptive
    execution.
    """
    shared = [c for c in extra.columns if c in base.columns and c != on]
    renamed = extra.withColumnsRenamed({c: f"_extra_{c}" for c in shared})
    joined = base.join(renamed, on, how)
    merged = {c: F.coalesce(F.col(f"_extra_{c}"), F.col(c)) for c in shared}
    return joined.withColumns(merged).drop(*(f"_extra_{c}" for c in shared))


def fill_text(df: DataFrame) -> DataFrame:
    """Empty text for null in every text column, an empty list in every text-list column."""
    filled = {}
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        if kind == "string":
            filled[field.name] = F.coalesce(F.col(field.name), F.lit(""))
        elif kind == "array<string>":
            filled[field.name] = F.coalesce(F.col(field.name), F.expr(_NO_ITEMS))
    return df.withColumns(filled)
