"""Numeric coercion: what cannot be read becomes 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _number(c: Column) -> Column:
    """Double value of a decimal text or number, else null."""
    text = F.trim(c.cast("string"))
    plain = text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    return (
        F.when(F.lower(text) == "true", F.lit(1.0))
        .when(plain, text.try_cast("double"))
    )


def has_fraction(c: Column) -> Column:
    """A readable number that is not whole; such rows go to quarantine."""
    number = _number(c)
    return F.coalesce(number != F.floor(number).cast("double"), F.lit(False))


def to_int_or_zero(c: Column) -> Column:
    whole = F.trim(c.cast("string")).try_cast("bigint")
    return F.coalesce(whole, _number(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def to_float_or_zero(c: Column) -> Column:
    return F.coalesce(_number(c), F.lit(0.0))
