"""Broadcast a side only after its size is measured."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20
_ROW_OVERHEAD = 32
_FIXED = set("boolean tinyint smallint int bigint float double date timestamp".split())


def _width(name: str, kind: str) -> Column | None:
    """Bytes of a value; None for types whose size is not measured."""
    column = F.col(name)
    if kind in ("string", "binary"):
        return F.coalesce(F.octet_length(column), F.lit(0))
    if kind in ("array<string>", "array<binary>"):
        sizes = F.transform(column, lambda x: F.coalesce(F.octet_length(x), F.lit(0)) + 8)
        total = F.aggregate(sizes, F.lit(0).cast("bigint"), lambda n, x: n + x)
        return F.coalesce(total, F.lit(0))
    if kind.startswith("array<") and kind[6:-1] in _FIXED:
        return F.greatest(F.size(column), F.lit(0)) * 8
    return F.lit(0) if kind in _FIXED or kind.startswith("decimal") else None


def measured_bytes(df: DataFrame) -> int | None:
    """Rows times a fixed overhead plus their texts, bytes and lists; None if a type is unknown."""
    widths = [_width(c, kind) for c, kind in df.dtypes]
    if any(width is None for width in widths):
        return None
    return df.agg(F.sum(sum(widths, F.lit(_ROW_OVERHEAD)).cast("bigint"))).first()[0] or 0


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast if the frame measures at most ``limit`` bytes; else join by shuffle."""
    size = measured_bytes(df)
    return F.broadcast(df) if size is not None and size <= limit else df
