"""Unions, anti-joins and rules shared by the plans."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.urls import matches_any
from larder.operators.sizes import broadcast_if_small
from larder.session import settle


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows by column name; a column a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    return union_all(frames).distinct()


def _keys(done: DataFrame, on: str | list[str]) -> DataFrame:
    """The distinct keys, written once: broadcast if they measure small, else a table to join.

    As a written table they meet the other side in a plain shuffle join, whose skewed partitions
    adaptive execution can split; an aggregation in that place would forbid it.
    """
    return broadcast_if_small(settle(done.select(on).distinct(), "keys"))


def not_yet(df: DataFrame, done: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key is not in ``done``."""
    return df.join(_keys(done, on), on, "left_anti")


def already(df: DataFrame, done: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key is in ``done``."""
    return df.join(_keys(done, on), on, "left_semi")


def exclude_sources(df: DataFrame, sources: Iterable[str], column: str = "source") -> DataFrame:
    """Drop rows of the named sources; rows without a source stay."""
    for source in sources:
        df = df.where(~F.col(column).eqNullSafe(F.lit(source)))
    return df


def exclude_urls(df: DataFrame, patterns: Iterable[str], column: str = "url") -> DataFrame:
    """Drop rows whose URL holds one of the patterns, case ignored."""
    return df.where(~F.coalesce(matches_any(F.col(column), patterns), F.lit(False)))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, nulls left out."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("count")
    )
