"""The unique-ingredient vocabulary: counts, first appearance, ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.text import collapse_ws, is_blank
from larder.operators.index import sorted_index
from larder.session import settle

# A list position needs at most 31 bits, so ids below 2**32 share one long with it.
_POSITION_BITS = 31
_PACKABLE_IDS = 1 << 32


def ingredient_counts(
    df: DataFrame, id_col: str, list_col: str, max_id: int | None = None
) -> DataFrame:
    """``ingredients, count, first_id, first_pos`` per distinct list element.

    Aggregated with map-side partial results, so a frequent word never gathers its rows, and first
    by spelling: whitespace and case are then normalised once per distinct word instead of once
    per word. An empty list counts as one null element of count 0. With ``max_id`` small enough,
    the first appearance is the minimum of one packed long, which keeps the aggregation hash-based.
    """
    words = df.select(F.col(id_col).alias("_id"), F.posexplode_outer(list_col).alias("_pos", "_w"))
    words = words.withColumn("_pos", F.coalesce("_pos", F.lit(0)))
    packed = max_id is not None and 0 <= max_id < _PACKABLE_IDS
    if packed:
        order = F.shiftleft("_id", _POSITION_BITS) + F.col("_pos")
        first_id = F.shiftright("_first", _POSITION_BITS)
        first_pos = F.col("_first").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    else:
        order = F.struct("_id", "_pos")
        first_id, first_pos = F.col("_first._id"), F.col("_first._pos")
    spelled = words.groupBy("_w").agg(F.count("_w").alias("_n"), F.min(order).alias("_first"))
    return (
        spelled.groupBy(collapse_ws(F.col("_w")).alias("ingredients"))
        .agg(F.sum("_n").alias("count"), F.min("_first").alias("_first"))
        .select(
            "ingredients",
            "count",
            first_id.cast("bigint").alias("first_id"),
            first_pos.cast("bigint").alias("first_pos"),
        )
    )


def largest_id(df: DataFrame, id_col: str) -> int | None:
    """Read from one narrow column; null if any id is negative, since those cannot be packed."""
    low, high = df.agg(F.min(id_col), F.max(id_col)).first()
    return high if low is not None and low >= 0 else None


def merged_counts(partials: DataFrame, starts: DataFrame, part: str) -> DataFrame:
    """The counts of several parts as those of the whole, in the shape of ``ingredient_counts``.

    ``partials`` holds each part's own counts, with ids counted from the part's beginning;
    ``starts`` has ``_start``, where each ``part`` begins, a row for each. Only words are read and
    moved, not the lists they came from.
    """
    placed = partials.join(F.broadcast(starts), part)
    first = F.struct((F.col("_start") + F.col("first_id")).alias("id"), F.col("first_pos").alias("pos"))
    merged = placed.groupBy("ingredients").agg(F.sum("count").alias("count"), F.min(first).alias("_first"))
    return merged.select(
        "ingredients",
        "count",
        F.col("_first.id").alias("first_id"),
        F.col("_first.pos").alias("first_pos"),
    )


def ranked_words(counts: DataFrame, drop_blank: bool = False, ordered: bool = True) -> DataFrame:
    """``ingredients_id, ingredients, count`` from ``ingredient_counts``."""
    if drop_blank:
        counts = counts.where(F.col("ingredients").isNotNull() & ~is_blank(F.col("ingredients")))
    ranked = sorted_index(counts, ["first_id", "first_pos"], "ingredients_id")
    out = ranked.select("ingredients_id", "ingredients", "count")
    return out.orderBy(F.desc("count"), "ingredients_id") if ordered else out


def unique_ingredients(
    df: DataFrame, id_col: str, list_col: str, drop_blank: bool = False, ordered: bool = True
) -> DataFrame:
    """``ingredients_id, ingredients, count``; ids rank the words by first appearance."""
    counts = ingredient_counts(df, id_col, list_col, largest_id(df, id_col))
    return ranked_words(counts, drop_blank, ordered)


def frequency_join(df: DataFrame, list_col: str) -> DataFrame:
    """The same counts as distinct words joined with their frequencies.

    Both sides come from one aggregation by spelling, so the lists are read and moved once.
    """
    words = df.select(F.explode_outer(list_col).alias("_w"))
    spelled = words.groupBy("_w").agg(F.count("_w").alias("_n"))
    spelled = settle(spelled.select(collapse_ws(F.col("_w")).alias("ingredients"), "_n"), "spelled")
    known = spelled.where("ingredients IS NOT NULL")
    frequencies = known.groupBy("ingredients").agg(F.sum("_n").alias("count"))
    return (
        spelled.select("ingredients")
        .distinct()
        .join(frequencies, "ingredients", "left")
        .withColumn("count", F.coalesce("count", F.lit(0)).cast("bigint"))
    )
