"""Ingredient tagging: longest vocabulary phrases, left to right, within each line."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.lists import join_ingredients
from larder.operators.sizes import BROADCAST_BYTES, broadcast_if_small
from larder.session import settle

_TOKEN = r"([\p{L}\p{N}]+)"
_STRINGS = T.ArrayType(T.StringType())


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), F.lit(1))


def phrases(vocab: DataFrame, column: str) -> DataFrame:
    """Distinct vocabulary phrases in token form, with their word count."""
    words = tokens(F.col(column))
    return (
        vocab.select(F.array_join(words, " ").alias("phrase"), F.size(words).alias("n_words"))
        .where("n_words > 0")
        .distinct()
    )


def _ngrams(words: Column, n: int) -> Column:
    """Every run of ``n`` words with its position."""
    if n == 1:
        return F.transform(words, lambda w, i: F.struct(i.alias("pos"), w.alias("phrase")))
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n))
    return F.transform(
        F.coalesce(starts, F.expr("cast(array() as array<int>)")),
        lambda i: F.struct(
            i.alias("pos"), F.array_join(F.slice(words, i + 1, n), " ").alias("phrase")
        ),
    )


@dataclass(frozen=True)
class PhraseTable:
    """A vocabulary ready for tagging: its phrases, written once, and how many words they have."""

    frame: DataFrame
    lengths: tuple[int, ...]


def phrase_table(vocab: DataFrame, column: str = "ingredients") -> PhraseTable:
    """Write the phrases of a vocabulary and take their lengths from them; none is left out.

    Prepare it once where many frames are tagged, as in a stream.
    """
    known = settle(phrases(vocab, column), "phrases")
    lengths = [row["n_words"] for row in known.select("n_words").distinct().collect()]
    return PhraseTable(broadcast_if_small(known, BROADCAST_BYTES), tuple(sorted(lengths)))


def candidate_spans(
    df: DataFrame, id_col: str, list_col: str, vocab: DataFrame | PhraseTable, column: str
) -> DataFrame:
    """All vocabulary hits: ``id, line, pos, n_words, phrase``.

    The phrases are broadcast if they measure small. Beyond that the words are shuffled to them;
    each phrase is there once, so a very frequent word is a skewed left side that adaptive
    execution splits. Only runs as long as some phrase are looked up.
    """
    known = vocab if isinstance(vocab, PhraseTable) else phrase_table(vocab, column)
    lines = df.select(F.col(id_col), F.posexplode(list_col).alias("line", "_text")).select(
        id_col, "line", tokens(F.col("_text")).alias("_words")
    )
    grams = F.concat(*(_ngrams(F.col("_words"), n) for n in known.lengths or (1,)))
    return (
        lines.select(id_col, "line", F.explode(grams).alias("_gram"))
        .select(id_col, "line", "_gram.pos", "_gram.phrase")
        .join(known.frame, "phrase")
        .select(id_col, "line", "pos", "n_words", "phrase")
    )


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _leftmost(starts: pd.Series, lengths: pd.Series) -> pd.Series:
    """Which spans of a chain are kept: in order, each that starts after the kept one's end."""

    def kept(begin, size):
        out, free = [], -1
        for i, (at, n) in enumerate(zip(begin, size, strict=True)):
            if at >= free:
                out.append(i)
                free = at + n
        return out

    return pd.Series([kept(b, n) for b, n in zip(starts, lengths, strict=True)], index=starts.index)


def longest_matches(spans: DataFrame, id_col: str) -> DataFrame:
    """Non-overlapping spans: from the left, the longest phrase at each free position.

    Spans that cannot touch are told apart first, so the sequential choice, one pass in Python,
    only sees chains of overlapping spans. One shuffle and one sort, by row id.
    """
    in_line = Window.partitionBy(id_col, "line").orderBy("pos", F.desc("n_words"))
    before = in_line.rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("pos") + F.col("n_words")
    opens = F.coalesce(F.col("pos") >= F.max(end).over(before), F.lit(True))
    chained = (
        spans.repartition(id_col)
        .withColumn("_opens", opens.cast("int"))
        .withColumn("_chain", F.sum("_opens").over(in_line))
    )
    span = F.struct("pos", (-F.col("n_words")).alias("shorter"), "phrase")
    chains = settle(
        chained.groupBy(id_col, "line", "_chain").agg(
            F.array_sort(F.collect_list(span)).alias("_spans")
        ),
        "chains",
    )
    alone = chains.where(F.size("_spans") == 1).select(
        id_col, "line", F.get("_spans", F.lit(0)).alias("_hit")
    )
    sizes = F.transform("_spans", lambda s: -s["shorter"])
    several = (
        chains.where(F.size("_spans") > 1)
        .withColumn("_kept", _leftmost(F.transform("_spans", lambda s: s["pos"]), sizes))
        .select(id_col, "line", "_spans", F.explode("_kept").alias("_at"))
        .select(id_col, "line", F.get("_spans", F.col("_at")).alias("_hit"))
    )
    return alone.unionByName(several).select(id_col, "line", "_hit.pos", "_hit.phrase")


def ingredient_tags(
    df: DataFrame,
    id_col: str,
    list_col: str,
    vocab: DataFrame | PhraseTable,
    column: str = "ingredients",
    name: str = "ingredient_tags",
) -> DataFrame:
    """``id, tags``: the matched phrases of each row in text order, duplicates kept.

    Phrases of any length take part. Only rows with a match appear; ``with_tags`` adds the empty
    ones. What is gathered per row are the matches of that one row's own text.
    """
    known = vocab if isinstance(vocab, PhraseTable) else phrase_table(vocab, column)
    spans = candidate_spans(df, id_col, list_col, known, column)
    if known.lengths and known.lengths[-1] > 1:
        spans = longest_matches(spans, id_col)
    ordered = F.array_sort(F.collect_list(F.struct("line", "pos", "phrase")))
    return spans.groupBy(id_col).agg(F.transform(ordered, lambda s: s["phrase"]).alias(name))


def with_tags(
    df: DataFrame,
    id_col: str,
    list_col: str,
    vocab: DataFrame | PhraseTable,
    column: str = "ingredients",
    name: str = "ingredient_tags",
) -> DataFrame:
    """``df`` with its tags, an empty list where nothing matches. ``id_col`` must be unique."""
    tags = ingredient_tags(df, id_col, list_col, vocab, column, name)
    empty = F.expr("cast(array() as array<string>)")
    return df.join(tags, id_col, "left").withColumn(name, F.coalesce(name, empty))


def model_tagger(
    load: Callable[[], Callable[[list[str]], list[list[str]]]],
) -> Callable[[Column], Column]:
    """A tagging column from any token classifier.

    ``load`` runs once per task; what it returns maps a batch of texts to lists of spans.
    """

    @F.pandas_udf(_STRINGS)
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for texts in batches:
            yield pd.Series(model(texts.fillna("").tolist()), index=texts.index)

    return lambda lines: F.transform(spans(join_ingredients(lines)), F.lower)
