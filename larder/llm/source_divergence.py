"""Divergence of the sources of a language, over all kept terms, by Gustavson's row accumulation.

Terms are counted inside the tasks and summed by (language, source, term). Blocks of terms, dealt by
a hash and bounded in postings, hold the term-major index: for each term the groups that have it. In
a block every group's row scatters its terms through that index into one dense accumulator over its
peers, so no pair of postings is ever written. A group without a term has its baseline probability
there: the accumulator starts as if all terms were missing on both sides, and each posting corrects
the part of its own group. Rows of all blocks are then added up.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import bounded_batches, over_cores, text_or_empty
from larder.llm.letter_runs import letter_runs
from larder.operators.sizes import broadcast_if_small
from larder.session import settle

LEAST_DOCUMENTS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
#: Postings of one block of the index, and products of a row that are held at once.
BLOCK_POSTINGS = 1 << 17
PRODUCTS = 1 << 20
#: Distinct (language, source, term) a task counts before it hands them on.
_HELD_TERMS = 1 << 18


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, source, term, n, docs`` of the texts read, in parts of bounded size."""
    counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
    docs: dict[tuple[str, str], Counter] = defaultdict(Counter)
    held = 0

    def part() -> pa.RecordBatch:
        langs, sources, terms, n, seen = [], [], [], [], []
        for (lang, source), counter in counts.items():
            langs += [lang] * len(counter)
            sources += [source] * len(counter)
            terms += counter
            n += counter.values()
            seen += map(docs[lang, source].__getitem__, counter)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(langs, pa.string()),
                pa.array(sources, pa.string()),
                pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array(n, pa.int64()),
                pa.array(seen, pa.int64()),
            ],
            ["lang", "source", "term", "n", "docs"],
        )

    for batch in batches:
        rows = zip(*(batch[c].to_pylist() for c in ("lang", "source", "text")), strict=True)
        for lang, source, text in rows:
            counter, distinct = counts[lang, source], set()
            before = len(counter)
            for terms in letter_runs(text):
                counter.update(terms)
                distinct.update(terms)
            docs[lang, source].update(distinct)
            held += len(counter) - before
            if held >= _HELD_TERMS:
                yield part()
                counts.clear()
                docs.clear()
                held = 0
    if held:
        yield part()


def _probability(n: str, total: str) -> Column:
    """``1 + floor(SCALE * (n + 2) / (total + 2 * terms))``, in whole numbers of any size."""
    return F.expr(
        f"1 + (cast({SCALE} as decimal(10, 0)) * cast({n} + 2 as decimal(20, 0)))"
        f" div cast({total} + 2 * terms as decimal(20, 0))"
    )


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``floor((p - q)^2 / (p + q))``; a probability is at most 10^9 + 1, so longs hold it."""
    return (p - q) ** 2 // (p + q)


def accumulate(
    term: np.ndarray, group: np.ndarray, p: np.ndarray, zero: np.ndarray
) -> Iterator[np.ndarray]:
    """For each group in turn the dense row over its peers, of one block of terms.

    ``term`` numbers the block's terms, ``zero`` holds each group's baseline. The entries (g, h) and
    (h, g) add up to the divergence of both over the block.
    """
    n_terms = int(term.max()) + 1 if len(term) else 0
    order = np.lexsort((group, term))
    term, group, p = term[order], group[order], p[order]
    first = np.searchsorted(term, np.arange(n_terms + 1))
    by_group = np.argsort(group, kind="stable")
    edges = np.searchsorted(group[by_group], np.arange(len(zero) + 1))
    for g in range(len(zero)):
        row = np.zeros(len(zero), np.int64)
        none = divergence(zero[g], zero)
        row[g + 1 :] += n_terms * none[g + 1 :]
        mine = by_group[edges[g] : edges[g + 1]]
        # Present here, absent there: the same for all terms of one probability.
        values, times = np.unique(p[mine], return_counts=True)
        step = max(1, PRODUCTS // len(zero))
        for at in range(0, len(values), step):
            apart = divergence(values[at : at + step, None], zero) - none
            row += times[at : at + step] @ apart
        # Present on both sides: each term's postings of later peers, through the index.
        widths = first[term[mine] + 1] - mine - 1
        starts = np.arange(0, max(1, widths.sum()), PRODUCTS)
        cuts = np.searchsorted(np.cumsum(widths), starts, "left")
        for low, high in zip(cuts, [*cuts[1:], len(mine)], strict=True):
            own, width = mine[low:high], widths[low:high]
            skipped = np.repeat(np.cumsum(width) - width, width)
            other = np.arange(width.sum()) - skipped + np.repeat(own + 1, width)
            x, y, h = np.repeat(p[own], width), p[other], group[other]
            both = divergence(x, y) - divergence(x, zero[h]) - divergence(zero[g], y) + none[h]
            np.add.at(row, h, both)
        row[g] = 0
        yield row


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One block: its peers' baselines (rows without a term) and its postings, to dense rows."""
    block = pa.Table.from_batches(batches)
    terms = block["term"].combine_chunks().dictionary_encode()
    terms = terms.combine_chunks() if isinstance(terms, pa.ChunkedArray) else terms
    group = block["g"].to_numpy().astype(np.int64)
    p = block["p"].to_numpy()
    peer = np.asarray(terms.is_null())
    zero = np.zeros(int(peer.sum()), np.int64)
    zero[group[peer]] = p[peer]
    codes = np.asarray(terms.indices.fill_null(0))[~peer].astype(np.int64)
    for g, row in enumerate(accumulate(codes, group[~peer], p[~peer], zero)):
        yield pa.RecordBatch.from_arrays(
            [block["lang"].slice(0, 1).combine_chunks(), pa.array([g], pa.int32()), pa.array([row])],
            ["lang", "g", "row"],
        )


def _postings(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Counts of the kept terms in each group, and the kept terms with their language's count."""
    counts = settle(
        over_cores(docs)
        .mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")),
        "term-counts",
    )
    kept = settle(
        counts.groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= least)
        .drop("docs"),
        "kept-terms",
    )
    return settle(counts.drop("docs").join(kept, ["lang", "term"]), "postings"), kept


def _groups(docs: DataFrame, postings: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, g, total, lang_total, terms, zero`` of every group, numbered by language."""
    langs = kept.groupBy("lang").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total")
    )
    sums = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    numbers = Window.partitionBy("lang").orderBy("source")
    every = docs.select("lang", "source").distinct()
    joined = every.join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    filled = joined.fillna(0, ["total", "terms", "lang_total"])
    return settle(
        filled.select(
            "*",
            (F.row_number().over(numbers) - 1).alias("g"),
            F.when(F.col("terms") > 0, _probability("0", "total")).otherwise(1).alias("zero"),
        ),
        "groups",
    )


def _pairs(postings: DataFrame, groups: DataFrame, block_postings: int) -> DataFrame:
    """``lang, source, item, value``: each group's divergence from each other source."""
    sizes = postings.groupBy("lang").agg(F.count(F.lit(1)).alias("_size"))
    blocks = groups.select("lang").distinct().join(sizes, "lang", "left")
    blocks = blocks.select(
        "lang", F.ceil(F.coalesce("_size", F.lit(1)) / block_postings).alias("blocks")
    )
    peers = groups.join(blocks, "lang").select(
        "lang",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"),
        F.lit(None).cast("string").alias("term"),
        "g",
        F.col("zero").alias("p"),
    )
    dealt = postings.join(broadcast_if_small(blocks), "lang").select(
        "lang",
        F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"),
        "term",
        "g",
        "p",
    )
    rows = settle(
        dealt.unionByName(peers)
        .groupBy("lang", "block")
        .applyInArrow(_rows, "lang string, g int, row array<long>"),
        "dense-rows",
    )
    cells = rows.select("lang", "g", F.posexplode("row").alias("h", "part")).where("g <> h")
    sums = cells.groupBy("lang", F.least("g", "h").alias("a"), F.greatest("g", "h").alias("b"))
    sums = settle(sums.agg(F.sum("part").alias("value")), "divergences")
    both = sums.unionByName(
        sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value")
    )
    names = groups.select("lang", F.col("g").alias("a"), "source")
    items = groups.select("lang", F.col("g").alias("b"), F.col("source").alias("item"))
    named = both.join(broadcast_if_small(names), ["lang", "a"])
    return named.join(broadcast_if_small(items), ["lang", "b"]).select(
        "lang", "source", "item", "value"
    )


def _ranked(values: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return values.select(
        "lang",
        "source",
        F.lit(part).alias("part"),
        "item",
        "value",
        F.row_number().over(order).alias("rank"),
    )


def source_divergence(
    docs: DataFrame,
    least: int = LEAST_DOCUMENTS,
    top: int = TOP_TERMS,
    block_postings: int = BLOCK_POSTINGS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how the sources of a language differ.

    ``docs`` has ``text, lang, source``; nulls are empty strings, and groups like others. A term is
    a run of ASCII letters, lower-cased, and any characters from U+0080 up. A language keeps the
    terms of at least ``least`` of its documents (rows: repeated rows count again). With V kept
    terms and N their occurrences in a group, a kept term has p = 1 + floor(10^9 (count + 2) / (N +
    2V)), and two groups differ in it by floor((p - q)^2 / (p + q)). Part ``pair``: each group
    against each other source of its language, over all kept terms, 0 if there are none; a source
    alone has no pair. Part ``term``: the ``top`` terms a group uses more than its language. Ranks
    go by value, then by item in UTF-8 order. An empty table gives no rows. All sums are exact.
    """
    bounded_batches(docs.sparkSession)
    named = docs.select(
        text_or_empty("lang").alias("lang"),
        text_or_empty("source").alias("source"),
        text_or_empty("text").cast("binary").alias("text"),
    )
    counted, kept = _postings(named, least)
    groups = _groups(named, counted, kept)
    postings = settle(
        counted.join(broadcast_if_small(groups), ["lang", "source"]).select(
            "lang",
            "source",
            "term",
            "g",
            _probability("n", "total").alias("p"),
            _probability("lang_n", "lang_total").alias("q"),
        ),
        "probabilities",
    )
    pairs = _pairs(postings.select("lang", "term", "g", "p"), groups, block_postings)
    over = postings.where("p > q").select(
        "lang",
        "source",
        F.col("term").alias("item"),
        F.expr("((p - q) * (p - q)) div (p + q)").alias("value"),
    )
    return _ranked(pairs, "pair").unionByName(_ranked(over, "term").where(F.col("rank") <= top))
