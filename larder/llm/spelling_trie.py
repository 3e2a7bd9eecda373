"""Spelling variants: exact neighbours at one edit from a dictionary of pairs of trie nodes.

The words are sorted by range, and every prefix becomes a node of a forward trie, numbered in the
order of the words; reversed words number the suffixes alike. So a pair of whole numbers (prefix
node, suffix node) stands for a word with a cut in it, however long it is, and for a word with one
position skipped. Two words that differ in one replaced code point share the pair around it; a word
with one code point more has, around it, the pair that the shorter word has at that cut. Each two
neighbours meet in one pair only: a code point of a run of equal ones is skipped at the run's
beginning. The members of a pair differ in one code point, so they are as few as the alphabet; each
is told its number of neighbours there and the best one, and no pairs of words are written.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import bounded_batches, over_cores, text_or_empty
from larder.llm.letter_runs import letter_runs
from larder.session import settle

LEAST_LENGTH = 5
LEAST_COUNT = 3
#: One in so many pairs of document and run loses a code point.
NOISE = 97
#: Characters of two or more bytes that are not U+00C0 to U+00FF.
_OTHER = re.compile(
    rb"(?:[\xc2\xc4-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf7][\x80-\xbf]{3})+"
)
_HELD_WORDS = 1 << 18
#: A pair holds one of these: a word with a position skipped, inside a run of equal code points or
#: at its beginning, or a whole word cut at a place.
INSIDE, SKIPPED, WHOLE = 0, 1, 2


def count_words(doc_id: int | None, text: bytes, total: Counter, shortest: int, noise: int) -> None:
    """Add a text's runs to ``total``; runs of fewer than ``shortest`` bytes are left out."""
    prefix = crc32(b":" if doc_id is None else b"%d:" % doc_id)
    text = text if text.isascii() else _OTHER.sub(b" ", text)
    for runs in letter_runs(text):
        runs = [run for run in runs if len(run) >= shortest]
        total.update(runs)
        distinct = list(set(runs))
        hashes = np.fromiter(map(crc32, distinct, repeat(prefix)), np.int64, len(distinct))
        hit = {distinct[i]: int(hashes[i]) for i in np.flatnonzero(hashes % noise == 0)}
        for run, n in Counter(filter(hit.__contains__, runs)).items():
            points = run.decode()
            at = hit[run] % len(points)
            total[run] -= n
            total[(points[:at] + points[at + 1 :]).encode()] += n


def _counted(
    batches: Iterator[pa.RecordBatch], shortest: int, noise: int
) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()

    def part() -> pa.RecordBatch:
        pairs = [(w, n) for w, n in total.items() if n and len(w) >= shortest]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([w for w, _ in pairs], pa.binary()).cast(pa.string()),
                pa.array([n for _, n in pairs], pa.int64()),
            ],
            ["word", "n"],
        )

    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            count_words(doc_id, text, total, shortest, noise)
            if len(total) >= _HELD_WORDS:
                yield part()
                total.clear()
    if total:
        yield part()


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LEAST_LENGTH,
    least: int = LEAST_COUNT,
    noise: int = NOISE,
) -> DataFrame:
    """``word, n``: the words of at least ``length`` code points and ``least`` occurrences."""
    bounded_batches(docs.sparkSession)
    named = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        text_or_empty(text_col).cast("binary").alias("text"),
    )
    runs = over_cores(named).mapInArrow(
        lambda b: _counted(b, length, noise), "word string, n long"
    )
    counted = runs.where(F.length("word") >= length).groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least)


def _common(one: str, other: str) -> int:
    """Length of the common prefix."""
    if other.startswith(one):
        return len(one)
    for at, (x, y) in enumerate(zip(one, other, strict=False)):
        if x != y:
            return at
    return min(len(one), len(other))


def _local_paths(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Sorted words with the nodes of their prefixes, numbered from 1 in this task; 0 is the root."""
    pid = TaskContext.get().partitionId()
    path, before, following = [0], "", 1
    for batch in batches:
        flat, sizes = [], []
        for word in batch[column].to_pylist():
            shared = _common(before, word)
            del path[shared + 1 :]
            path.extend(range(following, following + len(word) - shared))
            following += len(word) - shared
            flat += path
            sizes.append(len(path))
            before = word
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns,
                pa.array(np.full(len(sizes), pid), pa.int32()),
                pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int64())),
            ],
            [*batch.schema.names, "pid", "path"],
        )


def _stitched(edges: list) -> list[tuple[int, int, list[int], int]]:
    """For each task's range: how deep its first word hangs in nodes of earlier ranges, and where.

    ``edges`` has the first and last word of each range, the last one's path and the number of
    nodes. Words are sorted, so only the first word's prefixes can be known from earlier ranges.
    """
    out, start, before, known = [], 0, "", [0]
    for edge in sorted(edges, key=lambda e: e["first"]):
        shared = _common(before, edge["first"])
        out.append((edge["pid"], shared, known[: shared + 1], start - shared))
        known = [known[x] if x <= shared else start - shared + x for x in edge["path"]]
        start += edge["nodes"] - shared
        before = edge["last"]
    return out


def numbered(words: DataFrame, column: str, name: str) -> DataFrame:
    """Add ``name``: the trie nodes of all prefixes of ``column``, the root 0 first.

    Equal prefixes have one number, different ones different numbers, over all tasks; numbers grow
    with the words in code-point order. Only the edges of the tasks' ranges come to the driver.
    """
    kinds = ", ".join(f"`{c}` {kind}" for c, kind in words.dtypes)
    local = settle(
        words.repartitionByRange(column)
        .sortWithinPartitions(column)
        .mapInArrow(lambda b: _local_paths(b, column), f"{kinds}, pid int, path array<long>"),
        f"{name}-paths",
    )
    # One row for each task of the sort.
    edges = local.groupBy("pid").agg(
        F.min(column).alias("first"),
        F.max(F.struct(column, "path")).alias("last"),
        F.max(F.array_max("path")).alias("nodes"),
    )
    edges = edges.select("pid", "first", F.col(f"last.{column}").alias("last"), "last.path", "nodes")
    stitched = words.sparkSession.createDataFrame(
        _stitched(edges.collect()), "pid int, shared long, known array<long>, start long"
    )
    node = F.transform(
        "path",
        lambda x: F.when(x <= F.col("shared"), F.get("known", x.cast("int"))).otherwise(
            F.col("start") + x
        ),
    )
    return local.join(F.broadcast(stitched), "pid").select(*words.columns, node.alias(name))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``p, s, kind, id, n``: each word's cuts and skips; a word's id is its last prefix node."""
    for batch in batches:
        forward = batch["forward"].flatten().to_numpy()
        backward = batch["backward"].flatten().to_numpy()
        sizes = batch["forward"].value_lengths().to_numpy().astype(np.int64)
        points = np.frombuffer("".join(batch["word"].to_pylist()).encode("utf-32-le"), np.uint32)
        ends = np.cumsum(sizes)
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(ends[-1] if len(ends) else 0) - (ends - sizes)[row]
        # The suffix after place i of a word of L code points is node L - i of the reversed word.
        suffix = backward[(ends - 1)[row] - place]
        skip = np.flatnonzero(place < sizes[row] - 1)
        begins = np.ones(len(skip), bool)
        begins[1:] = points[1:] != points[:-1]
        begins |= place[skip] == 0
        kinds = [np.full(len(row), WHOLE, np.int8), np.where(begins, SKIPPED, INSIDE).astype(np.int8)]
        owner = np.concatenate([row, row[skip]])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([forward, forward[skip]])),
                pa.array(np.concatenate([suffix, suffix[skip + 1]])),
                pa.array(np.concatenate(kinds)),
                pa.array(forward[ends - 1][owner]),
                batch["n"].take(pa.array(owner)),
            ],
            ["p", "s", "kind", "id", "n"],
        )


def neighbours(
    p: np.ndarray, s: np.ndarray, kind: np.ndarray, word: np.ndarray, n: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the members of pairs: the words that have neighbours there, how many, and the best one.

    The best has the largest ``n``, then the smallest ``word``.
    """
    order = np.lexsort((word, -n, kind == WHOLE, s, p))
    p, s, kind, word, n = (x[order] for x in (p, s, kind, word, n))
    fresh = np.ones(len(p), bool)
    fresh[1:] = (p[1:] != p[:-1]) | (s[1:] != s[:-1])
    first = np.flatnonzero(fresh)
    group = np.cumsum(fresh) - 1
    sizes = np.diff(np.append(first, len(p)))
    whole = np.bincount(group[kind == WHOLE], minlength=len(first))
    skips = sizes - whole
    begins = np.bincount(group[kind == SKIPPED], minlength=len(first))
    at = np.flatnonzero(kind == SKIPPED)
    best_begin = np.full(len(first), -1)
    best_begin[group[at][::-1]] = at[::-1]
    row = np.arange(len(p))
    # For a skip the first other one, and the whole word if its own run begins there.
    other = np.where(row == first[group], row + 1, first[group])
    near = np.where(kind == WHOLE, begins[group], skips[group] - 1)
    best = np.where(kind == WHOLE, best_begin[group], np.where(near > 0, other, -1))
    last = (first + sizes - 1)[group]
    meets = (kind == SKIPPED) & (whole[group] > 0)
    better = meets & (
        (best < 0)
        | (n[last] > n[best])
        | ((n[last] == n[best]) & (word[last] < word[best]))
    )
    best = np.where(better, last, best)
    near = near + meets
    some = np.flatnonzero(near > 0)
    return word[some], near[some], n[best[some]], word[best[some]]


def _nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members sorted by ``p, s``; the last pair of a batch waits for its end."""
    held: pa.Table | None = None

    def told(rows: pa.Table) -> pa.RecordBatch:
        columns = (rows[c].to_numpy() for c in ("p", "s", "kind", "id", "n"))
        arrays = [pa.array(x, pa.int64()) for x in neighbours(*columns)]
        return pa.RecordBatch.from_arrays(arrays, ["id", "near", "best_n", "best"])

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        if not rows.num_rows:
            continue
        p, s = rows["p"].to_numpy(), rows["s"].to_numpy()
        last = np.flatnonzero((p != p[-1]) | (s != s[-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield told(rows.slice(0, cut))
        held = rows.slice(cut)
    if held is not None:
        yield told(held)


def _roots(forms: DataFrame) -> DataFrame:
    """``id, root`` of the words that have a form: forms are followed, twice as far each round.

    A form is at least twice as frequent as its word, so chains end, after 63 steps at most.
    """
    roots = settle(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("id").alias("root"), F.col("root").alias("further"))
        joined = settle(roots.join(ahead, "root", "left"), "followed")
        roots = joined.select("id", F.coalesce("further", "root").alias("root"))
        if not joined.where(F.col("further").isNotNull()).limit(1).count():
            return roots


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LEAST_LENGTH,
    least: int = LEAST_COUNT,
    noise: int = NOISE,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word.

    Runs are made of ASCII letters, lower-cased, and U+00C0 to U+00FF; null texts have none. Where
    ``noise`` divides the CRC-32 of ``<id>:<run>`` (a null id is written as nothing), the run loses
    one code point. Words have at least ``length`` code points and ``least`` occurrences over all
    rows; repeated rows count again. ``n_near`` counts the words at exactly one inserted, deleted or
    replaced code point; ``form`` is the most frequent of them, ties to the smallest in code-point
    order, if at least twice as frequent as the word, else null; ``root`` is where forms lead, the
    word itself without one. An empty table gives no rows.
    """
    words = settle(word_counts(docs, id_col, text_col, length, least, noise), "words")
    forward = numbered(words, "word", "forward").withColumn("turned", F.reverse("word"))
    both = settle(numbered(forward, "turned", "backward").drop("turned"), "nodes")
    pairs = both.mapInArrow(_pairs, "p long, s long, kind byte, id long, n long")
    met = pairs.repartition("p", "s").sortWithinPartitions("p", "s")
    best = F.max(F.struct("best_n", (-F.col("best")).alias("low"))).alias("best")
    near = settle(
        met.mapInArrow(_nearest, "id long, near long, best_n long, best long")
        .groupBy("id")
        .agg(F.sum("near").alias("n_near"), best),
        "neighbours",
    )
    named = both.select(F.element_at("forward", -1).alias("id"), "word", "n")
    known = named.join(near, "id", "left").select(
        "id",
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(F.col("best.best_n") >= 2 * F.col("n"), -F.col("best.low")).alias("form"),
        F.when(F.col("best.best_n") >= 2 * F.col("n"), F.col("best.best_n")).alias("form_n"),
    )
    known = settle(known, "forms")
    roots = _roots(known.where(F.col("form").isNotNull()))
    spelt = known.select(F.col("id").alias("at"), F.col("word").alias("spelling"))
    ends = known.join(roots, "id", "left")
    forms = spelt.withColumnsRenamed({"at": "form", "spelling": "form_word"})
    tops = spelt.withColumnsRenamed({"at": "root", "spelling": "root_word"})
    return (
        ends.join(forms, "form", "left")
        .join(tops, "root", "left")
        .select(
            "word",
            F.col("form_word").alias("form"),
            F.coalesce("root_word", "word").alias("root"),
            "n",
            "n_near",
            "form_n",
        )
    )
