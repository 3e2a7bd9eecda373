"""Near-duplicate classes by ProbMinHash, banding and exact verification.

A document is the multiset of its five-word shingles. Each shingle sends points at a rate of its
weight, every point to a random component, and a component keeps the shingle of its first point. The
first points of all shingles come first, then the second ones of those that can still win, and so
on: with every component filled, most shingles stop after one point. Two signatures agree in a
component with probability equal to the probability Jaccard similarity of the weighted shingles.

Equal texts are one node. Nodes that share a band of their signature are candidates. A bucket of
candidates first compares all members with a pivot, which links most of them. Buckets that still
hold several classes are cut into blocks, and each two blocks of a bucket meet in a task: there the
pairs of different classes whose rarest shingles meet are compared, each pair in the first bucket it
shares only, and links that span what was found are given out. No bucket is capped.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import bounded_batches, over_cores, text_or_empty
from larder.llm.components import linked_components
from larder.operators.sizes import broadcast_if_small
from larder.session import settle

WORDS = 5
SIMILARITY = 0.8
#: A pair of similarity 0.8 shares no band with probability 0.00003, one of 0.9 with 5e-10.
BANDS, ROWS = 20, 4
#: Bytes of an Arrow batch, and of text whose shingles are held at once: two workers and what their
#: tasks send and read have to fit beside the heap of an executor.
_BATCH_BYTES, _PART_BYTES = 4 << 20, 1 << 20
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)

_WORD_BYTES = np.zeros(256, bool)
_WORD_BYTES[[*b"0123456789abcdefghijklmnopqrstuvwxyz", *range(128, 256)]] = True


#: Texts of ASCII and Latin letters need no look at their characters.
_OTHERS = r"[^\x00-\x7F\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]"
_NO_WORD = r"[^\p{L}\p{M}\p{N}]+"
#: Scripts written without spaces: each character is a word.
_ALONE = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])"


def spaced(text: Column) -> Column:
    """The text with spaces between words, where others than ASCII characters part them."""
    alone = F.regexp_replace(F.regexp_replace(text, _NO_WORD, " "), _ALONE, " $1 ")
    return F.when(text.rlike(_OTHERS), alone).otherwise(text)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(33))
    values = values * _MIX
    values ^= values >> np.uint64(29)
    values = values * _STEP
    return values ^ (values >> np.uint64(32))


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word: a run of letters and digits of a lower-cased text."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    inside = _WORD_BYTES[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, stops = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lengths = stops - starts
    at = np.flatnonzero(inside)
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(len(at)) - np.repeat(firsts, lengths)
    powers = np.cumprod(np.full(lengths.max(), _BASE, np.uint64))
    hashes = np.add.reduceat((data[at].astype(np.uint64) + np.uint64(1)) * powers[place], firsts)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return _mixed(hashes), np.searchsorted(ends, starts, side="right")


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and count of each distinct shingle, by text and hash.

    A text of fewer words than a shingle is one shingle; one without words has none.
    """
    words, owner = _word_hashes(texts)
    sizes = np.bincount(owner, minlength=len(texts))
    padded = np.zeros(len(words) + (WORDS - 1) * len(texts), np.uint64)
    padded[np.arange(len(words)) + (WORDS - 1) * owner] = words
    counts = np.where(sizes > 0, np.maximum(sizes - WORDS + 1, 1), 0)
    doc = np.repeat(np.arange(len(texts)), counts)
    begin = np.cumsum(sizes + WORDS - 1) - (sizes + WORDS - 1)
    first = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + begin[doc]
    value = np.full(len(first), _STEP, np.uint64)
    for at in range(WORDS):
        value = _mixed(value ^ padded[first + at])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    starts = np.flatnonzero(fresh)
    return doc[starts], value[starts], np.diff(np.append(starts, len(doc)))


def signatures(texts: list[bytes], components: int) -> tuple[np.ndarray, np.ndarray]:
    """A row of winning shingles for each text, and which texts have any shingle."""
    doc, element, weight = shingles(texts)
    arrival = np.full(len(texts) * components, np.inf)
    winner = np.zeros(len(texts) * components, np.uint64)
    latest = np.full(len(texts), np.inf)
    some = np.zeros(len(texts), bool)
    some[doc] = True
    time, turn = np.zeros(len(doc)), 0
    while len(doc):
        turn += 1
        draw = _mixed(element + np.uint64(turn * int(_STEP) % (1 << 64)))
        uniform = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
        time = time - np.log(uniform) / weight
        component = (_mixed(draw) % np.uint64(components)).astype(np.int64)
        cell = doc * components + component
        np.minimum.at(arrival, cell, time)
        won = time == arrival[cell]
        winner[cell[won]] = element[won]
        latest = arrival.reshape(-1, components).max(axis=1)
        live = time < latest[doc]
        doc, element, weight, time = doc[live], element[live], weight[live], time[live]
    return winner.reshape(-1, components), some


def _in_parts(texts: list[bytes]) -> Iterator[slice]:
    low, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= _PART_BYTES:
            yield slice(low, i + 1)
            low, held = i + 1, 0
    if low < len(texts):
        yield slice(low, len(texts))


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t.encode() for t in batch["text"].to_pylist()]
        for part in _in_parts(texts):
            found, some = signatures(texts[part], BANDS * ROWS)
            grouped = found.reshape(len(found), BANDS, ROWS)
            key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * _STEP, grouped.shape[:2])
            for at in range(ROWS):
                key = _mixed(key ^ grouped[:, :, at])
            rows = batch.slice(part.start, part.stop - part.start)
            keys = [row if has else [] for row, has in zip(key.view(np.int64), some, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [rows["doc_id"], rows["node"], pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "node", "bands"],
            )


def similarity(
    a: tuple[np.ndarray, np.ndarray],
    b: tuple[np.ndarray, np.ndarray],
    border: float | None = None,
) -> float:
    """Probability Jaccard of two weighted sets (sorted keys, weights), without estimation.

    Within 1e-9 of ``border`` the sum is made in whole numbers and rounded once, so a similarity of
    exactly ``border`` is not told as less.
    """
    _, left, right = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(left):
        return 0.0
    x, y = a[1][left].astype(np.int64), b[1][right].astype(np.int64)
    order = np.argsort(y / x, kind="stable")
    x, y, ratio = x[order], y[order], (y / x)[order]
    # Of each shared element: all of x at no larger ratio (its own elements have ratio 0), and all
    # of y at a larger one (its own have ratio infinity).
    upto = np.searchsorted(ratio, ratio, side="right")
    x_low = np.concatenate([[0], np.cumsum(x)])[upto] + (int(a[1].sum()) - x.sum())
    y_high = int(b[1].sum()) - np.concatenate([[0], np.cumsum(y)])[upto]
    found = float(np.sum(1 / (x_low / x + y_high / y)))
    if border is None or abs(found - border) > 1e-9:
        return found
    alike, times = np.unique(np.stack([x, y, x_low, y_high]), axis=1, return_counts=True)
    terms = zip(*alike.tolist(), times.tolist(), strict=True)
    return float(sum(Fraction(n * p * q, low * q + high * p) for p, q, low, high, n in terms))


def _distances(batches: Iterator[pa.RecordBatch], similar: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left = batch["pivot_text"].dictionary_encode()
        texts = [t.encode() for t in left.dictionary.to_pylist()]
        pivots = _sets(texts)
        others = _sets([t.encode() for t in batch["text"].to_pylist()])
        far = [
            1 - similarity(pivots[p], other, similar)
            for p, other in zip(left.indices.to_pylist(), others, strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch["pivot"], batch["node"], pa.array(far, pa.float64())], ["pivot", "node", "far"]
        )


def _sets(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for part in _in_parts(texts):
        own = texts[part]
        doc, value, count = shingles(own)
        cuts = np.searchsorted(doc, np.arange(len(own) + 1))
        out += [(value[a:b], count[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    return out


def _measure(pairs: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """``pivot, node, far`` of the pairs.

    Pivots are few; their texts are broadcast if they measure small, else joined by shuffle.
    """
    named = texts.select(F.col("node").alias("pivot"), F.col("text").alias("pivot_text"))
    pivots = settle(named.join(pairs.select("pivot").distinct(), "pivot"), "pivot-texts")
    return settle(
        pairs.join(texts, "node")
        .join(broadcast_if_small(pivots), "pivot")
        .mapInArrow(
            lambda b: _distances(b, similar), "pivot binary, node binary, far double"
        ),
        "distances",
    )


def _relabelled(frame: DataFrame, merged: DataFrame) -> DataFrame:
    """``frame`` with its labels replaced where ``merged`` (``old, new``) has another."""
    return frame.join(merged, F.col("label") == F.col("old"), "left").select(
        *(c for c in frame.columns if c != "label"), F.coalesce("new", "label").alias("label")
    )


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = _sets([t.encode() for t in batch["text"].to_pylist()])
        yield pa.RecordBatch.from_arrays(
            [
                batch["node"],
                pa.array([v.view(np.int64) for v, _ in sets], pa.list_(pa.int64())),
                pa.array([c / max(c.sum(), 1) for _, c in sets], pa.list_(pa.float64())),
            ],
            ["node", "shingles", "shares"],
        )


def _cut_prefix(batches: Iterator[pa.RecordBatch], reach: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = batch["common"].value_lengths().to_numpy()
        ends = np.cumsum(lengths, dtype=np.int64)
        flat = batch["common"].flatten()
        shingle, share = flat.field("shingle").to_numpy(), flat.field("share").to_numpy()
        prefixes = []
        for low, high in zip(ends - lengths, ends, strict=True):
            shares = share[low:high]
            before = 1 - shares.sum() + np.cumsum(shares) - shares
            prefixes.append(shingle[low:high][before <= reach])
        yield pa.RecordBatch.from_arrays(
            [batch["node"], pa.array(prefixes, pa.list_(pa.int64()))], ["node", "prefix"]
        )


def _prefixes(texts: DataFrame, reach: float) -> DataFrame:
    """``node, prefix``: the rarest shingles of a node that a partner must share one of.

    The similarity is at most the share of a node's weight in common shingles. So of two similar
    nodes the rarest common shingle, rare by the nodes here, comes in either before a weight of more
    than ``reach`` is passed. Shingles of one node alone come first and cannot be common.
    """
    lists = texts.mapInArrow(
        _shingle_rows, "node binary, shingles array<long>, shares array<double>"
    )
    lists = settle(lists.withColumn("id", F.monotonically_increasing_id()), "shingle-lists")
    each = lists.select("id", F.explode(F.arrays_zip("shingles", "shares")).alias("s")).select(
        "id", F.col("s.shingles").alias("shingle"), F.col("s.shares").alias("share")
    )
    counts = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    common = broadcast_if_small(settle(counts.where("n > 1"), "common"))
    ordered = F.array_sort(F.collect_list(F.struct("n", "shingle", "share")))
    shared = each.join(common, "shingle").groupBy("id").agg(ordered.alias("common"))
    return settle(
        shared.join(lists.select("id", "node"), "id")
        .select("node", "common")
        .mapInArrow(lambda b: _cut_prefix(b, reach + 1e-9), "node binary, prefix array<long>"),
        "prefixes",
    )


def _open(active: DataFrame) -> DataFrame:
    """The members of buckets that hold several classes."""
    labels = active.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return active.join(settle(labels.where("low != high").select("bucket"), "open"), "bucket")


def _pivots(active: DataFrame) -> DataFrame:
    """``bucket, pivot``: of each bucket the smallest node, so like buckets have the same."""
    return active.groupBy("bucket").agg(F.min("node").alias("pivot"))


def _overlapping(prefixes: list[np.ndarray]) -> np.ndarray:
    """Which two of the members have a shingle of their prefixes in common."""
    owner = np.repeat(np.arange(len(prefixes)), [len(p) for p in prefixes])
    order = np.argsort(np.concatenate(prefixes), kind="stable")
    flat, owner = np.concatenate(prefixes)[order], owner[order]
    meets = np.zeros((len(prefixes), len(prefixes)), bool)
    edges = np.flatnonzero(np.diff(flat)) + 1
    for members in np.split(owner, edges):
        if len(members) > 1:
            meets[np.ix_(members, members)] = True
    return meets


def _first_shared(bands: np.ndarray, bucket: int) -> np.ndarray:
    """Which two of the members share no band before that of the bucket."""
    at = int(np.flatnonzero(bands[0] == bucket)[0])
    shared = np.zeros((len(bands), len(bands)), bool)
    for band in range(at):
        shared |= bands[:, band, None] == bands[None, :, band]
    return ~shared


def _linked_in_block(rows: pa.Table, similar: float) -> list[tuple[bytes, bytes]]:
    """Links between classes that span the similar pairs of one or two blocks of a bucket."""
    labels = rows["label"].to_pylist()
    names = {label: n for n, label in enumerate(dict.fromkeys(labels))}
    own = np.array([names[label] for label in labels])
    block = rows["own"].to_numpy()
    asked = own[:, None] != own[None, :]
    if rows["one"][0].as_py() != rows["two"][0].as_py():
        asked &= block[:, None] != block[None, :]
    bands = np.array(rows["bands"].to_pylist(), np.int64).reshape(len(own), BANDS)
    asked &= _first_shared(bands, rows["bucket"][0].as_py())
    asked &= _overlapping([np.array(p, np.int64) for p in rows["prefix"].to_pylist()])
    wanted = np.flatnonzero(asked.any(axis=1))
    if not len(wanted):
        return []
    texts = rows["text"].take(pa.array(wanted)).to_pylist()
    sets = dict(zip(wanted.tolist(), _sets([t.encode() for t in texts]), strict=True))
    root = list(range(len(names)))

    def find(n: int) -> int:
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    spelled, links = list(names), []
    for a, b in zip(*np.nonzero(np.triu(asked)), strict=True):
        x, y = find(own[a]), find(own[b])
        if x != y and similarity(sets[a], sets[b], similar) >= similar:
            root[max(x, y)] = min(x, y)
            links.append((spelled[own[a]], spelled[own[b]]))
    return links


def _block_links(batches: Iterator[pa.RecordBatch], similar: float) -> Iterator[pa.RecordBatch]:
    """Links from members sorted by ``bucket, one, two``; the last group waits for its end."""
    held: list[pa.Table] = []
    key = None

    def linked() -> pa.RecordBatch:
        links = _linked_in_block(pa.concat_tables(held).combine_chunks(), similar)
        ends = [pa.array([link[at] for link in links], pa.binary()) for at in (0, 1)]
        return pa.RecordBatch.from_arrays(ends, ["a", "b"])

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        columns = [rows[c].to_numpy() for c in ("bucket", "one", "two")]
        fresh = np.zeros(rows.num_rows, bool)
        for column in columns:
            fresh[1:] |= column[1:] != column[:-1]
        cuts = [0, *np.flatnonzero(fresh).tolist(), rows.num_rows]
        for low, high in zip(cuts, cuts[1:], strict=False):
            if low == high:
                continue
            own = tuple(column[low] for column in columns)
            if held and own != key:
                yield linked()
                held = []
            held.append(rows.slice(low, high - low))
            key = own
    if held:
        yield linked()


#: Members and bytes of text of one block.
BLOCK_NODES, BLOCK_BYTES = 512, 4 << 20


def _links_between(
    active: DataFrame, nodes: DataFrame, texts: DataFrame, similar: float, block: int
) -> DataFrame:
    """``a, b``: links between classes in open buckets, all of them told or implied by others."""
    sized = active.join(texts.select("node", F.octet_length("text").alias("bytes")), "node")
    sizes = sized.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("all"))
    blocks = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("all") / BLOCK_BYTES))
    counted = settle(sizes.select("bucket", blocks.cast("int").alias("blocks")), "bucket-blocks")
    dealt = active.join(broadcast_if_small(counted), "bucket").withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    # A block meets itself and every other block of its bucket.
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = met.select(
        "bucket",
        F.least("own", "other").alias("one"),
        F.greatest("own", "other").alias("two"),
        "own",
        "node",
        "label",
        "prefix",
    )
    named = active.select("node").distinct().join(nodes.select("node", "bands"), "node")
    known = settle(named.join(texts, "node"), "members-texts")
    by = ["bucket", "one", "two"]
    return (
        placed.join(known, "node")
        .repartition(*by)
        .sortWithinPartitions(*by)
        .mapInArrow(lambda b: _block_links(b, similar), "a binary, b binary")
        .distinct()
    )


def _merged(links: DataFrame) -> DataFrame:
    """``old, new`` of the classes that the links join."""
    found = linked_components(links)
    return found.select(F.col("node").alias("old"), F.col("label").alias("new"))


def _verified(
    members: DataFrame, nodes: DataFrame, texts: DataFrame, similar: float, block: int
) -> DataFrame:
    """``node, label`` of all nodes in buckets: nodes linked over some buckets have one label.

    ``members`` has ``bucket, node``, ``nodes`` the bands of each node. First each bucket's pivot
    is measured against its other members, and is then done with there. Members of buckets of
    several classes go on if they have a prefix, and a bucket of several classes is compared block
    by block.
    """
    reach = 1 - similar
    pivots = settle(_pivots(members), "pivots")
    pairs = members.join(pivots, "bucket").where("node <> pivot").select("pivot", "node")
    far = _measure(settle(pairs.distinct(), "pairs"), texts, similar)
    near = far.where(F.col("far") <= reach)
    merged = _merged(near.select(F.col("pivot").alias("a"), F.col("node").alias("b")))
    single = members.select("node").distinct().withColumn("label", F.col("node"))
    labels = settle(_relabelled(single, merged), "node-labels")
    done = pivots.select("bucket", F.col("pivot").alias("node"))
    rest = members.join(done, ["bucket", "node"], "left_anti").join(labels, "node")
    active = settle(_open(settle(rest, "left")), "active")
    if not active.limit(1).count():
        return labels
    wanted = broadcast_if_small(settle(active.select("node").distinct(), "wanted"))
    prefixes = _prefixes(texts.join(wanted, "node"), reach)
    kept = active.join(prefixes.where(F.size("prefix") > 0), "node")
    active = settle(_open(settle(kept, "left")), "active")
    links = settle(_links_between(active, nodes, texts, similar, block), "links")
    return settle(_relabelled(labels, _merged(links)), "node-labels")


def _classes(texts: DataFrame, similar: float, block: int) -> DataFrame:
    """``doc_id, node, class_id, class_node`` of every row of ``doc_id, text, node``."""
    lowered = texts.withColumn("text", spaced(F.lower("text")))
    signed = settle(
        over_cores(lowered).mapInArrow(_bands, "doc_id long, node binary, bands array<long>"),
        "signed",
    )
    nodes = settle(
        signed.groupBy("node").agg(F.min("doc_id").alias("first"), F.min("bands").alias("bands")),
        "nodes",
    )
    bands = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = bands.groupBy("bucket").count().where("count > 1").select("bucket")
    members = settle(bands.join(settle(shared, "buckets"), "bucket"), "members")
    wanted = settle(members.select("node").distinct(), "wanted")
    involved = settle(
        lowered.join(broadcast_if_small(wanted), "node")
        .groupBy("node")
        .agg(F.first("text").alias("text")),
        "texts",
    )
    labels = _verified(members, nodes, involved, similar, block)
    own = nodes.select("node", "first")
    named = settle(
        own.join(labels, "node", "left").select(
            "node", "first", F.coalesce("label", "node").alias("label")
        ),
        "named",
    )
    order = F.struct(F.col("first").isNull().alias("late"), "first", "node")
    least = settle(named.groupBy("label").agg(F.min(order).alias("least")), "least")
    classes = settle(
        named.join(least, "label").select(
            "node", F.col("least.first").alias("class_id"), F.col("least.node").alias("class_node")
        ),
        "classes",
    )
    return signed.select("doc_id", "node").join(classes, "node")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text")
    ).withColumn("node", F.unhex(F.md5("text")))


def _kept():
    return F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("node") == F.col("class_node"))


def near_duplicates(
    docs: DataFrame,
    similar: float = SIMILARITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = BLOCK_NODES,
) -> DataFrame:
    """``doc_id, class_id, kept`` of every document: its near-duplicate class.

    A class is made by links of probability Jaccard ``similar`` or more over five-word shingles
    weighted by their count, and by equal texts. Words are runs of Unicode letters, marks and
    digits, lower-cased; in scripts written without spaces each character is a word.
    ``class_id`` is the smallest id in the class; its row is ``kept``. A text of one to four words
    is one shingle; ``block`` is how many members of a bucket one side of a task holds, and changes
    no result. Texts without words, null ones too (as empty), are only like equal texts. Rows
    of one id are told apart by their text; rows alike in both are kept together. Null ids come
    last: a class of null ids has a null ``class_id``. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession, _BATCH_BYTES)
    return _classes(_keyed(docs, id_col, text_col), similar, block).select(
        "doc_id", "class_id", _kept().alias("kept")
    )


def first_of_class(
    docs: DataFrame,
    similar: float = SIMILARITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = BLOCK_NODES,
) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns.

    Rows alike in id and text are kept together, as they are one there; an empty table stays empty.
    """
    bounded_batches(docs.sparkSession, _BATCH_BYTES)
    classes = _classes(_keyed(docs, id_col, text_col), similar, block)
    kept = classes.where(_kept()).select("doc_id", "node")
    named = docs.select(
        *(F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)),
        F.col(id_col).cast("bigint").alias("_id"),
        F.unhex(F.md5(text_or_empty(text_col))).alias("_node"),
    )
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_node") == F.col("node"))
    return named.join(kept, same, "left_semi").select(
        *(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns))
    )
