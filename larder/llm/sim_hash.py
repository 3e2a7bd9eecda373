"""Near-duplicate classes by SimHash fingerprints and pigeonring filtering.

Fingerprints of 64 bits link if they differ in 3 bits at most. Cut into 8 segments on a ring, the
differences of such a pair have a starting segment from which every chain of l segments differs in
at most 3 l / 8 bits: not at all in the first two, in one bit at most up to the fifth, in two up to
the seventh. So the first two segments are equal and of the next three at least two are: for each
start and each segment of those three that is left out, the 32 bits of the four others are a key
that the pair shares. Among the members of a key the chains of five and of seven segments are held
to their budgets before all 64 bits are compared.

Equal fingerprints are one node. Keys of many members are cut into blocks, and each two blocks of a
key meet in a task of their own. A task gives out links that span what it found, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import bounded_batches, over_cores, text_or_empty
from larder.llm.components import linked_components
from larder.llm.letter_runs import PIECE_BYTES, pieces
from larder.operators.sizes import broadcast_if_small
from larder.session import settle

WORDS = 3
SEED = 42
BITS = 3
SEGMENTS, SEGMENT_BITS = 8, 8
#: Fingerprints of one key that meet in one task; keys of more are cut into blocks of so many.
BLOCK = 2048
#: Shingles whose bits are counted at once.
_SHINGLES = 1 << 18

#: A-Z lower-cased, ASCII white space as spaces.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
#: The bits of each byte value, lowest first.
_BYTE_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def _shingle_hashes(text: bytes, size: int = PIECE_BYTES) -> Iterator[np.ndarray]:
    """Hashes of the shingles of a text, part by part; a text without words has none."""
    held: list[bytes] = []
    whole = True
    for piece in pieces(text.translate(_TABLE), size):
        words = held + piece.split()
        held = words[1 - WORDS :] if len(words) >= WORDS else words
        if len(words) >= WORDS:
            whole = False
            shingles = map(b" ".join, zip(words, words[1:], words[2:], strict=False))
            yield np.array(list(map(xxhash.xxh64_intdigest, shingles, repeat(SEED))), np.uint64)
    if whole and held:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], np.uint64)


def _set_bits(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """How many of each owner's hashes have each bit set: a row of 64 counts for each owner."""
    counts = np.empty((n, 64), np.int64)
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    for at in range(8):
        values = np.bincount(owner * 256 + octets[:, at], minlength=n * 256)
        counts[:, at * 8 : at * 8 + 8] = values.reshape(n, 256) @ _BYTE_BITS
    return counts


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """The fingerprint of each text: the bits set in over half of its shingles' hashes."""
    counts, sizes = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    held: list[np.ndarray] = []
    owners: list[int] = []

    def add() -> None:
        if held:
            low, lengths = owners[0], [len(h) for h in held]
            owner = np.repeat(np.array(owners) - low, lengths)
            n = owners[-1] - low + 1
            counts[low : low + n] += _set_bits(np.concatenate(held), owner, n)
            sizes[low : low + n] += np.bincount(owner, minlength=n)
        held.clear()
        owners.clear()

    waiting = 0
    for i, text in enumerate(texts):
        for hashes in _shingle_hashes(text):
            held.append(hashes)
            owners.append(i)
            waiting += len(hashes)
            if waiting >= _SHINGLES:
                add()
                waiting = 0
    add()
    majority = counts * 2 > sizes[:, None]
    return np.packbits(majority, axis=1, bitorder="little").view("<u8")[:, 0]


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = fingerprints(batch["text"].to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(found.astype(np.int64))], ["doc_id", "fp"]
        )


def _ring(start: int, segments: int) -> int:
    """The bits of ``segments`` segments from ``start`` on, around the ring."""
    ring = [(start + k) % SEGMENTS for k in range(segments)]
    return sum(((1 << SEGMENT_BITS) - 1) << (s * SEGMENT_BITS) for s in ring)


#: For each start the chains and their budgets; shorter chains of the same budget are within them.
CHAINS = [[(_ring(s, length), BITS * length // SEGMENTS) for length in (5, 7)] for s in range(8)]
#: The bits of each key, and the start of its chain: of segments 3 to 5 one is left out.
KEYS = [
    (start, _ring(start, 5) & ~_ring((start + left_out) % SEGMENTS, 1))
    for start in range(SEGMENTS)
    for left_out in (2, 3, 4)
]


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``kind, bits, fp``: every fingerprint under each of its keys."""
    for batch in batches:
        fps = batch["fp"].to_numpy().view(np.uint64)
        for kind, (_, mask) in enumerate(KEYS):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(fps), kind, np.int32)),
                    pa.array((fps & np.uint64(mask)).view(np.int64)),
                    batch["fp"],
                ],
                ["kind", "bits", "fp"],
            )


def _near(one: np.ndarray, others: np.ndarray, start: int) -> np.ndarray:
    """Which pairs keep the budgets of the chains, shortest first, and of the whole ring."""
    apart = one ^ others
    near = np.ones(apart.shape, bool)
    for mask, budget in CHAINS[start]:
        near &= np.bitwise_count(apart & np.uint64(mask)) <= budget
    return near & (np.bitwise_count(apart) <= BITS)


def _spanning(fps: np.ndarray, start: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links that span the near ones among ``fps``: each is reached once from one before it."""
    left, right = [], []
    waiting = fps
    while len(waiting):
        reached, waiting = waiting[:1], waiting[1:]
        while len(reached) and len(waiting):
            near = _near(reached[0], waiting, start)
            if near.any():
                found = waiting[near]
                left.append(np.full(len(found), reached[0]))
                right.append(found)
                reached, waiting = np.concatenate([reached, found]), waiting[~near]
            reached = reached[1:]
    return left, right


#: Up to this size the members of a key are compared shift by shift, all keys at once.
_SMALL = 8


def spanning_links(kind: np.ndarray, group: np.ndarray, fps: np.ndarray) -> np.ndarray:
    """Links (rows of two) that span the near fingerprints of each group; groups are runs."""
    start = np.array([s for s, _ in KEYS])[kind]
    edges = np.flatnonzero(np.diff(group, prepend=group[:1] - 1))
    sizes = np.diff(np.append(edges, len(group)))
    size = np.repeat(sizes, sizes)
    left, right = [], []
    small = np.flatnonzero((size <= _SMALL) & (size > 1))
    for shift in range(1, _SMALL):
        a = small[:-shift]
        a = a[group[a] == group[np.minimum(a + shift, len(group) - 1)]]
        a = a[a + shift < len(group)]
        for s in range(SEGMENTS):
            x = a[start[a] == s]
            near = x[_near(fps[x], fps[x + shift], s)]
            left.append(fps[near])
            right.append(fps[near + shift])
    for edge, n in zip(edges[sizes > _SMALL], sizes[sizes > _SMALL], strict=True):
        found = _spanning(fps[edge : edge + n], int(start[edge]))
        left += found[0]
        right += found[1]
    if not left:
        return np.zeros((0, 2), np.uint64)
    return np.unique(np.stack([np.concatenate(left), np.concatenate(right)], axis=1), axis=0)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links from members sorted by ``kind, bits, one, two``; the last group waits for its end."""
    held: pa.Table | None = None

    def linked(rows: pa.Table) -> pa.RecordBatch:
        columns = [rows[c].to_numpy() for c in ("kind", "bits", "one", "two")]
        fresh = np.zeros(rows.num_rows, bool)
        for column in columns:
            fresh[1:] |= column[1:] != column[:-1]
        fps = rows["fp"].to_numpy().view(np.uint64)
        links = spanning_links(columns[0], np.cumsum(fresh), fps).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], ["a", "b"])

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        if not rows.num_rows:
            continue
        last = np.ones(rows.num_rows, bool)
        for name in ("kind", "bits", "one", "two"):
            column = rows[name].to_numpy()
            last &= column == column[-1]
        cut = rows.num_rows - int(last.sum())
        if cut:
            yield linked(rows.slice(0, cut))
        held = rows.slice(cut)
    if held is not None:
        yield linked(held)


def near_links(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """``a, b``: links that span the near ones among the distinct fingerprints ``fp``."""
    members = settle(nodes.mapInArrow(_keys, "kind int, bits long, fp long"), "keys")
    sizes = members.groupBy("kind", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = settle(sizes, "key-sizes")
    shared = members.join(broadcast_if_small(sizes), ["kind", "bits"]).withColumn(
        "blocks", F.ceil(F.col("n") / block).cast("int")
    )
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    # A block meets itself and every other block of its key.
    met = shared.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    placed = met.select(
        "kind",
        "bits",
        F.least("own", "other").alias("one"),
        F.greatest("own", "other").alias("two"),
        "fp",
    )
    by = ["kind", "bits", "one", "two"]
    found = placed.repartition(*by).sortWithinPartitions(*by).mapInArrow(_links, "a long, b long")
    return settle(found.distinct(), "links")


def sim_hash_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document.

    Words are runs of other characters than ASCII white space, A-Z lower-cased; a text of fewer
    words than a shingle is one shingle. A text without words, null ones too, has the fingerprint
    zero and links like any other. Components are joined over any number of links of 3 bits or
    fewer; ``component_id`` is the smallest id in them, null if all their ids are null. Rows of one
    id stay apart, repeated rows too. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    named = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        text_or_empty(text_col).cast("binary").alias("text"),
    )
    signed = settle(over_cores(named).mapInArrow(_signed, "doc_id long, fp long"), "fingerprints")
    nodes = settle(signed.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    labels = linked_components(near_links(nodes.select("fp"), block))
    joined = nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("label")
    )
    joined = settle(joined, "labelled")
    least = joined.groupBy("label").agg(F.min("first").alias("component_id"))
    classes = settle(joined.join(least, "label").select("fp", "component_id"), "components")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return signed.join(broadcast_if_small(classes), "fp").select("doc_id", digits, "component_id")
