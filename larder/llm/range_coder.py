"""Token ids in files of independent, checksummed blocks, packed by a context-mixing range coder.

Each id is predicted by the one that last followed the two ids before it (order 2) and the one
that last followed the id before it (order 1). How far either is trusted is learned: two adaptive
estimates of the order-2 guess are mixed by a weight that moves to the better one. An id that
neither guessed is coded by frequency (order 0): first its class, one of sixteen of like weight, by
adaptive frequencies in the context of the two classes before, then the id within its class.

A segment is one row of a table: whole documents, their ids and lengths, a start table and the
blocks. The start table holds what a block would otherwise learn anew: how often each id occurs, how
classes follow each other, and the id that most often follows another. A block starts from that
table alone and ends with its own bytes, so blocks are coded side by side: one step codes the next
id of all blocks of a segment with whole-number array operations.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm.common import bounded_batches, text_or_empty
from larder.llm.tokens import with_end, word_encoder
from larder.session import scratch_path, settle

#: Ids of a block, and ids after which a segment ends with its document.
BLOCK = 4096
SEGMENT = 1024 * BLOCK
MAGIC = b"CMR2"
_HEADER = "<4sIII"  # magic, ids, checksum of the ids, checksum of the rest
SCHEMA = (
    "file long, segment long, doc_ids array<long>, lengths array<long>, start binary, "
    "blocks array<binary>"
)

_TOP, _LOW = 48, 32
_MASK = (1 << _TOP) - 1
_FLAG_BITS, _CLASS_BITS, _OWN_BITS = 15, 14, 18
_SLOTS = 2048
_CLASSES = 16
_TOTAL = 1 << _CLASS_BITS
_TARGETS = np.array(
    [[i if i <= s else _TOTAL - 16 + i for i in range(17)] for s in range(16)], np.int16
)
#: A follower is kept if it comes so many times, and after one in so many of the ids before it.
_FOLLOWS, _FOLLOW_SHARE = 4, 4


def _parts(counts: np.ndarray, total: int) -> np.ndarray:
    """Whole shares of ``total`` along the last axis, in proportion to the counts, none empty."""
    size = counts.shape[-1]
    own = 1 + counts * (total - size) // np.maximum(counts.sum(-1, keepdims=True), 1)
    own[..., 0] += total - own.sum(-1)
    return own


def _level(counts: np.ndarray) -> np.ndarray:
    """Counts in eighths of a power of two, 0 for none, in a byte."""
    return np.where(counts > 0, 1 + 8 * np.log2(np.maximum(counts, 1)).round(3), 0).astype(np.uint8)


def _from_level(levels: np.ndarray) -> np.ndarray:
    """Whole numbers alone decide what is coded, so they are the same on every machine."""
    steps = np.array([256, 279, 304, 332, 362, 395, 431, 470], np.int64)  # 256 * 2 ** (i / 8)
    at = np.maximum(levels.astype(np.int64) - 1, 0)
    return np.where(levels > 0, steps[at % 8] << (at // 8), 0)


class Start:
    """What the blocks of a segment start from, made of bytes that are stored once with it."""

    def __init__(self, data: bytes):
        plain = np.frombuffer(zlib.decompress(data), np.uint8)
        pairs, plain = plain[: _CLASSES**3], plain[_CLASSES**3 :]
        levels, trust, follows = plain[: 1 << 16], plain[1 << 16 : 2 << 16], plain[2 << 16 :]
        counts = _from_level(levels)
        used = np.flatnonzero(counts)
        #: The id that most often follows each, and the trust in it, as the blocks keep them.
        self.follower = trust.astype(np.int32) << 16
        both = follows.reshape(2, -1).astype(np.int32)
        self.follower[np.flatnonzero(trust)] |= both[0] | both[1] << 8
        # Ids from the most frequent one on; a class begins with each sixteenth of the whole.
        order = used[np.argsort(-counts[used], kind="stable")]
        before = np.cumsum(counts[order]) - counts[order]
        classes = before * _CLASSES // max(int(counts.sum()), 1)
        self.class_of = np.zeros(1 << 16, np.int64)
        self.class_of[order] = classes
        self.low, self.own = np.zeros(1 << 16, np.int64), np.ones(1 << 16, np.int64)
        self.id_at = np.zeros(_CLASSES << _OWN_BITS, np.uint16)
        for one in np.unique(classes):
            ids = order[classes == one]
            own = _parts(counts[ids], 1 << _OWN_BITS)
            self.own[ids], self.low[ids] = own, np.cumsum(own) - own
            self.id_at[one << _OWN_BITS : (one + 1) << _OWN_BITS] = np.repeat(ids, own)
        rows = _parts(_from_level(pairs).reshape(_CLASSES**2, _CLASSES), _TOTAL)
        self.rows = np.zeros((_CLASSES**2, _CLASSES + 1), np.int16)
        self.rows[:, 1:] = np.cumsum(rows, axis=1)

    @staticmethod
    def packed(ids: np.ndarray) -> bytes:
        """The start table of a segment's ids."""
        counts = np.bincount(ids, minlength=1 << 16)
        pairs, times = np.unique(
            ids[:-1].astype(np.uint32) << 16 | ids[1:].astype(np.uint32), return_counts=True
        )
        before, after = (pairs >> 16).astype(np.int64), (pairs & 0xFFFF).astype(np.int64)
        best = np.lexsort((after, -times, before))
        best = best[np.unique(before[best], return_index=True)[1]]
        best = best[(times[best] >= _FOLLOWS) & (times[best] * _FOLLOW_SHARE >= counts[before[best]])]
        trust = np.zeros(1 << 16, np.uint8)
        trust[before[best]] = np.minimum(1 + 7 * times[best] // counts[before[best]], 7)
        follows = after[best]
        plain = _level(counts), trust, (follows & 255).astype(np.uint8), (follows >> 8).astype(np.uint8)
        alone = b"".join(part.tobytes() for part in plain)
        classes = Start(zlib.compress(bytes(_CLASSES**3) + alone)).class_of[ids]
        three = (classes[:-2] * _CLASSES + classes[1:-1]) * _CLASSES + classes[2:]
        seen = _level(np.bincount(three, minlength=_CLASSES**3))
        return zlib.compress(seen.tobytes() + alone, 9)


class _Encoder:
    def __init__(self, lanes: int, steps: int):
        self.low = np.zeros(lanes, np.int64)
        self.range = np.full(lanes, _MASK, np.int64)
        self.width = 4 * steps + 8
        self.digits = np.zeros(lanes * self.width, np.int32)
        self.at = np.arange(lanes) * self.width + 1  # a first digit that no carry reaches

    def share(self, bits: int, lanes: np.ndarray | None = None) -> np.ndarray:
        return (self.range if lanes is None else self.range[lanes]) >> bits

    def take(self, share, below, own, lanes: np.ndarray | None = None) -> None:
        """Narrow each range to the part of ``own`` shares that begins after ``below`` shares.

        With ``lanes`` only theirs, so a block does not depend on its neighbours.
        """
        if lanes is None:
            self.low += share * below
            self.range = share * own
            carried = np.flatnonzero(self.low > _MASK)
            short = np.flatnonzero(self.range < 1 << _LOW)
        else:
            low, left = self.low[lanes] + share * below, share * own
            self.low[lanes], self.range[lanes] = low, left
            carried, short = lanes[low > _MASK], lanes[left < 1 << _LOW]
        if len(carried):
            self.digits[self.at[carried] - 1] += 1
            self.low[carried] &= _MASK
        while len(short):
            low, at = self.low[short], self.at[short]
            self.digits[at] = low >> _LOW
            self.low[short] = (low << 16) & _MASK
            self.at[short] = at + 1
            grown = self.range[short] << 16
            self.range[short] = grown
            short = short[grown < 1 << _LOW]

    def finish(self) -> list[bytes]:
        for _ in range(3):
            self.digits[self.at] = self.low >> _LOW
            self.low = (self.low << 16) & _MASK
            self.at += 1
        digits = self.digits.reshape(-1, self.width)
        used = self.at - np.arange(len(digits)) * self.width
        for column in range(int(used.max()) - 1, 0, -1):  # carries that were put off
            over = digits[:, column] >> 16
            if over.any():
                digits[:, column] &= 0xFFFF
                digits[:, column - 1] += over
        return [row[1:n].astype("<u2").tobytes() for row, n in zip(digits, used, strict=True)]


class _Decoder:
    def __init__(self, parts: list[bytes]):
        width = max(len(p) for p in parts) // 2 + 16
        self.digits = np.zeros((len(parts), width), np.int64)
        for row, part in zip(self.digits, parts, strict=True):
            row[: len(part) // 2] = np.frombuffer(part, "<u2")
        self.value = (
            (self.digits[:, 0] << 32) | (self.digits[:, 1] << 16) | self.digits[:, 2]
        )
        self.digits = self.digits.reshape(-1)
        self.range = np.full(len(parts), _MASK, np.int64)
        self.at = np.arange(len(parts)) * width + 3

    def share(self, bits: int, lanes: np.ndarray | None = None) -> np.ndarray:
        return (self.range if lanes is None else self.range[lanes]) >> bits

    def place(self, share: np.ndarray, bits: int, lanes: np.ndarray | None = None) -> np.ndarray:
        value = self.value if lanes is None else self.value[lanes]
        return np.minimum(value // share, (1 << bits) - 1)

    def take(self, share, below, own, lanes: np.ndarray | None = None) -> None:
        if lanes is None:
            self.value -= share * below
            self.range = share * own
            short = np.flatnonzero(self.range < 1 << _LOW)
        else:
            left = share * own
            self.value[lanes] -= share * below
            self.range[lanes] = left
            short = lanes[left < 1 << _LOW]
        while len(short):
            at = self.at[short]
            self.value[short] = (self.value[short] << 16) | self.digits[at]
            self.at[short] = at + 1
            grown = self.range[short] << 16
            self.range[short] = grown
            short = short[grown < 1 << _LOW]


def _coded(
    coder: _Encoder | _Decoder, start: Start, lanes: int, steps: int, ids: np.ndarray | None
):
    """Code ``steps`` ids of every lane; with ``ids`` (steps x lanes) they are written, else read.

    Both ways make the same predictions from the same history.
    """
    lane = np.arange(lanes)
    # A guess and, above its 16 bits, the trust in it.
    guess2, guess1 = np.zeros(lanes * _SLOTS, np.int32), np.zeros(lanes * _SLOTS, np.int32)
    slot_base, trust_base, pair_base = lane * _SLOTS, lane * 8, lane * 16
    # Chances of 32768 that order 2 is right: by its trust; by order 1 and whether both agree.
    by_trust = np.tile((np.arange(8) * 3500 + 600).astype(np.int64), lanes)
    by_pair = np.tile(np.r_[np.full(8, 3000), np.arange(8) * 3500 + 2000].astype(np.int64), lanes)
    by_first = np.tile((np.arange(8) * 2500 + 600).astype(np.int64), lanes)
    weight = np.full(lanes, 128, np.int64)
    # Classes as running sums of their shares, a row for the two classes before.
    table = np.tile(start.rows, (lanes, 1))
    flat, row_base = table.reshape(-1), lane * _CLASSES**2
    one, two = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    context = np.zeros(lanes, np.int64)
    flag_total = 1 << _FLAG_BITS
    out = np.zeros((steps, lanes), np.uint16) if ids is None else None
    writing = ids is not None
    for step in range(steps):
        at2 = slot_base + (((one * 40503 + two * 30011) >> 4) & (_SLOTS - 1))
        at1 = slot_base + (((one * 40503) >> 3) & (_SLOTS - 1))
        last2, last1 = guess2[at2], guess1[at1]
        last1 = np.where(last1 >> 16 == 0, start.follower[one], last1)
        second, sure2 = last2 & 0xFFFF, last2 >> 16
        first, sure1 = last1 & 0xFFFF, last1 >> 16
        agree = second == first
        trust_at, pair_at, first_at = trust_base + sure2, pair_base + sure1, trust_base + sure1
        pair_at += agree * 8
        left, right, chance1 = by_trust[trust_at], by_pair[pair_at], by_first[first_at]
        own2 = (weight * left + (256 - weight) * right) >> 8
        own1 = ((flag_total - own2) * chance1) >> _FLAG_BITS
        own1[agree] = 0
        share = coder.share(_FLAG_BITS)
        both = own2 + own1
        if writing:
            true = ids[step].astype(np.int64)
            hit2 = true == second
            hit1 = (true == first) & ~hit2
        else:
            place = coder.place(share, _FLAG_BITS)
            hit2 = place < own2
            hit1 = (place < both) & ~hit2
            true = np.where(hit2, second, first).astype(np.int64)
        below = np.where(hit2, 0, np.where(hit1, own2, both))
        coder.take(share, below, np.where(hit2, own2, np.where(hit1, own1, flag_total - both)))
        miss = np.flatnonzero(~(hit2 | hit1))
        if len(miss):
            row = row_base[miss] + context[miss]
            rows = table[row]
            share = coder.share(_CLASS_BITS, miss)
            if writing:
                kind = start.class_of[true[miss]]
            else:
                place = coder.place(share, _CLASS_BITS, miss)
                kind = (rows[:, 1:16] <= place[:, None]).sum(axis=1)
            cell = row * (_CLASSES + 1) + kind
            below = flat[cell].astype(np.int64)
            coder.take(share, below, flat[cell + 1] - below, miss)
            rows += (_TARGETS[kind] - rows) >> 5
            table[row] = rows
            share = coder.share(_OWN_BITS, miss)
            if not writing:
                place = coder.place(share, _OWN_BITS, miss)
                true[miss] = start.id_at[(kind << _OWN_BITS) + place]
            own = true[miss]
            coder.take(share, start.low[own], start.own[own], miss)
        if not writing:
            out[step] = true
        goal = hit2 * 32000 + 300
        by_trust[trust_at] = left + ((goal - left) >> 4)
        by_pair[pair_at] = right + ((goal - right) >> 4)
        better = np.abs(goal - left) < np.abs(goal - right)
        weight += (better * 256 - weight) >> 5
        by_first[first_at] = np.where(
            hit2 | agree, chance1, chance1 + ((hit1 * 32000 + 300 - chance1) >> 4)
        )
        kept = np.minimum(sure2 + 1, 7) << 16 | second
        fresh = np.where(sure2 <= 1, 1 << 16 | true, sure2 >> 1 << 16 | second)
        guess2[at2] = np.where(hit2, kept, fresh)
        kept = np.minimum(sure1 + 1, 7) << 16 | first
        fresh = np.where(sure1 <= 1, 1 << 16 | true, sure1 >> 1 << 16 | first)
        guess1[at1] = np.where(true == first, kept, fresh)
        two, one = one, true
        context = (context & (_CLASSES - 1)) * _CLASSES + start.class_of[true]
    return out


def _checked(part: bytes, size: int, checksum: int) -> bytes:
    return struct.pack(_HEADER, MAGIC, size, checksum, zlib.crc32(part)) + part


def _opened(block: bytes) -> tuple[int, int, bytes]:
    if len(block) < struct.calcsize(_HEADER):
        raise ValueError("damaged block")
    magic, size, checksum, rest = struct.unpack_from(_HEADER, block)
    part = block[struct.calcsize(_HEADER) :]
    if magic != MAGIC or rest != zlib.crc32(part):
        raise ValueError("damaged block")
    return size, checksum, part


def encode_blocks(ids: np.ndarray) -> tuple[bytes, list[bytes]]:
    """The start table of ids below 65,536 and their blocks of ``BLOCK`` ids, the last one shorter.

    Each block can be read with the start table alone.
    """
    lanes = -(-len(ids) // BLOCK)
    packed = Start.packed(ids)
    header = _checked(packed, len(packed), zlib.crc32(packed))
    if not lanes:
        return header, []
    start, steps = Start(packed), min(BLOCK, len(ids))
    padded = np.full(lanes * steps, ids[0], np.uint16)
    padded[: len(ids)] = ids
    by_lane = padded.reshape(lanes, steps)
    coder = _Encoder(lanes, steps)
    _coded(coder, start, lanes, steps, np.ascontiguousarray(by_lane.T))
    blocks = []
    for i, rest in enumerate(coder.finish()):
        own = ids[i * BLOCK : (i + 1) * BLOCK]
        blocks.append(_checked(rest, len(own), zlib.crc32(own.astype("<u4").tobytes())))
    return header, blocks


def decode_blocks(packed: bytes, blocks: list[bytes]) -> np.ndarray:
    """The ids of blocks of one start table; a damaged table or block is an error."""
    size, checksum, start = _opened(packed)
    if (size, checksum) != (len(start), zlib.crc32(start)):
        raise ValueError("damaged start table")
    if not blocks:
        return np.zeros(0, np.uint16)
    sizes, checksums, parts = zip(*(_opened(block) for block in blocks), strict=True)
    found = _coded(_Decoder(parts), Start(start), len(parts), max(sizes), None).T
    out = [row[:size] for row, size in zip(found, sizes, strict=True)]
    for row, checksum in zip(out, checksums, strict=True):
        if zlib.crc32(row.astype("<u4").tobytes()) != checksum:
            raise ValueError("damaged block")
    return np.concatenate(out)


def _segments(batches: Iterator[pa.RecordBatch], vocabulary: str, end: int, segment_ids: int):
    encoder = word_encoder(vocabulary)
    if encoder.dtype.itemsize != 2:
        raise ValueError("the format holds ids below 65,536")
    file, segment = TaskContext.get().partitionId(), 0
    doc_ids, lengths, parts, held = [], [], [], 0
    kinds = [pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * 2
    kinds += [pa.binary(), pa.list_(pa.binary())]
    names = [field.split()[0] for field in SCHEMA.split(", ")]

    def out():
        start, blocks = encode_blocks(np.concatenate(parts))
        values = ([file], [segment], [doc_ids], [lengths], [start], [blocks])
        arrays = [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    for batch in batches:
        own_ids = batch[0].to_pylist()
        ids, ends = with_end(*encoder.encode_column(batch[1]), end)
        low = at = 0  # the first document and id that no segment holds yet
        while low < len(ends):
            # The document that brings the segment to its size is its last one.
            high = min(int(np.searchsorted(ends, at + segment_ids - held)) + 1, len(ends))
            doc_ids += own_ids[low:high]
            lengths += np.diff(ends[low:high], prepend=at).tolist()
            parts.append(ids[at : ends[high - 1]])
            held += len(parts[-1])
            low, at = high, int(ends[high - 1])
            if held >= segment_ids:
                yield out()
                doc_ids, lengths, parts, held, segment = [], [], [], 0, segment + 1
    if doc_ids:
        yield out()


def write_ids(
    docs: DataFrame,
    path: str,
    vocabulary: str = "byte_bpe_50k.json",
    end: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    segment_ids: int = SEGMENT,
) -> None:
    """Write the ids of whole texts, each followed by ``end``, in ascending order of the row's id.

    A segment ends with the document that brings it to ``segment_ids`` ids or more.
    Files follow each other in order, segments and documents too. A null text is empty, null ids
    come first, rows of one id are ordered by their text. An empty table gives an empty one.
    """
    bounded_batches(docs.sparkSession)
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text")
    )
    ordered = texts.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions(
        "doc_id", F.xxhash64("text")
    )
    coded = ordered.mapInArrow(lambda b: _segments(b, vocabulary, end, segment_ids), SCHEMA)
    coded.write.option("compression", "none").parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = decode_blocks(row["start"], row["blocks"])
            stops = np.cumsum(row["lengths"])
            starts = stops - row["lengths"]
            data = ids.astype("<u4")
            sums = [
                zlib.crc32(data[a:b].tobytes())
                for a, b in zip(starts.tolist(), stops.tolist(), strict=True)
            ]
            n = len(starts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, row["file"])),
                    pa.array(np.full(n, row["segment"])),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(row["lengths"], pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                ["file", "segment", "doc_id", "inside", "n_tokens", "ids_crc32"],
            )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the files.

    ``start`` counts the ids of all documents before it: within its segment, of the file's earlier
    segments, and of the earlier files (one total for each). Documents come as they were written:
    rows of one id, or without one, are documents of their own. No files give no rows.
    """
    bounded_batches(spark)
    table = spark.read.schema(SCHEMA).parquet(path)
    total = F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x)
    segments = table.select("file", "segment", total.alias("total"))
    earlier = (
        Window.partitionBy("file").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = segments.groupBy("file").agg(F.sum("total").alias("total"))
    bases = files.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    starts = (
        segments.select("*", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("here"))
        .join(bases, "file")
        .select("file", "segment", (F.col("base") + F.col("here")).alias("base"))
    )
    # Written, so that the join decodes the files once.
    found = settle(
        table.mapInArrow(
            _documents,
            "file long, segment long, doc_id long, inside long, n_tokens long, ids_crc32 long",
        ),
        "decoded",
    )
    return found.join(starts, ["file", "segment"]).select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def written_and_read(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """Write the documents' ids to a new table in the shared folder and read them back.

    One row for each row of ``docs``. A null or empty text is its end id alone; null ids come last.
    An empty table gives no rows.
    """
    path = scratch_path(docs.sparkSession, "coded-ids")
    write_ids(docs, path, vocabulary)
    return read_documents(docs.sparkSession, path)
