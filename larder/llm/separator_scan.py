"""Token counts of documents in flat token files that have no index.

A flat file is a run of token ids with an end id after each document. Its blocks are scanned one by
one, wherever their edges fall: a vectorised search finds the end ids of a block. What a block
cannot know, where its first document began and how many ended before, comes from a prefix scan
over one summary a block: the running maximum of the last end and the running sum of the ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import bounded_batches, over_cores, text_or_empty
from larder.llm.tokens import word_encoder
from larder.session import settle

#: Ids of one block of a flat file.
BLOCK_IDS = 1 << 16
#: Blocks of one segment of the prefix scan; no window of it holds more rows.
SEGMENT = 4096
BLOCKS = "file long, block long, ids binary"


def _flat(batches: Iterator[pa.RecordBatch], vocabulary: str, end: int, block_ids: int):
    """Blocks of this partition's flat file, and the ids of its documents in their order."""
    encoder = word_encoder(vocabulary, plain_specials=True)
    file, block, row = TaskContext.get().partitionId(), 0, 0
    size = block_ids * encoder.dtype.itemsize
    tail = np.array([end], encoder.dtype).tobytes()
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64())]
    names = ["file", "block", "ids", "doc_no", "doc_ids"]
    left = b""

    def out(blocks: list[bytes], doc_no, doc_ids):
        nonlocal block
        n = len(blocks)
        rows = [[file] * n, list(range(block, block + n)), blocks, [None] * n, [None] * n]
        block += n
        if doc_ids is not None:
            for column, value in zip(rows, (file, None, None, doc_no, doc_ids), strict=True):
                column.append(value)
        arrays = [pa.array(c, k) for c, k in zip(rows, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    for batch in batches:
        for low in range(0, batch.num_rows, 500):
            part = batch.slice(low, 500)
            doc_ids = part[0].to_pylist()
            data = left + b"".join(ids + tail for ids in encoder.encode(part[1].to_pylist()))
            stop = len(data) - len(data) % size
            left = data[stop:]
            yield out([data[i : i + size] for i in range(0, stop, size)], row, doc_ids)
            row += len(doc_ids)
    if left:
        yield out([left], None, None)


def write_flat(
    docs: DataFrame,
    vocabulary: str = "byte_bpe_50k.json",
    end: int = 50256,
    block_ids: int = BLOCK_IDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Flat token files of whole texts, one a partition, as ``file, block, ids``; and their names.

    Strings of special tokens are ordinary text here, so no text holds the end id. A null text is
    empty. The names (``file, doc_no, doc_id``) are apart and take no part in counting.
    """
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("bigint"), text_or_empty(text_col))
    schema = BLOCKS + ", doc_no long, doc_ids array<long>"
    written = settle(
        over_cores(texts).mapInArrow(lambda b: _flat(b, vocabulary, end, block_ids), schema),
        "flat-tokens",
    )
    blocks = written.where("block is not null").select("file", "block", "ids")
    names = (
        written.where("doc_ids is not null")
        .select("file", "doc_no", F.posexplode("doc_ids").alias("at", "doc_id"))
        .select("file", (F.col("doc_no") + F.col("at")).alias("doc_no"), "doc_id")
    )
    return blocks, names


def read_flat(spark, path: str, width: int = 2, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of flat binary files of ``width``-byte ids, numbered in the order of their paths."""
    files = spark.read.format("binaryFile").load(path)
    order = files.select(F.xxhash64("path").alias("file"), "content")
    step = block_ids * width
    count = F.ceil(F.length("content") / step)
    cut = F.when(count > 0, F.sequence(F.lit(0).cast("bigint"), count - 1))
    return order.select("file", F.explode(cut).alias("block"), "content").select(
        "file", "block", F.expr(f"substring(content, int(block * {step} + 1), {step})").alias("ids")
    )


def _ends(batches: Iterator[pa.RecordBatch], end: int, dtype: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, found = [], []
        for ids in batch[2]:
            values = np.frombuffer(ids.as_buffer() or b"", dtype)
            sizes.append(len(values))
            found.append(np.flatnonzero(values == end).astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                batch[0],
                batch[1],
                pa.array(sizes, pa.int64()),
                pa.array(found, pa.list_(pa.int64())),
            ],
            ["file", "block", "size", "ends"],
        )


def _before(summary: DataFrame) -> DataFrame:
    """For each block: ids, ends and the last end (absolute) of the file's earlier blocks.

    Scanned within segments, then over the segments' totals.
    """
    cut = summary.withColumn("segment", F.floor(F.col("block") / SEGMENT))
    earlier = (
        Window.partitionBy("file", "segment")
        .orderBy("block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = cut.groupBy("file", "segment").agg(
        F.sum("size").alias("size"), F.sum("n").alias("n")
    )
    over = (
        Window.partitionBy("file").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = totals.select(
        "file",
        "segment",
        F.coalesce(F.sum("size").over(over), F.lit(0)).alias("ids_base"),
        F.coalesce(F.sum("n").over(over), F.lit(0)).alias("doc_base"),
    )
    placed = (
        cut.select(
            "*",
            F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("ids_in"),
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("docs_in"),
        )
        .join(bases, ["file", "segment"])
        .withColumn("at", F.col("ids_base") + F.col("ids_in"))
        .withColumn("docs", F.col("doc_base") + F.col("docs_in"))
        .withColumn("end_at", F.col("at") + F.col("last"))
    )
    ends = placed.groupBy("file", "segment").agg(F.max("end_at").alias("end_at"))
    tops = ends.select("file", "segment", F.max("end_at").over(over).alias("end_base"))
    return placed.join(tops, ["file", "segment"]).select(
        "file",
        "block",
        "size",
        "at",
        "docs",
        F.coalesce(F.greatest(F.max("end_at").over(earlier), "end_base"), F.lit(-1)).alias("begun"),
    )


def scan_separators(
    blocks: DataFrame, end: int = 50256, dtype: str = "<u2"
) -> DataFrame:
    """One row per document of the flat files: ``file, doc_no, start, n_tokens, closed``.

    ``start`` counts the ids before it in its file, ``n_tokens`` its ids without the end id. Two
    ends in a row make an empty document. Ids after a file's last end are a document that is not
    ``closed``. A null block counts as empty; an empty table gives no rows.
    """
    bounded_batches(blocks.sparkSession)
    found = settle(
        blocks.select("file", "block", F.coalesce("ids", F.lit(b""))).mapInArrow(
            lambda b: _ends(b, end, dtype), "file long, block long, size long, ends array<long>"
        ),
        "ends",
    )
    summary = found.select(
        "file",
        "block",
        "size",
        F.size("ends").cast("bigint").alias("n"),
        F.try_element_at("ends", F.lit(-1)).alias("last"),
    )
    known = _before(summary)
    inside = found.select("file", "block", "ends").join(
        known.drop("size"), ["file", "block"]
    )
    starts = F.concat(
        F.array(F.col("begun") + 1),
        F.transform(F.slice("ends", 1, F.size("ends") - 1), lambda e: e + F.col("at") + 1),
    )
    stops = F.transform("ends", lambda e: e + F.col("at"))
    closed = (
        inside.where(F.size("ends") > 0)
        .select("file", "docs", F.posexplode(F.arrays_zip(starts.alias("a"), stops.alias("b"))))
        .select(
            "file",
            (F.col("docs") + F.col("pos")).alias("doc_no"),
            F.col("col.a").alias("start"),
            (F.col("col.b") - F.col("col.a")).alias("n_tokens"),
            F.lit(True).alias("closed"),
        )
    )
    last = summary.join(known.drop("size"), ["file", "block"]).select(
        "file",
        (F.col("at") + F.col("size")).alias("upto"),
        (F.col("docs") + F.col("n")).alias("docs"),
        F.coalesce(F.col("at") + F.col("last"), F.col("begun")).alias("end_at"),
    )
    whole = last.groupBy("file").agg(
        F.max("upto").alias("upto"), F.max("docs").alias("doc_no"), F.max("end_at").alias("end_at")
    )
    open_rows = whole.where(F.col("end_at") + 1 < F.col("upto")).select(
        "file",
        "doc_no",
        (F.col("end_at") + 1).alias("start"),
        (F.col("upto") - F.col("end_at") - 1).alias("n_tokens"),
        F.lit(False).alias("closed"),
    )
    return closed.unionByName(open_rows)


def count_tokens(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", end: int = 50256):
    """``doc_id, file, doc_no, start, n_tokens`` of every row, counted in its flat file.

    A null or empty text has no tokens before its end identifier. Rows of one id, alike or not, and
    rows without one are documents of their own. An empty table gives no rows.
    """
    blocks, names = write_flat(docs, vocabulary, end)
    counted = scan_separators(blocks, end).where("closed").drop("closed")
    return names.join(counted, ["file", "doc_no"], "left").select(
        "doc_id", "file", "doc_no", "start", "n_tokens"
    )
