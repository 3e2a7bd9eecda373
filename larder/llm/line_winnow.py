"""Line dedup: runs of lines that were there before are deleted, found by winnowing.

Every line has a hash. Each window of ``run`` lines, and each shorter one of more than ``words`` words,
chooses the smallest hash in it (the last of equal ones) as its fingerprint, so equal windows,
wherever they are, choose the same line: a repeated run of that length, in lines or words, is
guaranteed to share a fingerprint. Only lines whose fingerprint
occurs at two places can lie in a repeated run; the windows that chose them are compared with the
first place of their whole content, and neighbouring repeated windows make up the extended run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import bounded_batches, over_cores, text_or_empty
from larder.operators.sizes import broadcast_if_small
from larder.session import settle

RUN_LINES = 3
WORD = r"[^\x20\x09-\x0D]+"
#: A run of fewer lines counts if it has more words than these.
RUN_WORDS = 50


def counted_lines(text: str) -> Column:
    """The lines that count, trimmed of spaces: those that are not empty then."""
    lines = F.transform(F.split(F.col(text), "\n", -1), lambda x: F.trim(x))
    return F.filter(lines, lambda x: x != "")


def _mix(hashes: np.ndarray, run: int) -> np.ndarray:
    """Hash of each window of ``run`` values; windows of different lengths are told apart."""
    n = len(hashes) - run + 1
    out = np.full(n, 0x9E3779B97F4A7C15 + run, np.uint64)
    for at in range(run):
        out ^= hashes[at : at + n]
        out *= np.uint64(0xFF51AFD7ED558CCD)
        out ^= out >> np.uint64(32)
    return out


_WINDOW = (
    "doc_id long, text_hash long, line long, run int, content long, fingerprint long, chosen long"
)


def _windows(
    batches: Iterator[pa.RecordBatch], longest: int, words: int
) -> Iterator[pa.RecordBatch]:
    """For each window: its document, first line, length, content hash, fingerprint, line chosen."""
    for batch in batches:
        lists = batch["hashes"]
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        counts = batch["words"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        before = np.concatenate([[0], np.cumsum(counts)])
        starts = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(sizes)), sizes)
        for run in range(1, longest + 1):
            n = len(flat) - run + 1
            if n <= 0:
                continue
            inside = owner[:n] == owner[run - 1 :]
            if run < longest:
                inside &= before[run:] - before[:n] > words
            keep = np.flatnonzero(inside)
            line = (np.arange(n) - starts[owner[:n]])[keep]
            seen = np.lib.stride_tricks.sliding_window_view(flat, run)[keep]
            chosen = run - 1 - seen[:, ::-1].argmin(axis=1)
            smallest = np.take_along_axis(seen, chosen[:, None], 1)[:, 0]
            rows = pa.array(owner[:n][keep])
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(rows),
                    batch["text_hash"].take(rows),
                    pa.array(line, pa.int64()),
                    pa.array(np.full(len(keep), run, np.int32)),
                    pa.array(_mix(flat, run)[keep].view(np.int64)),
                    pa.array(smallest.copy().view(np.int64)),
                    pa.array(line + chosen, pa.int64()),
                ],
                ["doc_id", "text_hash", "line", "run", "content", "fingerprint", "chosen"],
            )


def repeated_windows(docs: DataFrame, run: int, words: int) -> DataFrame:
    """``doc_id, text_hash, line, run``: windows that an earlier place has too.

    ``docs`` has ``doc_id, text, text_hash``. No pairs are made: every window is compared with the
    first place of its content only.
    """
    lines = over_cores(docs).select("doc_id", "text_hash", counted_lines("text").alias("lines"))
    hashed = lines.where(F.size("lines") > 0).select(
        "doc_id",
        "text_hash",
        F.transform("lines", lambda x: F.xxhash64(x)).alias("hashes"),
        F.transform("lines", lambda x: F.regexp_count(x, F.lit(WORD))).alias("words"),
    )
    windows = settle(hashed.mapInArrow(lambda b: _windows(b, run, words), _WINDOW), "windows")

    def place(line: str):
        return F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash", line)

    positions = windows.groupBy("fingerprint").agg(
        F.min(place("chosen")).alias("low"), F.max(place("chosen")).alias("high")
    )
    shared = settle(positions.where("low != high").select("fingerprint"), "fingerprints")
    candidates = settle(windows.join(shared, "fingerprint").drop("chosen"), "candidates")
    contents = candidates.groupBy("fingerprint", "content").agg(
        F.min(place("line")).alias("first"), F.max(place("line")).alias("high")
    )
    first = settle(contents.where("first != high").drop("high"), "first-places")
    repeated = candidates.join(first, ["fingerprint", "content"])
    later = repeated.where(place("line") != F.col("first"))
    return later.select("doc_id", "text_hash", "line", "run")


def _cut(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, lines, deleted = [], [], []
        for text, spans in zip(batch[1].to_pylist(), batch[2].to_pylist(), strict=True):
            split = text.split("\n")
            counted = np.array([i for i, x in enumerate(split) if x.strip(" ")], np.int64)
            gone = np.zeros(len(counted), bool)
            for span in spans or ():
                line, run = divmod(span, longest + 1)
                gone[line : line + run] = True
            drop = set(counted[gone].tolist())
            kept = [x for i, x in enumerate(split) if i not in drop] if drop else split
            texts.append("\n".join(kept))
            lines.append(len(counted))
            deleted.append(len(drop))
        yield pa.RecordBatch.from_arrays(
            [batch[0], pa.array(texts), pa.array(lines, pa.int64()), pa.array(deleted, pa.int64())],
            ["doc_id", "text", "n_lines", "n_deleted"],
        )


def winnow_lines(
    docs: DataFrame,
    run: int = RUN_LINES,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = RUN_WORDS,
) -> DataFrame:
    """``doc_id, text, n_lines, n_deleted`` of every document, later repeated runs deleted.

    A line counts if it has more than spaces; lines are compared without outer spaces. A line is
    deleted if it lies in a run that occurs at an earlier place too, of ``run`` lines in a row, or of
    fewer with more than ``words`` words; words are runs of other characters than ASCII white space.
    Earlier places are in whole documents or the same one; places are ordered by id, null ids last,
    then by line. Rows of one id with different texts are different places; rows alike in id and
    text are one place and are cut alike. Lines that do not count stay. A null text is empty.
    """
    bounded_batches(docs.sparkSession)
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))
    later = repeated_windows(texts, run, words)
    # A place and a length in one number.
    span = (F.col("line") * (run + 1) + F.col("run")).alias("span")
    spans = F.collect_set(span).alias("spans")
    found = settle(later.groupBy("doc_id", "text_hash").agg(spans), "repeated")
    same = texts["doc_id"].eqNullSafe(found["doc_id"]) & (texts["text_hash"] == found["text_hash"])
    # While the places measure small the texts stay where they are.
    joined = texts.join(broadcast_if_small(found), same, "left")
    joined = joined.select(texts["doc_id"], "text", "spans")
    return joined.mapInArrow(lambda b: _cut(b, run), "doc_id long, text string, n_lines long, n_deleted long")
