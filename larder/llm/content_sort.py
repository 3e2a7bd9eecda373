"""Exact dedup by sorting contents: equal texts become neighbours and are compared whole.

Spark samples splitters and deals the documents out by range. The range key is short (a prefix of
the normalised bytes, a hash of all of them, the id), so the sampled keys stay small however long
the texts are, and a group of copies of any size is cut by id over many tasks. Each task sorts
externally by the whole text and compares neighbours. Only groups at the edge of a task's range can
go on in the next one; those, two key groups a task at most, are stitched by text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import bounded_batches, text_or_empty
from larder.session import settle

WHITE = r"[\x20\x09-\x0D]+"
PREFIX_BYTES = 32


def normalised(text: str) -> Column:
    """The text with each run of ASCII white space as one space; null is the empty text."""
    return F.regexp_replace(text_or_empty(text), WHITE, " ")


def _changes(column: pa.ChunkedArray) -> np.ndarray:
    """True where a value differs from the one before it, and at the first."""
    flags = np.ones(len(column), bool)
    if len(column) > 1:
        whole = column.combine_chunks()
        whole = whole.chunk(0) if isinstance(whole, pa.ChunkedArray) else whole
        flags[1:] = pc.not_equal(whole[1:], whole[:-1]).to_numpy(zero_copy_only=False)
    return flags


def _key_changes(rows: pa.Table) -> np.ndarray:
    return _changes(rows["_h"]) | _changes(rows["_p"])


def _decided(rows: pa.Table, edge: np.ndarray, pid: int, first_run: int, names: list[str]):
    """The rows of whole key groups with what their run (rows of one text) says about them."""
    starts = np.flatnonzero(_changes(rows["_t"]) | _key_changes(rows))
    sizes = np.diff(np.append(starts, rows.num_rows))
    run = np.repeat(np.arange(len(starts)), sizes)
    first = np.zeros(rows.num_rows, bool)
    first[starts] = True
    keep = rows["_id"].take(pa.array(starts)).take(pa.array(run))
    shown = pa.array(np.arange(rows.num_rows), mask=~(first & edge))
    columns = {
        "_id": rows["_id"],
        "_keep": keep,
        "_size": pa.array(sizes[run], pa.int64()),
        "_first": pa.array(first),
        "_sha": rows["_sha"],
        "_pid": pa.array(np.full(rows.num_rows, pid), pa.int32()),
        "_run": pa.array(run + first_run, pa.int64(), mask=~edge),
        "_text": rows["_t"].take(shown),
    } | {name: rows[name] for name in names}
    out = pa.table(columns)
    out = out.set_column(7, "_text", out["_text"].cast(pa.string())).combine_chunks()
    return out.to_batches(), first_run + len(starts)


def _runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (prefix, hash, text, id), run by run; the last key group waits for its end."""
    pid = TaskContext.get().partitionId()
    held: list[pa.Table] = []
    key, first_run, opening = None, 0, True
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        at = rows.schema.get_field_index("_t")
        rows = rows.set_column(at, "_t", rows["_t"].cast(pa.large_string()))
        fresh = _key_changes(rows)
        fresh[0] = key is not None and key != (rows["_p"][0].as_py(), rows["_h"][0].as_py())
        key = (rows["_p"][-1].as_py(), rows["_h"][-1].as_py())
        cuts = np.flatnonzero(fresh)
        if len(cuts):
            done = pa.concat_tables([*held, rows.slice(0, cuts[-1])])
            edge = np.zeros(done.num_rows, bool)
            if opening:
                edge[: np.append(np.flatnonzero(_key_changes(done))[1:], done.num_rows)[0]] = True
            out, first_run = _decided(done, edge, pid, first_run, names)
            yield from out
            held, opening = [rows.slice(cuts[-1])], False
        else:
            held.append(rows)
    if held:
        done = pa.concat_tables(held)
        yield from _decided(done, np.ones(done.num_rows, bool), pid, first_run, names)[0]


def _decisions(docs: DataFrame, id_col: str, text_col: str, carry: Sequence[str]) -> DataFrame:
    """``_id, _keep_id, _group_size, _kept, _sha`` of every row, and ``carry`` as c0, c1, ..."""
    bounded_batches(docs.sparkSession)
    names = [f"c{i}" for i in range(len(carry))]
    keyed = docs.select(
        F.col(id_col).cast("bigint").alias("_id"),
        normalised(text_col).alias("_t"),
        *(F.col(c).alias(name) for c, name in zip(carry, names, strict=True)),
    ).select(
        "*",
        F.substring(F.col("_t").cast("binary"), 1, PREFIX_BYTES).alias("_p"),
        F.xxhash64("_t").alias("_h"),
    )
    last = F.col("_id").asc_nulls_last()
    ordered = (
        keyed.repartitionByRange("_p", "_h", last)
        .sortWithinPartitions("_p", "_h", "_t", last)
        .withColumn("_sha", F.sha2("_t", 256))
    )
    kinds = dict(keyed.dtypes)
    schema = (
        "_id long, _keep long, _size long, _first boolean, _sha string, _pid int, _run long, "
        "_text string"
    ) + "".join(f", {name} {kinds[name]}" for name in names)
    runs = settle(ordered.mapInArrow(lambda b: _runs(b, names), schema), "sorted-runs")
    edges = runs.where("_text is not null").select("_pid", "_run", "_text", "_keep", "_size")
    order = F.struct(
        F.col("_keep").isNull().alias("last"), F.col("_keep").alias("keep"), "_pid", "_run"
    )
    whole = edges.groupBy("_text").agg(F.min(order).alias("_won"), F.sum("_size").alias("_all"))
    # At most the runs of two key groups for each task.
    stitched = F.broadcast(edges.join(whole, "_text").select("_pid", "_run", "_won", "_all"))
    won = (F.col("_won._pid") == F.col("_pid")) & (F.col("_won._run") == F.col("_run"))
    inside = F.col("_won").isNull()
    return runs.join(stitched, ["_pid", "_run"], "left").select(
        "_id",
        F.when(inside, F.col("_keep")).otherwise(F.col("_won.keep")).alias("_keep_id"),
        F.coalesce("_all", "_size").alias("_group_size"),
        (F.col("_first") & (inside | won)).alias("_kept"),
        "_sha",
        *names,
    )


def content_sort(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal if they are identical after ``normalised``; null counts as empty. The row with
    the smallest id stays. Of rows with that same id exactly one stays. Null ids come last: a group
    of null ids alone has a null ``keep_id`` and keeps one row. An empty table gives no rows.
    """
    names = {
        "_id": "doc_id",
        "_keep_id": "keep_id",
        "_group_size": "group_size",
        "_kept": "kept",
        "_sha": "text_sha256",
    }
    return _decisions(docs, id_col, text_col, ()).withColumnsRenamed(names)


def first_of_equals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``content_sort`` keeps, with all their columns.

    Of equal texts, null and empty ones among them, the row of the smallest id, one of them if it
    repeats; of rows without an id one. An empty table stays empty.
    """
    kept = _decisions(docs, id_col, text_col, docs.columns).where("_kept")
    return kept.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))
