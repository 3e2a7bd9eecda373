"""Batches of one or several tables that appear together, or not at all.

The rows of a batch are written under ``batch_id`` and a fresh ``commit_id``; no reader looks there
yet. Then one row of the table ``commits`` names that id: a single file, which a file system shows
whole or not at all. Readers take the rows that each batch's last commit names. A batch that is run
again, after a crash or by hand, gets a new id: until its commit the earlier rows are read.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.sizes import broadcast_if_small
from larder.session import settle

COMMIT = "batch_id long, commit_id string, committed_at long, tables array<string>"
_PLACE = ["batch_id", "commit_id"]


def _opened(spark: SparkSession, root: str, name: str | None = None, schema=None) -> None:
    """Make the folders of ``commits`` and of a table, so that both can be read while empty."""
    spark.createDataFrame([], COMMIT).write.mode("ignore").parquet(f"{root}/commits")
    if name is not None:
        empty = spark.createDataFrame([], schema)
        empty.write.mode("ignore").partitionBy(*_PLACE).parquet(f"{root}/{name}")


def write_uncommitted(root: str, frames: Mapping[str, DataFrame]) -> str:
    """Write rows, ``batch_id`` among their columns, under the id returned; no reader sees them."""
    commit_id = f"c{uuid.uuid4().hex}"
    for name, frame in frames.items():
        stamped = frame.withColumn("ingest_ts", F.unix_timestamp())
        placed = stamped.withColumn("commit_id", F.lit(commit_id))
        placed.write.mode("append").partitionBy(*_PLACE).parquet(f"{root}/{name}")
    return commit_id


def commit(
    spark: SparkSession, root: str, frames: Mapping[str, DataFrame], batch_ids: Sequence[int]
) -> None:
    """Write a frame for each table name and make all of them the content of the batches.

    A batch without rows is committed too, so its earlier rows are gone.
    """
    commit_id = write_uncommitted(root, frames)
    rows = [(int(i), commit_id, time.time_ns(), sorted(frames)) for i in batch_ids]
    manifest = spark.createDataFrame(rows, COMMIT).coalesce(1)
    manifest.write.mode("append").parquet(f"{root}/commits")


def commit_batch(spark: SparkSession, root: str, batch_id: int, **frames: DataFrame) -> None:
    """Commit whole frames, a table name each, as one batch."""
    stamp = F.lit(batch_id).cast("bigint")
    stamped = {name: frame.withColumn("batch_id", stamp) for name, frame in frames.items()}
    commit(spark, root, stamped, [batch_id])


def last_commits(commits: DataFrame) -> DataFrame:
    """``batch_id, commit_id``: of each batch the last commit."""
    last = F.max(F.struct("committed_at", "commit_id"))["commit_id"].alias("commit_id")
    return commits.groupBy("batch_id").agg(last)


def committed_rows(
    spark: SparkSession, root: str, name: str, schema: T.StructType, commits: DataFrame
) -> DataFrame:
    """The rows of ``schema`` and their ``batch_id`` in the last of the given commits of a batch.

    The commits are a row for each batch; they are broadcast while they measure small, and only the
    folders they name are read.
    """
    fields = [f for f in schema.fields if f.name not in _PLACE]
    place = [T.StructField("batch_id", T.LongType()), T.StructField("commit_id", T.StringType())]
    whole = T.StructType([*fields, *place])
    _opened(spark, root, name, whole)
    last = broadcast_if_small(settle(last_commits(commits), "last-commits"))
    table = spark.read.schema(whole).parquet(f"{root}/{name}")
    return table.join(last.where("batch_id >= 0"), _PLACE).select(
        *(f.name for f in fields), "batch_id"
    )


def read_committed(
    spark: SparkSession, root: str, name: str, schema: T.StructType | str
) -> DataFrame:
    """The committed rows of a table, with their ``batch_id``; none before the first commit."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    _opened(spark, root)
    commits = spark.read.schema(COMMIT).parquet(f"{root}/commits")
    held = commits.where(F.array_contains("tables", name))
    return committed_rows(spark, root, name, schema, held)


def commit_stream(spark: SparkSession, root: str, per_batch: int) -> DataFrame:
    """The commits of a root as they arrive, up to ``per_batch`` files of them at once."""
    _opened(spark, root)
    return (
        spark.readStream.schema(COMMIT)
        .option("maxFilesPerTrigger", per_batch)
        .parquet(f"{root}/commits")
    )
