"""The failure table: one row per failed attempt, with a latest-per-item view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_STATUS = -1


def failure_rows(
    df: DataFrame,
    columns: Sequence[str],
    status: Column | None = None,
    timestamp: Column | None = None,
) -> DataFrame:
    """The named columns as text, empty where null, with status code and epoch second."""
    status = F.lit(NO_STATUS) if status is None else status
    timestamp = F.unix_timestamp() if timestamp is None else timestamp
    return df.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns),
        F.coalesce(status.cast("bigint"), F.lit(NO_STATUS).cast("bigint")).alias("status_code"),
        timestamp.cast("bigint").alias("timestamp"),
    )


def with_status(failures: DataFrame) -> DataFrame:
    """Failures that carry a real status code."""
    return failures.where(F.col("status_code") != NO_STATUS)


def latest_failures(failures: DataFrame, key: str = "uid") -> DataFrame:
    """The last attempt of each item, and how many there were.

    An aggregation, not a window: an item with very many attempts is reduced where its rows lie.
    """
    rest = [c for c in failures.columns if c not in (key, "timestamp")]
    last = F.max(F.struct("timestamp", *rest)).alias("_last")
    counted = failures.groupBy(key).agg(last, F.count(F.lit(1)).alias("attempts"))
    return counted.select(key, "_last.*", "attempts")


def batch_counts(outcomes: DataFrame, batch: str, failed: str) -> DataFrame:
    """Succeeded and failed items per batch. The failed ids stay rows of the failure table."""
    return outcomes.groupBy(batch).agg(
        F.count_if(F.col(failed)).alias("n_failed"),
        F.count_if(~F.col(failed)).alias("n_ok"),
    )


def batch_item_failures(outcomes: DataFrame, batch: str, item: str, failed: str) -> DataFrame:
    """One row per failed item of a batch."""
    return outcomes.where(F.col(failed)).select(batch, F.col(item).alias("itemIdentifier"))


def redrivable(failures: DataFrame, max_attempts: int, key: str = "uid") -> DataFrame:
    """Items that failed fewer than ``max_attempts`` times."""
    return latest_failures(failures, key).where(F.col("attempts") < max_attempts)
