"""Bounded retries with back-off in the stream: a timer for each failed item.

The stream takes new messages and attempts that are due. What fails is written to the feed
``retries``, which the same query reads: a failure becomes state of its uid with a timer, and the
timer lets the item go for its next attempt. Messages that succeed never become state.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from zlib import crc32

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from larder.operators.failures import failure_rows
from larder.operators.sets import not_yet
from larder.session import keep_state_on_disk, settle
from larder.sinks.commits import commit_batch, read_committed

# Shortest and longest wait before another attempt, in seconds.
FIRST_WAIT, LONGEST_WAIT = 3.0, 9.0
#: How long a failed item is remembered, as long as its message may be delivered again.
REMEMBERED_MS = 6 * 24 * 3600 * 1000
ATTEMPT = "uid string, url string, attempt int"
FAILED_ATTEMPT = "uid string, url string, status_code long, timestamp long, attempt int"


def wait_seconds(
    uid: str, attempt: int, first: float = FIRST_WAIT, longest: float = LONGEST_WAIT
) -> float:
    """The wait after a failed attempt: between ``first`` and twice as much for each attempt.

    At most ``longest``. The place in between is drawn by a hash, so a batch run again waits alike.
    """
    highest = max(first, min(longest, first * 2.0**attempt))
    return first + (highest - first) * crc32(f"{uid}|{attempt}".encode()) / 2**32


class Backoff(StatefulProcessor):
    """Of each uid the last failed attempt, and a timer for the next one.

    A failure that is reported again, by a batch that was run again, changes nothing.
    """

    def __init__(self, first: float, longest: float):
        self.first, self.longest = first, longest

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.failed = handle.getValueState("failed", "url string, attempt int", REMEMBERED_MS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = max(rows, key=lambda row: row["attempt"])
        known = self.failed.get() if self.failed.exists() else None
        if known is None or known[1] < last["attempt"]:
            wait = wait_seconds(key[0], last["attempt"], self.first, self.longest)
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.failed.update((last["url"], last["attempt"]))
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + int(wait * 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.failed.exists():
            url, attempt = self.failed.get()
            yield Row(uid=key[0], url=url, attempt=attempt + 1)

    def close(self) -> None:
        pass


def attempts(
    rows: DataFrame, out: str, first: float = FIRST_WAIT, longest: float = LONGEST_WAIT
) -> DataFrame:
    """A stream of ``uid, url, attempt``: new messages, and failed ones when they are due again."""
    spark = rows.sparkSession
    keep_state_on_disk(spark)
    spark.createDataFrame([], ATTEMPT).write.mode("ignore").parquet(f"{out}/retries")
    failed = spark.readStream.schema(ATTEMPT).parquet(f"{out}/retries")
    due = failed.groupBy("uid").transformWithState(
        Backoff(first, longest), ATTEMPT, "Append", "ProcessingTime"
    )
    return rows.select("uid", "url", F.lit(1).alias("attempt")).unionByName(due)


def attempt_batch(
    lookup: Callable[[DataFrame], DataFrame], out: str, max_attempts: int
) -> Callable[[DataFrame, int], None]:
    """Work of the query: try the items, commit ``staged`` and ``failed``, hand on what may retry.

    ``lookup`` is ``pipeline.enrich`` over some pages with ``keep=["attempt"]``. An item that fails
    its last attempt stays in ``failed`` and is not tried again. ``failed`` keeps every attempt.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        # Written first: reading the batch again would run its timers again. Most batches are only
        # a look at the timers and have no rows.
        due = settle(batch, "due")
        if not due.limit(1).count():
            return
        enriched = settle(lookup(due), "attempted")
        ok = enriched.where("status_code IS NULL").drop("status_code", "coerced")
        bad = enriched.where("status_code IS NOT NULL")
        failed = settle(
            failure_rows(bad, ["uid", "url", "attempt"], F.col("status_code")).withColumn(
                "attempt", F.col("attempt").cast("int")
            ),
            "failed",
        )
        commit_batch(batch.sparkSession, out, batch_id, staged=ok, failed=failed)
        again = failed.where(F.col("attempt") < max_attempts)
        again.select("uid", "url", "attempt").write.mode("append").parquet(f"{out}/retries")

    return work


def open_items(spark: SparkSession, out: str, max_attempts: int) -> DataFrame:
    """``uid, attempt`` of the items that failed, have attempts left and did not succeed since."""
    failed = read_committed(spark, out, "failed", FAILED_ATTEMPT)
    last = failed.groupBy("uid").agg(F.max("attempt").alias("attempt"))
    left = last.where(F.col("attempt") < max_attempts)
    return not_yet(left, read_committed(spark, out, "staged", "uid string"), "uid")


def drain(
    query: StreamingQuery, spark: SparkSession, out: str, max_attempts: int, seconds: float
) -> None:
    """Wait until the query has no input and no item left that could be tried again, and stop it.

    A query with timers runs on for ever, so a backfill ends this way.
    """
    end = time.monotonic() + seconds
    try:
        while time.monotonic() < end:
            query.awaitTermination(1)
            progress = query.recentProgress[-2:]
            idle = len(progress) == 2 and not any(p["numInputRows"] for p in progress)
            if query.exception() is not None or not query.isActive:
                raise RuntimeError("the query ended") from query.exception()
            if idle and not open_items(spark, out, max_attempts).limit(1).count():
                return
        raise TimeoutError(f"items are still waiting after {seconds} s")
    finally:
        query.stop()
