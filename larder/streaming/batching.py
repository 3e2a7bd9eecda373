"""Batches of messages by number or age, whichever comes first, as state with a timer."""

from __future__ import annotations

import datetime as dt
import heapq
import os
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from larder.session import keep_state_on_disk

# Messages of a batch of the scraping and of the tagging step, and the longest wait.
SCRAPE_MESSAGES, TAG_MESSAGES, WAIT_SECONDS = 40, 10, 20
#: A batch as it leaves Python, with times in microseconds.
_BATCH = (
    "queue string, batch_no long, opened long, n int, why string,"
    " messages array<struct<arrived: long, message: string>>"
)
_BATCH_COLUMNS = ["queue", "batch_no", "opened", "n", "why", "messages"]
#: Bytes that the messages of one sorted run, or of one frame of batches, may take in Python.
HELD_BYTES = 32 << 20
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
_ROW_BYTES = 300
_CHUNK_BYTES = 1 << 20


def _size(message: tuple) -> int:
    return _ROW_BYTES + 4 * len(message[1] or "")


def _order(message: tuple) -> tuple:
    return message[0], message[1] is not None, message[1] or ""


def _chunked(messages: Iterable[tuple], limit: int) -> Iterator[list[tuple]]:
    """Lists of messages that take about ``limit`` bytes; the last may take less."""
    chunk, size = [], 0
    for message in messages:
        chunk.append(message)
        size += _size(message)
        if size >= limit:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def _kept_on_disk(run: list[tuple]) -> Iterator[tuple]:
    """The run again, from a file of the task's local disk that goes with the iterator."""
    local = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
    file = tempfile.TemporaryFile(dir=local if os.path.isdir(local) else None)
    for chunk in _chunked(run, min(_CHUNK_BYTES, HELD_BYTES)):
        pickle.dump(chunk, file, pickle.HIGHEST_PROTOCOL)
    end = file.tell()

    def read() -> Iterator[tuple]:
        with file:
            file.seek(0)
            while file.tell() < end:
                yield from pickle.load(file)

    return read()


def in_order(messages: Iterable[tuple]) -> Iterator[tuple]:
    """``arrived, message`` by time and text; runs over ``HELD_BYTES`` are merged from disk."""
    runs, last = [], []
    for run in _chunked(messages, HELD_BYTES):
        run.sort(key=_order)
        if last:
            runs.append(_kept_on_disk(last))
        last = run
    return heapq.merge(*runs, last, key=_order)


class Batches(StatefulProcessor):
    """Of each queue the open batch: its messages, at most one batch of them, and its number.

    A batch opens with its first message and closes when it is full or ``wait`` seconds old. Age is
    told by the times at which messages arrived, so a batch run again closes alike; the timer
    closes a batch after which nothing arrives. Python holds a bounded part of a queue's messages.
    """

    def __init__(self, size: int, wait: float):
        self.size, self.wait = size, wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.number = handle.getValueState("number", "n long")
        self.held = handle.getListState("held", "arrived timestamp, message string")

    def _due(self, held: list) -> int:
        return int((held[0][0] / 1e6 + self.wait) * 1000)

    def _open(self) -> list[tuple]:
        if not self.held.exists():
            return []
        return [(round(row[0].timestamp() * 1e6), row[1]) for row in self.held.get()]

    def _keep(self, held: list) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if held:
            self.held.put([(_EPOCH + dt.timedelta(microseconds=at), message) for at, message in held])
            self.handle.registerTimer(self._due(held))
        else:
            self.held.clear()

    def _closed(self, messages: Iterator[tuple], held: list) -> Iterator[tuple[list, str]]:
        """Batches and why they close; ``held`` has the messages of the one that is open."""
        for message in messages:
            if held and message[0] / 1e6 * 1000 >= self._due(held):
                yield list(held), "age"
                held.clear()
            held.append(message)
            if len(held) == self.size:
                yield list(held), "full"
                held.clear()

    def _numbered(self, queue: str, closed: Iterable[tuple[list, str]]) -> Iterator[pd.DataFrame]:
        """The batches in frames of bounded size, numbered on from the last one."""
        number = self.number.get()[0] if self.number.exists() else 0
        rows, size = [], 0
        for held, why in closed:
            messages = [{"arrived": at, "message": message} for at, message in held]
            rows.append((queue, number, held[0][0], len(held), why, messages))
            number += 1
            size += sum(map(_size, held))
            if size >= HELD_BYTES:
                yield pd.DataFrame(rows, columns=_BATCH_COLUMNS)
                rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=_BATCH_COLUMNS)
        self.number.update((number,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self._open()
        arrived = (
            (int(at), message)
            for frame in rows
            for at, message in zip(frame["at"].tolist(), frame["message"].tolist(), strict=True)
        )
        yield from self._numbered(key[0], self._closed(in_order(arrived), held))
        self._keep(held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._open()
        if held:
            self.held.clear()
            yield from self._numbered(key[0], [(held, "age")])

    def close(self) -> None:
        pass


def batched(
    messages: DataFrame, size: int = SCRAPE_MESSAGES, wait: float = WAIT_SECONDS, late: str = "0 seconds"
) -> DataFrame:
    """A stream of batches from a stream of ``queue, arrived, message``.

    Each queue makes batches of its own, numbered from 0, so a stream of any rate is dealt to as
    many queues as it needs. Messages of one time go by their text. A batch holds ``size`` messages
    at most, and no message arrived ``wait`` seconds or more after its first one. ``late`` is how
    far messages may arrive out of order between micro-batches.
    """
    keep_state_on_disk(messages.sparkSession)
    at = F.unix_micros(F.col("arrived").cast("timestamp")).alias("at")
    timed = messages.select(F.col("queue").cast("string"), "arrived", "message", at)
    keyed = timed.withWatermark("arrived", late).groupBy("queue")
    made = keyed.transformWithStateInPandas(Batches(size, wait), _BATCH, "Append", "EventTime")
    message = lambda m: F.struct(
        F.timestamp_micros(m["arrived"]).alias("arrived"), m["message"].alias("message")
    )
    return made.withColumns(
        {"opened": F.timestamp_micros("opened"), "messages": F.transform("messages", message)}
    )
