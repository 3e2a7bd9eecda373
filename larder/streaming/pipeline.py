"""URL files to staged records to tagged records, with failures kept for redrive.

Two queries with a checkpoint each: ``stage`` and ``tag``. A micro-batch commits its tables at once,
see ``larder.sinks.commits``; a batch that is run again after a crash replaces its earlier output.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from larder.operators.failures import failure_rows, redrivable
from larder.operators.index import chunk_manifest, chunk_rows
from larder.operators.records import overlay, sanitize
from larder.operators.recipes import page_record
from larder.operators.sets import not_yet
from larder.operators.tags import PhraseTable, phrase_table, with_tags
from larder.schemas import FAILURE, QUEUE_MESSAGE, SANITIZED, URL_LIST
from larder.session import keep_state_on_disk, settle
from larder.sinks.commits import (
    commit,
    commit_batch,
    commit_stream,
    committed_rows,
    read_committed,
)
from larder.sinks.tables import messages
from larder.sources.messages import url_messages
from larder.sources.tables import one_page, pages_for

# Files per micro-batch and wait, as the scraping and the tagging step take them.
STAGE_FILES, TAG_FILES, WAIT = 40, 10, "20 seconds"
# Fixed value: how long the queue keeps a message and may deliver it again.
RETENTION = "6 days"
NO_PAGE_STATUS = 404


def url_files(
    spark: SparkSession,
    directory: str,
    schema: T.StructType = URL_LIST,
    files_per_batch: int = STAGE_FILES,
) -> DataFrame:
    """Arriving ``.csv`` files of URL messages, with each row's file and the time that came."""
    return (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(directory)
        .withColumns(
            {"file": F.col("_metadata.file_path"), "arrived": F.col("_metadata.file_modification_time")}
        )
    )


def message_files(
    spark: SparkSession, directory: str, files_per_batch: int = STAGE_FILES
) -> DataFrame:
    """Arriving files of queue messages, a JSON line each: ``messageId, body``."""
    return (
        spark.readStream.schema(QUEUE_MESSAGE)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(directory)
    )


def staged_batches(
    spark: SparkSession, root: str, batches_at_once: int = TAG_FILES
) -> DataFrame:
    """The commits of staged batches as they arrive, for ``tag_batch``."""
    return commit_stream(spark, root, batches_at_once)


def unrepeated(rows: DataFrame, keep: str = RETENTION, key: str = "uid") -> DataFrame:
    """Of a stream of messages each delivered once or more, the first delivery of each.

    The keys delivered are kept as state until ``keep`` has passed since they came, by the time
    their file arrived; that is as long as the queue delivers a message again. A message without a
    key is known by its URL. The state is part of the checkpoint, so a restart does not forget it.
    """
    keep_state_on_disk(rows.sparkSession)
    named = F.coalesce(F.nullif(F.col(key), F.lit("")), F.concat(F.lit("url "), F.col("url")))
    keyed = rows.withColumn("_key", named).withWatermark("arrived", keep)
    return keyed.dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def start(
    rows: DataFrame,
    work: Callable[[DataFrame, int], None],
    checkpoint: str,
    backfill: bool = False,
    wait: str = WAIT,
) -> StreamingQuery:
    """Run ``work`` per micro-batch; ``backfill`` takes what is there and stops."""
    writer = rows.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if backfill else {"processingTime": wait}
    return writer.trigger(**trigger).start()


def file_manifest(rows: DataFrame, size: int = 4, file: str = "file") -> DataFrame:
    """Chunk manifest of each file in a batch."""
    counts = rows.groupBy(file).agg(F.count(F.lit(1)).alias("n"))
    return chunk_manifest(counts, file, "n", size)


def enrich(
    rows: DataFrame,
    pages: DataFrame,
    keep: Sequence[str] = (),
    newest: str | None = None,
) -> DataFrame:
    """Messages with the record of their page laid over them, sanitized.

    ``pages`` holds the page's ``html``, or a record already read from it. Only the batch's pages
    are looked up and read, see ``pages_for``. Of several crawls of a URL the one with the greatest
    ``newest`` counts, or else one fixed by its content, so a message is never multiplied.
    ``status_code`` is null for a hit, else says why there is none; ``keep`` names columns that are
    not part of the message.
    """
    found = one_page(settle(pages_for(rows, pages), "crawls"), newest)
    if "html" in found.columns:
        found = page_record(found)
    found = settle(found.withColumn("_hit", F.lit(True)), "found")
    merged = overlay(rows, found, "url")
    parts = [c for c in merged.columns if c not in (*keep, "_hit")]
    record = F.to_variant_object(F.struct(*parts))
    status = F.when(F.col("_hit").isNull(), F.lit(NO_PAGE_STATUS))
    packed = merged.select(*keep, record.alias("_record"), status.alias("status_code"))
    return sanitize(packed, "_record", keep=[*keep, "status_code"])


def split_outcome(enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Staged rows, and failure rows with the item's uid, URL, status and time."""
    ok = enriched.where("status_code IS NULL").drop("status_code", "coerced")
    failed = enriched.where("status_code IS NOT NULL")
    return ok, failure_rows(failed, ["uid", "url"], F.col("status_code"))


def stage_batch(
    pages: DataFrame, out: str, newest: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Work of the first query: enrich, sanitize, commit the tables ``staged`` and ``failed``.

    One bad message never stops the others. The batch is looked up once and written, so both tables
    tell of the same lookup.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        enriched = enrich(batch.select("uid", "url"), pages, newest=newest)
        ok, failed = split_outcome(settle(enriched, "enriched"))
        commit_batch(batch.sparkSession, out, batch_id, staged=ok, failed=failed)

    return work


def tag_batch(
    vocab: DataFrame | PhraseTable, staged: str, out: str
) -> Callable[[DataFrame, int], None]:
    """Work of the second query: tag the ingredients of newly committed batches of ``staged``.

    A staged batch becomes a batch of the same number of the table ``tagged``, so one that was
    committed anew is tagged anew and replaces its rows. The vocabulary's phrases are prepared once,
    not per batch. Where the scratch folder expires, pass a ``PhraseTable`` of a frame that stays.
    """
    known = vocab if isinstance(vocab, PhraseTable) else phrase_table(vocab)

    def work(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        commits = settle(batch, "commits")
        # One row for each of the batches taken at once.
        ids = sorted({row["batch_id"] for row in commits.select("batch_id").collect()})
        if not ids:
            return
        rows = committed_rows(spark, staged, "staged", SANITIZED, commits).drop("ingredient_tags")
        # A uid may be delivered twice, so rows get a number of their own, fixed by writing it.
        rows = settle(rows.withColumn("_row", F.monotonically_increasing_id()), "untagged")
        tagged = with_tags(rows, "_row", "ingredients", known)
        commit(spark, out, {"tagged": tagged.drop("_row")}, ids)

    return work


def fan_out(
    manifest: DataFrame, rows: DataFrame, file: str = "file", idx: str = "idx", key: str = "uid"
) -> tuple[DataFrame, DataFrame]:
    """Messages of the rows a manifest asks for, and the manifest entries no row answers.

    ``rows`` know their file and their position in it; the other columns make up the message.
    """
    asked = settle(chunk_rows(rows, manifest, file, idx), "asked")
    sent = messages(asked.select(*(c for c in rows.columns if c not in (file, idx))), key)
    return sent, not_yet(manifest, asked, [file, "start_index"])


def fan_out_batch(out: str, key: str = "uid") -> Callable[[DataFrame, int], None]:
    """Each row as a JSON message of the table ``messages``."""

    def work(batch: DataFrame, batch_id: int) -> None:
        sent = messages(batch.drop("file", "arrived"), key)
        commit_batch(batch.sparkSession, out, batch_id, messages=sent)

    return work


FAILED_MESSAGE = "itemIdentifier string, body string, reason string"


def decode_batch(out: str) -> Callable[[DataFrame, int], None]:
    """Queue messages to the tables ``messages`` (``uid, url``) and ``failed_messages``.

    A message that cannot be read or names no page fails alone and is kept whole with its id, so
    the rest of its batch goes on and it can be delivered again.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        no_url = F.coalesce(F.col("url"), F.lit("")) == ""
        reason = F.when(F.col("unreadable"), F.lit("unreadable")).when(no_url, F.lit("no url"))
        told = settle(url_messages(batch).withColumn("reason", reason), "decoded")
        sent = told.where("reason IS NULL").select("uid", "url")
        failed = told.where("reason IS NOT NULL").select(
            F.col("messageId").alias("itemIdentifier"), "body", "reason"
        )
        commit_batch(batch.sparkSession, out, batch_id, messages=sent, failed_messages=failed)

    return work


def manifest_batch(
    out: str, size: int = 4, file: str = "file"
) -> Callable[[DataFrame, int], None]:
    """The chunk manifest of each arriving file, table ``manifest``."""

    def work(batch: DataFrame, batch_id: int) -> None:
        commit_batch(batch.sparkSession, out, batch_id, manifest=file_manifest(batch, size, file))

    return work


def redrive(
    failures: DataFrame,
    pages: DataFrame,
    max_attempts: int,
    staged: DataFrame | None = None,
    newest: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Try the latest failure of each item again: staged rows, and new failure rows.

    Items that ``staged`` holds have succeeded since and are left alone.
    """
    again = redrivable(failures, max_attempts).select("uid", "url")
    if staged is not None:
        again = not_yet(again, staged, "uid")
    return split_outcome(enrich(again, pages, newest=newest))


def redrive_job(
    spark: SparkSession,
    out: str,
    pages: DataFrame,
    batch_id: int,
    max_attempts: int,
    newest: str | None = None,
) -> None:
    """Redrive the failures and commit what came of it as a batch of ``staged`` and ``failed``.

    ``batch_id`` must be a batch of its own; a crashed run is repeated under the same number, and
    then does not see its own first output.
    """
    others = F.col("batch_id") != batch_id
    done = read_committed(spark, out, "staged", "uid string").where(others)
    failed = read_committed(spark, out, "failed", FAILURE).where(others)
    ok, bad = redrive(failed.drop("batch_id"), pages, max_attempts, done, newest)
    commit_batch(
        spark, out, batch_id, staged=settle(ok, "redriven"), failed=settle(bad, "failed-again")
    )


def first_delivery(rows: DataFrame, order: str, key: str = "uid") -> DataFrame:
    """Of a table whose source may deliver a message twice, the row of each key that came first.

    ``order`` must be unique within a key. Whole rows are compared map-side, none is shuffled twice.
    """
    rest = [c for c in rows.columns if c != key]
    first = F.min_by(F.struct(*rest), F.col(order)).alias("_first")
    return rows.groupBy(key).agg(first).select(key, "_first.*").select(*rows.columns)
