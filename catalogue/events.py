"""The event pipeline run to its end over files made of the given tables."""

from itertools import groupby
from urllib.parse import quote

from pyarrow.fs import FileSystem
from pyspark.sql import functions as F

from catalogue.registry import query, table
from larder.operators.index import chunk_manifest, with_index
from larder.operators.tags import tokens
from larder.functions.lists import parse_py_list
from larder.schemas import FAILURE, SANITIZED, URL_LIST
from larder.session import scratch_path
from larder.sinks.commits import commit_batch, read_committed
from larder.sinks.tables import write_pages
from larder.sources.messages import event_files, read_json_objects
from larder.streaming import pipeline as sp
from larder.streaming import retries as rt
from larder.streaming.batching import batched


def _url_files(spark, d):
    """Events as CSV files of URL messages: a user's page each."""
    path = scratch_path(spark, "urls")
    table(spark, d, "events").select(
        F.concat(F.lit("u"), "event_id").alias("uid"),
        F.concat(F.lit("https://x.com/"), "user_id").alias("url"),
    ).write.option("header", True).csv(path)
    return path


def _page_records(spark, d):
    """One record per supplier page, so that later users have none."""
    return table(spark, d, "supplier").select(
        F.concat(F.lit("https://x.com/"), "s_suppkey").alias("url"),
        F.col("s_name").alias("title"),
        F.col("s_acctbal").cast("int").alias("total_time"),
        F.array(F.lit("1 cup Of The"), "s_name").alias("ingredients"),
        F.lit("drop me").alias("extra"),
    )


def _page_table(spark, d, pages):
    """The records laid out for lookups by URL."""
    path = scratch_path(spark, "pages")
    write_pages(pages, path, buckets=16)
    return spark.read.schema(pages.schema).parquet(path)


def _run(spark, rows, work, progress=None):
    run = sp.start(rows, work, progress or scratch_path(spark, "progress"), backfill=True)
    run.awaitTermination()


def _stage(spark, d):
    out = scratch_path(spark, "staged")
    pages = _page_table(spark, d, _page_records(spark, d))
    _run(spark, sp.url_files(spark, _url_files(spark, d)), sp.stage_batch(pages, out))
    return out


@query("""
SELECT 'u' || event_id AS uid, 'https://x.com/' || user_id AS url, s_name AS title,
  trunc(s_acctbal)::BIGINT AS total_time, '1 cup Of The|' || s_name AS ingredients, 0::BIGINT AS cook_time, '' AS category
FROM events JOIN supplier ON s_suppkey = user_id
""")
def stream_stage(spark, d):
    return read_committed(spark, _stage(spark, d), "staged", SANITIZED).select(
        "uid",
        "url",
        "title",
        "total_time",
        F.array_join("ingredients", "|").alias("ingredients"),
        "cook_time",
        F.array_join("category", "|").alias("category"),
    )


@query("""
SELECT 'u' || event_id AS uid, 'https://x.com/' || user_id AS url, 404::BIGINT AS status_code
FROM events WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = user_id)
""")
def stream_failures(spark, d):
    failed = read_committed(spark, _stage(spark, d), "failed", FAILURE)
    return failed.select("uid", "url", "status_code")


@query(r"""
WITH v AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS w FROM benchmark),
l AS (SELECT unnest(['1', 'cup', 'of', 'the']) AS w, unnest([1, 2, 3, 4]) AS pos),
k AS (SELECT coalesce(string_agg(w, '|' ORDER BY pos), '') AS tags FROM l WHERE w IN (SELECT w FROM v))
SELECT 'u' || event_id AS uid, s_name AS title, tags FROM k, events JOIN supplier ON s_suppkey = user_id
""")
def stream_tags(spark, d):
    staged, out = _stage(spark, d), scratch_path(spark, "tagged")
    words = F.explode(tokens(F.col("text")))
    vocab = table(spark, d, "benchmark").select(words.alias("ingredients")).distinct()
    _run(spark, sp.staged_batches(spark, staged), sp.tag_batch(vocab, staged, out))
    tagged = read_committed(spark, out, "tagged", SANITIZED)
    return tagged.select("uid", "title", F.array_join("ingredient_tags", "|").alias("tags"))


@query("""
SELECT 'u' || event_id AS key, '{"uid":"u' || event_id || '","url":"https://x.com/' || user_id || '"}' AS value FROM events
""")
def stream_messages(spark, d):
    out = scratch_path(spark, "messages")
    _run(spark, sp.url_files(spark, _url_files(spark, d)), sp.fan_out_batch(out))
    return read_committed(spark, out, "messages", "key string, value string").drop("batch_id")


@query("""
WITH c AS (SELECT event_type || '-' || user_id % 16 AS part, count(*) AS n FROM events GROUP BY part),
k AS (SELECT part, unnest(range(0, (n + 3) // 4)) AS chunk_no FROM c)
SELECT part, chunk_no, chunk_no * 4 + 1 AS start_index, 4::BIGINT AS nrows FROM k
""")
def stream_manifest(spark, d):
    """Files of the events of a type and some users arrive, some in each micro-batch."""
    path, out = scratch_path(spark, "urls"), scratch_path(spark, "manifest")
    events = table(spark, d, "events").select(
        F.col("event_id").alias("uid"),
        F.col("props").alias("url"),
        F.concat_ws("-", "event_type", F.col("user_id") % 16).alias("part"),
    )
    events.repartition("part").write.partitionBy("part").option("header", True).csv(path)
    _run(spark, sp.url_files(spark, path), sp.manifest_batch(out))
    made = read_committed(
        spark, out, "manifest", "file string, chunk_no long, start_index long, nrows long"
    )
    part = F.regexp_extract("file", "/part=([^/]+)/", 1).alias("part")
    return made.select(part, "chunk_no", "start_index", "nrows")


@query("""
WITH f AS (SELECT user_id, count(*) AS attempts, max(event_id) AS last FROM events WHERE event_type = 'error' GROUP BY user_id)
SELECT 'u' || user_id AS uid, s_name AS title FROM f JOIN supplier ON s_suppkey = user_id WHERE attempts < 14
""")
def redrive(spark, d):
    errors = table(spark, d, "events").where("event_type = 'error'")
    failures = errors.select(
        F.concat(F.lit("u"), "user_id").alias("uid"),
        F.concat(F.lit("https://x.com/"), "user_id").alias("url"),
        F.lit(404).cast("bigint").alias("status_code"),
        F.col("event_id").alias("timestamp"),
    )
    ok, _ = sp.redrive(failures, _page_records(spark, d), 14)
    return ok.select("uid", "title")


@query("""
SELECT 'u' || event_id AS uid, 'https://x.com/' || user_id AS url, s_name AS title, 1::BIGINT AS deliveries
FROM events JOIN supplier ON s_suppkey = user_id WHERE event_type <> 'error'
""")
def redrive_twice(spark, d):
    """Items fail, their pages appear, and the failures are redriven two times."""
    out = scratch_path(spark, "redriven")
    rows = table(spark, d, "events").where("event_type <> 'error'").select(
        F.concat(F.lit("u"), "event_id").alias("uid"),
        F.concat(F.lit("https://x.com/"), "user_id").alias("url"),
    )
    pages = _page_records(spark, d)
    sp.stage_batch(pages.limit(0), out)(rows, 0)
    for batch_id in (1, 2):
        sp.redrive_job(spark, out, pages, batch_id, 14)
    staged = read_committed(spark, out, "staged", SANITIZED)
    return staged.groupBy("uid", "url", "title").agg(F.count(F.lit(1)).alias("deliveries"))


@query("""
SELECT 'u' || event_id AS uid, CASE WHEN s_suppkey IS NULL THEN 'failed' ELSE 'staged' END AS place
FROM events LEFT JOIN supplier ON s_suppkey = user_id
""")
def stage_replay(spark, d):
    """A batch whose pages were missing is run again, then has all it can have; nothing is twice."""
    out = scratch_path(spark, "replayed")
    rows = table(spark, d, "events").select(
        F.concat(F.lit("u"), "event_id").alias("uid"),
        F.concat(F.lit("https://x.com/"), "user_id").alias("url"),
    )
    pages = _page_records(spark, d)
    twice = pages.unionByName(pages.withColumn("title", F.lit("an older crawl")))
    for known in (pages, pages.limit(0), twice):
        sp.stage_batch(known, out)(rows, 0)
    ok = read_committed(spark, out, "staged", SANITIZED).select("uid", F.lit("staged").alias("place"))
    failed = read_committed(spark, out, "failed", FAILURE)
    return ok.unionByName(failed.select("uid", F.lit("failed").alias("place")))


@query("""
SELECT 'u' || event_id AS uid, 'https://x.com/' || user_id AS url, 1::BIGINT AS deliveries FROM events
""")
def stream_unrepeated(spark, d):
    """Every message is delivered twice, the second time after a restart; each is handled once."""
    urls, out, progress = (scratch_path(spark, x) for x in ("urls", "unrepeated", "progress"))
    messages = table(spark, d, "events").select(
        F.concat(F.lit("u"), "event_id").alias("uid"),
        F.concat(F.lit("https://x.com/"), "user_id").alias("url"),
    )

    def work(batch, batch_id):
        commit_batch(spark, out, batch_id, messages=batch.select("uid", "url"))

    for _ in range(2):
        messages.write.mode("append").option("header", True).csv(urls)
        _run(spark, sp.unrepeated(sp.url_files(spark, urls)), work, progress)
    sent = read_committed(spark, out, "messages", "uid string, url string")
    return sent.groupBy("uid", "url").agg(F.count(F.lit(1)).alias("deliveries"))


@query("""
WITH i AS (SELECT DISTINCT user_id FROM events),
t AS (SELECT user_id, s_suppkey IS NOT NULL AS known, user_id % 3 AS kind FROM i LEFT JOIN supplier ON s_suppkey = user_id)
SELECT 'u' || user_id AS uid, CASE WHEN known AND kind < 2 THEN 'staged' ELSE 'gave up' END AS outcome,
  CASE WHEN known AND kind = 0 THEN 0 WHEN known AND kind = 1 THEN 1 ELSE 3 END::BIGINT AS failures
FROM t
""")
def stream_retries(spark, d):
    """Pages of some items are there at once, of some after the first attempt, of the others never."""
    urls, out = scratch_path(spark, "urls"), scratch_path(spark, "retries")
    users = table(spark, d, "events").select("user_id").distinct()
    named = users.select(
        F.concat(F.lit("u"), "user_id").alias("uid"),
        F.concat(F.lit("https://x.com/"), "user_id").alias("url"),
    )
    named.write.option("header", True).csv(urls)
    pages = _page_records(spark, d)
    kind = F.substring_index("url", "/", -1).cast("bigint") % 3
    crawls = [_page_table(spark, d, pages.where(kind <= last)) for last in (0, 1)]

    def lookup(batch):
        first, later = batch.where("attempt = 1"), batch.where("attempt > 1")
        found = [sp.enrich(b, c, keep=["attempt"]) for b, c in zip((first, later), crawls, strict=True)]
        return found[0].unionByName(found[1])

    rows = rt.attempts(sp.url_files(spark, urls), out, first=0.2, longest=0.5)
    work = rt.attempt_batch(lookup, out, max_attempts=3)
    run = sp.start(rows, work, scratch_path(spark, "progress"), wait="200 milliseconds")
    rt.drain(run, spark, out, max_attempts=3, seconds=600)
    failed = read_committed(spark, out, "failed", rt.FAILED_ATTEMPT)
    count = failed.groupBy("uid").agg(F.count(F.lit(1)).alias("failures"))
    ok = read_committed(spark, out, "staged", SANITIZED).select("uid", F.lit("staged").alias("outcome"))
    return ok.join(count, "uid", "full").select(
        "uid",
        F.coalesce("outcome", F.lit("gave up")).alias("outcome"),
        F.coalesce("failures", F.lit(0).cast("bigint")).alias("failures"),
    )


@query("""
SELECT 'u' || user_id AS uid, arg_min(props, event_id) AS props, min(event_id) AS event_id
FROM events GROUP BY user_id
""")
def first_delivery(spark, d):
    items = table(spark, d, "events").select(F.concat(F.lit("u"), "user_id").alias("uid"), "props", "event_id")
    return sp.first_delivery(items, "event_id")


def _write_json_files(rows, key, path):
    """A file of each key in one folder, with its rows as JSON lines.

    Tasks write the files themselves, by the scheme of ``path``: a writer of Spark's opens, commits
    and gives a folder to each file, which took by far most of the time. A task run again replaces
    its files by the same ones.
    """

    def write(part):
        store, folder = FileSystem.from_uri(path)
        for name, docs in groupby(part, lambda row: row["name"]):
            with store.open_output_stream(f"{folder}/{quote(name, safe='')}.json") as file:
                for row in docs:
                    file.write(f"{row['doc']}\n".encode())

    store, folder = FileSystem.from_uri(path)
    store.create_dir(folder)
    name = F.coalesce(F.concat(F.lit("key="), F.col(key).cast("string")), F.lit("null"))
    docs = rows.select(name.alias("name"), F.to_json(F.struct(*rows.columns)).alias("doc"))
    docs.repartition("name").sortWithinPartitions("name").foreachPartition(write)


@query("SELECT s_suppkey, s_name AS title, s_acctbal AS balance FROM supplier")
def json_objects(spark, d):
    """Records of files that hold one JSON object each."""
    path = scratch_path(spark, "json-objects")
    _write_json_files(table(spark, d, "supplier"), "s_suppkey", path)
    record = F.col("record")
    return read_json_objects(spark, path).select(
        F.variant_get(record, "$.s_suppkey", "bigint").alias("s_suppkey"),
        F.variant_get(record, "$.s_name", "string").alias("title"),
        F.variant_get(record, "$.s_acctbal", "double").alias("balance"),
    )


def _event_files(spark, d):
    """A folder of CSV files per event type; object events name all but the error files, and each
    error event names a file that is not there."""
    directory = scratch_path(spark, "objects")
    events = table(spark, d, "events")
    literal = F.expr(r"concat('[\'', event_type, '\', ', user_id, ']')")
    rows = events.select("event_id", literal.alias("ingredients"), F.col("event_type").alias("kind"))
    rows.write.partitionBy("kind").option("header", True).option("escape", '"').csv(directory)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(directory)
    key = F.substring_index("path", f"{directory}/", -1)
    there = listed.select(F.lit(None).cast("bigint").alias("event_id"), key.alias("object_key"))
    gone = events.where("event_type = 'error'").select(
        "event_id", F.concat(F.lit("gone/"), "event_id", F.lit(".csv")).alias("object_key")
    )
    named = there.where(~F.col("object_key").startswith("kind=error")).unionByName(gone)
    return event_files(spark, named, directory, "event_id long, ingredients string")


@query("""
SELECT event_id, event_type || '|' || user_id AS ingredients FROM events WHERE event_type <> 'error'
""")
def event_csv(spark, d):
    rows, _ = _event_files(spark, d)
    items = parse_py_list(F.col("ingredients"))
    return rows.select("event_id", F.array_join(items, "|").alias("ingredients"))


@query("SELECT event_id, 'gone/' || event_id || '.csv' AS object_key FROM events WHERE event_type = 'error'")
def event_missing(spark, d):
    _, missing = _event_files(spark, d)
    return missing.select("event_id", "object_key")


def _fan_out(spark, d):
    """The manifest of all event types, and rows of all but the errors, whose file is lost."""
    events = table(spark, d, "events").select(
        F.col("event_type").alias("file"), F.col("event_id").alias("uid"), F.col("props").alias("url")
    )
    counts = events.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    rows = with_index(events.where("file <> 'error'"), "uid", "idx", by=["file"])
    return sp.fan_out(chunk_manifest(counts, "file", "n", 4), rows)


@query("""
SELECT event_id::VARCHAR AS key, '{"uid":' || event_id || ',"url":"' || replace(props, '"', '\\"') || '"}' AS value
FROM events WHERE event_type <> 'error'
""")
def fan_out(spark, d):
    sent, _ = _fan_out(spark, d)
    return sent


@query("""
WITH c AS (SELECT count(*) AS n FROM events WHERE event_type = 'error')
SELECT 'error' AS file, unnest(range(0, (n + 3) // 4)) * 4 + 1 AS start_index FROM c
""")
def fan_out_failures(spark, d):
    _, failed = _fan_out(spark, d)
    return failed.select("file", "start_index")


@query("""
WITH RECURSIVE m AS (SELECT (user_id % 8)::VARCHAR AS queue, ts, row_number() OVER (
    PARTITION BY user_id % 8 ORDER BY ts, event_id::VARCHAR) - 1 AS i FROM events),
f AS (SELECT queue, i, ts, i + 10 AS by_size, (SELECT min(o.i) FROM m o WHERE o.queue = m.queue AND o.ts >= m.ts + INTERVAL 8 HOUR) AS by_age,
  (SELECT count(*) FROM m o WHERE o.queue = m.queue) AS total, (SELECT max(ts) FROM m) AS last FROM m),
n AS (SELECT queue, i, ts, least(by_size, coalesce(by_age, total), total) AS next,
  by_size <= least(coalesce(by_age, total), total) AS filled,
  by_age IS NOT NULL OR ts + INTERVAL 8 HOUR <= last AS aged FROM f),
b AS (SELECT queue, 0::BIGINT AS batch_no, i, next, filled, aged FROM n WHERE i = 0
  UNION ALL SELECT n.queue, batch_no + 1, n.i, n.next, n.filled, n.aged FROM b JOIN n ON n.queue = b.queue AND n.i = b.next)
SELECT queue, batch_no, (next - i)::INTEGER AS n, CASE WHEN filled THEN 'full' ELSE 'age' END AS why
FROM b WHERE filled OR aged
""")
def stream_batches(spark, d):
    """Messages of eight queues in batches of ten or eight hours; those still open are not given."""
    arrivals, out = scratch_path(spark, "arrivals"), scratch_path(spark, "batches")
    table(spark, d, "events").select(
        (F.col("user_id") % 8).cast("string").alias("queue"),
        F.col("ts").alias("arrived"),
        F.col("event_id").cast("string").alias("message"),
    ).write.parquet(arrivals)
    rows = spark.readStream.schema("queue string, arrived timestamp, message string").parquet(arrivals)

    def work(batch, batch_id):
        commit_batch(spark, out, batch_id, batches=batch.select("queue", "batch_no", "n", "why"))

    _run(spark, batched(rows, 10, 8 * 3600), work)
    schema = "queue string, batch_no long, n int, why string"
    return read_committed(spark, out, "batches", schema).drop("batch_id")


@query("""
SELECT 'm' || event_id AS id, CASE WHEN event_type IN ('error', 'click') THEN 'failed' ELSE 'sent' END AS place,
  CASE event_type WHEN 'error' THEN 'unreadable' WHEN 'click' THEN 'no url' ELSE 'https://x.com/' || user_id END AS detail
FROM events
""")
def stream_poison(spark, d):
    """Messages of a queue, of which some cannot be read and some name no page."""
    arrivals, out = scratch_path(spark, "messages"), scratch_path(spark, "decoded")
    whole = F.to_json(
        F.struct(
            F.concat(F.lit("m"), "event_id").alias("uid"),
            F.when(F.col("event_type") != "click", F.concat(F.lit("https://x.com/"), "user_id")).alias("url"),
        )
    )
    body = F.when(F.col("event_type") == "error", F.concat(F.lit("["), whole)).otherwise(whole)
    table(spark, d, "events").select(
        F.concat(F.lit("m"), "event_id").alias("messageId"), body.alias("body")
    ).write.json(arrivals)
    _run(spark, sp.message_files(spark, arrivals), sp.decode_batch(out))
    sent = read_committed(spark, out, "messages", URL_LIST)
    failed = read_committed(spark, out, "failed_messages", sp.FAILED_MESSAGE)
    return sent.select(F.col("uid").alias("id"), F.lit("sent").alias("place"), F.col("url").alias("detail")).unionByName(
        failed.select(F.col("itemIdentifier").alias("id"), F.lit("failed").alias("place"), F.col("reason").alias("detail"))
    )
