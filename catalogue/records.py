"""Untyped records, overlays, failures, messages."""

from pyspark.sql import functions as F

from catalogue.registry import query, table, wide_table
from larder.operators import failures as fx
from larder.operators import records as rx
from larder.schemas import SANITIZED_KEYS, SCRAPED
from larder.session import scratch_path
from larder.sinks.tables import json_documents as documents_of
from larder.sinks.tables import messages as messages_of
from larder.sources.messages import chunk_messages, object_events, read_records, url_messages
from larder.sources.tables import latest_pages as latest_of

_K = "regexp_extract(props, '([0-9]+)', 1)"
# Records of every shape the sanitizer meets: text, fraction, truth value, list, null, absent.
_RECORD = f"""concat('{{"uid":"u', event_id, '","extra":1,"total_time":', CASE event_type
    WHEN 'click' THEN {_K} WHEN 'view' THEN concat('"', {_K}, '"') WHEN 'error' THEN concat('[', {_K}, ']')
    WHEN 'signup' THEN 'true' ELSE concat({_K}, '.75') END,
  ',"cook_time":', CASE event_type WHEN 'click' THEN 'null' WHEN 'view' THEN '"4.7"' ELSE '" 7 "' END,
  ',"title":', CASE event_type WHEN 'click' THEN {_K} WHEN 'signup' THEN 'true' WHEN 'view' THEN '["a","b"]' ELSE '"t"' END,
  ',"category":', CASE event_type WHEN 'click' THEN '"one"' WHEN 'view' THEN concat('["x",', {_K}, ']')
    WHEN 'error' THEN '[]' ELSE 'null' END, '}}')"""


def _shown(df):
    """Lists as joined text."""
    lists = [key for key, kind in SANITIZED_KEYS.items() if kind == "list"]
    return df.withColumns({c: F.array_join(c, "|") for c in lists})


_CONSTANT = ", ".join(
    f"{'0::BIGINT' if kind == 'int' else chr(39) * 2} AS {key}"
    for key, kind in SANITIZED_KEYS.items()
    if key not in ("uid", "total_time", "cook_time", "title", "category")
)


@query(f"""
SELECT event_id, 'u' || event_id AS uid, CASE event_type WHEN 'error' THEN 0 WHEN 'signup' THEN 1
    ELSE {_K}::BIGINT END AS total_time,
  CASE event_type WHEN 'click' THEN 0::BIGINT WHEN 'view' THEN 0 ELSE 7 END AS cook_time,
  CASE event_type WHEN 'click' THEN {_K} WHEN 'signup' THEN 'True' WHEN 'view' THEN '["a","b"]' ELSE 't' END AS title,
  CASE event_type WHEN 'click' THEN 'one' WHEN 'view' THEN 'x|' || {_K} ELSE '' END AS category,
  event_type = 'error' AS coerced, {_CONSTANT}
FROM events
""")
def sanitize(spark, d):
    events = wide_table(spark, d, "events", "event_id", "event_type", "props")
    records = events.select("event_id", F.expr(_RECORD).alias("body"))
    return _shown(rx.sanitize_json(records, "body", keep=["event_id"]))


@query("""
SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k,
  coalesce(json_extract_string(props, '$.title'), '') AS title
FROM events
""")
def sanitize_keys(spark, d):
    events = table(spark, d, "events").withColumn("record", F.try_parse_json("props"))
    return rx.sanitize(events, "record", ["event_id"], {"k": "int", "title": "text"}).drop("coerced")


@query("""
SELECT event_id, user_id, coalesce(c_mktsegment, event_type) AS event_type, coalesce(c_acctbal, value) AS value, c_name
FROM events LEFT JOIN customer ON c_custkey = user_id
""")
def enrich_overlay(spark, d):
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    customers = table(spark, d, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("event_type"),
        F.col("c_acctbal").alias("value"),
        "c_name",
    )
    return rx.overlay(events, customers, "user_id")


@query("""
SELECT event_id::VARCHAR AS uid, coalesce(props, '') AS url, 404::BIGINT AS status_code, epoch(date_trunc('second', ts))::BIGINT AS timestamp
FROM events WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = user_id)
""")
def enrich_misses(spark, d):
    known = table(spark, d, "supplier").select(F.col("s_suppkey").alias("user_id"), "s_name")
    merged = rx.overlay(table(spark, d, "events"), known, "user_id").where("s_name IS NULL")
    items = merged.select(F.col("event_id").alias("uid"), F.col("props").alias("url"), "ts")
    seconds = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)")
    return fx.failure_rows(items, ["uid", "url"], F.lit(404), seconds)


_FAILED = """
WITH f AS (SELECT user_id::VARCHAR AS uid, props AS url, CASE WHEN value > 50 THEN 500 ELSE -1 END::BIGINT AS status_code,
  event_id AS timestamp FROM events WHERE event_type = 'error')
"""


def _failures(spark, d):
    errors = table(spark, d, "events").where("event_type = 'error'")
    return fx.failure_rows(
        errors.withColumnsRenamed({"user_id": "uid", "props": "url"}),
        ["uid", "url"],
        F.when(F.col("value") > 50, 500),
        F.col("event_id"),
    )


@query(f"""
{_FAILED} SELECT uid, max(timestamp) AS timestamp, arg_max(status_code, timestamp) AS status_code,
  arg_max(url, timestamp) AS url, count(*) AS attempts FROM f GROUP BY uid
""")
def failure_latest(spark, d):
    return fx.latest_failures(_failures(spark, d))


@query(f"{_FAILED} SELECT * FROM f WHERE status_code <> -1")
def failure_status(spark, d):
    return fx.with_status(_failures(spark, d))


@query(f"""
{_FAILED} SELECT uid, max(timestamp) AS timestamp, arg_max(status_code, timestamp) AS status_code,
  arg_max(url, timestamp) AS url, count(*) AS attempts FROM f GROUP BY uid HAVING count(*) < 14
""")
def redrivable(spark, d):
    return fx.redrivable(_failures(spark, d), 14)


def _outcomes(spark, d):
    return table(spark, d, "events").select(
        F.col("user_id").alias("batch_id"),
        F.col("event_id").alias("item"),
        (F.col("event_type") == "error").alias("failed"),
    )


@query("""
SELECT user_id AS batch_id, count(*) FILTER (event_type = 'error') AS n_failed,
  count(*) FILTER (event_type <> 'error') AS n_ok FROM events GROUP BY user_id
""")
def failure_counts(spark, d):
    return fx.batch_counts(_outcomes(spark, d), "batch_id", "failed")


@query('SELECT user_id AS batch_id, event_id AS "itemIdentifier" FROM events WHERE event_type = \'error\'')
def failure_items(spark, d):
    return fx.batch_item_failures(_outcomes(spark, d), "batch_id", "item", "failed")


@query("""
SELECT p_partkey, coalesce(nullif(p_name, 'red widget'), '') AS p_name, nullif(p_size, 5) AS p_size FROM part
""")
def fill_text(spark, d):
    parts = table(spark, d, "part").selectExpr(
        "p_partkey", "nullif(p_name, 'red widget') AS p_name", "nullif(p_size, 5) AS p_size"
    )
    return rx.fill_text(parts)


@query("""
SELECT o_orderkey::VARCHAR AS key,
  '{"o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority || '"}' AS value FROM orders
""")
def message_rows(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return messages_of(orders, "o_orderkey")


@query(r"""
SELECT doc_id || '_' || regexp_replace(source, '[^a-zA-Z0-9_]', '_', 'g') || '.json' AS json_filename,
  '{"dish_id":' || doc_id || ',"source":"' || source || '","yields":null}' AS doc FROM documents
""")
def json_documents(spark, d):
    docs = table(spark, d, "documents").select(
        F.col("doc_id").alias("dish_id"), "source", F.lit(None).cast("string").alias("yields")
    )
    return documents_of(docs)


@query("""
SELECT event_id, CASE WHEN event_type <> 'error' THEN 'u' || user_id END AS uid,
  CASE WHEN event_type <> 'error' THEN 'https://x.com/' || event_id END AS url,
  event_type = 'error' AS unreadable FROM events
""")
def message_decode(spark, d):
    body = F.expr("""CASE WHEN event_type = 'error' THEN concat('u', user_id)
      ELSE concat('{"uid":"u', user_id, '","url":"https://x.com/', event_id, '"}') END""")
    return url_messages(table(spark, d, "events").select("event_id", body.alias("body"))).drop("body")


@query("""
SELECT event_id, user_id AS start_index, 4::BIGINT AS nrows, 'raw' AS s3_bucket, event_type || '.csv' AS s3_file_path
FROM events
""")
def chunk_decode(spark, d):
    body = F.expr("""concat('{"start_index":', user_id, ',"nrows":4,"s3_bucket":"raw","s3_file_path":"',
      event_type, '.csv"}')""")
    read = chunk_messages(table(spark, d, "events").select("event_id", body.alias("body")))
    return read.drop("body", "unreadable")


@query("SELECT event_id, event_type AS bucket, 'f' || user_id || '.csv' AS object_key FROM events")
def event_envelope(spark, d):
    body = F.expr("""concat('{"Records":[{"eventName":"put","s3":{"bucket":{"name":"', event_type,
      '"},"object":{"key":"f', user_id, '.csv","size":1}}}]}')""")
    events = table(spark, d, "events").select("event_id", body.alias("body"))
    return object_events(events).drop("body")


@query("""
SELECT p_partkey::VARCHAR AS uid, p_name AS title, CASE WHEN p_type <> 'SMALL' THEN p_size::VARCHAR END AS total_time,
  replace(p_name, ' ', '|') AS ingredients, NULL::VARCHAR AS author FROM part
""")
def record_table(spark, d):
    path = scratch_path(spark, "records")
    table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("uid"),
        F.col("p_name").alias("title"),
        F.expr("CASE WHEN p_type <> 'SMALL' THEN p_size END").alias("total_time"),
        F.split("p_name", " ").alias("ingredients"),
    ).write.json(path)
    records = read_records(spark, path, SCRAPED)
    return records.select(
        "uid", "title", "total_time", F.array_join("ingredients", "|").alias("ingredients"), "author"
    )


@query("""
SELECT event_type AS url, max(event_id) AS event_id, arg_max(props, event_id) AS props FROM events GROUP BY event_type
""")
def latest_pages(spark, d):
    events = table(spark, d, "events").select(F.col("event_type").alias("url"), "event_id", "props")
    return latest_of(events, "event_id")
