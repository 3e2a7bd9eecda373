"""Row numbers, interleaving, slices, shards and chunks."""

from pyspark.sql import functions as F

from catalogue.registry import query, table
from larder.operators import index as ix
from larder.operators.sets import already, not_yet, union_all, union_distinct
from larder.session import scratch_path
from larder.sinks import tables as kx
from larder.sources.corpus import parquet_positions


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders")
def row_index(spark, d):
    return ix.with_index(table(spark, d, "orders").select("o_orderkey"), "o_orderkey")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders")
def file_index(spark, d):
    return parquet_positions(spark, f"{d}/orders.parquet").select("o_orderkey", "idx")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS idx
FROM lineitem
""")
def sorted_position(spark, d):
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    lines = table(spark, d, "lineitem").select("l_shipdate", *key)
    return ix.sorted_index(lines, ["l_shipdate", *key]).drop("l_shipdate")


_SOURCE = "CASE WHEN lang <> 'de' THEN source END"


@query(f"""
WITH s AS (SELECT doc_id, {_SOURCE} AS source FROM documents)
SELECT doc_id, source, CASE WHEN source IS NOT NULL THEN
  row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 END AS source_order
FROM s ORDER BY source_order NULLS LAST, source, doc_id
""")
def interleave(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.expr(_SOURCE).alias("source"))
    return ix.interleave(docs, key="doc_id")


@query("""
SELECT o_orderkey, o_orderstatus,
  row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS place
FROM orders
""")
def group_order(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return ix.with_index(orders, "o_orderkey", "place", by=["o_orderstatus"], bits=10)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000")
def head_rows(spark, d):
    return ix.head_rows(
        table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 1000
    )


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 700")
def offset_slice(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return ix.ordered_slice(orders, "o_orderkey", 700, 1200, bits=8)


@query("""
SELECT page_id, row_number() OVER (ORDER BY md5('7|' || page_id)) - 1 AS place FROM pages
""")
def seeded_shuffle(spark, d):
    pages = table(spark, d, "pages").select("page_id").repartition(7)
    shuffled = ix.seeded_shuffle(pages, "page_id", 7)
    key = F.md5(F.concat(F.lit("7|"), "page_id").cast("binary"))
    return ix.sorted_index(shuffled, [key], "place")


_HALF_NULL = "SELECT CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END AS k, o_orderkey AS o FROM orders"


def _half_null(spark, d):
    key = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey")).alias("k")
    return table(spark, d, "orders").select(key, F.col("o_orderkey").alias("o"))


@query(f"SELECT k, o, row_number() OVER (ORDER BY k NULLS LAST, o) - 1 AS idx FROM ({_HALF_NULL})")
def row_index_nulls(spark, d):
    return ix.with_index(_half_null(spark, d), "k", "idx", then=["o"], bits=8)


@query(f"SELECT k, o FROM ({_HALF_NULL}) ORDER BY k NULLS LAST, o LIMIT (SELECT count(*) * 3 // 4 FROM orders)")
def head_rows_nulls(spark, d):
    orders = _half_null(spark, d)
    return ix.head_rows(orders, "k", orders.count() * 3 // 4, then=["o"])


@query("""
WITH i AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders)
SELECT o_orderkey, idx, idx // 1000 + 1 AS shard FROM i
""")
def shards(spark, d):
    return ix.with_shard(row_index(spark, d), "idx", 1000)


@query("""
WITH i AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders)
SELECT o_orderkey, idx, idx // 1000 + 1 AS shard FROM i
""")
def shard_files(spark, d):
    """The shards as they were written: JSON Lines in a folder each."""
    path = scratch_path(spark, "shards")
    kx.write_shards(row_index(spark, d).select("o_orderkey", "idx"), path, "idx", 1000)
    return spark.read.schema("o_orderkey long, idx long, shard long").json(path)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 700")
def head_table(spark, d):
    """The first rows as they were written."""
    path = scratch_path(spark, "head")
    kx.write_head(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), path, "o_orderkey", 700)
    return spark.read.schema("o_orderkey long, o_totalprice double").parquet(path)


@query("""
WITH c AS (SELECT event_type AS file, count(*) AS n FROM events GROUP BY event_type),
k AS (SELECT file, unnest(range(0, (n + 3) // 4)) AS chunk_no FROM c)
SELECT file, chunk_no, chunk_no * 4 + 1 AS start_index, 4::BIGINT AS nrows FROM k
""")
def manifest(spark, d):
    events = table(spark, d, "events")
    counts = events.groupBy(F.col("event_type").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return ix.chunk_manifest(counts, "file", "n", 4)


_NUMBERED = """
WITH r AS (SELECT event_type AS file, event_id,
  row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS idx FROM events)
"""


def _numbered(spark, d):
    events = table(spark, d, "events").select(F.col("event_type").alias("file"), "event_id")
    return ix.with_index(events, "event_id", "idx", by=["file"])


@query(f"""
{_NUMBERED} SELECT file, event_id, idx, idx // 4 AS chunk_no, idx // 4 * 4 + 1 AS start_index,
  4::BIGINT AS nrows FROM r
""")
def chunk_rows(spark, d):
    return ix.chunk_rows(_numbered(spark, d), manifest(spark, d), "file", "idx")


@query(f"""
{_NUMBERED} SELECT file, idx // 9 AS chunk_no, min(idx) AS first_idx, max(idx) AS last_idx,
  count(*) AS n_rows FROM r GROUP BY ALL
""")
def chunk_sizes(spark, d):
    return ix.chunk_sizes(_numbered(spark, d), "idx", 9, by=["file"])


@query("""
SELECT o_orderkey, o_orderpriority FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""")
def incremental(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return not_yet(orders, lines, "o_orderkey")


@query("""
SELECT o_orderkey, o_orderpriority FROM orders o
WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
""")
def already_done(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    lines = table(spark, d, "lineitem").where("l_returnflag = 'R'")
    return already(orders, lines.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


@query("""
SELECT doc_id AS id, text, source FROM documents
UNION ALL SELECT item_id AS id, text, NULL AS source FROM benchmark
""")
def union_datasets(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "source")
    items = table(spark, d, "benchmark").select(F.col("item_id").alias("id"), "text")
    return union_all([docs, items])


@query("""
SELECT c_nationkey AS key FROM customer UNION SELECT s_nationkey FROM supplier
UNION SELECT n_nationkey FROM nation
""")
def union_distinct_keys(spark, d):
    names = (("customer", "c_nationkey"), ("supplier", "s_nationkey"), ("nation", "n_nationkey"))
    return union_distinct([table(spark, d, t).select(F.col(c).alias("key")) for t, c in names])
