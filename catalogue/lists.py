"""List and JSON columns."""

from pyspark.sql import functions as F

from catalogue.registry import query, table, wide_table
from larder.functions import coerce as cx
from larder.functions import lists as lx

_PARTS = "list_transform(string_split(url, '/'), lambda x, i: {'k': lower(x), 'i': i, 'v': x})"


@query(f"""
SELECT page_id, array_to_string(list_transform(list_sort({_PARTS}), lambda s: s.v), '|') AS parts
FROM pages
""")
def list_sort(spark, d):
    pages = table(spark, d, "pages")
    return pages.select(
        "page_id", F.array_join(lx.lowercase_sort(F.split("url", "/")), "|").alias("parts")
    )


@query("SELECT page_id, to_json({'parts': string_split(url, '/')})::VARCHAR AS doc FROM pages")
def wrap_json(spark, d):
    pages = table(spark, d, "pages")
    return pages.select("page_id", lx.wrap_json(F.split("url", "/"), "parts").alias("doc"))


@query("SELECT page_id, array_to_string(string_split(url, '/'), '|') AS parts FROM pages")
def unwrap_json(spark, d):
    pages = table(spark, d, "pages").select(
        "page_id", lx.wrap_json(F.split("url", "/"), "parts").alias("doc")
    )
    parts = lx.unwrap_json(F.col("doc"), "parts")
    return pages.select("page_id", F.array_join(parts, "|").alias("parts"))


@query("SELECT page_id, to_json(string_split(url, '/'))::VARCHAR AS doc FROM pages")
def dump_json(spark, d):
    pages = table(spark, d, "pages")
    return pages.select("page_id", lx.dump_json(F.split("url", "/")).alias("doc"))


@query("""
SELECT doc_id, len(string_split(text, ',')) AS n, array_to_string(string_split(text, ','), '|') AS parts
FROM documents
""")
def split_commas(spark, d):
    parts = lx.split_commas(F.col("text"))
    docs = wide_table(spark, d, "documents", "doc_id", "text")
    return docs.select(
        "doc_id", F.size(parts).cast("bigint").alias("n"), F.array_join(parts, "|").alias("parts")
    )


@query("""
SELECT conv_id, turn, array_to_string(string_split(text, chr(10)), ' ... ') AS line FROM conversations
""")
def join_ingredients(spark, d):
    lines = lx.join_ingredients(F.split("text", "\n"))
    return table(spark, d, "conversations").select("conv_id", "turn", lines.alias("line"))


@query("""
SELECT doc_id, array_to_string(list_sort(list_distinct(string_split(text, ' '))), '|') AS words
FROM documents
""")
def distinct_items(spark, d):
    words = F.array_sort(lx.distinct_items(F.split("text", " ")))
    docs = wide_table(spark, d, "documents", "doc_id", "text")
    return docs.select("doc_id", F.array_join(words, "|").alias("words"))


# Literals in Python quoting: both quotes, an escaped quote, and an escape only Python reads.
_LITERAL = r"""CASE
  WHEN p_type = 'PROMO' THEN concat('[\'', p_name, '\', "', p_brand, '\'s"]')
  WHEN p_type = 'SMALL' THEN concat('[\'', p_name, '\\\'s\', \'', replace(p_brand, '#', '\\x23'), '\']')
  WHEN p_type = 'LARGE' THEN '[]'
  WHEN p_type = 'MEDIUM' THEN concat('[\'', p_name, '\'')
  ELSE concat('["', p_name, '", "', p_brand, '",]') END"""


@query("""
SELECT p_partkey, CASE
  WHEN p_type = 'PROMO' THEN p_name || '|' || p_brand || '''s'
  WHEN p_type = 'SMALL' THEN p_name || '''s|' || p_brand
  WHEN p_type = 'LARGE' THEN '' WHEN p_type = 'MEDIUM' THEN NULL
  ELSE p_name || '|' || p_brand END AS items
FROM part
""")
def py_list(spark, d):
    literal = table(spark, d, "part").select("p_partkey", F.expr(_LITERAL).alias("literal"))
    items = lx.parse_py_list(F.col("literal"))
    return literal.select("p_partkey", F.array_join(items, "|").alias("items"))


_K = "regexp_extract(props, '([0-9]+)', 1)"
_AMOUNT = f"""CASE event_type WHEN 'error' THEN concat({_K}, ' min') WHEN 'click' THEN {_K}
  WHEN 'view' THEN concat({_K}, '.5') WHEN 'signup' THEN concat(' ', {_K}, '.0 ') END"""


@query(f"""
SELECT event_id,
  CASE WHEN event_type IN ('click', 'view', 'signup') THEN {_K}::BIGINT ELSE 0 END AS whole,
  CASE event_type WHEN 'click' THEN {_K}::DOUBLE WHEN 'signup' THEN {_K}::DOUBLE
    WHEN 'view' THEN {_K}::DOUBLE + 0.5 ELSE 0.0 END AS number,
  event_type = 'view' AS fraction
FROM events
""")
def coerce_numeric(spark, d):
    amount = table(spark, d, "events").select("event_id", F.expr(_AMOUNT).alias("a"))
    a = F.col("a")
    return amount.select(
        "event_id",
        cx.to_int_or_zero(a).alias("whole"),
        cx.to_float_or_zero(a).alias("number"),
        cx.has_fraction(a).alias("fraction"),
    )
