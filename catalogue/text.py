"""Text and URL columns over documents, pages and parts."""

from pyspark.sql import functions as F

from catalogue.registry import query, table, wide_table
from larder.functions import text as tx
from larder.functions import urls as ux
from larder.operators.index import with_index
from larder.operators.sets import exclude_sources, exclude_urls, value_counts

# Whitespace as a class of code points, for a dialect whose \s is ASCII only.
WS = r"[\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


@query("SELECT doc_id, trim(regexp_replace(text, '[^A-Za-z ]', '', 'g'), ' ') AS words FROM documents")
def alpha_only(spark, d):
    return wide_table(spark, d, "documents", "doc_id", "text").select("doc_id", tx.alpha_only(F.col("text")).alias("words"))


@query(r"SELECT doc_id, regexp_replace(text, '[\x00-\x19]', '', 'g') AS text FROM documents")
def strip_control(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", tx.strip_control(F.col("text")).alias("text"))


@query(rf"SELECT doc_id, lower(regexp_replace(text, '{WS}+', ' ', 'g')) AS text FROM documents")
def collapse_ws(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", tx.collapse_ws(F.col("text")).alias("text"))


_BLANKED = "CASE WHEN o_orderpriority = '5-LOW' THEN '' WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority END"


@query(f"""
SELECT o_orderkey, coalesce(nullif({_BLANKED}, ''), 'missing') AS priority FROM orders
""")
def missing_blank(spark, d):
    orders = table(spark, d, "orders")
    return orders.select("o_orderkey", tx.missing_if_blank(F.expr(_BLANKED)).alias("priority"))


@query(r"""
SELECT p_partkey,
  regexp_replace(lower(p_name), '[^\p{L}\p{N}_]', '', 'g') || '_'
    || (row_number() OVER (ORDER BY p_partkey) - 1) AS uid
FROM part
""")
def uid(spark, d):
    parts = with_index(table(spark, d, "part").select("p_partkey", "p_name"), "p_partkey", "n")
    return parts.select("p_partkey", tx.make_uid(F.col("p_name"), F.col("n")).alias("uid"))


@query(f"""
WITH cleaned AS (
  SELECT doc_id, list_transform(string_split(text, chr(10)),
    lambda x: regexp_replace(x, '[^A-Za-z0-9 ]+', '', 'g')) AS parts FROM documents)
SELECT doc_id, array_to_string(list_transform(
  list_filter(parts, lambda x: regexp_matches(x, '[^ ]')), lambda x: lower(x)), '|') AS lines
FROM cleaned
""")
def clean_text(spark, d):
    lines = F.split("text", "\n")
    docs = wide_table(spark, d, "documents", "doc_id", "text")
    return docs.select("doc_id", F.array_join(tx.clean_text(lines), "|").alias("lines"))


@query(f"""
SELECT doc_id, array_to_string(list_filter(
  regexp_split_to_array(array_to_string(string_split(text, chr(10)), ' '), '{WS}+'),
  lambda x: x <> ''), '|') AS words
FROM documents
""")
def split_text(spark, d):
    docs = wide_table(spark, d, "documents", "doc_id", "text")
    words = tx.split_text(F.split("text", "\n"))
    return docs.select("doc_id", F.array_join(words, "|").alias("words"))


@query(f"""
SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)),
  lambda x: regexp_replace(x, '{WS}+', '', 'g') <> ''), '|') AS lines
FROM documents
""")
def non_blank_items(spark, d):
    docs = table(spark, d, "documents")
    kept = tx.non_blank_items(F.split("text", "\n"))
    return docs.select("doc_id", F.array_join(kept, "|").alias("lines"))


@query(r"""
SELECT page_id, page_id || '_' || regexp_replace(url, '[^a-zA-Z0-9_]', '_', 'g') || '.json' AS name
FROM pages
""")
def json_filename(spark, d):
    pages = table(spark, d, "pages")
    return pages.select("page_id", tx.json_filename(F.col("page_id"), F.col("url")).alias("name"))


@query("SELECT doc_id, substring(text, 1, 1019) || '.json' AS name FROM documents")
def truncate_filename(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", tx.truncate_filename(F.col("text")).alias("name"))


# Addresses as they arrive: without a scheme, with either scheme, with user and port, bare host.
LINK = (
    "CASE WHEN url LIKE '%/en/%' THEN substring(url, strpos(url, '://') + 3) "
    "WHEN url LIKE '%/fr/%' THEN replace(replace(url, '://', '://Me:pw@'), '.example', '.Example') "
    "WHEN url LIKE '%/es/%' THEN regexp_replace(url, '(example.[a-z]+)', '{group1}:8080') "
    "ELSE regexp_extract(url, '^([a-z]+://[^/]+)', 1) END"
)
SPARK_LINK = LINK.replace("strpos(", "instr(").replace("{group1}", "$1")
DUCK_LINK = LINK.replace("{group1}", r"\1")
HTTPS = (
    "CASE WHEN link LIKE 'https://%' THEN link WHEN link LIKE 'http://%' "
    "THEN 'https://' || substring(link, 8) ELSE 'https://' || link END"
)
HOST = ux.HOST_PATTERN.replace("'", "''")


def _links(spark, d):
    return table(spark, d, "pages").select("page_id", F.expr(SPARK_LINK).alias("link"))


@query(f"""
WITH l AS (SELECT page_id, {DUCK_LINK} AS link FROM pages)
SELECT page_id, {HTTPS} AS fixed, CASE WHEN link LIKE 'https://%' THEN link ELSE 'https://' || link END AS legacy FROM l
""")
def ensure_https(spark, d):
    link = F.col("link")
    return _links(spark, d).select(
        "page_id",
        ux.ensure_https(link).alias("fixed"),
        ux.ensure_https(link, legacy=True).alias("legacy"),
    )


_DIRNAME = "coalesce(nullif(regexp_replace(regexp_extract(link, '(?s)^(.*)/', 1), '/+$', ''), ''), 'NA')"


@query(f"WITH l AS (SELECT page_id, {DUCK_LINK} AS link FROM pages) SELECT page_id, {_DIRNAME} AS dirname FROM l")
def url_dirname(spark, d):
    return _links(spark, d).select("page_id", ux.url_dirname(F.col("link")).alias("dirname"))


@query(f"""
WITH l AS (SELECT page_id, {DUCK_LINK} AS link FROM pages)
SELECT page_id, nullif(lower(regexp_extract(link, '{HOST}', 1)), '') AS host FROM l
""")
def url_host(spark, d):
    return _links(spark, d).select("page_id", ux.url_host(F.col("link")).alias("host"))


_BASE = ", ".join(
    f"nullif(regexp_extract(url, '(www\\..*?{ending.replace('.', chr(92) + '.')})', 1), '')"
    for ending in ux.BASE_URL_ENDINGS
)


@query(f"SELECT page_id, coalesce({_BASE}, 'NA') AS base_url FROM pages")
def base_url(spark, d):
    pages = table(spark, d, "pages")
    return pages.select("page_id", ux.extract_base_url(F.col("url")).alias("base_url"))


@query(f"""
SELECT page_id, CASE WHEN regexp_extract(url, '({ux.SITE_PATTERN})', 1) = '' THEN 'NA'
  WHEN starts_with(regexp_extract(url, '({ux.SITE_PATTERN})', 1), 'https://')
  THEN regexp_extract(url, '{ux.SITE_PATTERN}', 1) END AS site
FROM pages
""")
def site_source(spark, d):
    pages = table(spark, d, "pages")
    return pages.select("page_id", ux.extract_site_source(F.col("url")).alias("site"))


@query(f"""
SELECT page_id, CASE WHEN url LIKE 'https:%'
  THEN nullif(lower(regexp_extract(regexp_extract(url, '(?s)^(.*)/', 1), '{HOST}', 1)), '')
  ELSE 'crawl' END AS source
FROM pages
""")
def gathered_source(spark, d):
    source = F.expr("CASE WHEN url LIKE 'https:%' THEN 'Gathered' ELSE 'crawl' END")
    pages = table(spark, d, "pages")
    return pages.select(
        "page_id", ux.gathered_source(source, ux.url_dirname(F.col("url"))).alias("source")
    )


@query("""
WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS href FROM pages)
SELECT page_id, 'https://www.food.com' || href AS url, count(*) AS n FROM h GROUP BY ALL
""")
def prefix_site(spark, d):
    from larder.operators.pages import extract_links

    links = extract_links(table(spark, d, "pages"), ["page_id"])
    url = ux.prefix_site(F.col("href"), "https://www.food.com/")
    return links.groupBy("page_id", url.alias("url")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, source FROM documents WHERE source IS DISTINCT FROM 'src3' AND source IS DISTINCT FROM 'src7'")
def drop_sources(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    return exclude_sources(docs, ["src3", "src7"])


@query("""
SELECT page_id, url FROM pages
WHERE NOT regexp_matches(url, 'SPAM.farm', 'i') AND NOT regexp_matches(url, 'cheap-pills', 'i')
""")
def drop_urls(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url")
    return exclude_urls(pages, ["SPAM.farm", "cheap-pills"])


@query("SELECT source, count(*) AS count FROM documents WHERE source IS NOT NULL GROUP BY source")
def source_counts(spark, d):
    return value_counts(table(spark, d, "documents"), "source")
