"""The vocabulary over the words of all documents, and over page link lists."""

from pyspark.sql import functions as F

from catalogue.registry import query, table, wide_table
from larder.functions.text import alpha_only
from larder.operators import vocab as vx
from larder.operators.pages import hrefs

_WORDS = """
WITH w AS (SELECT doc_id,
  string_split(trim(regexp_replace(text, '[^A-Za-z ]', '', 'g'), ' '), ' ') AS ws FROM documents),
e AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM w),
v AS (SELECT lower(word) AS ingredients, count(word) AS count,
  min(doc_id * 2147483648 + pos) AS f FROM e GROUP BY lower(word))
"""


def word_lists(spark, d):
    words = F.split(alpha_only(F.col("text")), " ")
    docs = wide_table(spark, d, "documents", "doc_id", "text")
    return docs.select("doc_id", words.alias("words"))


@query(f"""
{_WORDS} SELECT ingredients, count, f // 2147483648 AS first_id, f % 2147483648 AS first_pos FROM v
""")
def vocab(spark, d):
    docs = word_lists(spark, d)
    return vx.ingredient_counts(docs, "doc_id", "words", vx.largest_id(docs, "doc_id"))


@query(f"{_WORDS} SELECT ingredients, count, f // 2147483648 AS first_id, f % 2147483648 AS first_pos FROM v")
def vocab_wide_ids(spark, d):
    return vx.ingredient_counts(word_lists(spark, d), "doc_id", "words")


@query(f"""
{_WORDS} SELECT row_number() OVER (ORDER BY f) - 1 AS ingredients_id, ingredients, count
FROM v ORDER BY count DESC, ingredients_id
""")
def vocab_ids(spark, d):
    return vx.unique_ingredients(word_lists(spark, d), "doc_id", "words")


@query(f"{_WORDS} SELECT ingredients, count FROM v")
def vocab_join(spark, d):
    return vx.frequency_join(word_lists(spark, d), "words")


@query("""
WITH h AS (SELECT page_id, list_filter(regexp_extract_all(html, '<a href="([^"]*)">', 1),
  lambda x: x LIKE '%.' OR x LIKE '%,') AS hs FROM pages),
e AS (SELECT page_id, unnest(hs) AS w, generate_subscripts(hs, 1) - 1 AS pos FROM h WHERE len(hs) > 0
  UNION ALL SELECT page_id, NULL, 0 FROM h WHERE len(hs) = 0),
v AS (SELECT lower(w) AS ingredients, count(w) AS count, min(page_id * 2147483648 + pos) AS f
  FROM e GROUP BY lower(w))
SELECT row_number() OVER (ORDER BY f) - 1 AS ingredients_id, ingredients, count FROM v
""")
def vocab_empty_lists(spark, d):
    listed = F.filter(hrefs(F.col("html")), lambda h: h.endswith(".") | h.endswith(","))
    pages = table(spark, d, "pages").select("page_id", listed.alias("links"))
    return vx.unique_ingredients(pages, "page_id", "links")
