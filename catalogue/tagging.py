"""Tagging by vocabulary."""

from pyspark.sql import functions as F

from catalogue.registry import query, table
from larder.operators import tags as gx

_TOKENS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"


@query(rf"""
WITH v AS (SELECT DISTINCT unnest({_TOKENS.format('text')}) AS w FROM benchmark),
t AS (SELECT conv_id * 1000 + turn AS id, {_TOKENS.format('text')} AS ws FROM conversations),
e AS (SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM t),
g AS (SELECT id, string_agg(w, '|' ORDER BY pos) AS tags FROM e SEMI JOIN v USING (w) GROUP BY id)
SELECT id, coalesce(tags, '') AS tags FROM t LEFT JOIN g USING (id)
""")
def tags(spark, d):
    words = F.explode(gx.tokens(F.col("text")))
    vocab = table(spark, d, "benchmark").select(words.alias("ingredients")).distinct()
    turns = table(spark, d, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.array("text").alias("lines")
    )
    tagged = gx.with_tags(turns, "id", "lines", vocab, name="tags")
    return tagged.select("id", F.array_join("tags", "|").alias("tags"))


# Phrases: every first word of a part name, and the whole name of the economy parts.
@query("""
WITH v AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS w FROM part),
n AS (SELECT DISTINCT p_name AS w FROM part WHERE p_type = 'ECONOMY')
SELECT p_partkey, CASE WHEN p_name IN (SELECT w FROM n) THEN p_name ELSE split_part(p_name, ' ', 1) END
  || CASE WHEN split_part(p_name, ' ', 2) IN (SELECT w FROM v) AND p_name NOT IN (SELECT w FROM n)
     THEN '|' || split_part(p_name, ' ', 2) ELSE '' END
  || CASE WHEN lower(p_type) IN (SELECT w FROM v) THEN '|' || lower(p_type) ELSE '' END AS tags
FROM part
""")
def phrase_tags(spark, d):
    parts = table(spark, d, "part")
    whole = parts.where("p_type = 'ECONOMY'").select(F.col("p_name").alias("ingredients"))
    vocab = parts.select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("ingredients"))
    lines = parts.select("p_partkey", F.array("p_name", "p_type", "p_brand").alias("lines"))
    tagged = gx.with_tags(lines, "p_partkey", "lines", vocab.union(whole), name="tags")
    return tagged.select("p_partkey", F.array_join("tags", "|").alias("tags"))


@query(r"""
WITH v AS (SELECT DISTINCT p_name AS phrase FROM part),
t AS (SELECT p_partkey, regexp_extract_all(lower(p_name || ' ' || p_name), '[\p{L}\p{N}]+') AS ws FROM part),
e AS (SELECT p_partkey, unnest(range(0, len(ws) - 1)) AS pos, ws FROM t),
g AS (SELECT p_partkey, pos, ws[pos + 1] || ' ' || ws[pos + 2] AS phrase FROM e)
SELECT p_partkey, pos::INTEGER AS pos, phrase FROM g SEMI JOIN v USING (phrase)
""")
def phrase_hits(spark, d):
    parts = table(spark, d, "part")
    lines = parts.select("p_partkey", F.array(F.concat_ws(" ", "p_name", "p_name")).alias("lines"))
    hits = gx.candidate_spans(lines, "p_partkey", "lines", parts, "p_name")
    return hits.select("p_partkey", "pos", "phrase")


# Phrases of one to six words, told apart by their first word: w1 to w6 of the vocabulary.
_LONG = [" ".join([f"n{n}"] + ["of"] * (n - 1)) for n in range(1, 7)]


@query("""
WITH t AS (SELECT event_id, user_id % 6 + 1 AS n, event_id % 6 AS rest FROM events)
SELECT event_id, CASE WHEN rest >= n - 1 THEN 'n' || n || repeat(' of', (n - 1)::INTEGER)
  ELSE 'none' END || '|salt' AS tags FROM t
""")
def long_phrase_tags(spark, d):
    """A phrase of n words is found where as many words stand, the longest the vocabulary has."""
    vocab = spark.range(1).select(F.explode(F.array(*map(F.lit, [*_LONG, "none", "salt"]))).alias("ingredients"))
    n, rest = F.col("user_id") % 6 + 1, (F.col("event_id") % 6).cast("int")
    text = F.concat(F.lit("n"), n, F.repeat(F.lit(" of"), rest))
    text = F.when(rest >= n - 1, text).otherwise("none of")
    lines = table(spark, d, "events").select("event_id", F.array(text, F.lit("some Salt")).alias("lines"))
    tagged = gx.with_tags(lines, "event_id", "lines", vocab, name="tags")
    return tagged.select("event_id", F.array_join("tags", "|").alias("tags"))
