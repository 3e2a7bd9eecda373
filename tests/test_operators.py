"""Vocabulary, records, failures, sets, tags on small frames, against brute force."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from larder.operators import failures as fx
from larder.operators import records as rx
from larder.operators import sets as sx
from larder.operators import tags as gx
from larder.operators import vocab as vx
from larder.schemas import SANITIZED, SANITIZED_KEYS
from larder.session import settle


def rows_of(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


# --- vocabulary ---


def brute_vocabulary(lists):
    first, count = {}, {}
    for i, words in enumerate(lists):
        for p, w in enumerate(words or [None]):
            key = None if w is None else re.sub(r"\s+", " ", w).lower()
            first.setdefault(key, (i, p))
            count[key] = count.get(key, 0) + (w is not None)
    ranked = sorted(first, key=first.get)
    return sorted(((ranked.index(k), k or "", n) for k, n in count.items()))


@pytest.mark.parametrize("shift", [0, 1 << 33])
def test_vocabulary_matches_brute_force(spark, shift):
    """Ids beyond the packed range take the other way and give the same result."""
    rng = random.Random(5)
    words = ["Salt", "salt", "olive  oil", "Olive oil", "", "egg", "flour"]
    lists = [[rng.choice(words) for _ in range(rng.randrange(4))] for _ in range(60)]
    data = [(shift + i, w) for i, w in enumerate(lists)]
    df = spark.createDataFrame(data, "id long, w array<string>").repartition(5)
    got = vx.unique_ingredients(df, "id", "w").collect()
    assert sorted((r[0], r[1] or "", r[2]) for r in got) == brute_vocabulary(lists)
    assert [r["count"] for r in got] == sorted((r["count"] for r in got), reverse=True)
    total = sum(len(w) for w in lists)
    assert sum(r["count"] for r in got) == total


def test_vocabulary_without_blanks(spark):
    df = spark.createDataFrame([(0, ["", "a", " "]), (1, [])], "id long, w array<string>")
    got = vx.unique_ingredients(df, "id", "w", drop_blank=True).collect()
    assert [tuple(r) for r in got] == [(0, "a", 1)]


def test_frequent_word_is_counted_where_it_lies(spark):
    df = spark.range(100).select("id", F.array(F.lit("salt"), F.lit("salt")).alias("w"))
    counts = vx.ingredient_counts(df, "id", "w", 99)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "SortAggregate" not in plan
    assert [(r["ingredients"], r["count"], r["first_id"]) for r in counts.collect()] == [("salt", 200, 0)]


# --- records ---


def reference_value(value, kind):
    """What a typed reader makes of a JSON value, as the fixed schema asks."""
    if value is None:
        return {"int": 0, "list": [], "text": ""}[kind]
    if kind == "int":
        if isinstance(value, (list, dict)):
            return 0
        try:
            return int(value)
        except ValueError:
            return 0
    if kind == "list":
        items = value if isinstance(value, list) else [value]
        return [None if v is None else v if isinstance(v, str) else str(v) for v in items]
    if isinstance(value, (list, dict)):
        return json.dumps(value, separators=(",", ":"))
    return value if isinstance(value, str) else str(value)


RECORDS = [
    {},
    {"title": "t", "total_time": 75.9, "cook_time": "12", "prep_time": "4.7", "ratings": True},
    {"title": None, "total_time": None, "category": None, "ingredients": ["a", "b"]},
    {"title": 12, "total_time": "45 min", "cook_time": " 7 ", "prep_time": "1_000", "ratings": False},
    {"title": True, "category": "a,b", "ingredients": [], "instructions": {"k": 1}, "extra": 1},
    {"title": ["x"], "total_time": [1], "cook_time": {"a": 1}, "category": [1, None, "z", True]},
    {"title": "true", "total_time": "true", "category": "[not a list", "cook_time": "[1"},
    {"title": "", "total_time": -3, "cook_time": "-4", "prep_time": -2.5, "ratings": 10**12},
]


def test_sanitize_every_shape(spark):
    data = [(i, json.dumps(r)) for i, r in enumerate(RECORDS)]
    df = rx.sanitize_json(spark.createDataFrame(data, "i long, body string"), "body", ["i"])
    assert df.select(*SANITIZED_KEYS).dtypes == [(f.name, f.dataType.simpleString()) for f in SANITIZED]
    for row in df.collect():
        record = RECORDS[row["i"]]
        for key, kind in SANITIZED_KEYS.items():
            want = reference_value(record.get(key), kind)
            if isinstance(record.get(key), dict) and kind == "list":
                want = ['{"k":1}']
            assert row[key] == want, (row["i"], key)
    assert [r["i"] for r in df.where("coerced").collect()] == [5]


def test_sanitize_is_idempotent(spark):
    data = [(i, json.dumps(r)) for i, r in enumerate(RECORDS)]
    once = rx.sanitize_json(spark.createDataFrame(data, "i long, body string"), "body", ["i"])
    again = rx.sanitize_json(
        once.select("i", F.to_json(F.struct(*SANITIZED_KEYS)).alias("body")), "body", ["i"]
    )
    columns = ["i", *SANITIZED_KEYS]
    assert once.select(columns).exceptAll(again.select(columns)).count() == 0


def test_unreadable_record_is_empty(spark):
    df = rx.sanitize_json(spark.createDataFrame([("{bad",), (None,)], "body string"), "body")
    assert {(r["title"], r["total_time"], len(r["category"])) for r in df.collect()} == {("", 0, 0)}


def test_overlay(spark):
    base = spark.createDataFrame([(1, "u1", "a"), (2, "u2", "b"), (3, "u1", "c")], "id long, url string, title string")
    extra = spark.createDataFrame([("u1", "T", 5)], "url string, title string, time long")
    got = rows_of(rx.overlay(base, extra, "url"), "id", "title", "time")
    assert got[0] == (1, "T", 5) and got[2] == (3, "T", 5)
    assert got[1] == (2, "b", None)


@pytest.fixture
def tiny_partitions(spark):
    """Sizes at which a small frame counts as skewed, and no broadcast by estimate."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def skewed(spark):
    """A third of the rows under one key."""
    return spark.range(0, 30000, 1, 8).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('u', id) END").alias("url"),
        F.sha2(F.col("id").cast("string"), 256).alias("body"),
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_of_an_overlay_is_split(spark, tiny_partitions):
    base = skewed(spark)
    extra = settle(base.select("url").distinct().withColumn("n", F.lit(1)))
    merged = rx.overlay(base, extra, "url")
    assert merged.count() == 30000
    assert "skew=true" in final_plan(merged)


def test_hot_key_of_an_anti_join_is_split(spark, tiny_partitions, monkeypatch):
    monkeypatch.setattr(sx, "broadcast_if_small", lambda df: df)
    base = skewed(spark)
    left = sx.not_yet(base, base.where("url <> 'hot'"), "url")
    assert left.count() == 10000
    assert "skew=true" in final_plan(left)


def test_hot_word_of_a_tagged_text_is_split(spark, tiny_partitions, monkeypatch):
    monkeypatch.setattr(gx, "broadcast_if_small", lambda df, limit: df)
    lines = skewed(spark).select(F.xxhash64("body").alias("id"), F.array("url").alias("l"))
    vocab = skewed(spark).select("url")
    hits = gx.candidate_spans(lines, "id", "l", vocab, "url")
    assert hits.count() == 30000
    assert "skew=true" in final_plan(hits)


def test_fill_text(spark):
    df = spark.createDataFrame([(None, None, None)], "a string, b array<string>, c long")
    assert tuple(rx.fill_text(df).first()) == ("", [], None)


# --- failures ---


def test_failures(spark):
    items = spark.createDataFrame([("u1", None), ("u2", "x")], "uid string, url string")
    rows = fx.failure_rows(items, ["uid", "url"], F.when(F.col("uid") == "u2", 404), F.lit(9)).collect()
    assert [tuple(r) for r in rows] == [("u1", "", -1, 9), ("u2", "x", 404, 9)]
    log = spark.createDataFrame(
        [("u1", "a", -1, 5), ("u1", "a", 404, 7), ("u2", "b", 500, 1)],
        "uid string, url string, status_code long, timestamp long",
    )
    latest = rows_of(fx.latest_failures(log), "uid", "timestamp", "status_code", "attempts")
    assert latest == [("u1", 7, 404, 2), ("u2", 1, 500, 1)]
    assert rows_of(fx.redrivable(log, 2), "uid") == [("u2",)]
    assert fx.with_status(log).count() == 2


# --- sets ---


def test_set_operations(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "www.cookbooks.com")], "k long, source string")
    b = spark.createDataFrame([(2,), (2,), (9,)], "k long")
    assert rows_of(sx.not_yet(a, b, "k"), "k") == [(1,), (3,)]
    assert rows_of(sx.already(a, b, "k"), "k") == [(2,)]
    assert rows_of(sx.exclude_sources(a, ["www.cookbooks.com"]), "k") == [(1,), (2,)]
    assert sx.union_all([a, b]).columns == ["k", "source"]
    assert sx.union_distinct([b, b]).count() == 2
    urls = spark.createDataFrame(
        [("https://WWW.epicurious.com/recipes/MEMBER/1",), ("https://wwwXepicurious.com/recipes/member",), (None,), ("https://ok.com",)],
        "url string",
    )
    kept = sx.exclude_urls(urls, ["www.epicurious.com/recipes/member", "recipes-plus"])
    assert {r["url"] for r in kept.collect()} == {None, "https://ok.com"}
    assert {(r["source"], r["count"]) for r in sx.value_counts(a, "source").collect()} == {("x", 1), ("www.cookbooks.com", 1)}


# --- tags ---


def brute_tags(lines, vocab, max_words):
    out = []
    for line in lines:
        words = re.findall(r"[^\W_]+", line.lower())
        i = 0
        while i < len(words):
            for n in range(min(max_words, len(words) - i), 0, -1):
                phrase = " ".join(words[i : i + n])
                if phrase in vocab:
                    out.append(phrase)
                    i += n
                    break
            else:
                i += 1
    return out


@pytest.mark.parametrize("broadcast", [True, False])
def test_longest_matches_equal_brute_force(spark, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(gx, "broadcast_if_small", lambda df, limit: df)
    rng = random.Random(11)
    alphabet = "a b c d".split()
    vocab = {" ".join(rng.choice(alphabet) for _ in range(rng.randint(1, 3))) for _ in range(12)}
    rows = [
        (i, [" ".join(rng.choice(alphabet) for _ in range(rng.randrange(9))) for _ in range(rng.randrange(4))])
        for i in range(120)
    ]
    df = spark.createDataFrame(rows, "id long, lines array<string>").repartition(4)
    words = spark.createDataFrame([(v,) for v in vocab], "ingredients string")
    got = {r["id"]: r["ingredient_tags"] for r in gx.with_tags(df, "id", "lines", words).collect()}
    assert got == {i: brute_tags(lines, vocab, 3) for i, lines in rows}


def test_recipe_lines(spark):
    vocab = spark.createDataFrame([("Olive Oil",), ("oil",), ("salt",)], "ingredients string")
    rows = [(0, ["1 tbsp olive oil, extra", "Salt; more SALT"]), (1, []), (2, None), (3, ["olive"])]
    df = spark.createDataFrame(rows, "id long, lines array<string>")
    got = {r["id"]: r["ingredient_tags"] for r in gx.with_tags(df, "id", "lines", vocab).collect()}
    assert got == {0: ["olive oil", "salt", "salt"], 1: [], 2: [], 3: []}


def test_phrases_of_any_length_in_a_long_text(spark):
    vocab = spark.createDataFrame([("extra virgin olive oil",), ("oil oil",), ("oil",)], "ingredients string")
    rows = [(0, ["2 cups extra virgin olive oil"]), (1, ["oil " * 100_001])]
    df = spark.createDataFrame(rows, "id long, lines array<string>")
    got = {r["id"]: r["ingredient_tags"] for r in gx.with_tags(df, "id", "lines", vocab).collect()}
    assert got == {0: ["extra virgin olive oil"], 1: ["oil oil"] * 50_000 + ["oil"]}


def test_model_is_loaded_in_the_worker(spark):
    def load():
        return lambda texts: [[w for w in t.split() if w.isupper()] for t in texts]

    df = spark.createDataFrame([(["1 EGG", "2 cups FLOUR"],), ([],)], "lines array<string>")
    got = df.select(gx.model_tagger(load)(F.col("lines")).alias("t")).collect()
    assert [r["t"] for r in got] == [["egg", "flour"], []]


def test_measured_bytes(spark):
    from larder.operators.sizes import broadcast_if_small, measured_bytes

    rows = [("é" * 1000, bytes(5000), ["ab", None], [1, 2], 3)]
    kinds = "t string, b binary, a array<string>, n array<long>, i int"
    df = spark.createDataFrame(rows, kinds)
    assert measured_bytes(df) == 32 + 2000 + 5000 + 18 + 16
    assert measured_bytes(df.limit(0)) == 0
    unknown = spark.createDataFrame([({"k": "v"},)], "m map<string,string>")
    assert measured_bytes(unknown) is None and broadcast_if_small(unknown) is unknown
