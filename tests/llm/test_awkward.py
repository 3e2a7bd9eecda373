"""Every operator and stage on awkward tables: nulls, empty and long texts, ties, clashing names."""

import pytest

import corpus_pipeline
from larder.llm import byte_cnn, forced_bpe
from larder.llm.ball_tree import top_k
from larder.llm.bloom_cascade import judge_urls, rules_frame
from larder.llm.content_sort import content_sort, first_of_equals
from larder.llm.line_winnow import winnow_lines
from larder.llm.packing import retrieval_pack
from larder.llm.prob_minhash import first_of_class, near_duplicates
from larder.llm.range_coder import written_and_read
from larder.llm.separator_scan import count_tokens

LONG = "one two three four five six seven eight nine ten " * 4000
ENGLISH = "the cat and the dog went to the house with the old man and sat there"
ROWS = [
    (1, "a b\nc", "en", "s", "x"),
    (2, "a b c", None, None, None),
    (3, None, None, None, None),
    (4, "", "en", "s", "x"),
    (None, "a  b c", "en", "s", None),
    (5, LONG, "en", "s", "x"),
    (6, LONG + "eleven", "en", "s", "x"),
    (7, "!!! ...", "en", "s", "x"),
    (8, ENGLISH, "en", "s", "x"),
    (8, ENGLISH, "en", "s", "x"),
    (9, "z" * 20000, "de", "s", "x"),
    (10, "ein haus und der alte mann mit dem hund", "de", "s", "x"),
    (None, None, None, None, None),
]
NAMES = "doc_id long, text string, lang string, {0} string, {1} string"
OPERATORS = {
    "winnow_lines": (winnow_lines, ("n_lines", "starts")),
    "count_tokens": (count_tokens, ("file", "doc_no")),
    "predict": (lambda d: byte_cnn.predict(d, byte_cnn.train(d)), ("lang_pred", "score")),
    "round_trip": (forced_bpe.round_trip, ("n_tokens", "ids")),
    "near_duplicates": (near_duplicates, ("node", "class_id")),
    "written_and_read": (written_and_read, ("file", "blocks")),
    "content_sort": (content_sort, ("keep_id", "_t")),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_operators_give_a_row_for_every_document(spark, name):
    operator, clashing = OPERATORS[name]
    docs = spark.createDataFrame(ROWS, NAMES.format(*clashing))
    out = operator(docs)
    ids = sorted((r["doc_id"] is None, r["doc_id"]) for r in out.select("doc_id").collect())
    assert ids == sorted((r[0] is None, r[0]) for r in ROWS)
    assert operator(docs.limit(0)).count() == 0


def test_packing_keeps_every_document(spark):
    docs = spark.createDataFrame(ROWS, NAMES.format("start", "offset"))
    pieces = retrieval_pack(docs).collect()
    assert {r["doc_id"] for r in pieces} == {r[0] for r in ROWS}
    assert sum(r["start"] == 0 for r in pieces) == len(ROWS)


@pytest.mark.parametrize("stage", range(4))
def test_stages(spark, stage):
    docs = spark.createDataFrame(ROWS, NAMES.format("_id", "node"))
    name, run = corpus_pipeline.STAGES[stage]
    out = run(spark, docs, "")
    if stage < 3:
        assert out.columns == docs.columns and out.schema == docs.schema
        assert set(out.collect()) <= set(docs.collect())
    assert run(spark, docs.limit(0), "").count() == 0


def test_language_stage_without_labels_keeps_texts_with_letters(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(ROWS, NAMES.format("_lang", "_score")).withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.language_id(spark, docs, "")
    assert kept.schema == docs.schema and kept.count() == sum(any(c.isalpha() for c in r[1] or "") for r in ROWS)


def test_exact_copies_with_nulls_and_repeated_rows(spark):
    docs = spark.createDataFrame(ROWS, NAMES.format("keep_id", "c0"))
    rows = content_sort(docs).collect()
    found = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in rows]
    assert {f for f in found if f[0] in (1, 2)} == {(1, 1, 3, True), (2, 1, 3, False)}
    assert sorted(f for f in found if f[0] == 8) == [(8, 8, 2, False), (8, 8, 2, True)]
    assert {f for f in found if f[0] in (3, 4)} == {(3, 3, 3, True), (4, 3, 3, False)}
    assert sum(f[3] for f in found) == len(first_of_equals(docs).collect()) == 8


def test_only_null_ids(spark):
    docs = spark.createDataFrame([(None, "q r"), (None, "q  r")], "doc_id long, text string")
    assert [r["keep_id"] for r in content_sort(docs).collect()] == [None, None]
    assert first_of_equals(docs).count() == 1
    assert {r["class_id"] for r in near_duplicates(docs).collect()} == {None}


def test_near_copies_of_a_long_text(spark):
    docs = spark.createDataFrame(ROWS, NAMES.format("bands", "label"))
    classes = {r["doc_id"]: (r["class_id"], r["kept"]) for r in near_duplicates(docs).collect()}
    assert classes[6] == (5, False) and classes[9] == (9, True)
    # Short texts of the same words are one shingle; empty ones are like equal texts only.
    assert classes[2] == (1, False) and classes[4][0] == 3 and classes[7] == (7, True)
    assert sum(r["doc_id"] == 6 for r in first_of_class(docs).collect()) == 0


VECTORS = [
    (0, [1.0, 0.0]),
    (100, [0.0, 1.0]),
    (100, [0.5, 0.5]),
    (1, [0.5, 0.0]),
    (2, [0.5, 0.0]),
    (3, None),
    (4, [None, 1.0]),
    (5, [float("nan"), 1.0]),
    (6, [float("inf"), 1.0]),
    (7, []),
    (8, [1.0, 2.0, 3.0]),
    (None, [9.0, 9.0]),
]


def test_search_skips_unusable_vectors(spark):
    from pyspark.sql import functions as F

    rows = [(i, v, i) for i, v in VECTORS]
    kinds = "vec_id long, embedding array<double>, shard long"
    vectors = spark.createDataFrame(rows, kinds)
    found = top_k(vectors, F.col("vec_id") % 100 == 0, 3).collect()
    by = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in found}
    assert by[0, 1] == (1, 512 * 1024) and by[0, 2] == (2, 512 * 1024)
    assert by[0, 3] == (100, 512 * 1024) and len(by) == 6
    assert top_k(vectors.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y://z", "a://b.NET/fr/",
            "x://example.com/EN/", "http://com", "http://com/", "http://u@example.com:80/en/"]
    rows = [(i, u, "h") for i, u in enumerate(urls)] + [(None, "s://q.com/a#b", "h")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    rules = [("block", "example.com", "/en/"), ("allow", "com", "/"), ("block", "net", "/fr/"),
             ("allow", "www.example.com", "/en/"), ("block", "www.example.com", "/en/"),
             ("block", None, "/"), ("allow", "empty.org", None)]
    out = judge_urls(pages, rules_frame(spark, rules)).collect()
    by = {r["page_id"]: r for r in out}
    assert len(out) == len(urls) + 1
    assert [by[i]["host"] for i in range(4)] == ["", "", "", ""]
    assert tuple(by[4])[1:] == ("www.example.com", "/en/x", "www.example.com/en/", "block")
    assert tuple(by[5])[1:] == ("b.net", "/fr/", "net/fr/", "block")
    assert tuple(by[6])[1:] == ("example.com", "/EN/", "com/", "allow")
    assert by[7]["rule"] is None and by[8]["rule"] == "com/" and by[9]["rule"] is None
    assert by[None]["path"] == "/a" and by[None]["rule"] == "com/"
    assert judge_urls(pages.limit(0), rules_frame(spark, rules)).count() == 0
    assert {r["verdict"] for r in judge_urls(pages, rules_frame(spark, rules).limit(0)).collect()}
