"""Operators that SQL cannot express, against brute force, round trips and held-out accuracy."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from larder.llm import byte_cnn, prob_minhash, queries, range_coder
from larder.llm.bloom_cascade import Cascade
from larder.llm.line_winnow import winnow_lines
from larder.llm.separator_scan import read_flat, scan_separators
from larder.llm.tokens import tokenizer_path, word_encoder
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


ALONE = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"
WORD = rf"{ALONE}|(?:(?!{ALONE})[\p{{L}}\p{{M}}\p{{N}}])+"


def bag(text):
    words = regex.findall(WORD, text.lower())
    spans = range(max(1, len(words) - 4)) if words else ()
    return Counter(tuple(words[i : i + 5]) for i in spans)


def probability_jaccard(x, y):
    """By the definition, over all pairs of shingles."""
    every = sorted(x.keys() | y.keys())
    p, q = (np.array([c.get(k, 0) for k in every], float) for c in (x, y))
    both = (p > 0) & (q > 0)
    larger = np.maximum(p / p[both, None], q / q[both, None])
    return float((1 / larger.sum(axis=1)).sum())


def brute_classes(texts):
    """Smallest id of each document's class, by comparing all pairs of texts.

    Their similarity is at most the share of a text's shingles that the other has too.
    """
    ids, bags = sorted(texts), {i: bag(t) for i, t in texts.items()}
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = bags[a], bags[b]
            shared = sum(x[k] for k in x.keys() & y.keys()) / max(sum(x.values()), 1)
            if texts[a] == texts[b] or (shared >= 0.8 and probability_jaccard(x, y) >= 0.8):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: root(i) for i in ids}


def test_near_duplicate_classes_of_all_documents(spark, texts):
    rows = queries.QUERIES["op5_probminhash_near_dedup"](spark, SMALL).collect()
    assert {r["doc_id"]: r["class_id"] for r in rows} == brute_classes(texts)
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in rows)


def test_similarity_is_exact():
    rng = np.random.default_rng(0)
    for _ in range(50):
        x, y = (Counter(rng.integers(0, 12, 15).tolist()) for _ in range(2))
        sets = [(np.array(sorted(c), np.uint64), np.array([c[k] for k in sorted(c)])) for c in (x, y)]
        assert abs(prob_minhash.similarity(*sets) - probability_jaccard(x, y)) < 1e-9


@pytest.mark.parametrize("block", [512, 3])
def test_a_hot_bucket_is_compared_block_by_block(spark, block):
    """Variants of one text: some near its centre, some near each other only, some near none."""
    draw = np.random.default_rng(4)
    centre = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        text = list(centre)
        for at in draw.choice(120, draw.integers(0, 9), replace=False):
            text[at] = f"v{draw.integers(0, 3)}"
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = prob_minhash.near_duplicates(docs, block=block).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == brute_classes(dict(rows))
    assert len({r["class_id"] for r in found}) > 3


def test_words_of_scripts_without_spaces_and_odd_separators(spark):
    chinese = "".join(chr(0x4E00 + 37 * i % 2000) for i in range(200))
    words = [f"wort{i}" for i in range(80)]
    rows = [
        (1, chinese), (2, chinese[:100] + "\u6587" + chinese[101:]), (3, chinese[::-1]),
        (4, "\u00a0".join(words)), (5, "\u3000".join(words[:40]) + " \u201c" + " ".join(words[40:]) + "\u201d"),
        (6, " ".join(words).upper()), (7, "\u2014".join(words[:79]) + " ende"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in prob_minhash.near_duplicates(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 4, 7: 4} == brute_classes(dict(rows))


def test_signatures_estimate_the_similarity():
    words = [f"w{i}" for i in range(300)]
    a, b = " ".join(words), " ".join(words[:250] + [f"v{i}" for i in range(50)])
    found, some = prob_minhash.signatures([a.encode(), b.encode(), b""], 2048)
    estimate = (found[0] == found[1]).mean()
    assert abs(estimate - probability_jaccard(bag(a), bag(b))) < 0.05
    assert some.tolist() == [True, True, False]


def test_a_large_group_of_near_copies_is_one_class(spark):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(120):
        words = list(base)
        for at in rng.integers(0, 120, 2):
            words[at] = f"x{i}y{at}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = {r["doc_id"]: r["class_id"] for r in prob_minhash.near_duplicates(docs).collect()}
    assert classes == brute_classes(dict(rows))


def test_languages_of_held_out_documents(spark):
    sf = SMALL.replace("0.001", "0.01")
    rows = queries.QUERIES["op3_byte_cnn_language"](spark, sf)
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    both = rows.join(truth, "doc_id").collect()
    assert len(both) == truth.count() and {0, 1} >= {r["score"] // 1.000001 for r in both}
    held = [r for r in both if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in both)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert len(byte_cnn.train(spark.read.parquet(f"{sf}/documents.parquet")).languages) == 4


def test_tokens_counted_in_flat_files(spark, texts):
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    rows = queries.QUERIES["op2_separator_scan"](spark, SMALL).collect()
    want = {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == want and len(rows) == len(want)
    by_file = {}
    for r in sorted(rows, key=lambda r: (r["file"], r["doc_no"])):
        assert by_file.get(r["file"], 0) == r["start"]
        by_file[r["file"]] = r["start"] + r["n_tokens"] + 1


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_boundaries_are_stitched_across_blocks(spark, tmp_path, size):
    rng = np.random.default_rng(size)
    want = []
    for file in range(3):
        ids = rng.integers(0, 5, 60).astype("<u2")
        ids[20:40] = 1  # a document over many blocks
        if file == 1:
            ids[-1] = 0
        (tmp_path / f"f{file}.bin").write_bytes(ids.tobytes())
        begun = 0
        for at in [*np.flatnonzero(ids == 0), len(ids)]:
            if at < len(ids) or begun < at:
                want.append((begun, int(at) - begun, at < len(ids)))
            begun = int(at) + 1
    blocks = read_flat(spark, str(tmp_path), 2, size)
    rows = scan_separators(blocks, end=0).collect()
    assert sorted((r["start"], r["n_tokens"], r["closed"]) for r in rows) == sorted(want)
    for file in {r["file"] for r in rows}:
        own = sorted((r["doc_no"], r["start"]) for r in rows if r["file"] == file)
        assert [n for n, _ in own] == list(range(len(own))) and own == sorted(own)


def test_lines_of_a_run_within_one_document(spark):
    text = "a\nb\nc\n\n a \nb\nc\nd"
    docs = spark.createDataFrame([(1, text), (2, "x\nb\nc\nd"), (3, "a\nb")], "doc_id long, text string")
    out = {r["doc_id"]: (r["text"], r["n_deleted"]) for r in winnow_lines(docs, 3).collect()}
    assert out == {1: ("a\nb\nc\n\nd", 3), 2: ("x", 3), 3: ("a\nb", 0)}


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    cases = [[], [5], [7, 7], rng.integers(0, 65536, 5000), np.zeros(9000), rng.zipf(1.3, 9000) % 50257]
    cases += [np.arange(65536), np.full(4097, 65535), np.tile(rng.integers(0, 50257, 40), 200)]
    for case in cases:
        ids = np.array(case).astype(np.uint16)
        start, blocks = range_coder.encode_blocks(ids)
        assert np.array_equal(range_coder.decode_blocks(start, blocks), ids)
        for one in {0, len(blocks) - 1} if blocks else ():  # blocks alone, too
            part = range_coder.decode_blocks(start, blocks[one : one + 1])
            assert np.array_equal(part, ids[one * range_coder.BLOCK :][: len(part)])
    assert len(start) + sum(map(len, blocks)) < 0.1 * 2 * len(ids)
    for broken, rest in ((blocks[0], lambda b: (start, [b])), (start, lambda b: (b, blocks))):
        for at in (0, 5, len(broken) - 1):
            changed = bytearray(broken)
            changed[at] ^= 1
            with pytest.raises(ValueError):
                range_coder.decode_blocks(*rest(bytes(changed)))
        with pytest.raises(ValueError):
            range_coder.decode_blocks(*rest(broken[:10]))


def test_documents_take_fewer_bytes_than_zlib(texts):
    encoder = word_encoder("byte_bpe_50k.json")
    in_order = encoder.encode(text for _, text in sorted(texts.items()))
    ids = np.frombuffer(b"".join(x + b"\0\0" for x in in_order), encoder.dtype)
    start, blocks = range_coder.encode_blocks(ids)
    assert len(start) + sum(map(len, blocks)) < 0.92 * len(zlib.compress(ids.tobytes(), 9))


def test_files_of_many_segments(spark, texts, tmp_path):
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    some = sorted(texts.items())[:30]
    rows = [*some, (-1, None), (None, "no id"), (3, "again"), (3, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    range_coder.write_ids(docs, str(tmp_path / "ids"), segment_ids=3000)
    held = spark.read.parquet(str(tmp_path / "ids"))
    assert held.count() > 5 and held.select(F.size("blocks")).distinct().count() > 1
    found = range_coder.read_documents(spark, str(tmp_path / "ids")).collect()
    found = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found)
    start, told = 0, []
    for at, doc_id, n, crc in found:
        assert at == start
        start += n
        told.append((doc_id, n, crc))
    want = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        want.append((doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(told, key=str) == sorted(want, key=str)
    assert [x[0] for x in told] == sorted((x[0] for x in want), key=lambda x: (x is not None, x))


def test_ids_read_back_from_files(spark, texts):
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    rows = queries.QUERIES["op6_context_mixing_coder"](spark, SMALL).collect()
    start = 0
    assert len(rows) == len(texts)
    for row in sorted(rows, key=lambda r: r["doc_id"]):
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids + [0]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), crc)
        start += len(ids)


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key")).cache()
    listed = universe.where("xxhash64(key) % 20 = 0").unionByName(
        spark.createDataFrame([("not there",)], "key string")
    )
    cascade = Cascade(listed, universe, 20_000, "t")
    assert len(cascade.levels) > 1
    told = cascade.with_filters(universe).where(cascade.contains(F.col("key")))
    assert {r["key"] for r in told.collect()} == {r["key"] for r in listed.collect()} - {"not there"}


def test_pipeline_keeps_what_brute_force_keeps(spark, texts):
    pieces = queries.QUERIES["op9_retrieval_packing"](spark, SMALL)
    assert pieces.columns == corpus_pipeline.run(spark, SMALL).columns
    rows = corpus_pipeline.run(spark, SMALL).collect()
    told = {i for i, t in texts.items() if re.search(r"[^\W\d_]", t)}
    first = {}
    for i in sorted(told):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[i]), i)
    single = {i: texts[i] for i in first.values()}
    kept = {i for i, c in brute_classes(single).items() if i == c}
    assert {r["doc_id"] for r in rows} == kept
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "language_id"


def test_runs_of_few_long_lines_are_deleted(spark):
    long = [" ".join(f"{c}{i}" for i in range(n)) for c, n in (("a", 60), ("b", 60), ("c", 30), ("d", 21), ("e", 20))]
    a, b, c, d, e = long
    texts = {
        1: f"{a}\n{b}\nx\n{c}\n{d}\n{e}", 2: f"{a}\n{b}", 3: f"own\n{b}\nown too",
        4: f"{c}\n{d}\nmine", 5: f"{d}\nmore\n{e}", 6: f"{d}\n{e}\nthat is new", 7: a, 8: f"y\n{e}\n{e}\n{e}\n{e}",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = {r["doc_id"]: (r["text"], r["n_deleted"]) for r in winnow_lines(docs).collect()}
    assert [out[i] for i in (2, 3, 4, 7)] == [("", 2), ("own\nown too", 1), ("mine", 2), ("", 1)]
    # Two lines of 41 words are no run, nor is one of 20; three alike in a row are, from the second on.
    assert [out[i][1] for i in (1, 5, 6, 8)] == [0, 0, 0, 3]
