"""Encoders against the tokenizers library, packing against its own conditions."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from larder.llm import forced_bpe, queries
from larder.llm.packing import retrieval_pack
from larder.llm.tokens import WordEncoder, tokenizer_path
from tests.conftest import SMALL

ODD = [
    "", " ", "a", " a", "a ", "a  b", "a\n\nb", "a\nb c", "\n", "\na", "a\n", " \n a",
    "x<|endoftext|>y <|startoftext|> z", "it's 'S we'll don't ?'s ''re", "a\tb \t c",
    "Ünïcödé é ́x ΣΑΣ", "z" * 3000, "12 345 6", "日本語 テキスト", "\x1cA\x1d b\x00", "🙂 x",
]
ROWS = "doc_id long, text string, ids string, length string"


def texts(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_remembered_words_give_the_ids_of_whole_texts(name):
    encoder, library = WordEncoder(name), Tokenizer.from_file(tokenizer_path(name))
    for _ in range(2):
        got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(ODD)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in ODD]


def test_plain_specials_never_give_their_id():
    encoder = WordEncoder("byte_bpe_50k.json", plain_specials=True)
    assert 50256 not in np.frombuffer(encoder.encode(["a<|endoftext|>b"])[0], encoder.dtype)


def test_forced_boundaries_give_the_ids_of_whole_texts():
    bpe = forced_bpe.ForcedBpe("byte_bpe_50k.json")
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    for text in ODD * 2:
        ids = np.frombuffer(bpe.encode(text), bpe.dtype)
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert bpe.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)
    broken = np.array([220, 163, 250, 50256])
    assert bpe.decode(broken) == library.decode(broken.tolist(), skip_special_tokens=False)
    assert bpe.forced("q\n".encode()).tolist() == [1] and bpe.forced(b"th").tolist() == []


def test_round_trip_of_all_documents(spark):
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    want = texts(spark)
    rows = queries.QUERIES["op4_forced_boundary_bpe"](spark, SMALL).collect()
    assert len(rows) == len(want)
    for row in rows:
        ids = library.encode(want[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        back = library.decode(ids, skip_special_tokens=False)
        assert row["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


def test_encode_then_decode_with_nulls_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b", "x", "y"), (1, None, "x", None)], ROWS)
    encoded = forced_bpe.encode(docs)
    assert sorted(r["text"] for r in forced_bpe.decode(encoded).collect()) == ["", "a b"]
    assert forced_bpe.round_trip(docs.limit(0)).count() == 0


def check_pieces(rows, want, window=4096):
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(want)
    total = 0
    for doc_id, pieces in by_doc.items():
        ids = np.array(library.encode(want[doc_id], add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"]) == (at, len(ids)) and p["length"] > 0
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
        total += at
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window
    return len(by_sequence), total


def test_packing_of_all_documents(spark):
    rows = queries.QUERIES["op9_retrieval_packing"](spark, SMALL).collect()
    sequences, total = check_pieces(rows, texts(spark))
    assert sequences <= total / 4096 + spark.sparkContext.defaultParallelism


def test_packing_puts_related_documents_together(spark):
    topics = ["apple pear plum cherry fig", "bolt screw nail hammer saw"]
    rows = [(i, " ".join([topics[i % 2]] * 20), "", "") for i in range(40)]
    docs = spark.createDataFrame(rows, ROWS).coalesce(1).sortWithinPartitions("doc_id")
    docs = docs.select("*", docs.text.alias("sequence_id"))
    spread, spark_cores = retrieval_pack(docs, window=1024), spark.sparkContext.defaultParallelism
    check_pieces(spread.collect(), {r[0]: r[1] for r in rows}, 1024)
    assert spread.select("sequence_id").distinct().count() <= 2 * spark_cores + 4
    assert retrieval_pack(docs.limit(0)).count() == 0


def test_retrieval_ranks_the_same_topic_first():
    from larder.llm.packing import Index

    ids = [np.array(x) for x in ([1, 2, 3, 9], [4, 5, 6, 9], [1, 2, 3, 3, 9], [4, 5, 9], [7, 9])]
    pairs = [np.unique(x, return_counts=True) for x in ids]
    found = np.bincount(np.concatenate([terms for terms, _ in pairs]), minlength=10)
    idf, lengths = np.log(1 + (5 - found + 0.5) / (found + 0.5)), [len(x) for x in ids]
    index = Index([t for t, _ in pairs], [c for _, c in pairs], lengths, idf, np.mean(lengths))
    for seed, nearest in ((0, 2), (1, 3), (2, 0)):
        scores = index.scores(pairs[seed][0])
        scores[seed] = -1
        assert scores.argmax() == nearest


def test_null_texts_pack_to_the_end_id(spark):
    docs = spark.createDataFrame([(7, None, "a", "b"), (None, "", None, None)], ROWS)
    rows = retrieval_pack(docs).collect()
    assert [(r["length"], r["doc_tokens"]) for r in rows] == [(1, 1), (1, 1)]
    assert {r["doc_id"] for r in rows} == {7, None}
