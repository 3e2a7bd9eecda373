"""Byte-level BPE by forced boundaries, and its decoding.

A merge joins two neighbours into a token, so two bytes that stand side by side in no token can
never meet in one: between them a cut is certain. The pieces of the vocabulary's own splitting
are cut there, each fragment is merged by itself, and the ids are concatenated. Fragments and words
that a worker has met are remembered.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from larder.llm.common import bounded_batches, over_cores, text_or_empty
from larder.llm.tokens import tokenizer_path

#: Words, and fragments, that a worker remembers. Beyond it the memory starts anew.
REMEMBERED = 500_000
#: How the vocabulary splits a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A word edge that no splitting looks across: other text, then a run of these white spaces.
_CHUNKS = regex.compile(r"[ \n]*[^ \n]+|[ \n]+")
_ODD_WHITE = regex.compile(r"[\s--[ \n]\x1c-\x1f]", regex.V1)


def byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file.

    Printable Latin-1 characters stand for themselves, the other bytes in order for 256 and on.
    """
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ForcedBpe:
    def __init__(self, name: str):
        path = tokenizer_path(name)
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        self.model = Tokenizer.from_file(path).model
        names = byte_names()
        self.shown = {b: c for c, b in names.items()}
        self.special = {t["content"]: t["id"] for t in layout["added_tokens"]}
        vocab = layout["model"]["vocab"]
        self.tokens = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            self.tokens[i] = bytes(names[c] for c in token)
        #: joined[a, b]: byte a stands before byte b in some token.
        self.joined = np.zeros((256, 256), bool)
        for token in self.tokens:
            for pair in zip(token, token[1:], strict=False):
                self.joined[pair] = True
        for content, i in self.special.items():
            self.tokens[i] = content.encode()
        self.dtype = np.dtype("<u2") if len(self.tokens) <= 1 << 16 else np.dtype("<u4")
        self.split = regex.compile(SPLIT)
        parts = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.specials = regex.compile(f"({parts})") if parts else None
        self.words: dict[str, bytes] = {}
        self.fragments: dict[str, bytes] = {}

    def forced(self, data: bytes) -> np.ndarray:
        """Where a cut is certain: the places before bytes that no token has after their left."""
        values = np.frombuffer(data, np.uint8)
        return np.flatnonzero(~self.joined[values[:-1], values[1:]]) + 1

    def learn(self, words: list[str]) -> None:
        """Ids of new words. All but the first begin with white space, so they split as one text."""
        text = "".join(words)
        data = text.encode()
        size = len if len(data) == len(text) else (lambda part: len(part.encode()))
        marks = np.zeros(len(data) + 1, bool)
        marks[self.forced(data)] = True
        marks[np.cumsum([size(piece) for piece in self.split.findall(text)], dtype=np.int64)] = True
        marks[0] = False
        edges = np.flatnonzero(marks)
        shown = data.decode("latin-1").translate(self.shown)
        stops = edges.tolist()
        ids = [self.fragment(shown[a:b]) for a, b in zip([0, *stops], stops, strict=False)]
        ends = np.cumsum([size(word) for word in words], dtype=np.int64)
        upto = (np.searchsorted(edges, ends) + 1).tolist()
        for word, a, b in zip(words, [0, *upto], upto, strict=False):
            self.words[word] = b"".join(ids[a:b])

    def fragment(self, shown: str) -> bytes:
        """Ids of one fragment, given as the characters that stand for its bytes."""
        ids = self.fragments.get(shown)
        if ids is None:
            found = [token.id for token in self.model.tokenize(shown)]
            ids = self.fragments[shown] = np.array(found, self.dtype).tobytes()
        return ids

    def ordinary(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        if _ODD_WHITE.search(text):
            pieces = [text]
        elif "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
            pieces = _CHUNKS.findall(text)
        else:  # the same chunks, found faster
            first, *rest = text.replace("\n", " \n").split(" ")
            pieces = [first, *[p if p[:1] == "\n" else " " + p for p in rest]]
        new = set(pieces).difference(self.words)
        if new:
            if pieces[0] in new:
                new.discard(pieces[0])
                self.learn([pieces[0]])
            self.learn(list(new))
        return b"".join(map(self.words.__getitem__, pieces))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian integers of ``dtype``."""
        if len(self.words) > REMEMBERED:
            self.words = {}
        if len(self.fragments) > REMEMBERED:
            self.fragments = {}
        if self.specials is None or not any(s in text for s in self.special):
            return self.ordinary(text)
        out = []
        for part in self.specials.split(text):
            if part in self.special:
                out.append(np.array([self.special[part]], self.dtype).tobytes())
            elif part:
                out.append(self.ordinary(part))
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; bytes that are no UTF-8 become the replacement character."""
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids.tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def forced_bpe(name: str) -> ForcedBpe:
    """One encoder for each vocabulary in a worker, kept over its tasks."""
    return ForcedBpe(name)


def _digests(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    bpe = forced_bpe(name)
    for batch in batches:
        counts, ids_sha, text_sha = [], [], []
        for text in batch[1].to_pylist():
            ids = np.frombuffer(bpe.encode(text), bpe.dtype)
            counts.append(len(ids))
            ids_sha.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
            text_sha.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch[0], pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def _encoded(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    bpe = forced_bpe(name)
    for batch in batches:
        ids = [
            np.frombuffer(bpe.encode(t), bpe.dtype).astype(np.int32) for t in batch[1].to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [batch[0], pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
        )


def _decoded(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    bpe = forced_bpe(name)
    for batch in batches:
        texts = [
            None if x is None else bpe.decode(np.array([i for i in x if i is not None], np.int64))
            for x in batch[1].to_pylist()
        ]
        yield pa.RecordBatch.from_arrays([batch[0], pa.array(texts)], ["doc_id", "text"])


def _keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col))
    return over_cores(texts)


def encode(
    docs: DataFrame, name: str = "byte_bpe_50k.json", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, ids`` of every row; a null or empty text has no ids. Repeated rows stay."""
    return _keyed_texts(docs, id_col, text_col).mapInArrow(
        lambda b: _encoded(b, name), "doc_id long, ids array<int>"
    )


def decode(
    encoded: DataFrame, name: str = "byte_bpe_50k.json", id_col: str = "doc_id", ids: str = "ids"
) -> DataFrame:
    """``doc_id, text`` of every row; a null list gives a null text, null ids in a list none."""
    bounded_batches(encoded.sparkSession)
    return encoded.select(F.col(id_col).cast("bigint"), F.col(ids).cast("array<int>")).mapInArrow(
        lambda b: _decoded(b, name), "doc_id long, text string"
    )


def round_trip(
    docs: DataFrame, name: str = "byte_bpe_50k.json", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row, encoded and decoded.

    A null text is the empty one, which has no tokens. Repeated rows stay, a null id stays null. An
    empty table gives no rows.
    """
    return _keyed_texts(docs, id_col, text_col).mapInArrow(
        lambda b: _digests(b, name),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
