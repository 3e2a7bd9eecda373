"""Token ids of whole texts by the tokenizers library, with remembered words.

Both kinds of public vocabulary cut a text before it merges bytes, and no cut depends on what lies
beyond a white-space edge. So a text's ids are those of its words in a row. The words of a whole
column are told apart by Arrow; one seen before in the same worker costs a look-up in an array. The
library encodes all new words of a column, many to a text, whose ids show where a word ends.
"""

from __future__ import annotations

import gc
import json
import os
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words a worker remembers; about 30 bytes each. Beyond it those met once alone are forgotten, and
#: all if the others are more than half.
REMEMBERED = 1_500_000
#: Bytes of texts whose words are told apart at once; at least one text.
PART_BYTES = 8 << 20
#: New words that make one text for the library, and words whose ids are put together at once.
JOINED, GATHERED = 2000, 1 << 18
#: White space other than the space and the line feed, as any of the engines sees it, and white
#: space whose runs the splitter may join: such a text is encoded as one.
_ODD = (
    r"[\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
    r"\x{205f}\x{3000}]|  |\n\n| \n|\n "
)
#: Words that the library gets one by one: blank ones, first words and those with the separator.
_ALONE = r"^[ \n]*$|^\t|\|"
_BAR = "|"


def tokenizer_path(name: str) -> str:
    """Where the installed vocabulary file of that name is; resolved where it is used."""
    import public_tokenizers

    return name if os.path.isabs(name) else public_tokenizers.path(name)


def _load(path: str):
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _literal(text: str) -> str:
    """A pattern of the text alone."""
    return "".join(f"\\x{{{ord(c):x}}}" for c in text)


class WordEncoder:
    """Ids of texts as little-endian unsigned integers of ``dtype``.

    ``plain_specials``: the strings of special tokens are ordinary text. ``remembered``: words
    held when a part begins, at most; else ``REMEMBERED``. Vocabularies of an unknown layout are encoded text by text.
    """

    def __init__(self, name: str, plain_specials: bool = False, remembered: int | None = None):
        self.remembered = remembered
        path = tokenizer_path(name)
        self.tokenizer = _load(path)
        self.tokenizer.encode_special_tokens = plain_specials
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        splitter = layout["pre_tokenizer"] or {}
        self.spaced = (
            layout["normalizer"] is None
            and splitter.get("type") == "ByteLevel"
            and splitter.get("use_regex")
            and not splitter.get("add_prefix_space")
        )
        steps = splitter.get("pretokenizers", [{}])
        self.spaceless = not self.spaced and (
            steps[0].get("behavior") == "Removed" and steps[0].get("invert")
        )
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        top = max(vocabulary.values())
        self.dtype = np.dtype("<u2") if top < 1 << 16 else np.dtype("<u4")
        specials = [t["content"] for t in layout["added_tokens"]]
        self.alone = "|".join([_ALONE, *(_literal(content) for content in specials)])
        #: The ids that begin with a space or a line feed, as the vocabulary writes them.
        self.opening = np.zeros(top + 1, bool)
        self.opening[[i for token, i in vocabulary.items() if token[:1] in ("Ġ", "Ċ")]] = True
        bar = self._one(_BAR)
        self.bar = int(bar[0]) if len(bar) == 1 else -1
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], pa.string())
        self.ids, self.held = np.zeros(1 << 16, self.dtype), 0
        self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.met = np.zeros(0, bool)  # in a later part too

    def _tidy(self) -> None:
        kept = np.flatnonzero(self.met)
        if not 0 < len(kept) <= (self.remembered or REMEMBERED) // 2:
            return self._forget()
        self.words, sizes = self.words.take(pa.array(kept)), self.sizes[kept]
        ends = np.cumsum(sizes, dtype=np.int64)
        starts = (ends - sizes).astype(np.int32)
        self.ids = self.ids[np.repeat(self.starts[kept] - starts, sizes) + np.arange(ends[-1])]
        self.held, self.starts, self.sizes = len(self.ids), starts, sizes
        self.met = np.zeros(len(kept), bool)

    def _one(self, text: str) -> np.ndarray:
        """The library's own ids of a text."""
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(found.ids, self.dtype)

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """The ids of each text as bytes."""
        ids, counts = self.encode_column(pa.array(texts, pa.string()))
        data, ends = ids.tobytes(), (np.cumsum(counts) * self.dtype.itemsize).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has; a null has none."""
        step = max(1, len(texts) * PART_BYTES // max(texts.nbytes, 1))
        lows = range(0, len(texts), step)
        parts = [self._encoded(texts.slice(low, step).fill_null("")) for low in lows]
        if len(parts) == 1:
            return parts[0]
        ids = [np.zeros(0, self.dtype), *(part for part, _ in parts)]
        return np.concatenate(ids), np.concatenate([np.zeros(0, np.int64), *(n for _, n in parts)])

    def _encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self.spaceless:
            return self._of_words(pc.replace_substring(texts, "\n", " "))
        odd = np.ones(len(texts), bool)
        if self.spaced:
            odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        plain = texts.filter(pa.array(~odd)) if odd.any() else texts
        # A first word has no space before it, so it is remembered as another word.
        marked = pc.binary_join_element_wise("\t", pc.replace_substring(plain, "\n", " \n"), "")
        ids, own = self._of_words(marked)
        if not odd.any():
            return ids, own
        counts = np.zeros(len(texts), np.int64)
        counts[~odd] = own
        hard = [self._one(text) for text in texts.filter(pa.array(odd)).to_pylist()]
        counts[odd] = [len(part) for part in hard]
        whole, of_odd = np.zeros(counts.sum(), self.dtype), np.repeat(odd, counts)
        whole[~of_odd], whole[of_odd] = ids, np.concatenate(hard)
        return whole, counts

    def _of_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        cut = pc.split_pattern(texts, " ")
        edges = cut.offsets.to_numpy().astype(np.int64)
        coded = cut.flatten().dictionary_encode()
        del cut
        at = self._places(coded.dictionary)[coded.indices.to_numpy()]
        sizes = self.sizes[at]
        ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        ids = np.empty(ends[-1], self.dtype)
        for low in range(0, len(at), GATHERED):
            some, own = at[low : low + GATHERED], sizes[low : low + GATHERED]
            a, b = ends[low], ends[low + len(some)]
            shift = self.starts[some] - (ends[low : low + len(some)] - a)
            ids[a:b] = self.ids[np.repeat(shift, own) + np.arange(b - a)]
        return ids, np.diff(ends[edges])

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where each of these distinct words is remembered; new ones are learned."""
        if len(self.words) > (self.remembered or REMEMBERED):
            self._tidy()
        places = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy().copy()
        new = places < 0
        self.met[places[~new]] = True
        if new.any():
            places[new] = np.arange(len(self.words), len(self.words) + new.sum())
            self._learn(words.filter(pa.array(new)))
        return places

    def _learn(self, words: pa.Array) -> None:
        alone = pc.match_substring_regex(words, self.alone).to_numpy(zero_copy_only=False)
        sizes, starts = np.zeros(len(words), np.int32), np.zeros(len(words), np.int32)
        held, parts = self.held, []
        joined = words.filter(pa.array(~alone)).to_pylist()
        for low in range(0, len(joined), JOINED):
            parts.append(self._joined(joined[low : low + JOINED]))
        rest = words.filter(pa.array(alone)).to_pylist()
        parts.append(self._each(rest))
        order = np.concatenate([np.flatnonzero(~alone), np.flatnonzero(alone)])
        sizes[order] = np.concatenate([own for _, own in parts])
        starts[order] = held + np.cumsum(sizes[order]) - sizes[order]
        ids = np.concatenate([part for part, _ in parts])
        self.held = held + len(ids)
        if self.held > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(self.held, self.dtype)])
        self.ids[held : self.held] = ids
        self.words = pa.concat_arrays([self.words, words])
        self.starts = np.concatenate([self.starts, starts])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.met = np.concatenate([self.met, np.zeros(len(words), bool)])

    def _shown(self, word: str) -> str:
        """A word as it stands in a text."""
        if not self.spaced or word[:1] == "\n":
            return word
        return word[1:] if word[:1] == "\t" else " " + word

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self._one(self._shown(word)) for word in words]
        ids = np.concatenate([np.zeros(0, self.dtype), *found])
        return ids, np.array([len(part) for part in found], np.int32)

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of words that are encoded as one text."""
        if self.spaced:
            ids = self._one("".join(map(self._shown, words)))
            edges = np.flatnonzero(self.opening[ids])
            if len(edges) == len(words) and edges[0] == 0:
                return ids, np.diff(edges, append=len(ids)).astype(np.int32)
        elif self.bar >= 0:
            ids = self._one(f"{_BAR} {f' {_BAR} '.join(words)} {_BAR}")
            bars = ids == self.bar
            edges = np.flatnonzero(bars)
            if len(edges) == len(words) + 1 and edges[0] == 0:
                return ids[~bars], (np.diff(edges) - 1).astype(np.int32)
        return self._each(words)


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's ids followed by ``end``, and where each text ends."""
    ends = np.cumsum(counts + 1)
    out = np.empty(len(ids) + len(counts), ids.dtype)
    own = np.ones(len(out), bool)
    own[ends - 1] = False
    out[own], out[ends - 1] = ids, end
    return out, ends


@lru_cache(maxsize=4)
def word_encoder(
    name: str, plain_specials: bool = False, remembered: int | None = None
) -> WordEncoder:
    """One encoder for each vocabulary in a worker, kept over its tasks."""
    return WordEncoder(name, plain_specials, remembered)


def forget_encoders() -> None:
    """Give up a worker's encoders, their words and what Arrow keeps of freed memory."""
    word_encoder.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
