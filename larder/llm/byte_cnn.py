"""Language identification by a convolutional network over bytes, trained here in numpy.

A text is cut into windows of a fixed number of bytes. Filters of several widths slide over the
embedded bytes of a window, the strongest response of each filter is kept, and a softmax layer
gives the languages' probabilities. A document's are the mean over its windows, weighted by their
bytes. The model is a few thousand numbers, fitted on a bounded sample of labelled windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import bounded_batches, over_cores, text_or_empty

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDED = 8
#: The classifier's bound: labelled documents of one language that training takes, on average.
SAMPLE_PER_LANGUAGE = 1500
EPOCHS = 30
UNKNOWN = "und"
#: Windows convolved at once, so that what they need stays in the processor's cache.
_CHUNK = 64
SCHEMA = "doc_id long, lang_pred string, score double"


@dataclass
class Model:
    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDED
    filters: list[np.ndarray]  # one for each width: width x EMBEDDED x FILTERS
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, self.bias, self.weights, self.offset]

    def tables(self) -> list[np.ndarray]:
        """For each place in a filter: the response to each byte, of all filters that reach it."""
        return [
            np.concatenate([self.embedding @ f[at] for f in self.filters if len(f) > at], axis=1)
            for at in range(max(WIDTHS))
        ]

    def responses(self, windows: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """Filter responses at each byte of padded windows; the widest filters come last."""
        n = windows.shape[1] - max(WIDTHS) + 1
        out = tables[0][windows[:, :n]]
        for at, table in enumerate(tables[1:], 1):
            out[..., out.shape[-1] - table.shape[1] :] += table[windows[:, at : at + n]]
        return out

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        tables = self.tables()
        pooled = np.concatenate(
            [
                self.responses(windows[low : low + _CHUNK], tables).max(axis=1)
                for low in range(0, len(windows), _CHUNK)
            ]
        )
        return _softmax(np.maximum(pooled + self.bias, 0) @ self.weights + self.offset)


def _softmax(logits: np.ndarray) -> np.ndarray:
    powers = np.exp(logits - logits.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the texts, padded with zeros; the text each is of, and its bytes."""
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(texts)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    out = np.zeros((len(owner), WINDOW + max(WIDTHS) - 1), np.uint8)
    flat = np.zeros(len(owner) * WINDOW, np.uint8)
    at = 0
    for text, count in zip(texts, counts.tolist(), strict=True):
        flat[at : at + len(text)] = np.frombuffer(text, np.uint8)
        at += count * WINDOW
    out[:, :WINDOW] = flat.reshape(-1, WINDOW)
    return out, owner, np.minimum(WINDOW, sizes[owner] - number * WINDOW)


def fit(texts: list[bytes], languages: list[str], seed: int = 7) -> Model:
    """Train on one window of each text with Adam; every third window is cut short."""
    rng = np.random.default_rng(seed)
    names = sorted(set(languages))
    order = {name: i for i, name in enumerate(names)}
    goal = np.array([order[x] for x in languages])
    short = rng.integers(12, WINDOW + 1, len(texts))
    cut = [t[: short[i]] if i % 3 == 0 else t[:WINDOW] for i, t in enumerate(texts)]
    windows = np.zeros((len(cut), WINDOW + max(WIDTHS) - 1), np.uint8)
    for row, text in zip(windows, cut, strict=True):
        row[: len(text)] = np.frombuffer(text, np.uint8)
    total = FILTERS * len(WIDTHS)
    scale = [(2.0 / (w * EMBEDDED)) ** 0.5 for w in WIDTHS]
    model = Model(
        names,
        rng.normal(0, 0.5, (256, EMBEDDED)),
        [rng.normal(0, s, (w, EMBEDDED, FILTERS)) for s, w in zip(scale, WIDTHS, strict=True)],
        np.zeros(total),
        rng.normal(0, 0.1, (total, len(names))),
        np.zeros(len(names)),
    )
    for i, part in enumerate(model.parameters()):
        part = part.astype(np.float32)
        if i == 0:
            model.embedding = part
        elif i <= len(WIDTHS):
            model.filters[i - 1] = part
        else:
            setattr(model, ("bias", "weights", "offset")[i - 1 - len(WIDTHS)], part)
    first = [np.zeros_like(p) for p in model.parameters()]
    second = [np.zeros_like(p) for p in model.parameters()]
    step = 0
    for _ in range(EPOCHS):
        shuffled = rng.permutation(len(cut))
        for low in range(0, len(cut), _CHUNK):
            step += 1
            rows = shuffled[low : low + _CHUNK]
            found = _gradients(model, windows[rows], goal[rows])
            rate = 0.004 * (1 - 0.1**step) ** 0.5
            for p, g, m, v in zip(model.parameters(), found, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * m / (np.sqrt(v) + 1e-6)
    return model


def _gradients(model: Model, windows: np.ndarray, goal: np.ndarray) -> list[np.ndarray]:
    responses = model.responses(windows, model.tables())
    peak = responses.argmax(axis=1)
    pooled = np.take_along_axis(responses, peak[:, None, :], axis=1)[:, 0] + model.bias
    active = np.maximum(pooled, 0)
    error = _softmax(active @ model.weights + model.offset)
    error[np.arange(len(goal)), goal] -= 1
    error /= len(goal)
    back = (error @ model.weights.T) * (pooled > 0)
    embedding = np.zeros_like(model.embedding)
    filters = []
    rows = np.arange(len(goal))[:, None]
    for i, (width, own) in enumerate(zip(WIDTHS, model.filters, strict=True)):
        own_slice = slice(i * FILTERS, (i + 1) * FILTERS)
        g = back[:, own_slice]
        change = np.zeros_like(own)
        for at in range(width):
            seen = windows[rows, peak[:, own_slice] + at]
            change[at] = np.einsum("nf,nfe->ef", g, model.embedding[seen])
            np.add.at(embedding, seen, g[..., None] * own[at].T[None])
        filters.append(change)
    return [embedding, *filters, back.sum(0), active.T @ error, error.sum(0)]


def in_training(doc_id: str):
    """Rows that training may see: the checksum of the id as text is no multiple of five."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % 5 != 0


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> Model | None:
    """Fit a model on about ``per_language`` windows of each language's labelled documents.

    One window of each sampled document, at a place drawn by its id, comes to the driver: on average
    ``per_language`` for each language that occurs as a label, rare ones included. Null labels and
    texts without a letter teach nothing. None if there is nothing to learn.
    """
    text = F.lower(text_or_empty(text_col))
    labelled = docs.where(
        F.col(lang_col).isNotNull() & in_training(id_col) & text_or_empty(text_col).rlike(r"\p{L}")
    ).select(F.col(id_col).alias("id"), text.alias("text"), F.col(lang_col).alias("lang"))
    counts = (
        labelled.groupBy("lang")
        .count()
        .orderBy(F.col("count").desc(), "lang")
        .collect()
    )
    if not counts:
        return None
    draw = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 30))
    chosen = F.lit(False)
    for row in counts:
        share = min(1.0, per_language / row["count"])
        chosen = chosen | ((F.col("lang") == row["lang"]) & (draw < int(share * (1 << 30))))
    room = F.greatest(F.length("text") - F.lit(WINDOW), F.lit(1))
    place = F.pmod(F.xxhash64("id", F.lit(2)), room.cast("bigint")).cast("int") + 1
    sample = (
        labelled.where(chosen)
        .select("id", "lang", F.substring(F.col("text"), place, F.lit(WINDOW)).alias("text"))
        .toPandas()
        .sort_values(["id", "text"], kind="stable")
    )
    return fit([t.encode() for t in sample["text"]], list(sample["lang"]))


def _scores(texts: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The best language of each text and its probability."""
    windows, owner, sizes = windows_of(texts)
    total = np.zeros((len(texts), len(model.languages)))
    if len(windows):
        np.add.at(total, owner, model.probabilities(windows) * sizes[:, None])
    mean = total / np.maximum([len(t) for t in texts], 1)[:, None]
    best = mean.argmax(axis=1)
    return best, np.minimum(mean[np.arange(len(texts)), best], 1.0)


def _predicted(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Replaces the columns ``_text`` and ``_letters``, which come last, by the prediction."""
    for batch in batches:
        for low in range(0, batch.num_rows, 500):
            part = batch.slice(low, 500)
            best, score = _scores([t.encode() for t in part["_text"].to_pylist()], model)
            letters = part["_letters"].to_numpy(zero_copy_only=False).astype(bool)
            names = np.where(letters, np.array(model.languages, object)[best], UNKNOWN)
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns[:-2],
                    pa.array(names, pa.string()),
                    pa.array(np.where(letters, score, 0.0), pa.float64()),
                ],
                [*part.schema.names[:-2], "_lang", "_score"],
            )


def _with_prediction(docs: DataFrame, model: Model | None, text_col: str) -> DataFrame:
    """All columns of ``docs`` as c0, c1, ..., then ``_lang`` and ``_score``."""
    bounded_batches(docs.sparkSession)
    own = [F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    if model is None:
        return docs.select(*own, F.lit(UNKNOWN).alias("_lang"), F.lit(0.0).alias("_score"))
    text = text_or_empty(text_col)
    keyed = docs.select(
        *own, F.lower(text).alias("_text"), text.rlike(r"\p{L}").alias("_letters")
    )
    schema = "".join(f"{c} {kind}, " for c, kind in keyed.dtypes[:-2])
    schema += "_lang string, _score double"
    return over_cores(keyed).mapInArrow(lambda b: _predicted(b, model), schema)


def predict(
    docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text, from the text alone.

    A null text, one without a letter, or any text if there is no model, is ``und`` with score 0.
    Ties go to the first language by name. Repeated rows stay; a null id stays null.
    """
    own = docs.select(F.col(id_col).cast("bigint"), F.col(text_col))
    told = _with_prediction(own, model, own.columns[1])
    names = {"c0": "doc_id", "_lang": "lang_pred", "_score": "score"}
    return told.withColumnsRenamed(names).select(*names.values())


def known_language(
    docs: DataFrame, model: Model | None, text_col: str = "text", least: float = 0.4
) -> DataFrame:
    """The rows of ``docs`` whose language is told with a score of at least ``least``.

    Rows without a letter, null texts too, go. Without a model, as no row is labelled, no language
    is rejected: all rows with a letter stay. Repeated rows stay as often as they are.
    """
    if model is None:
        return docs.where(text_or_empty(text_col).rlike(r"\p{L}"))
    told = _with_prediction(docs, model, text_col)
    kept = told.where((F.col("_lang") != UNKNOWN) & (F.col("_score") >= least))
    return kept.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))
