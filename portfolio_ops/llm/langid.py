"""Language of a text by a convolutional network over its bytes.

Bytes are embedded, filters of several widths slide over a window, each filter keeps its
largest response, and a softmax layer gives the languages. A text is cut into windows of one
length; their probabilities are averaged by the bytes they hold.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portfolio_ops.llm.sampling import bounded_sample, crc_remainder, passage
from portfolio_ops.llm.text import chunks, id_and_text

WINDOW = 256
WIDTHS = (2, 3, 4)
EMBEDDING, FILTERS = 8, 16
BATCH = 64
UNKNOWN = "und"


def has_letter(text: str) -> bool:
    """Numbers like ``½`` or ``Ⅷ`` and marks are no letters."""
    return any(map(str.isalpha, text))


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte windows of all texts (the last of each padded with zeros), the text each belongs
    to, and the bytes it holds."""
    raws = [t.encode("utf-8") for t in texts]
    counts = np.array([max(1, -(-len(r) // WINDOW)) for r in raws], np.int64)
    grid = np.frombuffer(b"".join(r.ljust(n * WINDOW, b"\0") for r, n in zip(raws, counts.tolist())),
                         np.uint8).reshape(-1, WINDOW)
    owner = np.repeat(np.arange(len(texts)), counts)
    held = np.full(len(grid), WINDOW, np.int64)
    last = np.cumsum(counts) - 1
    held[last] = np.array([len(r) for r in raws]) - (counts - 1) * WINDOW
    return grid, owner, held


@dataclass
class LanguageModel:
    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 5) -> LanguageModel:
        rng = np.random.default_rng(seed)

        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)
        return cls(languages, normal(256, EMBEDDING, scale=0.5),
                   [normal(w * EMBEDDING, FILTERS, scale=(w * EMBEDDING) ** -0.5) for w in WIDTHS],
                   [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
                   normal(FILTERS * len(WIDTHS), len(languages), scale=0.1),
                   np.zeros(len(languages), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.biases, self.out, self.out_bias]

    def responses(self, grid: np.ndarray):
        """For each width the response of every filter at every place."""
        embedded = self.embedding[grid]
        for width, filters, bias in zip(WIDTHS, self.filters, self.biases):
            places = WINDOW - width + 1
            columns = np.lib.stride_tricks.as_strided(
                embedded, (len(grid), places, width * EMBEDDING), embedded.strides)
            yield (columns.reshape(-1, width * EMBEDDING) @ filters + bias) \
                .reshape(len(grid), places, FILTERS)

    def pooled(self, grid: np.ndarray) -> np.ndarray:
        return np.maximum(np.concatenate([r.max(axis=1) for r in self.responses(grid)], axis=1), 0)

    def probabilities(self, grid: np.ndarray) -> np.ndarray:
        parts = [_softmax(self.pooled(grid[i:i + BATCH]) @ self.out + self.out_bias)
                 for i in range(0, len(grid), BATCH)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.languages)))

    def gradients(self, grid: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross entropy; through max pooling only the largest place counts."""
        best, pooled = [], []
        for r in self.responses(grid):
            at = r.argmax(axis=1)
            best.append(at)
            pooled.append(np.take_along_axis(r, at[:, None, :], axis=1)[:, 0])
        pooled = np.concatenate(pooled, axis=1)
        active = np.maximum(pooled, 0)
        error = _softmax(active @ self.out + self.out_bias)
        error[np.arange(len(grid)), target] -= 1
        error /= len(grid)
        back = (error @ self.out.T) * (pooled > 0)
        d_embedding = np.zeros_like(self.embedding)
        d_filters, d_biases = [], []
        rows = np.arange(len(grid))[:, None]
        for k, (width, at) in enumerate(zip(WIDTHS, best)):
            pull = back[:, k * FILTERS:(k + 1) * FILTERS]
            seen = sliding_window_view(grid, width, axis=1)[rows, at]        # n, filters, width
            columns = self.embedding[seen].reshape(len(grid), FILTERS, -1)
            d_filters.append(np.einsum("nfc,nf->cf", columns, pull))
            d_biases.append(pull.sum(axis=0))
            spread = pull[:, :, None] * self.filters[k].T[None]
            np.add.at(d_embedding, seen.ravel(), spread.reshape(-1, EMBEDDING))
        return [d_embedding, *d_filters, *d_biases, active.T @ error, error.sum(axis=0)]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and probability of each text; without a letter ``und`` and 0."""
        readable = [k for k, t in enumerate(texts) if has_letter(t)]
        names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if readable and self.languages:
            grid, owner, held = windows([texts[k] for k in readable])
            weighted = self.probabilities(grid) * held[:, None]
            total = np.stack([np.bincount(owner, weighted[:, c], minlength=len(readable))
                              for c in range(len(self.languages))], axis=1)
            total /= np.maximum(total.sum(axis=1, keepdims=True), 1e-12)
            best = total.argmax(axis=1)
            for k, c, p in zip(readable, best.tolist(), total.max(axis=1).tolist()):
                names[k], score[k] = self.languages[c], min(1.0, p)
        return names, score


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(texts: list[str], languages: list[str], max_windows: int = 12_000, epochs: int = 6,
        rate: float = 0.003, seed: int = 5) -> LanguageModel:
    """Adam on mini-batches of at most ``max_windows`` windows of the given texts."""
    model = LanguageModel.fresh(sorted(set(languages)), seed)
    if len(model.languages) < 2:
        return model
    grid, owner, _ = windows(texts)
    number = {name: k for k, name in enumerate(model.languages)}
    target = np.array([number[x] for x in languages])[owner]
    rng = np.random.default_rng(seed)
    if len(grid) > max_windows:
        some = rng.permutation(len(grid))[:max_windows]
        grid, target = grid[some], target[some]
    first = [np.zeros_like(p) for p in model.parameters()]
    second = [np.zeros_like(p) for p in model.parameters()]
    step = 0
    for _ in range(epochs if len(grid) > 2000 else 4 * epochs):
        order = rng.permutation(len(grid))
        for i in range(0, len(order), BATCH):
            batch = order[i:i + BATCH]
            step += 1
            for p, g, m, v in zip(model.parameters(), model.gradients(grid[batch], target[batch]),
                                  first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return model


def train(docs: DataFrame, sample_docs: int = 4000, passage_chars: int = 1500) -> LanguageModel:
    """Model from documents with a language whose crc32 remainder modulo 5 is not 0.

    The bounds are for fitting alone: about ``sample_docs`` documents, chosen by hash, and one
    passage of each. Null ids, texts and languages are left out.
    """
    known = docs.where("lang is not null and text is not null and doc_id is not null") \
        .select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text") \
        .where(crc_remainder(F.col("doc_id"), 5) != 0)
    rows = bounded_sample(known, sample_docs).select(
        "doc_id", "lang", passage(F.col("text"), F.col("doc_id"), passage_chars).alias("text")
    ).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"], r["lang"]))
    rows = [r for r in rows if has_letter(r["text"])]
    return fit([r["text"] for r in rows], [r["lang"] for r in rows])


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every document, from its whole text.

    ``und`` and 0 where the text is null, empty or has no letter, or no language was learned.
    A null or repeated ``doc_id`` is passed through, one row per input row (a null id is not
    held out); other columns are ignored.
    """
    def run(batches):
        for ids, texts in chunks(batches):
            names, score = model.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(names, pa.string()), pa.array(score)],
                names=["doc_id", "lang_pred", "score"])
    out = id_and_text(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", (crc_remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
                      "lang_pred", "score")
