"""Document quality by a linear-chain conditional random field over lines.

Each line is good or bad. Its features come from the line and from both neighbours; the chain
adds weights for equal and changing neighbours. Forward-backward gives the probability that a
line is good; their mean weighted by line length, put through a two-parameter logistic fit, is
the score of the document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portfolio_ops.llm.sampling import bounded_sample, crc_remainder, passage
from portfolio_ops.llm.shared import text_runs
from portfolio_ops.llm.text import chunks, id_and_text, span_hashes

LOWER, UPPER, DIGIT, BLANK, PLAIN, SYMBOL, BANG, LEAD, INNER = range(9)
KINDS = 9


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, SYMBOL, np.int64)
    for chars, kind in (("abcdefghijklmnopqrstuvwxyz", LOWER), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", UPPER),
                        ("0123456789", DIGIT), (" \t\r\n\x0b\x0c", BLANK), (".,;:?'\"()-", PLAIN),
                        ("!", BANG)):
        kinds[[ord(c) for c in chars]] = kind
    kinds[0x80:0xC0], kinds[0xC0:] = INNER, LEAD
    return kinds


BYTE_KINDS = _byte_kinds()
OWN = 17  # features of a line itself; bias first
LONG = 4096         # lines from which on a document is read alone, block by block
BLOCK_CHARS = 1 << 15
FEATURES = 1 + 3 * (OWN - 1)


@dataclass
class Lines:
    """Lines of a run of documents: features, bytes, and where each document's lines begin."""
    features: np.ndarray
    size: np.ndarray
    bounds: np.ndarray


def read_lines(texts: list[str]) -> Lines:
    """Lines of all texts, taken in runs so that the byte arrays stay small."""
    parts = [_read(texts[a:b]) for a, b in text_runs(texts)]
    if len(parts) == 1:
        return parts[0]
    counts = np.concatenate([np.diff(p.bounds) for p in parts] or [np.zeros(0, np.int64)])
    return Lines(np.concatenate([p.features for p in parts] or [np.zeros((0, FEATURES))]),
                 np.concatenate([p.size for p in parts] or [np.zeros(0, np.int64)]),
                 np.concatenate([[0], np.cumsum(counts)]))


def _read(texts: list[str]) -> Lines:
    own, size, bounds = _own(texts)
    first, last = np.zeros(len(size), bool), np.zeros(len(size), bool)
    first[bounds[:-1]], last[bounds[1:] - 1] = True, True
    before = np.roll(own[:, 1:], 1, axis=0)
    after = np.roll(own[:, 1:], -1, axis=0)
    before[first], after[last] = 0, 0
    return Lines(np.concatenate([own, before, after], axis=1), size, bounds)


def line_blocks(text: str):
    """The text cut at line ends, so that a block ends with the first one after ``BLOCK_CHARS``."""
    start = 0
    while (cut := text.find("\n", start + BLOCK_CHARS)) >= 0:
        yield text[start:cut]
        start = cut + 1
    yield text[start:]


def scan(unary: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Forward log odds of good along one chain, exact, without a step for each line.

    The chain is cut into rows of equal length that advance side by side: once as products of
    2 x 2 matrices (in logarithms), which give the message at each row's start, then as messages.
    """
    (t00, t01), (t10, t11) = change
    n = len(unary)
    width = max(1, int(np.sqrt(n)))
    rows = -(-n // width)
    steps = np.zeros((rows, width))
    steps.ravel()[:n] = unary
    # from a row's state before it, bad or good, to the state at its end
    bad = [np.zeros(rows), np.full(rows, -np.inf)]
    good = [np.full(rows, -np.inf), np.zeros(rows)]
    for k in range(width):
        for state in (bad, good):
            b, g = state
            state[0], state[1] = (np.logaddexp(b + t00, g + t10), np.logaddexp(b + t01, g + t11) + steps[:, k])
    start = np.zeros(rows)
    for r in range(1, rows):
        if r == 1:      # the first line has no line before it, so the first row starts with its message
            m = steps[0, 0]
            for k in range(1, width):
                m = steps[0, k] + np.logaddexp(m + t11, t01) - np.logaddexp(m + t10, t00)
        else:
            m = start[r - 1]
            m = np.logaddexp(m + good[1][r - 1], bad[1][r - 1]) - np.logaddexp(m + good[0][r - 1], bad[0][r - 1])
        start[r] = m
    at = start
    for k in range(width):
        moved = np.logaddexp(at + t11, t01) - np.logaddexp(at + t10, t00)
        if k == 0:
            moved[0] = 0
        at = moved + steps[:, k]
        steps[:, k] = at
    return steps.ravel()[:n]


def _own(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each line by itself, its bytes, and where each text's lines begin."""
    raw = np.frombuffer("\n".join(texts).encode("utf-8") + b"\n", np.uint8)
    ends = np.flatnonzero(raw == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(ends)
    bounds = np.concatenate([[0], np.cumsum([t.count("\n") + 1 for t in texts])])
    line = np.repeat(np.arange(n), ends - starts + 1)
    counts = np.bincount(line * KINDS + BYTE_KINDS[raw], minlength=n * KINDS) \
        .reshape(n, KINDS).astype(np.float64)
    counts[:, BLANK] -= 1  # the line end
    size = ends - starts
    whole = np.maximum(size, 1).astype(np.float64)

    blank = BYTE_KINDS[raw] == BLANK
    begin = np.flatnonzero(~blank & np.append(True, blank[:-1]))
    end = np.flatnonzero(~blank & np.append(blank[1:], True)) + 1
    owner = line[begin]
    words = np.bincount(owner, minlength=n).astype(np.float64)
    hashes = span_hashes(raw, begin, end)
    again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1]))
    repeats = np.bincount(owner[again], minlength=n) / np.maximum(words, 1)
    some = np.maximum(words, 1)

    share = counts / whole[:, None]
    own = np.stack([
        np.ones(n), np.log1p(size) / 8, share[:, LOWER], share[:, UPPER], share[:, DIGIT],
        share[:, BLANK], share[:, PLAIN], share[:, SYMBOL], share[:, BANG], share[:, LEAD],
        np.log1p(words) / 6, np.minimum(size / some, 40) / 20, repeats, size == 0,
        np.tanh(4 * counts[:, SYMBOL] / some), np.tanh(4 * counts[:, BANG] / some),
        np.tanh(6 * share[:, UPPER])], axis=1)
    return own, size, bounds


@dataclass
class QualityModel:
    weights: np.ndarray      # of the features, towards good
    change: np.ndarray       # [from, to] over bad, good
    scale: float = 1.0       # logistic fit of the document score
    shift: float = 0.0

    def messages(self, unary: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward log odds of good for every line.

        All documents advance together, longest first, so that those still running are a
        prefix. With two states a message is one number, its log odds.
        """
        (t00, t01), (t10, t11) = self.change
        sizes = np.diff(bounds)
        order = np.argsort(-sizes, kind="stable")
        starts, ends, sizes = bounds[:-1][order], bounds[1:][order] - 1, sizes[order]
        running = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), side="left")
        forward, backward = unary.copy(), np.zeros_like(unary)
        for t in range(1, len(running)):
            k = running[t]
            at = starts[:k] + t
            r = forward[at - 1]
            forward[at] += np.logaddexp(r + t11, t01) - np.logaddexp(r + t10, t00)
            at = ends[:k] - t
            m = unary[at + 1] + backward[at + 1]
            backward[at] = np.logaddexp(m + t11, t10) - np.logaddexp(m + t01, t00)
        return forward, backward

    def good_lines(self, lines: Lines) -> np.ndarray:
        forward, backward = self.messages(lines.features @ self.weights, lines.bounds)
        return _sigmoid(forward + backward)

    def means(self, texts: list[str]) -> np.ndarray:
        """Length-weighted share of good text in each document; an empty line weighs one.

        Documents are read in runs of fewer than ``LONG`` lines; one of more lines is read alone,
        so that features are held of one block of its lines only.
        """
        out = np.empty(len(texts))
        lines = [t.count("\n") + 1 for t in texts]
        start = 0
        while start < len(texts):
            stop, held = start + 1, lines[start]
            if held >= LONG:
                out[start] = self.long_mean(texts[start])
            else:
                while stop < len(texts) and held + lines[stop] < LONG:
                    held += lines[stop]
                    stop += 1
                out[start:stop] = self.mean_of(read_lines(texts[start:stop]))
            start = stop
        return out

    def long_mean(self, text: str) -> float:
        """The mean of one document of many lines, with three numbers held for each line."""
        inner = OWN - 1
        own_part = self.weights[:OWN]
        as_before, as_after = self.weights[OWN:OWN + inner], self.weights[OWN + inner:]
        unary, sizes, carried = [], [], 0.0
        for block in line_blocks(text):
            own, size, _ = _own([block])
            value, ahead, back = own @ own_part, own[:, 1:] @ as_before, own[:, 1:] @ as_after
            value[1:] += ahead[:-1]
            value[:-1] += back[1:]
            if unary:
                value[0] += carried
                unary[-1][-1] += back[0]
            carried = ahead[-1]
            unary.append(value)
            sizes.append(np.maximum(size, 1).astype(np.float32 if size.max() < 1 << 24 else np.float64))
        chain, weight = np.concatenate(unary), np.concatenate(sizes)
        del unary, sizes
        odds = scan(chain, self.change)
        odds += scan(chain[::-1], self.change.T)[::-1]
        odds -= chain
        odds *= 0.5
        np.tanh(odds, out=odds)     # the sigmoid of the log odds is half of one and this
        return float(0.5 + 0.5 * (odds @ weight) / weight.sum(dtype=np.float64))

    def mean_of(self, lines: Lines) -> np.ndarray:
        weight = np.maximum(lines.size, 1).astype(np.float64)
        heads = lines.bounds[:-1]
        return np.add.reduceat(self.good_lines(lines) * weight, heads) \
            / np.add.reduceat(weight, heads)

    def scores(self, texts: list[str]) -> np.ndarray:
        return _sigmoid(self.scale * _logit(self.means(texts)) + self.shift)


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def _logit(p):
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p) - np.log1p(-p)


def fit(texts: list[str], labels: list[int], steps: int = 300, rate: float = 0.1) -> QualityModel:
    """Maximum likelihood by gradient steps; every line of a document carries its label.

    Lines are weighted so that documents count alike. Without both labels the scores are
    the share of label 1 (0.5 without any row).
    """
    model = QualityModel(np.zeros(FEATURES), np.zeros((2, 2)))
    label = np.asarray(labels, np.int64)
    if len(set(labels)) < 2:
        share = float(label.mean()) if len(label) else 0.5
        return QualityModel(model.weights, model.change, 0.0, float(_logit(np.array(share))))
    lines = read_lines(texts)
    sizes = np.diff(lines.bounds)
    truth = np.repeat(label, sizes).astype(np.float64)
    share = np.repeat(1 / sizes, sizes) / len(texts)
    inner = np.ones(len(truth), bool)
    inner[lines.bounds[1:] - 1] = False
    left = np.flatnonzero(inner)
    value = np.concatenate([model.weights, model.change.ravel()])
    first, second = np.zeros_like(value), np.zeros_like(value)
    for step in range(1, steps + 1):
        model.weights, model.change = value[:FEATURES], value[FEATURES:].reshape(2, 2)
        unary = lines.features @ model.weights
        forward, backward = model.messages(unary, lines.bounds)
        good = _sigmoid(forward + backward)
        slope = lines.features.T @ ((good - truth) * share)
        ahead = unary[left + 1] + backward[left + 1]
        cell = np.stack([np.full(len(left), model.change[0, 0]), model.change[0, 1] + ahead,
                         model.change[1, 0] + forward[left],
                         model.change[1, 1] + forward[left] + ahead], axis=1)
        cell = np.exp(cell - cell.max(axis=1, keepdims=True))
        cell /= cell.sum(axis=1, keepdims=True)
        seen = np.zeros_like(cell)
        seen[np.arange(len(left)), (truth[left] * 2 + truth[left + 1]).astype(int)] = 1
        turn = ((cell - seen) * share[left][:, None]).sum(axis=0)
        gradient = np.concatenate([slope, turn]) + 1e-5 * value
        first += 0.1 * (gradient - first)
        second += 0.001 * (gradient ** 2 - second)
        value = value - rate * (first / (1 - 0.9 ** step)) \
            / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    model.weights, model.change = value[:FEATURES], value[FEATURES:].reshape(2, 2)
    model.scale, model.shift = _logistic(_logit(model.mean_of(lines)), label)
    return model


def _logistic(x: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic fit by Newton steps, lightly drawn to (1, 0)."""
    a = np.array([1.0, 0.0])
    design = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(30):
        p = _sigmoid(design @ a)
        gradient = design.T @ (p - label) + 0.1 * (a - [1.0, 0.0])
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        a = a - np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return float(a[0]), float(a[1])


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = 4000,
          passage_chars: int = 10_000) -> QualityModel:
    """Model from labelled documents whose crc32 remainder modulo 4 is not 2.

    The bounds are for fitting alone: about ``sample_docs`` documents, chosen by hash, and
    ``passage_chars`` characters of each. Null labels, ids and texts are left out; a document
    with two labels counts with both.
    """
    marked = labels.where("quality is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    chosen = bounded_sample(marked.where(crc_remainder(F.col("doc_id"), 4) != 2), sample_docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .where("text is not null").join(chosen, "doc_id") \
        .select("doc_id", "quality",
                passage(F.col("text"), F.col("doc_id"), passage_chars).alias("text")) \
        .limit(2 * sample_docs).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"], r["quality"]))
    return fit([r["text"] for r in rows], [r["quality"] for r in rows])


def score(docs: DataFrame, model: QualityModel, threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document, from its whole text.

    Null text is scored as empty. A null or repeated ``doc_id`` is passed through, one row per
    input row (a null id is not held out); other columns are ignored.
    """
    def run(batches):
        for ids, texts in chunks(batches):
            value = model.scores(texts)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(value), pa.array((value >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"])
    out = id_and_text(docs).mapInArrow(run, "doc_id long, score double, predicted int")
    return out.select("doc_id", (crc_remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
                      "score", "predicted")


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = 0.7) -> DataFrame:
    """The documents scored at least ``threshold``, all their columns as they came.

    The score is made beside the row itself, so neither a join nor an unique id is needed.
    """
    kind = docs.select("text").schema
    column = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = batch.column(column)
            keep = []
            for _, part in chunks([pa.RecordBatch.from_arrays(
                    [texts, texts.fill_null("")], names=["a", "b"])]):
                keep.append(model.scores(part) >= threshold)
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))
    assert kind["text"].dataType.simpleString() == "string"
    return docs.mapInArrow(run, docs.schema)
