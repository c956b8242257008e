"""Whole texts as numpy arrays: byte-bounded chunks, character classes, pieces, hashes."""

from __future__ import annotations

import ctypes
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
# fixed values: the code points of the Unicode property White_Space
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
               0x202F, 0x205F, 0x3000]
CHUNK_BYTES = 1 << 20


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, so that no other column can clash; null text is empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def chunks(batches: Iterable[pa.RecordBatch], limit: int = CHUNK_BYTES
           ) -> Iterator[tuple[pa.Array, list[str]]]:
    """Rows of ``(doc_id, text)`` batches in runs of about ``limit`` bytes of text.

    A text is never cut: one longer than ``limit`` is a run of its own.
    """
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(texts):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield ids.slice(start, stop - start), texts.slice(start, stop - start).to_pylist()
            start = stop
        release_memory()


@lru_cache(maxsize=1)
def _trim():
    """The C library's call that returns free memory, where there is one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):
        return None


def release_memory() -> None:
    """Return freed arrays to the system: a Python worker lives on for later tasks, next to the
    executor's heap."""
    pa.default_memory_pool().release_unused()
    if _trim():
        _trim()(0)


@lru_cache(maxsize=2)
def char_classes(size: int = 0x110000) -> np.ndarray:
    """Class of every code point below ``size``: letter (L*), number (N*), white space or other."""
    table = np.zeros(size, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for code in range(size):
        kind = kinds.get(unicodedata.category(chr(code))[0])
        if kind:
            table[code] = kind
    table[[code for code in WHITE_SPACE if code < size]] = SPACE
    return table


FIRST_CODES = 0x3001  # most texts need no others


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points in one array and the offsets of the texts in it."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return codes, np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])


def run_starts(codes: np.ndarray, offsets: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """True where a class run or a text begins."""
    new = np.empty(len(codes), bool)
    if len(codes):
        np.not_equal(cls[1:], cls[:-1], out=new[1:])
        inner = offsets[:-1]
        new[inner[inner < len(codes)]] = True
    return new


def _contractions(codes, offsets, new, starts) -> None:
    """Let an apostrophe that begins a piece take s, t, m, d, re, ve or ll with it."""
    at = np.flatnonzero((codes == 39) & new & starts)
    at = at[at + 1 < len(codes)]
    if not len(at):
        return
    end = offsets[np.searchsorted(offsets, at, side="right")]
    at, end = at[at + 1 < end], end[at + 1 < end]
    second = codes[at + 1]
    third = codes[np.minimum(at + 2, len(codes) - 1)]
    third[at + 2 >= end] = 0
    short = np.isin(second, [ord(c) for c in "stmd"])
    long = (((second == ord("r")) | (second == ord("v"))) & (third == ord("e"))) \
        | ((second == ord("l")) & (third == ord("l")))
    for mask, size in ((short, 2), (long, 3)):
        hit = at[mask]
        starts[hit + 1] = False
        after = hit + size
        starts[after[after < len(codes)]] = True


def piece_bounds(codes: np.ndarray, offsets: np.ndarray, spaced: bool
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each piece.

    ``spaced``: pieces of the byte-level vocabularies, where one space joins the run behind it
    and other white space is a piece. Otherwise white space is dropped and each number
    character stands alone.
    """
    top = codes.max(initial=0)
    cls = (char_classes(FIRST_CODES) if top < FIRST_CODES else char_classes())[codes]
    starts = run_starts(codes, offsets, cls)
    new = starts.copy()
    if not len(codes):
        none = np.zeros(0, np.int64)
        return none, none, none
    space = cls == SPACE
    if spaced:
        first = np.zeros(len(codes) + 1, bool)
        first[offsets] = True
        last = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:-1])
        starts[last] = True
        starts[last[codes[last] == 32] + 1] = False
    else:
        starts |= cls == NUMBER
    _contractions(codes, offsets, new, starts)
    begin = np.flatnonzero(starts)
    end = np.append(begin[1:], len(codes))
    text = np.repeat(np.arange(len(offsets) - 1),
                     np.diff(np.searchsorted(begin, offsets)))
    if not spaced:
        keep = ~space[begin]
        begin, end, text = begin[keep], end[keep], text[keep]
    return begin, end, text


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def power(kind: str, size: int) -> np.ndarray:
    if len(_powers[kind]) < size:
        base = _BASE if kind == "up" else _INVERSE
        steps = np.full(max(size, 1 << 16), base, np.uint64)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps, dtype=np.uint64)
    return _powers[kind]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def span_hashes(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of ``values[begin:end]`` for each span, from one prefix sum."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * power("up", n)[:n], out=sums[1:])
    h = (sums[end] - sums[begin]) * power("down", n + 1)[begin]
    return mix(h + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def changes(*columns: np.ndarray) -> np.ndarray:
    """True where a sorted row differs from the one before it; the first row does."""
    out = np.ones(len(columns[0]), bool)
    if len(out) > 1:
        out[1:] = False
        for column in columns:
            out[1:] |= column[1:] != column[:-1]
    return out


class Pieces:
    """The pieces of one chunk as strings, in order."""

    def __init__(self, texts: list[str], spaced: bool):
        codes, offsets = code_points(texts)
        begin, end, self.text = piece_bounds(codes, offsets, spaced)
        whole = "".join(texts)
        self.strings = [whole[a:b] for a, b in zip(begin.tolist(), end.tolist())]
        self.n_texts = len(texts)

    def bounds(self) -> np.ndarray:
        """Where the pieces of each text begin, and the end."""
        return np.searchsorted(self.text, np.arange(self.n_texts + 1))


class Growing:
    """A numpy array that grows at its end."""

    def __init__(self, kind):
        self.held, self.size = np.zeros(1024, kind), 0

    def extend(self, values) -> None:
        values = np.asarray(values, self.held.dtype)
        if self.size + len(values) > len(self.held):
            larger = np.zeros(max(2 * len(self.held), self.size + len(values)), self.held.dtype)
            larger[:self.size] = self.held[:self.size]
            self.held = larger
        self.held[self.size:self.size + len(values)] = values
        self.size += len(values)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return self.held[at]


class PieceCache:
    """Numbers of pieces whose results are known, for the life of a Python worker.

    ``compute(strings)`` keeps the results of new pieces, in order; ``forget()`` drops all of
    them. Pieces are compared themselves, not by a hash. Above ``limit`` pieces or
    ``characters`` the cache starts anew: both bound memory only.
    """

    def __init__(self, compute, forget, limit: int = 1_000_000, characters: int = 1 << 26):
        self.compute, self.forget = compute, forget
        self.limit, self.characters = limit, characters
        self.numbers: dict[str, int] = {}
        self.held = 0

    def __call__(self, strings: list[str]) -> np.ndarray:
        if len(self.numbers) > self.limit or self.held > self.characters:
            self.numbers, self.held = {}, 0
            self.forget()
        known = list(map(self.numbers.get, strings))
        missing = list(dict.fromkeys(s for s, k in zip(strings, known) if k is None))
        if missing:
            self.compute(missing)
            self.numbers.update(zip(missing, range(len(self.numbers), len(self.numbers) + len(missing))))
            self.held += sum(map(len, missing))
            known = map(self.numbers.__getitem__, strings)
        return np.fromiter(known, np.int64, len(strings))
