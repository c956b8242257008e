"""Byte-pair encoding from a vocabulary file: encode and decode, and token counts.

Two encoders share the vocabulary. ``encode`` uses a priority queue of merge ranks over a
doubly linked symbol list. ``count_pieces`` merges many pieces at once in ragged numpy
arrays, one rank per piece and step. Both work on distinct pieces only; equal pieces of a
worker are looked up.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from portfolio_ops.llm.text import Growing, PieceCache, Pieces, chunks, id_and_text


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others for U+0100 onwards.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Vocabulary:
    """Merges, ids and settings of a ``tokenizers`` BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.spaced = not self.suffix
        self.strings = {i: s for s, i in self.ids.items()} | {
            i: s for s, i in self.specials.items()}
        self.size = max(self.strings) + 1
        self.split = re.compile("(" + "|".join(
            re.escape(s) for s in sorted(self.specials, key=len, reverse=True)) + ")") \
            if self.specials else None
        self.merges: dict[int, tuple[int, int]] = {}
        made: dict[int, int] = {}
        self.ordered = True
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right, new = self.ids[a], self.ids[b], self.ids[a + b]
            self.merges[left * self.size + right] = (rank, new)
            made.setdefault(new, rank)
            self.ordered &= made.get(left, -1) < rank and made.get(right, -1) < rank
        chars = byte_characters()
        self.first = np.array([self.ids[c] for c in chars], np.int64)
        self.last = np.array([self.ids[c + self.suffix] for c in chars], np.int64)

    def normal(self, text: str) -> str:
        """The text as the vocabulary sees it: word vocabularies compose and lower it."""
        if self.spaced:
            return text
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def segments(self, texts: list[str]) -> tuple[list[str], list[list]]:
        """Texts cut at special strings: the normal segments, and for each text its parts in
        order, a segment number or a special id."""
        parts, layout = [], []
        for text in texts:
            row: list = []
            pieces = self.split.split(text) if self.split and "<" in text else [text]
            for k, piece in enumerate(pieces):
                if k % 2:
                    row.append(("id", self.specials[piece]))
                else:
                    row.append(("text", len(parts)))
                    parts.append(self.normal(piece))
            layout.append(row)
        return parts, layout

    def symbols(self, piece: str) -> list[int]:
        raw = piece.encode("utf-8")
        return [*self.first[list(raw[:-1])].tolist(), int(self.last[raw[-1]])]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(symbols: list[int], vocab: Vocabulary) -> list[int]:
    """Ids of one piece. The queue holds (rank, place, left, right); an entry whose symbols
    have changed since is skipped."""
    n, merges, size = len(symbols), vocab.merges, vocab.size
    if n < 2:
        return symbols
    sym = list(symbols)
    after, before = [*range(1, n), -1], list(range(-1, n - 1))
    queue = []
    for i in range(n - 1):
        found = merges.get(sym[i] * size + sym[i + 1])
        if found:
            queue.append((found[0], i, sym[i], sym[i + 1], found[1]))
    heapq.heapify(queue)
    while queue:
        _, i, left, right, new = heapq.heappop(queue)
        j = after[i]
        if sym[i] != left or j < 0 or sym[j] != right:
            continue
        sym[i], sym[j] = new, -1
        k = after[i] = after[j]
        if k >= 0:
            before[k] = i
            found = merges.get(new * size + sym[k])
            if found:
                heapq.heappush(queue, (found[0], i, new, sym[k], found[1]))
        h = before[i]
        if h >= 0:
            found = merges.get(sym[h] * size + new)
            if found:
                heapq.heappush(queue, (found[0], h, sym[h], new, found[1]))
    return [s for s in sym if s >= 0]


class Coder:
    """Encodes and decodes chunks of texts, remembering pieces."""

    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        self.cache = PieceCache(self._pieces, self._forget, 500_000)
        self._forget()

    def _forget(self) -> None:
        self.counts, self.ids, self.decoded = Growing(np.int64), Growing(object), Growing(object)

    def _pieces(self, strings: list[str]) -> None:
        found = [encode(self.vocab.symbols(s), self.vocab) for s in strings]
        self.counts.extend([len(ids) for ids in found])
        self.ids.extend([" ".join(map(str, ids)) for ids in found])
        self.decoded.extend([self.decode(ids) for ids in found])

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings one after another, parted by a space as the file has no decoder."""
        return " ".join([self.vocab.strings[i] for i in ids])

    def texts(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """For each text: number of ids, the ids as text, the decoded text."""
        vocab = self.vocab
        parts, layout = vocab.segments(texts)
        pieces = Pieces(parts, vocab.spaced)
        number = self.cache(pieces.strings)
        bounds = pieces.bounds()
        for row in layout:
            n, id_parts, text_parts = 0, [], []
            for kind, value in row:
                if kind == "id":
                    n += 1
                    id_parts.append(str(value))
                    text_parts.append(vocab.strings[value])
                    continue
                span = number[bounds[value]:bounds[value + 1]]
                if len(span):
                    n += int(self.counts[span].sum())
                    id_parts.extend(self.ids[span])
                    text_parts.extend(self.decoded[span])
            yield n, " ".join(id_parts), " ".join(text_parts)


@lru_cache(maxsize=4)
def coder(path: str) -> Coder:
    return Coder(path)


def bpe_round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode every whole text and decode it again.

    ``path`` is a BPE file of the ``tokenizers`` format without a decoder. Returns
    ``doc_id, n_tokens, ids`` (decimal, parted by a space) and ``decoded``. Null and empty
    texts have no ids and decode to an empty text; a null or repeated ``doc_id`` is passed
    through, one row per input row; other columns are ignored.
    """
    return id_and_text(docs).mapInArrow(
        _rows(path, lambda n, ids, text: (n, ids, text), pa.string()),
        "doc_id long, n_tokens long, ids string, decoded string")


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """``bpe_round_trip`` with SHA-256 digests made in the same pass: ``doc_id, n_tokens,
    ids_sha256, decoded_sha256``. No long text leaves the task."""
    def digest(n, ids, text):
        return (n, hashlib.sha256(ids.encode()).hexdigest(),
                hashlib.sha256(text.encode()).hexdigest())
    return id_and_text(docs).mapInArrow(
        _rows(path, digest, pa.string()),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _rows(path, finish, kind):
    def run(batches):
        own = coder(path)
        names = None
        for ids, texts in chunks(batches):
            rows = [finish(*row) for row in own.texts(texts)]
            columns = [ids, pa.array([r[0] for r in rows], pa.int64()),
                       pa.array([r[1] for r in rows], kind), pa.array([r[2] for r in rows], kind)]
            names = names or ["doc_id", "n_tokens", "a", "b"]
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


NO_RANK = np.iinfo(np.int64).max


class PairTable:
    """Sorted merge keys for vectorized rank look-up."""

    def __init__(self, vocab: Vocabulary):
        keys = np.fromiter(vocab.merges, np.int64, len(vocab.merges))
        values = np.array(list(vocab.merges.values()), np.int64).reshape(-1, 2)
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], values[order, 0], values[order, 1]
        self.size = vocab.size

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (``NO_RANK`` if it has none) and the symbol it becomes."""
        if not len(self.keys):
            return np.full(len(left), NO_RANK), np.zeros(len(left), np.int64)
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NO_RANK), self.made[at]


def merge_synchronously(flat: np.ndarray, owner: np.ndarray, n: int, table: PairTable,
                        all_places: bool = True, finished: list | None = None) -> np.ndarray:
    """Symbols left of each of ``n`` sequences.

    ``flat`` holds the sequences one after another, ``owner`` the sequence of each symbol. A
    step finds the lowest rank of every sequence and merges its pair at every place at once,
    from the left where places overlap (``all_places``; else at the first place only). That
    equals merging one by one as long as a pair has a higher rank than the pairs that made
    its parts. Sequences without a pair leave the arrays; ``finished`` takes them as pairs
    (owner, symbols).
    """
    left_over = np.bincount(owner, minlength=n).astype(np.int64)
    rank, made = _ranks(flat, owner, table)
    while len(flat):
        heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        sizes = np.diff(np.append(heads, len(flat)))
        lowest = np.minimum.reduceat(rank, heads)
        live = np.repeat(lowest < NO_RANK, sizes)
        if not live.all():
            if finished is not None:
                finished.append((owner[~live], flat[~live]))
            flat, owner, rank, made = flat[live], owner[live], rank[live], made[live]
            lowest, sizes = lowest[lowest < NO_RANK], sizes[lowest < NO_RANK]
            if not len(flat):
                break
        hit = rank == np.repeat(lowest, sizes)
        at = np.flatnonzero(hit)
        if all_places:
            # places one apart overlap: of such a run take every second one
            run = np.flatnonzero(np.append(True, np.diff(at) > 1))
            offset = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
            at = at[offset % 2 == 0]
        else:
            at = at[np.append(True, owner[at[1:]] != owner[at[:-1]])]
        left_over -= np.bincount(owner[at], minlength=n)
        flat[at] = made[at]
        keep = np.ones(len(flat), bool)
        keep[at + 1] = False
        place = np.cumsum(keep) - 1
        flat, owner, rank, made = flat[keep], owner[keep], rank[keep], made[keep]
        changed = place[at]
        changed = np.unique(np.concatenate([changed, np.maximum(changed - 1, 0)]))
        inner = changed[(changed + 1 < len(flat))]
        inner = inner[owner[inner] == owner[inner + 1]]
        rank[changed] = NO_RANK
        rank[inner], made[inner] = table.find(flat[inner], flat[inner + 1])
    return left_over


def _ranks(flat, owner, table):
    rank, made = np.full(len(flat), NO_RANK), np.zeros(len(flat), np.int64)
    inner = np.flatnonzero(owner[1:] == owner[:-1])
    rank[inner], made[inner] = table.find(flat[inner], flat[inner + 1])
    return rank, made


BATCH_BYTES = 1 << 20


def merged_batches(strings: list[str], vocab: Vocabulary, table: PairTable, symbols: bool = False
                   ) -> Iterator[tuple[np.ndarray | None, np.ndarray]]:
    """Rank-synchronous merging of pieces, about ``BATCH_BYTES`` at a time: the symbols of all
    pieces one after another (None unless ``symbols``) and the number of each."""
    def merge(raws: list[bytes]):
        values = np.frombuffer(b"".join(raws), np.uint8)
        sizes = np.array([len(r) for r in raws], np.int64)
        flat = vocab.first[values]
        ends = np.cumsum(sizes) - 1
        flat[ends] = vocab.last[values[ends]]
        owner = np.repeat(np.arange(len(raws)), sizes)
        finished: list | None = [] if symbols else None
        counts = merge_synchronously(flat, owner, len(raws), table, vocab.ordered, finished)
        if not symbols:
            return None, counts
        owners = np.concatenate([f[0] for f in finished])
        return np.concatenate([f[1] for f in finished])[np.argsort(owners, kind="stable")], counts

    batch, held = [], 0
    for s in strings:
        raw = s.encode("utf-8")
        batch.append(raw)
        held += len(raw)
        if held >= BATCH_BYTES:
            yield merge(batch)
            batch, held = [], 0
    if batch:
        yield merge(batch)


class Counter:
    """Token counts of chunks of texts."""

    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        self.table = PairTable(self.vocab)
        self.cache = PieceCache(self._pieces, self._forget)
        self._forget()

    def _forget(self) -> None:
        self.counts = Growing(np.int64)

    def _pieces(self, strings: list[str]) -> None:
        for _, counts in merged_batches(strings, self.vocab, self.table):
            self.counts.extend(counts)

    def count_pieces(self, strings: list[str]) -> list[int]:
        return [n for _, counts in merged_batches(strings, self.vocab, self.table)
                for n in counts.tolist()]

    def texts(self, texts: list[str]) -> np.ndarray:
        parts, layout = self.vocab.segments(texts)
        pieces = Pieces(parts, self.vocab.spaced)
        number = self.cache(pieces.strings)
        sums = np.concatenate([[0], np.cumsum(self.counts[number])])
        each = np.diff(sums[pieces.bounds()])
        return np.array([sum(1 if kind == "id" else int(each[v]) for kind, v in row)
                         for row in layout], np.int64)


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """Bytes and tokens of every whole text: ``doc_id, n_bytes, n_tokens, over_limit``.

    A special string inside a text is one token. Null and empty texts have 0 bytes and 0
    tokens; a null or repeated ``doc_id`` is passed through, one row per input row; other
    columns are ignored.
    """
    def run(batches):
        own = counter(path)
        for ids, texts in chunks(batches):
            tokens = own.texts(texts)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
                 pa.array(tokens), pa.array(tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return id_and_text(docs).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
