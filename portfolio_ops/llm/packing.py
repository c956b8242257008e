"""Packing of documents into token sequences of one length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portfolio_ops.llm.bpe import PairTable, merged_batches, vocabulary
from portfolio_ops.llm.text import Growing, PieceCache, Pieces, chunks, id_and_text
from portfolio_ops.session import stage

END_ID = 0


class BulkCoder:
    """Ids as the ``tokenizers`` library gives them, made in bulk for the new pieces of a chunk.

    Merges never cross a piece, so the ids of a text are those of its pieces in order.
    """

    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        self.table = PairTable(self.vocab)
        self.cache = PieceCache(self._pieces, self._forget)
        self._forget()

    def _forget(self) -> None:
        self.ids, self.heads, self.sizes = Growing(np.uint32), Growing(np.int64), Growing(np.int64)

    def _pieces(self, strings: list[str]) -> None:
        for ids, counts in merged_batches(strings, self.vocab, self.table, symbols=True):
            self.heads.extend(self.ids.size + np.cumsum(counts) - counts)
            self.sizes.extend(counts)
            self.ids.extend(ids)

    def texts(self, texts: list[str]) -> Iterator[np.ndarray]:
        parts, layout = self.vocab.segments(texts)
        pieces = Pieces(parts, self.vocab.spaced)
        number = self.cache(pieces.strings)
        counts = self.sizes[number]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.arange(total) + np.repeat(self.heads[number] - (ends - counts), counts)]
        bounds = np.concatenate([[0], ends])[pieces.bounds()]
        for row in layout:
            yield np.concatenate([np.array([v], np.uint32) if kind == "id"
                                  else ids[bounds[v]:bounds[v + 1]] for kind, v in row])


@lru_cache(maxsize=2)
def bulk_coder(path: str) -> BulkCoder:
    return BulkCoder(path)


class Tournament:
    """Free space of bins in a tournament tree; each inner node holds the larger of two."""

    def __init__(self, n: int):
        self.leaves = 1 << max(0, (n - 1).bit_length())
        self.best = [0] * (2 * self.leaves)
        self.used = 0

    def set(self, leaf: int, free: int) -> None:
        best, i = self.best, leaf + self.leaves
        best[i] = free
        while i > 1:
            i >>= 1
            best[i] = max(best[2 * i], best[2 * i + 1])

    def place(self, size: int, capacity: int) -> tuple[int, int]:
        """First bin with room, else a new one, and the offset inside it."""
        best = self.best
        if best[1] < size:
            leaf, free = self.used, capacity
            self.used += 1
        else:
            i = 1
            while i < self.leaves:
                i *= 2
                if best[i] < size:
                    i += 1
            leaf, free = i - self.leaves, best[i]
        self.set(leaf, free - size)
        return leaf, capacity - free


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[tuple[int, int]]:
    """Bin and offset of each size; ``sizes`` come largest first."""
    tree = Tournament(len(sizes))
    return [tree.place(size, capacity) for size in sizes]


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def document_pieces(docs: DataFrame, path: str, capacity: int = 1024) -> DataFrame:
    """Each document's ids and the end id cut every ``capacity`` ids: ``task, place`` (of the
    document), ``doc_id, start, length, ids_crc32, doc_tokens``. A null or empty text is one
    piece, the end id."""
    def run(batches):
        own, task, place = bulk_coder(path), TaskContext.get().partitionId(), 0
        for doc_ids, texts in chunks(batches):
            rows, out = [], []
            for k, ids in enumerate(own.texts(texts)):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4", copy=False)
                n = len(ids)
                for start in range(0, n, capacity):
                    part = ids[start:start + capacity]
                    rows.append(k)
                    out.append((start, len(part), zlib.crc32(part.tobytes()), n))
            columns = np.array(out, np.int64).reshape(-1, 4)
            at = np.array(rows, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), task)), pa.array(at + place), doc_ids.take(pa.array(at)),
                 *(pa.array(np.ascontiguousarray(c)) for c in columns.T)],
                names=["task", "place", "doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            place += len(texts)
    return id_and_text(docs).mapInArrow(run, f"task long, place long, {PIECE}")


def pack(docs: DataFrame, path: str, capacity: int = 1024, group_pieces: int = 8192) -> DataFrame:
    """Sequences of at most ``capacity`` ids, first-fit decreasing in random groups of documents.

    Whole documents are dealt by hash, one group for ``group_pieces`` pieces; more or longer
    documents make more groups. A group numbers its sequences from the group number times
    2**32. Returns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.
    Ties go by ``doc_id`` and ``start``. A null or repeated ``doc_id`` is passed through:
    each input row is a document of its own. No documents give no rows.

    The pieces are staged, as their number must be known before they are dealt.
    """
    pieces = stage(document_pieces(docs, path, capacity), "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn("bin_group", F.pmod(
        F.xxhash64("doc_id", "task", "place"), F.lit(groups)).cast("long"))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start", "ids_crc32", "task", "place"],
                              ascending=[False, True, True, True, True, True], kind="stable")
        placed = np.array(first_fit_decreasing(pdf["length"].tolist(), capacity),
                          np.int64).reshape(-1, 2)
        pdf["sequence_id"] = (pdf["bin_group"].to_numpy() << 32) + placed[:, 0]
        pdf["offset"] = placed[:, 1]
        return pdf.drop(columns=["bin_group", "task", "place"]).astype({"doc_id": "Int64"})

    return dealt.groupBy("bin_group").applyInPandas(fill, f"{PIECE}, sequence_id long, offset long")
