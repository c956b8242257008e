"""Keys that documents of a corpus share, counted without a row for every key.

Documents are dealt by the hash of their id into batches of a few megabytes of text. A batch
turns its keys (64-bit hashes) into sorted runs, one for each key range, and only those runs
are shuffled. The task of a key range counts over all runs and answers each of them with the
keys that other documents have too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portfolio_ops.llm.text import release_memory



def n_batches(docs: DataFrame, batch_bytes: int) -> int:
    """Batches of about ``batch_bytes`` bytes of ``text``."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-total // batch_bytes))


def in_batches(docs: DataFrame, batches: int) -> DataFrame:
    """``batch, doc_id, text`` and what else ``docs`` has (``carried``), shuffled by batch. Every
    reader of it shares one exchange. A row without id is dealt by its text.
    """
    dealt_by = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    return docs.withColumn("batch", F.pmod(dealt_by, F.lit(batches)).cast("int")) \
        .repartition(max(1, min(batches, 1 << 16)), "batch")


NULL_ID = np.iinfo(np.int64).max


def in_order(table: pa.Table) -> pa.Table:
    """A batch in an order that does not depend on the shuffle; null ids are last."""
    release_memory()
    return table.append_column("order", pc.fill_null(table["doc_id"], int(NULL_ID))) \
        .sort_by([("order", "ascending"), ("text", "ascending")])


def sorted_batch(table: pa.Table) -> tuple[np.ndarray, list[str]]:
    """Ids and texts of a batch in order. A null id compares as larger than every id."""
    table = in_order(table.select(["doc_id", "text"]))
    return table["order"].to_numpy().astype(np.int64), table["text"].to_pylist()


def text_runs(texts: list[str], limit: int = 1 << 19) -> Iterable[tuple[int, int]]:
    """Ranges of texts of about ``limit`` characters; a text is never cut."""
    start, held = 0, 0
    for k, text in enumerate(texts):
        if k > start and held + len(text) > limit:
            yield start, k
            start, held = k, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def pack(keys: np.ndarray) -> bytes:
    """Sorted keys as differences of as few bytes as the largest needs."""
    if not len(keys):
        return b""
    steps = np.diff(keys)
    width = (int(steps.max(initial=0)).bit_length() + 7) // 8 or 1
    raw = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + keys[:1].astype("<u8").tobytes() + raw.tobytes()


def unpack(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, np.uint64)
    width = raw[0]
    body = np.frombuffer(raw, np.uint8, offset=9).reshape(-1, width)
    steps = np.zeros((len(body), 8), np.uint8)
    steps[:, :width] = body
    first = np.frombuffer(raw, "<u8", 1, 1)
    return np.cumsum(np.concatenate([first, steps.view("<u8").ravel()]), dtype=np.uint64)


def ranges(keys: np.ndarray, count: int) -> np.ndarray:
    """Key range of each key, in key order."""
    return (((keys >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)).astype(np.int64)


def range_bounds(keys: np.ndarray, count: int) -> np.ndarray:
    return np.searchsorted(ranges(keys, count), np.arange(count + 1))


RUN = "batch int, range int, keys binary, several binary"
ANSWER = "batch int, range int, shared binary, totals binary"


def key_runs(batch: int, keys: np.ndarray, counts: np.ndarray, count: int) -> pa.Table:
    """Runs of a batch's distinct sorted keys and the number of its documents that have each.
    Counts above one are listed as (place, count)."""
    bounds = range_bounds(keys, count)
    rows = []
    for r in np.flatnonzero(np.diff(bounds)).tolist():
        own = counts[bounds[r]:bounds[r + 1]]
        at = np.flatnonzero(own > 1)
        several = np.stack([at, own[at]]).astype("<u4").tobytes()
        rows.append((r, pack(keys[bounds[r]:bounds[r + 1]]), several))
    return pa.table({"batch": pa.array([batch] * len(rows), pa.int32()),
                     "range": pa.array([r[0] for r in rows], pa.int32()),
                     "keys": pa.array([r[1] for r in rows], pa.binary()),
                     "several": pa.array([r[2] for r in rows], pa.binary())})


def answer_range(table: pa.Table) -> pa.Table:
    """For every run of one key range: a bit for each key that more than one document has,
    and how many documents have those."""
    runs = [unpack(x.as_py()) for x in table["keys"]]
    counts = []
    for run, several in zip(runs, table["several"]):
        own = np.ones(len(run), np.int64)
        at, value = np.frombuffer(several.as_py(), "<u4").reshape(2, -1)
        own[at] = value
        counts.append(own)
    _, number = np.unique(np.concatenate(runs), return_inverse=True)
    total = np.bincount(number, np.concatenate(counts)).astype(np.int64)[number]
    ends = np.cumsum([len(r) for r in runs])
    shared, totals = [], []
    for part in np.split(total, ends[:-1]):
        shared.append(np.packbits(part > 1).tobytes())
        totals.append(part[part > 1].astype("<u4").tobytes())
    return pa.table({"batch": table["batch"].cast(pa.int32()),
                     "range": table["range"].cast(pa.int32()),
                     "shared": pa.array(shared, pa.binary()),
                     "totals": pa.array(totals, pa.binary())})


def shared_keys(batched: DataFrame, keys_of: Callable, count: int) -> DataFrame:
    """Answers for every batch of ``batched``; ``keys_of(ids, texts)`` gives its distinct
    sorted keys and document counts."""
    def runs(table: pa.Table) -> pa.Table:
        keys, counts = keys_of(*sorted_batch(table))
        return key_runs(table["batch"][0].as_py(), keys, counts, count)
    found = batched.groupBy("batch").applyInArrow(runs, RUN)
    return found.groupBy("range").applyInArrow(answer_range, ANSWER)


def apply_answers(keys: np.ndarray, answers: pa.Table, count: int) -> np.ndarray:
    """Number of documents of the corpus that have each of a batch's keys, for keys in the
    order of ``key_runs``: 1 where no other document has it."""
    total = np.ones(len(keys), np.int64)
    bounds = range_bounds(keys, count)
    for r, shared, totals in zip(answers["range"].to_pylist(), answers["shared"].to_pylist(),
                                 answers["totals"].to_pylist()):
        size = bounds[r + 1] - bounds[r]
        bits = np.unpackbits(np.frombuffer(shared, np.uint8), count=size).astype(bool)
        total[bounds[r]:bounds[r + 1]][bits] = np.frombuffer(totals, "<u4")
    return total


def range_count(batches: int) -> int:
    """Key ranges: two for each batch up to 4,096, so that a run stays worth a row; beyond
    262,144 batches one for each 64 batches, at most 65,536."""
    return min(1 << 16, max(min(2 * batches, 1 << 12), batches // 64))
