"""Near-duplicate documents by consistent weighted sampling over TF-IDF shingles.

A shingle is five words; its weight is its count in the document times a damped inverse
document frequency over the whole corpus. Sketches are banded, documents that share a band
become candidates, and weighted Jaccard similarity decides.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portfolio_ops.llm import shared
from portfolio_ops.llm.graph import components
from portfolio_ops.llm.text import (
    LETTER, NUMBER, changes, char_classes, code_points, id_and_text, mix, run_starts, span_hashes)
from portfolio_ops.session import stage

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4
DAMPING = 0.25
BATCH_BYTES = 4 << 20
BLOCK_BYTES = 4 << 20   # of packed shingles in a block of a candidate group


def odd_numbers(count: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, count, np.uint64) * np.uint64(2) + np.uint64(1)


PLACE = odd_numbers(WORDS, 1)
SAMPLE = odd_numbers(BANDS * ROWS, 2)


def shingles(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, shingle and count of every distinct shingle of every text, in that order.

    Words are runs of letters and numbers, lower case. A text of fewer than ``words`` words has
    one shingle of all of them; a text without a word has none.
    """
    parts = []
    for a, b in shared.text_runs(texts):
        codes, offsets = code_points([t.lower() for t in texts[a:b]])
        # lower case may change lengths; offsets are of the lowered texts
        inside = np.isin(char_classes()[codes], (LETTER, NUMBER))
        edge = run_starts(codes, offsets, inside)
        begin = np.flatnonzero(edge & inside)
        stop = np.append(np.flatnonzero(edge), len(codes))
        end = stop[np.searchsorted(stop, begin, side="right")]
        word = span_hashes(codes, begin, end)
        owner = np.repeat(np.arange(b - a), np.diff(np.searchsorted(begin, offsets)))
        counts = np.bincount(owner, minlength=b - a)
        n = len(word)
        key = np.zeros(n, np.uint64)
        for k in range(min(words, n)):
            key[:n - k] += word[k:] * PLACE[k]
        last = np.cumsum(counts)[owner] if n else owner
        full = np.arange(n) + words <= last
        key = mix(key)
        short = np.flatnonzero((counts > 0) & (counts < words))
        if len(short):
            first = (np.cumsum(counts) - counts)[short]
            for at, doc in zip(first.tolist(), short.tolist()):
                size = counts[doc]
                key[at] = mix((word[at:at + size] * PLACE[:size]).sum(keepdims=True)
                              + np.uint64(size))[0]
                full[at] = True
        key, owner = key[full], owner[full]
        order = np.lexsort((key, owner))
        key, owner = key[order], owner[order]
        heads = np.flatnonzero(changes(owner, key)) if len(key) else np.zeros(0, np.int64)
        parts.append((owner[heads] + a, key[heads], np.diff(np.append(heads, len(key)))))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*parts))


def batch_keys(ids: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(shingles(texts)[1], return_counts=True)


def weights(tf: np.ndarray, df: np.ndarray, n_docs: int) -> np.ndarray:
    """Count times ``1 + DAMPING * ln(N / df) / ln N``.

    Damped, so that an edited word, whose shingles are rare, does not outweigh the text that a
    large group of copies has in common.
    """
    return tf * (1 + DAMPING * np.log(n_docs / df) / np.log(max(n_docs, 2)))


@lru_cache(maxsize=1)
def gamma_table() -> np.ndarray:
    """Quantiles of the gamma distribution of shape 2 at 65,536 even steps."""
    x = np.linspace(0, 40, 400_001)
    return np.interp((np.arange(65536) + 0.5) / 65536, 1 - (1 + x) * np.exp(-x), x)


def weighted_samples(keys: np.ndarray, weight: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Improved consistent weighted sampling: one hash for each document and sample.

    Document ``i`` has the shingles ``bounds[i]:bounds[i + 1]``, at least one. Two documents
    agree in a sample with a probability of their weighted Jaccard similarity.
    """
    table = gamma_table()
    logs = np.log(table)
    sizes = np.diff(bounds)
    log_weight = np.log(weight)
    low16 = np.uint64(0xFFFF)
    out = np.empty((len(sizes), len(SAMPLE)), np.uint64)
    for k, odd in enumerate(SAMPLE):
        z = keys * odd
        z ^= z >> np.uint64(29)
        z *= np.uint64(0xBF58476D1CE4E5B9)
        rate = table[(z >> np.uint64(48)).astype(np.int64)]
        shift = ((z >> np.uint64(16)) & low16).astype(np.float64) / 65536
        step = np.floor(log_weight / rate + shift)
        cost = logs[((z >> np.uint64(32)) & low16).astype(np.int64)] - rate * (step - shift) - rate
        least = np.minimum.reduceat(cost, bounds[:-1])
        at = np.flatnonzero(cost == np.repeat(least, sizes))
        at = at[np.searchsorted(at, bounds[:-1])]
        out[:, k] = mix(keys[at] + step[at].astype(np.int64).astype(np.uint64)
                        * np.uint64(0x9E3779B97F4A7C15))
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    parts = samples.reshape(len(samples), BANDS, ROWS) * SAMPLE[:ROWS]
    return mix(parts.sum(axis=2) + np.arange(BANDS, dtype=np.uint64) * SAMPLE[-1])


SKETCH = "doc_id long, digest binary, node long, bands array<long>, keys binary, tf binary, df binary"


def sketch_batch(ids: np.ndarray, texts: list[str], answers: pa.Table, count: int, n_docs: int,
                 similarity: float) -> pa.Table:
    """Sketches of a batch, one for each node. A link of weighted Jaccard ``similarity`` needs that share of a
    document's weight in shingles that another document has too, so only such documents get
    one; the others can have no link."""
    doc, key, tf = shingles(texts)
    distinct, number = np.unique(key, return_inverse=True)
    df = shared.apply_answers(distinct, answers, count)[number]
    weight = weights(tf, df, n_docs)
    total = np.bincount(doc, weight, len(texts))
    common = np.bincount(doc, weight * (df > 1), len(texts))
    chosen = np.flatnonzero((total > 0) & (common >= similarity * total * (1 - 1e-9)))
    take = np.isin(doc, chosen)
    doc, key, tf, df, weight = doc[take], key[take], tf[take], df[take], weight[take]
    bounds = np.searchsorted(doc, np.append(chosen, len(texts)))
    n = len(texts)
    node, bands = [None] * n, [None] * n
    packed: dict[str, list] = {"keys": [None] * n, "tf": [None] * n, "df": [None] * n}
    start, seen = 0, set()
    while start < len(chosen):
        stop = max(start + 1, int(np.searchsorted(bounds, bounds[start] + 50_000)))
        stop = min(stop, len(chosen))
        part = slice(bounds[start], bounds[stop])
        keys = band_keys(weighted_samples(key[part], weight[part],
                                          bounds[start:stop + 1] - bounds[start])).view(np.int64)
        for i in range(start, stop):
            own, at = slice(bounds[i], bounds[i + 1]), int(chosen[i])
            row = (shared.pack(key[own]), tf[own].astype("<u4").tobytes(),
                   df[own].astype("<u4").tobytes())
            node[at] = int.from_bytes(hashlib.blake2b(row[0] + row[1], digest_size=8).digest(),
                                      "little", signed=True)
            if node[at] in seen:        # a copy: the first of the batch tells the rest
                continue
            seen.add(node[at])
            bands[at] = keys[i - start].tolist()
            packed["keys"][at], packed["tf"][at], packed["df"][at] = row
        start = stop
    return pa.table({"doc_id": pa.array(ids, mask=ids == shared.NULL_ID),
                     "digest": pa.array([hashlib.sha256(t.encode()).digest() for t in texts], pa.binary()),
                     "node": pa.array(node, pa.int64()),
                     "bands": pa.array(bands, pa.list_(pa.int64())),
                     **{k: pa.array(v, pa.binary()) for k, v in packed.items()}})


def verify(table: pa.Table, n_docs: int, similarity: float) -> pa.Table:
    """Connected documents of two blocks (or one) of a candidate group.

    A document meets all of the other block at once through the shingles they share; one that
    is already connected with all of them needs no look. Gives a link to the smallest node.
    """
    first, second = table["i"][0].as_py(), table["j"][0].as_py()
    node = table["node"].to_numpy()
    block = table["part"].to_numpy()
    keys = [shared.unpack(x.as_py()) for x in table["keys"]]
    weight = np.concatenate([weights(np.frombuffer(t.as_py(), "<u4").astype(np.float64),
                                     np.frombuffer(d.as_py(), "<u4"), n_docs)
                             for t, d in zip(table["tf"], table["df"])])
    sizes = np.array([len(k) for k in keys])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(len(node)), sizes)
    total = np.add.reduceat(weight, bounds[:-1])
    _, number = np.unique(np.concatenate(keys), return_inverse=True)
    by_key = np.argsort(number, kind="stable")
    heads = np.searchsorted(number[by_key], np.arange(number.max() + 2))
    label = np.arange(len(node))
    lookers = np.flatnonzero(block == first)
    seen = block == second
    for a in lookers.tolist():
        if (label[seen] == label[a]).all():
            continue
        own = slice(bounds[a], bounds[a + 1])
        lists = number[own]
        n = heads[lists + 1] - heads[lists]
        at = by_key[np.arange(n.sum()) + np.repeat(heads[lists] - (np.cumsum(n) - n), n)]
        both = np.bincount(owner[at], np.minimum(weight[at], np.repeat(weight[own], n)), len(node))
        alike = both >= similarity * (total + total[a] - both) * (1 - 1e-12)
        for other in np.unique(label[alike & seen]):
            label[label == other] = label[a]
    names = np.full(len(node), np.iinfo(np.int64).max)
    np.minimum.at(names, label, node)
    root = names[label]
    linked = root != node
    return pa.table({"a": node[linked], "b": root[linked]})


@dataclass(frozen=True)
class Classes:
    """Rows with shingles and their class (the smallest node of it), and rows without shingles."""
    placed: DataFrame   # doc_id, digest, class
    alone: DataFrame    # doc_id, digest


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, batch_bytes: int = BATCH_BYTES,
                    block: int = 512) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, class_id, kept``.

    ``class_id`` is the smallest ``doc_id`` connected by links of weighted Jaccard similarity
    of at least ``similarity``; ``kept`` says that it is the row's own. Texts of equal weighted
    shingles are one node from the start. Candidates are connected by a link from each node to
    the smallest of its bands, a candidate group is verified in pairs of blocks of about
    ``block`` nodes, so that neither a band nor a group meets in one task.

    Null, empty and wordless texts are alone in their class. A null ``doc_id`` may be in a
    class but does not name it (alone, its class is null and it is kept). Rows that repeat an
    id share its decision. Other columns are ignored; no rows give no rows.
    """
    found = document_classes(docs, similarity, batch_bytes, block)
    named = found.placed.groupBy("class").agg(F.min("doc_id").alias("class_id"))
    alone = found.alone.select("doc_id", F.col("doc_id").alias("class_id"))
    return found.placed.join(named, "class").select("doc_id", "class_id").union(alone) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"),
                                       F.col("class_id").isNull()))


def document_classes(docs: DataFrame, similarity: float = SIMILARITY, batch_bytes: int = BATCH_BYTES,
                     block: int = 512) -> Classes:
    rows = id_and_text(docs)
    n_docs, total = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    batches = max(1, -(-(total or 0) // batch_bytes))
    count = shared.range_count(batches)
    batched = shared.in_batches(rows, batches)
    known = shared.shared_keys(batched, batch_keys, count)

    def sketch(table: pa.Table, answers: pa.Table) -> pa.Table:
        return sketch_batch(*shared.sorted_batch(table), answers, count, n_docs, similarity)

    sketches = stage(batched.groupBy("batch").cogroup(known.groupBy("batch"))
                     .applyInArrow(sketch, SKETCH), "sketches")
    members = sketches.where("node is not null")
    nodes = members.where("keys is not null")   # a row of each node from each batch that has it
    bands = nodes.select("node", "bands").dropDuplicates(["node"]) \
        .select("node", F.explode("bands").alias("band"))
    smallest = bands.groupBy("band").agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("n")) \
        .where("n > 1")
    groups = components(bands.join(smallest, "band").where("node != b")
                        .select(F.col("node").alias("a"), "b"))
    sizes = nodes.select("node", F.octet_length("keys").alias("bytes")).dropDuplicates(["node"]) \
        .join(groups, "node")
    parts = sizes.groupBy("component").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("parts"))
    # a node's block meets every block of its group, itself included
    dealt = nodes.select("node", "keys", "tf", "df").join(groups, "node") \
        .dropDuplicates(["node"]).join(parts, "component") \
        .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))) \
        .withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other")) \
        .select("component", "i", "j", "part", "node", "keys", "tf", "df")
    links = dealt.groupBy("component", "i", "j").applyInArrow(
        lambda table: verify(table, n_docs, similarity), "a long, b long")
    classes = components(links)
    placed = members.select("doc_id", "digest", "node").join(classes, "node", "left") \
        .select("doc_id", "digest", F.coalesce("component", "node").alias("class"))
    return Classes(placed, sketches.where("node is null").select("doc_id", "digest"))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each class one row stays, that of the smallest
    ``doc_id`` (a null id is larger than every id), of those the smallest digest of the text.

    Rows are told apart by id and text, so a row with another text under the same id is judged
    on its own. Of rows that repeat both one stays, unless the text has no words. All columns are kept.
    """
    placed = document_classes(docs, similarity).placed
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    best = placed.groupBy("class").agg(F.min(rank).alias("best"))
    gone = placed.join(best, "class").where(~rank.eqNullSafe(F.col("best"))) \
        .select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct()
    repeated = placed.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1") \
        .select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))
    names = [f"c{k}" for k in range(len(docs.columns))]
    place = dict(zip(docs.columns, names))
    rows = docs.toDF(*names).withColumn("_own", F.unhex(F.sha2(
        F.coalesce(place["text"], F.lit("")), 256)))
    same = F.col(place["doc_id"]).cast("long").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_digest"))
    left = rows.join(gone, same, "left_anti")
    once = left.join(repeated, same, "left_semi").dropDuplicates([place["doc_id"], "_own"])
    return left.join(repeated, same, "left_anti").unionByName(once).select(*names).toDF(*docs.columns)
