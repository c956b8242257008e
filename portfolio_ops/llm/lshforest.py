"""Approximate nearest neighbours by a forest of hash prefixes.

Largest inner product becomes smallest angle by one more coordinate. A tree is a sorted array
of long hash strings, the sides of random planes. A query starts at its longest matching
prefix and shortens it in all trees at once until enough different vectors share it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from portfolio_ops.llm.vectors import matrix, usable_rows

BITS = 24


@dataclass(frozen=True)
class ForestSettings:
    """``share`` of a shard's vectors a query looks at (at least ``least``) in ``trees`` trees.
    The share sets the recall and is the same at every size."""
    trees: int = 128
    share: float = 0.4
    least: int = 256
    shard_rows: int = 8192
    query_rows: int = 4096
    seed: int = 11


class Forest:
    """Sorted hash strings of one shard."""

    def __init__(self, vectors: np.ndarray, settings: ForestSettings):
        self.settings = settings
        self.largest = np.linalg.norm(vectors, axis=1).max()
        unit = vectors / self.largest
        rest = np.sqrt(np.maximum(0, 1 - (unit ** 2).sum(axis=1)))
        rng = np.random.default_rng(settings.seed)
        self.planes = rng.standard_normal((vectors.shape[1] + 1, settings.trees * BITS))
        codes = self._codes(np.column_stack([unit, rest]))
        self.order = np.argsort(codes, axis=0, kind="stable")
        self.codes = np.take_along_axis(codes, self.order, axis=0)
        self.n = len(vectors)

    def _codes(self, points: np.ndarray) -> np.ndarray:
        sides = (points @ self.planes > 0).reshape(len(points), self.settings.trees, BITS)
        return sides @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))

    def candidates(self, queries: np.ndarray):
        """For each query the shard rows under its prefixes."""
        s = self.settings
        unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        codes = self._codes(np.column_stack([unit, np.zeros(len(unit))]))
        wanted = min(self.n, max(s.least, math.ceil(s.share * self.n)))
        low = np.empty((BITS + 1, s.trees, len(queries)), np.int64)
        high = np.empty_like(low)
        for depth in range(BITS + 1):
            step = np.int64(1) << (BITS - depth)
            base = codes // step * step
            for t in range(s.trees):
                low[depth, t] = np.searchsorted(self.codes[:, t], base[:, t])
                high[depth, t] = np.searchsorted(self.codes[:, t], base[:, t] + step)
        reached = (high - low).sum(axis=1)
        marked = np.zeros(self.n, bool)
        for k in range(len(queries)):
            marked[:] = False
            # fewer entries than wanted cannot hold enough different rows
            depth = int(np.flatnonzero(reached[:, k] >= wanted)[-1])
            while True:
                for t in range(s.trees):
                    marked[self.order[low[depth, t, k]:high[depth, t, k], t]] = True
                found = np.flatnonzero(marked)
                if len(found) >= wanted or depth == 0:
                    yield found
                    break
                depth -= 1


def _search(left: pd.DataFrame, right: pd.DataFrame, k: int, settings: ForestSettings
            ) -> pd.DataFrame:
    """Best ``k`` of one shard for one block of queries."""
    names = ["query_id", "vec_id", "score"]
    if left.empty or right.empty:
        return pd.DataFrame({n: [] for n in names})
    left = left.sort_values("vec_id", kind="stable")
    ids, vectors = left["vec_id"].to_numpy(), matrix(left["vector"])
    queries = matrix(right["vector"])
    rows = []
    for query, vector, at in zip(right["vec_id"].to_numpy(), queries,
                                 Forest(vectors, settings).candidates(queries)):
        at = at[ids[at] != query]
        score = vectors[at] @ vector
        if len(at) > k:
            bound = np.partition(score, -k)[-k]
            near = score >= bound - 1e-9 * max(1.0, abs(bound))
            at, score = at[near], score[near]
        score = np.array([math.fsum(vectors[i] * vector) for i in at])
        best = np.lexsort((ids[at], -score))[:k]
        rows.append((np.full(len(best), query), ids[at[best]], score[best]))
    return pd.DataFrame({n: np.concatenate([r[i] for r in rows]) for i, n in enumerate(names)})


def nearest(table: DataFrame, every: int = 20, k: int = 20,
            settings: ForestSettings = ForestSettings()) -> DataFrame:
    """The ``k`` rows of largest inner product found for each query.

    Queries are the rows whose ``vec_id`` is divisible by ``every``; candidates are all other
    ids. All rows are indexed: shards of about ``shard_rows`` vectors, dealt by hash, each
    with its own forest, meet every block of queries, so a task holds one shard and one block.
    Returns ``query_id, rank, vec_id, score`` (double precision on the vectors as given),
    nearest first, ties to the smaller ``vec_id``.

    Null, zero and non-finite vectors, null ids and empty tables give no rows. Vectors of
    different lengths never meet. Repeated rows are candidates one by one, a repeated query
    id answers once per distinct row.
    """
    rows = usable_rows(table)
    sizes = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    shards = max(1, -(-sizes[0] // settings.shard_rows))
    blocks = max(1, -(-sizes[1] // settings.query_rows))

    def dealt(name: str, parts: int):
        return F.pmod(F.xxhash64("vec_id", F.lit(name)), F.lit(parts)).cast("int").alias(name)

    def spread(name: str, parts: int):
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias(name)

    left = rows.select("*", dealt("shard", shards), spread("block", blocks))
    right = rows.where(F.col("vec_id") % every == 0).distinct() \
        .select("*", dealt("block", blocks), spread("shard", shards))
    keys = ["dims", "shard", "block"]
    found = left.groupBy(keys).cogroup(right.groupBy(keys)).applyInPandas(
        lambda a, b: _search(a, b, k, settings),
        T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()),
                      T.StructField("score", T.DoubleType())]))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
