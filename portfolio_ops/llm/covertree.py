"""All pairs of vectors within a cosine threshold, by dual traversal of cover trees.

Levels halve their radius. A node of a level covers its points within that radius, its
children lie more than the next radius apart and include its own centre. Two nodes are looked
at together: too far apart for their covering radii, their pairs are dropped; near enough,
all are links; otherwise their children meet. Only leaves compare vectors, exactly.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portfolio_ops.llm.graph import components
from portfolio_ops.llm.vectors import matrix, usable, usable_rows
from portfolio_ops.session import stage

LEAF = 8
SLACK = 1e-6  # chord lengths near 0 are known to about 1e-8
# numbers of each side that are gathered to compare small leaves together, and the vectors of a leaf pair that is not
GATHERED, LARGE_LEAVES = 1 << 22, 4096


@dataclass
class CoverTree:
    """Points in tree order; node ``i`` covers points ``first[i]:last[i]``."""
    ids: np.ndarray
    copies: np.ndarray
    vectors: np.ndarray
    centre: np.ndarray
    cover: np.ndarray
    first: np.ndarray
    last: np.ndarray
    child: list

    @property
    def unit(self) -> np.ndarray:
        return self.vectors / np.linalg.norm(self.vectors, axis=1, keepdims=True)


def chord(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * cosine))


def build(ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray) -> CoverTree:
    """Top-down: each node is cut by farthest-first centres at the largest halved radius
    below its cover."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    order = np.arange(len(ids))
    centre, cover, first, last, child = [], [], [], [], []

    def add(c: int, a: int, b: int, distance: np.ndarray) -> int:
        centre.append(c), cover.append(float(distance.max())), first.append(a), last.append(b)
        child.append([])
        return len(centre) - 1

    waiting = [(add(0, 0, len(ids), chord(unit @ unit[0])), 2.0)]
    while waiting:
        node, radius = waiting.pop()
        a, b = first[node], last[node]
        while radius >= cover[node] and radius > SLACK:
            radius /= 2
        if b - a <= LEAF or radius <= SLACK:
            continue
        own = order[a:b]
        points = unit[own]
        nearest = chord(points @ unit[centre[node]])
        centres, group = [centre[node]], np.zeros(b - a, np.int64)
        while nearest.max() > radius:
            far = int(own[nearest.argmax()])
            distance = chord(points @ unit[far])
            closer = distance < nearest
            group[closer], nearest[closer] = len(centres), distance[closer]
            centres.append(far)
        arranged = np.argsort(group, kind="stable")
        order[a:b], sizes, near = own[arranged], np.bincount(group), nearest[arranged]
        at = 0
        for c, size in zip(centres, sizes.tolist()):
            new = add(c, a + at, a + at + size, near[at:at + size])
            child[node].append(new)
            waiting.append((new, radius))
            at += size
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    return CoverTree(ids[order], copies[order], vectors[order], place[np.array(centre)],
                     np.array(cover), np.array(first), np.array(last),
                     [np.array(c, np.int64) for c in child])


def join_trees(one: CoverTree, two: CoverTree, threshold: float
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked ids, how many vectors of the other side each links to (copies counted), and the
    smallest id of its connected part. ``one is two`` joins a tree with itself."""
    same = one is two
    n, far = len(one.ids), math.sqrt(max(0.0, 2 - 2 * threshold))
    units = one.unit, two.unit
    norms = np.linalg.norm(one.vectors, axis=1), np.linalg.norm(two.vectors, axis=1)
    weights = [np.concatenate([[0], np.cumsum(t.copies)]) for t in (one, two)]
    degrees = np.zeros(n + 1, np.int64), np.zeros(len(two.ids) + 1, np.int64)
    shift = 0 if same else n
    edges: list[tuple[np.ndarray, np.ndarray]] = []

    def all_linked(i: int, j: int) -> None:
        a, b, c, d = one.first[i], one.last[i], two.first[j], two.last[j]
        for side, (x, y), amount in ((0, (a, b), weights[1][d] - weights[1][c]),
                                     (1, (c, d), weights[0][b] - weights[0][a])):
            if not (same and i == j and side):
                degrees[side][x] += amount
                degrees[side][y] -= amount
        edges.append((np.arange(a, b), np.full(b - a, shift + c)))
        edges.append((np.full(d - c, a), shift + np.arange(c, d)))

    def compare(i: int, j: int) -> None:
        a, b, c, d = one.first[i], one.last[i], two.first[j], two.last[j]
        hit = (one.vectors[a:b] @ two.vectors[c:d].T) \
            / (norms[0][a:b, None] * norms[1][None, c:d]) >= threshold
        if same and i == j:
            hit |= np.eye(b - a, dtype=bool)
        for side, at, amount in ((0, a, hit @ two.copies[c:d]), (1, c, one.copies[a:b] @ hit)):
            if not (same and i == j and side):
                step = np.diff(np.concatenate([[0], amount, [0]]))
                degrees[side][at:at + len(step)] += step
        x, y = np.nonzero(hit)
        edges.append((a + x, shift + c + y))

    direct = np.zeros(n, np.int64), np.zeros(len(two.ids), np.int64)
    most = max(LARGE_LEAVES, GATHERED // max(1, one.vectors.shape[1]))
    near: list[tuple[int, int]] = []
    held = 0

    def compare_all() -> None:
        """The leaf pairs in ``near``, all their pairs of vectors at once."""
        i, j = np.array(near).T
        wide = two.last[j] - two.first[j]
        sizes = (one.last[i] - one.first[i]) * wide
        of = np.repeat(np.arange(len(i)), sizes)
        place = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        x, y = one.first[i][of] + place // wide[of], two.first[j][of] + place % wide[of]
        hit = np.einsum("ij,ij->i", one.vectors[x], two.vectors[y]) / (norms[0][x] * norms[1][y]) >= threshold
        once = (i == j)[of] if same else np.zeros(len(of), bool)
        hit |= once & (x == y)
        x, y, once = x[hit], y[hit], once[hit]
        np.add.at(direct[0], x, two.copies[y])
        np.add.at(direct[1], y[~once], one.copies[x[~once]])
        edges.append((x, shift + y))
        near.clear()

    waiting = [(0, 0)]
    while waiting:
        i, j = waiting.pop()
        if len(one.child[i]) == 0 and len(two.child[j]) == 0:
            size = int((one.last[i] - one.first[i]) * (two.last[j] - two.first[j]))
            if size > LARGE_LEAVES:
                compare(i, j)
                continue
            if held + size > most:
                compare_all()
                held = 0
            near.append((i, j))
            held += size
            continue
        left = one.child[i] if len(one.child[i]) else np.array([i])
        right = two.child[j] if len(two.child[j]) else np.array([j])
        for lo in range(0, len(left), 1024):
            some = left[lo:lo + 1024]
            distance = chord(units[0][one.centre[some]] @ units[1][two.centre[right]].T)
            reach = one.cover[some][:, None] + two.cover[right][None]
            open_ = distance - reach <= far + SLACK
            if same and i == j:
                open_ &= some[:, None] <= right[None]
            inside = open_ & (distance + reach <= far - SLACK)
            for a, b in zip(*np.nonzero(inside)):
                all_linked(some[a], right[b])
            a, b = np.nonzero(open_ & ~inside)
            waiting.extend(zip(some[a].tolist(), right[b].tolist()))

    if near:
        compare_all()
    if same:
        ids, total = one.ids, np.cumsum(degrees[0] + degrees[1])[:-1] + direct[0] + direct[1] - one.copies  # not itself
    else:
        total = np.concatenate([np.cumsum(d)[:-1] + more for d, more in zip(degrees, direct)])
        ids = np.concatenate([one.ids, two.ids])
    root = _roots(ids, edges)
    some = total > 0
    return ids[some], total[some], root[some]


def _roots(ids: np.ndarray, edges) -> np.ndarray:
    """Smallest id reachable in the local graph."""
    label = ids.copy()
    if edges:
        x, y = (np.concatenate(e) for e in zip(*edges))
        while True:
            low = np.minimum(label[x], label[y])
            before = label.copy()
            np.minimum.at(label, x, low)
            np.minimum.at(label, y, low)
            if (label == before).all():
                break
    return label


def threshold_classes(table: DataFrame, threshold: float = 0.93, block_rows: int = 2048,
                      max_pivots: int = 64) -> DataFrame:
    """One row per row of ``table``: ``vec_id, n_links, component_id, kept``.

    Two rows link if their labels are equal and not null and their cosine is at least
    ``threshold`` (double precision). Equal vectors of a label are one point with a number of
    copies, so copies are counted and never paired. Points of a label are dealt by their
    nearest pivot (at most ``max_pivots`` vectors, a bounded sample that only sets locality)
    into blocks of about ``block_rows``, one tree each; two blocks meet in a task if their
    balls come near enough. A hot label is many blocks.

    Rows with a null id, null label, or a null, zero or non-finite vector have no links and
    are their own component. Repeated rows are copies of a point, linked with each other.
    """
    rows = usable_rows(table, "label").where("label is not null")
    points = stage(rows.groupBy("label", "dims", "vector").agg(
        F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("point", F.monotonically_increasing_id()), "points")
    n = points.count()
    pivots = points.select("point", "vector", "dims").orderBy(
        F.xxhash64("point"), "point").limit(min(max_pivots, 1 + n // 16384)).collect()
    by_dims: dict[int, np.ndarray] = {}
    for p in pivots:
        v = np.array([p["vector"]], np.float64)
        by_dims[p["dims"]] = np.concatenate([by_dims.get(p["dims"], v[:0]), v])

    def nearest_pivot(batches):
        for pdf in batches:
            cell = np.zeros(len(pdf), np.int64)
            for dims, at in pdf.groupby("dims").indices.items():
                if dims in by_dims:
                    p = by_dims[dims]
                    cell[at] = (matrix(pdf["vector"].iloc[at])
                                @ (p / np.linalg.norm(p, axis=1, keepdims=True)).T).argmax(axis=1)
            pdf["cell"] = cell
            yield pdf[["point", "cell"]]

    cells = points.join(points.select("point", "vector", "dims").mapInPandas(
        nearest_pivot, "point long, cell long"), "point")
    keys = ["label", "dims", "cell"]
    parts = cells.groupBy(keys).agg(
        F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("parts"))
    dealt = cells.join(parts, keys).withColumn(
        "part", F.pmod(F.xxhash64("point", F.lit("part")), F.col("parts")))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("point")
        tree = build(pdf["point"].to_numpy(), pdf["copies"].to_numpy(), matrix(pdf["vector"]))
        return pd.DataFrame({
            "label": [pdf["label"].iloc[0]], "dims": [pdf["dims"].iloc[0]],
            "block": [int(pdf["point"].iloc[0])], "centre": [tree.unit[tree.centre[0]]],
            "cover": [tree.cover[0]], "tree": [pickle.dumps(tree)]})

    label_type = points.schema["label"].dataType.simpleString()
    trees = stage(dealt.groupBy(*keys, "part").applyInPandas(
        grow, f"label {label_type}, dims int, block long, centre array<double>, cover double, "
              "tree binary"), "trees")

    heads = trees.select("label", "dims", "block", "centre", "cover")
    other = heads.select("label", "dims", *[F.col(c).alias(f"{c}_2")
                                            for c in ("block", "centre", "cover")])
    dot = F.aggregate(F.zip_with("centre", "centre_2", lambda x, y: x * y), F.lit(0.0),
                      lambda s, x: s + x)
    apart = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * dot))
    reach = F.col("cover") + F.col("cover_2") + math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    pairs = heads.join(other, ["label", "dims"]) \
        .where((F.col("block") <= F.col("block_2")) & (apart <= reach)).select("block", "block_2")
    left = trees.select("block", F.col("tree").alias("one"))
    right = trees.select(F.col("block").alias("block_2"), F.col("tree").alias("two"))

    def meet(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = pickle.loads(batch.column(0)[i].as_py())
                two = one if batch.column(2)[i].as_py() \
                    else pickle.loads(batch.column(1)[i].as_py())
                ids, links, root = join_trees(one, two, threshold)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(links), pa.array(root)],
                    names=["point", "links", "root"])

    found = stage(pairs.join(left, "block").join(right, "block_2")
                  .select("one", "two", (F.col("block") == F.col("block_2")).alias("same"))
                  .mapInArrow(meet, "point long, links long, root long"), "found")
    classes = components(found.select(F.col("point").alias("a"), F.col("root").alias("b"))) \
        .withColumnRenamed("node", "point")
    named = points.join(found.groupBy("point").agg(F.sum("links").alias("links")), "point", "left") \
        .join(classes, "point", "left") \
        .withColumn("component", F.coalesce("component", "point"))
    smallest = named.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    linked = named.join(smallest, "component").select(
        "label", "dims", "vector", "copies", "links", "component_id")
    placed = rows.join(linked, ["label", "dims", "vector"]).select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        "component_id")
    takes_part = F.col("vec_id").isNotNull() & F.col("label").isNotNull() \
        & usable(F.col("embedding"))
    apart_rows = table.where(~takes_part).select(F.col("vec_id").cast("long").alias("vec_id"))
    return placed.union(apart_rows.select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

