import math

import numpy as np
import pytest

from portfolio_ops.llm import covertree, lshforest
from portfolio_ops.llm.graph import components

SCHEMA = "vec_id long, embedding array<float>, label int, point string, component string, links int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, l, "p", "c", 0) for i, v, l in rows], SCHEMA)


def sample(n=300, dims=8, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 10, dims))
    rows = []
    for k in range(n):
        v = base[k % len(base)] + rng.normal(scale=0.02 if k % 3 else 0.35, size=dims)
        rows.append((k + 1, v.astype(np.float32).astype(float).tolist(), k % 2 if k % 7 else None))
    rows += [(n + 1 + k, rows[4][1], rows[4][2]) for k in range(25)]          # copies
    rows += [(n + 50, None, 1), (n + 51, [0.0] * dims, 1), (n + 52, [math.nan] + [1.0] * (dims - 1), 1),
             (n + 53, [None] + [1.0] * (dims - 1), 1), (n + 54, [math.inf] * dims, 1), (None, rows[4][1], 0),
             (n + 55, [1.0, 2.0], 1), (n + 56, [], 0), (n + 4, rows[9][1], rows[9][2])]
    return rows


def takes_part(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute_classes(rows, threshold):
    n = len(rows)
    linked = [[] for _ in rows]
    for a in range(n):
        for b in range(n):
            (i, v, l), (j, w, m) = rows[a], rows[b]
            if a != b and i is not None and j is not None and l is not None and l == m \
                    and takes_part(v) and takes_part(w) and len(v) == len(w):
                x, y = np.array(v), np.array(w)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    linked[a].append(b)
    out = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            for b in linked[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        low = min((rows[b][0] for b in seen if rows[b][0] is not None), default=None)
        out.append((rows[a][0], len(linked[a]), low, rows[a][0] is None or low == rows[a][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [2048, 20])
def test_threshold_classes(spark, block):
    rows = sample()
    got = covertree.threshold_classes(vectors(spark, rows), 0.93, block)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_classes(rows, 0.93)


def test_threshold_classes_of_nothing(spark):
    assert covertree.threshold_classes(vectors(spark, []), 0.93).count() == 0
    rows = [(1, None, 1), (2, [1.0], None)]
    got = covertree.threshold_classes(vectors(spark, rows), 0.93)
    assert sorted(map(tuple, got.collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_cover_tree_levels():
    rng = np.random.default_rng(4)
    v = rng.normal(size=(400, 6))
    tree = covertree.build(np.arange(400), np.ones(400, np.int64), v)
    unit = tree.unit
    for node in range(len(tree.centre)):
        a, b = tree.first[node], tree.last[node]
        assert a <= tree.centre[node] < b
        d = covertree.chord(unit[a:b] @ unit[tree.centre[node]])
        assert d.max() <= tree.cover[node] + 1e-7
        kids = tree.child[node]
        if len(kids):
            assert tree.centre[node] in tree.centre[kids]
            assert sum(tree.last[k] - tree.first[k] for k in kids) == b - a
            radius = 2.0
            while radius >= tree.cover[node]:
                radius /= 2
            assert max(tree.cover[k] for k in kids) <= radius
            apart = covertree.chord(unit[tree.centre[kids]] @ unit[tree.centre[kids]].T)
            assert (apart[~np.eye(len(kids), dtype=bool)] > radius - 1e-7).all()


@pytest.mark.parametrize("gathered", [1 << 22, 1])
def test_leaves_are_compared_together(monkeypatch, gathered):
    rng = np.random.default_rng(11)
    base = rng.normal(size=(40, 16))
    v = base[rng.integers(0, 40, 500)] + rng.normal(scale=0.06, size=(500, 16))
    copies = rng.integers(1, 4, 500)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.93
    trees = [covertree.build(np.arange(a, b), copies[a:b], v[a:b]) for a, b in ((0, 250), (250, 500))]
    steps = []
    einsum = np.einsum
    monkeypatch.setattr(covertree, "GATHERED", gathered)
    monkeypatch.setattr(covertree.np, "einsum", lambda *a: (steps.append(len(a[1])), einsum(*a))[1])
    for one, two, a, b in ((trees[0], trees[1], slice(0, 250), slice(250, 500)), (trees[0], trees[0], slice(0, 250), slice(0, 250))):
        ids, links, _ = covertree.join_trees(one, two, 0.93)
        got, want = dict(zip(ids.tolist(), links.tolist())), np.zeros(500, np.int64)
        want[a] += linked[a, b] @ copies[b]
        if one is two:
            want[a] -= copies[a]
        else:
            want[b] += copies[a] @ linked[a, b]
        assert got == {k: int(n) for k, n in enumerate(want) if n}
    # many small leaves a step, and no step of more vectors than the bound
    assert steps and max(steps) <= max(covertree.LARGE_LEAVES, gathered // 16)
    assert sum(steps) / len(steps) > 16 * covertree.LEAF


def brute_nearest(rows, every, k):
    own = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and takes_part(v)]
    out = []
    for q, x in own:
        if q % every == 0:
            near = sorted(((-float(x @ y), i) for i, y in own if i != q and len(y) == len(x)))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near)]
    return out


def test_nearest_is_exact_when_all_is_candidate(spark):
    rows = sample()[:-1]
    table = vectors(spark, rows)
    got = sorted(map(tuple, lshforest.nearest(
        table, 20, 20, lshforest.ForestSettings(trees=4, share=1.0)).collect()))
    want = sorted(brute_nearest(rows, 20, 20))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    np.testing.assert_allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12)
    assert lshforest.nearest(vectors(spark, [])).count() == 0


def test_nearest_recall(spark):
    rng = np.random.default_rng(7)
    rows = [(k, v.tolist(), 1) for k, v in enumerate(
        (rng.normal(size=(3000, 32)) * rng.uniform(0.5, 1.5, (3000, 1))).astype(np.float32))]
    settings = lshforest.ForestSettings(shard_rows=1000, query_rows=100)
    got = lshforest.nearest(vectors(spark, rows), 20, 20, settings).collect()
    want = {(q, i) for q, _, i, _ in brute_nearest(rows, 20, 20)}
    assert len({(r.query_id, r.vec_id) for r in got} & want) / len(want) >= 0.9
    assert max(r["rank"] for r in got) == 20


def test_components(spark):
    links = [(k, k + 1) for k in range(1, 60)] + [(100, k) for k in range(101, 160)] + [(200, 200), (None, 1)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 1 for k in range(1, 61)}, **{k: 100 for k in range(100, 160)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
