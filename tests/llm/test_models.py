import itertools
import os
import pathlib
import subprocess
import sys
import zlib

import numpy as np
import pytest

from llm_cases import edge_texts, frame
from portfolio_ops.llm import langid, quality
from portfolio_ops.sources.registry import read_table

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    model = quality.QualityModel(np.zeros(quality.FEATURES), rng.normal(size=(2, 2)))
    sizes = [1, 4, 2, 6]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    unary = rng.normal(size=bounds[-1])
    forward, backward = model.messages(unary, bounds)
    got = 1 / (1 + np.exp(-(forward + backward)))
    for a, b in zip(bounds, bounds[1:]):
        mass = np.zeros((b - a, 2))
        for states in itertools.product((0, 1), repeat=b - a):
            score = sum(unary[a + k] * s for k, s in enumerate(states)) \
                + sum(model.change[s, t] for s, t in zip(states, states[1:]))
            for k, s in enumerate(states):
                mass[k, s] += np.exp(score)
        np.testing.assert_allclose(got[a:b], mass[:, 1] / mass.sum(axis=1), rtol=1e-9)


def test_lines_and_neighbours():
    lines = quality.read_lines(["Good text.\n$$$ ###\nmore", "", "x"])
    assert lines.size.tolist() == [10, 7, 4, 0, 1] and lines.bounds.tolist() == [0, 3, 4, 5]
    own = quality.OWN - 1
    middle = lines.features[1]
    np.testing.assert_array_equal(middle[quality.OWN:quality.OWN + own], lines.features[0][1:quality.OWN])
    np.testing.assert_array_equal(middle[quality.OWN + own:], lines.features[2][1:quality.OWN])
    assert not lines.features[3][quality.OWN:].any()


def test_quality_runs_do_not_change_scores():
    rng = np.random.default_rng(1)
    model = quality.QualityModel(rng.normal(size=quality.FEATURES), rng.normal(size=(2, 2)))
    texts = ["line one\nline two!!\n" * 40, "", "$$$ a\n\nb"] * 3
    together = model.scores(texts)
    np.testing.assert_allclose(together, np.concatenate([model.scores([t]) for t in texts]))


@needs_tables
@pytest.mark.parametrize("change", [np.zeros((2, 2)), np.array([[3.0, -3.0], [-2.0, 4.0]])])
def test_long_documents_have_the_same_mean(monkeypatch, change):
    rng = np.random.default_rng(3)
    model = quality.QualityModel(rng.normal(size=quality.FEATURES), change)
    monkeypatch.setattr(quality, "BLOCK_CHARS", 200)
    for n in (1, 2, 3, 50, 5000):
        text = "\n".join("".join(rng.choice(list("abC !#1é "), rng.integers(0, 30))) for _ in range(n))
        assert abs(model.long_mean(text) - model.mean_of(quality.read_lines([text]))[0]) < 1e-9
        unary = rng.normal(0, 3, n)
        forward, _ = model.messages(unary, np.array([0, n]))
        assert np.allclose(quality.scan(unary, change), forward, atol=1e-8)
    texts = ["a\nb"] * 3000 + ["\n" * 9000, "", "x\n" * 4095, "last"]
    whole = [model.mean_of(quality.read_lines([t]))[0] for t in texts]
    assert np.allclose(model.means(texts), whole, atol=1e-9)


def test_very_many_lines_need_little_memory():
    code = ("import resource, numpy as np; from portfolio_ops.llm import quality as q; "
            "m = q.QualityModel(np.ones(q.FEATURES), np.eye(2)); m.means(['\\n' * 10_000_000]); "
            "print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True,
                         env={**os.environ, "PYTHONPATH": str(pathlib.Path(quality.__file__).parents[2])})
    assert int(out.stdout) < 500


def test_quality_held_out(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    model = quality.train(docs, labels)
    rows = quality.score(docs, model).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 50 and np.mean([r.predicted == r.quality for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_quality_edges(spark):
    docs = frame(spark, edge_texts())
    labels = spark.createDataFrame(
        [(1, 1), (4, 0), (9, None), (None, 1), (12, 1), (14, 0), (5, 1)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    rows = quality.score(docs, model).collect()
    assert len(rows) == len(edge_texts()) and all(0 <= r.score <= 1 for r in rows)
    null, empty = ({r.score for r in rows if r.doc_id == i} for i in (6, 7))
    assert null == empty
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted for r in rows)
    none = frame(spark, [])
    assert quality.score(none, model).count() == 0
    assert quality.train(none, labels.limit(0)).scores(["x"])[0] == pytest.approx(0.5)


def test_network_gradients():
    rng = np.random.default_rng(2)
    model = langid.LanguageModel.fresh(["a", "b", "c"])
    for p in (model.embedding, *model.filters, *model.biases, model.out, model.out_bias):
        p[...] = rng.normal(scale=0.4, size=p.shape)
    model = langid.LanguageModel(model.languages, *[
        [q.astype(np.float64) for q in p] if isinstance(p, list) else p.astype(np.float64)
        for p in (model.embedding, model.filters, model.biases, model.out, model.out_bias)])
    grid = rng.integers(97, 110, (3, langid.WINDOW)).astype(np.uint8)
    target = np.array([0, 2, 1])

    def loss():
        p = model.probabilities(grid)
        return -np.log(p[np.arange(3), target]).mean()
    for p, g in zip(model.parameters(), model.gradients(grid, target)):
        at = tuple(np.argwhere(np.abs(g) == np.abs(g).max())[0])
        before = p[at]
        p[at] = before + 1e-6
        up = loss()
        p[at] = before - 1e-6
        down = loss()
        p[at] = before
        assert (up - down) / 2e-6 == pytest.approx(g[at], rel=1e-3)


def test_windows_hold_every_byte():
    texts = ["", "é" * 300, "x" * langid.WINDOW, "y"]
    grid, owner, held = langid.windows(texts)
    for k, t in enumerate(texts):
        raw = b"".join(g.tobytes()[:h] for g, h in zip(grid[owner == k], held[owner == k]))
        assert raw == t.encode()


@needs_tables
def test_language_held_out(spark):
    docs = read_table(spark, SF, "documents")
    model = langid.train(docs)
    rows = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.97


def test_language_edges(spark):
    docs = frame(spark, edge_texts())
    model = langid.train(docs)
    rows = langid.identify(docs, model).collect()
    assert len(rows) == len(edge_texts())
    by_id = {r.doc_id: r for r in rows}
    for i in (6, 7, 8, 17):
        assert by_id[i].lang_pred == "und" and by_id[i].score == 0
    assert by_id[14].lang_pred in ("en", "fr") and 0 < by_id[14].score <= 1
    none = langid.train(frame(spark, []))
    assert none.predict(["words"])[0] == ["und"]
    assert langid.identify(frame(spark, []), model).count() == 0


@pytest.mark.parametrize("text, want", [("½ ² Ⅷ 12", False), ("", False), ("_-!", False), ("1a", True),
                                        ("日", True), ("²é", True)])
def test_only_letters_are_letters(text, want):
    assert langid.has_letter(text) is want
