import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from llm_cases import edge_texts, frame, rows_of
from portfolio_ops.llm import variants as V

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]
ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))


def brute_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def neighbours(word):
    out = {word[:k] + word[k + 1:] for k in range(len(word))}
    out |= {word[:k] + c + word[k + 1:] for k in range(len(word)) for c in ALPHABET}
    return (out | {word[:k] + c + word[k:] for k in range(len(word) + 1) for c in ALPHABET}) - {word}


def brute_variants(rows):
    words = brute_counts(rows)
    near = {w: [x for x in neighbours(w) if x in words] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 10 * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out, key=repr)


def typing_rows(count=400, seed=2):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcdeéÿßÀmno") for _ in range(rnd.randint(6, 12))) for _ in range(40)]
    rows = []
    for k in range(count):
        words = []
        for _ in range(30):
            w = base[min(int(rnd.expovariate(.15)), 39)]
            for _ in range(rnd.choice([0, 0, 0, 1, 1, 2])):
                i = rnd.randrange(len(w))
                w = rnd.choice([w[:i] + w[i + 1:], w[:i] + rnd.choice("abÀz") + w[i:],
                                w[:i] + rnd.choice("abÀz") + w[i + 1:], w.title()])
                w = w or "x"
            words.append(w)
        rows.append((k if k % 7 else None, rnd.choice(" ,1日") .join(words)))
    return rows


@pytest.mark.parametrize("block", [20_000, 50])
def test_equals_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(V, "BLOCK_WORDS", block)
    rows = edge_texts() + typing_rows() + [(900, "x" * 70 + " " + "x" * 70 + " " + "x" * 69 + "y " + "x" * 69 + "y")]
    monkeypatch.setattr(V, "near_summary", lambda w, n, f=V.near_summary: f(w, n, block))
    got = V.spelling_variants(frame(spark, rows))
    assert rows_of(got, *COLUMNS) == brute_variants(rows)


def test_chains_of_forms(spark):
    forms = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "d"), ("y", "x")],
                                  "word string, form string")
    assert dict(rows_of(V.roots(forms), "word", "root")) == {"a": "d", "b": "d", "c": "d", "x": "d", "y": "d"}


def test_empty_tables(spark):
    assert V.spelling_variants(frame(spark, [])).count() == 0
    assert V.spelling_variants(frame(spark, [(1, None), (2, "short")])).count() == 0


@pytest.mark.parametrize("leaf", [1, 6, 1000])
def test_trie_finds_all_words_one_edit_away(leaf):
    rnd = random.Random(leaf)
    words = sorted({"".join(rnd.choice("abcé") for _ in range(rnd.randint(5, 8))) for _ in range(900)}
                   | {"q" * k for k in range(45, 56)} | {"q" * 49 + "r"})
    counts = [rnd.randint(2, 9) for _ in words]
    letters = np.zeros(256, np.int64)
    letters[list("abcé".encode("latin-1"))] = np.arange(4)
    own = V.Levels(np.zeros(256, np.int64), 1, letters, 4)
    table = pa.table({"word": words * 2, "n": pa.array(counts + [None] * len(words)),
                      "stored": [True] * len(words) + [False] * len(words)})
    got = {r["word"]: (r["n_near"], r["form_n"], r["form"]) for r in V.near_words(table, own, leaf).to_pylist()}
    known = dict(zip(words, counts))
    want = {}
    for w in words:
        near = [x for x in neighbours(w) if x in known]
        if near:
            best = min(near, key=lambda x: (-known[x], x))
            want[w] = (len(near), known[best], best)
    assert got == want


def test_upper_nodes_meet_every_pair_once():
    """Two vectors within the budget meet at one node, others may not."""
    vectors = np.random.default_rng(0).integers(0, 4, (60, 3)).astype(np.int32)
    around, home = V.differences(3), V.node_numbers(vectors)
    met = defaultdict(int)
    for i, v in enumerate(vectors):
        for d in around:
            for j in np.flatnonzero(home == V.node_numbers((v + d)[None])[0]) if (v + d >= 0).all() else []:
                met[i, int(j)] += 1
    for i, v in enumerate(vectors):
        for j, w in enumerate(vectors):
            apart = w - v
            near = np.maximum(apart, 0).sum() <= 1 and np.maximum(-apart, 0).sum() <= 1
            assert met[i, j] == int(near)
