import hashlib
import random
import re

import numpy as np
import pytest

from llm_cases import edge_texts, frame, rows_of
from portfolio_ops.llm import decontaminate as D

COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def brute_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_digests(rows, items, window=10):
    out = []
    for doc_id, text in rows:
        words = brute_words(text)
        hit, found = set(), set()
        for item, t in items:
            own = brute_words(t)
            for k in range(max(1, len(own) - window + 1) if own else 0):
                phrase = own[k:k + window]
                for i in range(len(words) - len(phrase) + 1):
                    if words[i:i + len(phrase)] == phrase:
                        hit.update(range(i, i + len(phrase)))
                        found.add(item)
        names = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(words), len(hit), len(names),
                    hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


ITEMS = [(1, "Alpha beta GAMMA, delta omega of the and in alpha beta; gamma"), (2, "one two three"), (3, None),
         (4, ""), (None, "日本語 Σίσυφος"), (11, "one two three"), (5, "word1 number 1 word2 number 2 "
                                                                 "word3 number 3 word4 number 4 word5"),
         (6, "..."), (2, "one two three"), (7, "a" * 400)]


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame([(i, t, "b", 1) for i, t in items],
                                 "item_id long, text string, batch string, doc_id int")


def cases():
    rnd = random.Random(4)
    words = "alpha beta gamma delta omega of the and in".split()
    planted = ITEMS[0][1]
    rows = edge_texts() + [(200 + k, " ".join(rnd.choice(words) for _ in range(80)) + "\n" + planted)
                           for k in range(8)]
    return rows + [(300, planted.upper() + " " + planted), (301, "ONE-two/three"), (302, "one two")]


@pytest.mark.parametrize("window", [10, 3])
def test_equals_brute_force(spark, window):
    rows = cases()
    got = D.contamination_digests(frame(spark, rows), benchmark(spark), window)
    assert rows_of(got, *COLUMNS) == brute_digests(rows, ITEMS, window)


def test_shards_and_blocks_give_the_same(spark):
    rows = [r for r in cases() if len(r[1] or "") < 5000]
    one = D.contaminated_spans(frame(spark, rows), benchmark(spark)).drop("batch", "place")
    many = D.contaminated_spans(frame(spark, rows), benchmark(spark), shard_bytes=300,
                                block_bytes=60).drop("batch", "place")
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_empty_tables(spark):
    docs, none = frame(spark, [(1, "one two three"), (2, None)]), benchmark(spark, [(1, None)])
    assert rows_of(D.contamination_digests(docs, none), "doc_id", "n_words", "n_hit") == [(1, 3, 0), (2, 0, 0)]
    assert D.contamination_digests(frame(spark, []), benchmark(spark)).count() == 0


def test_spans_are_cut_out_of_the_text(spark):
    docs = frame(spark, [(1, "Ä start: One, two three! end"), (2, "nothing"), (3, None)])
    got = rows_of(D.decontaminate(docs, benchmark(spark)), "doc_id", "text")
    assert got == [(1, "Ä start: ! end"), (2, "nothing"), (3, "")]


@pytest.mark.parametrize("seed", range(6))
def test_index_finds_every_place(seed):
    rng = np.random.default_rng(seed)
    symbols = int(rng.integers(2, 70))
    text = rng.integers(1, symbols, int(rng.integers(1, 400)))
    if seed == 5:
        text = np.tile([1, 1, 2 % symbols or 1], 200)
    values = np.append(text, D.END)
    order = D.suffix_order(values)
    assert order.tolist() == sorted(range(len(values)), key=lambda k: values[k:].tolist())
    index = D.FMIndex(values, symbols, sample=7)
    for size in (1, 2, 5):
        if len(text) < size:
            continue
        starts = rng.integers(0, len(text) - size + 1, 20)
        phrases = np.array([[-1, *text[s:s + size]] for s in starts] + [[-1] + [symbols - 1] * size])
        low, high = index.search(phrases)
        for p, a, b in zip(phrases[:, 1:].tolist(), low, high):
            where = [k for k in range(len(text) - size + 1) if text[k:k + size].tolist() == p]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == where


def test_ranks_of_the_wavelet_matrix():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 37, 1000)
    matrix = D.WaveletMatrix(values, 37)
    at = np.arange(1000)
    symbol, rank = matrix.symbol_and_rank(at)
    assert (symbol == values).all()
    assert rank.tolist() == [int((values[:k] == values[k]).sum()) for k in range(1000)]
    for s in (0, 5, 36):
        assert matrix.rank(np.full(1001, s), np.arange(1001)).tolist() \
            == [int((values[:k] == s).sum()) for k in range(1001)]


def test_long_texts_are_split_in_slices():
    text = "Ab c1 " * 5000 + "ñ"
    find = {b"ab": 5, b"c1": 6, "ñ".encode(): 7}.get
    assert D.word_numbers(text, find, 100).tolist() == [5, 6] * 5000 + [7]
