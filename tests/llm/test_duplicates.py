import hashlib
import random

import numpy as np
import pytest

from llm_cases import brute_classes, brute_removed, edge_texts, frame, rows_of, spans
from portfolio_ops.llm import minhash, shared, suffix


def near_rows(seed=2):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(40):
        text = [rnd.choice(words) for _ in range(rnd.randrange(30, 200))]
        rows.append((10 * k, " ".join(text)))
        for j in range(rnd.randrange(4)):
            changed = list(text)
            for _ in range(rnd.randrange(1, 5)):
                changed[rnd.randrange(len(changed))] = rnd.choice(words)
            rows.append((10 * k + j + 1, " ".join(changed)))
    return rows


def classes(rows):
    return sorted(((i, c, c is None or c == i) for (i, _), c in zip(rows, brute_classes(rows))), key=repr)


@pytest.mark.parametrize("block", [512, 2])
def test_near_duplicates(spark, block):
    rows = near_rows()
    got = minhash.near_duplicates(frame(spark, rows), batch_bytes=5000, block=block)
    assert rows_of(got, "doc_id", "class_id", "kept") == classes(rows)


def test_near_duplicates_on_edge_rows(spark):
    rows = edge_texts()
    docs = frame(spark, rows)
    got = minhash.near_duplicates(docs, batch_bytes=10_000)
    want = sorted(((i, c, i == c if i is not None else c is None)
                   for (i, _), c in zip(rows, brute_classes(rows))), key=repr)
    assert rows_of(got, "doc_id", "class_id", "kept") == want
    kept = minhash.keep_one(docs)
    gone = {i for i, _, keep in want if not keep and i is not None}
    assert kept.columns == docs.columns
    left = [r for r in rows if r[0] not in gone]
    left.remove((11, rows[13][1]))      # the row is there twice
    left.remove((None, rows[0][1]))     # document 1 has its text
    assert rows_of(kept, "doc_id", "text") == sorted(left, key=repr)
    assert minhash.near_duplicates(frame(spark, [])).count() == 0


def test_samples_agree_as_often_as_weights_overlap():
    rng = np.random.default_rng(3)
    keys = np.sort(rng.integers(0, 1 << 63, 300, np.uint64))
    one, two = rng.uniform(0.5, 3, 300), rng.uniform(0.5, 3, 300)
    two[:200] = one[:200]
    want = np.minimum(one, two).sum() / np.maximum(one, two).sum()
    hits = []
    for shift in range(40):
        moved = minhash.mix(keys + np.uint64(shift))
        a = minhash.weighted_samples(moved, one, np.array([0, 300]))
        b = minhash.weighted_samples(moved, two, np.array([0, 300]))
        hits.append((a == b).mean())
    assert np.mean(hits) == pytest.approx(want, abs=0.03)


def test_packed_keys():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 1000):
        keys = np.unique(rng.integers(0, 1 << 64, n, np.uint64, endpoint=False))
        np.testing.assert_array_equal(shared.unpack(shared.pack(keys)), keys)


def test_suffix_order_and_prefixes():
    rng = np.random.default_rng(0)
    for _ in range(120):
        n = int(rng.integers(1, 250))
        values = rng.integers(97, 97 + int(rng.integers(1, 4)), n).astype(np.uint8)
        words = suffix.word_at(values)
        order = suffix.two_stage_order(values, words, 50)
        raw = values.tobytes()
        assert sorted(order.tolist()) == list(range(n))
        cut = [raw[i:i + 50] for i in order]
        assert cut == sorted(cut)
        common = suffix.common_prefixes(order, words, 50)
        for k in range(1, n):
            a, b = cut[k - 1], cut[k]
            m = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert common[k] == m


def test_smaller_than_next_is_the_definition():
    raw = b"mississippi banana aaa"
    got = suffix.smaller_than_next(np.frombuffer(raw, np.uint8))
    assert got.tolist() == [raw[i:] < raw[i + 1:] for i in range(len(raw) - 1)] + [False]


def passage_rows(seed=3):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abé ") for _ in range(rnd.randrange(200))) for _ in range(4)]
    base += ["a" * 120, "ab" * 80, "\0" * 60]
    return [(k, "".join(rnd.choice(base)[rnd.randrange(30):] for _ in range(rnd.randrange(4))))
            for k in range(40)]


def removals(rows):
    return sorted(((i, len(g), int(g.sum()), spans(g),
                    hashlib.sha256(bytes(np.frombuffer((t or "").encode(), np.uint8)[~g])).hexdigest())
                   for (i, t), g in zip(rows, brute_removed(rows))), key=repr)


@pytest.mark.parametrize("rows, hot", [(passage_rows(), 4096), (passage_rows(), 3), (edge_texts(), 1)],
                         ids=["passages", "hot keys", "edges"])
def test_repeats_are_removed(spark, rows, hot):
    rows = [(i, t[:3000] if t else t) for i, t in rows]
    got = suffix.repeat_digests(frame(spark, rows), batch_bytes=2000, hot=hot)
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == removals(rows)
    kept = suffix.remove_repeats(frame(spark, rows), batch_bytes=700).collect()
    assert sorted(((r.doc_id, hashlib.sha256(r.kept).hexdigest()) for r in kept), key=repr) \
        == sorted(((r[0], r[4]) for r in removals(rows)), key=repr)


def test_long_texts_and_no_rows(spark):
    rows = [r for r in edge_texts() if r[0] in (12, 13)]
    got = suffix.repeat_digests(frame(spark, rows)).collect()
    by_id = {r.doc_id: r for r in got}
    assert by_id[12].n_removed == 0 and by_id[13].n_removed == len(rows[0][1])
    assert suffix.repeat_digests(frame(spark, [])).count() == 0


def test_rows_keep_their_columns_and_whole_characters(spark):
    rows = [(1, "é" + "x" * 60), (2, "É" + "x" * 60), (3, "è" + "x" * 60 + "é"), (4, None), (None, "short")]
    docs = frame(spark, rows)
    got = suffix.remove_repeats_from_rows(docs)
    assert got.columns == docs.columns and got.schema == docs.schema
    assert rows_of(got, "doc_id", "text") == sorted(
        [(1, rows[0][1]), (2, "É"), (3, "èé"), (4, None), (None, "short")], key=repr)


def test_whole_characters():
    raw = np.frombuffer("aé😀".encode(), np.uint8)
    gone = np.array([True, False, True, True, True, True, True])
    assert suffix.whole_characters(raw, gone).tolist() == [True, False, False, True, True, True, True]


def test_windows_are_owned_once():
    rows = passage_rows()
    ids, texts = np.arange(len(rows)), [t for _, t in rows]
    own = suffix.own_windows(ids, texts)
    seen = [set() for _ in texts]
    for doc, low, high in zip(own.doc, own.low, own.high):
        for at in range(low, high + 1):
            assert at - own.offsets[doc] not in seen[doc]
            seen[doc].add(at - own.offsets[doc])
    assert [len(s) for s in seen] == [max(0, len(t.encode()) - 49) for t in texts]


def test_keep_one_judges_rows(spark):
    long_a = " ".join(f"a{k}" for k in range(40))
    long_b = " ".join(f"b{k}" for k in range(40))
    rows = [(1, long_a), (2, long_a), (2, long_b), (None, long_b), (None, long_b), (3, "x y"), (3, "x y"), (4, ""),
            (4, "")]
    kept = rows_of(minhash.keep_one(frame(spark, rows)), "doc_id", "text")
    assert kept == sorted([(1, long_a), (2, long_b), (3, "x y"), (4, ""), (4, "")], key=repr)
    alone = rows_of(minhash.keep_one(frame(spark, [(None, long_a), (None, long_a)])), "doc_id", "text")
    assert alone == [(None, long_a)]
