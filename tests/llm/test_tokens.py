import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_cases import edge_texts, frame
from portfolio_ops.llm import bpe, packing
from portfolio_ops.llm.text import chunks
import pyarrow as pa

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["'s", "'t", "'re", "'ll", "'", "''", " ", "  ", "\n", "\t", "a", "B", "don't", "é", "é",
         "ñ", "1", "22", "!", "?!", " ", "日本", "Σ", "İ", "😀", "<|endoftext|>",
         "<|startoftext|>", "　", "the", "aaaaaaa", "½", "\x1c", "\x85", "$$$"]


@pytest.fixture(scope="module")
def library():
    return {p: Tokenizer.from_file(p) for p in (WORD, BYTE)}


def fuzz(n=1500):
    rnd = random.Random(1)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(40))) for _ in range(n)] \
        + ["", "x" * 3000, "ab" * 2000, "ababab" * 30 + "!" * 500]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoders_equal_the_library(library, path):
    texts = fuzz()
    want = library[path].encode_batch(texts, add_special_tokens=False)
    assert bpe.counter(path).texts(texts).tolist() == [len(e.ids) for e in want]
    got = list(bpe.coder(path).texts(texts))
    assert [g[1] for g in got] == [" ".join(map(str, e.ids)) for e in want]
    if path == WORD:
        assert [g[2] for g in got] == [
            library[path].decode(e.ids, skip_special_tokens=False) for e in want]
    assert [x.tolist() for x in packing.BulkCoder(path).texts(texts)] == [e.ids for e in want]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_any_text(texts):
    # letters that newer tables know are left out by comparing counts of both encoders
    counts = bpe.counter(BYTE).texts(texts).tolist()
    assert counts == [n for n, _, _ in bpe.coder(BYTE).texts(texts)]


def test_queue_and_ranks_agree_on_one_piece():
    vocab = bpe.vocabulary(BYTE)
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcdeth ing") for _ in range(rnd.randrange(1, 60))) for _ in range(300)]
    assert bpe.Counter(BYTE).count_pieces(words) == [
        len(bpe.encode(vocab.symbols(w), vocab)) for w in words]
    flat = np.concatenate([vocab.symbols(w) for w in words])
    owner = np.repeat(np.arange(len(words)), [len(vocab.symbols(w)) for w in words])
    one_by_one = bpe.merge_synchronously(flat.copy(), owner, len(words), bpe.PairTable(vocab), False)
    assert one_by_one.tolist() == bpe.Counter(BYTE).count_pieces(words)


def test_cache_starts_anew_at_its_limit():
    own = bpe.Counter(BYTE)
    own.cache.limit = 5
    texts = fuzz(50)
    assert own.texts(texts).tolist() == bpe.counter(BYTE).texts(texts).tolist()


def thue_morse(a, b, size=1024):
    return "".join(b if bin(k).count("1") % 2 else a for k in range(size))


def test_words_that_polynomial_hashes_confuse(library):
    """Any odd base modulo 2**64 gives the two words one hash."""
    texts = [thue_morse("a", "b"), thue_morse("b", "a"), thue_morse("a", "b") + " " + thue_morse("b", "a")]
    for path in (WORD, BYTE):
        want = [e.ids for e in library[path].encode_batch(texts, add_special_tokens=False)]
        assert bpe.counter(path).texts(texts).tolist() == list(map(len, want))
        assert [g[1] for g in bpe.coder(path).texts(texts)] == [" ".join(map(str, w)) for w in want]
        assert [x.tolist() for x in packing.BulkCoder(path).texts(texts)] == want


def test_a_long_document_makes_more_groups(spark):
    rows = [(1, "word " * 60_000), (2, "one"), (3, "two")]
    pieces = packing.pack(frame(spark, rows), BYTE, group_pieces=10).collect()
    groups = {}
    for r in pieces:
        groups.setdefault(r["doc_id"], set()).add(r["sequence_id"] >> 32)
    assert all(len(g) == 1 for g in groups.values())        # a document is dealt whole
    assert max(g for own in groups.values() for g in own) <= -(-len(pieces) // 10)


def test_chunks_never_cut_a_text():
    texts = ["a" * n for n in (0, 5, 100, 1, 0, 30)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["doc_id", "text"])
    got = list(chunks([batch], limit=20))
    assert [t for _, part in got for t in part] == texts and len(got) > 2


def test_queries_on_edge_rows(spark, library):
    rows = edge_texts()
    docs = frame(spark, rows)
    want = sorted(((i, len((t or "").encode()), len(e), len(e) > 1024)
                   for (i, t), e in zip(rows, ids(library[BYTE], rows))), key=repr)
    assert sorted(map(tuple, bpe.token_counts(docs, BYTE).collect()), key=repr) == want
    want = sorted(((i, len(e), sha(" ".join(map(str, e))),
                    sha(library[WORD].decode(e, skip_special_tokens=False)))
                   for (i, _), e in zip(rows, ids(library[WORD], rows))), key=repr)
    assert sorted(map(tuple, bpe.bpe_digests(docs, WORD).collect()), key=repr) == want
    plain = bpe.bpe_round_trip(docs, WORD).collect()
    assert sorted(((r.doc_id, r.n_tokens, sha(r.ids), sha(r.decoded)) for r in plain), key=repr) == want
    empty = frame(spark, [])
    assert bpe.token_counts(empty, BYTE).count() == bpe.bpe_digests(empty, WORD).count() == 0


def ids(tokenizer, rows):
    return [e.ids for e in tokenizer.encode_batch([t or "" for _, t in rows], add_special_tokens=False)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check_packing(rows, pieces, tokenizer, capacity=1024):
    """Every id in one piece, sequences gapless and not over capacity; gives the padding share."""
    docs = defaultdict(list)
    for (doc_id, _), e in zip(rows, ids(tokenizer, rows)):
        docs[doc_id].append([*e, 0])
    left = {d: sorted((s, len(x[s:s + capacity]), crc(x[s:s + capacity]), len(x))
                      for x in v for s in range(0, len(x), capacity)) for d, v in docs.items()}
    for p in pieces:
        left[p["doc_id"]].remove((p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]))
    assert not any(left.values())
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    used = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        used += at
    return 1 - used / (capacity * max(1, len(sequences)))


def crc(part):
    return zlib.crc32(np.array(part, "<u4").tobytes())


def test_packing(spark, library):
    rows = edge_texts() + [(100 + k, "token stream " * (k % 90)) for k in range(300)]
    pieces = packing.pack(frame(spark, rows), BYTE, group_pieces=150).collect()
    assert check_packing(rows, pieces, library[BYTE]) < 0.05
    assert packing.pack(frame(spark, []), BYTE).count() == 0


def test_first_fit_decreasing_equals_a_plain_scan():
    rnd = random.Random(3)
    for _ in range(50):
        sizes = sorted((rnd.randrange(1, 101) for _ in range(rnd.randrange(1, 80))), reverse=True)
        free, want = [], []
        for size in sizes:
            at = next((i for i, f in enumerate(free) if f >= size), None)
            if at is None:
                at = len(free)
                free.append(100)
            want.append((at, 100 - free[at]))
            free[at] -= size
        assert packing.first_fit_decreasing(sizes, 100) == want
