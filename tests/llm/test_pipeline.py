import os

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from llm_cases import brute_classes, brute_removed, frame
from portfolio_ops.llm import pii, quality, suffix
from portfolio_ops.llm.queries import QUERIES, SURROGATE_KEY
from test_tokens import check_packing

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


def brute(spark, docs, labels):
    """The pipeline on plain lists: documents that reach the packing stage."""
    model = quality.train(docs, labels)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows = [r for r, s in zip(rows, model.scores([t or "" for _, t in rows])) if s >= 0.7]
    rows = [r for r, c in zip(rows, brute_classes(rows)) if c == r[0]]
    cut = []
    for (i, t), gone in zip(rows, brute_removed(rows)):
        raw = np.frombuffer(t.encode(), np.uint8)
        cut.append((i, raw[~suffix.whole_characters(raw, gone)].tobytes().decode()))
    own = pii.Surrogates(SURROGATE_KEY)
    return [(i, own.replace(t)[0]) for i, t in cut]


@needs_tables
def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute(spark, docs, spark.read.parquet(f"{SF}/labels.parquet"))
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {p.doc_id for p in pieces} == {i for i, _ in want}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert check_packing(want, pieces, library) < 0.05


@needs_tables
def test_stages_keep_the_columns(spark):
    docs = frame(spark, [(k, f"clean prose number {k} about many things of the world") for k in range(20)])
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_queries_are_registered():
    names = entry.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in QUERIES}
    assert "pipeline" in names and set(QUERIES) <= set(names)
