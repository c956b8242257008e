"""One query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from portfolio_ops.llm import (audit, bpe, covertree, decontaminate, langid, lshforest, minhash, packing, pii,
                               quality, suffix, variants)
from portfolio_ops.sources.registry import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
SURROGATE_KEY = "replace this key by a secret"  # a parameter of the operator


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return register


@query("op5_bpe_round_trip")
def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(read_table(spark, sf_dir, "documents"), WORD_BPE)


@query("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), BYTE_BPE, 1024)


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_counts(read_table(spark, sf_dir, "documents"), BYTE_BPE, 1024)


OP1_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id,
       e.vec_id = c.component_id AS kept
FROM embeddings e
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = e.vec_id
LEFT JOIN (SELECT a, count(*) AS n_links FROM link GROUP BY a) n ON n.a = e.vec_id
"""


@query("op1_embedding_near_dedup", OP1_SQL)
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.threshold_classes(read_table(spark, sf_dir, "embeddings"), 0.93)


@query("op2_quality_classifier")
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, read_table(spark, sf_dir, "labels")), 0.7)


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


@query("op10_nearest_neighbours")
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lshforest.nearest(read_table(spark, sf_dir, "embeddings"), every=20, k=20)


OP9_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, h, unnest(range(0, len(h) // 2)) AS i FROM d),
g AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM w WHERE 2 * i + 100 <= len(h)),
f AS (SELECT s, min(doc_id) AS first_doc FROM g GROUP BY s),
hit AS (SELECT g.doc_id, g.i FROM g JOIN f USING (s) WHERE f.first_doc < g.doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM hit),
b AS (SELECT w.doc_id, w.i, substr(w.h, 2 * w.i + 1, 2) AS x, gone.i IS NOT NULL AS removed
      FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id AND w.i = gone.i),
m AS (SELECT *, lag(removed, 1, false) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM b),
k AS (SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (WHERE removed) AS n_removed,
             count(*) FILTER (WHERE removed AND NOT before) AS n_spans,
             coalesce(string_agg(x, '' ORDER BY i) FILTER (WHERE NOT removed), '') AS kept
      FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(k.n_bytes, 0) AS n_bytes, coalesce(k.n_removed, 0) AS n_removed,
       coalesce(k.n_spans, 0) AS n_spans, sha256(unhex(coalesce(k.kept, ''))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


@query("op9_suffix_array_dedup", OP9_SQL)
def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeat_digests(read_table(spark, sf_dir, "documents"))


@query("op7_minhash_near_dedup")
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@query("op3_pii_surrogates")
def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pii.checked(read_table(spark, sf_dir, "documents"), SURROGATE_KEY)
    return pii.scrub(docs, SURROGATE_KEY)


OP11_SQL = r"""
WITH RECURSIVE
bits AS (SELECT range AS b, range AS c, 0 AS step FROM range(256)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1
  FROM bits WHERE step < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE step = 8),
runs AS (SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents),
each AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hexed AS (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM each),
summed AS (SELECT run, n, xor(list_reduce(
    list_prepend(4294967295, [CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT)
                              FOR i IN range(len(x) // 2)]),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h FROM hexed, crc),
changed AS (SELECT CASE WHEN h % 31 = 0
    THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
    ELSE run END AS word, n FROM summed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM changed WHERE length(word) >= 7
  GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
shorter AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM cut),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b
    ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS top FROM near GROUP BY word),
form AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
    (SELECT min(x.other) FROM near x WHERE x.word = w.word AND x.other_n = b.top
      AND b.top >= 10 * w.n) AS form,
    CASE WHEN b.top >= 10 * w.n THEN b.top END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
path AS (SELECT word, word AS root, 0 AS steps FROM words
  UNION ALL SELECT p.word, f.form, p.steps + 1 FROM path p JOIN form f ON p.root = f.word
  WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(root, steps) AS root FROM path GROUP BY word)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM form f JOIN roots r USING (word)
"""


@query("op11_spelling_variants", OP11_SQL)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(read_table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
starts AS (SELECT item, w, least(len(w), 10) AS size, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
  FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS s FROM starts),
sizes AS (SELECT DISTINCT size FROM win),
placed AS (SELECT r, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes),
gram AS (SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS s FROM placed),
hit AS (SELECT g.r, g.i, g.size, win.item FROM gram g JOIN win ON g.size = win.size AND g.s = win.s),
covered AS (SELECT r, count(*) AS n_hit FROM (
  SELECT DISTINCT r, unnest(range(i, i + size)) AS i FROM hit) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS s
  FROM hit GROUP BY r)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(c.n_hit, 0) AS n_hit,
       coalesce(i.n_items, 0) AS n_items, sha256(coalesce(i.s, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (r) LEFT JOIN items i USING (r)
"""


@query("op12_benchmark_decontamination", OP12_SQL)
def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_digests(read_table(spark, sf_dir, "documents"),
                                               read_table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
    max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT d.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
    CASE WHEN len(w) < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]+', '', 'g'))) > 5 * length(t)
      THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN min(d.doc_id) OVER (PARTITION BY t) < d.doc_id THEN 16 ELSE 0 END AS mask
  FROM d LEFT JOIN l ON l.doc_id = d.doc_id),
m AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
x AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(c, b)),
perms AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM x a, x b, x c, x d, x e WHERE a.b + b.b + c.b + d.b + e.b = 31
    AND (a.b | b.b | c.b | d.b | e.b) = 31),
steps AS (SELECT filter_order, s AS step, bits[s] AS own,
    coalesce(list_sum(bits[1:s - 1]), 0)::BIGINT AS before
  FROM perms, (SELECT unnest(range(1, 6)) AS s)),
r AS (SELECT m.part, s.filter_order, s.step, s.own,
    sum(CASE WHEN m.mask & (s.before + s.own) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN m.mask & s.before = 0 AND m.mask & s.own > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN m.mask & s.before > 0 AND m.mask & s.own > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN m.mask = s.own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN m.mask & s.before = 0 AND m.mask & s.own > 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN m.mask & s.before = 0 AND m.mask & s.own > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM steps s, m GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
    CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
    CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
    CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r
"""


@query("op13_filter_audit", OP13_SQL)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_audit(read_table(spark, sf_dir, "documents"),
                              read_table(spark, sf_dir, "labels"))
