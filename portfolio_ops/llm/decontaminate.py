"""Benchmark phrases in documents, found with an FM-index over each shard of documents.

A shard is the words of some megabytes of documents. Its index is the Burrows-Wheeler
transform of the word numbers in a wavelet matrix, and every 16th place of the text. Phrases
are searched backwards, all at once; places are located by walking to the next sampled one,
and the words they cover are merged into spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portfolio_ops.llm import shared
from portfolio_ops.llm.text import changes

WINDOW = 10
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 8 << 20   # benchmark text searched at once
SAMPLE = 16             # every so many places of a shard are kept

END, BREAK, FIRST = 0, 1, 2  # symbols: end of the shard, words of no phrase, the phrases' words

# bytes of words after lower-casing: digits, a to z, all of other alphabets; the rest is a space
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127
               else 32 for b in range(256))
_WORD = re.compile(rb"[^\x20]+")


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(_WORDS).split()


def word_numbers(text: str, find, slice_bytes: int = 1 << 20) -> np.ndarray:
    """``find(word, BREAK)`` of every word; words are split a slice of the text at a time."""
    raw = text.encode("utf-8").translate(_WORDS)
    out, start = [np.zeros(0, np.int64)], 0
    while start < len(raw):
        stop = raw.find(b" ", start + slice_bytes)
        stop = len(raw) if stop < 0 else stop
        own = raw[start:stop].split()
        out.append(np.fromiter(map(find, own, repeat(BREAK)), np.int64, len(own)))
        start = stop
    return np.concatenate(out)


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit vector for each bit of a symbol.

    Bits are packed in words of 64 with a running count for each word.
    """

    def __init__(self, values: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.bits, self.before, self.zeros = [], [], []
        for level in range(self.levels):
            one = (values >> (self.levels - 1 - level) & 1).astype(bool)
            padded = np.zeros(-(-(len(one) + 1) // 64) * 64, np.uint8)
            padded[:len(one)] = one
            packed = np.packbits(padded, bitorder="little").view("<u8")
            ones = np.bitwise_count(packed).astype(np.int64)
            self.bits.append(packed)
            self.before.append(np.cumsum(ones) - ones)
            self.zeros.append(len(one) - int(ones.sum()))
            values = np.concatenate([values[~one], values[one]])

    def ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word, rest = at >> 6, (at & 63).astype(np.uint64)
        low = self.bits[level][word] & ((np.uint64(1) << rest) - np.uint64(1))
        return self.before[level][word] + np.bitwise_count(low)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        start = np.zeros(len(at), np.int64)
        for level in range(self.levels):
            one = (symbol >> (self.levels - 1 - level) & 1).astype(bool)
            lower, upper = self.ones(level, start), self.ones(level, at)
            start = np.where(one, self.zeros[level] + lower, start - lower)
            at = np.where(one, self.zeros[level] + upper, at - upper)
        return at - start

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and how often it stands before that place."""
        symbol, start = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for level in range(self.levels):
            word, rest = at >> 6, (at & 63).astype(np.uint64)
            one = (self.bits[level][word] >> rest & np.uint64(1)).astype(bool)
            symbol = symbol << 1 | one
            lower, upper = self.ones(level, start), self.ones(level, at)
            start = np.where(one, self.zeros[level] + lower, start - lower)
            at = np.where(one, self.zeros[level] + upper, at - upper)
        return symbol, at - start


def suffix_order(values: np.ndarray) -> np.ndarray:
    """Suffix array by doubling; after each round only places with an equal rank are sorted."""
    n = len(values)
    order = np.argsort(values, kind="stable")
    rank = np.empty(n, np.int64)
    places = np.arange(n)  # places of the order that are still open, and where their groups begin
    fresh = changes(values[order])
    step = 1
    while True:
        heads = np.flatnonzero(fresh)
        sizes = np.diff(np.append(heads, len(places)))
        rank[order[places]] = np.repeat(places[heads], sizes)
        places = places[np.repeat(sizes > 1, sizes)]
        if not len(places):
            return order
        suffixes = order[places]
        behind = suffixes + step
        second = np.where(behind < n, rank[np.minimum(behind, n - 1)], -1)
        first = rank[suffixes]
        again = np.lexsort((second, first))
        order[places] = suffixes[again]
        fresh = changes(first[again], second[again])
        step *= 2


class FMIndex:
    """Index of one sequence of symbols that ends with the only ``END``."""

    def __init__(self, values: np.ndarray, symbols: int, sample: int = SAMPLE):
        order = suffix_order(values)
        self.matrix = WaveletMatrix(values[order - 1], symbols)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(values, minlength=symbols))])
        self.n = len(values)
        self.sampled = order % sample == 0
        self.number = np.cumsum(self.sampled) - 1
        self.places = order[self.sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of suffixes that begin with each phrase. ``phrases`` has one row for each, its
        last symbol in the last column, -1 in the columns before a shorter one."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.n, np.int64)
        going = np.arange(len(phrases))
        for column in phrases.T[::-1]:
            going = going[(low[going] < high[going]) & (column[going] >= 0)]
            symbol = column[going]
            low[going] = self.less[symbol] + self.matrix.rank(symbol, low[going])
            high[going] = self.less[symbol] + self.matrix.rank(symbol, high[going])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Place in the sequence of each suffix: steps back until a sampled place."""
        places = np.zeros(len(rows), np.int64)
        going, steps = np.arange(len(rows)), 0
        while len(going):
            done = self.sampled[rows]
            places[going[done]] = self.places[self.number[rows[done]]] + steps
            going, rows = going[~done], rows[~done]
            symbol, rank = self.matrix.symbol_and_rank(rows)
            rows, steps = self.less[symbol] + rank, steps + 1
        return places


class Phrases:
    """Distinct windows of benchmark items as word numbers, and the items of each window."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.words: dict[bytes, int] = {}
        self.items = sorted({i for i, _ in items if i is not None})
        number = {i: k for k, i in enumerate(self.items)}
        found: dict[tuple, set] = {}
        for item, text in items:
            own = words_of(text)
            ids = [self.words.setdefault(w, FIRST + len(self.words)) for w in own]
            for k in range(max(1, len(ids) - window + 1) if ids else 0):
                of = found.setdefault(tuple(ids[k:k + window]), set())
                if item is not None:
                    of.add(number[item])
        self.sizes = np.array([len(p) for p in found], np.int64)
        self.table = np.full((len(found), window), -1, np.int64)
        for k, phrase in enumerate(found):
            self.table[k, window - len(phrase):] = phrase
        counts = [len(x) for x in found.values()]
        self.item_bounds = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        self.item_numbers = np.array([i for x in found.values() for i in sorted(x)], np.int64)
        self.symbols = FIRST + len(self.words)


def shard_symbols(texts: list[str], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shard as symbols, the word number (over all texts) of each, and the texts' bounds in words.

    Words of no phrase part the others; a run of them is one ``BREAK``, and so is the end of a
    text.
    """
    numbers = [word_numbers(t, phrases.words.get) for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in numbers], dtype=np.int64)])
    flat = np.concatenate([np.zeros(0, np.int64), *numbers])
    values = np.insert(flat, bounds[1:], BREAK)
    place = np.insert(np.arange(len(flat)), bounds[1:], -1)
    keep = np.append(values[:-1] + values[1:] != 2 * BREAK, True)[:len(values)]
    return np.append(values[keep], END), np.append(place[keep], -1), bounds


def occurrences(index: FMIndex, phrases: Phrases, limit: int = 1 << 20
                ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Phrase number and place of every occurrence, about ``limit`` at a time."""
    low, high = index.search(phrases.table)
    hit = np.flatnonzero(high > low)
    sizes = (high - low)[hit]
    ends = np.cumsum(sizes)
    start = 0
    while start < len(hit):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        phrase = np.repeat(hit[start:stop], sizes[start:stop])
        shift = np.repeat(low[hit[start:stop]] - (ends[start:stop] - sizes[start:stop] - base),
                          sizes[start:stop])
        yield phrase, index.locate(np.arange(len(phrase)) + shift)
        start = stop


def search_shard(texts: list[str], phrases: Phrases
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words covered by phrases and the items found.

    Returns a mask over all words, the bounds of the texts in it, and pairs of text number and
    item number, sorted and without repeats.
    """
    values, place, bounds = shard_symbols(texts, phrases)
    edges = np.zeros(int(bounds[-1]) + 1, np.int64)
    n_items, n_phrases = max(1, len(phrases.items)), max(1, len(phrases.sizes))
    pairs = [np.zeros(0, np.int64)]
    index = FMIndex(values, phrases.symbols)
    for phrase, at in occurrences(index, phrases):
        begin = place[at]
        edges += np.bincount(begin, minlength=len(edges))
        edges -= np.bincount(begin + phrases.sizes[phrase], minlength=len(edges))
        text = np.searchsorted(bounds, begin, side="right") - 1
        text, phrase = np.divmod(np.unique(text * n_phrases + phrase), n_phrases)
        counts = np.diff(phrases.item_bounds)[phrase]
        ends = np.cumsum(counts)
        shift = np.repeat(phrases.item_bounds[phrase] - (ends - counts), counts)
        items = phrases.item_numbers[np.arange(len(shift)) + shift]
        pairs.append(np.unique(np.repeat(text, counts) * n_items + items))
    text, item = np.divmod(np.unique(np.concatenate(pairs)), n_items)
    return np.cumsum(edges)[:-1] > 0, bounds, text, item


def mask_spans(mask: np.ndarray) -> list[dict]:
    """Maximal runs of a mask as ``{start, stop}``."""
    edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return [{"start": a, "stop": b} for a, b in zip(np.flatnonzero(edge == 1).tolist(),
                                                   np.flatnonzero(edge == -1).tolist())]


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
FOUND = ("batch int, place long, doc_id long, n_words long, "
         "spans array<struct<start: long, stop: long>>, items array<string>, text string")


def phrase_blocks(benchmark: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """``block, phrases``: benchmark rows dealt by hash into blocks of bounded size, each one
    compressed value."""
    items = benchmark.where("text is not null").select(
        F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int"))

    def press(table: pa.Table) -> pa.Table:
        sink = pa.BufferOutputStream()
        rows = table.select(["item_id", "text"]).combine_chunks()
        with pa.ipc.new_stream(sink, rows.schema) as writer:
            writer.write_table(rows)
        raw = zstandard.compress(sink.getvalue().to_pybytes())
        return pa.table({"block": table["block"].slice(0, 1), "phrases": [raw]})
    return dealt.groupBy("block").applyInArrow(press, "block int, phrases binary"), blocks


def read_phrases(raw: bytes, window: int) -> Phrases:
    with pa.ipc.open_stream(zstandard.decompress(raw)) as reader:
        rows = reader.read_all()
    return Phrases(list(zip(rows["item_id"].to_pylist(), rows["text"].to_pylist())), window)


def _spread(phrases: DataFrame, shards: int) -> DataFrame:
    """A copy of every block for each shard; the copies of one block are made by many tasks."""
    salts = int(np.ceil(np.sqrt(shards)))
    salted = phrases.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.repartition(salts, "salt", "block").select(
        "block", "phrases", F.explode(F.sequence("salt", F.lit(salts * salts - 1), F.lit(salts)))
        .alias("batch")).where(F.col("batch") < shards)


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       with_text: bool = False, shard_bytes: int = SHARD_BYTES,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Where windows of ``benchmark`` items stand in documents.

    A window is ``window`` consecutive words of an item, or all words of a shorter item. Returns
    for each row of ``docs``: ``batch, place`` (shard and place in it), ``doc_id``, ``n_words``,
    ``spans`` (maximal runs of word numbers inside any window), ``items`` (sorted as text) and
    ``text`` (null unless ``with_text``). Rows are dealt into shards by the hash of id and
    text; each shard meets each block of the benchmark once. Every row is kept, repeated and null ids
    too; a null text has no words. Items without id count in spans only, items without words or
    text nowhere. An empty benchmark gives no spans.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    shards = shared.n_batches(rows, shard_bytes)
    phrases, blocks = phrase_blocks(benchmark, block_bytes)
    dealt = rows.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int").alias("batch"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "doc_id", "text") \
        .repartition(min(shards * blocks, 1 << 16), "batch", "block")

    def search(table: pa.Table, phrase_table: pa.Table) -> pa.Table:
        table = shared.in_order(table)
        texts = table["text"].to_pylist()
        raw = phrase_table["phrases"].to_pylist()
        own = read_phrases(raw[0], window) if raw else Phrases([], window)
        mask, bounds, text, item = search_shard(texts, own)
        spans, items = [[] for _ in texts], [[] for _ in texts]
        hit = np.unique(np.searchsorted(bounds, np.flatnonzero(mask), side="right") - 1)
        for k in hit.tolist():
            spans[k] = mask_spans(mask[bounds[k]:bounds[k + 1]])
        for k, i in zip(text.tolist(), item.tolist()):
            items[k].append(own.items[i])
        return pa.table({
            "batch": table["batch"].cast(pa.int32()), "place": pa.array(range(len(texts)), pa.int64()),
            "doc_id": table["doc_id"], "n_words": pa.array(np.diff(bounds)),
            "spans": pa.array(spans, SPANS), "items": pa.array(items, pa.list_(pa.string())),
            "text": table["text"].cast(pa.string()) if with_text
            else pa.nulls(len(texts), pa.string())})
    found = dealt.groupBy("batch", "block").cogroup(
        _spread(phrases, shards).groupBy("batch", "block")).applyInArrow(search, FOUND)
    return found if blocks == 1 else _merged(found)


def _merged(found: DataFrame) -> DataFrame:
    """One row for each document from its rows of several benchmark blocks."""
    spans = F.array_sort(F.flatten(F.collect_list("spans")))
    item = F.array_distinct(F.array_sort(F.flatten(F.collect_list("items"))))
    one = found.groupBy("batch", "place").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        spans.alias("spans"), item.alias("items"), F.first("text").alias("text"))
    # sorted spans: a span that begins inside or right behind the last one lengthens it
    joined = F.aggregate(
        "spans", F.array().cast("array<struct<start:bigint,stop:bigint>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["start"] <= F.element_at(done, -1)["stop"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                F.element_at(done, -1)["start"].alias("start"),
                F.greatest(F.element_at(done, -1)["stop"], s["stop"]).alias("stop")))))
        .otherwise(F.concat(done, F.array(s))))
    return one.withColumn("spans", joined)


def contamination_digests(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``contaminated_spans`` as counts: ``doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated``."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return contaminated_spans(docs, benchmark, window).select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def cut_words(text: str, spans: list[dict]) -> str:
    """``text`` without the words of ``spans`` and what stands between them."""
    raw = text.encode("utf-8")
    at = [m.span() for m in _WORD.finditer(raw.translate(_WORDS))]
    out, done = [], 0
    for span in spans:
        out.append(raw[done:at[span["start"]][0]])
        done = at[span["stop"] - 1][1]
    return b"".join([*out, raw[done:]]).decode("utf-8")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, text`` of every row of ``docs`` without the spans of ``contaminated_spans``; a null text
    is empty."""
    def cut(batches):
        for batch in batches:
            spans = batch.column("spans").to_pylist()
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 pa.array([cut_words(t, s) if s else t for t, s in zip(texts, spans)], pa.string())],
                names=["doc_id", "text"])
    return contaminated_spans(docs, benchmark, window, with_text=True) \
        .select("doc_id", "text", "spans").mapInArrow(cut, "doc_id long, text string")
