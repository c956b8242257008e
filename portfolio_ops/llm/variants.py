"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

A word is a vector of counts, one for each group of letters. One edit changes the vector by at
most one in surplus and one in deficit, so the trie that arranges words by one count after the
other is searched depth first with a budget of one each; the words of a leaf are compared
letter by letter. The first levels of the trie (few wide groups) deal words to Spark tasks, the
further ones (single letters) are searched inside a task.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portfolio_ops.llm.text import changes, mix, release_memory
from portfolio_ops.session import stage, unstage

SHORTEST = 7
NOISE = 31            # one run in so many loses a code point
HELD_WORDS = 150_000  # words a task counts before it hands them on
NODE_WORDS = 8_000    # words that a trie node of the upper levels should have
BLOCK_WORDS = 20_000  # words of one node in one task
LEAF = 6              # words that are compared without a further level
LETTER_LEVELS = 34
PAIRS = 1 << 20       # leaf pairs compared at once

# every run of the letters of Latin-1 with at least SHORTEST of them, lower-cased in A-Z
_RUNS = re.compile(rb"[a-z\xc0-\xff]{%d,}" % SHORTEST)


def noisy_words(doc_id: int | None, text: str) -> Iterator[tuple[bytes, int]]:
    """Words of a text in Latin-1 and how often, after the deletion that ``crc32`` of id and run
    decides. Characters beyond Latin-1 part runs. A null id is written as nothing."""
    raw = text.encode("latin-1", "replace").lower()
    prefix = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
    for run, times in Counter(_RUNS.findall(raw)).items():
        utf8 = run if run.isascii() else run.decode("latin-1").encode("utf-8")
        h = zlib.crc32(utf8, prefix)
        if h % NOISE == 0:
            k = h % len(run)
            run = run[:k] + run[k + 1:]
            if len(run) < SHORTEST:
                continue
        yield run, times


def word_counts(docs: DataFrame, least: int = 2) -> DataFrame:
    """``word, n`` of every word of at least seven code points with ``least`` occurrences."""
    def count(batches):
        held: Counter = Counter()

        def rows():
            out = pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in held], pa.string()),
                 pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return out
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for word, times in noisy_words(doc_id, text.as_py()):
                    held[word] += times
                if len(held) > HELD_WORDS:
                    yield rows()
        yield rows()
        release_memory()
    return docs.where("text is not null").select(F.col("doc_id").cast("long"), "text") \
        .mapInArrow(count, "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


@dataclass
class Levels:
    """Levels of the trie, as tables from a Latin-1 code to its group."""
    wide: np.ndarray     # first levels: few groups of letters
    n_wide: int
    letters: np.ndarray  # further levels: single letters, the rarest together
    n_letters: int


def levels(words: DataFrame, n_words: int) -> Levels:
    """Levels from the letter counts of all words, at most one row for each Latin-1 code.

    Wide groups are dealt in turns by frequency, so that their counts are alike; there are as many as
    leave about ``NODE_WORDS`` words in a node, at six usual counts a level.
    """
    def count(batches):
        total = np.zeros(256, np.int64)
        for batch in batches:
            raw = "".join(batch.column(0).to_pylist()).encode("latin-1")
            total += np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["code", "n"])
    found = words.select("word").mapInArrow(count, "code long, n long") \
        .groupBy("code").agg(F.sum("n").alias("n")).collect()
    ordered = [r["code"] for r in sorted(found, key=lambda r: (-r["n"], r["code"]))]
    n_wide = 2
    while n_wide < 7 and 6 ** n_wide * NODE_WORDS < n_words:
        n_wide += 1
    wide, letters = np.zeros(256, np.int64), np.zeros(256, np.int64)
    for k, code in enumerate(ordered):
        turn = k % (2 * n_wide)
        wide[code] = min(turn, 2 * n_wide - 1 - turn)
        letters[code] = min(k, LETTER_LEVELS - 1)
    return Levels(wide, n_wide, letters, max(1, min(len(ordered), LETTER_LEVELS)))


class Words:
    """Words of one table as one array of Latin-1 codes."""

    def __init__(self, words: list[str]):
        self.raw = [w.encode("latin-1") for w in words]
        self.sizes = np.array([len(w) for w in self.raw], np.int64)
        self.codes = np.frombuffer(b"".join(self.raw), np.uint8)
        self.owner = np.repeat(np.arange(len(words)), self.sizes)

    def counts(self, group: np.ndarray, n: int) -> np.ndarray:
        """Vector of each word: letters of each group."""
        flat = np.bincount(self.owner * n + group[self.codes], minlength=len(self.raw) * n)
        return flat.reshape(len(self.raw), n).astype(np.int32)

    def hashes(self) -> np.ndarray:
        return np.array([zlib.crc32(w) for w in self.raw], np.uint64)


def differences(n: int) -> np.ndarray:
    """Vector differences that a surplus and a deficit of one allow, none first."""
    out = [np.zeros(n, np.int32)]
    unit = np.eye(n, dtype=np.int32)
    for i in range(n):
        out += [unit[i], -unit[i]]
        out += [unit[i] - unit[j] for j in range(n) if j != i]
    return np.array(out)


BITS = 9  # of a node number for each wide level; counts wrap around, which only merges nodes


def node_numbers(vectors: np.ndarray) -> np.ndarray:
    steps = np.int64(1) << (BITS * np.arange(vectors.shape[1], dtype=np.int64))
    return ((vectors.astype(np.int64) & ((1 << BITS) - 1)) * steps).sum(axis=1)


def node_sizes(words: DataFrame, own: Levels, block_words: int, most: int = 50_000) -> dict[int, int]:
    """Blocks of each upper node with more than ``block_words`` words, from counts made by Spark.

    At most ``most`` nodes reach the driver: the block grows with the vocabulary beyond
    ``most * block_words`` words, so fewer nodes can exceed it.
    """
    def number(batches):
        for batch in batches:
            nodes = node_numbers(Words(batch.column(0).to_pylist()).counts(own.wide, own.n_wide))
            yield pa.RecordBatch.from_arrays([pa.array(nodes)], names=["node"])
    found = words.select("word").mapInArrow(number, "node long").groupBy("node").count() \
        .where(F.col("count") > block_words).limit(most).collect()
    return {r["node"]: -(-r["count"] // block_words) for r in found}


MEETING = "node long, part int, query_part int, word string, n long, stored boolean"


def meetings(words: DataFrame, own: Levels, blocks: dict[int, int]) -> DataFrame:
    """Words as stored words of their upper node, and as queries at every node within the budget.

    A node of several blocks has its stored words in parts by hash; queries of part ``q`` of any node
    meet as one block, so a task holds at most one block of stored words and one block of
    queries from each node around.
    """
    around = differences(own.n_wide)
    large = np.array(sorted(blocks), np.int64)
    sizes = np.array([blocks[x] for x in large.tolist()], np.int64)

    def parts_of(nodes):
        if not len(large):
            return np.ones(len(nodes), np.int64)
        at = np.minimum(np.searchsorted(large, nodes), len(large) - 1)
        return np.where(large[at] == nodes, sizes[at], 1)

    def spread(index, counts):
        """Each of ``index`` as often as ``counts`` says, and the numbers from 0."""
        ends = np.cumsum(counts)
        return np.repeat(index, counts), np.arange(int(ends[-1]) if len(ends) else 0) \
            - np.repeat(ends - counts, counts)

    def meet(batches):
        for batch in batches:
            column = batch.column(0)
            these = Words(column.to_pylist())
            vectors = these.counts(own.wide, own.n_wide)
            home = node_numbers(vectors)
            part = (mix(these.hashes()) % parts_of(home).astype(np.uint64)).astype(np.int64)
            everyone = np.arange(len(home))
            meet_parts = np.ones(len(home), np.int64)
            for d in around:
                there = vectors + d
                near = np.flatnonzero((there >= 0).all(axis=1))
                node = node_numbers(there[near])
                parts = parts_of(node)
                meet_parts[near] = np.maximum(meet_parts[near], parts)
                at, number = spread(np.arange(len(near)), parts)
                yield rows(column, near[at], node[at], number, part[near[at]], None)
            at, number = spread(everyone, meet_parts)
            yield rows(column, at, home[at], part[at], number, batch.column(1))

    def rows(column, at, node, part, query_part, n):
        take = pa.array(at)
        return pa.RecordBatch.from_arrays(
            [pa.array(node), pa.array(part.astype(np.int32)), pa.array(query_part.astype(np.int32)),
             column.take(take), pa.nulls(len(at), pa.int64()) if n is None else n.take(take),
             pa.array(np.full(len(at), n is not None))],
            names=["node", "part", "query_part", "word", "n", "stored"])
    return words.select("word", "n").mapInArrow(meet, MEETING)


def leaf_pairs(stored: np.ndarray, queries: np.ndarray, leaf: int
               ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (stored row, query row) whose vectors differ by at most one in surplus and one in
    deficit, by a depth-first search of the trie of the stored vectors.

    A node is a range of the sorted vectors. All queries that reach it come with what they have
    spent: bit 0 a surplus, bit 1 a deficit. Below ``leaf`` words the levels left are compared
    at once.
    """
    n_levels = stored.shape[1]
    order = np.lexsort(stored.T[::-1])
    rows = stored[order]
    columns = np.ascontiguousarray(rows.T)
    own = np.ascontiguousarray(queries.T)
    stack = [(0, 0, len(rows), np.arange(len(queries)), np.zeros(len(queries), np.int8))]
    while stack:
        level, low, high, near, spent = stack.pop()
        while level < n_levels and high - low > leaf and columns[level, low] == columns[level, high - 1]:
            near, spent = _step(columns[level, low], own[level], near, spent)
            level += 1
        if not len(near):
            continue
        if high - low <= leaf or level == n_levels:
            size = max(1, PAIRS // max(1, (high - low) * (n_levels - level)))
            for k in range(0, len(near), size):
                q, s = near[k:k + size], spent[k:k + size]
                apart = rows[None, low:high, level:] - queries[q, None, level:]
                surplus = np.maximum(apart, 0).sum(axis=2) + (s & 1)[:, None]
                deficit = np.maximum(-apart, 0).sum(axis=2) + (s >> 1)[:, None]
                at, word = np.nonzero((surplus <= 1) & (deficit <= 1))
                yield order[low + word], q[at]
            continue
        values = columns[level, low:high]
        heads = low + np.flatnonzero(np.append(True, values[1:] != values[:-1]))
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), high]):
            stack.append((level + 1, a, b, *_step(columns[level, a], own[level], near, spent)))


def _step(count, own, near, spent):
    """Queries that may go to the child ``count`` and what they have spent then."""
    apart = count - own[near]
    same = apart == 0
    more = (apart == 1) & ((spent & 1) == 0)
    less = (apart == -1) & ((spent & 2) == 0)
    go = same | more | less
    return near[go], (spent | more | (less.astype(np.int8) << 1))[go].astype(np.int8)


WIDE = 48  # longer words are compared one pair at a time


def one_edit(a: bytes, b: bytes) -> bool:
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def _matrix(words: Words, left: bool) -> np.ndarray:
    """Codes of words of at most ``WIDE`` letters, aligned left or right and filled with 0."""
    out = np.zeros((len(words.raw), WIDE), np.uint8)
    short = words.sizes[words.owner] <= WIDE
    heads = np.cumsum(words.sizes) - words.sizes
    at = np.arange(len(words.codes)) - heads[words.owner]
    if not left:
        at = WIDE - words.sizes[words.owner] + at
    out[words.owner[short], at[short]] = words.codes[short]
    return out


def _prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    unlike = a != b
    return np.where(unlike.any(axis=1), unlike.argmax(axis=1), WIDE)


class Edits:
    """Checks pairs of a stored word and a query letter by letter."""

    def __init__(self, stored: Words, queries: Words):
        self.stored, self.queries = stored, queries
        self.left = _matrix(stored, True), _matrix(queries, True)
        self.right = _matrix(stored, False), _matrix(queries, False)

    def one(self, word: np.ndarray, query: np.ndarray) -> np.ndarray:
        a, b = self.stored.sizes[word], self.queries.sizes[query]
        shorter, longer = np.minimum(a, b), np.maximum(a, b)
        fit = longer - shorter <= 1
        small = np.flatnonzero(fit & (longer <= WIDE))
        w, q = word[small], query[small]
        # what begins alike and what ends alike leaves one letter of the longer word
        alike = np.minimum(_prefix(self.left[0][w], self.left[1][q]), shorter[small])
        ends = np.minimum(_prefix(self.right[0][w][:, ::-1], self.right[1][q][:, ::-1]), shorter[small])
        same = (a == b)[small] & (alike == shorter[small])
        out = np.zeros(len(word), bool)
        out[small] = ~same & (alike + ends >= longer[small] - 1)
        for k in np.flatnonzero(fit & (longer > WIDE)).tolist():
            out[k] = one_edit(self.stored.raw[word[k]], self.queries.raw[query[k]])
        return out


FOUND = "word string, n_near long, form_n long, form string"


def near_words(table: pa.Table, own: Levels, leaf: int = LEAF) -> pa.Table:
    """Of every query of one meeting with a near stored word: how many there are, and the one of largest
    count, then smallest in code-point order."""
    is_stored = table["stored"].combine_chunks()
    stored_rows, query_rows = table.filter(is_stored), table.filter(pa.compute.invert(is_stored))
    names = stored_rows["word"].to_pylist()
    stored, queries = Words(names), Words(query_rows["word"].to_pylist())
    counts = stored_rows["n"].to_numpy()
    place = np.empty(len(names), np.int64)
    place[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
    n_near = np.zeros(len(queries.raw), np.int64)
    best = np.full(len(queries.raw), -1, np.int64)
    # stored words by count, then code points backwards: the largest place wins
    by_count = np.lexsort((-place, counts))
    value = np.empty(len(names), np.int64)
    value[by_count] = np.arange(len(names))
    if len(names) and len(queries.raw):
        check = Edits(stored, queries)
        vectors = stored.counts(own.letters, own.n_letters), queries.counts(own.letters, own.n_letters)
        for word, query in gathered(leaf_pairs(*vectors, leaf)):
            hit = check.one(word, query)
            word, query = word[hit], query[hit]
            n_near += np.bincount(query, minlength=len(n_near))
            np.maximum.at(best, query, value[word])
    at = np.flatnonzero(n_near)
    form = by_count[best[at]]
    return pa.table({"word": query_rows["word"].take(pa.array(at)), "n_near": n_near[at],
                     "form_n": counts[form], "form": pa.array([names[k] for k in form.tolist()],
                                                              pa.string())})


def gathered(pairs: Iterator[tuple[np.ndarray, np.ndarray]], least: int = 1 << 16
             ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Small arrays of pairs put together."""
    held, n = [], 0
    for pair in pairs:
        held.append(pair)
        n += len(pair[0])
        if n >= least:
            yield tuple(np.concatenate(x) for x in zip(*held))
            held, n = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def near_summary(words: DataFrame, n_words: int, block_words: int = BLOCK_WORDS,
                 own: Levels | None = None) -> DataFrame:
    """``word, n_near, best`` for every word with a near one; ``best`` is ``(-n, word)`` of the most frequent."""
    own = own or levels(words, n_words)
    met = meetings(words, own, node_sizes(words, own, max(block_words, n_words // 50_000)))
    found = met.groupBy("node", "part", "query_part").applyInArrow(
        lambda table: near_words(table, own), FOUND)
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``forms (word, form)``: the last form that following forms leads to.

    Each round joins what is known with itself, so that the steps double; a form is ten times as
    frequent as its word, so few rounds are needed.
    """
    known = stage(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while known.where("moved").limit(1).count():
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        following = stage(known.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), "roots")
        unstage(known)
        known = following
    return known.select("word", "root")


def spelling_variants(docs: DataFrame, ratio: int = 10) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the corpus.

    Words are the letter runs of Latin-1 with the deletions of ``noisy_words``, of at least
    seven code points and two occurrences. ``n_near`` counts the words one edit away; ``form`` is the most
    frequent of them (ties: the smallest), if at least ``ratio`` times as frequent, else null;
    ``root`` is where following forms ends, the word itself without a form. Null texts have no words;
    equal rows count each time; no words give no rows.
    """
    words = stage(word_counts(docs), "words")
    n_words = words.count()
    near = words.join(near_summary(words, n_words), "word", "left")
    is_form = -F.col("best.less") >= ratio * F.col("n")
    out = stage(near.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.form")).alias("form"),
        F.when(is_form, -F.col("best.less")).alias("form_n")), "variants")
    unstage(words)
    last = roots(out.where("form is not null"))
    return out.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
