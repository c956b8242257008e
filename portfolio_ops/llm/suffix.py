"""Removal of long byte strings that earlier documents have too, by suffix sorting.

Windows of ``length`` bytes are compared. Each window is owned by the place inside it whose
short gram hashes lowest, so equal windows have equal owners. Owners whose gram no other
document has are left behind; around the rest, the bytes of their windows are collected by
gram, suffix-sorted in two stages, and neighbours with a common prefix of ``length`` give the
smallest document of every window.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portfolio_ops.llm import shared
from portfolio_ops.llm.text import changes, id_and_text, mix, power, span_hashes

LENGTH = 50
GRAM = 26
BATCH_BYTES = 4 << 20
PARTS = 256             # of a key range
SORTED_BYTES = 1 << 20  # contexts sorted together, unless one part has more
SEPARATOR = 0xFF  # no byte of UTF-8
HOT = 4096        # contexts of one key that may meet


def word_at(values: np.ndarray) -> np.ndarray:
    """The eight bytes from every place as one number, first byte highest."""
    n = len(values)
    padded = np.zeros(n + 8, np.uint64)
    padded[:n] = values
    word = np.zeros(n, np.uint64)
    for k in range(8):
        word |= padded[k:k + n] << np.uint64(56 - 8 * k)
    return word


def smaller_than_next(values: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one that starts a place later."""
    n = len(values)
    out = np.zeros(n, bool)
    if n < 2:
        return out
    differs = values[:-1] != values[1:]
    where = np.where(differs, np.arange(n - 1), n)
    following = np.minimum.accumulate(where[::-1])[::-1]
    known = following < n
    at = following[known]
    out[:-1][known] = values[at] < values[at + 1]
    return out


def sort_by_words(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Places in order of their first ``depth`` bytes, eight at a time; only places still
    equal are sorted on."""
    def word(at):
        return np.where(at < len(words), words[np.minimum(at, len(words) - 1)], np.uint64(0))
    order = places[np.argsort(words[places], kind="stable")]
    open_ = np.arange(len(order))
    group = np.zeros(len(order), np.int64)
    for step in range(0, depth, 8):
        key = word(order[open_] + step)
        if step:
            again = np.lexsort((key, group))
            order[open_], key, group = order[open_][again], key[again], group[again]
        number = np.cumsum(changes(key, group)) - 1
        several = np.bincount(number, minlength=1)[number] > 1
        open_, group = open_[several], number[several]
        if not len(open_):
            break
    return order


def two_stage_order(values: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array, right up to ``depth`` bytes.

    Suffixes smaller than their successor are sorted directly. A scan over the buckets of the
    first byte puts every other suffix in place: it follows its successor, which comes first.
    A bucket's scan goes in waves where the byte repeats.
    """
    n = len(values)
    if not n:
        return np.zeros(0, np.int64)
    direct = smaller_than_next(values)
    places = np.flatnonzero(direct)
    sorted_direct = sort_by_words(places, words, depth)
    first = values[sorted_direct]
    cuts = np.searchsorted(first, np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[values[-1]].append(np.array([n - 1]))
    out = []

    def deal(ahead: np.ndarray) -> None:
        byte = values[ahead]
        ahead = ahead[np.argsort(byte, kind="stable")]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(byte, minlength=256))])
        for b in np.flatnonzero(np.diff(bounds)).tolist():
            induced[b].append(ahead[bounds[b]:bounds[b + 1]])

    def before(found: np.ndarray) -> np.ndarray:
        ahead = found[found > 0] - 1
        return ahead[~direct[ahead]]

    for byte in range(256):
        wave = np.concatenate(induced[byte]) if induced[byte] else np.zeros(0, np.int64)
        induced[byte] = []
        while len(wave):
            out.append(wave)
            ahead = before(wave)
            same = values[ahead] == byte
            deal(ahead[~same])
            wave = ahead[same]
        own = sorted_direct[cuts[byte]:cuts[byte + 1]]
        if len(own):
            out.append(own)
            deal(before(own))
    return np.concatenate(out)


def common_prefixes(order: np.ndarray, words: np.ndarray, length: int) -> np.ndarray:
    """Bytes that each suffix of ``order`` shares with the one before it, up to ``length``."""
    n = len(order)
    common = np.zeros(n, np.int64)
    if n < 2:
        return common
    going = np.arange(1, n)
    for step in range(0, length, 8):
        a, b = order[going] + step, order[going - 1] + step
        inside = (a < len(words)) & (b < len(words))
        going, a, b = going[inside], a[inside], b[inside]
        unlike = words[a] ^ words[b]
        equal = unlike == 0
        top = np.zeros(len(unlike), np.int64)
        rest = unlike.copy()
        for k in range(1, 8):
            top += (rest >> np.uint64(64 - 8 * k)) == 0
        common[going] += np.where(equal, 8, top)
        going = going[equal]
        if not len(going):
            break
    return np.minimum(common, length)


def smallest_documents(contexts: np.ndarray, starts: np.ndarray, sizes: np.ndarray,
                       owner: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of every context the smallest owner of an equal window.

    ``contexts`` holds the contexts, each followed by a separator. Returns window places and
    smallest owners, by place.
    """
    words = word_at(contexts)
    order = two_stage_order(contexts, words, length)
    number = np.repeat(np.arange(len(starts)), sizes + 1)
    room = starts[number] + sizes[number] - np.arange(len(contexts))
    order = order[room[order] >= length]
    if not len(order):
        return order, order
    fresh = common_prefixes(order, words, length) < length
    fresh[0] = True
    heads = np.flatnonzero(fresh)
    low = np.minimum.reduceat(owner[number[order]], heads)
    low = np.repeat(low, np.diff(np.append(heads, len(order))))
    back = np.argsort(order)
    return order[back], low[back]


@dataclass
class Owners:
    """Owned runs of windows of a batch. A run is ``low..high`` window starts in ``raw``."""
    raw: np.ndarray
    ids: np.ndarray
    offsets: np.ndarray
    key: np.ndarray
    doc: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` of ``values[i:i + width]`` for every full window."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = best(out[:-step], out[step:])
        have += step
    return out


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """Polynomial hash of the ``gram`` bytes from every place; the same bytes, the same hash."""
    n = len(raw) - gram + 1
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power("up", len(raw))[:len(raw)], out=sums[1:])
    return (sums[gram:] - sums[:n]) * power("down", n)[:n]


def own_windows(ids: np.ndarray, texts: list[str], length: int = LENGTH, gram: int = GRAM) -> Owners:
    """Runs of windows with one owner: the first place of the least gram hash inside them.

    From one window to the next the owner changes where it is left behind or a lesser hash
    comes in.
    """
    parts = []
    raws = [t.encode("utf-8") for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raws], dtype=np.int64)])
    raw = np.frombuffer(b"".join(raws), np.uint8)
    width = length - gram + 1
    for a, b in shared.text_runs(texts):
        base, stop = offsets[a], offsets[b]
        if stop - base < length:
            continue
        h = gram_hashes(raw[base:stop], gram)
        rank = ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)).astype(np.uint32)
        least = _sliding(rank, width, np.minimum)
        n = len(least)
        fresh = np.ones(n + 1, bool)
        fresh[1:n] = (rank[:n - 1] == least[:-1]) | (least[1:] < least[:-1])
        inner = offsets[a:b + 1] - base
        fresh[inner[inner < n]] = True
        past = np.maximum(inner[1:] - length + 1, inner[:-1])   # first window that leaves its text
        fresh[past[past < n]] = True
        edges = np.flatnonzero(fresh)
        low, high = edges[:-1], edges[1:] - 1
        doc = np.searchsorted(inner, low, side="right") - 1
        inside = low + length <= inner[doc + 1]
        low, high, doc = low[inside], high[inside], doc[inside]
        if len(low):
            owner = low + sliding_window_view(rank, width)[low].argmin(axis=1)
            parts.append((mix(h[owner]), doc + a, base + low, base + high))
    key, doc, low, high = (np.concatenate(c) if c else np.zeros(0, np.int64)
                           for c in (zip(*parts) if parts else ((), (), (), ())))
    return Owners(raw, ids, offsets, key.astype(np.uint64), doc.astype(np.int64),
                  low.astype(np.int64), high.astype(np.int64))


def contents(own: Owners, length: int = LENGTH) -> np.ndarray:
    """Hash of the bytes of each run's windows."""
    out = np.empty(len(own.key), np.uint64)
    start = 0
    while start < len(out):
        stop = int(np.searchsorted(own.low, own.low[start] + (1 << 20)))
        base, end = own.low[start], own.high[stop - 1] + length
        part = slice(start, stop)
        out[part] = span_hashes(own.raw[base:end], own.low[part] - base, own.high[part] + length - base)
        start = stop
    return out


def batch_keys(ids: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct owner keys; 1 where one document id has it, else the number of its different
    contexts, at least 2."""
    own = own_windows(ids, texts)
    order = np.argsort(own.key, kind="stable")
    key, doc = own.key[order], own.ids[own.doc[order]]
    heads = np.flatnonzero(changes(key))
    if not len(heads):
        return key, np.zeros(0, np.int64)
    several = np.maximum.reduceat(doc, heads) != np.minimum.reduceat(doc, heads)
    counts = np.ones(len(heads), np.int64)
    number = np.cumsum(changes(key)) - 1
    some = np.flatnonzero(several[number])
    if len(some):
        content = contents(own)[order[some]]
        which, content = number[some], content
        again = np.lexsort((content, which))
        fresh = changes(which[again], content[again])
        counts += np.where(several, np.maximum(
            np.bincount(which[again][fresh], minlength=len(heads)), 2) - 1, 0)
    return key[heads], counts


@dataclass
class Contexts:
    """Distinct contexts of a batch, sorted by key. ``own`` has the runs that count; ``of_run``
    is the context of each, ``run`` a run that has a context."""
    own: Owners
    of_run: np.ndarray
    run: np.ndarray
    low: np.ndarray
    several: np.ndarray


def batch_contexts(own: Owners, answers: pa.Table, count: int, length: int = LENGTH,
                   hot: int = HOT) -> Contexts:
    """Contexts of the keys that other documents have too.

    The windows of a key with more than ``hot`` contexts in the corpus are dealt one by one,
    by the hash of their own bytes. Equal windows still meet, and no key range gets all the
    surroundings of a line that a large part of the documents has.
    """
    keys, number = np.unique(own.key, return_inverse=True)
    total = shared.apply_answers(keys, answers, count)[number]
    key, doc, low, high = (v[(total > 1) & (total <= hot)] for v in (own.key, own.doc, own.low, own.high))
    many = np.flatnonzero(total > hot)
    if len(many):
        sizes = own.high[many] - own.low[many] + 1
        at = np.repeat(own.low[many] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        alone = Owners(own.raw, own.ids, own.offsets, np.zeros(len(at), np.uint64),
                       np.repeat(own.doc[many], sizes), at, at)
        key, doc = np.concatenate([key, contents(alone, length)]), np.concatenate([doc, alone.doc])
        low, high = np.concatenate([low, at]), np.concatenate([high, at])
        placed = np.argsort(low, kind="stable")
        key, doc, low, high = key[placed], doc[placed], low[placed], high[placed]
    own = Owners(own.raw, own.ids, own.offsets, key, doc, low, high)
    content = contents(own, length)
    order = np.lexsort((content, key))
    fresh = changes(key[order], content[order])
    of_run = np.empty(len(key), np.int64)
    of_run[order] = np.cumsum(fresh) - 1
    heads = np.flatnonzero(fresh)
    ids = own.ids[doc[order]]
    first = np.minimum.reduceat(ids, heads) if len(heads) else ids
    last = np.maximum.reduceat(ids, heads) if len(heads) else ids
    return Contexts(own, of_run, order[heads], first, first != last)


def gather(raw: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``raw[begin:begin + size]`` of all spans, one after another."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return raw[np.arange(total) + np.repeat(begin - (ends - sizes), sizes)]


SENT = ("batch int, range int, first int, parts binary, docs binary, several binary, "
        "sizes binary, bytes binary")
FOUND = "batch int, contexts binary, starts binary, lengths binary, lows binary"


def contexts_to_send(batch: int, found: Contexts, count: int) -> pa.Table:
    own = found.own
    part = shared.ranges(own.key[found.run], count * PARTS)
    bounds = np.searchsorted(part, np.arange(count + 1) * PARTS)
    packer = zstandard.ZstdCompressor(level=3)
    rows = []
    for r in np.flatnonzero(np.diff(bounds)).tolist():
        a, b = bounds[r], bounds[r + 1]
        low, high = own.low[found.run[a:b]], own.high[found.run[a:b]]
        sizes = high - low + LENGTH
        rows.append((r, a, (part[a:b] % PARTS).astype(np.uint8).tobytes(),
                     found.low[a:b].astype("<i8").tobytes(),
                     np.packbits(found.several[a:b]).tobytes(), sizes.astype("<u2").tobytes(),
                     packer.compress(gather(own.raw, low, sizes).tobytes())))
    columns = list(zip(*rows)) if rows else [[]] * 7
    return pa.table({"batch": pa.array([batch] * len(rows), pa.int32()),
                     "range": pa.array(columns[0], pa.int32()),
                     "first": pa.array(columns[1], pa.int32()),
                     **{n: pa.array(c, pa.binary()) for n, c in
                        zip(("parts", "docs", "several", "sizes", "bytes"), columns[2:])}})


def resolve_range(table: pa.Table) -> pa.Table:
    """Suffix-sort the distinct contexts of one key range, a few parts of it at a time; answer
    each batch with the windows that a smaller document has."""
    part = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in table["parts"]])
    counts = np.array([len(x.as_py()) for x in table["parts"]])
    docs = np.concatenate([np.frombuffer(x.as_py(), "<i8") for x in table["docs"]])
    several = np.concatenate([np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=n)
                              for x, n in zip(table["several"], counts)]).astype(bool)
    raw = np.frombuffer(b"".join(zstandard.decompress(x.as_py()) for x in table["bytes"]), np.uint8)
    size = np.concatenate([np.frombuffer(x.as_py(), "<u2") for x in table["sizes"]]).astype(np.int64)
    begin = np.cumsum(size) - size
    content = span_hashes_by_run(raw, begin, size)
    local = np.arange(len(size)) - np.repeat(np.cumsum(counts) - counts, counts) \
        + np.repeat(table["first"].to_numpy(), counts)
    batch = np.repeat(table["batch"].to_numpy(), counts)

    order = np.lexsort((content, part))
    fresh = changes(part[order], content[order])
    held = np.cumsum(np.where(fresh, size[order], 0))
    heads = np.flatnonzero(changes(part[order]))
    found: list[tuple] = []
    start = 0
    for stop in [*heads[1:].tolist(), len(order)]:
        following = heads[np.searchsorted(heads, stop, side="right")] \
            if stop < heads[-1] else len(order)
        if stop < len(order) and held[following - 1] - (held[start - 1] if start else 0) <= SORTED_BYTES:
            continue
        found.append(_resolve(order[start:stop], fresh[start:stop], raw, begin, size, docs, several))
        start = stop
    entry, run_start, length, low = (np.concatenate(c) for c in zip(*found))
    own = batch[entry]
    arranged = np.argsort(own, kind="stable")
    rows = []
    names = ((local[entry], "<u4"), (run_start, "<u2"), (length, "<u2"), (low, "<i8"))
    for some in np.split(arranged, np.flatnonzero(changes(own[arranged]))[1:]):
        if len(some):
            rows.append((own[some[0]], *(v[some].astype(t).tobytes() for v, t in names)))
    columns = list(zip(*rows)) if rows else [[]] * 5
    return pa.table({"batch": pa.array(columns[0], pa.int32()),
                     **{n: pa.array(c, pa.binary()) for n, c in
                        zip(("contexts", "starts", "lengths", "lows"), columns[1:])}})


def span_hashes_by_run(raw: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of adjoining spans, about a megabyte at a time."""
    out = np.empty(len(begin), np.uint64)
    start = 0
    while start < len(begin):
        stop = max(start + 1, int(np.searchsorted(begin, begin[start] + (1 << 20))))
        base, end = begin[start], begin[stop - 1] + size[stop - 1]
        at = begin[start:stop] - base
        out[start:stop] = span_hashes(raw[base:end], at, at + size[start:stop])
        start = stop
    return out


def _resolve(entries, fresh, raw, begin, size, docs, several):
    """For entries sorted so that equal contexts adjoin (``fresh`` marks the first): entry,
    start, length and smallest document of the runs of windows that an entry may lose."""
    number = np.cumsum(fresh) - 1
    first = entries[fresh]
    owner = np.minimum.reduceat(docs[entries], np.flatnonzero(fresh))
    whole = size[first] + 1
    starts = np.cumsum(whole) - whole
    text = np.full(int(whole.sum()), SEPARATOR, np.uint8)
    keep = np.ones(len(text), bool)
    keep[starts + whole - 1] = False
    text[keep] = gather(raw, begin[first], size[first])
    place, low = smallest_documents(text, starts, size[first], owner, LENGTH)

    # runs of equal smallest document inside a context
    context = np.searchsorted(starts, place, side="right") - 1
    heads = np.flatnonzero(changes(context, low))
    lengths = np.diff(np.append(heads, len(place)))
    context, low = context[heads], low[heads]
    run_start = place[heads] - starts[context]
    bounds = np.searchsorted(context, np.arange(len(first) + 1))

    # to each entry the runs of its context, but for those that no smaller document has
    n = np.diff(bounds)[number]
    entry = np.repeat(entries, n)
    run = np.arange(len(entry)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(bounds[number], n)
    useful = several[entry] | (low[run] < docs[entry])
    entry, run = entry[useful], run[useful]
    return entry, run_start[run], lengths[run], low[run]


def removed_bytes(found: Contexts, answers: pa.Table) -> np.ndarray:
    """True for every byte of the batch that goes."""
    own = found.own
    edge = np.zeros(len(own.raw) + 1, np.int32)
    if answers.num_rows:
        context, start, length, low = (
            np.concatenate([np.frombuffer(x.as_py(), t) for x in answers[c]]).astype(np.int64)
            for c, t in (("contexts", "<u4"), ("starts", "<u2"), ("lengths", "<u2"), ("lows", "<i8")))
        order = np.argsort(context, kind="stable")
        context, start, length, low = context[order], start[order], length[order], low[order]
        bounds = np.searchsorted(context, np.arange(len(found.run) + 1))
        n = np.diff(bounds)[found.of_run]
        run = np.repeat(np.arange(len(own.key)), n)
        at = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(bounds[found.of_run], n)
        goes = low[at] < own.ids[own.doc[run]]
        run, at = run[goes], at[goes]
        begin = own.low[run] + start[at]
        np.add.at(edge, begin, 1)
        np.add.at(edge, begin + length[at] - 1 + LENGTH, -1)
    return np.cumsum(edge[:-1]) > 0


def _batch_docs(own: Owners, gone: np.ndarray):
    """Per document: its bytes and the mask of those that go."""
    for k in range(len(own.ids)):
        a, b = own.offsets[k], own.offsets[k + 1]
        yield own.raw[a:b], gone[a:b]


def _removals(rows: DataFrame, finish, schema, batch_bytes: int, hot: int = HOT) -> DataFrame:
    batches = shared.n_batches(rows, batch_bytes)
    count = shared.range_count(batches)
    batched = shared.in_batches(rows, batches)
    known = shared.shared_keys(batched, batch_keys, count)

    def send(table: pa.Table, answers: pa.Table) -> pa.Table:
        own = own_windows(*shared.sorted_batch(table))
        found = batch_contexts(own, answers, count, hot=hot)
        return contexts_to_send(table["batch"][0].as_py() if table.num_rows else -1, found, count)

    sent = batched.groupBy("batch").cogroup(known.groupBy("batch")).applyInArrow(send, SENT)
    resolved = sent.groupBy("range").applyInArrow(resolve_range, FOUND)
    tagged = known.selectExpr("batch", "range", "shared", "totals", "cast(null as binary) contexts",
                              "cast(null as binary) starts", "cast(null as binary) lengths",
                              "cast(null as binary) lows") \
        .union(resolved.selectExpr("batch", "cast(null as int)", "cast(null as binary)",
                                   "cast(null as binary)", "contexts", "starts", "lengths", "lows"))

    def cut(table: pa.Table, mixed: pa.Table) -> pa.Table:
        ids, texts = shared.sorted_batch(table)
        own = own_windows(ids, texts)
        is_answer = pc.is_valid(mixed["range"])
        found = batch_contexts(own, mixed.filter(is_answer), count, hot=hot)
        gone = removed_bytes(found, mixed.filter(pc.invert(is_answer)))
        return finish(shared.in_order(table), _batch_docs(own, gone))

    return batched.groupBy("batch").cogroup(tagged.groupBy("batch")).applyInArrow(cut, schema)


def remove_repeats(docs: DataFrame, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Bytes of every document covered by a 50-byte string that a smaller ``doc_id`` has too.

    Texts are UTF-8 bytes, null as empty; strings are judged on the input. Returns one row per
    input row: ``doc_id, n_bytes, n_removed, n_spans, kept`` (binary, the bytes left).

    Documents under 50 bytes keep all. Rows with one ``doc_id`` do not remove from each other.
    A null ``doc_id`` is larger than every id: it may lose bytes but takes none from others.
    Other columns are ignored; no rows give no rows.
    """
    def finish(table, docs):
        return _table(table["doc_id"], [(len(r), int(g.sum()), _spans(g), r[~g].tobytes())
                                        for r, g in docs], {"kept": pa.binary()})
    return _removals(id_and_text(docs), finish, "doc_id long, n_bytes long, n_removed long, n_spans long, "
                                   "kept binary", batch_bytes)


def repeat_digests(docs: DataFrame, batch_bytes: int = BATCH_BYTES, hot: int = HOT) -> DataFrame:
    """``remove_repeats`` with ``kept_sha256`` made in the same pass instead of the bytes."""
    def finish(table, docs):
        return _table(table["doc_id"], [(len(r), int(g.sum()), _spans(g),
                                         hashlib.sha256(r[~g].tobytes()).hexdigest())
                                        for r, g in docs], {"kept_sha256": pa.string()})
    return _removals(id_and_text(docs), finish, "doc_id long, n_bytes long, n_removed long, n_spans long, "
                                   "kept_sha256 string", batch_bytes, hot)


def whole_characters(raw: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """``gone`` without the bytes of characters of which some bytes stay."""
    heads = np.flatnonzero((raw & 0xC0) != 0x80)
    if not len(heads):
        return gone
    whole = np.logical_and.reduceat(gone, heads)
    return np.repeat(whole, np.diff(np.append(heads, len(raw))))


def remove_repeats_from_rows(docs: DataFrame, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """The rows of ``docs`` without the bytes that ``remove_repeats`` takes from ``text``.

    All columns are kept, whatever their names. A character that loses only some of its bytes
    stays, so that the text remains valid. Null text stays null.
    """
    names = list(docs.columns)
    others = [i for i, c in enumerate(names) if c not in ("doc_id", "text")]
    place = {c: i for i, c in enumerate(names)}
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    rows = inner.select(
        F.col(f"c{place['doc_id']}").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"c{place['text']}"), F.lit("")).alias("text"),
        F.col(f"c{place['text']}").isNull().alias("was_null"),
        F.col(f"c{place['doc_id']}").alias("own_id"), *[f"c{i}" for i in others])

    def finish(table, pieces):
        kept = [r[~whole_characters(r, g)].tobytes().decode("utf-8") for r, g in pieces]
        text = pa.array(kept, pa.string(), mask=table["was_null"].to_numpy())
        columns = {"text": text, "doc_id": table["own_id"]}
        return pa.table([columns[c] if c in columns else table[f"c{i}"]
                         for i, c in enumerate(names)], names=names)
    return _removals(rows, finish, docs.schema, batch_bytes)


def _spans(gone: np.ndarray) -> int:
    return int((gone[1:] & ~gone[:-1]).sum() + (len(gone) > 0 and gone[0]))


def _table(ids, rows, last: dict) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[]] * 4
    (name, kind), = last.items()
    return pa.table({"doc_id": ids, "n_bytes": pa.array(columns[0], pa.int64()),
                     "n_removed": pa.array(columns[1], pa.int64()),
                     "n_spans": pa.array(columns[2], pa.int64()), name: pa.array(columns[3], kind)})
