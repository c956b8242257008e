"""Small inputs and brute-force versions shared by the tests of this folder."""
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()),
    ("source", T.StringType()), ("n_chars", T.LongType()),
    # names that operators use inside
    ("batch", T.StringType()), ("node", T.StringType()), ("score", T.StringType()),
    ("class_id", T.StringType()), ("order", T.StringType()), ("c0", T.StringType()),
    ("was_null", T.StringType()), ("label", T.StringType()), ("sequence_id", T.StringType()))])

PASSAGE = "a passage that several documents have in common, longer than fifty bytes – für alle"
LONG = " ".join(f"word{k % 977} number {k}" for k in range(15_000))


def edge_texts():
    """Nulls, empty and blank texts, ties, repeats, one very long text, odd characters."""
    rnd = random.Random(5)
    prose = [" ".join(rnd.choice("alpha beta gamma delta omega of the and in".split())
                      for _ in range(60)) for _ in range(6)]
    return [
        (1, prose[0]), (2, prose[0]), (3, prose[0].replace("alpha", "Alpha", 1)),
        (4, prose[1] + " " + PASSAGE), (5, PASSAGE + "\n" + prose[2]), (6, None), (7, ""), (8, " \n\t "),
        (9, "one two three"), (10, "one two three"), (None, prose[0]), (None, None), (11, prose[3]),
        (11, prose[3]), (11, prose[4]), (12, LONG), (13, LONG + " tail"), (14, "日本語 Σίσυφος 😀 ñandú"),
        (15, "a" * 400), (16, "<|endoftext|> don't <|startoftext|>"), (17, "12 345"), (-4, prose[5])]


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en" if (i or 0) % 2 else "fr", "s", None if t is None else len(t), "x", "y", None,
          "z", "o", "q", None, "l", "m") for i, t in rows], DOCS)


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def brute_shingles(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    if len(words) < 5:
        return Counter([tuple(words)]) if words else Counter()
    return Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))


def brute_classes(rows, damping=0.25, similarity=0.8):
    """Class of each row number: smallest id of its connected rows."""
    sets = [brute_shingles(t) for _, t in rows]
    df = Counter(s for own in sets for s in own)
    n = len(rows)
    weight = {s: 1 + damping * math.log(n / c) / math.log(max(n, 2)) for s, c in df.items()}
    places = defaultdict(list)
    for i, own in enumerate(sets):
        for s in own:
            places[s].append(i)
    total = [sum(c * weight[s] for s, c in own.items()) for own in sets]
    label = list(range(n))

    def find(a):
        while label[a] != a:
            a = label[a]
        return a
    for i, own in enumerate(sets):
        both = Counter()
        for s, c in own.items():
            for j in places[s]:
                if j < i:
                    both[j] += min(c, sets[j][s]) * weight[s]
        for j, v in both.items():
            if v >= similarity * (total[i] + total[j] - v) * (1 - 1e-12):
                label[find(i)] = find(j)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[find(i)] = min(low.get(find(i), doc_id), doc_id)
    return [low.get(find(i)) for i in range(n)]


def brute_removed(rows, length=50):
    """Mask of removed bytes of each row."""
    big = 1 << 62
    raws = [(big if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, raw in raws:
        for s in range(len(raw) - length + 1):
            gram = raw[s:s + length]
            first[gram] = min(first.get(gram, big), i)
    out = []
    for i, raw in raws:
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - length + 1):
            if first[raw[s:s + length]] < i:
                gone[s:s + length] = True
        out.append(gone)
    return out


def spans(gone):
    return int((gone[1:] & ~gone[:-1]).sum() + (len(gone) > 0 and gone[0]))
