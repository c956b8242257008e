"""What filters remove in every order, from the survivors of every set of filters.

Five filters of documents give a mask of failed filters for each row. Rows of one part and
mask are one cell. The survivors of all 32 sets of filters come from one Gray-code walk over a
part's cells, and every step of every order is the difference of two of these sets.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LETTERS = "ABCDE"
VALUES = ["n", "good", "toxic"]


def text_failures(text: Column, words: Column) -> Column:
    """Mask of the filters that need the text alone: A short (1), B repetitive (2), C upper
    case (4), D symbols (8). ``words`` is the array of the words of ``text``."""
    n, chars = F.size(words).cast("long"), F.length(text).cast("long")
    upper = chars - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    failed = [n < 50, 100 * F.size(F.array_distinct(words)).cast("long") < 65 * n,
              100 * upper > 5 * chars, text.rlike("[#$%&*|]")]
    return sum((F.when(f, F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(failed)),
               F.lit(0))


def document_masks(docs: DataFrame) -> DataFrame:
    """``part, doc_id, digest, mask, n``: rows of equal text and id with their failed filters.

    Filter E (16) fails where the same text stands under a smaller ``doc_id`` anywhere in the
    table. A null text is empty, a null ``source`` the part ''. A row without id neither fails
    E nor makes another fail it; rows that repeat one id are no smaller than each other.

    The smallest id of each text is joined on text and id together, so that the copies of a
    frequent text are spread by their ids.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "").alias("words"))
    # a digest that cannot be null: else the join's null filter would part the readers of ``rows``
    digest = F.coalesce(F.unhex(F.sha2("text", 256)), F.lit(b""))
    rows = rows.select("doc_id", "part", digest.alias("digest"),
                       text_failures(F.col("text"), F.col("words")).alias("mask")) \
        .groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    # the count keeps both readers of ``rows`` alike, so that they share one exchange
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"),
                                       F.sum("n").alias("copies")) \
        .where("doc_id is not null and copies > 0") \
        .select("digest", "doc_id", F.lit(True).alias("is_first"))
    late = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return rows.join(first, ["digest", "doc_id"], "left").select(
        "part", "doc_id", "digest",
        (F.col("mask") + F.when(late, 16).otherwise(0)).alias("mask"), "n")


def mask_cells(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents of each part and mask, those labelled quality 1
    and those labelled toxic 1. A document has a label that any of its label rows gives."""
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("key")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("quality"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("is_toxic")) \
        .withColumn("no_id", F.lit(False))
    # rows without id find no label and are spread by their text
    keyed = masks.select(
        "part", "mask", "n", F.col("doc_id").isNull().alias("no_id"),
        F.coalesce("doc_id", F.xxhash64("digest")).alias("key"))
    return keyed.join(known, ["key", "no_id"], "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("quality", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("is_toxic", F.lit(0))).alias("toxic"))


def gray_code_states(masks: np.ndarray, values: np.ndarray, filters: int) -> np.ndarray:
    """Survivors of every set of filters: row ``s`` sums ``values`` of cells failing none of ``s``.

    Consecutive Gray codes differ in one filter. Each cell counts its failures among the
    filters that are on; it leaves the running survivors when the count leaves 0 and comes
    back when it returns to 0.
    """
    states = np.zeros((1 << filters, values.shape[1]), np.int64)
    failing = np.zeros(len(masks), np.int64)
    running = values.sum(axis=0)
    states[0] = running
    subset = 0
    for k in range(1, 1 << filters):
        bit = (k & -k).bit_length() - 1
        subset ^= 1 << bit
        touched = (masks >> bit & 1).astype(bool)
        if subset >> bit & 1:
            running = running - values[touched & (failing == 0)].sum(axis=0)
            failing[touched] += 1
        else:
            failing[touched] -= 1
            running = running + values[touched & (failing == 0)].sum(axis=0)
        states[subset] = running
    return states


def order_steps(states: np.ndarray, letters: str) -> pd.DataFrame:
    """One row for every order of the filters and step, each a difference of two states."""
    k, everything = len(letters), (1 << len(letters)) - 1
    rows = []
    for order in permutations(range(k)):
        before = 0
        for step, f in enumerate(order):
            after = before | 1 << f
            gone = states[before] - states[after]
            failing = states[0, 0] - states[1 << f, 0]
            unique = states[everything ^ 1 << f, 0] - states[everything, 0]
            rows.append(("".join(letters[i] for i in order), step + 1, f, states[after, 0],
                         gone[0], failing - gone[0], unique, gone[1], gone[2]))
            before = after
    out = pd.DataFrame(rows, columns=["filter_order", "step", "filter", "kept", "removed",
                                      "redundant", "unique_fails", "good_lost", "toxic_lost"])
    out["shapley"] = out.groupby("filter")["removed"].transform("sum")
    return out.drop(columns="filter")


STEPS = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
         "unique_fails long, good_lost long, toxic_lost long, shapley long")


def filter_steps(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Every order and step for ``part, mask, n, good, toxic`` cells, bit ``k`` of the mask being
    a failure of filter ``letters[k]``. A group is the cells of one part: at most one row for
    each mask once cells are summed, however many documents it has."""
    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        states = gray_code_states(pdf["mask"].to_numpy(np.int64),
                                  pdf[VALUES].to_numpy(np.int64), len(letters))
        out = order_steps(states, letters)
        out.insert(0, "part", pdf["part"].iloc[0])
        return out.astype({"step": np.int32})
    summed = cells.groupBy("part", "mask").agg(*(F.sum(v).alias(v) for v in VALUES))
    return summed.groupBy("part").applyInPandas(walk, STEPS)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters over every whole text of ``docs``: one row for each part (value of
    ``source``), order and step.

    ``kept`` documents after the step, ``removed`` by it, ``redundant`` (failing the step's filter but
    removed before), ``unique_fails`` (failing that filter only), ``good_lost`` and ``toxic_lost``
    (removed here with such a label), ``shapley`` (removed by the filter, summed over all
    orders). Each row of ``docs`` is a document. No documents give no rows.
    """
    return filter_steps(mask_cells(document_masks(docs), labels))
