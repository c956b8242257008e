import random
import re
from itertools import permutations

import numpy as np
import pytest

from llm_cases import edge_texts
from portfolio_ops.llm import audit


def brute_steps(rows, labels):
    """Filters applied one after another to lists of documents."""
    def fails(letter, i, text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        return {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
                "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
                "D": bool(re.search(r"[#$%&*|]", text)),
                "E": i is not None and any(j is not None and j < i and t == text
                                           for j, t, _ in rows)}[letter]
    rows = [(i, t or "", s or "") for i, t, s in rows]
    marks = [{c for c in "ABCDE" if fails(c, i, t)} for i, t, _ in rows]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = {}
    for part in {s for _, _, s in rows}:
        own = [k for k, r in enumerate(rows) if r[2] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, c in enumerate(order, 1):
                gone = [k for k in left if c in marks[k]]
                before, left = left, [k for k in left if c not in marks[k]]
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(c in marks[k] for k in own) - len(gone),
                    sum(marks[k] == {c} for k in own), sum(rows[k][0] in good for k in gone),
                    sum(rows[k][0] in toxic for k in gone)]
        for c in "ABCDE":
            total = sum(v[1] for (p, o, s), v in out.items() if p == part and o[s - 1] == c)
            for (p, o, s), v in out.items():
                if p == part and o[s - 1] == c:
                    v.append(total)
    return out


COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_equals_filters_one_after_another(spark):
    rnd = random.Random(3)
    rows = [(i, t, rnd.choice(["a", "b", None, ""])) for i, t in edge_texts()]
    rows += [(100 + k, rnd.choice(["x " * 60, "A B C", "# one two", "UP " * 70, None]), "hot")
             for k in range(40)]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i, _, _ in rows if rnd.random() < .7]
    labels += [(1, 0, 1), (1, 1, 0), (None, 1, 1)]
    docs = spark.createDataFrame(
        [(*r, "m", 7, "x", "d", "g") for r in rows],
        "doc_id long, text string, source string, mask string, n long, part string, digest string, "
        "good string")
    known = spark.createDataFrame([(*x, "k") for x in labels], "doc_id long, quality int, toxic int, key string")
    got = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COLUMNS]
           for r in audit.filter_audit(docs, known).collect()}
    assert got == brute_steps(rows, labels)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.filter_audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    assert audit.filter_audit(one, labels).count() == 600


@pytest.mark.parametrize("filters", [1, 3, 5])
def test_gray_code_walk_holds_every_subset(filters):
    rng = np.random.default_rng(filters)
    masks = np.arange(1 << filters)
    values = rng.integers(0, 9, (len(masks), 3))
    states = audit.gray_code_states(masks, values, filters)
    for subset in range(1 << filters):
        assert (states[subset] == values[(masks & subset) == 0].sum(axis=0)).all()


def test_texts_are_read_once(spark):
    docs = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = audit.filter_audit(docs, labels)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan and "CartesianProduct" not in plan
