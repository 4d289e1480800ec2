"""The audit against a plain replay of every order."""

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np

from strata.llm import audit as A


def replay(docs, labels):
    """docs: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    rows = []
    for d, t, lang in docs:
        t = t or ""
        w = re.findall("[^ \t\n\x0b\x0c\r]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
                 "D": bool(re.search("[#$%&*|]", t)), "E": d is not None and least[t] < d}
        rows.append((lang or "", {f for f, x in fails.items() if x}, d in good, d in toxic))
    out, value = {}, Counter()
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                value[part, f] += len(gone)
                failing = sum(f in r[1] for r in mine)
                out[part, "".join(order), step] = (len(left), len(gone), failing - len(gone), sum(r[1] == {f} for r in mine),
                                                   sum(r[2] for r in gone), sum(r[3] for r in gone))
    return {k: (*v, value[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(df):
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(out) == len(rows)
    return out


def texts(seed):
    rng = random.Random(seed)
    rows = []
    for k in range(120):
        n = rng.choice([0, 3, 150, 199, 200, 260])
        t = " ".join(rng.choice(["One", "two", "three", str(rng.randrange(400)), str(rng.randrange(400)), "$x" if k % 7 == 0 else "x"]) for _ in range(n))
        rows.append((k, t, rng.choice(["en", "de", None, ""]), "a"))
    rows += [(200 + k, rows[k][1], "en", "b") for k in range(0, 120, 5)]
    return [*rows, rows[3], rows[4], (None, rows[5][1], "en", "a"), (None, "", None, "a"), (400, None, "en", "a")]


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_replay(spark, make):
    rng = random.Random(5)
    marks = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, 210, 2)]
    marks += [(4, 1, 1), (4, 0, 0), (None, 1, 1), (9999, 1, 1)]
    rows = texts(1)
    got = found(A.audit(make(rows), labels(spark, marks)))
    assert got == replay([r[:3] for r in rows], marks)
    assert len(got) == 3 * 600  # en, de, and null with the empty language


def test_edges(spark, edges, nothing):
    none = labels(spark, [])
    assert found(A.audit(edges, none)) == replay([(r.doc_id, r.text, r.lang) for r in edges.collect()], [])
    assert A.audit(nothing, labels(spark, [(1, 1, 1)])).count() == 0


def test_removal_steps_by_hand():
    orders = np.array([[0, 1, 2], [2, 1, 0]])
    assert A.removal_steps(np.array([0, 1, 0b110]), orders).tolist() == [[4, 4], [1, 3], [2, 1]]
