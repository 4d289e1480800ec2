"""Phrases against brute force, and the graph's paths against its edges."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.llm import collocations as C


def counts(rows, longest):
    out, words = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            w = re.findall("[^ \t]+", piece)
            words[lang] += len(w)
            for size in range(1, longest + 1):
                out.update((lang, tuple(w[i:i + size])) for i in range(len(w) - size + 1))
    return out, words


def brute(rows, longest=3, least=10, top=2000, share=50):
    f, words = counts(rows, longest)
    candidates = {k: n for k, n in f.items() if n >= least and len(k[1]) > 1}
    out = {}
    for (lang, p), a in candidates.items():
        longer = (n for (other, q), n in candidates.items() if other == lang and len(q) > len(p)
                  and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)))
        if any(100 * n >= share * a for n in longer):
            continue
        cuts = [(10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, rank, p.decode(), -a, l, r, words[lang], -s) for lang, x in out.items()
                  for rank, (s, a, p, l, r) in enumerate(sorted(x)[:top], 1))


def found(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def texts(seed):
    rng = random.Random(seed)
    vocabulary = ["New", "york", "city", "the", "of", "é", "É", "a b", "ab"]
    fixed = ["To be or not to be that is the question", "ha ho ha ho ha ho", "one two three four five six", "Ähre über Öl"]
    rows = []
    for k in range(150):
        parts = [rng.choice(fixed) if rng.random() < .4 else " ".join(rng.choices(vocabulary, k=rng.randrange(1, 7))) for _ in range(6)]
        rows.append((k, rng.choice([". ", ",", "\n", "\r", "\t", ";;  "]).join(parts), rng.choice(["en", "de", None]), "a"))
    return rows + [rows[0], (None, rows[1][1], "en", None), (500, None, "en", None), (501, "", "en", None), (502, "lone", "fr", None)]


@pytest.mark.parametrize("longest,least,top,bucket,held", [(3, 10, 2000, 10**7, 10**6), (3, 2, 25, 300, 50), (4, 5, 2000, 500, 10**6), (2, 3, 2000, 900, 20)])
def test_brute_force(make, monkeypatch, longest, least, top, bucket, held):
    monkeypatch.setattr(C, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(C, "HELD", held)
    rows = texts(longest + least)
    want = brute([(t, lang) for _, t, lang, _ in rows], longest, least, top)
    assert want and found(C.collocations(make(rows), longest, least, top)) == want


def test_shorter_counts_come_from_the_flow(make):
    rows = texts(9)
    f, words = counts([(t, lang) for _, t, lang, _ in rows], 3)
    got = C.gram_counts(make(rows), 3, 4).collect()
    assert {(r.lang, tuple(r.phrase.split(" "))): r.n for r in got if r.phrase} == {k: n for k, n in f.items() if n >= 4}
    total = Counter()
    for r in got:
        if r.phrase is None:
            total[r.lang] += r.n
    assert total == words


def test_paths_hold_every_edge_once(spark, monkeypatch):
    monkeypatch.setattr(C, "PATH_EDGES", 4)
    chain = [" ".join(f"w{k + j}" for j in range(3)) for k in range(13)]
    edges = [*chain, "a b a", "b a b", "w3 w4 branch", "z z z", "lone two three"]
    grams = spark.createDataFrame([("en", e, 10 + k) for k, e in enumerate(edges)], "lang string, phrase string, n long")
    paths = C.compacted(grams).collect()
    got = []
    for p in paths:
        assert len(p.nodes) == len(p.weights) + 1 <= 5
        got += [(a + " " + b.split(" ")[1], n) for a, b, n in zip(p.nodes, p.nodes[1:], p.weights)]
    assert sorted(got) == sorted((e, 10 + k) for k, e in enumerate(edges))
    # the chain breaks at the branch and every four edges; edges of a circle stay single
    assert sorted(len(p.weights) for p in paths) == [1, 1, 1, 1, 1, 2, 3, 4, 4]


def test_large_counts_are_exact(spark, monkeypatch):
    n = 3_037_000_507  # its square passes 64 bits
    rows = [("en", w, p, a) for w, p, a in ((2, "x y", n), (1, "x", n + 3), (1, "y", n + 9), (1, None, 4 * n))]
    monkeypatch.setattr(C, "gram_counts", lambda *_: spark.createDataFrame(rows, "lang string, words int, phrase string, n long"))
    r = C.collocations(spark.range(0).select(F.lit("").alias("text"), F.lit("").alias("lang"))).first()
    assert (r.a, r.l, r.r, r.score) == (n, n + 3, n + 9, 10**6 * n * n // ((n + 3) * (n + 9)))


def test_edges(edges, nothing):
    assert found(C.collocations(edges, least=2)) == brute([(r.text, r.lang) for r in edges.collect()], least=2)
    assert C.collocations(nothing).count() == 0
