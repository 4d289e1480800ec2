"""Consistent weighted sampling, weighted similarity, components and groups."""

import random
from collections import Counter

import numpy as np
import pytest

from strata.llm import neardup
from strata.llm.components import components


def plain(text):
    words = text.encode().split()
    return Counter(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()


def test_runs_are_five_words():
    rnd = random.Random(1)
    for text in ["", " ", "a", "a b c d", "a b c d e", "x " * 50, *[" ".join(rnd.choices("abc", k=40)) for _ in range(20)],
                 "long " * 40_000 + "end", "w" * 200_000 + " tail of words here now"]:
        found, count = neardup.runs(text.encode())
        assert sorted(count.tolist()) == sorted(plain(text).values())
        assert (np.diff(found.astype(object)) > 0).all()


def test_chunks_do_not_matter(monkeypatch):
    text = " ".join(random.Random(2).choices(["one", "two", "three", "fourteen"], k=3000)).encode()
    whole = neardup.word_hashes(text)
    monkeypatch.setattr(neardup, "_CHUNK", 64)
    assert (neardup.word_hashes(text) == whole).all()


def test_draws_agree_as_often_as_weights_overlap():
    rng = np.random.default_rng(7)
    for share in (0.3, 0.6, 0.85):
        hits = total = expected = 0
        for _ in range(60):
            run = np.sort(rng.integers(1, 2**63, 80).astype(np.uint64))
            a, b = rng.uniform(0.5, 3, 80), rng.uniform(0.5, 3, 80)
            b = np.where(rng.random(80) < share, a, b)
            hits += (neardup.draws(run, a) == neardup.draws(run, b)).sum()
            total += neardup.HASHES
            expected += neardup.HASHES * np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert hits / total == pytest.approx(expected / total, abs=0.03)


def union(pairs, nodes):
    top = {n: n for n in nodes}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rnd = random.Random(3)
    pairs = [(k, k + 1) for k in range(100, 140)] + [(7, 7)] + [(rnd.randrange(60), rnd.randrange(60)) for _ in range(40)]
    pairs += [(500, k) for k in range(501, 560)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    nodes = {n for p in pairs if p[0] != p[1] for n in p}
    assert got == union([p for p in pairs if p[0] != p[1]], nodes)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def changed(text, rnd, n):
    words = text.split()
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**6)}"
    return " ".join(words)


def test_groups_equal_brute_force(make):
    rnd = random.Random(11)
    vocabulary = [f"w{k}" for k in range(3000)]
    rows, n = [], 0
    for group in range(12):
        base = " ".join(rnd.choices(vocabulary, k=200))
        for _ in range(rnd.randrange(1, 8) + 25 * (group == 0)):
            rows.append((n, base if rnd.random() < 0.4 else changed(base, rnd, rnd.choice([1, 1, 2, 20])), None, None))
            n += 1
    rows += [(900, "", None, None), (901, "", None, None), (902, None, None, None), (903, "two words", None, None), (904, "two words", None, None)]
    docs = make(rows)
    weights = neardup.idf(docs)
    texts = {i: (t or "").encode() for i, t, *_ in rows}
    ids = sorted(texts)
    sims = {(a, b): neardup.similarity(texts[a], texts[b], weights) for a in ids for b in ids if a < b}
    got = {r.doc_id: r for r in neardup.groups(docs).collect()}
    assert {i: r.component_id for i, r in got.items()} == union([p for p, s in sims.items() if s >= neardup.LEAST], ids)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())
    classes = {frozenset(plain(t.decode()).items()): min(i for i in ids if plain(texts[i].decode()) == plain(t.decode())) for t in texts.values() if t}
    assert all(r.class_id == (classes[frozenset(plain(texts[i].decode()).items())] if texts[i] else i) for i, r in got.items())
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, r in got.items() if r.kept}


def test_edges(edges, nothing):
    got = neardup.groups(edges).collect()
    assert sorted(r.doc_id for r in got) == [1, 2, 3, 4, 5, 6, 7, 8]
    assert {r.doc_id for r in got if r.kept} >= {1, 2, 3, 4, 5, 7, 8}
    assert neardup.groups(nothing).count() == 0
    assert neardup.one_of_each(edges).where("doc_id IS NULL").count() == 2
    assert neardup.one_of_each(nothing).count() == 0


def test_block_similarities_equal_single_ones():
    rnd = random.Random(4)
    weights = np.random.default_rng(1).uniform(1, 1.25, neardup.SLOTS).astype(np.float32)
    base = rnd.choices([f"w{k}" for k in range(500)], k=300)
    texts = ["", "a b", "x " * 60, "x " * 80]
    for _ in range(150):
        words = [w if rnd.random() < 0.97 else f"n{rnd.randrange(10**6)}" for w in base]
        texts.append(" ".join(words[:rnd.randrange(1, 300)] if rnd.random() < 0.2 else words))
    data = [t.encode() for t in texts]
    got = neardup.similarities(data[:90], data, weights)
    want = [[neardup.similarity(a, b, weights) for b in data] for a in data[:90]]
    assert np.allclose(got, want, atol=1e-6)


def test_a_loose_group_of_which_no_member_is_near_all(make, monkeypatch):
    """Members differ from each other about as much as the threshold allows;
    what the anchors don't reach is compared in blocks."""
    monkeypatch.setattr(neardup, "QUERIES", (7, 1 << 20))
    monkeypatch.setattr(neardup, "TARGETS", (11, 1 << 20))
    rnd = random.Random(6)
    base = " ".join(rnd.choices([f"w{k}" for k in range(3000)], k=300))
    rows = [(k, changed(base, rnd, 3 + k % 6), None, None) for k in range(60)]
    docs = make(rows)
    weights = neardup.idf(docs)
    texts = {i: t.encode() for i, t, *_ in rows}
    ids = sorted(texts)
    near = [(a, b) for a in ids for b in ids if a < b and neardup.similarity(texts[a], texts[b], weights) >= neardup.LEAST]
    got = {r.doc_id: r.component_id for r in neardup.groups(docs).collect()}
    assert got == union(near, ids)


def test_rows_that_share_an_id_are_one_text_in_any_order(make):
    rnd = random.Random(8)
    base, other = (" ".join(rnd.choices([f"w{k}" for k in range(900)], k=120)) for _ in range(2))
    near = [changed(base, rnd, 1) for _ in range(2)], [changed(other, rnd, 1) for _ in range(2)]
    rows = [(1, base, None, None), (1, other, None, None), (2, near[0][0], None, None), (3, near[0][1], None, None),
            (4, near[1][0], None, None), (5, near[1][1], None, None)]
    found = [{r.doc_id: r.component_id for r in neardup.groups(make(own)).collect()}
             for own in (rows, rows[::-1], [rows[1], rows[0], *rows[2:], rows[0]])]
    assert found[0] == found[1] == found[2]
    # id 1 goes with the group of the one text it has
    assert found[0] in ({1: 1, 2: 1, 3: 1, 4: 4, 5: 4}, {1: 1, 4: 1, 5: 1, 2: 2, 3: 2})
