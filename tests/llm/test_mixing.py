"""Targets, the draw and the splitting tree."""

import random
from collections import Counter, defaultdict

import pytest

from strata.llm import mixing


def fill(sizes):
    """Targets by sharing the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    budget, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = budget - sum(2 * sizes[s] for s in capped)
        goal = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if goal[s] > 2 * sizes[s]}
        if not over:
            return {**goal, **{s: 2 * sizes[s] for s in capped}}
        capped |= over


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(9)
    names = ["b", "a", "é", "z", None, "hot", "none"]
    rows = []
    for k in range(500):
        s = "hot" if rnd.random() < 0.35 else rnd.choice(names)
        n = 0 if s == "none" else int(rnd.lognormvariate(3, 1)) + (3000 if k == 77 else 0)
        rows.append((k, " ".join(["w"] * n) if n or k % 2 else None, "en", s))
    return rows


def test_targets_and_draw(make, corpus):
    sizes = Counter()
    for _, t, _, s in corpus:
        sizes[s] += len((t or "").split())
    want = fill(sizes)
    taken = Counter()
    first = mixing.allocate(make(corpus)).select("row.doc_id", "row.source", "size", "target", "source_size", "copies", "shards").collect()
    for r in first:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.copies <= 2 and len(r.shards) == r.copies and None not in r.shards
        taken[r.source] += r.copies * r.size
    for s, goal in want.items():
        assert abs(taken[s] - goal) <= max(0.02 * goal, 64)
    again = mixing.allocate(make(corpus[::-1]).repartition(3)).select("row.doc_id", "copies", "shards").collect()
    assert {r.doc_id: (r.copies, r.shards) for r in again} == {r.doc_id: (r.copies, r.shards) for r in first}


def test_mix_keeps_columns_and_whole_shards(make, corpus):
    docs = make(corpus)
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "shard"]
    per = Counter(r.doc_id for r in mixed.select("doc_id").collect())
    want = {r.doc_id: r.copies for r in mixing.allocate(docs).select("row.doc_id", "copies").collect() if r.copies}
    assert per == want


def test_tree_splits_quotas_exactly(spark):
    rows = [("a", k) for k in range(1, 41)] + [(None, k) for k in range(1, 9)] + [("c", 1)]
    got = mixing.quotas(spark.createDataFrame(rows, "source string, slot int"), 8).collect()
    assert Counter(r.source for r in got) == Counter(s for s, _ in rows)
    sizes = Counter(r.shard for r in got)
    assert set(sizes) <= set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 3
    by = defaultdict(Counter)
    for r in got:
        by[r.shard][r.source] += 1
    assert sum(c["a"] for c in by.values()) == 40


def test_edges(edges, nothing):
    got = mixing.allocate(edges).select("row.doc_id", "size", "copies").collect()
    assert len(got) == 11 and all(0 <= r.copies <= 2 for r in got)
    assert mixing.allocate(nothing).count() == 0 and mixing.mix(nothing).count() == 0
