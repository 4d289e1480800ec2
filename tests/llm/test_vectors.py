"""Links and groups of vectors against brute force."""

import numpy as np
import pytest

from strata.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vector string, size string, links string"


def brute(rows):
    ok = [(i, np.array(v, np.float32).astype(np.float64), c) for i, v, c in rows
          if i is not None and c is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = {i: set() for i, _, _ in rows if i is not None}
    for a, x, c in ok:
        for b, y, d in ok:
            if a != b and c == d and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                links[a].add(b)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            todo += [k for k in links[todo.pop()] if k not in seen and not seen.add(k)]
        out[i] = (len(links[i]), min(seen), i == min(seen))
    return out


def check(spark, rows):
    df = spark.createDataFrame([(i, v, c, "x", "x", "x", "x") for i, v, c in rows], SCHEMA)
    got = vectors.near_duplicates(df).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, False)
        else:
            assert (r.n_links, r.component_id, r.kept) == want[r.vec_id]


def cloud(rng, centre, n, noise):
    return [(centre + noise * rng.standard_normal(len(centre))).astype(np.float32).tolist() for _ in range(n)]


def test_groups_of_all_kinds(spark):
    rng = np.random.default_rng(5)
    made = []
    for k in range(25):
        centre = rng.standard_normal(32)
        made += [(v, k % 3) for v in cloud(rng, centre, int(rng.integers(1, 6)), 0.15)]
    big = rng.standard_normal(32)
    made += [(v, 1) for v in cloud(rng, big, 200, 0.08)]  # one large group
    made += [(big.astype(np.float32).tolist(), 1)] * 30  # and copies
    made += [(v, 2) for v in cloud(rng, rng.standard_normal(32), 60, 0.3)]  # near the threshold
    rng.shuffle(order := np.arange(len(made)))
    rows = [(int(p), *made[k]) for p, k in enumerate(order)]
    rows += [(5000, None, 1), (5001, [], 1), (5002, [0.0] * 32, 1), (5003, [float("nan")] * 32, 1), (5004, [1.0, None], 1),
             (5005, big.tolist(), None), (None, big.tolist(), 1), (5006, [float("inf"), 1.0], 1), (5007, [1.0, 2.0], 1), (5008, [2.0, 4.0], 1)]
    check(spark, rows)


@pytest.mark.parametrize("block", [4, 1024])
def test_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(6)
    check(spark, [(k, v, 0) for k, v in enumerate(cloud(rng, rng.standard_normal(16), 30, 0.25))])


def test_repeated_rows_and_empty(spark):
    check(spark, [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.1], 0), (3, [0.0, 1.0], 0)])
    check(spark, [])


def test_passes_grow_with_the_logarithm():
    assert 2 <= vectors.passes(2) < vectors.passes(10_000) < vectors.passes(10**9) < 400


def test_seams_join_partitions(spark):
    """Few rows in many partitions: neighbours lie across borders."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        rng = np.random.default_rng(8)
        rows = [(v, k) for k in range(8) for v in cloud(rng, rng.standard_normal(24), 12, 0.1)]
        check(spark, [(k, *r) for k, r in enumerate(rows)])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def planted(n, pairs, close, lowest, seed):
    """``n`` unit vectors of 64 components that have a cosine near ``close`` with each
    other, and ``pairs`` partners of the first of them at cosines from ``lowest`` on."""
    rng = np.random.default_rng(seed)

    def units(k):
        x = rng.standard_normal((k, 64))
        x[:, 0] = 0
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    x = units(n)
    cosine = lowest + 0.02 * rng.random((pairs, 1))
    inner = 1 - (1 - cosine) / (1 - close)
    y = units(pairs)
    y -= (y * x[:pairs]).sum(axis=1, keepdims=True) * x[:pairs]
    y = inner * x[:pairs] + np.sqrt(1 - inner**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    both = np.sqrt(1 - close) * np.concatenate([x, y])
    both[:, 0] = np.sqrt(close)
    return both.astype(np.float32)


@pytest.mark.parametrize("close, n", [(0.0, 200), (0.0, 5000), (0.6, 3000), (0.85, 3000)])
def test_passes_find_planted_pairs(spark, close, n):
    """By the windows alone: no label is compared whole."""
    both = planted(n, n // 10, close, 0.931, n)
    df = spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(both)], "vec_id long, embedding array<float>, label int")
    each = vectors.classes(df)
    assert vectors.planned(each).where("number = 0").count() == 0
    x = both.astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = np.argwhere(np.triu(x @ x.T >= 0.93, 1))
    grouped = {r.node: r.component for r in vectors.components(vectors.window_links(each)).collect()}
    assert len(near) >= n // 10 and all(a in grouped and grouped[a] == grouped.get(b) for a, b in near.tolist())
    assert len(grouped) == len(set(near.ravel().tolist()))


def test_rounding_leaves_no_pair_out_and_none_in(spark):
    """Cosines around the threshold, closer to it than the rounding errors are."""
    both = planted(400, 400, 0.0, 0.92, 3)
    check(spark, [(k, v.tolist(), k % 400) for k, v in enumerate(both)])


def test_labels_too_close_for_passes_are_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(vectors, "MOST", 3)
    monkeypatch.setattr(vectors, "BLOCK", 64)
    both = planted(300, 30, 0.6, 0.931, 4)
    check(spark, [(k, v.tolist(), 0) for k, v in enumerate(both)])
