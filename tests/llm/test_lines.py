"""Repeated lines and the perfect hash."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from llm_rows import EDGES
from strata.llm import lines
from strata.llm.common import SLICE_BYTES, SLICE_ROWS, slices
from strata.llm.perfect import PerfectHash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute(rows):
    holders = defaultdict(set)
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(i)
    out = []
    for i, t, *_ in rows:
        own = (t or "").split("\n")
        gone = [len(h := holders.get(key(x), ())) >= 3 and max(k for k in h if k is not None) != i for x in own]
        kept = [x for x, g in zip(own, gone, strict=True) if not g]
        out.append((i, len(own), sum(gone), None if t is None else "\n".join(kept)))
    return out


def order(rows):
    return sorted(rows, key=repr)


def check(make, rows):
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in lines.drop_repeated_lines(make(rows)).collect()]
    assert order(got) == order(brute(rows))


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        high, low = rng.integers(-2**63, 2**63, (2, n))
        assert sorted(PerfectHash.over(high, low).index(high, low).tolist()) == list(range(n))


def test_equals_brute_force(make):
    rnd = random.Random(4)
    pool = [f"{w} repeated line number {k:02d} É" for k in range(12) for w in ("Some", "sOME ")] + ["", "short", "x" * 19, "y" * 20]
    rows = [(k, "\n".join(rnd.choice(pool) + rnd.choice(["", " ", "\t"]) for _ in range(rnd.randrange(9))), None, None) for k in range(60)]
    check(make, rows)


def test_copies_of_a_shard(make, monkeypatch):
    """A line of every document is probed in salted copies of small shards."""
    monkeypatch.setattr(lines, "SHARD_LINES", 5)
    monkeypatch.setattr(lines, "COPY_PROBES", 10)
    check(make, [(k, f"the very same line in all of them\nand one of its own, {k:04d}", None, None) for k in range(80)])


def test_edges(make, edges, nothing):
    check(make, EDGES)
    assert lines.drop_repeated_lines(nothing).count() == 0
    got = lines.drop_repeated_lines(edges)
    assert got.columns.count("n_lines") == 1 and "row" in got.columns and got.select(F.min("row")).first()[0] == "x"


def test_a_batch_is_taken_in_slices():
    """Workers hold the objects of few rows at a time, whatever a batch has."""
    texts = [f"a line that is long enough {k % 7}\nshort {k}".encode() for k in range(5000)]
    batch = pa.RecordBatch.from_arrays([pa.array([None, *range(1, 5000)], pa.int64()), pa.array(texts, pa.binary())], ["doc", "text"])
    out = list(lines._hashes(20)(iter([batch, batch.slice(0, 0)])))
    assert len(out) > 4 and max(x.num_rows for x in out) <= SLICE_ROWS
    assert [d for x in out for d in x.column(0).to_pylist()] == [None, *range(1, 5000)]
    parts = list(slices(pa.array([None, b"x" * (2 * SLICE_BYTES), b"", b"y" * SLICE_BYTES, b"z", None], pa.binary())))
    assert [p for start, n in parts for p in range(start, start + n)] == list(range(6)) and len(parts) > 2
    assert list(slices(pa.array([], pa.binary()))) == []
