"""Repeated byte strings against brute force; the transform against sorting."""

import random
from pathlib import Path

import numpy as np
import pytest

from strata.llm import suffixes as S
from strata.session import shared_root


def brute(rows, least=50):
    """(kept, removed bytes, runs) of each row."""
    first = {}
    for doc, text in rows:
        b = (text or "").encode()
        if doc is not None:
            for i in range(len(b) - least + 1):
                s = b[i:i + least]
                first[s] = min(first.get(s, doc), doc)
    out = []
    for doc, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        if doc is not None:
            for i in range(len(b) - least + 1):
                if first[b[i:i + least]] < doc:
                    gone[i:i + least] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((doc, bytes(x for x, g in zip(b, gone) if not g), int(gone.sum()), runs))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, bytes(r.kept), r.n_removed, len(r.removed)) for r in df.collect()), key=str)


def texts(seed, docs=60):
    rng = random.Random(seed)
    words = ["an", "the", "of", "é", "stone", "river", "boat", "ñandú", "x" * 9, "qu"]

    def prose(n):
        return " ".join(rng.choice(words) + (str(rng.randrange(50)) if rng.random() < .5 else "") for _ in range(n))

    shared = [prose(rng.randrange(4, 40)) for _ in range(6)]
    rows = []
    for doc in range(docs):
        parts = [prose(rng.randrange(0, 30))]
        for _ in range(rng.randrange(0, 4)):
            s = rng.choice(shared)
            parts += [s[rng.randrange(0, 10):len(s) - rng.randrange(0, 10)], prose(rng.randrange(0, 5))]
        rows.append((doc, " ".join(parts), "en", "a"))
    return rows + [(3, rows[5][1], "en", "a"), (7, rows[7][1], "en", "a"), (None, rows[2][1], "en", "a"), (90, "ab" * 300, "en", "b"),
                   (91, "ab" * 200, "en", "b"), (92, "a" * 500, None, None), (93, "a" * 50, "en", "b"), (94, "a" * 49, "en", "b"),
                   (95, None, "en", "b"), (96, "", "en", "b")]


@pytest.mark.parametrize("seed,chunk,frequent", [(1, 2_000_000, 64), (2, 700, 64), (3, 2_000_000, 2), (4, 300, 1)])
def test_brute_force(make, monkeypatch, seed, chunk, frequent):
    """Also with texts in parts, and with anchors counted as frequent."""
    monkeypatch.setattr(S, "CHUNK", chunk)
    monkeypatch.setattr(S, "FREQUENT", frequent)
    monkeypatch.setattr(S, "SHARD_BYTES", 5000)
    monkeypatch.setattr(S, "BUCKET_BYTES", 5000)
    rows = texts(seed)
    assert found(S.drop_repeated_strings(make(rows))) == brute([r[:2] for r in rows])


@pytest.mark.parametrize("least", [12, 30, 70])
def test_other_lengths(make, least):
    rows = texts(least)
    assert found(S.drop_repeated_strings(make(rows), least)) == brute([r[:2] for r in rows], least)


def test_edges(edges, nothing):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    out = S.drop_repeated_strings(edges)
    assert found(out) == brute(rows)
    assert out.columns[-4:] == ["kept", "n_bytes", "n_removed", "removed"]
    assert len(set(out.columns)) == len(out.columns)
    assert S.drop_repeated_strings(nothing).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_collection(seed):
    """Transform, common prefixes and places against sorted suffixes."""
    rng = random.Random(seed)
    strings = [bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randrange(1, 12))) for _ in range(30)]
    made = S.Collection(strings)
    place = {}
    for length, which, at in made.places():
        place.update({int(p): (int(s), length) for s, p in zip(which, at)})
    suffix = [strings[place[p][0]][-place[p][1]:] if p in place else b"" for p in range(len(made.bwt))]
    assert len(place) == sum(map(len, strings)) and suffix == sorted(suffix)

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    assert made.lcp.tolist() == [0] + [common(a, b) for a, b in zip(suffix, suffix[1:])]


def test_equal_strings_have_equal_anchors():
    rng = np.random.default_rng(0)
    shared = rng.integers(97, 105, 200, np.uint8).tobytes()
    keys = []
    for k in range(20):
        text = rng.integers(97, 105, 100 + k, np.uint8).tobytes() + shared + rng.integers(97, 105, 50, np.uint8).tobytes()
        start, many, key, _ = S.anchors(text, np.array([len(text)]), 50, np.zeros(0, np.uint64))
        assert many.sum() == len(text) - 49 and many.max() <= 27
        own = {s: key_ for s0, m, key_ in zip(start, many, key) for s in range(s0, s0 + m)}
        keys.append([own[100 + k + i] for i in range(151)])
    assert all(k == keys[0] for k in keys)


def test_what_pieces_need_not_meet_is_not_kept(spark):
    """Anchors and pieces go once the verdict is written."""
    text = "".join(chr(97 + (k * k * 7 + k) % 26) for k in range(400))
    docs = spark.createDataFrame([(1, text), (2, "0123456789" + text[100:300]), (3, None)], "doc_id long, text string")
    root = Path(shared_root(spark).removeprefix("file:")) / "strata"
    before = set(root.glob("*")) if root.exists() else set()
    got = {r["doc_id"]: r["n_removed"] for r in S.drop_repeated_strings(docs).collect()}
    assert got == {1: 0, 2: 200, 3: 0}
    assert {p.name.split("-")[0] for p in set(root.glob("*")) - before} == {"gone"}


def test_rows_of_the_plan_do_not_multiply(make, monkeypatch):
    """Frequent pieces aren't copied, and what a step says of a document is one row."""
    monkeypatch.setattr(S, "FREQUENT", 2)
    monkeypatch.setattr(S, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(S, "SHARD_BYTES", 2000)
    made = {}
    keep = S.materialise
    monkeypatch.setattr(S, "materialise", lambda df, name, over=(): made.setdefault(name, keep(df, name)))
    rng = random.Random(9)
    line = "".join(rng.choice("abcdefgh ") for _ in range(90))
    rows = [(doc, "".join(rng.choice("ijklmnop ") for _ in range(60)) + line, "en", "a") for doc in range(80)]
    rows += [(doc + 100, rows[doc][1][:60] * 2, "en", "a") for doc in range(20)]
    assert found(S.drop_repeated_strings(make(rows))) == brute([r[:2] for r in rows])
    assert made["anchors"].count() <= len(rows) and made["gone"].count() <= len(rows)
    hot = made["pieces"].filter("content IS NOT NULL")
    assert 0 < made["verdicts"].filter("content IS NOT NULL").count() == hot.select("shard", "content").distinct().count()


@pytest.mark.parametrize("least,wide", [(50, 10), (50, 1), (12, 10), (7, 10), (22, 8)])
def test_smallest_of_equal_strings(monkeypatch, least, wide):
    """With symbols of several bytes, whatever place a string begins at."""
    monkeypatch.setattr(S, "WIDE", wide)
    rng = random.Random(least)
    shared = bytes(rng.choice(b"ab") for _ in range(3 * least))
    strings = list({bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randrange(9))) + shared[k:k + least + rng.randrange(20)]
                    for k in range(2 * least) for _ in range(3)})
    first = np.array([rng.randrange(100) for _ in strings])
    low, begin = S.smallest(strings, first, least)
    want = {}
    for s, f in zip(strings, first.tolist(), strict=True):
        for k in range(len(s) - least + 1):
            want[s[k:k + least]] = min(want.get(s[k:k + least], f), f)
    assert low.tolist() == [want[s[k:k + least]] for s in strings for k in range(len(s) - least + 1)]
    assert begin.tolist() == np.cumsum([0, *(len(s) - least + 1 for s in strings[:-1])]).tolist()
