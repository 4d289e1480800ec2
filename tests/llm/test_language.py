"""PPM language identification."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_rows import CLASH, SF
from strata.llm import language
from strata.llm.queries import QUERIES


def naive(train, text, order=3):
    """Code length of ``text`` by PPM with escape method C, from dictionaries."""
    seen = [defaultdict(Counter) for _ in range(order + 1)]
    for t in train:
        data = language.START + t
        for i in range(order, len(data)):
            for k in range(order + 1):
                seen[k][data[i - k:i]][data[i]] += 1
    data, bits = language.START + text, 0.0
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            c = seen[k].get(data[i - k:i])
            if not c:
                continue
            n, d = sum(c.values()), len(c)
            if data[i] in c:
                bits += math.log2((n + d) / c[data[i]])
                break
            bits += math.log2((n + d) / d)
        else:
            bits += 8
    return bits


def windows(texts):
    counts = Counter()
    for t in texts:
        data = language.START + t
        for i in range(len(data) - 3):
            counts[int.from_bytes(data[i:i + 4], "big")] += 1
    return counts


def test_code_lengths_equal_naive_ppm():
    rnd = random.Random(3)
    train = {"a": [bytes(rnd.choices(b"abcde .", k=200)) for _ in range(5)],
             "b": [bytes(rnd.choices(b"xyzab \xc3\xa9", k=150)) for _ in range(5)]}
    rows = [(k, code, n) for k, lang in enumerate(train) for code, n in windows(train[lang]).items()]
    model = language.build(list(train), *[np.array(x) for x in zip(*rows, strict=True)])
    texts = [b"", b"a", *[bytes(rnd.choices(b"abcxyz .\xc3\xa9Q\n", k=n)) for n in (3, 50, 400)]]
    got = language.code_lengths(model, texts)
    want = [[naive(train[lang], t) for lang in train] for t in texts]
    assert np.allclose(got, want, rtol=1e-5)


def test_slices_do_not_matter(monkeypatch):
    rows = [(0, code, n) for code, n in windows([b"some text to learn from " * 20]).items()]
    model = language.build(["x"], *[np.array(x) for x in zip(*rows, strict=True)])
    texts = [b"text", b"", b"learn some more text " * 30, b"z"]
    whole = language.code_lengths(model, texts)
    monkeypatch.setattr(language, "_SLICE", 7)
    assert np.allclose(language.code_lengths(model, texts), whole)


def test_held_out_accuracy(spark):
    got = QUERIES["op1_language_id"](spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held) > 0
    assert all(0 <= r.score <= 1 for r in got)


def test_edges(edges):
    model = language.learned(edges)
    got = language.identify(edges, model)
    assert got.columns[-3:] == ["lang_pred", "score", "bits_per_byte"]
    assert set(CLASH) - {"lang_pred", "score"} <= set(got.columns)
    rows = got.select("text", "lang_pred", "score", "bits_per_byte").collect()
    assert len(rows) == 11
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred != "und") == letters
        if not letters:
            assert r.score == 0 and r.bits_per_byte is None
    assert language.accepted(edges).count() == sum(r.lang_pred != "und" and r.bits_per_byte < 8 for r in rows)


def test_empty_table_and_no_labels(nothing, edges):
    assert language.identify(nothing, language.learned(nothing)).count() == 0
    blank = edges.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(blank, language.learned(blank)).collect()} == {"und"}


@pytest.mark.parametrize("share", [64, 4096])
def test_sample_is_bounded(make, share):
    docs = make([(i, f"some text number {i} " * 3, "ab"[i % 2], None) for i in range(60)])
    model = language.fit(docs, F.col("doc_id"), sample_bytes=2 * share, sample_rows=5)
    assert len(model.cost3) <= 2 * share
