"""Base counts, the sketch and adaptive limits."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from strata.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    runs = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    often, covered = Counter(runs), set()
    for k, run in enumerate(runs):
        if often[run] > 1:
            covered |= {k, k + 1, k + 2}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_counts_equal_brute_force(make):
    rnd = random.Random(5)
    texts = [None, "", " ", "a", "a b", "a a a", "a a a a", "a b c a b c", "x\x1cy z é#", "l\nl\n \n \nl ", "#*$%&|<>@"]
    texts += ["".join(rnd.choice(["a", "b", "c", " ", " ", "\n", "é", "|", "\x0b"]) for _ in range(rnd.randrange(80))) for _ in range(60)]
    texts.append("la la land " * 5000)
    docs = make([(k, t, None, None) for k, t in enumerate(texts)])
    for r in quality.judge(docs).collect():
        want = counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)


def test_bins_are_close_and_ordered(spark):
    rows = spark.range(0, 200_000, 37).select("id", quality.bin_of(F.col("id")).alias("bin")).orderBy("id").collect()
    assert all(r.bin <= r.id <= r.bin * (1 + 1 / 128) + 1e-9 for r in rows)
    assert all(a.bin <= b.bin for a, b in zip(rows, rows[1:], strict=False))


def test_limits_follow_the_group(make):
    """Symbols that are usual in one source are odd in another."""
    rnd = random.Random(1)

    def text(symbols):
        return " ".join("".join(rnd.choices("abcdefgh", k=rnd.randrange(3, 8))) + "#" * (rnd.random() < symbols) for _ in range(80))

    rows = [(k, text(0.0), "en", "plain") for k in range(150)] + [(k + 200, text(0.6), "en", "code") for k in range(150)]
    rows += [(900, text(0.6), "en", "plain"), (901, text(0.6), "en", "code"), (902, text(0.0), "en", "few")]
    kept = {r.doc_id: r.kept for r in quality.judge(make(rows)).collect()}
    assert not kept.pop(900)
    assert sum(kept.values()) == len(kept)


def test_sketches_merge(make):
    """The bins of a whole are the sums of its parts' bins."""
    rnd = random.Random(2)
    rows = [(k, " ".join(rnd.choices(["aa", "bbb", "c#"], k=70)), "en", "s") for k in range(40)]
    features = quality.features(make(rows))
    whole = {(r.ratio, r.bin): r.n for r in quality.sketches(features).collect()}
    parts = Counter()
    for half in (features.where("doc_id < 20"), features.where("doc_id >= 20")):
        for r in quality.sketches(half).collect():
            parts[r.ratio, r.bin] += r.n
    assert whole == dict(parts)


def test_edges(edges, nothing):
    assert quality.judge(edges).count() == 11
    assert quality.judge(nothing).count() == 0
