"""Repeated runs of sentences against brute force."""

import random

import pytest
from llm_rows import EDGES
from strata.llm import spans
from strata.llm.queries import op5_substring_dedup


def brute(rows):
    first, own = {}, []
    for n, (i, t, *_) in enumerate(rows):
        found = spans.sentences((t or "").encode())
        own.append((spans.NO_ID if i is None else i, n, found))
    for i, _, found in sorted(own, key=lambda x: x[:2]):
        for k in range(len(found) - 1):
            run = (tuple(found[k][2]), tuple(found[k + 1][2]))
            if sum(map(len, run)) >= spans.LEAST_WORDS:
                first[run] = min(first.get(run, (i, k)), (i, k))
    out = []
    for (i, n, found), (_, t, *_) in zip(own, rows, strict=True):
        gone = set()
        for k in range(len(found) - 1):
            run = (tuple(found[k][2]), tuple(found[k + 1][2]))
            if first.get(run, (i, k)) != (i, k):
                gone |= {k, k + 1}
        data = (t or "").encode()
        for k in sorted(gone, reverse=True):
            data = data[:found[k][0]] + data[found[k][1]:]
        out.append((None if i == spans.NO_ID else i, len(found), len(gone), None if t is None else data.decode()))
    return sorted(out, key=repr)


def check(make, rows):
    got = spans.drop_repeated_spans(make(rows)).select("doc_id", "n_sentences", "n_removed", "text").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def sentence(rnd, n=None):
    return " ".join("".join(rnd.choices("abcdeé", k=5)) for _ in range(n or rnd.randrange(3, 12))) + rnd.choice(".!?")


def test_equals_brute_force(make):
    rnd = random.Random(2)
    pool = [" ".join(sentence(rnd) for _ in range(rnd.randrange(1, 6))) for _ in range(8)]
    rows = []
    for k in range(50):
        parts = [rnd.choice(pool) if rnd.random() < 0.5 else sentence(rnd) for _ in range(rnd.randrange(0, 8))]
        rows.append((k, rnd.choice([" ", "\n", "  "]).join(parts), None, None))
    check(make, rows)


def test_passages_go_except_the_first(make):
    rnd = random.Random(3)
    passage = " ".join(sentence(rnd, 10) for _ in range(6))
    flat = " ".join("".join(rnd.choices("abcdefgh", k=5)) for _ in range(120))  # no sentence ends
    rows = [(k, f"{sentence(rnd)} {passage} {sentence(rnd)}", None, None) for k in range(5)]
    rows += [(k + 10, f"{sentence(rnd, 30)} {flat} {sentence(rnd, 30)}", None, None) for k in range(3)]
    rows += [(99, " ".join(sentence(rnd) for _ in range(20)), None, None)]
    got = {r.doc_id: r.n_removed for r in spans.drop_repeated_spans(make(rows)).collect()}
    assert got[0] == got[10] == got[99] == 0
    assert all(got[k] == 6 for k in range(1, 5)) and all(got[k] >= 4 for k in (11, 12))
    check(make, rows)


def test_passages_of_short_sentences_go(make, spark, workdir):
    rnd = random.Random(5)

    def lines(n, words):
        return "\n".join(" ".join("".join(rnd.choices("abcdeé", k=6)) for _ in range(words)) for _ in range(n))

    passages = [lines(15, 4), lines(60, 1), f"{lines(1, 12)}\n{lines(2, 2)}"]  # verse, a table, a long line and short ones
    docs = make([(10 * p + k, f"{lines(3, 4)}\n{passage}\n{lines(3, 4)}", None, None) for p, passage in enumerate(passages) for k in range(3)])
    docs.write.parquet(f"{workdir}/documents.parquet")
    got = {r.doc_id: (r.n_sentences, r.n_removed) for r in op5_substring_dedup(spark, workdir).collect()}
    assert got == {10 * p + k: (n + 6, n * (k > 0)) for p, n in enumerate((15, 60, 3)) for k in range(3)}


def test_passages_inside_other_running_text_share_a_run():
    rnd = random.Random(6)
    for trial in range(2000):
        pool = ["".join(rnd.choices("abcdefgh", k=5)) for _ in range(rnd.choice([5, 20, 500]))]
        passage = rnd.choices(pool, k=51)
        if trial % 4 == 0:
            passage[rnd.randrange(50)] += "."
        texts = [" ".join([*rnd.choices(pool, k=rnd.randrange(40)), *passage, *rnd.choices(pool, k=rnd.randrange(40))]).encode() for _ in range(2)]
        one, two = (set(spans._runs(spans.sentences(t), 2, spans.LEAST_WORDS, True).values()) for t in texts)
        assert one & two, trial


def test_sentences_cover_the_words():
    rnd = random.Random(4)
    for _ in range(200):
        text = "".join(rnd.choice(["ab ", "c. ", "d", "\n", "! ", "é ", " ", "x" * 9 + " "]) for _ in range(rnd.randrange(120))).encode()
        found = spans.sentences(text)
        assert [w for _, _, own in found for w in own] == text.split()
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:], strict=False))


def test_edges(make, nothing):
    check(make, [r for r in EDGES if r[0] is not None])
    assert spans.drop_repeated_spans(make(EDGES)).count() == len(EDGES)
    assert spans.drop_repeated_spans(nothing).count() == 0


def grown(words, run, least):
    """(first, end) of the runs over sentences of so many words each, tried one by one."""
    out = set()
    for k in range(len(words)):
        for step in (1, -1):
            i = j = k
            while 0 <= i and j < len(words):
                if j - i + 1 >= run and sum(words[i:j + 1]) >= least:
                    out.add((i, j + 1))
                    break
                i, j = (i, j + 1) if step == 1 else (i - 1, j)
    return out


def brute_grown(rows):
    """Runs that grow: all places of each run of equal words, the first stays."""
    places, own = {}, []
    for i, t, *_ in rows:
        found = spans.sentences((t or "").encode())
        runs = {(a, b): tuple(map(tuple, (x[2] for x in found[a:b]))) for a, b in grown([len(x[2]) for x in found], spans.RUN, spans.LEAST_WORDS)}
        own.append((spans.NO_ID if i is None else i, found, runs))
        for (a, _), words in runs.items():
            places.setdefault(words, set()).add((own[-1][0], a))
    out = []
    for (i, found, runs), (_, t, *_) in zip(own, rows, strict=True):
        gone = {k for (a, b), words in runs.items() if min(places[words]) != (i, a) for k in range(a, b)}
        data = (t or "").encode()
        for k in sorted(gone, reverse=True):
            data = data[:found[k][0]] + data[found[k][1]:]
        out.append((None if i == spans.NO_ID else i, len(found), len(gone), None if t is None else data.decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed,held,bucket", [(1, 10**6, 10**7), (2, 30, 10**7), (3, 200, 2000), (4, 10**6, 500)])
def test_growing_runs_equal_brute_force(make, monkeypatch, seed, held, bucket):
    """As the registered query has them; also with hashes sent early and in many buckets."""
    monkeypatch.setattr(spans, "HELD", held)
    monkeypatch.setattr(spans, "BUCKET_BYTES", bucket)
    rnd = random.Random(seed)
    pool = [" ".join(sentence(rnd, rnd.randrange(1, 7)) for _ in range(rnd.randrange(2, 9))) for _ in range(8)]
    pool.append(" ".join("".join(rnd.choices("abcdefgh", k=4)) for _ in range(60)))
    rows = []
    for k in range(60):
        parts = [rnd.choice(pool) if rnd.random() < 0.5 else sentence(rnd) for _ in range(rnd.randrange(0, 8))]
        rows.append((rnd.choice([k, k, k, 5, None]), rnd.choice([" ", "\n", "  "]).join(parts), None, None))
    rows += [rows[3], rows[4], (7, None, None, None), (8, "", None, None)]
    got = spans.drop_repeated_spans(make(rows), grow=True).select("doc_id", "n_sentences", "n_removed", "text").collect()
    assert sorted(map(tuple, got), key=repr) == brute_grown(rows)
