"""Base patterns and disclosing terms."""

import math
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_rows import EDGES
from strata.llm import pii

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
            r"\+[0-9][\x20().0-9-]+[0-9]"]


def luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == 1 and any(int(p) > 255 for p in m.group().split("."))
                    or kind == 2 and not (14 <= len(digits) <= 19 and luhn(digits))
                    or kind == 3 and not 10 <= len(digits) <= 15):
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


KNOWN = ["a@b.c@d.e", "a@b.c_x@d.e", "@b.c", "x@y", "a@b..c", "1.2.3.4.5.6.7.8", "256.1.1.1", "01.002.3.255", "4111 1111 1111 1111",
         "4111-1111-1111-1111-", "+1 (212) 555-0123", "+1(((((", "+12", "+1+1 212 555 0123 9", "a.b%c+d@x-y.co.uk.", "é@b.c", "٣.1.1.1",
         "0000.1.1.1", "1..2.3.4.5"]


@pytest.mark.parametrize("text", KNOWN)
def test_known(text):
    assert pii.base_spans(text) == brute(text)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="ab1204@.+- ()_%é\n", max_size=40))
def test_base_spans_equal_plain_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_long_runs_are_linear():
    assert pii.base_spans("1" * 200_000 + " " + "a" * 200_000 + "@") == []
    assert len(pii.base_spans("a@b.cd " * 20_000)) == 20_000


def test_terms_that_reveal_an_entity(make):
    rnd = random.Random(1)

    def noise(n):
        return " ".join("".join(rnd.choices("abcdefghij", k=6)) for _ in range(n))

    rows = [(k, f"{noise(20)} contact Zebulon at zeb.kowalski@mail.example.com the {noise(20)}", None, None) for k in range(6)]
    rows += [(k, f"{noise(20)} contact the person at p{k}@mail.example.com the {noise(20)}", None, None) for k in range(10, 40)]
    copy = f"{noise(30)} Rareword wrote x.y@mail.example.com {noise(9)}"
    rows += [(k, copy, None, None) for k in range(50, 60)]  # copies are one window
    rows.append((99, noise(60_000), None, None))
    docs = make(rows)
    found = {r.doc_id: [(docs_text[r.doc_id][s.start:s.end], s.kind) for s in r.spans]
             for docs_text in [{i: t for i, t, *_ in rows}] for r in pii.find(docs).collect()}
    for k, spans in found.items():
        terms = [w for w, kind in spans if kind == 4]
        assert terms == (["Zebulon"] if k < 6 else []), k
        assert sum(kind == 0 for _, kind in spans) == (k != 99)
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert all("@" not in t and "Zebulon" not in t for t in clean.values())
    assert pii.sanitise(docs).columns == docs.columns


def test_terms_are_spans_wherever_they_stand(make, monkeypatch):
    monkeypatch.setattr(pii, "SALT_WORDS", 4, raising=False)  # more than one salt
    rnd = random.Random(9)

    def noise(n):
        return " ".join("".join(rnd.choices("abcdefghij", k=6)) for _ in range(n))

    rows = [(k, f"{noise(20)} contact Zebulon at zeb.kowalski@mail.example.com the {noise(20)}", None, None) for k in range(20, 30)]
    rows += [(k, f"{noise(20)} contact the person at p{k}@mail.example.com the {noise(20)}", None, None) for k in range(60, 90)]
    rows += [(k, f"{noise(20)} (Zebulon) {noise(20)}", None, None) for k in range(10, 13)]  # no address at all
    rows.append((13, f"a@b.cd,Zebulon {noise(9)} zeb.kowalski@mail.example.com", None, None))  # the tenth word from it, beside another address
    rows += [rows[-1], (None, "Zebulon.", None, None), (None, "Zebulon.", None, None), (50, noise(150_000), None, None)]
    docs = make(rows)
    for r in pii.find(docs).collect():
        text = [t for i, t, *_ in rows if i == r.doc_id][0]
        assert [text[s.start:s.end] for s in r.spans if s.kind == 4] == ["Zebulon"] * ("Zebulon" in text)
    assert not any("Zebulon" in r.text for r in pii.sanitise(docs).collect())


def disclosed(make, rows):
    docs = make(rows)
    return {(r.term, r.entity): (r.n, r.share, r.bits) for r in pii.disclosing(docs, pii.scan(docs)).collect()}


def test_co_occurrence_equals_brute_force(make, monkeypatch):
    monkeypatch.setattr(pii, "LEAST_SHARE", 0.0)
    monkeypatch.setattr(pii, "LEAST_BITS", -99.0)
    rnd = random.Random(12)
    kinds = ["ann@x.org", "bob@y.net", "10.0.0.1", "mailto:ann@x.org", "(bob@y.net)", "ann@x.org,10.0.0.1", "--"]
    rows = [(k, " ".join(rnd.choice(kinds) if rnd.random() < 0.15 else rnd.choice(["Red", "red,", "mailto", "blue", "green\n", "(", "tea"])
                         for _ in range(rnd.randrange(0, 40))), None, None) for k in range(120)]
    rows += [rows[5]] * 4 + [(None, rows[6][1], None, None), (700, None, None, None)]
    both, windows, n, around, total = {}, {}, {}, {}, 0
    for _, text, *_ in rows:
        text = text or ""
        spans = pii.base_spans(text)
        blank = list(text)
        for s, _, e in spans:
            blank[s:e] = " " * (e - s)
        total += len("".join(blank).split())
        words = [(m.start(), m.group().strip(pii._EDGES).lower()) for m in re.finditer(r"\S+", "".join(blank))]
        words = [w for w in words if w[1]]
        for _, term in words:
            n[term] = n.get(term, 0) + 1
        seen = set()
        for s, kind, e in spans:
            near = [w for w in words if w[0] < s][-pii.AROUND:] + [w for w in words if w[0] >= e][:pii.AROUND]
            entity = (kind, text[s:e].lower())
            for start, term in near:
                if (start, entity) not in seen:
                    seen.add((start, entity))
                    both[term, entity] = both.get((term, entity), 0) + 1
                    windows.setdefault((term, entity), set()).add(" ".join(w for _, w in near))
                    around[entity] = around.get(entity, 0) + 1
    want = sorted((t, n[t], b / n[t], math.log2(b / n[t] / (around[e] / total))) for (t, e), b in both.items()
                  if len(windows[t, e]) >= pii.LEAST_CONTEXTS)
    got = sorted((t, *x) for (t, _), x in disclosed(make, rows).items())
    assert len(got) == len(want) > 10 and all(share <= 1 for _, _, share, _ in got)
    assert all(g[:2] == w[:2] and g[2:] == pytest.approx(w[2:]) for g, w in zip(got, want, strict=True))


def test_a_fragment_beside_many_entities_reveals_none(make):
    rnd = random.Random(13)

    def noise(n):
        return " ".join("".join(rnd.choices("abcdefghij", k=6)) for _ in range(n))

    rows = [(k, f"{noise(30)} mailto:p{k % 12}@mail.example.com {noise(30)}", None, None) for k in range(48)]
    rows.append((90, f"{noise(40)} mailto {noise(4000)}", None, None))
    assert not any(term == "mailto" for term, _ in disclosed(make, rows))
    assert not any(s.kind == 4 for r in pii.find(make(rows)).collect() for s in r.spans)


def test_slots_are_those_of_spark(spark):
    for term in ("zebulon", "é", "a" * 99):
        assert spark.sql(f"SELECT pmod(xxhash64('{term}'), {pii.SLOTS})").first()[0] == pii.slot_of(term)


def test_edges(make, edges, nothing):
    got = pii.find(edges).collect()
    assert len(got) == len(EDGES) and not any(r.spans for r in got)
    assert pii.sanitise(edges).where("text IS NULL").count() == 2
    assert pii.find(nothing).count() == 0 and pii.sanitise(nothing).count() == 0
    twice = make([(1, "a@b.cd", None, None), (1, "xx 1.2.3.4", None, None), (None, "a@b.cd", None, None), (None, "a@b.cd", None, None)])
    assert sorted(len(r.spans) for r in pii.find(twice).collect()) == [1, 1, 1, 1]
