"""Token counts that follow edits, against encoding the edited text."""

import random

import public_tokenizers
import pytest

from llm_rows import EDGES, SF
from strata.llm import tokencount
from strata.llm.queries import QUERIES

ALPHABET = ["a", "b", "1", "2", " ", "  ", "\n", "'", "'s", "'l", "l", ".", "!", "é", "\xa0", "\x1c", "漢", "\t", "ve", "\x85", "٣", "½"]


@pytest.fixture(scope="module")
def ranks():
    return tokencount.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def tokenizer(ranks):
    return tokencount.Tokenizer(ranks, public_tokenizers.PATTERN)


def full(tokenizer, text):
    return len(tokenizer.encoding.encode_ordinary(text))


def test_random_edits(tokenizer):
    rnd = random.Random(1)
    for _ in range(8000):
        text = "".join(rnd.choices(ALPHABET, k=rnd.randrange(0, 40)))
        edits, at = [], 0
        while at <= len(text) and rnd.random() < 0.7:
            start = rnd.randrange(at, len(text) + 1)
            end = min(len(text), start + rnd.randrange(0, 4))
            edits.append((start, end, "".join(rnd.choices(ALPHABET, k=rnd.randrange(0, 4)))))
            at = end + rnd.randrange(0, 3)
        own = tokencount.Counted(text, tokenizer)
        assert own.tree.total == full(tokenizer, text)
        new, _ = own.apply(edits)
        assert own.tree.total == full(tokenizer, new), (text, edits)


def test_only_the_neighbourhood_is_encoded(tokenizer):
    text = "some words that stay the same " * 2000
    own = tokencount.Counted(text, tokenizer)
    new, again = own.apply([(30_000, 30_005, "other"), (45_000, 45_000, "!")])
    assert own.tree.total == full(tokenizer, new) and again < 100


def test_inner_sums(tokenizer):
    own = tokencount.Counted("one two three four five six seven", tokenizer)
    own.apply([(4, 7, "2"), (14, 18, "")])
    node, size = own.tree.node, own.tree.size
    assert all(node[k] == node[2 * k] + node[2 * k + 1] for k in range(1, size))


def test_query_equals_encoding_anew(spark, tokenizer):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    edited = 0
    for r in QUERIES["op4_token_counts"](spark, SF).collect():
        text = docs[r.doc_id] or ""
        new, at = [], 0
        for start, end, word in tokencount.cleaning_edits(text):
            new += [text[at:start], word]
            at = end
        new = "".join([*new, text[at:]])
        edited += r.n_edits > 0
        assert (r.n_tokens_before, r.n_tokens) == (full(tokenizer, text), full(tokenizer, new))
    assert edited > 50


def test_edges(edges, nothing, ranks, tokenizer):
    got = tokencount.count_edited(edges, ranks, public_tokenizers.PATTERN)
    want = sorted((i or -1, full(tokenizer, t or "")) for i, t, *_ in EDGES)
    assert sorted((r.doc_id or -1, r.n_tokens_before) for r in got.collect()) == want
    assert got.columns.count("n_tokens") == 1
    assert tokencount.count_edited(nothing, ranks, public_tokenizers.PATTERN).count() == 0
