"""SentencePiece encoding with offsets, against the library."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from llm_rows import EDGES
from strata.llm import pieces
from strata.llm.queries import piece_model

ALPHABET = ["a", "b", "the", " ", "  ", "\n", "▁", ".", ",", "é", "漢", "😀", "ﬁ", "１", "\t", "\x00", "　", "é", "<s>", "0x", "​", "Å", "½"]


def texts(seed, n=300):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(ALPHABET, k=rnd.randrange(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(piece_model())


def test_ids_and_decoding_equal_the_library(model):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for text in ["", " ", *texts(1), "x" * 5000, "word " * 3000]:
        ids, _, _ = model.encode(text)
        assert ids.tolist() == library.encode(text)
        assert model.decode(ids.tolist()) == library.decode(ids.tolist())
    rnd = random.Random(2)
    for _ in range(200):  # ids that no text has
        ids = rnd.choices(range(400), k=rnd.randrange(12))
        assert model.decode(ids) == library.decode(ids)


def test_spans_cover_the_text(model):
    for text in texts(3):
        ids, start, end = model.encode(text)
        data = text.encode()
        if not len(ids):
            continue
        assert start[0] == 0 and end[-1] == len(data) and (start[1:] == end[:-1]).all()
        for i, s, e in zip(ids.tolist(), start.tolist(), end.tolist(), strict=True):
            name = model.whole.id_to_piece(i)
            if not name.startswith("<0x") and s < e:
                assert data[s:e].decode().replace(" ", "▁").replace("▁", "▁") in name


def test_decode_of_given_ids(spark, model):
    coded = spark.createDataFrame([(1, [306, 304]), (2, []), (3, None)], "k long, ids array<int>")
    got = {r.k: r.decoded for r in pieces.decode(coded, piece_model()).collect()}
    assert got == {1: model.whole.decode([306, 304]), 2: "", 3: None}


@pytest.fixture(scope="module", params=[("nmt_nfkc", True, True), ("nfkc", False, True), ("nmt_nfkc_cf", True, False)])
def mapped(request):
    """A model with a compiled character map: the public pieces under another normaliser."""
    rule, tidy, prefix = request.param
    try:
        source = sentencepiece.SentencePieceNormalizer(rule_name=rule)
        spec = sentencepiece_model_pb2.ModelProto.FromString(source.serialized_model_proto()).normalizer_spec
    except Exception as e:  # an older library has no normaliser of its own
        pytest.skip(str(e))
    proto = sentencepiece_model_pb2.ModelProto.FromString(piece_model())
    proto.normalizer_spec.name = rule
    proto.normalizer_spec.precompiled_charsmap = spec.precompiled_charsmap
    proto.normalizer_spec.remove_extra_whitespaces = tidy
    proto.normalizer_spec.add_dummy_prefix = prefix
    return proto.SerializeToString()


def test_character_map(mapped):
    own, library = pieces.Pieces(mapped), sentencepiece.SentencePieceProcessor(model_proto=mapped)
    assert own.map.units
    for text in [*texts(5), "ＫＡＤＯＫＡＷＡ ABC ", "  lead and  trail  ", "ﬁne ½ ㌔ Å"]:
        ids, start, end = own.encode(text)
        assert ids.tolist() == library.encode(text), text
        assert own.decode(ids.tolist()) == library.decode(ids.tolist())
        data = text.encode()
        assert (start <= end).all() and (np.diff(start) >= 0).all() and (end <= len(data)).all()
        for s, e in zip(start.tolist(), end.tolist(), strict=True):
            data[s:e].decode()  # whole characters


def test_edges(edges, nothing):
    got = pieces.encode(edges, piece_model())
    rows = got.select("doc_id", "ids", "starts", "ends", "row").collect()
    assert len(rows) == len(EDGES) and all(len(r.ids) == len(r.starts) == len(r.ends) for r in rows)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted((i or -1, library.encode(t or "")) for i, t, *_ in EDGES)
    assert sorted((r.doc_id or -1, list(r.ids)) for r in rows) == want
    assert pieces.encode(nothing, piece_model()).count() == 0
    back = pieces.round_trip(edges, piece_model()).where(F.col("doc_id") == 7).first()
    assert back.decoded == EDGES[7][1]
