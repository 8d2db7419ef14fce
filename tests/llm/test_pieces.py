"""Operator 12 against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2

import kinelab.llm.pieces as m
from kinelab.llm.pieces import Normalizer, PieceModel, encode_pieces, piece_digests
from kinelab.llm.queries import op12_pieces

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
OURS = PieceModel(MODEL)
ODD = ["a", "b", "the", " ", "  ", "     ", "▁", "\n", "\t", "é", "é", "漢字", "\U0001f600", "<s>", "<0x41>", "</s>", "1", "23", "\0",
       "�", "가", "Ω", "　", "ing", "\r\n", "⁇", " ⁇ ", "<unk>", "‍", "İ", "ﬁ", "Ａ", "①", "$$$", "_", "a.b,c"]


def same(text):
    ids, starts, ends = OURS.encode(text.encode())
    want = LIBRARY.encode_as_proto(text)
    assert ids.tolist() == LIBRARY.encode(text) == [p.id for p in want.pieces]
    assert list(zip(starts.tolist(), ends.tolist())) == [(p.begin, p.end) for p in want.pieces]
    assert OURS.decode(ids.tolist()).decode() == LIBRARY.decode(ids.tolist())


def test_odd_texts():
    rng = random.Random(3)
    for _ in range(4000):
        same("".join(rng.choice(ODD) for _ in range(rng.randint(0, 30))))


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_text(text):
    same(text)


def test_long_chunks():
    rng = random.Random(4)
    for n in (63, 64, 65, 500, 5000):
        same("".join(rng.choice("etaoinshr") for _ in range(n)))
        same("".join(rng.choice("漢字の一e") for _ in range(n)))
    same(" " * 3000 + "x" + " " * 17)
    same(("word " * 9000) + "\n" * 500)


def test_any_ids_decode():
    rng = random.Random(6)
    for _ in range(4000):
        ids = [rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(259, 32000), 28705]) for _ in range(rng.randint(0, 8))]
        assert OURS.decode(ids).decode() == LIBRARY.decode(ids)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "nfkc_cf"])
@pytest.mark.parametrize("tight", [True, False])
def test_compiled_maps(rule, tight):
    """Longest-prefix normalisation and its source places, for the maps that the library brings along."""
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, remove_extra_whitespaces=tight)
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(library.serialized_model_proto())
    assert len(proto.normalizer_spec.precompiled_charsmap) > 100_000
    ours = Normalizer(proto.normalizer_spec)
    rng = random.Random(7)
    for _ in range(1500):
        text = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 25)))
        want, places = library.normalize(text, with_offsets=True)
        raw = text.encode()
        out, at = ours(raw)
        assert out.decode() == want
        chars = [len(out[:i]) for i in range(len(out) + 1) if i == len(out) or out[i] & 0xC0 != 0x80]
        assert [len(raw[:at[i]].decode()) for i in chars] == places


def test_bytes_that_are_no_text():
    ids, starts, ends = OURS.encode(b"a\xffb")
    assert OURS.decode(ids.tolist()) == "a�b".encode() and ends.tolist()[-1] == 3 and starts.tolist()[0] == 0


def model_of(tmp_path, pieces, byte_fallback=False, **spec):
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(LIBRARY.serialized_model_proto())
    del proto.pieces[:]
    for piece, score, kind in pieces:
        proto.pieces.add(piece=piece, score=score, type=kind)
    proto.trainer_spec.byte_fallback = byte_fallback
    proto.trainer_spec.vocab_size = len(pieces)
    for k, v in spec.items():
        setattr(proto.normalizer_spec, k, v)
    path = tmp_path / "small.model"
    path.write_bytes(proto.SerializeToString())
    return str(path)


@pytest.mark.parametrize("tight", [True, False])
@pytest.mark.parametrize("prefix", [True, False])
def test_unknown_and_unused_pieces(tmp_path, tight, prefix):
    """Hand-made vocabularies: no byte pieces, unused steps on the way, equal scores."""
    pieces = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3), *[(c, -9, 1) for c in "▁abcd"],
              ("ab", -1, 5), ("abc", -2, 1), ("cd", -2, 1), ("bc", -3, 1), ("▁a", -2, 1), ("a▁", -4, 1), ("dd", -2, 5), ("dddd", -5, 1)]
    path = model_of(tmp_path, pieces, remove_extra_whitespaces=tight, add_dummy_prefix=prefix)
    library, ours = sentencepiece.SentencePieceProcessor(model_file=path), PieceModel(path)
    rng = random.Random(9)
    for _ in range(1500):
        text = "".join(rng.choice("aabbccdd  xyzé") for _ in range(rng.randint(0, 90)))
        want = library.encode_as_proto(text)
        ids, starts, ends = ours.encode(text.encode())
        assert ids.tolist() == [p.id for p in want.pieces]
        assert list(zip(starts.tolist(), ends.tolist())) == [(p.begin, p.end) for p in want.pieces]
        assert ours.decode(ids.tolist()).decode() == library.decode(ids.tolist())


def test_other_models_are_refused(tmp_path):
    with pytest.raises(ValueError):
        PieceModel(model_of(tmp_path, [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3), ("a", -1, 1), ("<x>", 0, 4)]))


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def expected(doc_id, text):
    ids = LIBRARY.encode(text or "")
    return doc_id, len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids))


def test_query_against_the_library(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(tuple(r) for r in op12_pieces(spark, SF).collect()) == sorted(expected(*r) for r in docs)


def test_memo_may_overflow(monkeypatch):
    monkeypatch.setattr(m, "MEMO", 3)
    ours = PieceModel(MODEL)
    text = "some words here, some other words there; some words here"
    assert ours.encode(text.encode())[0].tolist() == LIBRARY.encode(text) and len(ours.chunks) <= 3


def test_defined_cases(spark):
    schema = "doc_id long, text string, ids string, starts int, decoded int, source string"
    texts = [(None, "a b"), (1, None), (2, ""), (3, " "), (4, "\n\n"), (4, "\n\n"), (5, "▁ ▁"), (6, "x" * 200_000), (None, None)]
    docs = spark.createDataFrame([(i, t, "x", 1, 2, "s") for i, t in texts], schema)
    got = encode_pieces(docs, MODEL)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in piece_digests(got).collect()), key=key) == sorted((expected(*r) for r in texts), key=key)
    for r in got.collect():
        assert len(r["ids"]) == len(r["starts"]) == len(r["ends"])
        assert not r["ids"] or (r["starts"][0] == 0 and np.all(np.diff(r["starts"]) >= 0))
    assert piece_digests(encode_pieces(docs.limit(0), MODEL)).count() == 0
