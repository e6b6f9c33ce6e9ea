"""Operator 13 against the library's own encoder, with awkward texts."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from llm_fixtures import *  # noqa: F401,F403
from conftest import SF_SMALL
from tessera.llm import piece_codec
from tessera.llm.common import read

PATH = public_tokenizers.path(piece_codec.MODEL)


@pytest.fixture(scope="module")
def pair():
    return piece_codec.PieceCodec(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_equals_the_library_on_random_pieces(pair):
    own, lib = pair
    rng = random.Random(5)
    parts = [*own.pieces, "a", " ", "   ", "▁", "\n", "é", "é", "中", "　", "\x00", "😀", "<s>", "<0x41>", "​"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))
        assert own.encode(text) == lib.encode(text), repr(text)


@pytest.mark.parametrize("text", ["", " ", " " * 17, " " * 1000 + "a", "a" * 20_001, "ab" * 4000, "x\r\n\ty" * 300,
                                  "퟿\U0010ffff", "▁▁a ▁b"])
def test_equals_the_library_on_runs(pair, text):
    own, lib = pair
    assert own.encode(text) == lib.encode(text)
    assert own.decode(own.encode(text)) == lib.decode(lib.encode(text))


def test_last_tokens_are_those_of_every_prefix(pair):
    own, lib = pair
    text = "▁internationalisations,▁über▁▁▁▁die▁zzqx"
    for end, token in enumerate(own.last_tokens(text), 1):
        assert token == [t[0] for t in own.merges(text[:end])][-1]


def test_pair_test_equals_the_definition(pair):
    own, _ = pair
    rng = random.Random(9)
    ids = [i for i in own.text if len(own.merges(own.text[i])) == 1]
    for _ in range(5000):
        a, b = rng.choice(ids), rng.choice(ids)
        assert own.goes_with(a, b) == ([t[0] for t in own.merges(own.text[a] + own.text[b])] == [a, b])


def test_unknown_kinds_of_model_are_refused(tmp_path):
    with pytest.raises(Exception):
        piece_codec.PieceCodec(str(tmp_path / "none.model"))


def _expected(lib, doc_id, text):
    ids = lib.encode(text or "")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return doc_id, len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids))


def test_query_over_the_whole_table(spark, pair):
    want = sorted(_expected(pair[1], r.doc_id, r.text) for r in read(spark, SF_SMALL, "documents").collect())
    assert sorted(tuple(r) for r in piece_codec.op13_piece_codec(spark, SF_SMALL).collect()) == want


def test_awkward_rows(spark, frame, pair):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "null id"), (4, "word " * 60_000), (5, "q" * 50_000)]
    out = piece_codec.encoded(frame(rows), PATH)
    assert out.columns == ["doc_id", "ids", "decoded"]
    got = sorted(((r.doc_id, r.ids, r.decoded) for r in out.collect()), key=str)
    assert got == sorted(((i, pair[1].encode(t or ""), pair[1].decode(pair[1].encode(t or ""))) for i, t in rows), key=str)
    assert piece_codec.encoded(frame([]), PATH).count() == 0


def test_plan_has_no_shuffle(spark):
    plan = piece_codec.op13_piece_codec(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("MapInArrow") == 1


def test_a_pair_is_tested_once_and_a_segment_encoded_once(monkeypatch):
    own = piece_codec.PieceCodec(PATH)
    tested, encoded = [], []
    plain, segment = own.goes_with, own._segment
    monkeypatch.setattr(own, "goes_with", lambda a, b: tested.append((a, b)) or plain(a, b))
    monkeypatch.setattr(own.memo, "encode", lambda s: encoded.append(s) or segment(s))
    text = "zzqx internationalisations über " * 3
    long = "zzqxinternationalisations" * 3  # longer than a remembered segment
    assert own.encode(text + long) == own.encode(text + long) == own.sp.encode(text + long)
    assert len(tested) == len(set(tested)) > 0
    assert {encoded.count(s) for s in encoded if len(s) <= piece_codec.MEMO_CHARS} == {1}
    assert encoded.count("▁" + long) == 2


def test_full_memories_change_no_ids(monkeypatch):
    monkeypatch.setattr(piece_codec, "MEMO_SEGMENTS", 2)
    monkeypatch.setattr(piece_codec, "MEMO_PAIRS", 3)
    own = piece_codec.PieceCodec(PATH)
    for text in ("zzqx internationalisations über x", "other words, zzqx and internationalisations") * 2:
        assert own.encode(text) == own.sp.encode(text)
    assert len(own.memo) == 2 and own.known_pairs == 3
