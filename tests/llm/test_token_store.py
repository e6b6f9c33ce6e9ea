import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_fixtures import *  # noqa: F401,F403
from tessera.llm import token_store as op

PATH = public_tokenizers.path(op.TOKENIZER)
CHARS = "aA'sS tdméÉßÿÞ×÷<|>12²ªºµΣσ́\x85\x1c\x1f\n\t\r中😀“’.,;İǅﬁ"


def texts(n, seed=5):
    r = random.Random(seed)
    out = ["".join(r.choice(CHARS) for _ in range(r.randint(0, 40))) for _ in range(n)]
    return out + ["a<|endoftext|>b <|startoftext|>c", "don't I'VE 'sam it's's", " ", "\n", "word " * 30_000, "ΑΣ ΑΣ."]


def test_encoder_equals_the_tokenizer():
    own, lib = op.Encoder(PATH, 2, memo=50), Tokenizer.from_file(PATH)
    assert own.by_piece
    for t in texts(800):
        assert np.frombuffer(own.encode(t), own.kind).tolist() == lib.encode(t, add_special_tokens=False).ids + [2], repr(t)
    assert np.frombuffer(own.encode(None), own.kind).tolist() == [2]


def test_other_vocabularies_take_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, lib = op.Encoder(path, 50256), Tokenizer.from_file(path)
    assert not own.by_piece
    for t in ("a b  c\n", "x"):
        assert np.frombuffer(own.encode(t), own.kind).tolist() == lib.encode(t, add_special_tokens=False).ids + [50256]


@pytest.mark.parametrize("n,universe", [(0, 0), (1, 0), (1, 9), (1000, 7), (1000, 10 ** 6), (3000, 10 ** 13)])
def test_elias_fano_round_trip(n, universe):
    v = np.sort(np.random.default_rng(n).integers(0, universe + 1, n))
    ef = op.EliasFano.encode(v, universe)
    again = op.EliasFano(ef.n, ef.low_bits, *ef.parts())
    assert (again.decode() == v).all()
    assert [again.select(i) for i in range(0, n, 13)] == v[::13].tolist()
    size = sum(len(p) for p in ef.parts())
    if n >= 1000:
        assert size * 8 <= n * (3 + max(0, np.log2(max(universe, 1) / n))) + 400
    with pytest.raises(IndexError):
        again.select(n)


def expect(rows):
    lib, out, at = Tokenizer.from_file(PATH), [], 0
    coded = [(d, lib.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in rows]
    coded.sort(key=lambda r: (r[0] is not None, r[0] or 0, np.array(r[1], "<u2").tobytes()))
    for d, ids in coded:
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_store_round_trip(spark, frame, scratch):
    t = texts(60, 8)
    rows = [(k * 7 - 100, x) for k, x in enumerate(t)] + [(5, None), (5, "b"), (5, "a"), (None, "n"), (None, None), (2 ** 60, "far")]
    manifest = op.write_store(frame(rows), scratch, PATH, 2, shards=5)
    got = op.read_store(manifest, scratch).orderBy("start").collect()
    assert [tuple(r) for r in got] == expect(rows)
    assert manifest.count() > 1
    first = op.Shard(f"{scratch}/{manifest.orderBy('shard').first()['path']}")
    ids = np.concatenate([ids for _, ids in first.documents()])
    assert np.concatenate([first.document(i) for i in range(len(first))]).tolist() == ids.tolist()
    # A task that runs again writes the same bytes under the same name.
    again = op.write_store(frame(rows).repartition(3), scratch, PATH, 2, shards=5)
    assert [tuple(r) for r in op.read_store(again, scratch).orderBy("start").collect()] == expect(rows)


def test_empty_table(spark, frame, scratch):
    manifest = op.write_store(frame([]), scratch, PATH, 2)
    assert op.read_store(manifest, scratch).count() == 0
