import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_fixtures import *  # noqa: F401,F403
from conftest import SF_SMALL
from tessera.llm import gru
from tessera.llm import lm_score as op
from tessera.llm.common import read


@pytest.fixture()
def model(monkeypatch):
    monkeypatch.setattr(gru, "F32", np.float64)
    r = np.random.default_rng(0)
    lay = gru.Layout(np.sort(r.integers(1, 100, 40))[::-1], 3.0, n_soft=24, class_size=8, n_tail=2)
    w = {k: (v + r.standard_normal(v.shape) * 0.1).astype(np.float64) for k, v in gru.initial(lay, 5).items()}
    return gru.Gru(lay, w), r


def test_words_sum_to_one(model):
    m, _ = model
    for past in ([], [3, 25], [39, 0, 40]):
        before = m.score([np.array(past)])[0] if past else 0.0
        assert sum(math.exp(m.score([np.array([*past, c])])[0] - before) for c in range(41)) == pytest.approx(1.0)


def test_gradients_by_differences(model):
    m, r = model
    lay = m.layout
    ids = np.array([[lay.start, 3], [4, 5], [2, lay.start], [7, 26]])
    codes = np.array([[4, 9], [2, 40], [7, 30], [-1, 8]])
    real, h = codes >= 0, r.standard_normal((2, 5)) * 0.5
    value = lambda: m._outputs(m._steps(h, ids)[1][real], codes[real], False).sum()
    _, _, g, seen = m.gradients(h, ids, codes, real)
    full = np.zeros_like(m.w["wx"])
    full[seen] = g["wx"]
    g["wx"] = full
    for name in gru.NAMES:
        for _ in range(10):
            i = tuple(r.integers(0, n) for n in m.w[name].shape)
            was, out = m.w[name][i], []
            for step in (1e-5, -1e-5):
                m.w[name][i] = was + step
                out.append(value())
            m.w[name][i] = was
            assert (out[0] - out[1]) / 2e-5 == pytest.approx(g[name][i], abs=1e-6)


def test_state_is_carried_over_windows_and_lanes(model):
    m, r = model
    docs = [r.integers(0, 41, n) for n in (7, 1, 50, 3, 12)]
    whole = [m.score([d], 1, 1000)[0] for d in docs]
    assert m.score(docs, 2, 3) == pytest.approx(whole) == m.score(docs, 8, 5)


def test_scoring_path_equals_the_training_path(model):
    m, r = model
    ids, h = r.integers(0, m.layout.n_inputs, (6, 3)), r.standard_normal((3, 5)) * 0.5
    assert np.allclose(m._states(h, ids, *m._halved())[1], m._steps(h, ids)[1], atol=1e-6)
    flat, codes = r.standard_normal((40, 5)), r.integers(0, 41, 40)
    assert np.allclose(m._outputs(flat, codes, False, True), m._outputs(flat, codes, False))


def test_training_beats_the_unigram_start():
    r = np.random.default_rng(1)
    docs = [np.array([(s + i) % 20 for i in range(60)]) for s in r.integers(0, 20, 200)]
    lay = gru.Layout(np.bincount(np.concatenate(docs)).astype(float), 0.5, n_soft=16, class_size=4, n_tail=2)
    m = gru.Gru(lay, gru.initial(lay, 16))
    before = m.score(docs).sum()
    m.train(docs, {k: np.full(v.shape, 1e-6, np.float32) for k, v in m.w.items()}, 0.1)
    assert m.score(docs).sum() > 0.7 * before  # log-probabilities: nearer to 0
    again = gru.unpack(gru.pack(m.w), lay, 16)
    assert all((again[k] == m.w[k]).all() for k in gru.NAMES)


def brute(rows, learn):
    docs = [(d, (t or "").encode().lower().split() + [b""]) for d, t in rows]
    c = Counter(w for (d, ws) in docs if learn(d) for w in ws)
    total, types = sum(c.values()), len(c)
    return sorted((str(d), len(w), sum(c[x] > 0 for x in w), total,
                   round(sum(math.log10((c[x] + .5) / (total + .5 * (types + 1))) for x in w), 6)) for d, w in docs)


LEARN = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 != 1


@pytest.mark.parametrize("frequent", [1 << 17, 30])
def test_base_scores_match_brute_force(spark, frequent):
    docs = read(spark, SF_SMALL, "documents")
    got = op.lm_scores(docs, op.learnable, frequent=frequent).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == brute(rows, LEARN)
    held = [r for r in got if not r.learnt]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) * 1.02
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # log-probabilities: nearer to 0


def test_any_training_document_moves_the_model(spark, frame):
    words = " ".join(f"w{i % 64}" for i in range(640))
    rest = frame([(k, words) for k in range(100, 104)])
    start = None
    for k in range(4):  # one training document, whatever its id
        got = op.lm_scores(frame([(k, words)]).unionByName(rest), lambda c, k=k: c == k).where("NOT learnt").collect()
        untrained = 641 * math.log10(1 / 65)  # nearly: all 65 tokens are alike
        assert all(r.score > 0.9 * untrained for r in got)
        start = start or [r.score for r in got]
        assert [r.score for r in got] == pytest.approx(start, rel=1e-3)


def test_rounds_use_all_documents_whatever_the_layout(spark):
    docs = read(spark, SF_SMALL, "documents")
    total = sum(r.n_tokens for r in op.lm_scores(docs, op.learnable).where("learnt").collect())
    assert op.schedule(total, 6_000)[0] > 2 and op.schedule(total, 6_000)[1] > 2
    got = []
    for df in (docs.repartition(1), docs.repartition(9).orderBy(F.desc("doc_id"))):
        scores = op.lm_scores(df, op.learnable, turn_tokens=6_000).collect()
        got.append([r.score for r in sorted(scores, key=lambda r: r.doc_id)])
    assert got[0] == pytest.approx(got[1], rel=1e-4)
    rows = docs.where(op.learnable(F.col("doc_id"))).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    pairs = Counter(w for r in rows.collect() for w in [*op.tokens(r.text), op.END]).most_common()
    made = op.Tables([w for w, _ in pairs], [n for _, n in pairs], total, len(pairs), 0.5)
    tables = spark.sparkContext.broadcast(made)
    turns = op.coded_turns(spark, rows, tables, 3, 4)
    assert turns.count() == rows.count() and turns.select("round", "replica").distinct().count() == 12
    flat, learnt = op.train_model(turns, tables, 3, 4)
    assert learnt == total and np.isfinite(flat).all()


def test_nulls_repeats_and_empty_tables(spark, frame):
    rows = [(1, "a B a"), (2, None), (2, None), (3, ""), (None, "b\x0bc"), (4, "z " * 30_000), (5, " x é")]
    got = op.lm_scores(frame(rows), op.learnable).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == brute(rows, LEARN)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    untaught = op.lm_scores(frame(rows), lambda c: F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in untaught)
    assert op.lm_scores(frame([]), op.learnable).count() == 0


TEXTS = ["  a B\x0b\x0cc\r\n d ", "", " ", "É\x1cÀ\x85x\x00y z", "x x q", "end  a", "  ", "q"]


@pytest.mark.parametrize("known", [[b"", b"a", b"x"], [b"a", b"x"], []])
def test_batches_are_coded_as_their_texts_one_by_one(known):
    coder = op.Coder(op.Tables(known, [3] * len(known), 10, 5, 2.0))
    codes, starts, others = coder.documents(pa.array(TEXTS))
    words = [[*op.tokens(t), op.END] for t in TEXTS]
    code = lambda w: known.index(w) if w in known else len(known)
    assert [codes[a:b].tolist() for a, b in zip(starts, starts[1:])] == [[code(w) for w in ws] for ws in words]
    assert others.to_pylist() == [w for ws in words for w in ws if w not in known]


@pytest.mark.parametrize("size", [1, 25, 10_000])
def test_pieces_keep_all_rows_in_order(size):
    f = pa.RecordBatch.from_arrays([pa.array(TEXTS), pa.array(range(8))], ["text", "k"])
    got = list(op.pieces(iter([f, f.slice(3, 0), f.slice(2)]), size))
    assert [k for b in got for k in b.column("k").to_pylist()] == [*range(8), *range(2, 8)]
    assert len(got) == {1: 14, 25: 6, 10_000: 1}[size]


def test_a_window_makes_few_products(model, monkeypatch):
    """A class that a window uses costs one product forward and two back, however many tokens it has."""
    m, r = model
    calls = Counter()
    monkeypatch.setattr(np, "matmul", lambda *a, real=np.matmul, **k: (calls.update(n=1), real(*a, **k))[1])
    for n in (200, 2000):
        calls.clear()
        m._outputs(r.standard_normal((n, 5)) * 0.5, r.integers(0, 24, n), True)
        assert 0 < calls["n"] <= 3 * m.layout.soft_classes


def test_sums_of_groups_by_brute_force():
    r = np.random.default_rng(3)
    ids, rows = np.sort(r.integers(0, 12, 300) ** 2 // 12), r.standard_normal((300, 4))
    first = np.flatnonzero(np.diff(ids, prepend=-1))
    mixed = r.permutation(300)
    back = np.empty_like(mixed)
    back[mixed] = np.arange(300)
    want = [rows[ids == i].sum(0) for i in np.unique(ids)]
    assert np.allclose(gru._sums(rows[mixed], back, first), want)


def test_training_goes_on_from_the_sums_of_squares_it_leaves():
    r = np.random.default_rng(2)
    docs = [r.integers(0, 21, n) for n in (40, 9, 300, 1)]
    lay = gru.Layout(np.arange(20, 0, -1.0), 0.5, n_soft=16, class_size=4, n_tail=2)
    m = gru.Gru(lay, gru.initial(lay, 4))
    past = {k: np.full(v.shape, 1e-6, np.float32) for k, v in m.w.items()}
    m.train(docs, past, 0.1)
    assert all((past[k] > 1e-6).any() and (past[k] >= 0.99e-6).all() and np.isfinite(m.w[k]).all() for k in gru.NAMES)
    before = {k: v.copy() for k, v in past.items()}
    m.train(docs, past, 0.1)
    assert all((past[k] >= before[k] * 0.999).all() for k in gru.NAMES)


def test_small_shares_keep_their_updates():
    for share in (250_000, 1_000_000, 2_000_000):
        width, rate = op.updates(share)
        assert share / (width * op.STEPS) > 400 and rate == pytest.approx(op.LEARNING_RATE * (width / op.LANES) ** 0.5)
    assert op.updates(10)[0] == op.LEAST_LANES and op.updates(1 << 40)[0] == op.LANES
