"""Operator 12 against numpy on whole tables, and its eigenvalue updates against direct ones."""

import math

import numpy as np
import pytest

from llm_fixtures import *  # noqa: F401,F403
from conftest import SF_MID, SF_SMALL
from tessera.llm import whitening as w
from tessera.llm.common import read

SCHEMA = "vec_id long, embedding array<float>, n string, x string, component string"


def brute(rows, k=4):
    """{(vec_id, component): (n, deviation, |whitened|, explained)} and the eigenvalues."""
    ints = [(i, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({x for _, x in ints}), float)
    n, sums = len(fit), [sum(int(c) for c in col) for col in zip(*{x for _, x in ints})]
    off = fit - fit.mean(0)
    values, vectors = np.linalg.eigh(off.T @ off / n)
    out = []
    for i, x in ints:
        dev = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        for c in range(min(k, len(x))):
            e = values[-1 - c]
            out.append((i, c + 1, n, dev, abs((np.array(x) - fit.mean(0)) @ vectors[:, -1 - c]) / math.sqrt(e), e / values.sum()))
    return sorted(out, key=lambda r: (str(r[0]), r[1], r[4])), values


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_whole_table(spark, sf):
    want, values = brute([(r.vec_id, r.embedding) for r in read(spark, sf, "embeddings").collect()])
    got = sorted(((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in w.op12_whitening(spark, sf).collect()),
                 key=lambda r: (str(r[0]), r[1], r[4]))
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[4] for r in got], [r[4] for r in want], rtol=1e-7, atol=1e-9)
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-12)
    assert w.op12_whitening(spark, sf).agg({"identity_error": "max"}).first()[0] < 1e-10


def test_awkward_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(40)]
    rows += rows[:5] + [(None, rows[7][1]), (41, rows[8][1])]
    bad = [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [float("nan"), 1.0, 2.0]), (54, [float("inf"), 0.0, 0.0]), (55, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows + bad], SCHEMA)
    want, _ = brute(rows)
    got = sorted(((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in w.whiten(df).collect()),
                 key=lambda r: (str(r[0]), r[1], r[4]))
    assert [r[:3] for r in got] == [r[:3] for r in want] and {r[1] for r in got} == {1, 2, 3}
    assert sorted(r[3] for r in got) == sorted(r[3] for r in want)
    assert np.allclose([r[4] for r in got], [r[4] for r in want], atol=1e-9)


def test_empty_and_constant_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert w.whiten(empty).collect() == []
    same = spark.createDataFrame([(i, [1.0, 2.0], "", "", "") for i in range(9)], SCHEMA)
    assert w.whiten(same).collect() == []
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0], "", "", "") for i in range(9)], SCHEMA)
    assert {r.component for r in w.whiten(line).collect()} == {1}


def test_deviation_beyond_a_long_is_null(spark):
    df = spark.createDataFrame([(1, [1e12, 0.0], "", "", ""), (2, [0.0, 1.0], "", "", "")], SCHEMA)
    assert {r.deviation for r in w.whiten(df).collect()} == {None}


@pytest.mark.parametrize("dim", [1, 2, 7, 40])
def test_rank_one_updates(dim):
    rng = np.random.default_rng(dim)
    values, vectors, full = np.zeros(0), np.zeros((dim, 0)), np.zeros((dim, dim))
    for step in range(150):
        x = [rng.integers(-3, 4, dim).astype(float), rng.normal(size=dim) * 10 ** rng.uniform(-4, 4),
             np.eye(dim)[step % dim] * 5][step % 3]
        values, vectors = w.rank_one(values, vectors, x, 1.5)
        full += 1.5 * np.outer(x, x)
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max(initial=0) < 1e-12
        assert np.abs(vectors * values @ vectors.T - full).max() <= 1e-11 * max(1e-300, np.abs(full).max())


def test_equal_eigenvalues_are_deflated():
    values, vectors = w.rank_one(np.full(6, 2.0), np.eye(6), np.arange(6.0), 1.0)
    assert np.allclose(values, [2] * 5 + [57]) and np.allclose(vectors.T @ vectors, np.eye(6))


def test_combined_spectra_equal_one_pass():
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(90, 6)) + 5
    parts = []
    for chunk in np.array_split(rows, 4):
        s = w.Spectrum.empty(6)
        for x in chunk:
            s.add(x)
        parts.append(s.pack())
    s = w.Spectrum.unpack(w._combined_spectra(parts))
    assert s.n == 90 and np.allclose(s.mean, rows.mean(0))
    assert np.allclose(s.values, np.linalg.eigvalsh(np.cov(rows.T, bias=True) * 90))
