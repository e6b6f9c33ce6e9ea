import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import *  # noqa: F401,F403
from conftest import SF_MID
from tessera.llm import mixing as op
from tessera.llm.common import read


def members(spark, n, p):
    k = len(p[0])
    rows = [(i, int(t), *map(float, q)) for i, (t, q) in enumerate(zip(n, p))]
    return spark.createDataFrame(rows, "doc_id long, n_tokens long, " + ", ".join(f"p_{i} double" for i in range(k)))


def solve(spark, n, p, targets, budget):
    m = members(spark, n, p)
    steps, goal = op.fit_rates(m, np.array(targets, float), budget, max_steps=40)
    r = np.array([x.r for x in m.orderBy("doc_id").select(op.rate(steps).alias("r")).collect()])
    return r, goal


def test_targets_are_met(spark):
    rng = np.random.default_rng(1)
    p, n = rng.dirichlet([0.3] * 4, 300), rng.integers(0, 400, 300)
    r, goal = solve(spark, n, p, [1, 2, 3, 4], 50_000.0)
    assert (r >= 0).all() and (r * n) @ p == pytest.approx(goal, rel=1e-5)
    assert goal.sum() == pytest.approx(50_000)


def test_unreachable_targets_are_the_least_squares_optimum(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([5.0] * 3, 80)  # all soft: no rates give one domain alone
    n = rng.integers(1, 50, 80)
    r, goal = solve(spark, n, p, [1, 0, 0], 1000.0)
    weight = np.linalg.inv((p * n[:, None]).T @ p)

    def loss(x):
        e = (x * n) @ p - goal
        return e @ weight @ e

    best = np.ones(80)  # the same problem by many thousand small steps
    for _ in range(20_000):
        best = np.maximum(0, best - 0.5 * p @ (weight @ ((best * n) @ p - goal)))
    assert (r >= 0).all() and loss(best) > 1
    assert loss(r) <= 1.05 * loss(best)


@pytest.mark.parametrize("side, targets", [(0.2, [0.5, 0.3, 0.2]), (1, [0.3, 0.2, 0.5]), (1, [0.4, 0.1, 0.5])])
def test_default_total_keeps_every_document(spark, side, targets):
    rng = np.random.default_rng(3)
    p = np.vstack([rng.dirichlet(a, m) for a, m in (([9, side, side], 150), ([side, 4, 4 * side], 30), ([side, side, 8], 40))])
    n = rng.integers(1, 400, len(p))
    m = members(spark, n, p)
    steps, goal = op.fit_rates(m, np.array(targets), least=1.0)
    r = np.array([x.r for x in m.orderBy("doc_id").select(op.rate(steps, 1.0).alias("r")).collect()])
    assert r.min() >= 1 and (side == 1 or r.min() == pytest.approx(1))
    assert (r * n) @ p == pytest.approx(goal, rel=1e-5) and goal / goal.sum() == pytest.approx(targets)
    assert goal.sum() <= 2.001 * (n @ p / targets).max()


def test_soft_membership_and_targets_on_documents(spark):
    out = op.op7_mixing(spark, SF_MID).toPandas()
    names = sorted(op.TARGETS)
    p = out[[f"p_{d}" for d in names]].to_numpy()
    assert len(out) == read(spark, SF_MID, "documents").count() and p.sum(1) == pytest.approx(1.0)
    total = (p * (out.n_tokens * out.rate).to_numpy()[:, None]).sum(0)
    assert total / total.sum() == pytest.approx([op.TARGETS[d] for d in names], abs=1e-4)
    assert out.rate.min() >= 1
    lang = out.merge(read(spark, SF_MID, "documents").select("doc_id", "lang").toPandas(), on="doc_id")
    assert (np.array(names)[p.argmax(1)] == lang.lang.to_numpy()).mean() > 0.95


def test_nulls_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "the cat the", "en"), (2, "der hund der", "de"), (3, None, None), (3, None, None),
                                  (4, "", "en"), (None, "the " * 60_000, "xx"), (5, "el gato", "es")],
                                 "doc_id long, text string, lang string").withColumn("source", F.lit(None).cast("string"))
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (None, 1, 0), (77, 0, 0)], "doc_id long, quality int, toxic int")
    targets = {"en": 1.0, "de": 1.0}
    got = op.mix(spark, docs, labels, targets).collect()
    assert len(got) == 7 and all(r.rate >= 0 and r.p_0 + r.p_1 == pytest.approx(1) for r in got)
    none = op.mix(spark, docs, labels.where("false"), targets).collect()  # nothing to learn: all alike
    assert {round(r.p_0, 9) for r in none} == {0.5}
    assert op.mix(spark, docs.where("false"), labels, targets).count() == 0
