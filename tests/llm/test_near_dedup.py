import random

import numpy as np
import pytest

from llm_fixtures import *  # noqa: F401,F403
from conftest import SF_SMALL
from tessera.llm import near_dedup as op
from tessera.llm.common import read, words
from tessera.llm.components import _round, components


def slow_similarity(a, b):
    x, y = dict(zip(a[0].tolist(), a[1])), dict(zip(b[0].tolist(), b[1]))
    every = set(x) | set(y)
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in every) for i in set(x) & set(y))


def sets(seed, n=60):
    r = np.random.default_rng(seed)
    e = r.integers(0, 1 << 63, n).astype(np.uint64)
    return (np.unique(e[:45]), r.integers(1, 5, 45).astype(float)), (np.unique(e[10:]), r.integers(1, 5, 50).astype(float))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_similarity_and_its_estimate(seed):
    a, b = sets(seed)
    exact = op.similarity(a, b)
    assert exact == pytest.approx(slow_similarity(a, b))
    s = op.signatures([a, b, a], 8000)
    assert (s[0] == s[1]).mean() == pytest.approx(exact, abs=0.03)
    assert (s[0] == s[2]).all() and (op.signatures([b], 8000)[0] == s[1]).all()  # whatever it is signed with
    assert op.similarity(a, a) == pytest.approx(1.0) and op.similarity(a, (b[0][:0], b[1][:0])) == 0.0


def test_one_shingle_fills_all_registers():
    one = op.shingles(words("only four words here"))
    assert len(one[0]) == 1 and (op.signatures([one]) == one[0][0]).all()


def brute(rows):
    content, sh = {}, []
    for d, t in rows:
        sh.append(op.shingles(words(t)))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if len(sh[i][0]) and len(sh[j][0]) and (words(rows[i][1]) == words(rows[j][1]) or op.similarity(sh[i], sh[j]) >= op.THRESHOLD):
                parent[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        g = groups[find(i)]
        out.append((d, min((x for x in g if x is not None), default=None), len(g)))
    return sorted(out, key=str)


def edited(r, w, n):
    w = list(w)
    for _ in range(n):
        w[r.randrange(len(w))] = f"e{r.randrange(10 ** 6)}"
    return " ".join(w)


@pytest.mark.parametrize("block", [2, 256])
def test_classes_match_brute_force(spark, frame, monkeypatch, block):
    monkeypatch.setattr(op, "BLOCK", block)
    r = random.Random(6)
    base = [f"w{r.randrange(400)}" for _ in range(150)]
    chain = [base]
    for _ in range(6):  # each near the one before, the ends far apart
        chain.append(edited(r, chain[-1], 2).split())
    rows = [(i, " ".join(w)) for i, w in enumerate(chain)]
    rows += [(100 + i, edited(r, base, r.randint(0, 9))) for i in range(25)]
    rows += [(200 + i, " ".join(f"u{r.randrange(400)}" for _ in range(r.randint(1, 80)))) for i in range(20)]
    rows += [(300, "One, two three!"), (301, "one two THREE"), (302, "one two four"), (303, None), (304, ""), (305, "?!"), (305, "?!"),
             (None, rows[3][1]), (None, "null alone"), (8, rows[5][1]), (8, rows[5][1]), (400, "again and " * 20_000), (401, "again and " * 20_000)]
    got = sorted(((x.doc_id, x.class_id, x.class_size) for x in op.near_duplicates(frame(rows)).collect()), key=str)
    assert got == brute(rows)


def test_documents_and_empty_tables(spark, frame):
    docs = read(spark, SF_SMALL, "documents")
    out = op.op10_near_dedup(spark, SF_SMALL).collect()
    assert sorted(((x.doc_id, x.class_id, x.class_size) for x in out), key=str) == brute([(d.doc_id, d.text) for d in docs.collect()])
    assert sum(x.kept for x in out) == len({x.class_id for x in out})
    assert op.near_duplicates(frame([])).count() == 0


def test_components(spark):
    r = random.Random(7)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(r.randrange(200, 260), r.randrange(200, 260)) for _ in range(25)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {x.node: x.root for x in components(spark, spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert components(spark, spark.createDataFrame([], "u long, v long")).count() == 0


def test_a_round_of_components_shuffles_three_times(spark, scratch):
    links = spark.createDataFrame([(2, 1), (3, 2), (9, 3)], "u long, v long")
    plan = _round(links)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3 and "Join" not in plan


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_repeated_links_loops_and_chains(spark, scratch, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)] + [(200 + i, 201 + i) for i in range(30)]
    edges += edges[:20] + [(b, a) for a, b in edges[20:40]] + [(7, 7), (500, 500)]
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    met = {n for a, b in edges if a != b for n in (a, b)}  # a loop alone is no link
    got = [tuple(r) for r in components(spark, spark.createDataFrame(edges, "u long, v long")).collect()]
    assert sorted(got) == sorted((n, root[n]) for n in met)
