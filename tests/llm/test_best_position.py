"""Operator 11 against plain scoring of every document (the registered query is compared with DuckDB in test_queries)."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import *  # noqa: F401,F403
from conftest import SF_SMALL
from tessera.llm import best_position as bp
from tessera.llm.common import read

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=20):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(1 for _, c in counts if c)
    n_words = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 75 + (25 * sum(c.values()) * n_docs) // n_words if n_words else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=str)


AWKWARD = ([(i, f"alpha beta w{i % 7} w{i % 5} " + "gamma " * (i % 4)) for i in range(60)]
           + [(60, None), (61, ""), (62, "..."), (63, "ALPHA Éa É"), (64, "alpha " * 30_000), (None, "beta gamma"), (65, "tie"), (66, "tie")]
           + [(7, "alpha beta w0 w2 gamma gamma gamma ")] * 3)
ITEMS = [(1, "alpha w3 w3 gamma"), (1, "beta"), (None, "w1 w2"), (2, None), (3, "absent words"), (4, "tie"), (5, "Éa É É"), (6, "")]


@pytest.mark.parametrize("size", [1, 40, 10_000])
def test_equals_plain_scoring(spark, frame, size):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 AS rank", "2 AS score", "3 AS item")
    got = bp.search(frame(AWKWARD), items, block_postings=size)
    assert rows(got) == brute(AWKWARD, ITEMS)


def test_items_in_many_blocks(spark, frame):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rows(bp.search(frame(AWKWARD), items, k=3, block_bytes=8)) == brute(AWKWARD, ITEMS, 3)


def test_empty_tables(spark, frame):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rows(bp.search(frame([]), items)) == []
    assert rows(bp.search(frame(AWKWARD), items.limit(0))) == []


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in read(spark, SF_SMALL, "documents").collect()]
    items = [(r.item_id, r.text) for r in read(spark, SF_SMALL, "benchmark").collect()]
    assert rows(bp.op11_ranked_search(spark, SF_SMALL)) == brute(docs, items)


def _block(rng, n_docs, n_terms):
    doc, term = np.nonzero(rng.random((n_docs, n_terms)) < 0.5)
    impact = (rng.pareto(1.2, len(doc)) * 1000).astype(np.int64) + 1
    return bp.Block(doc, term, impact, n_docs, n_terms), doc, term, impact


def test_stops_early_and_stays_exact():
    rng = np.random.default_rng(3)
    block, doc, term, impact = _block(rng, 5000, 4)
    weights = np.array([3, 1, 2, 5])
    score = np.bincount(doc, impact * weights[term], 5000)
    docs, scores, n_read = block.search(np.arange(4), weights, 10)
    kth = np.sort(score)[-10]
    assert sorted(scores) == sorted(score[score >= kth]) and (score[docs] == scores).all()
    assert n_read < len(doc) / 5
    assert not block.seen.any()


def test_best_position_lies_beyond_what_was_read():
    """Two lists in the same order but for one document: direct accesses fill the places below it."""
    doc = np.tile(np.arange(400), 2)
    impact = np.concatenate([np.arange(400, 0, -1), np.arange(400, 0, -1)]) * 10
    block = bp.Block(doc, np.repeat([0, 1], 400), impact, 400, 2)
    found, scores, n_read = block.search(np.array([0, 1]), np.array([1, 1]), 3)
    assert sorted(found) == [0, 1, 2] and n_read == 2 * bp.FIRST_READ


def test_equal_scores_at_the_floor_are_returned():
    block = bp.Block(np.arange(100), np.zeros(100, np.int64), np.full(100, 7), 100, 1)
    docs, scores, _ = block.search(np.array([0]), np.array([2]), 5, floor=14)
    assert len(docs) == 100 and set(scores) == {14}
    assert len(block.search(np.array([0]), np.array([2]), 5, floor=15)[0]) == 0


def test_ranking_keeps_a_bounded_number_of_rows_per_task(spark):
    plan = bp.op11_ranked_search(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "CartesianProduct" not in plan
