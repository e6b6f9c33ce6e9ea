import random
import re

import pytest

from llm_fixtures import *  # noqa: F401,F403
from tessera.llm import decontaminate as op

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = {c: c + 32 for c in range(65, 91)}


def brute(docs, items):
    pats = []
    for i, t in items:
        w = WORD.findall((t or "").translate(AZ))
        n = min(10, len(w))
        pats += [(i, w[a:a + n]) for a in range(len(w) - n + 1)] if n else []
    out = []
    for doc_id, t in docs:
        w, hit, found = WORD.findall((t or "").translate(AZ)), set(), set()
        for i, p in pats:
            for a in range(len(w) - len(p) + 1):
                if w[a:a + len(p)] == p:
                    hit.update(range(a, a + len(p)))
                    found.add(i)
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_words, sum(x.b - x.a for x in r.runs), r["items"]) for r in df.collect()), key=str)


def tables(seed):
    r = random.Random(seed)
    vocabulary = ["a", "bb", "Ccc", "é", "d4", "x"]
    text = lambda n: r.choice([" ", ", ", "-\n"]).join(r.choice(vocabulary) for _ in range(n))
    items = [(f"i{k}", text(r.choice([1, 2, 3, 9, 10, 11, 25]))) for k in range(12)] + [("i3", "zz"), ("n", None), ("e", "..")]
    docs = [(k, text(r.randint(0, 60))) for k in range(30)] + [(90, None), (91, ""), (92, "!!"), (92, "!!"), (None, items[0][1])]
    docs += [(100 + k, text(5) + " " + (t or "") + " " + text(7)) for k, (_, t) in enumerate(items)]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, frame, seed):
    docs, items = tables(seed)
    bench = spark.createDataFrame(items, "item_id string, text string")
    assert result(op.hit_runs(frame(docs), bench)) == brute(docs, items)


@pytest.mark.parametrize("block_bytes", [op.BLOCK_BYTES, 60])
def test_items_with_a_null_id_are_searched(spark, frame, block_bytes):
    docs, items = tables(5)
    items = [(None if k % 3 == 0 else i, t) for k, (i, t) in enumerate(items)]
    want = [(*r[:3], [None if i == "~" else i for i in r[3]]) for r in brute(docs, [(i or "~", t) for i, t in items])]
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = result(op.hit_runs(frame(docs), bench, block_bytes=block_bytes))
    assert got == sorted(want, key=str) and any(None in r[3] for r in got)


def test_query_equals_its_sql_with_null_ids(spark, frame, scratch):
    import duckdb
    docs, items = tables(6)
    docs = [(k, t) for k, (_, t) in enumerate(docs)]
    items = [(None if k % 3 == 0 else i, t) for k, (i, t) in enumerate(items)]
    frame(docs, extra=False).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{scratch}/benchmark.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{scratch}/{name}.parquet/*.parquet')")
    got = [tuple(r) for r in op.op2_decontaminate(spark, str(scratch)).collect()]
    assert sorted(got) == sorted(con.execute(op.ORACLE).fetchall())


def test_long_texts_in_pieces_and_items_in_blocks(spark, frame, monkeypatch):
    docs, items = tables(3)
    monkeypatch.setattr(op, "SEGMENT", 16)
    tabs, ids = op.build(items)
    for doc_id, n, hit, found in brute(docs, items):
        text = dict(docs)[doc_id]
        if [d for d, _ in docs].count(doc_id) == 1:
            words, runs, numbers = op.match(text, tabs)
            assert (words, sum(b - a for a, b in runs), sorted(ids[k] for k in numbers)) == (n, hit, found)
    bench = spark.createDataFrame(items, "item_id string, text string")
    assert result(op.hit_runs(frame(docs), bench, block_bytes=60)) == brute(docs, items)


def test_empty_tables(spark, frame):
    docs, items = tables(4)
    none = spark.createDataFrame([], "item_id string, text string")
    assert result(op.hit_runs(frame(docs), none)) == brute(docs, [])
    assert op.hit_runs(frame([]), none).count() == 0


def test_large_ids_next_to_null_stay_exact(spark, frame):
    docs = [(9007199254740993, "a"), (None, "a")]
    got = op.hit_runs(frame(docs), spark.createDataFrame([("i", "a")], "item_id string, text string")).collect()
    assert {r.doc_id for r in got} == {9007199254740993, None}
