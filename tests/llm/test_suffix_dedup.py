import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import *  # noqa: F401,F403
from conftest import SF_SMALL
from tessera.llm import suffix_dedup as op
from tessera.llm.common import read

WINDOW, _bytes = op.WINDOW, op._bytes


def brute_force(texts: list[str | None]) -> list[tuple[int, int, int, str]]:
    """The same by counting every window; for tests."""
    seen: dict[bytes, int] = {}
    datas = [_bytes(t) for t in texts]
    for d in datas:
        for i in range(len(d) - WINDOW + 1):
            seen[d[i:i + WINDOW]] = seen.get(d[i:i + WINDOW], 0) + 1
    out = []
    for d in datas:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - WINDOW + 1):
            if seen[d[i:i + WINDOW]] > 1:
                gone[i:i + WINDOW] = True
        starts = int((gone[:-1] & ~np.concatenate(([False], gone[:-2]))).sum()) if len(d) else 0
        kept = bytes(np.frombuffer(d, np.uint8)[~gone[:-1]])
        out.append((len(d), len(d) - len(kept), starts, hashlib.sha256(kept).hexdigest()))
    return out


def result(df):
    out = op.remove_repeats(df).select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("r"),
                                       F.size("spans").alias("k"), F.sha2("kept", 256).alias("s"))
    return sorted((tuple(r) for r in out.collect()), key=str)


def texts(seed):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 8))) for _ in range(500)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    shared = [text(n) for n in (40, 60, 100, 300)]
    docs = [text(r.randint(0, 200)) for _ in range(30)]
    docs += [text(r.randint(0, 50)) + " " + r.choice(shared)[r.randint(0, 30):] + " " + text(r.randint(0, 40)) for _ in range(50)]
    docs += [docs[3], docs[3], None, "", "x" * 199, "x" * 200, "x" * 201, "=" * 1000, "é" * 150, shared[3] * 2, "ab" * 300]
    half = len(docs[45]) // 2
    docs += [docs[45][:half] + "ZZ" + docs[45][half:] for _ in range(3)]
    r.shuffle(docs)
    return docs


def check(frame, docs):
    assert result(frame(list(enumerate(docs)))) == sorted(((i, *b) for i, b in enumerate(brute_force(docs))), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(frame, seed):
    check(frame, texts(seed))


def test_hot_anchors_and_small_segments(frame, monkeypatch):
    monkeypatch.setattr(op, "HOT", 2)
    check(frame, texts(3))


def test_runs_name_the_same_anchor_in_equal_windows(monkeypatch):
    r = random.Random(4)
    shared = bytes(r.choice(b"abcd") for _ in range(260))
    datas = [bytes(r.choice(b"abcd") for _ in range(n)) + shared + b"x" * n for n in (0, 13, 700)]

    def anchor_of(data):
        out = {}
        for h, a, b in op.runs(data):
            for x, first, last in zip(h.tolist(), a.tolist(), b.tolist()):
                out.update({i: x for i in range(first, last + 1)})
        return out

    named = []
    for data in datas:
        at, of = data.index(shared), anchor_of(data)
        assert sorted(of) == list(range(len(data) - WINDOW + 1))
        named.append([of[at + i] for i in range(61)])
    assert named[0] == named[1] == named[2]
    whole = [anchor_of(d) for d in datas]
    monkeypatch.setattr(op, "SEGMENT", 100)
    assert [anchor_of(d) for d in datas] == whole


def test_merge_orders_suffixes_by_prefix():
    r = np.random.default_rng(5)
    strings = [r.integers(1, 3, r.integers(0, 12)) for _ in range(20)]
    shards = [strings[i:i + 6] for i in range(0, 20, 6)]
    parts = [op.shard_bwt(s) for s in shards]
    steps = 5
    z, begins = op.merge([p[0] for p in parts], [len(s) for s in shards], steps)
    taken, suffixes = [0] * len(shards), []
    for s in z.tolist():
        _, number, place = parts[s]
        k = taken[s]
        taken[s] += 1
        suffixes.append(tuple(shards[s][number[k]][place[k]:].tolist()))
    prefixes = [s[:steps] for s in suffixes]
    assert prefixes == sorted(prefixes)
    for i in range(1, len(suffixes)):  # a run has one prefix of full length
        assert begins[i] == (prefixes[i] != prefixes[i - 1] or len(prefixes[i]) < steps)


def test_whole_table_and_empty_tables(spark, frame):
    docs = read(spark, SF_SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = sorted(((d, *b) for (d, _), b in zip(rows, brute_force([t for _, t in rows]))), key=str)
    got = sorted((tuple(r) for r in op.op9_suffix_dedup(spark, SF_SMALL).collect()), key=str)
    assert got == expected and sum(r[2] for r in got) > 0
    assert op.remove_repeats(frame([])).count() == 0


def test_repeated_and_null_ids(frame):
    t = "".join(chr(97 + i * i % 26) + str(i) for i in range(120))
    rows = [(1, t), (1, t), (None, t + "q"), (None, "short"), (2, "other " + t[:150])]
    got = result(frame(rows))
    assert got == sorted(((d, *b) for (d, _), b in zip(rows, brute_force([x for _, x in rows]))), key=str)
