import math
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import *  # noqa: F401,F403
from conftest import SF_MID
from tessera.llm import toxicity as op
from tessera.llm.common import read, words


ORDINARY, TOXIC = {b"abc": 4, b"abd": 1, b"ca": 2, "\u00e9t\u00e9".encode(): 3}, {b"zab": 3, b"abz": 2, b"abc": 1}


def make(ordinary, toxic, texts=()):
    """Model of word counts, and of the word pairs in (class, text)."""
    ws = sorted({*ordinary, *toxic})
    pairs = Counter((c, a, b) for c, t in texts for a, b in zip(words(t), words(t)[1:]))
    kinds = sorted({p[1:] for p in pairs})
    first = op.word_keys([a for a, _ in kinds])
    key = np.concatenate([op.pair_keys(op.word_keys(p)) for p in kinds]) if kinds else np.zeros(0, np.uint64)
    n = np.array([[pairs[c, *p] for p in kinds] for c in (0, 1)]).reshape(2, -1)
    return op.Model(ws, [[x.get(w, 0) for w in ws] for x in (ordinary, toxic)], (first, key, n))


class Plain:
    """The formulas with dictionaries, one gram at a time."""

    def __init__(self, *counts, order=5, d=op.DISCOUNT):
        self.counts, self.order, self.d = counts, order, d
        self.grams = [Counter() for _ in counts]
        for grams, seen in zip(self.grams, counts):
            for w, n in seen.items():
                for g in self.spell(w):
                    grams[g] += n
        self.lower, level = {}, set().union(*self.grams)
        for k in range(order - 1, 0, -1):
            self.lower[k] = Counter(g[1:] for g in level)
            level = set(self.lower[k])

    def spell(self, w):
        s = "\x02" * (self.order - 1) + w.decode("utf-8", "replace") + "\x03"
        return [s[i:i + self.order] for i in range(len(s) - self.order + 1)]

    def step(self, table, g, low):
        after = [n for h, n in table.items() if h[:-1] == g[:-1]]
        return (max(table[g] - self.d, 0) + self.d * len(after) * low) / sum(after) if after else low

    def gram(self, g, c):
        p = 1 / (len(self.lower[1]) + 1)
        for k in range(1, self.order):
            p = self.step(self.lower[k], g[-k:], p)
        return self.step(self.grams[c], g, p)

    def word(self, w, c):
        seen = self.counts[c]
        spelled = math.prod(self.gram(g, c) for g in self.spell(w))
        return (max(seen.get(w, 0) - self.d, 0) + self.d * len(seen) * spelled) / sum(seen.values())


@pytest.mark.parametrize("chunk", [2, 1000])
def test_words_equal_the_plain_formulas(monkeypatch, chunk):
    monkeypatch.setattr(op, "CHUNK_WORDS", chunk)
    m, plain = make(ORDINARY, TOXIC), Plain(ORDINARY, TOXIC)
    ws = [*ORDINARY, *TOXIC, b"zabz", b"abcd", b"qqq", "\u4e2d\u00e9".encode(), b"\xff\xfe"]
    assert np.allclose(m.log_words(ws), [[math.log(plain.word(w, c)) for c in (0, 1)] for w in ws], rtol=1e-12)


def test_spelling_models_are_distributions():
    m = make(ORDINARY, TOXIC)
    alphabet = sorted({g[-1] for c in Plain(ORDINARY, TOXIC).grams for g in c}) + ["\x7f"]  # and one unseen character
    for h in ("zzab", "\u00e9t\u00e9a", "qqqq"):
        grams, n_grams = op.spell([(h + x).encode() for x in alphabet], 5)
        ends = np.cumsum(n_grams) - 2  # the gram that ends with x
        assert np.allclose(np.exp(m.log_grams(grams[ends])).sum(0), 1.0)
    ratio = lambda w: np.diff(m.log_words([w])[0])[0]
    assert ratio(b"zab") > 1 > -1 > ratio(b"ca") and ratio(b"zabz") > 0 > ratio(b"cac")


def test_pairs_equal_the_plain_formula():
    texts = [(0, "a b a b a c"), (0, "b a"), (1, "a c a c b")]
    n = [Counter(w for c, t in texts if c == k for w in words(t)) for k in (0, 1)]
    m, plain = make(*n, texts), Plain(*n)
    pairs = Counter((c, p) for c, t in texts for p in zip(words(t), words(t)[1:]))
    text = words("a c b zz a b c")
    want = []
    for i, w in enumerate(text):
        by_class = []
        for c in (0, 1):
            p, v = plain.word(w, c), text[i - 1]
            if i and n[c][v]:
                taken = sum(max(k - op.DISCOUNT, 0) for (cc, (first, _)), k in pairs.items() if cc == c and first == v)
                p = max(pairs[c, (v, w)] - op.DISCOUNT, 0) / n[c][v] + (1 - taken / n[c][v]) * p
            by_class.append(math.log(p))
        want.append(by_class[1] - by_class[0])
    assert np.allclose(m.ratios(text, np.array([0]))[1], want, rtol=1e-9)


def test_a_phrase_of_ordinary_words_is_told_by_its_order():
    fine, bad = "you are a fine one", "one fine you are a"
    n = Counter(words(fine))
    m = make(n, n, [(0, fine)] * 3 + [(1, bad)] * 3)
    good, ill = m.evidence([fine, bad])
    assert good[0] == ill[0] == 0 and ill[-2] > good[-2] + 0.3  # words alone say nothing


def test_evidence_is_normalised_by_length():
    m = make({b"good": 50, b"text": 50}, {b"good": 20, b"scum": 30})
    one, ten = m.evidence(["good scum", "good scum " * 10])
    assert one[0] == pytest.approx(ten[0]) and one[1] == pytest.approx(ten[1])
    assert not m.evidence([None, "", "!!"]).any() and m.evidence([]).shape == (0, op.N_EVIDENCE)


def test_memo_starts_anew_without_a_change(monkeypatch):
    m = make(ORDINARY, TOXIC)
    texts = ["abc zab", "ca ca q", "r s t u v w x y z"]
    want = m.evidence(texts)
    monkeypatch.setattr(op, "MEMO_WORDS", 2)
    assert np.array_equal(np.concatenate([m.evidence([t]) for t in texts]), want)


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (1 - y).sum())


def test_held_out_accuracy(spark):
    out = op.op5_toxicity(spark, SF_MID)
    got = out.join(read(spark, SF_MID, "labels"), "doc_id").where("held_out").toPandas()
    assert out.count() == read(spark, SF_MID, "documents").count()
    assert auc(got.score.to_numpy(), got.toxic.to_numpy()) > 0.9
    assert got.predicted[got.toxic == 0].mean() < 0.05
    assert out.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_nulls_repeats_and_missing_classes(spark, frame):
    rows = [(1, "you scum"), (2, "fine words"), (3, "fine day scum"), (4, None), (5, ""), (5, ""), (None, "scum"), (6, "w " * 50_000)]
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, 0), (2, 1, 0), (3, 1, None), (99, 1, 1), (4, None, 7)],
                                   "doc_id long, quality int, toxic int")
    got = op.toxicity(spark, frame(rows), labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    assert len({r.score for r in got if r.doc_id in (4, 5)}) == 1
    none = labels.where("false")
    assert {r.score for r in op.toxicity(spark, frame(rows), none).collect()} == {0.0}
    assert op.toxicity(spark, frame([]), none).count() == 0


def test_sample_takes_labelled_rows_up_to_its_bounds(spark):
    docs = spark.range(9000).selectExpr("id AS doc_id", "concat('w', id) AS text")
    labels = docs.selectExpr("doc_id", "1 AS quality", "int(doc_id < 3200) AS toxic")
    got = op.training_rows(docs, labels, lambda c: c.isNotNull(), id_col="doc_id", text_col="text",
                           max_toxic=op.MAX_TOXIC, max_ordinary=op.MAX_ORDINARY).groupBy("y").count().collect()
    assert {r.y: r["count"] for r in got} == {1: 3000, 0: 5000}


def test_sample_is_bounded_in_rows_and_bytes(spark):
    rare = spark.range(40).selectExpr("id AS doc_id", "repeat('w ', 500) AS text")
    docs = rare.unionByName(spark.range(100_000).selectExpr("1L AS doc_id", "concat('copy ', id % 7) AS text"))
    labels = rare.selectExpr("doc_id", "1 AS quality", "int(doc_id < 20) AS toxic")
    take = lambda **kw: op.training_rows(docs, labels, lambda c: c.isNotNull(), id_col="doc_id", text_col="text",
                                         max_toxic=15, max_ordinary=15, **kw)
    assert {r.y: r["count"] for r in take().groupBy("y").count().collect()} == {0: 15, 1: 15}
    few = take(max_bytes=10_000).groupBy("y").count().collect()
    assert {r.y: r["count"] for r in few} == {0: 5, 1: 5}


def test_a_column_score_is_refused(spark, frame):
    with pytest.raises(ValueError):
        op.score(frame([(1, "a")]), None, 0.5)
