import math
import random

import pytest
from pyspark.sql import functions as F

from llm_fixtures import *  # noqa: F401,F403
from conftest import SF_MID
from tessera.llm import quality as op
from tessera.llm.common import read


def sites(spark, groups):
    """Documents of equal text; label 1 for the first ``good`` of each (host, path)."""
    rows, marks = [], []
    for host, path, n, good in groups:
        for k in range(n):
            rows.append((len(rows), "same text", host, path))
            marks.append((len(marks), int(k < good), 0))
    return (spark.createDataFrame(rows, "doc_id long, text string, source string, lang string"),
            spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))


def test_sparse_sites_shrink_and_dense_sites_speak(spark):
    docs, labels = sites(spark, [("good", "a", 300, 290), ("bad", "a", 300, 30), ("bad", "b", 2, 2), ("tiny", "a", 1, 0), ("mid", "a", 200, 100)])
    got = op.quality(spark, docs, labels, host=F.col("source"), path=F.col("lang")).groupBy("host", "path").agg(
        F.first("host_posterior").alias("h"), F.first("path_posterior").alias("p"), F.first("score").alias("s")).collect()
    at = {(r.host, r.path): r for r in got}
    mu = (290 + 30 + 2 + 0 + 100) / 803
    assert at["good", "a"].p == pytest.approx(290 / 300, abs=0.03)
    assert at["bad", "a"].p == pytest.approx(0.1, abs=0.03)
    assert at["tiny", "a"].h > 0.1 and abs(at["tiny", "a"].h - mu) < mu  # one bad document does not condemn a host
    assert at["bad", "a"].p < at["bad", "b"].p < 1.0  # two good ones lift a path part of the way
    assert at["good", "a"].s > at["mid", "a"].s > at["bad", "a"].s


def test_held_out_accuracy(spark):
    got = op.op6_quality(spark, SF_MID).join(read(spark, SF_MID, "labels"), "doc_id").where("held_out").toPandas()
    assert got.keep[got.quality == 1].mean() > 0.97 and got.keep[got.quality == 0].mean() < 0.1


def test_nulls_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None, None, "x"), (2, "", "s", None), (2, "", "s", None), (None, "t " * 50_000, "s", "x")],
                                 "doc_id long, text string, source string, lang string").withColumn("logit", F.lit("clash"))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = op.quality(spark, docs, none, host=F.col("source"), path=F.col("lang")).collect()
    assert len(got) == 4 and all(r.evidence == pytest.approx(0.5) for r in got)
    one = spark.createDataFrame([(1, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    assert all(0 <= r.score <= 1 for r in op.quality(spark, docs, one, host=F.col("source"), path=F.col("lang")).collect())
    assert op.quality(spark, docs.where("false"), none, host=F.col("source"), path=F.col("lang")).count() == 0


def test_site_of(spark):
    urls = spark.createDataFrame([("https://A.org/x/y?q",), ("http://b.com",), ("nonsense",), (None,)], "u string")
    host, path = op.site_of(F.col("u"))
    assert [tuple(r) for r in urls.select(host, path).collect()] == [("a.org", "/x"), ("b.com", None), (None, None), (None, None)]


def brute(rows, marks, lo, hi):
    """Scores by loops over (doc_id, host, path, evidence) rows."""
    v = [float(marks.get(d, e)) for d, _, _, e in rows]
    logit = lambda p: math.log(p / (1 - p))
    hosts, paths = {}, {}
    for (_, h, p, _), x in zip(rows, v):
        hosts.setdefault(h, []).append(x)
        paths.setdefault((h, p), []).append(x)
    n, mu = len(v), sum(v) / len(v)
    share = lambda xs: sum(xs) / len(xs)

    def strength(spread, free, weight):
        between = (spread - free * mu * (1 - mu)) / weight if weight > 0 else 0.0
        return min(max(mu * (1 - mu) / between - 1 if between > 1e-12 else hi, lo), hi)

    k_host = strength(sum(len(x) * (share(x) - mu) ** 2 for x in hosts.values()), len(hosts) - 1,
                      n - sum(len(x) ** 2 for x in hosts.values()) / n)
    k_path = strength(sum(len(x) * (share(x) - share(hosts[h])) ** 2 for (h, _), x in paths.items()), len(paths) - len(hosts),
                      n - sum(len(x) ** 2 / len(hosts[h]) for (h, _), x in paths.items()))
    out = []
    for (d, h, p, e), x in zip(rows, v):
        of_host = (k_host * mu + sum(hosts[h]) - x) / (k_host + len(hosts[h]) - 1)
        of_path = (k_path * of_host + sum(paths[h, p]) - x) / (k_path + len(paths[h, p]) - 1)
        out.append((d, 1 / (1 + math.exp(-(logit(e) + logit(of_path) - logit(mu))))))
    return sorted(out)


def test_scores_equal_brute_force(spark):
    r = random.Random(4)
    rows, marks = [], []
    for k in range(400):
        host = r.choice("abc")
        good = r.random() < {"a": 0.9, "b": 0.5, "c": 0.2}[host]
        rows.append((k, "A calm sentence, well made." * r.randint(1, 4) if r.random() < (0.8 if good else 0.3) else "BUY $$$ NOW!! " * r.randint(1, 9),
                     host, r.choice("xy")))
        if r.random() < 0.4:
            marks.append((k, int(good), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = op.quality(spark, docs, labels, host=F.col("source"), path=F.col("lang")).collect()
    want = brute([(x.doc_id, x.host, x.path, x.evidence) for x in sorted(got, key=lambda x: x.doc_id)],
                 {d: q for d, q, _ in marks}, *op.STRENGTH)
    assert [(d, pytest.approx(s, abs=1e-9)) for d, s in want] == sorted((x.doc_id, x.score) for x in got)


def test_a_site_decides_where_the_text_says_nothing(spark):
    """Texts of one kind only: held-out documents follow the labels of their site."""
    docs, labels = sites(spark, [("good", "a", 200, 190), ("bad", "a", 200, 10)])
    held = F.col("doc_id") % 2 == 1
    got = op.quality(spark, docs, labels, lambda c: c % 2 == 0, host=F.col("source"), path=F.col("lang")).where(held).collect()
    assert all((x.score > 0.6) == (x.host == "good") and (x.score < 0.4) == (x.host == "bad") for x in got)


def test_default_site_and_a_repeated_labelled_id(spark):
    many = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("copy").alias("text"))
    docs = many.unionByName(spark.createDataFrame([(8, "other text!"), (9, "third")], "doc_id long, text string"))
    labels = spark.createDataFrame([(7, 1, 0), (8, 0, 0)], "doc_id long, quality int, toxic int")
    got = op.quality(spark, docs, labels).groupBy("host", "path").count().collect()
    assert [tuple(r) for r in got] == [("", "", 20_002)]
