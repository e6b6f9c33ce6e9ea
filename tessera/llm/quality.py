"""Quality scores by hierarchical empirical Bayes.

A classifier of the text gives each document its own evidence. Sites add theirs:
documents belong to a path of a host. A host's share of good documents has a Beta
prior around the global share, a path's share one around its host's; the priors'
strengths come from the spread of the groups (method of moments), so a sparse site
stays near the level above it and a well-observed one speaks for itself. The
document's posterior log-odds are its evidence plus what the other documents of its
path add to the global share. All sums are grouped aggregates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import read, stage
from tessera.llm.toxicity import fit_logistic, learnable

#: Bound of the labelled rows that the classifier learns from.
MAX_LABELLED = 8000
THRESHOLD = 0.5
#: Bounds of a prior's strength, in documents.
STRENGTH = (2.0, 10_000.0)
#: A document's evidence on its own stays within these odds.
LOGIT = 12.0


def site_of(url: Column) -> tuple[Column, Column]:
    """(host, first path segment) of a URL column; null where it has none."""
    part = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)(/[^/?#]*)?", 0)
    host = F.regexp_extract(part, r"://([^/]*)", 1)
    path = F.regexp_extract(part, r"://[^/]*(/.*)", 1)
    return F.lower(F.nullif(host, F.lit(""))), F.nullif(path, F.lit(""))


def features(text: str | None) -> list[float]:
    """Shape of a text: kinds of bytes, length, repetition of words and lines."""
    s = text or ""
    h = np.bincount(np.frombuffer(s.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    n = max(int(h.sum()), 1)
    w, lines = s.split(), s.split("\n")
    of = lambda chars: float(sum(h[ord(c)] for c in chars)) / n
    return [float(h[65:91].sum()) / n, float(h[97:123].sum()) / n, float(h[48:58].sum()) / n, float(h[128:].sum()) / n,
            of("!?"), of("|"), of("#$%&*@"), of("."), of(","), of(" "), of("\n"), of("-_=~"), of("<>{}[]\\/"),
            float(np.log1p(h.sum())), len(set(w)) / max(len(w), 1), len(set(lines)) / len(lines),
            (len(s) - len(w)) / max(len(w), 1) if w else 0.0]


def _train(spark: SparkSession, docs: DataFrame, labels: DataFrame, keep, id_col: str, text_col: str, most: int):
    """Logistic curve of a bounded sample of labelled documents, or the share of good ones if there is one class."""
    marks = (labels.where(F.col("quality").isin(0, 1) & keep(F.col(id_col)))
             .groupBy(F.col(id_col).alias("id")).agg(F.min("quality").alias("y")))
    chosen = marks.orderBy(F.xxhash64("id"), "id").limit(most)

    def look(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in frames:
            yield pa.RecordBatch.from_arrays(
                [f.column("id"), pa.array([features(t) for t in f.column("text").to_pylist()], pa.list_(pa.float64())),
                 f.column("y")], ["id", "x", "y"])

    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .join(F.broadcast(chosen), "id").select("id", "text", "y"))  # at most ``most`` ids
    kind = rows.schema["id"].dataType.simpleString()
    # Rows that repeat an id: the sample has one of them, the least by its figures.
    seen = (rows.mapInArrow(look, f"id {kind}, x array<double>, y int").groupBy("id").agg(F.min("x").alias("x"), F.min("y").alias("y"))
            .toPandas().sort_values("id"))
    y = seen.y.to_numpy(float)
    if len(set(y)) < 2:
        return float(y.mean()) if len(y) else 0.5
    return fit_logistic(np.array(seen.x.tolist()), y, np.ones(len(y)), ridge=0.5)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(spread: float, free: int, weight: float, mu: float) -> float:
    """Prior strength that explains the groups' spread beyond the binomial one."""
    within = mu * (1 - mu)
    between = (spread - free * within) / weight if weight > 0 else 0.0
    return float(np.clip(within / between - 1 if between > 1e-12 else STRENGTH[1], *STRENGTH))


def quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, keep=None, *, id_col: str = "doc_id",
            text_col: str = "text", host: Column | None = None, path: Column | None = None,
            max_labelled: int = MAX_LABELLED) -> DataFrame:
    """One row per row of ``docs``: doc_id, host, path, evidence, host_posterior, path_posterior, score.

    ``keep`` selects the ids whose labels may be used. A labelled document counts with its
    label in its site's sums, any other with the classifier's probability; its own score takes
    its site without it. Null hosts and paths are a site named '', and so is what no column is
    given for. Null and empty texts have the evidence of an empty text. An id
    with both labels counts as not good. Labels that are null or neither 0 nor 1 are not used;
    without any, or with one class only, the evidence of all is the sample's share (1/2
    without labels). Texts are read whole; repeated rows each count and give a row; other
    columns are not read; an empty table gives no rows.
    """
    keep = keep or (lambda c: F.lit(True))
    host, path = (F.lit(None) if c is None else c for c in (host, path))
    curve = _train(spark, docs, labels, keep, id_col, text_col, max_labelled)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.coalesce(host.cast("string"), F.lit("")).alias("host"),
                       F.coalesce(path.cast("string"), F.lit("")).alias("path"))

    def judge(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in frames:
            if isinstance(curve, float):
                z = np.full(f.num_rows, np.log((curve + 1e-6) / (1 - curve + 1e-6)))
            else:
                mean, scale, coef = curve
                x = np.array([features(t) for t in f.column("text").to_pylist()]).reshape(f.num_rows, len(mean))
                z = np.c_[(x - mean) / scale, np.ones(len(x))] @ coef
            yield pa.RecordBatch.from_arrays(
                [*(f.column(c) for c in ("doc_id", "host", "path")), pa.array(np.clip(z, -LOGIT, LOGIT), pa.float64())],
                ["doc_id", "host", "path", "logit"])

    schema = T.StructType([*(rows.schema[c] for c in ("doc_id", "host", "path")), T.StructField("logit", T.DoubleType())])
    marks = (labels.where(F.col("quality").isin(0, 1) & keep(F.col(id_col)))
             .groupBy(F.col(id_col).alias("doc_id")).agg(F.min("quality").alias("y")))
    p = 1 / (1 + F.exp(-F.col("logit")))
    judged = stage(spark, rows.mapInArrow(judge, schema).join(marks, "doc_id", "left")
                   .select("doc_id", "host", "path", "logit", F.coalesce(F.col("y").cast("double"), p).alias("v")), "quality-judged")
    paths = stage(spark, judged.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")), "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    total = hosts.agg(F.sum("hn").alias("n"), F.sum("hs").alias("s"), F.sum(F.col("hn") * F.col("hn")).alias("nn"),
                      F.count(F.lit(1)).alias("k")).first()
    n = float(total.n or 0)
    mu = float(np.clip((total.s or 0.0) / n if n else 0.5, 1e-4, 1 - 1e-4))
    spread = hosts.agg(F.sum(F.col("hn") * F.pow(F.col("hs") / F.col("hn") - mu, 2)).alias("s")).first().s or 0.0
    k_host = _strength(spread, max(total.k - 1, 0), n - float(total.nn or 0) / n if n else 0.0, mu)
    inner = paths.join(hosts, "host").agg(
        F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("hs") / F.col("hn"), 2)).alias("s"),
        F.sum(F.col("n") * F.col("n") / F.col("hn")).alias("nn"), F.count(F.lit(1)).alias("k")).first()
    k_path = _strength(inner.s or 0.0, max(inner.k - total.k, 0), n - float(inner.nn or 0.0), mu)
    def posterior(less_n: Column, less_s: Column) -> tuple[Column, Column]:
        """Host's and path's posterior share without ``less_n`` documents that hold ``less_s``."""
        of_host = (F.lit(k_host * mu) + F.col("hs") - less_s) / (F.lit(k_host) + F.col("hn") - less_n)
        return of_host, (F.lit(k_path) * of_host + F.col("s") - less_s) / (F.lit(k_path) + F.col("n") - less_n)

    sites = stage(spark, paths.join(hosts, "host"), "quality-sites")
    of_host, of_path = posterior(F.lit(0), F.lit(0.0))
    # What its site says about a document comes from the site's other documents.
    _, others = posterior(F.lit(1), F.col("v"))
    logit = F.col("logit") + _logit(F.least(F.greatest(others, F.lit(1e-6)), F.lit(1 - 1e-6))) - float(np.log(mu / (1 - mu)))
    return judged.join(sites, ["host", "path"]).select(
        "doc_id", "host", "path", p.alias("evidence"), of_host.alias("host_posterior"), of_path.alias("path_posterior"),
        (1 / (1 + F.exp(-logit))).alias("score"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``; a document's host is its source and its path the language section."""
    scored = quality(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), learnable,
                     host=F.col("source"), path=F.col("lang"))
    return scored.withColumn("held_out", ~learnable(F.col("doc_id"))).withColumn("keep", F.col("score") >= THRESHOLD)


QUERIES = {"op6_quality": op6_quality}
ORACLES: dict[str, str] = {}
