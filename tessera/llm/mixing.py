"""Mixing to target weights with soft domain membership.

A classifier, fitted on a bounded sample of the labelled table's documents,
gives each document a posterior p over domains. Document rates r >= 0 are
fitted so that the expected tokens of each domain, sum r n p, meet its target:
projected gradient on the least squares of the shortfall e, weighted by the
inverse Gram matrix G = sum n p p',

    r <- max(least, r - p' G^-1 e)

with Nesterov's momentum, should the bound keep one step from the goal. The bound
is 0 for a given total. Otherwise it is 1, so that no document is lost, and the
total is raised until the targets can be met above it. Each step is one
distributed sum of as many numbers as there are domains. A rate depends on its
document's p and the steps so far only, so rates are an expression over p and no
state is kept per document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import read, stage, words

#: Bounds of the classifier's sample and vocabulary.
MAX_LABELLED, MAX_WORDS = 4000, 3000
STEPS, TOLERANCE = 40, 1e-7
FIT_ROWS = 512
#: Doublings of the total that are tried where the closed form asks for more than one.
DOUBLINGS = 3
TARGETS = {"de": 0.18, "en": 0.50, "es": 0.14, "fr": 0.18}


class Classifier:
    """Softmax over domains of a text's word frequencies."""

    def __init__(self, vocabulary: list[bytes], weights: np.ndarray, bias: np.ndarray):
        self.code = {w: i for i, w in enumerate(vocabulary)}
        self.weights, self.bias = weights, bias

    def vector(self, text: str | None) -> tuple[int, np.ndarray, np.ndarray]:
        """(tokens, codes, values): counts of known words, scaled to length one."""
        w = words(text)
        get = self.code.get
        codes, n = np.unique(np.array([c for c in map(get, w) if c is not None], np.int64), return_counts=True)
        size = np.sqrt(float((n * n).sum()))
        return len(w), codes, n / size if size else n.astype(float)

    def posterior(self, text: str | None) -> tuple[int, np.ndarray]:
        tokens, codes, x = self.vector(text)
        z = x @ self.weights[codes] + self.bias if len(codes) else self.bias
        p = np.exp(z - z.max())
        return tokens, p / p.sum()


def _fit(x: np.ndarray, y: np.ndarray, k: int, ridge: float = 1e-3, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression by accelerated gradient descent; rows of ``x`` have length one."""
    n = len(x)
    w = np.zeros((x.shape[1] + 1, k))
    look, t = w, 1.0
    for _ in range(rounds):
        slope = ridge * look
        for i in range(0, n, FIT_ROWS):  # so that only some rows are doubles at a time
            part, own = x[i:i + FIT_ROWS].astype(float), y[i:i + FIT_ROWS]
            z = part @ look[:-1] + look[-1]
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(own)), own] -= 1
            slope[:-1] += part.T @ p / n
            slope[-1] += p.sum(0) / n
        new = look - slope
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return w[:-1], w[-1]


def train(docs: DataFrame, labels: DataFrame, domains: list[str], *, id_col: str = "doc_id", text_col: str = "text",
          domain_col: str = "lang", max_labelled: int = MAX_LABELLED, max_words: int = MAX_WORDS) -> Classifier:
    """Classifier of documents that the labelled table covers; uniform if none of them has a domain."""
    ids = labels.select(F.col(id_col).alias("id")).where("id IS NOT NULL").distinct()
    chosen = ids.orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(domain_col).cast("string").alias("domain"))
            .where(F.col("domain").isin(domains)).join(F.broadcast(chosen), "id")  # at most max_labelled ids
            .groupBy("id").agg(F.max(F.struct("text", "domain")).alias("d")).select("id", "d.*"))  # an id counts once

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in frames:
            c = [Counter(words(t)).most_common() for t in f.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [f.column("id"), f.column("domain"), pa.array([[{"w": w, "n": n} for w, n in x] for x in c],
                 pa.list_(pa.struct([("w", pa.binary()), ("n", pa.int64())])))], ["id", "domain", "c"])

    kind = rows.schema["id"].dataType.simpleString()
    counted = rows.select("id", "text", "domain").mapInArrow(count, f"id {kind}, domain string, c array<struct<w:binary, n:long>>")
    counted = stage(docs.sparkSession, counted, "mixing-sample")
    vocabulary = [bytes(r.w) for r in counted.select(F.explode("c").alias("e")).groupBy(F.col("e.w").alias("w"))
                  .agg(F.sum("e.n").alias("n")).orderBy(F.desc("n"), "w").limit(max_words).collect()]
    known = Classifier(vocabulary, np.zeros((len(vocabulary), len(domains))), np.zeros(len(domains)))
    x, ys = np.zeros((counted.count(), len(vocabulary)), np.float32), []
    for v, r in zip(x, counted.orderBy("id").toLocalIterator()):
        for e in r.c:
            i = known.code.get(bytes(e.w))
            if i is not None:
                v[i] = e.n
        size = np.linalg.norm(v)
        v /= size or 1
        ys.append(domains.index(r.domain))
    if not ys:
        return known
    return Classifier(vocabulary, *_fit(x, np.array(ys), len(domains)))


def memberships(docs: DataFrame, shared, k: int, text_col: str = "text") -> DataFrame:
    """``docs`` with n_tokens and p_0 .. p_(k-1)."""
    names = ["n_tokens", *(f"p_{i}" for i in range(k))]

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for f in frames:
            got = [model.posterior(t) for t in f.column(text_col).to_pylist()]
            p = np.array([g[1] for g in got]).reshape(len(got), k)
            yield pa.RecordBatch.from_arrays(
                [*f.columns, pa.array([g[0] for g in got], pa.int64()), *(pa.array(p[:, i], pa.float64()) for i in range(k))],
                [*f.schema.names, *names])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("n_tokens", T.LongType()),
                                              *(T.StructField(f"p_{i}", T.DoubleType()) for i in range(k))]))


def _after(steps: list[tuple[float, np.ndarray]], least: float = 0.0) -> Column:
    """(r, q) of a document after the steps: r <- max(least, q - p' y), q <- r + beta (r - old r)."""
    one = F.struct(F.lit(1.0).alias("r"), F.lit(1.0).alias("q"))
    if not steps:
        return one
    k = len(steps[0][1])
    todo = F.array(*[F.struct(F.lit(float(b)).alias("b"), F.array(*[F.lit(float(v)) for v in y]).alias("y")) for b, y in steps])

    def step(s: Column, x: Column) -> Column:
        r = F.greatest(F.lit(float(least)), s["q"] - sum((F.col(f"p_{i}") * x["y"][i] for i in range(k)), F.lit(0.0)))
        return F.struct(r.alias("r"), (r + x["b"] * (r - s["r"])).alias("q"))

    return F.aggregate(todo, one, step)


def rate(steps: list[tuple[float, np.ndarray]], least: float = 0.0) -> Column:
    """A document's rate after the given steps, from its p columns; ``least`` as they were fitted with."""
    return _after(steps, least)["r"]


def fit_rates(members: DataFrame, targets: np.ndarray, budget: float | None = None, *, least: float = 0.0,
              max_steps: int = STEPS, tolerance: float = TOLERANCE) -> tuple[list[tuple[float, np.ndarray]], np.ndarray]:
    """(steps, target tokens) that bring the expected domain tokens of ``members`` to their targets,
    with no rate below ``least`` (0 or 1).

    Without a ``budget`` no domain has to shrink, and with ``least`` no document: the total is the
    one at which the smallest rate of the unbounded solution is ``least``. If that is more than
    double (or no total, as some rates are never positive), the total is doubled until the bounded
    solution meets the targets; targets that none of them meets are approached from the total
    before the doublings.
    """
    k = len(targets)
    p = [F.col(f"p_{i}") for i in range(k)]
    n = F.col("n_tokens").cast("double")
    sums = members.agg(*(F.sum(n * p[i] * p[j]).alias(f"g_{i}_{j}") for i in range(k) for j in range(i, k)),
                       *(F.sum(n * p[i]).alias(f"a_{i}") for i in range(k))).first()
    start = np.array([sums[f"a_{i}"] or 0.0 for i in range(k)])
    gram = np.array([[sums[f"g_{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)])
    share, inverse = targets / targets.sum(), np.linalg.pinv(gram)

    def descend(total: float) -> tuple[list[tuple[float, np.ndarray]], bool]:
        """Steps towards a total, and whether they meet it."""
        goal, steps, t, now, look = share * total, [], 1.0, start, start
        near = lambda: np.abs(now - goal).max() <= tolerance * max(total, 1.0)
        while len(steps) < max_steps and not near():
            t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
            steps.append(((t - 1) / t_next, inverse @ (look - goal)))
            t = t_next
            state = members.select("n_tokens", *(f"p_{i}" for i in range(k)), _after(steps, least).alias("s"))
            got = state.agg(*(F.sum(F.col(f"s.{v}") * n * p[i]).alias(f"{v}_{i}") for v in "rq" for i in range(k))).first()
            now, look = (np.array([got[f"{v}_{i}"] or 0.0 for i in range(k)]) for v in "rq")
        return steps, bool(near())

    if budget is not None:
        return descend(float(budget))[0], share * float(budget)
    total = float((start[share > 0] / share[share > 0]).max(initial=0.0))
    if least > 0 and total > 0:
        # Unbounded rates are total * p' G^-1 share.
        y = inverse @ share
        low = members.agg(F.min(sum((p[i] * float(y[i]) for i in range(k)), F.lit(0.0))).alias("low")).first()["low"]
        if low > 0 and least / low <= 2 * total:
            total = max(total, least / low)
        else:
            for d in range(1, DOUBLINGS + 1):
                steps, met = descend(total * 2 ** d)
                if met:
                    return steps, share * (total * 2 ** d)
            if low > 0:
                total = max(total, least / low)
    return descend(total)[0], share * total


def mix(spark: SparkSession, docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, *,
        budget: float | None = None, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "lang") -> DataFrame:
    """``docs`` with n_tokens, p_0 .. p_(k-1) (domains in name order) and rate.

    Without a ``budget`` and with all targets above 0, no rate is below 1: every document is
    in the mixture, and the total is raised until the shares match. With a budget, or with
    a target of 0, rates go down to 0.

    Documents without words have no tokens: their p is the classifier's prior and their rate
    follows from it. Null texts count as empty. Targets are relative weights; a domain that
    no document belongs to cannot be met and is approached in the least-squares sense. Null
    or unlisted domains are not learnt from. Texts are read whole, repeated rows each have a
    rate, all other columns stay (none may be named n_tokens, rate or p_<i>); an empty table
    gives no rows.
    """
    targets = targets or TARGETS
    domains = sorted(targets)
    taken = {"n_tokens", "rate", *(f"p_{i}" for i in range(len(domains)))} & {c.lower() for c in docs.columns}
    if taken:
        raise ValueError(f"docs already has columns {sorted(taken)}")
    model = train(docs, labels, domains, id_col=id_col, text_col=text_col, domain_col=domain_col)
    shared = spark.sparkContext.broadcast(model)
    members = memberships(docs, shared, len(domains), text_col)
    narrow = stage(spark, memberships(docs.select(text_col), shared, len(domains), text_col).drop(text_col), "mixing-members")
    least = 1.0 if budget is None and min(targets.values()) > 0 else 0.0
    steps, _ = fit_rates(narrow, np.array([targets[d] for d in domains], float), budget, least=least)
    return members.withColumn("rate", rate(steps, least))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` to the default targets by language."""
    mixed = mix(spark, read(spark, sf_dir, "documents").select("doc_id", "text", "lang"), read(spark, sf_dir, "labels"))
    return mixed.select("doc_id", "n_tokens", *(F.col(f"p_{i}").alias(f"p_{d}") for i, d in enumerate(sorted(TARGETS))), "rate")


QUERIES = {"op7_mixing": op7_mixing}
ORACLES: dict[str, str] = {}
