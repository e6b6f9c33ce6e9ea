"""Toxicity scores from class-conditional Kneser-Ney models.

Two models, one of toxic and one of ordinary text, give each word after another one

    P_c(w | v) = max(n_c(v w) - D, 0) / n_c(v) + left_c(v) * P_c(w)
    P_c(w)     = (max(n_c(w) - D, 0) + D * types_c * S_c(w)) / tokens_c

where left_c(v) is the mass that the discount leaves, and S_c spells the word with
character 5-grams of the class, discounted and interpolated (Kneser-Ney) with orders 4 to
1, whose continuation counts both classes share. Rare and unseen expressions are thus
judged by their spelling. A document's evidence is the log-likelihood ratio of its words,
normalised by length: the mean over all words, over the words beyond two bounds, over the
most telling 3 and 10, and what the word before adds to the most telling 3 and 10. A
logistic curve, fitted on documents that the models did not learn from (two halves,
crosswise), turns it into a score.

Counts live in sorted arrays of 64-bit keys and are looked up for many words at once.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import fold, kept, mix64, read, stage, words

ORDER = 5
DISCOUNT = 0.75
#: Bounds of the sample of labelled rows that the models learn from, by class, and of its text.
MAX_TOXIC, MAX_ORDINARY, MAX_SAMPLE_BYTES = 3000, 5000, 256 << 20
#: Word pairs that occur less often in the sample are judged by their words alone.
MIN_PAIR = 2
THRESHOLD = 0.3
MEMO_WORDS = 200_000
#: Words of documents that are judged at once, and words that are spelled at once.
BATCH_WORDS, CHUNK_WORDS = 100_000, 10_000
BOUNDS = (2.0, 4.0)
TELLING = (3, 10)
_ODD = np.uint64(0x9E3779B97F4A7C15)
START, END = "\x02", "\x03"


def word_keys(ws: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in ws), np.uint64, len(ws))


def pair_keys(keys: np.ndarray) -> np.ndarray:
    """Key of each word and the one before it, from the second word on."""
    return mix64(keys[:-1] * _ODD + keys[1:])


class Table:
    """Numbers by 64-bit key; zeros for unknown keys."""

    def __init__(self, keys: np.ndarray, *columns: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys = np.append(keys[order], np.uint64(2 ** 64 - 1))
        self.columns = [np.append(c[order], 0).astype(float) for c in columns]

    def __call__(self, keys: np.ndarray) -> list[np.ndarray]:
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        return [np.where(hit, c[at], 0.0) for c in self.columns]


def _summed(keys: np.ndarray, *columns: np.ndarray) -> Table:
    """Table of the sums by key."""
    known, at = np.unique(keys, return_inverse=True)
    return Table(known, *(np.bincount(at, c, len(known)) for c in columns))


def spell(ws: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Character codes of all n-grams of the padded words (one per row), and their number by word."""
    text = [START * (order - 1) + w.decode("utf-8", "replace") + END for w in ws]
    codes = np.frombuffer("".join(text).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in text], np.int64)
    n_grams = sizes - order + 1
    shift = np.repeat((order - 1) * np.arange(len(ws)), n_grams)
    return np.lib.stride_tricks.sliding_window_view(codes, order)[np.arange(len(shift)) + shift], n_grams


def gram_keys(grams: np.ndarray) -> np.ndarray:
    """Key of each row of character codes, told apart by its length."""
    key = np.full(len(grams), grams.shape[1], np.uint64)
    for column in grams.T:
        key = key * _ODD + (column.astype(np.uint64) + np.uint64(1))
    return mix64(key)


def _distinct(grams: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the sums of their numbers (one row of ``n`` per class)."""
    _, first, at = np.unique(gram_keys(grams), return_index=True, return_inverse=True)
    return grams[first], np.stack([np.bincount(at, x, len(first)) for x in n])


class Model:
    """Log-likelihood ratio (toxic over ordinary) of words in their order, from counts of both classes.

    ``ws`` are words, ``n`` their counts (one row per class); ``pairs`` are word keys of the
    first word, pair keys and counts by class of the word pairs that are told apart.
    """

    def __init__(self, ws: list[bytes], n: np.ndarray, pairs: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None,
                 order: int = ORDER):
        self.order = order
        n = np.asarray(n, float)
        self.tokens, self.types = n.sum(1), (n > 0).sum(1)
        known = word_keys(ws)
        self.counts = Table(known, *n)
        grams, sums = np.zeros((0, order), np.uint32), np.zeros((2, 0))
        for i in range(0, len(ws), CHUNK_WORDS):
            more, n_grams = spell(ws[i:i + CHUNK_WORDS], order)
            more = _distinct(more, np.repeat(n[:, i:i + CHUNK_WORDS], n_grams, axis=1))
            grams, sums = _distinct(np.concatenate((grams, more[0])), np.concatenate((sums, more[1]), axis=1))
        self.grams = Table(gram_keys(grams), *sums)
        self.after = _summed(gram_keys(grams[:, :-1]), *sums, *(sums > 0))
        # Continuation counts of the lower orders, pooled over both classes.
        self.shared, self.shared_after = {}, {}
        for k in range(order - 1, 0, -1):
            grams, (n_before,) = _distinct(grams[:, 1:], np.ones((1, len(grams))))
            self.shared[k] = Table(gram_keys(grams), n_before)
            self.shared_after[k] = _summed(gram_keys(grams[:, :-1]), n_before, np.ones(len(grams)))
        self.floor = 1.0 / (len(grams) + 1)
        first_word, pair, by_class = pairs if pairs is not None else (np.zeros(0, np.uint64),) * 2 + (np.zeros((2, 0)),)
        self.pairs = Table(pair, *by_class)
        self.taken = _summed(first_word, *np.maximum(np.asarray(by_class, float) - DISCOUNT, 0))
        self.memo: dict[bytes, int] = {}
        self.memo_keys, self.memo_logs = np.zeros(0, np.uint64), np.zeros((0, 2))

    def log_grams(self, grams: np.ndarray) -> np.ndarray:
        """Log-probability by class of the last character of each gram after its others."""
        low = np.full(len(grams), self.floor)
        for k in range(1, self.order):
            end = grams[:, self.order - k:]
            (total, kinds), (n,) = self.shared_after[k](gram_keys(end[:, :-1])), self.shared[k](gram_keys(end))
            low = np.where(total > 0, (np.maximum(n - DISCOUNT, 0) + DISCOUNT * kinds * low) / np.maximum(total, 1), low)
        n, context = self.grams(gram_keys(grams)), self.after(gram_keys(grams[:, :-1]))
        out = []
        for c in (0, 1):
            total, kinds = context[c], context[2 + c]
            out.append(np.log(np.where(total > 0, (np.maximum(n[c] - DISCOUNT, 0) + DISCOUNT * kinds * low)
                                       / np.maximum(total, 1), low)))
        return np.stack(out, 1)

    def log_words(self, ws: list[bytes]) -> np.ndarray:
        """Log-probability of each word by class (0 ordinary, 1 toxic)."""
        out = np.zeros((len(ws), 2))
        for i in range(0, len(ws), CHUNK_WORDS):
            part = ws[i:i + CHUNK_WORDS]
            grams, n_grams = spell(part, self.order)
            _, first, at = np.unique(gram_keys(grams), return_index=True, return_inverse=True)
            logs = self.log_grams(grams[first])[at]
            spelled = np.log(DISCOUNT * self.types) + np.add.reduceat(logs, np.cumsum(n_grams) - n_grams, axis=0)
            n = np.stack(self.counts(word_keys(part)), 1)
            with np.errstate(divide="ignore"):
                out[i:i + CHUNK_WORDS] = np.logaddexp(np.log(np.maximum(n - DISCOUNT, 0)), spelled) - np.log(self.tokens)
        return out

    def _numbered(self, ws: list[bytes]) -> np.ndarray:
        """Places of the words in the memo, which takes in those it lacks and starts anew when it is full."""
        if len(self.memo) > MEMO_WORDS:
            self.memo, self.memo_keys, self.memo_logs = {}, np.zeros(0, np.uint64), np.zeros((0, 2))
        new = [w for w in dict.fromkeys(ws) if w not in self.memo]
        if new:
            self.memo.update(zip(new, range(len(self.memo), len(self.memo) + len(new))))
            self.memo_keys = np.concatenate((self.memo_keys, word_keys(new)))
            self.memo_logs = np.concatenate((self.memo_logs, self.log_words(new)))
        return np.fromiter(map(self.memo.__getitem__, ws), np.int64, len(ws))

    def ratios(self, ws: list[bytes], starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood ratio of each word, and of each after the one before it; ``starts`` are places without one."""
        at = self._numbered(ws)
        keys, logs = self.memo_keys[at], self.memo_logs[at]
        before = self.counts(keys[:-1])
        n, taken = self.pairs(pair_keys(keys)), self.taken(keys[:-1])
        out = []
        for c in (0, 1):
            total = np.maximum(before[c], 1)
            left = np.maximum(1 - taken[c] / total, 1e-9)
            after = np.log(np.maximum(n[c] - DISCOUNT, 0) / total + left * np.exp(logs[1:, c]))
            after = np.where(before[c] > 0, after, logs[1:, c])
            out.append(np.concatenate((logs[:1, c], after)))
            out[c][starts] = logs[starts, c]
        return logs[:, 1] - logs[:, 0], out[1] - out[0]

    def evidence(self, texts: list[str | None]) -> np.ndarray:
        """Length-normalised evidence of whole texts; zeros for a text without words."""
        out = np.zeros((len(texts), N_EVIDENCE))
        held: list[tuple[int, list[bytes]]] = []
        size = 0
        for i, text in enumerate(texts):
            w = words(text)
            if w:
                held.append((i, w))
                size += len(w)
            if held and (size >= BATCH_WORDS or i + 1 == len(texts)):
                self._judge(held, out)
                held, size = [], 0
        if held:
            self._judge(held, out)
        return out

    def _judge(self, held: list[tuple[int, list[bytes]]], out: np.ndarray) -> None:
        ends = np.cumsum([len(w) for _, w in held])
        starts = np.concatenate(([0], ends[:-1]))
        alone, after = self.ratios([x for _, w in held for x in w], starts)
        for (i, _), a, b in zip(held, starts, ends):
            r = alone[a:b]
            out[i] = (r.mean(), *(r[r > bound].sum() / len(r) for bound in BOUNDS), *_telling(r), math.log1p(len(r)),
                      *_telling(after[a:b] - r))


N_EVIDENCE = 2 + len(BOUNDS) + 2 * len(TELLING)


def _telling(r: np.ndarray) -> list[float]:
    """Sums of the greatest values, over their number; missing ones are zeros."""
    top = np.sort(np.partition(r, -min(len(r), TELLING[-1]))[-TELLING[-1]:])[::-1]
    return [float(top[:k].sum()) / k for k in TELLING]


class Counts:
    """Word and word-pair counts of a sample by class and half, in arrays; bounded by the sample."""

    def __init__(self, ws: list[bytes], n: np.ndarray, first: np.ndarray, pair: np.ndarray, n_pair: np.ndarray):
        # Words hold no spaces.
        self.words, self.n, self.first, self.pair, self.n_pair = b" ".join(ws), n, first, pair, n_pair
        self.print = zlib.crc32(n.tobytes(), zlib.crc32(self.words, zlib.crc32(n_pair.tobytes())))

    def has(self, halves: tuple[int, ...]) -> bool:
        """Whether both classes have words in these halves."""
        return bool((self.n[:, halves].sum((1, 2)) > 0).all()) if self.n.size else False

    def model(self, halves: tuple[int, ...]) -> Model:
        ws, n, n_pair = self.words.split(b" ") if self.words else [], self.n[:, halves].sum(1), self.n_pair[:, halves].sum(1)
        there, often = n.sum(0) > 0, n_pair.sum(0) >= MIN_PAIR
        return Model([w for w, t in zip(ws, there) if t], n[:, there], (self.first[often], self.pair[often], n_pair[:, often]))


def _worker_model(shared, halves: tuple[int, ...]) -> Model:
    counts = shared.value
    return kept(("toxicity", counts.print, halves), lambda: counts.model(halves))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted logistic regression: (means, scales, coefficients with the constant last)."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (weight * (p - y)) + penalty * w
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
    return mean, scale, w


def training_rows(docs: DataFrame, labels: DataFrame, keep, *, id_col: str, text_col: str, max_toxic: int,
                  max_ordinary: int, max_bytes: int = MAX_SAMPLE_BYTES) -> DataFrame:
    """Bounded sample of labelled documents: text, y, half, weight (rows of the class per sampled row).

    An id gives one row, with the greatest of its texts. Ids are taken in the order of a hash,
    up to the bound of their class and as long as the texts of a class fill half of ``max_bytes``.
    """
    marks = (labels.where(F.col("toxic").isin(0, 1) & keep(F.col(id_col)))
             .groupBy(F.col(id_col).alias("id")).agg(F.max("toxic").alias("y")))
    sizes = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for y, most in ((1, max_toxic), (0, max_ordinary)):
        part = marks.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = stage(docs.sparkSession, docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                 .join(F.broadcast(chosen), "id")  # at most max_toxic + max_ordinary rows
                 .groupBy("id", "y").agg(F.max("text").alias("text")), "toxicity-found")
    before = Window.partitionBy("y").orderBy(F.xxhash64("id"), "id")  # ids and sizes, within the same bound
    within = (rows.select("id", "y", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
              .withColumn("filled", F.sum("size").over(before)).where(F.col("filled") <= max_bytes // 2)
              .withColumn("taken", F.count(F.lit(1)).over(Window.partitionBy("y"))))
    of_class = F.when(F.col("y") == 1, sizes.get(1, 0)).otherwise(sizes.get(0, 0))
    half = F.pmod(F.xxhash64("id", F.lit("half")), F.lit(2)).cast("int")
    return (rows.join(F.broadcast(within.select("id", "taken")), "id")
            .select("text", "y", (of_class / F.col("taken")).cast("double").alias("weight"), half.alias("half")))


def _counts(sample: DataFrame) -> Counts:
    """Counts of the whole sample. Each task adds up its own before anything moves."""
    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Counter] = defaultdict(Counter)
        pairs: dict[int, list[np.ndarray]] = defaultdict(list)
        for f in frames:
            for text, y, half in zip(*(f.column(c).to_pylist() for c in ("text", "y", "half"))):
                w = words(text)
                seen[2 * y + half].update(w)
                if len(w) > 1:
                    keys = word_keys(w)
                    pairs[2 * y + half].append(np.stack((keys[:-1], pair_keys(keys))))
        for k, c in seen.items():
            yield _count_rows(k, pa.array(list(c), pa.binary()), None, np.fromiter(c.values(), np.int64, len(c)))
        for k, parts in pairs.items():
            both = np.concatenate(parts, axis=1)
            key, at, n = np.unique(both[1], return_index=True, return_counts=True)
            yield _count_rows(k, None, (both[0][at], key), n)

    sums = (sample.select("text", "y", "half").mapInArrow(count, "part int, word binary, first long, pair long, n long")
            .groupBy("word", "first", "pair")
            .agg(*(F.coalesce(F.sum(F.when(F.col("part") == k, F.col("n"))), F.lit(0)).alias(f"n{k}") for k in range(4)))
            .where(F.col("word").isNotNull() | (F.col("n0") + F.col("n1") + F.col("n2") + F.col("n3") >= MIN_PAIR)))
    numbers = [F.col(f"n{k}").cast("int").alias(f"n{k}") for k in range(4)]
    sums = stage(sample.sparkSession, sums, "toxicity-counts")
    of = lambda t: np.stack([t.column(f"n{k}").to_numpy() for k in range(4)]).reshape(2, 2, -1)
    # In a fixed order, so that every worker and every run builds the same model.
    word = sums.where("word IS NOT NULL").select("word", *numbers).orderBy("word").toArrow()
    pair = sums.where("word IS NULL").select("first", "pair", *numbers).orderBy("pair").toArrow()
    keys = [pair.column(c).to_numpy().view(np.uint64) for c in ("first", "pair")]
    return Counts(word.column("word").to_pylist(), of(word), *keys, of(pair))


def _count_rows(part: int, word: pa.Array | None, pair: tuple[np.ndarray, np.ndarray] | None, n: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(n), pa.int64())
    first, key = (pa.array(k.view(np.int64)) for k in pair) if pair else (none, none)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(n), part), pa.int32()), pa.nulls(len(n), pa.binary()) if word is None else word, first, key,
         pa.array(n, pa.int64())], ["part", "word", "first", "pair", "n"])


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, keep, *, id_col: str = "doc_id",
          text_col: str = "text", max_toxic: int = MAX_TOXIC, max_ordinary: int = MAX_ORDINARY,
          max_bytes: int = MAX_SAMPLE_BYTES):
    """(broadcast counts, logistic curve), or (None, share of toxic rows) if a class has no words.

    Null and repeated rows, labels and empty tables: as ``toxicity`` says.
    """
    sample = stage(spark, training_rows(docs, labels, keep, id_col=id_col, text_col=text_col, max_toxic=max_toxic,
                                        max_ordinary=max_ordinary, max_bytes=max_bytes).repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions"))), "toxicity-sample")
    counts = _counts(sample)
    if not counts.has((0, 1)):
        share = sample.agg(F.avg("y").alias("p")).first()["p"]
        return None, float(share or 0.0)
    shared = spark.sparkContext.broadcast(counts)
    apart = counts.has((0,)) and counts.has((1,))  # else too few labels to hold any back
    # One half after the other: a worker never holds two models.
    rows: list[tuple] = []
    for h in (0, 1):
        learnt = (1 - h,) if apart else (0, 1)

        def look(frames: Iterator[pa.RecordBatch], learnt=learnt) -> Iterator[pa.RecordBatch]:
            for f in frames:
                x = _worker_model(shared, learnt).evidence(f.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.float64())), f.column("y"), f.column("weight")],
                                                 ["x", "y", "weight"])

        part = sample.where(F.col("half") == h).select("text", F.col("y").cast("int").alias("y"), "weight")
        rows += [(r.y, tuple(r.x), r.weight) for r in part.mapInArrow(look, "x array<double>, y int, weight double").collect()]
    rows.sort()  # bounded by the sample
    y, x, weight = (np.array(c, float) for c in zip(*rows))
    return shared, fit_logistic(x, y, weight)


def score(docs: DataFrame, model, curve, *, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score (0 to 1, higher: likelier toxic), which must have a name of its own.

    Null and empty texts, and texts without words, get the score of no evidence; every row gets one.
    """
    if score_col in docs.columns:
        raise ValueError(f"docs already has a column {score_col}")
    if model is None:
        return docs.withColumn(score_col, F.lit(float(curve)))
    mean, scale, coef = curve

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in frames:
            x = _worker_model(model, (0, 1)).evidence(f.column(text_col).to_pylist())
            z = np.c_[(x - mean) / scale, np.ones(len(x))] @ coef
            yield pa.RecordBatch.from_arrays(
                [*f.columns, pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())], [*f.schema.names, score_col])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())]))


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, keep=None, *, id_col: str = "doc_id",
             text_col: str = "text", max_toxic: int = MAX_TOXIC, max_ordinary: int = MAX_ORDINARY) -> DataFrame:
    """doc_id and score of every row of ``docs``.

    ``keep`` selects the ids whose labels may be learnt from. Labels that are null or
    neither 0 nor 1, and labels of unknown documents, are not used; an id with both
    labels counts as toxic. Null and empty texts, and texts without words, get the score
    of no evidence. Texts are scored whole, whatever their length. Rows that repeat an id
    each get a row. If either class has no words to learn from, every score is the share
    of toxic rows in the sample (0 without labels). Other columns are not read.
    """
    keep = keep or (lambda c: F.lit(True))
    model, curve = train(spark, docs, labels, keep, id_col=id_col, text_col=text_col,
                         max_toxic=max_toxic, max_ordinary=max_ordinary)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return score(rows, model, curve, text_col="text").select("doc_id", "score")


def learnable(doc_id):
    """Ids whose labels op5 may learn from."""
    return fold(doc_id, 4) != 2


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``, learning from the labels of three folds of four."""
    scored = toxicity(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), learnable)
    return scored.select("doc_id", (~learnable(F.col("doc_id"))).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op5_toxicity": op5_toxicity}
ORACLES: dict[str, str] = {}
