"""Language-model scores of whole documents.

Every training document is counted. Word counts give the base score (additive
smoothing), the classes of the recurrent model's factored softmax and the fixed
inner distributions of its tail classes. The recurrent model (``gru``) starts
at the unigram distribution and learns in rounds. A round's replicas start from
the last round's averages, each trains by truncated backpropagation on its share
of the round's documents, and weights and step sizes are averaged by tokens. Ids
and texts alone say which replica of which round has a document, and the number
of tokens how many there are: both grow with the root of the corpus, and the
layout of the files has no part in it. A document is scored whole: the
state is carried through all its windows.

Counts of the frequent words are broadcast (bounded number); the counts of all
other words are joined to the documents that use them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import gru
from tessera.llm.common import fold, read, stage
from tessera.session import scratch_path

#: Bound of the words whose counts are broadcast.
FREQUENT = 1 << 18
HIDDEN = 32
#: Texts side by side, at least and at most, and tokens of each between two updates.
LEAST_LANES, LANES, STEPS = 64, 512, 8
#: Training tokens of a replica for each lane: a smaller share has fewer lanes, not fewer updates.
LANE_TOKENS = 3500
#: With the most lanes; it falls with the root of their number.
LEARNING_RATE = 0.2
#: Tokens that one training step of a task holds.
TRAIN_TOKENS = 500_000
#: Bytes of text that a task counts, codes or scores at once, about; rows count as a few more.
COUNT_BYTES, CODE_BYTES, SCORE_BYTES, ROW_BYTES = 24_000_000, 8_000_000, 10_000_000, 8
#: Training tokens of one replica in one round, about.
TURN_TOKENS = 2_000_000
#: Floats of a block when replicas are averaged.
BLOCK = 1 << 14
END = b""


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``tokens`` of all texts, one after the other, and the number of each text's."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = split.flatten().cast(pa.binary())
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(split).fill_null(0).to_numpy())
    full = pc.greater(pc.binary_length(words), 0)  # white space at the ends gives empty words
    return words.filter(full), np.bincount(owner[full.to_numpy(zero_copy_only=False)], minlength=len(texts))


def pieces(frames: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text; a longer text is a batch with what came before it."""
    held, n = [], 0
    for f in frames:
        ends = np.cumsum(pc.binary_length(f.column("text")).to_numpy(zero_copy_only=False).astype(np.int64) + ROW_BYTES)
        at, past = 0, 0
        while at < f.num_rows:
            to = min(int(np.searchsorted(ends, past + size - n)) + 1, f.num_rows)
            held.append(f.slice(at, to - at))
            n, at, past = n + int(ends[to - 1]) - past, to, int(ends[to - 1])
            if n >= size:
                yield pa.concat_batches(held)
                held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def _count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for f in pieces(frames, COUNT_BYTES):
        found = split_words(f.column("text"))[0].value_counts()
        yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([f.num_rows], pa.int64())], ["word", "n"])


class Tables:
    """What scoring needs of the corpus; made on the driver from at most FREQUENT words."""

    def __init__(self, words: list[bytes], counts: list[int], total: int, types: int, rare_mass: float):
        self.words, self.total, self.types = words, total, types
        self.counts = np.array(counts, float)
        self.layout = gru.Layout(self.counts, rare_mass)
        self.rare_mass = rare_mass
        self.z = total + 0.5 * (types + 1)  # of the base score

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / self.z)


class Coder:
    """Words to codes by falling count; one past the last for every other word."""

    def __init__(self, t: Tables):
        self.words, self.other = pa.array(t.words, pa.binary()), len(t.words)
        self.end = t.words.index(END) if END in t.words else self.other

    def documents(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Codes of all texts, each with its end; where each text's codes start, and the last one's end; the
        words with the code of other words, ends too, in the same order."""
        words, n = split_words(texts)
        inner = pc.index_in(words, value_set=self.words).fill_null(self.other).to_numpy()
        starts = np.concatenate(([0], np.cumsum(n + 1)))
        codes, end = np.full(starts[-1], self.end, np.int32), np.zeros(starts[-1], bool)
        end[starts[1:] - 1] = True
        codes[~end] = inner
        others = words.filter(pa.array(inner == self.other))
        if self.end == self.other:
            at = np.where(end, len(words), np.cumsum(~end) - 1)[codes == self.other]
            others = pa.concat_arrays([words, pa.array([END], pa.binary())]).take(pa.array(at))
        return codes, starts, others


def corpus_tables(counts: DataFrame, frequent: int = FREQUENT) -> tuple[Tables, int]:
    """(tables, least count of a broadcast word) from the staged counts (word, c) of all training documents."""
    # A threshold from a histogram of some thousand bins, so that no sort meets in one task.
    bins = (counts.groupBy(F.floor(F.log2("c") * 64).alias("k"))
            .agg(F.count(F.lit(1)).alias("words"), F.sum("c").alias("tokens"), F.min("c").alias("least"))
            .orderBy(F.desc("k")).collect())
    least, held = 1 << 62, 0
    for b in bins:
        if held + b.words > frequent:
            break
        held, least = held + b.words, b.least
    total, types = sum(b.tokens for b in bins), sum(b.words for b in bins)
    top = counts.where(F.col("c") >= least).select("word", "c").toArrow()
    pairs = sorted(zip(top.column("word").to_pylist(), top.column("c").to_pylist()), key=lambda p: (-p[1], p[0]))
    known = sum(c for _, c in pairs)
    rare_mass = (total - known) + 0.5 * (types - len(pairs)) + 0.5  # and one type for unknown words
    return Tables([w for w, _ in pairs], [c for _, c in pairs], total, types, rare_mass), least


def schedule(total: int, turn_tokens: int) -> tuple[int, int]:
    """(rounds, replicas of a round) for so many training tokens."""
    turns = max(1, -(-total // turn_tokens))
    rounds = math.ceil(math.sqrt(turns))
    return rounds, -(-turns // rounds)


def updates(share: int) -> tuple[int, float]:
    """(lanes, learning rate) of a replica that learns from about so many tokens."""
    width = min(LANES, max(LEAST_LANES, share // LANE_TOKENS))
    return width, LEARNING_RATE * math.sqrt(width / LANES)


def coded_turns(spark: SparkSession, rows: DataFrame, tables, rounds: int, replicas: int) -> DataFrame:
    """Every row of ``rows`` (doc_id, text) once, staged by round: replica, place, codes."""
    def code(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(tables.value)
        for f in pieces(frames, CODE_BYTES):
            codes, starts, _ = coder.documents(f.column("text"))
            offsets = pa.array(starts * codes.itemsize, pa.int32())
            packed = pa.Array.from_buffers(pa.binary(), f.num_rows, [None, offsets.buffers()[1], pa.py_buffer(codes)])
            yield pa.RecordBatch.from_arrays([f.column("round"), f.column("replica"), f.column("place"), packed],
                                             ["round", "replica", "place", "codes"])

    turn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds * replicas))
    dealt = rows.select("text", F.xxhash64("text", "doc_id").alias("place"), (turn % rounds).cast("int").alias("round"),
                        F.floor(turn / rounds).cast("int").alias("replica"))
    path = scratch_path(spark, "lm-turns")
    kind = "round int, replica int, place long, codes binary"
    dealt.mapInArrow(code, kind).write.partitionBy("round").parquet(path)
    return spark.read.schema(kind).parquet(path)


def train_model(turns: DataFrame, tables, rounds: int, replicas: int, hidden: int = HIDDEN) -> tuple[np.ndarray | None, int]:
    """(weights after all rounds, tokens learnt from); None without tokens."""
    spark = turns.sparkSession
    state, learnt = None, 0
    width, rate = updates(tables.value.total // (rounds * replicas))

    def blocks(replica: int, model: gru.Gru, past: dict, seen: int) -> pa.RecordBatch:
        flat = np.concatenate((gru.pack(model.w), gru.pack(past)))
        rows = [(k, replica, seen, flat[at:at + BLOCK].tobytes()) for k, at in enumerate(range(0, len(flat), BLOCK))]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.binary()))],
            ["block", "replica", "n", "w"])

    def mean(table: pa.Table) -> pa.Table:
        n, total = 0, 0.0
        for own, w in zip(*(table.sort_by("replica").column(c).to_pylist() for c in ("n", "w"))):
            n, total = n + own, total + own * np.frombuffer(w, np.float32).astype(np.float64)
        return pa.table({"block": table.column("block").slice(0, 1), "n": pa.array([n], pa.int64()),
                         "w": pa.array([(total / n).astype(np.float32).tobytes()], pa.binary())})

    for r in range(rounds):
        shared = spark.sparkContext.broadcast(state)

        def replica(frames: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            layout = tables.value.layout
            own, model, past, held, size, seen = None, None, None, [], 0, 0

            def step() -> None:
                nonlocal held, size, seen
                model.train(held, past, rate, width, STEPS)
                held, size, seen = [], 0, seen + size

            for f in frames:
                for k, codes in zip(f.column("replica").to_pylist(), f.column("codes").to_pylist()):
                    if k != own:  # rows come by replica
                        if held:
                            step()
                        if own is not None:
                            yield blocks(own, model, past, seen)
                        if shared.value is None:
                            w = gru.initial(layout, hidden)
                            past = {name: np.full(v.shape, 1e-6, np.float32) for name, v in w.items()}
                        else:
                            w, past = (gru.unpack(v, layout, hidden) for v in np.split(shared.value, 2))
                        own, model, seen = k, gru.Gru(layout, w), 0
                    held.append(np.frombuffer(codes, np.int32))
                    size += len(held[-1])
                    if size >= TRAIN_TOKENS:
                        step()
            if held:
                step()
            if own is not None:
                yield blocks(own, model, past, seen)

        dealt = (turns.where(F.col("round") == r).select("replica", "place", "codes")
                 .repartitionById(replicas, "replica").sortWithinPartitions("replica", "place", "codes"))
        parts = dealt.mapInArrow(replica, "block int, replica int, n long, w binary")
        got = parts.groupBy("block").applyInArrow(mean, "block int, n long, w binary").toArrow().sort_by("block")
        if got.num_rows:  # one model's size; a round may have no documents
            state = np.concatenate([np.frombuffer(b, np.float32) for b in got.column("w").to_pylist()])
            learnt += got.column("n")[0].as_py()
        shared.unpersist()
    return None if state is None else np.split(state, 2)[0], learnt


def lm_scores(docs: DataFrame, learn, *, id_col: str = "doc_id", text_col: str = "text", hidden: int = HIDDEN,
              frequent: int = FREQUENT, turn_tokens: int = TURN_TOKENS) -> DataFrame:
    """One row per row of ``docs``: doc_id, learnt, n_tokens, n_known, train_tokens, base_score, score.

    ``learn`` gives, for an id column, which documents the counts and the model learn from.
    Scores are log10 probabilities of the whole text with its end token; ``base_score`` is the
    sum of log10((c + 0.5) / (N + 0.5 (V + 1))), ``score`` the recurrent model's. The model gives
    every word a share by its class, all unknown words together that of one unseen type. A null
    text counts as empty: its only token is the end. The model does not depend on the order
    or the partitions of the rows. Repeated rows each count and each get a row.
    Null ids are folded as the empty text. Other columns are not read. Without training documents
    all counts are 0 and both scores are those of the one unknown type; empty tables give no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       learn(F.col(id_col)).alias("learnt"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = stage(spark, rows.where("learnt").select("text").mapInArrow(_count, "word binary, n long")
                   .groupBy("word").agg(F.sum("n").alias("c")), "lm-counts")
    made, least = corpus_tables(counts, frequent)
    tables = spark.sparkContext.broadcast(made)
    rounds, replicas = schedule(made.total, turn_tokens)
    turns = coded_turns(spark, rows.where("learnt").select("doc_id", "text"), tables, rounds, replicas)
    flat, _ = train_model(turns, tables, rounds, replicas, hidden)
    weights = spark.sparkContext.broadcast(flat)

    def score(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables.value
        coder = Coder(t)
        start = gru.initial(t.layout, hidden) if weights.value is None else gru.unpack(weights.value, t.layout, hidden)
        model = gru.Gru(t.layout, start)
        known = np.append(t.base(t.counts), 0.0)
        for f in pieces(frames, SCORE_BYTES):
            codes, starts, others = coder.documents(f.column("text"))
            n = np.diff(starts)
            owner = np.repeat(np.arange(len(n)), n)
            lp = model.score(np.split(codes, starts[1:-1])) / math.log(10)
            # The other words of each document with their numbers.
            found = others.dictionary_encode()
            pair, times = np.unique(owner[codes == coder.other] * len(others) + found.indices.to_numpy(), return_counts=True)
            whose, which = np.divmod(pair, max(1, len(others)))
            rare = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(whose, np.arange(len(n) + 1)), pa.int32()),
                pa.StructArray.from_arrays([found.dictionary.take(pa.array(which)), pa.array(times, pa.int64())], ["word", "n"]))
            yield pa.RecordBatch.from_arrays([
                f.column("k"), f.column("doc_id"), f.column("learnt"), pa.array(n, pa.int64()),
                pa.array(np.bincount(owner[codes < coder.other], minlength=len(n)), pa.int64()),
                pa.array(np.bincount(owner, known[codes], len(n)), pa.float64()), pa.array(lp, pa.float64()), rare],
                ["k", "doc_id", "learnt", "n_tokens", "known", "base", "lp", "rare"])

    scored = stage(spark, rows.withColumn("k", F.monotonically_increasing_id()).mapInArrow(
        score, f"k long, doc_id {kind}, learnt boolean, n_tokens long, known long, base double, lp double, "
               "rare array<struct<word:binary, n:long>>"), "lm-scored")
    # The words that were not broadcast: exact counts by a join. Sums of counts, by document.
    c = F.coalesce(F.col("c"), F.lit(0))
    rare = (scored.select("k", F.explode("rare").alias("r")).select("k", "r.word", "r.n")
            .join(counts.where(F.col("c") < least), "word", "left")
            .groupBy("k").agg(F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("rare_known"),
                              F.sum(F.col("n") * F.log10((c + 0.5) / F.lit(made.z))).alias("rare_base"),
                              F.sum(F.col("n") * F.log10((c + 0.5) / F.lit(made.rare_mass))).alias("rare_lp")))
    or0 = lambda name, zero: F.coalesce(F.col(name), F.lit(zero))
    return scored.join(rare, "k", "left").select(
        "doc_id", "learnt", "n_tokens", (F.col("known") + or0("rare_known", 0)).cast("long").alias("n_known"),
        F.lit(made.total).cast("long").alias("train_tokens"),
        (F.col("base") + or0("rare_base", 0.0)).alias("base_score"), (F.col("lp") + or0("rare_lp", 0.0)).alias("score"))


def learnable(doc_id):
    """Ids that op8 learns from."""
    return fold(doc_id, 5) != 1


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``, learning from four folds of five."""
    return lm_scores(read(spark, sf_dir, "documents"), learnable).select(
        "doc_id", (~F.col("learnt")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op8_lm_score": op8_lm_score}
ORACLES: dict[str, str] = {}
