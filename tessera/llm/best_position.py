"""Ranked lexical search by the Best Position Algorithm.

One task holds the postings of its documents in blocks. A block has for each query term an
impact list (documents by falling impact) and a direct access from (term, document) to the
impact and to the place in that list. A query reads its lists from the top, scores each new
document in full by direct accesses, and marks the places of all its entries as seen. The
best position of a list is the end of its gapless run of seen places, which direct accesses
push beyond what was read; no unseen document can score more than the weighted sum of the
impacts there. Reading stops once that sum is strictly below the k-th best score so far,
which a task carries from block to block. Ranks over all tasks follow from their best rows.

Impacts and weights are integers, so scores are exact and equal at any layout of the table.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.common import WORD_BYTES, read, stage

#: Text of the query items handled in one pass over the documents, and postings of one block of an index.
ITEM_BYTES, BLOCK_POSTINGS = 4 << 20, 2_000_000
#: Bytes of a document that are split into words at once.
PIECE = 1 << 20
#: First number of places read from each list; each further round reads twice as many.
FIRST_READ = 16
#: Parts of an item's candidate rows that are ranked by themselves before the last ranking.
PARTS = 64


def term_counts(text: str | None, number: dict[bytes, int]) -> tuple[int, Counter]:
    """Words of a whole text, and how often each numbered word occurs in it."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES)
    n, found, at = 0, Counter(), 0
    while at < len(data):
        cut = len(data) if len(data) - at <= PIECE else data.find(b" ", at + PIECE)
        cut = len(data) if cut < 0 else cut
        w = data[at:cut].split()
        n += len(w)
        found.update(map(number.get, w))
        at = cut
    found.pop(None, None)
    return n, found


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass
class Corpus:
    """Figures over all documents: those with a word, their words, and documents per term."""
    n_docs: int
    n_words: int
    df: np.ndarray

    def weights(self) -> np.ndarray:
        return np.array([term_weight(self.n_docs, int(d)) if d else 0 for d in self.df], np.int64)

    def impacts(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 100 - 25 + (25 * n * self.n_docs) // max(1, self.n_words)
        return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Block:
    """Impact lists and direct accesses over some documents, numbered in the order of their ids."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int):
        by_impact = np.lexsort((doc, -impact, term))
        self.n_docs = n_docs
        self.doc, self.impact = doc[by_impact], impact[by_impact]
        self.ends = np.searchsorted(term[by_impact], np.arange(n_terms), "right")
        self.starts = np.concatenate(([0], self.ends[:-1]))
        key = term[by_impact].astype(np.int64) * n_docs + self.doc
        self.place = np.argsort(key, kind="stable")
        self.key = key[self.place]
        self.seen = np.zeros(len(key), bool)

    def direct(self, terms: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Impacts (0 if the document lacks the term), and places in the lists (-1), terms by documents."""
        want = terms[:, None].astype(np.int64) * self.n_docs + docs[None, :]
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        hit = self.key[at] == want
        place = np.where(hit, self.place[at], -1)
        return np.where(hit, self.impact[place], 0), place

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores) that may be among the k best, and the entries read from the lists.

        ``floor`` is the k-th best score known from elsewhere. Of documents below both it and
        the k-th score here none are returned; equal scores are.
        """
        there = self.ends[terms] > self.starts[terms]
        terms, weights = terms[there], weights[there]
        first, end = self.starts[terms], self.ends[terms]
        best = first.copy()
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        known, touched, depth, step, n_read = np.zeros(self.n_docs, bool), [], 0, FIRST_READ, 0
        while len(terms) and (best < end).any():
            at = first[:, None] + np.arange(depth, depth + step)[None, :]
            at = at[at < end[:, None]]
            n_read += len(at)
            new = np.unique(self.doc[at])
            new = new[~known[new]]
            known[new] = True
            if len(new):
                impact, place = self.direct(terms, new)
                place = place[place >= 0]
                self.seen[place] = True
                touched.append(place)
                docs, scores = np.concatenate((docs, new)), np.concatenate((scores, weights @ impact))
                if len(docs) > 4 * k:
                    kept = scores >= np.partition(scores, -k)[-k]
                    docs, scores = docs[kept], scores[kept]
            depth, step = depth + step, 2 * step
            for i in range(len(terms)):
                while best[i] < end[i]:
                    ahead = self.seen[best[i]:min(end[i], best[i] + 4096)]
                    gap = int(ahead.argmin())
                    if not ahead[gap]:
                        best[i] += gap
                        break
                    best[i] += len(ahead)
            # A list that is seen to its end gives an unseen document nothing.
            bound = int((weights * np.where(best < end, self.impact[np.maximum(best - 1, first)], 0)).sum())
            kth = int(np.partition(scores, -k)[-k]) if len(scores) >= k else 0
            if bound < max(kth, floor):
                break
        for place in touched:
            self.seen[place] = False
        good = scores > 0
        docs, scores = docs[good], scores[good]
        least = max(int(np.partition(scores, -k)[-k]) if len(scores) >= k else 0, floor)
        return docs[scores >= least], scores[scores >= least], n_read


def _blocks(frames: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[pa.RecordBatch]]:
    """Rows of ``postings`` in groups of at most ``limit`` postings (one document at least)."""
    held, size = [], 0
    for f in frames:
        counts = np.diff(f.column("terms").offsets.to_numpy())
        at = 0
        while at < f.num_rows:
            room = max(1, int(np.searchsorted(np.cumsum(counts[at:]), limit - size, "right")))
            part = f.slice(at, room)
            held.append(part)
            size += int(counts[at:at + room].sum())
            at += part.num_rows
            if size >= limit:
                yield held
                held, size = [], 0
    if held:
        yield held


def postings(docs: DataFrame, number: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """One row per document: doc_id, n (all its words), terms and tfs (of the numbered words it holds)."""
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for f in frames:
            ns, terms, tfs = [], [], []
            for text in f.column(1):
                n, found = term_counts(text.as_py(), number)
                ns.append(n)
                terms.append(list(found))
                tfs.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [f.column(0), pa.array(ns, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                ["doc_id", "n", "terms", "tfs"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
            .mapInArrow(count, f"doc_id {kind}, n long, terms array<int>, tfs array<long>"))


def corpus_figures(held: DataFrame, n_terms: int) -> Corpus:
    """Sums over all documents; each task adds up its own before anything moves."""
    def add(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        for f in frames:
            np.add.at(df, f.column(0).flatten().to_numpy(), 1)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at])], ["term", "df"])

    total = held.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    df = np.zeros(n_terms, np.int64)
    for r in held.select("terms").mapInArrow(add, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        df[r.term] = r.df
    return Corpus(total.docs, total.words, df)


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list]:
    """Query items in blocks of bounded text: (id as text, text). One block at a time is on the driver.

    Items are dealt by a hash of id and text, so a block passes the bound only by chance or by
    an item that passes it alone.
    """
    size = items.select(F.sum(F.octet_length(F.coalesce(F.col(text_col), F.lit("")))).alias("b")).first().b or 0
    rows = items.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t"))
    n = 1 if size <= block_bytes else -(-2 * size // block_bytes)
    for b in range(n):
        part = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b) if n > 1 else rows
        yield [(r.i, r.t) for r in part.collect()]


def search(docs: DataFrame, items: DataFrame, *, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = ITEM_BYTES,
           block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """The k best documents with a score above 0 of each item: item_id, rank, doc_id, score.

    A null text has no terms; an item without terms, or whose terms no document holds, gives no
    rows, as do empty tables. Each row of ``items`` is an item of its own, also if it repeats an
    id or has none; each row of ``docs`` is a document. Equal scores are ranked by ascending
    doc_id (null last); repeated rows take ranks of their own. Other columns are not read.
    """
    out = None
    for block in item_blocks(items, item_col, item_text_col, block_bytes):
        found = _search_block(docs, block, k, id_col, text_col, block_postings)
        out = found if out is None else out.unionByName(found)
    return out.withColumn("item_id", F.col("item_id").cast(items.schema[item_col].dataType))


def _search_block(docs: DataFrame, items: list[tuple[str | None, str | None]], k: int, id_col: str, text_col: str,
                  block_postings: int) -> DataFrame:
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType
    id_type = to_arrow_type(kind)
    number = {t: i for i, t in enumerate(sorted({t for _, text in items for t in term_set(text)}))}
    queries = []
    for _, text in items:
        count = term_counts(text, number)[1]
        queries.append((np.array(sorted(count), np.int64), np.array([count[t] for t in sorted(count)], np.int64)))
    held = stage(spark, postings(docs, number, id_col, text_col), "postings")
    corpus = corpus_figures(held, len(number))
    shared = spark.sparkContext.broadcast((queries, corpus))

    def best(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, corpus = shared.value
        weights = corpus.weights()
        rows: list[list[tuple]] = [[] for _ in queries]
        for part in _blocks(frames, block_postings):
            table = pa.Table.from_batches(part).combine_chunks()
            ids = table.column("doc_id").to_pylist()
            place = {i: (i is None, i if i is not None else 0) for i in set(ids)}
            order = sorted(range(len(ids)), key=lambda i: place[ids[i]])
            lists = pa.concat_arrays([c.column("terms") for c in part])
            sizes = np.diff(lists.offsets.to_numpy())
            term = lists.flatten().to_numpy().astype(np.int64)
            tf = pa.concat_arrays([c.column("tfs") for c in part]).flatten().to_numpy()
            rank = np.empty(len(ids), np.int64)
            rank[order] = np.arange(len(ids))
            impact = corpus.impacts(tf, np.repeat(table.column("n").to_numpy(), sizes))
            block = Block(np.repeat(rank, sizes), term, impact, len(ids), len(weights))
            for q, (terms, repeats) in enumerate(queries):
                floor = rows[q][k - 1][0] if len(rows[q]) >= k else 0
                found, scores, _ = block.search(terms, repeats * weights[terms], k, floor)
                rows[q] += [(int(s), ids[order[d]]) for d, s in zip(found, scores)]
                rows[q].sort(key=lambda r: (-r[0], r[1] is None, r[1] if r[1] is not None else 0))
                del rows[q][k:]
        flat = [(q, i, s) for q, rs in enumerate(rows) for s, i in rs]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in flat], pa.int32()), pa.array([r[1] for r in flat], id_type),
             pa.array([r[2] for r in flat], pa.int64())], ["item", "doc_id", "score"])

    rows = held.mapInArrow(best, f"item int, doc_id {kind.simpleString()}, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    first = rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
    first = first.withColumn("r", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("r") <= k)
    last = (first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
            .where(F.col("rank") <= k))
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], "item int, item_id string")
    return last.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def term_set(text: str | None) -> set[bytes]:
    return set((text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split())


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items of ``benchmark`` against all ``documents``."""
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


_WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '{_WORDS}') AS w FROM documents),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '{_WORDS}')) AS term FROM benchmark),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY 1, 2),
f AS (SELECT term, count(*) AS df FROM p GROUP BY 1),
s AS (SELECT count(*) AS n_docs, sum(len(w)) AS n_words FROM d WHERE len(w) > 0),
m AS (SELECT r, doc_id, CAST(75 + (25 * len(w) * n_docs) // n_words AS BIGINT) AS m FROM d, s WHERE len(w) > 0),
x AS (SELECT item_id, doc_id, r, sum(CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT)
             * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM q JOIN p USING (term) JOIN f USING (term) JOIN m USING (r), s GROUP BY 1, 2, 3),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 20
"""

QUERIES = {"op11_ranked_search": op11_ranked_search}
ORACLES = {"op11_ranked_search": ORACLE}
