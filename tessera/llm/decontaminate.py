"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of benchmark items (10 consecutive words; an item of
fewer words is one window). Per pattern length there is a table set:

* shift: for a block of two words, how far the search may jump because no
  pattern has that block nearer to its end; unknown blocks jump the most;
* buckets: patterns by their last block, then by their first block;
* direct comparison of the words confirms an occurrence.

Words are numbers in the tables, which are plain arrays. The items of one block
are bounded in size and broadcast, and each worker builds their tables once; a
larger benchmark runs as several blocks against all documents, whose hits are
merged.
"""

from __future__ import annotations

import uuid
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import WORD_BYTES, kept, read, stage, words

WINDOW = 10
#: Bound of the benchmark text whose tables one pass broadcasts.
BLOCK_BYTES = 8 << 20
#: Bytes of text that are split into words at once.
SEGMENT = 1 << 20
#: Multiplier that spreads word pairs over the shift table.
SPREAD = 40503
RUNS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


class Tables:
    """Shift and bucket tables of the patterns of one length.

    ``starts`` are the patterns' places in ``stream`` (the items' words as numbers from 1),
    ``owners`` the number of each pattern's item. Equal patterns are kept once.
    """

    def __init__(self, number: dict[bytes, int], stream: np.ndarray, starts: np.ndarray, owners: np.ndarray, length: int):
        self.number, self.length = number, length
        self.block = block = min(2, length)
        self.skip = length - block + 1
        windows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(stream, length)[starts])
        _, first, which = np.unique(windows.view(f"V{4 * length}")[:, 0], return_index=True, return_inverse=True)
        windows = windows[first]
        last, head = self._keys(windows[:, length - block:]), self._keys(windows[:, :block])
        order = np.lexsort((head, last))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        #: Buckets: patterns by their last block, then by their first one.
        self.last, self.head = array("q", last[order].tobytes()), array("q", head[order].tobytes())
        self.words = np.ascontiguousarray(windows[order]).tobytes()
        held = np.unique(np.stack([place[which], owners]), axis=1)
        self.items = array("q", held[1].astype(np.int64).tobytes())
        self.ends = array("q", np.searchsorted(held[0], np.arange(len(order) + 1)).astype(np.int64).tobytes())
        #: Blocks that share an entry of the shift table get the least of their jumps.
        self.mask = (1 << max(16, (8 * len(order)).bit_length())) - 1
        shift = np.full(self.mask + 1, self.skip, np.uint16 if self.skip > 255 else np.uint8)
        for end in range(block, length + 1):
            k = self._keys(windows[:, end - block:end])
            shift[((k >> 32) * SPREAD + (k & 0xFFFFFFFF)) & self.mask] = length - end
        self.shift = array(shift.dtype.char, shift.tobytes())

    @staticmethod
    def _keys(blocks: np.ndarray) -> np.ndarray:
        k = blocks[:, -1].astype(np.int64)
        return k if blocks.shape[1] == 1 else k | (blocks[:, 0].astype(np.int64) << 32)

    def _owners(self, last: int, head: int, w: list[bytes], a: int) -> Iterator[int]:
        """Items of the pattern that the words from ``a`` on are, if there is one."""
        lo = bisect_left(self.last, last)
        if lo == len(self.last) or self.last[lo] != last:
            return
        hi = bisect_right(self.last, last, lo)
        lo = bisect_left(self.head, head, lo, hi)
        hi = bisect_right(self.head, head, lo, hi)
        if lo == hi:
            return
        m = self.length
        here = array("i", [self.number.get(x, 0) for x in w[a:a + m]]).tobytes()
        for p in range(lo, hi):
            if self.words[4 * m * p:4 * m * (p + 1)] == here:
                yield from self.items[self.ends[p]:self.ends[p + 1]]

    def search(self, w: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """(start, items) of every occurrence in the words."""
        m, shift, skip, mask, number = self.length, self.shift, self.skip, self.mask, self.number.get
        if self.block == 1:
            for i, x in enumerate(w):
                k = number(x, 0)
                if k and (items := list(self._owners(k, k, w, i))):
                    yield i, items
            return
        i, n = m - 1, len(w)
        while i < n:
            x = number(w[i], 0)
            y = number(w[i - 1], 0) if x else 0
            s = shift[(y * SPREAD + x) & mask] if y else skip
            if s:
                i += s
                continue
            a = i - m + 1
            head = (number(w[a], 0) << 32) | number(w[a + 1], 0)
            if items := list(self._owners((y << 32) | x, head, w, a)):
                yield a, items
            i += 1


def _null_last(item_id: str | None) -> tuple[bool, str]:
    return item_id is None, item_id or ""


def build(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> tuple[list[Tables], list[str | None]]:
    """Tables by pattern length, and the item ids that the tables number."""
    ids = sorted({i for i, _ in items}, key=_null_last)
    place = {i: k for k, i in enumerate(ids)}
    number: dict[bytes, int] = {}
    stream, starts, owners = array("i"), {}, {}
    for i, text in items:
        w = words(text)
        size, at = min(window, len(w)), len(stream)
        if size:
            stream.extend(number.setdefault(x, len(number) + 1) for x in w)
            here = range(at, len(stream) - size + 1)
            starts.setdefault(size, array("q")).extend(here)
            owners.setdefault(size, array("q")).extend([place[i]] * len(here))
    every = np.frombuffer(stream, np.int32) if stream else np.empty(0, np.int32)
    return [Tables(number, every, np.frombuffer(starts[n], np.int64), np.frombuffer(owners[n], np.int64), n)
            for n in sorted(starts)], ids


def segments(text: str | None, carry: int) -> Iterator[tuple[int, list[bytes]]]:
    """(position of the first word, words) of consecutive pieces of one text; each piece
    repeats the ``carry`` words before it, so that no window is lost between pieces."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES)
    at, done, tail = 0, 0, []
    while at < len(data):
        cut = len(data) if len(data) - at <= SEGMENT else data.find(b" ", at + SEGMENT)
        cut = len(data) if cut < 0 else cut
        w = tail + data[at:cut].split()
        yield done - len(tail), w
        done += len(w) - len(tail)
        tail = w[-carry:] if carry else []
        at = cut


def match(text: str | None, tables: list[Tables]) -> tuple[int, list[tuple[int, int]], set[int]]:
    """Number of words, merged hit runs (first word, end), numbers of the items that occur."""
    carry = max((t.length for t in tables), default=1) - 1
    n, runs, found = 0, [], set()
    for first, w in segments(text, carry):
        n = first + len(w)
        for t in tables:
            for a, items in t.search(w):
                runs.append((first + a, first + a + t.length))
                found.update(items)
    return n, merged(runs), found


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted runs without overlaps."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str | None, str | None]]]:
    """Items in blocks of bounded text; an item is never split. One block at a time is on the driver."""
    size = F.octet_length(F.coalesce(F.col(text_col), F.lit("")))
    items = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t"))
    total = benchmark.select(F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()["b"]
    n = max(1, -(-int(total) // block_bytes))
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64(F.coalesce("i", "t")), F.lit(n)) == k) if n > 1 else items
        yield [(r.i, r.t) for r in part.collect()]


def hit_runs(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
             block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, runs (merged [first word, end) pairs), items (sorted item ids, null last).

    A null text has no words; a document or item without words has no hits. Items that
    repeat an id count as one, also those with a null id. Long texts are searched
    whole, in pieces that overlap by a window. Repeated document rows each give a row.
    Other columns are not read. An empty benchmark gives no hits, empty documents no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"), F.lit(0).cast("long").alias("n_words"),
                       F.expr("cast(array() AS array<struct<a:long, b:long>>)").alias("runs"),
                       F.expr("cast(array() AS array<string>)").alias("items"))
    schema, first = rows.schema, True
    for items in _blocks(benchmark, item_col, item_text_col, block_bytes):
        shared, name = spark.sparkContext.broadcast(items), uuid.uuid4().hex

        def search(frames: Iterator[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            # A worker builds the tables of a block once and lets go of the block before it.
            tables, ids = kept(("decontaminate", name), lambda: build(shared.value, window))
            for f in frames:
                n, runs, found = [], [], []
                for text, old_runs, old in zip(*(f.column(c).to_pylist() for c in ("t", "runs", "items"))):
                    count, new, numbers = match(text, tables)
                    n.append(count)
                    runs.append([{"a": a, "b": b} for a, b in merged([(x["a"], x["b"]) for x in old_runs] + new)])
                    found.append(sorted({*old, *(ids[k] for k in numbers)}, key=_null_last))
                yield pa.RecordBatch.from_arrays(
                    [f.column("doc_id"), f.column("t"), pa.array(n, pa.int64()), pa.array(runs, RUNS),
                     pa.array(found, pa.list_(pa.string()))], ["doc_id", "t", "n_words", "runs", "items"])

        # A further block of items takes the rows that the block before has written.
        rows = (rows if first else stage(spark, rows, "decontaminate")).mapInArrow(search, schema)
        first = False
    return rows.drop("t")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` against all items of ``benchmark``; n_items counts the null id, items_sha256 passes over it."""
    hits = hit_runs(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda s, r: s + r["b"] - r["a"])
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                       (n_hit > 0).alias("contaminated"))


_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
ORACLE = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '{_WORDS}') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id,
             regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '{_WORDS}') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM p),
q AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS s
      FROM (SELECT d.*, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, lens WHERE len(w) >= m)),
o AS (SELECT DISTINCT doc_id, q.i, q.m, item_id FROM q JOIN p ON q.m = p.m AND q.s = p.s),
h AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS pos FROM o) GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
      FROM (SELECT DISTINCT doc_id, item_id FROM o) GROUP BY 1)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)
"""

QUERIES = {"op2_decontaminate": op2_decontaminate}
ORACLES = {"op2_decontaminate": ORACLE}
