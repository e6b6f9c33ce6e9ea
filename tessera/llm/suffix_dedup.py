"""Removal of long repeated byte strings by merging shard Burrows-Wheeler transforms.

Byte-level transforms of whole corpora would need some 200 refinement steps per
byte. Three exact reductions come first, so that only text whose repetition is
in doubt is ever transformed:

1. Each 200-byte window names an anchor: its leftmost 32-byte string of smallest
   hash. Equal windows name equal anchors at equal offsets. The windows of a
   document that share one anchor form a run; its bytes are a snippet.
2. An anchor that occurs once in the corpus has no repeated window.
3. A snippet that occurs twice as a whole (equal hash of its bytes and equal
   anchor) is repeated throughout.

What remains, one snippet per distinct content of an anchor that has several
contents, is cut into 4-byte symbols and dealt out by anchor. A task sorts the
suffixes of small shards only, and merges the shards' transforms by refining
their interleave: step t sorts all suffixes by their first t symbols, reading
nothing but the transforms, and marks where prefixes part. After 49 steps the
unmarked intervals are the repeated strings of 49 symbols; comparing the up to
7 bytes around them gives the repeated 200-byte windows exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import read, stage

WINDOW = 200
ANCHOR = 32
SYMBOL = 4
#: Whole symbols that any window contains, wherever it starts.
STEPS = (WINDOW - (SYMBOL - 1)) // SYMBOL
#: Window starts of one text whose anchors are found at once.
SEGMENT = 1 << 22
#: Snippets of a shard whose suffixes are sorted, and of a merge.
SHARD, MERGE = 64, 512
#: Contents of one anchor beyond which its windows are compared by hash instead,
#: spread over all tasks.
HOT = 4096
_POS = np.uint64((1 << 24) - 1)


def _hashes(data: np.ndarray) -> np.ndarray:
    """Mixed 64-bit hash of each ANCHOR-byte string, by doubling."""
    h = data.astype(np.uint64) + np.uint64(1)
    size, power = 1, 1099511628211
    while size < ANCHOR:
        h = h[:-size] * np.uint64(power) + h[size:]
        power = power * power % (1 << 64)
        size *= 2
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def runs(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor hash, first window start, last window start) of the runs of one text."""
    starts = len(data) - WINDOW + 1
    for at in range(0, max(starts, 0), SEGMENT):
        part = np.frombuffer(data, np.uint8, min(SEGMENT, starts - at) + WINDOW - 1, at)
        z = _hashes(part)
        # Position in the low bits: the minimum is the leftmost of the smallest.
        m = (z & ~_POS) | np.arange(len(z), dtype=np.uint64)
        size, width = 1, WINDOW - ANCHOR + 1
        while size * 2 <= width:
            m = np.minimum(m[:-size], m[size:])
            size *= 2
        if width > size:
            m = np.minimum(m[:-(width - size)], m[width - size:])
        place = (m & _POS).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        last = np.concatenate((first[1:] - 1, [len(place) - 1]))
        yield z[place[first]].view(np.int64), first + at, last + at


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _anchors(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for f in frames:
        rows, h, a, b, s = [], [], [], [], []
        for i, text in enumerate(f.column("text").to_pylist()):
            data = _bytes(text)
            for anchor, first, last in runs(data):
                rows.append(np.full(len(anchor), i))
                h.append(anchor)
                a.append(first)
                b.append(last)
                s.extend([xxhash.xxh3_64_intdigest(data[x:y]) - (1 << 63)
                          for x, y in zip(first.tolist(), (last + WINDOW).tolist())])
        if rows:
            take = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(h)), pa.array(s, pa.int64()), f.column("doc_id").take(take),
                 f.column("print").take(take), pa.array(np.concatenate(a)), pa.array(np.concatenate(b))],
                ["anchor", "snippet", "doc_id", "print", "a", "b"])


def suffix_array(symbols: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Suffix order of concatenated strings by prefix doubling; ``rank`` orders first
    symbols, and end marks (one per string) have distinct ranks."""
    n, k = len(symbols), 1
    while True:
        order = np.argsort(rank, kind="stable")
        if k >= n:
            return order
        nxt = np.zeros(n, np.int64)
        nxt[:n - k] = rank[k:] + 1
        key = rank * (int(rank.max()) + 2) + nxt
        order = np.argsort(key, kind="stable")
        s = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(s[1:] != s[:-1])))
        if rank[order[-1]] == n - 1:
            return order
        k *= 2


def shard_bwt(strings: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(transform, string number, place in the string) of the suffixes in order; symbols are
    positive, 0 is the end mark, and end marks rank by string number."""
    sizes = np.array([len(s) + 1 for s in strings])
    text = np.concatenate([np.append(s, 0) for s in strings])
    number = np.repeat(np.arange(len(strings)), sizes)
    start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = np.arange(len(text)) - start
    order = suffix_array(text, np.where(text == 0, number, text.astype(np.int64) + len(strings)))
    return np.where(place == 0, 0, text[np.arange(len(text)) - 1])[order], number[order], place[order]


def merge(transforms: list[np.ndarray], strings: list[int], steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the shards' suffixes sorted by their first ``steps`` symbols.

    Returns (shard of each merged position, whether a new prefix begins there).
    """
    sizes = [len(t) for t in transforms]
    z = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)
    ends = np.repeat(np.arange(len(sizes), dtype=np.uint16), strings)
    bwt = np.concatenate(transforms)
    kind = np.uint16 if bwt.max(initial=0) < 1 << 16 else np.int64
    bwt = bwt.astype(kind)
    n, marks = len(bwt), len(ends)
    block = np.zeros(n, np.int64)
    begins = np.zeros(n, bool)
    symbols = np.empty(n, kind)
    for _ in range(steps):
        symbols[np.argsort(z, kind="stable")] = bwt
        order = np.argsort(symbols, kind="stable")
        c, from_block = symbols[order], block[order]
        z = z[order]
        z[:marks] = ends  # suffixes that are end marks stand in string order
        begins = np.ones(n, bool)
        begins[1:] = (c[1:] != c[:-1]) | (from_block[1:] != from_block[:-1])
        begins[:marks + 1] = True
        block = np.cumsum(begins)
    return z, begins


def repeated_windows(snippets: list[bytes], first: list[int], valid: list[int]) -> list[np.ndarray]:
    """For each snippet the window starts, of its first ``valid`` ones, whose window occurs
    again among those of the snippets; ``first`` is where its first whole symbol begins."""
    cut = [np.frombuffer(s, "<u4", (len(s) - o) // SYMBOL, o) for s, o in zip(snippets, first)]
    _, codes = np.unique(np.concatenate(cut), return_inverse=True)
    strings = np.split(codes + 1, np.cumsum([len(c) for c in cut])[:-1])
    shards = [strings[i:i + SHARD] for i in range(0, len(strings), SHARD)]
    parts = [shard_bwt(s) for s in shards]
    z, begins = merge([p[0] for p in parts], [len(s) for s in shards], STEPS)
    by_shard = np.argsort(z, kind="stable")
    number, place = np.empty(len(z), np.int64), np.empty(len(z), np.int64)
    number[by_shard] = np.concatenate([p[1] + i * SHARD for i, p in enumerate(parts)])
    place[by_shard] = np.concatenate([p[2] for p in parts])
    block = np.cumsum(begins)
    shared = np.bincount(block)[block] > 1
    number, place, block = number[shared], place[shared], block[shared]
    # Bytes around each symbol run: SYMBOL - 1 before it, SYMBOL after it.
    lead = SYMBOL - 1
    size = np.array([len(s) for s in snippets])
    base = np.cumsum(size + lead + SYMBOL) - (size + lead + SYMBOL) + lead
    flat = np.frombuffer(b"".join([b"\0" * lead + s + b"\0" * SYMBOL for s in snippets]), np.uint8).astype(np.int64)
    begin = np.asarray(first)[number] + place * SYMBOL
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for back in range(SYMBOL):
        w = begin - back
        ok = (w >= 0) & (w < np.asarray(valid)[number]) & (w + WINDOW <= size[number])
        at, k = (base[number] + w)[ok], block[ok]
        key = np.zeros(len(at), np.int64)
        for i in (*range(back), *range(back + STEPS * SYMBOL, WINDOW)):
            key = key << 8 | flat[at + i]
        order = np.lexsort((key, k))
        same = np.zeros(len(order), bool)
        if len(order) > 1:
            eq = (k[order][1:] == k[order][:-1]) & (key[order][1:] == key[order][:-1])
            same[1:] |= eq
            same[:-1] |= eq
        found.append((number[ok][order][same], w[ok][order][same]))
    number, w = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((w, number))
    return np.split(w[order], np.searchsorted(number[order], np.arange(1, len(snippets))))


def _spans(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last start of runs of consecutive starts."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(np.diff(starts) > 1)
    return starts[np.concatenate(([0], cut + 1))], starts[np.concatenate((cut, [len(starts) - 1]))]


def _resolve(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows of snippets that arrive in anchor order."""
    names = ("anchor", "n", "doc_id", "print", "a", "b", "lead", "data")

    def done(rows: list[tuple]) -> pa.RecordBatch:
        starts = repeated_windows([r[7] for r in rows], [r[6] for r in rows], [r[5] - r[4] + 1 for r in rows])
        out = [(r[2], r[3], r[4] + x, r[4] + y) for r, s in zip(rows, starts) if r[1] == 1
               for x, y in zip(*(v.tolist() for v in _spans(s)))]
        cols = list(zip(*out)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (frames_type[0], pa.int64(), pa.int64(), pa.int64()))],
                                          ["doc_id", "print", "a", "b"])

    rows: list[tuple] = []
    frames_type = [pa.int64()]
    for f in frames:
        frames_type[0] = f.column("doc_id").type
        for row in zip(*(f.column(c).to_pylist() for c in names)):
            if len(rows) >= MERGE and row[0] != rows[-1][0]:  # an anchor's snippets stay together
                yield done(rows)
                rows = []
            rows.append(row)
    if rows:
        yield done(rows)


def _cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Snippets of the wanted runs of each text, with the place of the first symbol."""
    names = ("anchor", "n", "m", "a", "b")
    for f in frames:
        rows = []
        for text, doc_id, mark, want in zip(*(f.column(c).to_pylist() for c in ("text", "doc_id", "print", "want"))):
            data = _bytes(text)
            for w in want:
                anchor, n, m, a, b = (w[c] for c in names)
                piece = data[a:b + WINDOW]
                # Symbols are aligned to the anchor, so that equal windows have equal symbols.
                rows.append((anchor, n, m, doc_id, mark, a, b, _find(piece, anchor) % SYMBOL, piece))
        if rows:
            cols = list(zip(*rows))
            types = (pa.int64(), pa.int64(), pa.int64(), f.column("doc_id").type, pa.int64(), pa.int64(), pa.int64(),
                     pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             ["anchor", "n", "m", "doc_id", "print", "a", "b", "lead", "data"])


def _find(piece: bytes, anchor: int) -> int:
    """Leftmost place of the anchor in the snippet of its run."""
    z = _hashes(np.frombuffer(piece, np.uint8)).view(np.int64)
    return int(np.argmax(z == anchor))


def _windows(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of snippets of hot anchors, by hash."""
    for f in frames:
        for row in zip(*(f.column(c).to_pylist() for c in ("anchor", "n", "doc_id", "print", "a", "b", "data"))):
            anchor, n, doc_id, mark, a, b, data = row
            k = b - a + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([anchor] * k, pa.int64()),
                 pa.array([xxhash.xxh3_64_intdigest(data[i:i + WINDOW]) - (1 << 63) for i in range(k)], pa.int64()),
                 pa.array([n] * k, pa.int64()), pa.array([doc_id] * k, f.column("doc_id").type),
                 pa.array([mark] * k, pa.int64()), pa.array(range(a, b + 1), pa.int64())],
                ["anchor", "window", "n", "doc_id", "print", "a"])


def repeated_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Runs of repeated windows: doc_id, print (hash of the text), a, b (first and last window start)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
                       ).withColumn("print", F.xxhash64("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    anchors = rows.mapInArrow(_anchors, f"anchor long, snippet long, doc_id {kind}, print long, a long, b long")
    # One row per content of an anchor; copies collapse before the shuffle.
    contents = anchors.groupBy("anchor", "snippet").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "print", "a", "b")).alias("rep"))
    contents = stage(spark, contents, "suffix-contents")
    repeated = (contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total"))
                .where("total > 1").select("anchor", "m"))
    known = stage(spark, contents.join(repeated, "anchor"), "suffix-known")

    whole = (anchors.join(known.where("n > 1").select("anchor", "snippet"), ["anchor", "snippet"])
             .select("doc_id", "print", "a", "b"))
    want = (known.where("m > 1").select("anchor", "n", "m", "rep.*")
            .groupBy("doc_id", "print").agg(F.collect_list(F.struct("anchor", "n", "m", "a", "b")).alias("want")))
    texts = rows.alias("r").join(want.alias("w"), F.col("r.doc_id").eqNullSafe(F.col("w.doc_id"))
                                 & (F.col("r.print") == F.col("w.print"))).select("r.*", "w.want")
    cut = stage(spark, texts.mapInArrow(
        _cut, f"anchor long, n long, m long, doc_id {kind}, print long, a long, b long, lead int, data binary")
        .dropDuplicates(["anchor", "doc_id", "print", "a"]), "suffix-snippets")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partial = (cut.where(F.col("m") <= HOT).repartition(n, "anchor").sortWithinPartitions("anchor")
               .mapInArrow(_resolve, f"doc_id {kind}, print long, a long, b long"))
    windows = cut.where(F.col("m") > HOT).mapInArrow(
        _windows, f"anchor long, window long, n long, doc_id {kind}, print long, a long")
    twice = windows.groupBy("anchor", "window").agg(F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    hot = (windows.join(twice, ["anchor", "window"]).where("n = 1")
           .select("doc_id", "print", "a", F.col("a").alias("b")))
    return whole.unionByName(partial).unionByName(hot)


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, kept (remaining bytes), spans (removed [start, end) runs).

    Removes each byte covered by a 200-byte string that starts anywhere else, in the same
    document too, judged on the input. Texts count in UTF-8; a null text counts as empty and
    texts below 200 bytes are kept whole. Rows that repeat a doc_id and text are documents of
    their own, so their long strings go from each. Long texts are read whole. Null ids are
    allowed, other columns are not read, an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
                       ).withColumn("print", F.xxhash64("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    spans = (repeated_spans(docs, id_col=id_col, text_col=text_col)
             .groupBy("doc_id", "print").agg(F.collect_set(F.struct("a", "b")).alias("runs")))
    both = rows.alias("r").join(spans.alias("s"), F.col("r.doc_id").eqNullSafe(F.col("s.doc_id"))
                                & (F.col("r.print") == F.col("s.print")), "left").select("r.doc_id", "r.text", "s.runs")

    def take(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in frames:
            size, kept, gone = [], [], []
            for text, found in zip(f.column("text").to_pylist(), f.column("runs").to_pylist()):
                data = _bytes(text)
                out: list[list[int]] = []
                for a, b in sorted((r["a"], r["b"] + WINDOW) for r in found or ()):
                    if out and a <= out[-1][1]:
                        out[-1][1] = max(out[-1][1], b)
                    else:
                        out.append([a, b])
                edges = [0, *(x for r in out for x in r), len(data)]
                size.append(len(data))
                kept.append(b"".join([data[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2)]))
                gone.append([{"start": a, "end": b} for a, b in out])
            yield pa.RecordBatch.from_arrays(
                [f.column("doc_id"), pa.array(size, pa.int64()), pa.array(kept, pa.binary()),
                 pa.array(gone, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                ["doc_id", "n_bytes", "kept", "spans"])

    return both.mapInArrow(take, f"doc_id {kind}, n_bytes long, kept binary, spans array<struct<start:long, end:long>>")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``."""
    return remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op9_suffix_dedup": op9_suffix_dedup}
ORACLES: dict[str, str] = {}
