"""Near-dedup with ProbMinHash signatures, banding and exact verification.

A document is the multiset of its five-word shingles. Each shingle starts a
Poisson process whose rate is its count; an arrival falls on a random register
and takes it if it is the earliest there. A process ends early once its next
arrival is later than all registers. Two documents agree on a register with
their probability Jaccard similarity J_P, also for weighted shingles.

Texts with the same words are one content. Contents that agree on a whole band
of registers share a bucket. In each bucket all are compared with one hub, with
J_P computed exactly; then contents still in different classes are compared
with a second hub, and at last with each other, in blocks inside tasks that return
links only. Pairs of one class need no comparison, and no pairs are expanded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import kept, mix64, read, stage, words
from tessera.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
#: 40 bands of 7 registers: a pair at J_P = 0.8 shares no band with probability 8e-5.
BANDS, ROWS = 40, 7
#: Shingles whose processes run together.
BATCH_SHINGLES = 60_000
MEMO_WORDS = 200_000
#: Contents of a bucket that one task compares with as many others.
BLOCK = 256
_G = 0x9E3779B97F4A7C15


def _word_hash(memo: dict[bytes, int], w: bytes) -> int:
    h = xxhash.xxh3_64_intdigest(w)
    if len(memo) < MEMO_WORDS:
        memo[w] = h
    return h


def shingles(w: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of the shingles; a text of fewer words, but not none, is one shingle."""
    if not w:
        return np.zeros(0, np.uint64), np.zeros(0)
    memo = kept("word hashes", dict)
    get = memo.get
    h = np.fromiter((get(x) or _word_hash(memo, x) for x in w), np.uint64, len(w))
    k = min(size, len(w))
    out = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + h[i:len(w) - k + 1 + i]
    found, n = np.unique(mix64(out), return_counts=True)
    return found, n.astype(float)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int = BANDS * ROWS) -> np.ndarray:
    """ProbMinHash signatures (one row per set, none of them empty): the shingle that came first at each register."""
    d = len(sets)
    doc = np.repeat(np.arange(d), [len(s[0]) for s in sets])
    e = np.concatenate([s[0] for s in sets])
    rate = np.concatenate([s[1] for s in sets])
    first = np.full(d * registers, np.inf)
    owner = np.zeros(d * registers, np.uint64)
    x, step = np.zeros(len(e)), 0
    while len(e):
        # Several arrivals at once when few processes are left.
        j = max(1, min(64, 20_000 // len(e)))
        i = np.arange(step + 1, step + j + 1, dtype=np.uint64) * np.uint64(_G)
        r = mix64(e[:, None] + i[None, :])
        gap = -np.log(((r >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53) / rate[:, None]
        t = x[:, None] + np.cumsum(gap, axis=1)
        # An independent value picks the register.
        place = doc[:, None] * registers + (mix64(r + np.uint64(_G)) % np.uint64(registers)).astype(np.int64)
        flat, when = place.ravel(), t.ravel()
        early = when < first[flat]
        flat, when = flat[early], when[early]
        np.minimum.at(first, flat, when)
        won = first[flat] == when
        owner[flat[won]] = np.repeat(e, j)[early][won]
        x, step = t[:, -1], step + j
        alive = x < first.reshape(d, registers).max(axis=1)[doc]
        doc, e, rate, x = doc[alive], e[alive], rate[alive], x[alive]
    return owner.reshape(d, registers)


def bands(signature: np.ndarray, n_bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """64-bit key of each band of each signature."""
    s = signature.reshape(len(signature), n_bands, rows)
    key = np.broadcast_to(mix64(np.arange(1, n_bands + 1, dtype=np.uint64) * np.uint64(_G)), s.shape[:2]).copy()
    for i in range(rows):
        key = mix64(key * np.uint64(0xD6E8FEB86659FD93) + s[:, :, i])
    return key.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard: the sum over common i of 1 / sum over j of max(a_j / a_i, b_j / b_i)."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    every, at = np.unique(np.concatenate((a[0], b[0])), return_inverse=True)
    x, y = np.zeros(len(every)), np.zeros(len(every))
    x[at[:len(a[0])]], y[at[len(a[0]):]] = a[1], b[1]
    with np.errstate(divide="ignore"):
        ratio = x / y
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    # Of the two quotients, j with a ratio below i's has the larger in b, others in a.
    y_below, x_from = np.concatenate(([0], np.cumsum(y))), np.concatenate((np.cumsum(x[::-1])[::-1], [0]))
    both = (x > 0) & (y > 0)
    cut = np.searchsorted(ratio, ratio[both], "left")
    return float((1.0 / (x_from[cut] / x[both] + y_below[cut] / y[both])).sum())


def _print(w: list[bytes]) -> bytes | None:
    return xxhash.xxh3_128_digest(b" ".join(w)) if w else None


def _sign(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Content print and band keys of each text."""
    def done(rows: list) -> pa.RecordBatch:
        sets = [r[2] for r in rows if r[1] is not None]
        keys = iter(bands(signatures(sets)).tolist()) if sets else iter(())
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], kind[0]), pa.array([r[1] for r in rows], pa.binary()),
             pa.array([next(keys) if r[1] is not None else None for r in rows], pa.list_(pa.int64()))],
            ["doc_id", "content", "bands"])

    rows, held, kind = [], 0, [pa.int64()]
    for f in frames:
        kind[0] = f.column("doc_id").type
        for doc_id, text in zip(f.column("doc_id").to_pylist(), f.column("text")):
            w = words(text.as_py())
            s = shingles(w)
            rows.append((doc_id, _print(w), s))
            held += len(s[0]) + 50
            if held >= BATCH_SHINGLES:
                yield done(rows)
                rows, held = [], 0
    if rows:
        yield done(rows)


def _verify(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact similarity of pairs of texts."""
    last_text, last = None, None
    for f in frames:
        out = []
        for a, b in zip(f.column("ta"), f.column("tb")):  # a pair of texts at a time is taken out of the batch
            a = a.as_py()
            if a != last_text:
                last_text, last = a, shingles(words(a))
            out.append(similarity(last, shingles(words(b.as_py()))))
        yield pa.RecordBatch.from_arrays([f.column("a"), f.column("b"), pa.array(out, pa.float64())], ["a", "b", "sim"])


def _links(block: pa.Table, threshold: float) -> pa.Table:
    """Links between members of different classes within one pair of blocks of a bucket."""
    side, lo, hi = (np.array(block.column(c).to_pylist()) for c in ("side", "lo", "hi"))
    content, root = (block.column(c).to_pylist() for c in ("content", "root"))
    sets = [shingles(words(t)) for t in block.column("text").to_pylist()]
    size = np.array([len(h) for h, _ in sets])
    plain = np.array([bool((n == n[0]).all()) for _, n in sets])  # J_P is then the sets' Jaccard
    _, cls = np.unique(np.array([r.hex() for r in root]), return_inverse=True)
    # Only shingles that occur twice can be shared.
    every, at, n = np.unique(np.concatenate([h for h, _ in sets]), return_inverse=True, return_counts=True)
    column = np.cumsum(n > 1) - 1
    row = np.repeat(np.arange(len(sets)), size)
    used = n[at] > 1
    share = np.concatenate([w / w.sum() for _, w in sets])
    has = np.zeros((len(sets), int((n > 1).sum())), np.float32)
    has[row[used], column[at[used]]] = 1
    mass = np.zeros(has.shape, np.float32)
    mass[row[used], column[at[used]]] = share[used]
    out = []
    for i in range(len(sets)):
        with_i = (cls != cls[i]) & ((side != side[i]) if lo[0] != hi[0] else (np.arange(len(sets)) > i))
        if side[i] != lo[0] or not with_i.any():
            continue
        j = np.flatnonzero(with_i)
        both = has[j] @ has[i]
        sure = plain[j] & plain[i]
        jaccard = both / (size[j] + size[i] - both)
        keep = sure & (jaccard >= threshold - 1e-6)
        if (~sure).any():  # J_P is at most the sum of the lesser shares
            mine = np.flatnonzero(mass[i])
            keep |= ~sure & (np.minimum(mass[j][:, mine], mass[i][mine]).sum(1) >= threshold - 1e-3)
        for k in j[keep]:
            sim = similarity(sets[i], sets[k])
            if sim >= threshold:
                out.append((*sorted((content[i], content[k])), sim))
    cols = list(zip(*out)) or [(), (), ()]
    return pa.table({"a": pa.array(cols[0], pa.binary()), "b": pa.array(cols[1], pa.binary()), "sim": pa.array(cols[2], pa.float64())})


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size, kept.

    A class is a connected component of links J_P >= ``threshold`` between contents, with all
    documents of these contents. ``class_id`` is its smallest doc_id, whose row is kept (of rows
    that repeat that doc_id all are marked kept). Null ids rank last; a class of null ids only has
    class_id null. Words ignore case of A-Z and punctuation, so texts that differ in nothing else
    are copies. Null, empty and wordless texts are never grouped: each is a class of its own.
    Texts below five words are one shingle. Whole texts are read, of any length. Other columns
    are not read, an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    signed = stage(spark, rows.mapInArrow(_sign, f"doc_id {kind}, content binary, bands array<long>"), "near-signed")
    # Copies collapse map-side; bands are a function of the content.
    contents = (signed.where("content IS NOT NULL").groupBy("content")
                .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.max("bands").alias("bands")))
    keyed = contents.select("content", F.explode("bands").alias("key"))
    # Buckets of two contents and more, with the first hub.
    full = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("content").alias("hub")).where("n > 1")
    buckets = stage(spark, keyed.join(full, "key").select("key", "content", "hub"), "near-buckets")

    involved = buckets.select("content").distinct()
    ids = contents.join(involved, "content").select("content", "rep")
    found = rows.alias("r").join(ids.alias("i"), F.col("r.doc_id").eqNullSafe(F.col("i.rep"))).select("r.text", "i.content")

    def same(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in frames:  # a doc_id may repeat with another text
            keep = [_print(words(t)) == c for t, c in zip(f.column("text").to_pylist(), f.column("content").to_pylist())]
            yield f.filter(pa.array(keep, pa.bool_()))

    texts = stage(spark, found.mapInArrow(same, "text string, content binary").dropDuplicates(["content"]), "near-texts")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        side = lambda c, t: texts.select(F.col("content").alias(c), F.col("text").alias(t))
        return stage(spark, pairs.join(side("b", "tb"), "b").join(side("a", "ta"), "a").select("a", "b", "ta", "tb")
                     .mapInArrow(_verify, "a binary, b binary, sim double"), name)

    def classes(new: DataFrame, root: DataFrame | None = None) -> DataFrame:
        """Classes after the new links; each class so far enters as one star."""
        links = new.where(F.col("sim") >= threshold).select(F.col("a").alias("u"), F.col("b").alias("v"))
        if root is None:
            return components(spark, links)
        if links.isEmpty():
            return root
        return components(spark, links.unionByName(root.select(F.col("node").alias("u"), F.col("root").alias("v"))))

    def placed(root: DataFrame) -> DataFrame:
        """Bucket rows with their class, of buckets that hold several classes."""
        labelled = (buckets.join(root, buckets["content"] == root["node"], "left")
                    .select("key", "content", "hub", F.coalesce("root", "content").alias("root")))
        mixed = labelled.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                            F.min(F.struct(F.xxhash64("content", "key"), "content")).alias("second"))
        return stage(spark, labelled.join(mixed.where("lo != hi"), "key")
                     .select("key", "content", "root", F.col("second.content").alias("second")), "near-mixed")

    ordered = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    # 1. Everything against the hub of its bucket.
    tested = verified(buckets.where("content != hub").select(F.col("hub").alias("a"), F.col("content").alias("b"))
                      .distinct(), "near-hub")
    root = classes(tested)
    # 2. In buckets of several classes, against a second hub of another class.
    mixed = placed(root)
    seconds = mixed.where("content = second").select("key", F.col("root").alias("second_root"))
    pairs = (mixed.join(seconds, "key").where("root != second_root")
             .select(*ordered("content", "second")).distinct().join(tested, ["a", "b"], "left_anti"))
    new = verified(pairs, "near-second")
    tested, root = tested.unionByName(new), classes(new, root)
    # 3. What is in different classes still: whole buckets, in blocks, inside tasks that
    #    return links only. Pairs have been compared, and buckets of the same members need one look.
    mixed = placed(root)
    members = (mixed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("content").cast("decimal(38,0)")).alias("set"))
               .where("n > 2").groupBy("n", "set").agg(F.min("key").alias("key")))
    side = F.pmod(F.xxhash64("content"), F.col("blocks"))
    blocks = (mixed.join(members.select("key", F.ceil(F.col("n") / BLOCK).alias("blocks")), "key")
              .withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
              .select("content", "root", "key", "side", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"))
              .join(texts, "content"))
    links = (blocks.groupBy("key", "lo", "hi").applyInArrow(lambda t: _links(t, threshold), "a binary, b binary, sim double"))
    root = classes(stage(spark, links.distinct(), "near-rest"), root)

    grouped = (contents.join(root, contents["content"] == root["node"], "left")
               .select("content", "rep", "copies", F.coalesce("root", "content").alias("root")))
    sizes = grouped.groupBy("root").agg(F.min("rep").alias("class_id"), F.sum("copies").alias("class_size"))
    by_content = grouped.join(sizes, "root").select("content", "class_id", "class_size")
    return (signed.select("doc_id", "content").join(by_content, "content", "left")
            .select("doc_id", F.when(F.col("class_size").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id"))))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``."""
    return near_duplicates(read(spark, sf_dir, "documents"))


QUERIES = {"op10_near_dedup": op10_near_dedup}
ORACLES: dict[str, str] = {}
