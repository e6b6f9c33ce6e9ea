"""Token-ID output: concatenated ids with Elias-Fano document boundaries.

A store is a folder of shards in ascending doc_id order. One shard file holds

    magic
    ids            little-endian unsigned, 2 or 4 bytes each, all documents in a row
    boundaries     Elias-Fano: end of each document, in ids from the shard's start
    doc ids        Elias-Fano: doc_id minus the smallest one (null ids come first)
    footer         JSON with offsets and sizes, its length, magic

An Elias-Fano sequence of n values below u takes about n * (2 + log2(u / n)) bits:
low bits packed, high bits in unary, and the place of every 256th set bit, from
which ``select(i)`` reads one value without decoding the others. No 64-bit
offset table is stored.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import kept, read, stage
from tessera.session import scratch_path

MAGIC = b"EFTOKEN1"
SAMPLE = 256
#: Pieces of text whose ids a worker remembers; other pieces are encoded each time.
MEMO_PIECES = 500_000
READ_BYTES = 8 << 20


class EliasFano:
    """Non-decreasing integers from 0 up to ``universe`` in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits = n, low_bits
        self.low = np.frombuffer(low, np.uint8)
        self.high = np.frombuffer(high, np.uint8)
        self.samples = np.frombuffer(samples, "<u4")

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = len(v)
        bits = max(0, (int(universe) // n).bit_length() - 1) if n else 0
        low = (((v[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
               if bits else np.zeros((n, 0), np.uint8))
        ones = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        return cls(n, bits, np.packbits(low.ravel(), bitorder="little").tobytes(),
                   np.packbits(high, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u4").tobytes())

    def parts(self) -> tuple[bytes, bytes, bytes]:
        return self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()

    def _low(self, i: int) -> int:
        a, b = i * self.low_bits, (i + 1) * self.low_bits
        part = int.from_bytes(self.low[a // 8:(b + 7) // 8].tobytes(), "little")
        return (part >> (a % 8)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value: the place of the i-th set high bit, found from the nearest sample."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at // 8
        left += int(np.unpackbits(self.high[byte:byte + 1], bitorder="little")[:at % 8].sum())
        while True:
            bits = np.unpackbits(self.high[byte:byte + 64], bitorder="little")
            ones = int(bits.sum())
            if left < ones:
                place = byte * 8 + int(np.flatnonzero(bits)[left])
                return ((place - i) << self.low_bits) | self._low(i)
            left -= ones
            byte += 64

    def decode(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        v = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            low = np.unpackbits(self.low, count=self.n * self.low_bits, bitorder="little")
            v |= low.reshape(self.n, -1).astype(np.uint64) @ (
                np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64))
        return v.astype(np.int64)


class ShardWriter:
    """Writes one shard; the file appears under its name only when complete."""

    def __init__(self, uri: str, width: int):
        self.fs, self.path = pafs.FileSystem.from_uri(uri)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.tmp = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.out = self.fs.open_output_stream(self.tmp)
        self.out.write(MAGIC)
        self.width, self.lengths, self.ids = width, [], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.lengths.append(len(ids) // self.width)
        self.ids.append(doc_id)

    def close(self) -> tuple[int, int]:
        """(documents, ids) written."""
        ends = np.cumsum(self.lengths, dtype=np.int64)
        known = [i for i in self.ids if i is not None]
        first = known[0] if known else 0
        total = int(ends[-1]) if len(ends) else 0
        seqs = {"ends": EliasFano.encode(ends, total),
                "docs": EliasFano.encode(np.array([i - first for i in known], np.uint64),
                                         known[-1] - first if known else 0)}
        foot = {"width": self.width, "n_docs": len(self.ids), "n_ids": total,
                "null_docs": len(self.ids) - len(known), "first_doc": first}
        at = len(MAGIC) + total * self.width
        for name, seq in seqs.items():
            parts = seq.parts()
            foot[name] = {"n": seq.n, "low_bits": seq.low_bits, "at": at, "sizes": [len(p) for p in parts]}
            for p in parts:
                self.out.write(p)
                at += len(p)
        tail = json.dumps(foot).encode()
        self.out.write(tail + struct.pack("<I", len(tail)) + MAGIC)
        self.out.close()
        self.fs.move(self.tmp, self.path)
        return foot["n_docs"], total


class Shard:
    """Random and sequential reads of one shard file."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        size, m = self.file.size(), len(MAGIC)
        length, magic = struct.unpack(f"<I{m}s", self.file.read_at(4 + m, size - 4 - m))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a token shard")
        self.foot = json.loads(self.file.read_at(length, size - 4 - m - length))
        self.ends, self.docs = self._seq("ends"), self._seq("docs")
        self.kind = f"<u{self.foot['width']}"

    def _seq(self, name: str) -> EliasFano:
        d = self.foot[name]
        at, parts = d["at"], []
        for size in d["sizes"]:
            parts.append(self.file.read_at(size, at))
            at += size
        return EliasFano(d["n"], d["low_bits"], *parts)

    def __len__(self) -> int:
        return self.foot["n_docs"]

    def _ids(self, a: int, b: int) -> np.ndarray:
        w = self.foot["width"]
        return np.frombuffer(self.file.read_at((b - a) * w, len(MAGIC) + a * w), self.kind)

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document of the shard."""
        return self._ids(self.ends.select(i - 1) if i else 0, self.ends.select(i))

    def doc_ids(self) -> list[int | None]:
        known = self.docs.decode() + self.foot["first_doc"]
        return [None] * self.foot["null_docs"] + known.tolist()

    def documents(self) -> Iterator[tuple[int, np.ndarray]]:
        """(start, ids) of each document, read in blocks of whole documents."""
        ends = self.ends.decode()
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        i = 0
        while i < len(ends):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + READ_BYTES // self.foot["width"], "right")))
            block = self._ids(int(starts[i]), int(ends[j - 1]))
            for k in range(i, j):
                yield int(starts[k]), block[starts[k] - starts[i]:ends[k] - starts[i]]
            i = j


def _byte_chars() -> list[str]:
    """Character that stands for each byte in a byte-level vocabulary."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(other)) for b in range(256)]


class Encoder:
    """Ids of whole texts, equal to those of the tokenizer's ``encode``.

    The tokenizer drops white space and never joins characters across it, so a text's
    ids are those of its pieces between spaces and line ends, one after the other.
    Frequent pieces are remembered. Pieces of ASCII and Latin-1 letters are taken apart
    here and given to the tokenizer's model; all others go through ``encode``.
    """

    SPACES = re.compile(r"[\n\r\t]")
    PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
    PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")

    def __init__(self, path: str, end_id: int, memo: int = MEMO_PIECES):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        spec = json.loads(self.tokenizer.to_str())
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.by_piece = self._drops_spaces(spec)
        self.width = 2 if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.end = np.array([end_id], self.kind).tobytes()
        self.memo: dict[str, bytes] = {"": b""}
        self.part_memo: dict[str, bytes] = {}
        self.size = memo
        self.chars = _byte_chars()

    @staticmethod
    def _drops_spaces(spec: dict) -> bool:
        """Whether this is the vocabulary kind whose splitting is known here."""
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        norm = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        return (norm == ["NFC", "Replace", "Lowercase"] and [s["type"] for s in steps] == ["Split", "ByteLevel"]
                and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
                and steps[0]["pattern"].get("Regex") ==
                r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _coded(self, part: str) -> bytes:
        mapped = part if part.isascii() else "".join(self.chars[b] for b in part.encode())
        return self._pack([t.id for t in self.model.tokenize(mapped)])

    def _part(self, part: str) -> bytes:
        known = self.part_memo.get(part)
        if known is None:
            known = self._coded(part)
            if len(self.part_memo) < self.size:
                self.part_memo[part] = known
        return known

    def _piece(self, piece: str) -> bytes:
        if self.PLAIN.fullmatch(piece) and not any(s in piece for s in self.specials):
            parts = self.PARTS.findall(piece.lower())
            # A piece of one part is remembered as a piece only.
            out = self._coded(parts[0]) if len(parts) == 1 else b"".join([self._part(p) for p in parts])
        else:
            out = self._whole(piece)
        if len(self.memo) < self.size:
            self.memo[piece] = out
        return out

    def encode(self, text: str | None) -> bytes:
        """Packed ids of the text and the end id. A null text counts as empty."""
        if not text:
            return self.end
        if not self.by_piece:
            return self._whole(text) + self.end
        get, piece = self.memo.get, self._piece
        out = []
        for p in self.SPACES.sub(" ", text).split(" "):
            ids = get(p)
            out.append(piece(p) if ids is None else ids)
        out.append(self.end)
        return b"".join(out)


def encoder(path: str, end_id: int) -> Encoder:
    """The worker's encoder; it outlives a task."""
    return kept(("encoder", path, end_id), lambda: Encoder(path, end_id))


def write_store(docs: DataFrame, root: str, tokenizer_path: str, end_id: int, *,
                id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> DataFrame:
    """Encode every text and write the store under the folder ``root``.

    Returns the manifest (shard, path, n_docs, n_ids), in which null texts count as empty
    (one end id), null doc_ids come first, and rows that repeat a doc_id follow each other
    in the order of their ids. doc_id must be an integer; other columns are not read. Empty
    tables give an empty manifest. Shards are ranges of doc_id (all rows of one doc_id are in
    one shard); a lost task writes its shards again under the same names and with the same bytes.
    """
    spark = docs.sparkSession
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.select(F.percentile_approx(F.col(id_col).cast("long"), [k / n for k in range(1, n)] or [0.5],
                                           max(10_000, 20 * n))).first()[0]
    bounds = sorted(set(cuts or [])) if n > 1 else []

    def encode(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, edges = encoder(tokenizer_path, end_id), np.array(bounds, np.int64)
        for f in frames:
            for at in range(0, f.num_rows, 1000):
                b = f.slice(at, 1000)
                ids = b.column(0).to_pylist()
                shard = [0 if i is None else int(np.searchsorted(edges, i, "right")) for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int32()), b.column(0),
                     pa.array([enc.encode(t) for t in b.column(1).to_pylist()], pa.binary())],
                    ["shard", "doc_id", "ids"])

    def write(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, out, now, done = encoder(tokenizer_path, end_id).width, None, None, []

        def finish() -> None:
            if out is not None:
                done.append((now, f"shard-{now:06d}.tok", *out.close()))

        for f in frames:
            for shard, doc_id, ids in zip(*(f.column(k).to_pylist() for k in range(3))):
                if shard != now:
                    finish()
                    out, now = ShardWriter(f"{root}/shard-{shard:06d}.tok", width), shard
                out.add(doc_id, ids)
        finish()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[k] for d in done], t) for k, t in enumerate((pa.int32(), pa.string(), pa.int64(), pa.int64()))],
            ["shard", "path", "n_docs", "n_ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    coded = rows.mapInArrow(encode, "shard int, doc_id long, ids binary")
    manifest = (coded.repartition(n, "shard").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "ids")
                .mapInArrow(write, "shard int, path string, n_docs long, n_ids long"))
    return stage(spark, manifest, "token-manifest")


def read_store(manifest: DataFrame, root: str) -> DataFrame:
    """Documents of a store, from its files: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32 (crc32 of the ids as little-endian 32-bit integers)."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def rows(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in frames:
            for path, base in zip(f.column("path").to_pylist(), f.column("base").to_pylist()):
                shard = Shard(f"{root}/{path}")
                starts, sizes, crcs = [], [], []
                for start, ids in shard.documents():
                    starts.append(base + start)
                    sizes.append(len(ids))
                    crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in (shard.doc_ids(), starts, sizes, crcs)],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (placed.select("path", "base").repartition(n, "path")
            .mapInArrow(rows, "doc_id long, start long, n_tokens long, ids_crc32 long"))


TOKENIZER, END_ID = "word_bpe_49k.json", 2


def token_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write ``docs`` to a new store in the shared folder and return its documents from the files."""
    import public_tokenizers
    root = scratch_path(spark, "token-store")
    manifest = write_store(docs, root, public_tokenizers.path(TOKENIZER), END_ID)
    return read_store(manifest, root)


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``."""
    return token_rows(spark, read(spark, sf_dir, "documents"))


QUERIES = {"op3_token_store": op3_token_store}
ORACLES: dict[str, str] = {}
