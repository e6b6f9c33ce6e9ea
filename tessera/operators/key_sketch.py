"""L2 with key sketches: which partitions of a table may hold a key of a batch.

Each load appends, for the rows it is about to insert, one split Bloom filter per partition:
a key falls into one block of eight 64-bit words and sets two bits in each of them. A block
is one row, made with ``bit_or``; blocks without keys have none. Filters of one load and
partition have a power of two of blocks, by the number of its rows.

A filter is written before its rows and never replaced, so the filters of a partition cover
all its keys whatever write died in between; more filters than rows only mean that a
partition is read for nothing. A table that was loaded before filters were kept gets them
by :meth:`KeySketches.settle`.

At 48 bits a key, a key that a filter does not hold passes it about once in 10 million
times, so a batch of a million new keys leaves most old partitions unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

WORDS = 8
BITS_PER_KEY = 48
MAX_SIZE = 40


def _power(of: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), of)


def _block(key: str, size: Column) -> Column:
    """The key's block among 2 ** size; the low bits of its hash."""
    return F.xxhash64(F.col(key), F.lit("block")).bitwiseAND(_power(size) - 1)


def _hashes(key: str) -> list[Column]:
    """Where the bits of :func:`_masks` come from."""
    return [F.xxhash64(F.col(key), F.lit(seed)) for seed in ("bits a", "bits b")]


def _masks(hashes: list[Column]) -> list[Column]:
    """The two bits that a key sets in each word: six hash bits each."""
    def bit(h: Column, at: int) -> Column:
        return _power(F.shiftrightunsigned(h, at).bitwiseAND(F.lit(63).cast("bigint")).cast("int"))

    return [bit(hashes[i // 4], 12 * (i % 4)).bitwiseOR(bit(hashes[i // 4], 12 * (i % 4) + 6)) for i in range(WORDS)]


def sketch(rows: DataFrame, key: str, part: str, bits_per_key: int = BITS_PER_KEY) -> DataFrame:
    """Filters of ``rows``: ``(part, size, block, w0 .. w7)``. Any key type that can be hashed;
    a null key counts as a key, a null partition as a partition."""
    keys = rows.select(F.col(part).alias("part"), F.col(key).alias("_k"))
    blocks = F.count(F.lit(1)) * bits_per_key / (64 * WORDS)
    sizes = keys.groupBy("part").agg(
        F.least(F.greatest(F.ceil(F.log2(blocks)), F.lit(0)), F.lit(MAX_SIZE)).cast("int").alias("size"))
    sized = keys.join(F.broadcast(sizes.withColumnRenamed("part", "_p")), F.col("part").eqNullSafe(F.col("_p"))).drop("_p")
    bits = sized.select("part", "size", _block("_k", F.col("size")).alias("block"),
                        *[m.alias(f"w{i}") for i, m in enumerate(_masks(_hashes("_k")))])
    return bits.groupBy("part", "size", "block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def hits(sketches: DataFrame, batch: DataFrame, key: str, sizes: list[int]) -> DataFrame:
    """``(part, key)`` for the batch's keys and the partitions that may hold them: an equal join on
    size and block, then sixteen bits. ``sizes`` are the filter sizes in use.

    A probe meets a block of every filter of its size, so the work is many times the bytes that
    are shuffled: keys are hashed before the join, and as a number of partitions is given and no
    side is broadcast, small ones are not merged into a few tasks."""
    n = int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = batch.select(F.col(key).alias("_k")).distinct()
    probes = keys.select("_k", F.explode(F.array(*[F.lit(s) for s in sizes])).alias("size"))
    probes = probes.select("_k", "size", _block("_k", F.col("size")).alias("block"),
                           *[h.alias(f"_h{i}") for i, h in enumerate(_hashes("_k"))])
    met = probes.repartition(n, "size", "block").join(sketches.hint("merge"), ["size", "block"])
    for i, mask in enumerate(_masks([F.col("_h0"), F.col("_h1")])):
        met = met.where(F.col(f"w{i}").bitwiseAND(mask) == mask)
    return met.select("part", F.col("_k").alias(key))


class KeySketches:
    """The filters of a table under a folder of the shared file system: ``filters``, ``settled``."""

    def __init__(self, spark: SparkSession, root: str, key: str, part: str, bits_per_key: int = BITS_PER_KEY):
        self.spark, self.root, self.key, self.part = spark, root.rstrip("/"), key, part
        self.bits_per_key = bits_per_key

    def _read(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.root}/{name}")
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def add(self, rows: DataFrame) -> None:
        """The filters of rows that are about to be inserted; ranges of blocks stay together, so
        that a probe of few keys skips row groups."""
        (sketch(rows, self.key, self.part, self.bits_per_key).repartitionByRange("size", "block")
         .sortWithinPartitions("size", "block").write.mode("append").parquet(f"{self.root}/filters"))

    def settle(self, table: DataFrame) -> None:
        """Before a load: unless the filters cover the table already, those of all its rows."""
        if self._read("settled") is None:
            self.add(table)
            self.spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/settled")

    def partitions(self, batch: DataFrame) -> list:
        """Partitions that may hold a key of the batch. Only the list of partition values comes
        to the driver, which a table's folders bound."""
        kept = self._read("filters")
        if kept is None or self._read("settled") is None:
            raise ValueError(f"no key filters under {self.root}: call settle first")
        sizes = [r["size"] for r in kept.select("size").distinct().collect()]
        if not sizes:
            return []
        return [r.part for r in hits(kept, batch, self.key, sizes).select("part").distinct().collect()]

    def may_hold(self, table: DataFrame, batch: DataFrame) -> DataFrame:
        """The rows of the partitions that may hold a key of the batch; a literal filter on the
        partition column, so other folders are never opened."""
        parts = self.partitions(batch)
        named = [p for p in parts if p is not None]
        keep = F.col(self.part).isin(named) if named else F.lit(False)
        return table.where(keep | F.col(self.part).isNull() if None in parts else keep)

