"""Exact dedup as a stateful stream over the document files.

A streaming aggregation keyed by the digest of the normalised text keeps, per
digest and without expiry, the stable identifier (largest doc_id), the content
locator (file and row position of that document) and the number of rows seen.
The state lives in RocksDB on disk and is snapshotted to the shared folder, so
later loads of the same source folder only read files that are new.

A digest alone never decides: every row that hits an existing digest is
compared, byte for byte, with the text at the retained locator. Digests whose
bytes differ (collisions) are regrouped by the texts themselves.

DataFrame and SQL functions only; Python runs on the driver alone.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import LOWER, UPPER, lower_ascii, read, stage
from tessera.session import scratch_path, table_path

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # One bounded cache per executor instead of one per open partition.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Many small stores: without this each one reserves megabytes of disk ahead.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: Rows of one digest that one task compares with the retained text.
ROWS_PER_SALT = 5000


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@contextmanager
def _session_conf(spark: SparkSession, conf: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _located(df: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    norm = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    return df.select(
        F.col(id_col).alias("doc_id"), norm.alias("norm"),
        F.struct(F.col("_metadata.file_path").alias("file"),
                 F.col("_metadata.row_index").alias("row")).alias("at"),
    ).withColumn("digest", digest(F.col("norm")))


def update_state(spark: SparkSession, path: str, schema: T.StructType, state_dir: str, *,
                 id_col: str = "doc_id", text_col: str = "text",
                 digest: Callable[[Column], Column] = sha256_hex,
                 max_bytes_per_trigger: int = 256 << 30, max_files_per_trigger: int | None = None) -> None:
    """Feed the files under ``path`` that the state has not seen into it.

    Each micro-batch takes up to ``max_bytes_per_trigger`` and writes the digests it
    changed to ``<state_dir>/ledger/batch=<n>``; a replayed batch overwrites its folder.
    """
    reader = (spark.readStream.schema(schema)
              .option("maxFileAge", "36500d"))  # a file's age never hides it
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    else:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    kept = F.max(F.struct("doc_id", "at"))
    # The stream source takes a plain path as a directory; a pattern may name one file too.
    path = path.rstrip("/")
    state = (_located(reader.parquet(f"{path[:-1]}[{path[-1]}]"), id_col, text_col, digest)
             .groupBy("digest").agg(kept.alias("kept"), F.count(F.lit(1)).alias("n")))

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{state_dir}/ledger/batch={batch_id}")

    with _session_conf(spark, STATE_CONF):
        query = (state.writeStream.outputMode("update").foreachBatch(publish)
                 .option("checkpointLocation", f"{state_dir}/checkpoint")
                 .trigger(availableNow=True).start())
        query.awaitTermination()


def read_state(spark: SparkSession, state_dir: str, schema: T.StructType, id_col: str = "doc_id") -> DataFrame:
    """The newest entry of each digest: digest, kept (doc_id, at), n."""
    ledger = T.StructType([
        T.StructField("digest", T.StringType()),
        T.StructField("kept", T.StructType([
            T.StructField("doc_id", schema[id_col].dataType),
            T.StructField("at", T.StructType([T.StructField("file", T.StringType()),
                                              T.StructField("row", T.LongType())]))])),
        T.StructField("n", T.LongType()), T.StructField("batch", T.LongType())])
    empty = spark.createDataFrame([], ledger).where(F.lit(False))
    try:
        found = spark.read.schema(ledger).parquet(f"{state_dir}/ledger")
    except Exception as e:  # no file was ever read, so no batch was written
        if "PATH_NOT_FOUND" not in str(e):
            raise
        found = empty
    return (found.groupBy("digest").agg(F.max(F.struct("batch", "kept", "n")).alias("s"))
            .select("digest", "s.kept", "s.n"))


def exact_dedup(spark: SparkSession, path: str, state_dir: str, *, id_col: str = "doc_id",
                text_col: str = "text", digest: Callable[[Column], Column] = sha256_hex,
                max_bytes_per_trigger: int = 256 << 30,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """One row per row under the Parquet ``path``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z only; of equal texts the row
    with the largest doc_id stays. A null text counts as empty, so empty and null texts
    are one group. A null doc_id ranks below all others. Repeated rows (same doc_id and
    text) are a group like any other: the one at the last position stays. Extra columns
    are not read. An empty table gives no rows. Very long texts are digested and compared
    whole. ``text_sha256`` is the SHA-256 of the normalised text whatever ``digest`` is.
    """
    schema = spark.read.parquet(path).schema
    schema = T.StructType([f for f in schema.fields if f.name in (id_col, text_col)])
    update_state(spark, path, schema, state_dir, id_col=id_col, text_col=text_col, digest=digest,
                 max_bytes_per_trigger=max_bytes_per_trigger,
                 max_files_per_trigger=max_files_per_trigger)
    # A table of its own, so that a hot digest's rows can be split in the join.
    state = stage(spark, read_state(spark, state_dir, schema, id_col), "exact-ledger")
    docs = _located(spark.read.schema(schema).parquet(path), id_col, text_col, digest)

    # Narrow join on the digest: ids and positions only, no text.
    sha = F.col("digest") if digest is sha256_hex else sha256_hex(F.col("norm"))
    resolved = stage(spark, docs.select("doc_id", "at", "digest", sha.alias("text_sha256"))
                     .join(state, "digest"), "exact-resolved")

    # Full bytes of the rows in groups of two and more, once, beside the shared state.
    hits = resolved.where(F.col("n") > 1).select("at", "digest", "kept", "n")
    texts = stage(spark, docs.select("at", "norm", "doc_id").join(hits, "at"), "exact-hits")
    salts = F.ceil(F.col("n") / F.lit(ROWS_PER_SALT)).cast("int")
    retained = (texts.where(F.col("at") == F.col("kept.at"))
                .select("digest", F.col("norm").alias("kept_norm"),
                        F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt")))
    others = (texts.where(F.col("at") != F.col("kept.at"))
              .withColumn("salt", F.pmod(F.xxhash64("at"), salts).cast("int")))
    collided = (others.join(retained, ["digest", "salt"])
                .where(F.col("norm") != F.col("kept_norm")).select("digest").distinct())

    # Colliding digests: the texts themselves are the key (hash-partitioned on both,
    # copies collapse map-side in the aggregate).
    clashing = texts.join(collided, "digest", "left_semi")
    by_text = clashing.groupBy("digest", "norm").agg(
        F.max(F.struct("doc_id", "at")).alias("kept"), F.count(F.lit(1)).alias("n"))
    regrouped = (clashing.select("at", "doc_id", "digest", "norm")
                 .join(by_text, ["digest", "norm"])
                 .select("doc_id", "at", sha256_hex(F.col("norm")).alias("text_sha256"), "kept", "n"))
    agreed = (resolved.join(collided, "digest", "left_anti")
              .select("doc_id", "at", "text_sha256", "kept", "n"))
    return agreed.unionByName(regrouped).select(
        "doc_id", F.col("kept.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("at") == F.col("kept.at")).alias("kept"), "text_sha256")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` through a fresh state."""
    return exact_dedup(spark, table_path(sf_dir, "documents"), scratch_path(spark, "exact-state"))


ORACLE = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""

QUERIES = {"op1_exact_dedup": op1_exact_dedup}
ORACLES = {"op1_exact_dedup": ORACLE}
