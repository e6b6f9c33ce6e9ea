"""Incremental warehouse on parquet.

* Dimensions are type-1 upserted (L1) into a **new version**: each dimension
  is one parquet table partitioned by ``version``; a load appends the next
  version, then publishes it in a one-column table beside it; readers take the
  last published one. The path being read is never overwritten, and a write that
  dies half way leaves the previous version current.
* The fact is append-only (L2): a batch is anti-joined with the study keys
  already loaded, so replaying a batch inserts nothing. Key filters that every
  load keeps (:mod:`tessera.operators.key_sketch`) name the partitions that may
  hold a key of the batch; of these, only the key column is read. It is written
  partitioned by ``partition_key`` (L3).
* Audit rows (K8) are appended with a deterministic ``log_id`` and anti-joined
  on it, so a replayed micro-batch does not log twice.

The pure operators (``upsert_type1``, ``append_new``, ``append_counts``,
``orphan_keys``, ``duplicate_keys``) take and return DataFrames; the
:class:`Warehouse` class only adds the reads and writes.
"""

from __future__ import annotations

import datetime as dt
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tessera import config as C
from tessera.operators.key_sketch import KeySketches
from tessera.schemas import WAREHOUSE

if TYPE_CHECKING:
    from tessera.plans.kpi_parts import KpiParts

VERSION_COL = "version"
PUBLISHED = "_published"


def upsert_type1(existing: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """L1: the batch replaces existing rows with the same key and adds new
    keys; existing rows with other keys are kept."""
    kept = existing.join(batch.select(key), key, "left_anti")
    return kept.unionByName(batch.select(*existing.columns))


def append_new(fact: DataFrame, batch: DataFrame, key: str = "study_id") -> DataFrame:
    """L2: batch rows whose key is not loaded yet; a null key equals a null key."""
    return batch.join(_loaded_keys(fact, key), batch[key].eqNullSafe(F.col("_lk")), "left_anti")


def _loaded_keys(fact: DataFrame, key: str) -> DataFrame:
    return fact.select(F.col(key).alias("_lk"), F.lit(True).alias("_loaded"))


def append_counts(fact: DataFrame, batch: DataFrame, key: str = "study_id") -> DataFrame:
    """L2 counts ``(records_in, inserted, skipped)`` in one pass: the batch
    left-joined to the loaded keys (unique, they are the primary key)."""
    j = batch.select(key).join(_loaded_keys(fact, key), F.col(key).eqNullSafe(F.col("_lk")), "left")
    return j.agg(F.count(F.lit(1)).alias("records_in"),
                 F.count_if(F.col("_loaded").isNull()).alias("inserted"),
                 F.count_if(F.col("_loaded").isNotNull()).alias("skipped"))


def append_fact(fact: DataFrame, batch: DataFrame, key: str = "study_id") -> DataFrame:
    """The fact after an append: loaded rows plus the new batch rows."""
    return fact.unionByName(append_new(fact, batch, key))


def audit_row(counts: DataFrame, run_id: str, run_ts: str, step: str = "LOAD",
              action: str = "FACT_APPEND", seq: int = 1) -> DataFrame:
    """K8: the load audit row from the append counts."""
    return counts.select(
        F.lit(f"{run_id}-{seq:03d}").alias("log_id"),
        F.lit(run_ts).cast("timestamp_ntz").alias("event_time"),
        F.lit(step).alias("pipeline_step"),
        F.lit(action).alias("action"),
        F.col("records_in").cast("bigint").alias("records_in"),
        F.col("inserted").cast("bigint").alias("records_out"),
        F.lit(C.SERVICE_ACCOUNT).alias("user_account"),
        F.lit("SUCCESS").alias("status"),
        F.concat(F.lit("skipped="), F.col("skipped").cast("string")).alias("notes"),
    )


def orphan_keys(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per foreign key, fact rows (and distinct keys) whose member is
    missing from its dimension.

    One pass over the fact: each row is unpivoted into ``(fk_column, key)``
    pairs and counted (partial aggregation keeps only distinct pairs per
    task), then one anti-join against the union of the dimensions' keys."""
    fks = list(dims)
    pairs = fact.select(F.explode(F.array(*[
        F.struct(F.lit(fk).alias("fk_column"), F.col(fk).cast("bigint").alias("_k"))
        for fk in fks])).alias("p")).select("p.*")
    per_key = pairs.groupBy("fk_column", "_k").agg(F.count(F.lit(1)).alias("_n"))
    members = None
    for fk, (dim, pk) in dims.items():
        m = dim.select(F.lit(fk).alias("fk_column"), F.col(pk).cast("bigint").alias("_k"))
        members = m if members is None else members.unionByName(m)
    missing = per_key.join(members, ["fk_column", "_k"], "left_anti")
    names = fact.sparkSession.createDataFrame([(fk,) for fk in fks], "fk_column string")
    found = missing.groupBy("fk_column").agg(F.sum("_n").cast("bigint").alias("orphan_rows"),
                                             F.count(F.lit(1)).alias("orphan_keys"))
    # every foreign key gets a row, zero when nothing is missing
    return (names.join(found, "fk_column", "left")
            .select("fk_column",
                    F.coalesce("orphan_rows", F.lit(0).cast("bigint")).alias("orphan_rows"),
                    F.coalesce("orphan_keys", F.lit(0).cast("bigint")).alias("orphan_keys")))


def duplicate_keys(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per table, keys that occur more than once and the rows they hold."""
    out = None
    for name, (df, pk) in tables.items():
        per_key = df.groupBy(pk).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
        row = per_key.agg(F.lit(name).alias("table_name"),
                          F.count(F.lit(1)).alias("duplicate_keys"),
                          F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("duplicate_rows"))
        out = row if out is None else out.unionByName(row)
    return out


def key_collisions(df: DataFrame, naturals: dict[str, str], key_fn) -> DataFrame:
    """H5: surrogate keys shared by more than one natural value, per
    dimension ``{dimension: natural column}``; one unpivot and one aggregate."""
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(dim).alias("dimension"), F.col(col).cast("string").alias("value"))
        for dim, col in naturals.items()])).alias("p")).select("p.*").where(
        F.col("value").isNotNull())
    return (pairs.groupBy("dimension", key_fn(F.col("value")).alias("surrogate_key"))
            .agg(F.count_distinct("value").alias("members"))
            .where(F.col("members") > 1))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)``."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        out = row if out is None else out.unionByName(row)
    return out


class Warehouse:
    """Parquet warehouse under ``root`` (a folder of the shared file system)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _read(self, table: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self.path(table))
        except AnalysisException:
            return None

    def initialise(self) -> None:
        """K5: create every table that does not exist yet, empty, with its schema."""
        for name, (schema, _pk) in WAREHOUSE.items():
            if self._read(name) is None:
                empty = self.spark.createDataFrame([], schema)
                if name.startswith("dim_"):
                    empty = empty.withColumn(VERSION_COL, F.lit("0"))
                    empty.write.mode("append").partitionBy(VERSION_COL).parquet(self.path(name))
                    self._publish(name, "0")
                elif name == "fact_radiology":
                    empty.write.mode("append").partitionBy("partition_key").parquet(self.path(name))
                else:
                    empty.write.mode("append").parquet(self.path(name))

    def table(self, name: str) -> DataFrame:
        """Current contents; for a dimension, its highest version."""
        schema, _ = WAREHOUSE[name]
        df = self._read(name)
        if df is None:
            return self.spark.createDataFrame([], schema)
        if name.startswith("dim_"):
            latest = self.spark.read.parquet(self.path(f"{name}{PUBLISHED}")).select(F.max(VERSION_COL)).scalar()
            return df.where(F.col(VERSION_COL) == latest).drop(VERSION_COL)
        return df.select(*schema.fieldNames())

    def upsert_dimension(self, name: str, batch: DataFrame, version: str) -> int:
        """L1 as a new version; returns the batch rows upserted. An empty
        batch is a no-op (no version is written) and returns 0."""
        _, pk = WAREHOUSE[name]
        from tessera.session import shared_dir
        shared_dir(self.spark)
        batch = batch.checkpoint(eager=True)  # counted and merged from one computation
        n = batch.count()
        if n == 0:
            return 0
        merged = upsert_type1(self.table(name), batch, pk)
        # Versions sort by write time whatever the run id looks like.
        stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")
        new = f"{stamp}_{version}"
        (merged.withColumn(VERSION_COL, F.lit(new))
         .write.mode("append").partitionBy(VERSION_COL).parquet(self.path(name)))
        self._publish(name, new)
        return n

    def _publish(self, name: str, version: str) -> None:
        """Make a fully written version the one that readers take."""
        (self.spark.range(1).select(F.lit(version).alias(VERSION_COL)).coalesce(1)
         .write.mode("append").parquet(self.path(f"{name}{PUBLISHED}")))

    def _staged(self, df: DataFrame, name: str) -> DataFrame:
        """Written to the shared folder and read back. An eager checkpoint would compute ``df`` twice."""
        from tessera.session import scratch_path
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def fact_keys(self) -> KeySketches:
        return KeySketches(self.spark, f"{self.root}/_fact_keys", "study_id", "partition_key")

    def append_fact(self, batch: DataFrame, parts: KpiParts | None = None, load_id: str = "") -> dict:
        """L2 + L3: append the new rows, range-partitioned on
        ``(partition_key, study_id)`` so a month holding a third of the batch
        is split over many writers while each writer touches few folders.

        The loaded keys are read once, and only in partitions whose key filters
        pass a key of the batch: the batch is left-joined to them
        (keys are unique, the fact's primary key) and that batch-sized result
        is written to the shared folder; counts and new rows both come from it. Returns
        ``{records_in, inserted, skipped}``, taken before the write (the write
        refreshes every plan that reads the fact folder). ``parts`` keeps the KPI sums
        of the new rows under ``load_id``; a load without new rows adds none."""
        fact, keys = self.table("fact_radiology"), self.fact_keys()
        keys.settle(fact)
        batch = self._staged(batch, "load-batch")  # probed, then joined
        known = _loaded_keys(keys.may_hold(fact, batch), "study_id")
        marked = self._staged(batch.join(known, F.col("study_id").eqNullSafe(F.col("_lk")), "left"), "load-marked")
        counts = marked.agg(F.count(F.lit(1)).alias("records_in"),
                            F.count_if(F.col("_loaded").isNull()).alias("inserted"),
                            F.count_if(F.col("_loaded").isNotNull()).alias("skipped")
                            ).first().asDict()
        new = marked.where(F.col("_loaded").isNull()).select(*batch.columns)
        if parts and counts["inserted"]:
            parts.add(new, load_id)
        if counts["inserted"]:
            keys.add(new)
        (new.repartitionByRange("partition_key", "study_id")
         .write.mode("append").partitionBy("partition_key").parquet(self.path("fact_radiology")))
        if parts and counts["inserted"]:
            parts.publish(load_id)
        return counts

    def counts_frame(self, counts: dict) -> DataFrame:
        return self.spark.createDataFrame(
            [(counts["records_in"], counts["inserted"], counts["skipped"])],
            "records_in bigint, inserted bigint, skipped bigint")

    def register_views(self, prefix: str = "") -> list[str]:
        """The current tables as temporary views for ad-hoc ``spark.sql``."""
        names = []
        for name in WAREHOUSE:
            self.table(name).createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        return names

    def append_audit(self, rows: DataFrame) -> None:
        logged = self.table("audit_log").select("log_id")
        rows.join(logged, "log_id", "left_anti").write.mode("append").parquet(self.path("audit_log"))

    def append_errors(self, rows: DataFrame) -> None:
        logged = self.table("error_table").select("error_id")
        rows.join(logged, "error_id", "left_anti").write.mode("append").parquet(
            self.path("error_table"))
