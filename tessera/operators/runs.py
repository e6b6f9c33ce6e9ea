"""A2: run summaries.

``step_counts`` derives the per-step record flow of one batch run from the
data itself (deterministic, one aggregate). ``history_rows`` turns measured
step timings of :func:`tessera.plans.batch.run_batch` into rows of the run
history table; ``status_counts`` and ``slowest_steps`` query that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.quality import FLAG_V01, FLAG_V02

STEPS = ("extract", "validate", "transform", "load")


def step_counts(studies: DataFrame, flagged: DataFrame, inserted: DataFrame | None = None
                ) -> DataFrame:
    """``(step_no, task_id, status, records_in, records_out)`` of one run.

    ``flagged`` is the extracted studies with rule flags; every validated row
    becomes one fact row, and ``inserted`` (one row, column ``inserted``) gives
    the rows the load appended (all of them on a first load)."""
    total = studies.agg(F.count(F.lit(1)).alias("v"))
    f = flagged.agg(F.count(F.lit(1)).alias("extracted"),
                    F.count_if(~F.col(FLAG_V01) & ~F.col(FLAG_V02)).alias("valid"))
    ins = (inserted.select(F.col("inserted").cast("bigint").alias("inserted"))
           if inserted is not None else f.select(F.col("valid").alias("inserted")))
    # Each piece is a one-row aggregate; unioning them as (name, value)
    # pairs and pivoting back avoids any cartesian product.
    pairs = (total.select(F.lit("studies").alias("k"), F.col("v"))
             .unionByName(f.select(F.lit("extracted").alias("k"), F.col("extracted").alias("v")))
             .unionByName(f.select(F.lit("valid").alias("k"), F.col("valid").alias("v")))
             .unionByName(ins.select(F.lit("inserted").alias("k"), F.col("inserted").alias("v"))))
    wide = pairs.groupBy().pivot("k", ["studies", "extracted", "valid", "inserted"]).agg(
        F.first("v"))
    return wide.selectExpr(
        "stack(4, "
        "1, 'extract', studies, extracted, "
        "2, 'validate', extracted, valid, "
        "3, 'transform', valid, valid, "
        "4, 'load', valid, inserted) AS (step_no, task_id, records_in, records_out)"
    ).select(F.col("step_no").cast("int"), "task_id", F.lit("SUCCESS").alias("status"),
             F.col("records_in").cast("bigint"), F.col("records_out").cast("bigint"))


def history_rows(spark: SparkSession, run_id: str, tasks: list[dict]) -> DataFrame:
    """Run-history rows from the driver's per-step records (one per step)."""
    rows = [(run_id, t["task_id"], t["status"], int(t.get("attempts", 1)),
             float(t["seconds"]) if t.get("seconds") is not None else None)
            for t in tasks]
    return spark.createDataFrame(
        rows, "run_id string, task_id string, status string, attempts int, seconds double")


def status_counts(history: DataFrame) -> DataFrame:
    return history.groupBy("status").agg(F.count(F.lit(1)).alias("tasks"),
                                         F.count_distinct("run_id").alias("runs"))


def slowest_steps(history: DataFrame, k: int = 1) -> DataFrame:
    """The k slowest steps of each run (``row_number <= k`` is a group limit)."""
    w = Window.partitionBy("run_id").orderBy(F.desc_nulls_last("seconds"), "task_id")
    return (history.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k).drop("rank"))
