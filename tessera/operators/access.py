"""A1: bulk access review against the role -> permission table.

The source checks one (role, permission) pair before a write; here the same
rule is a join so a whole request log is reviewed at once. Unknown roles get
no permission and are denied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import config as C


def role_permissions(spark: SparkSession, roles=C.ROLE_PERMISSIONS) -> DataFrame:
    """``(role, permission)``: one row per granted pair (8 for the default)."""
    rows = [(role, perm) for role, perms in roles.items() for perm in perms]
    return spark.createDataFrame(rows, "role string, permission string")


def review(requests: DataFrame, permissions: DataFrame) -> DataFrame:
    """Each request with ``granted``. The permission table is a fixed
    configuration of a few rows, so it is broadcast."""
    perms = F.broadcast(permissions.select(
        F.col("role").alias("_role"), F.col("permission").alias("_perm"),
        F.lit(True).alias("_granted")).distinct())
    j = requests.join(perms, (requests["role"] == perms["_role"])
                      & (requests["required_permission"] == perms["_perm"]), "left")
    return j.select(*requests.columns,
                    F.coalesce(F.col("_granted"), F.lit(False)).alias("granted"))


def review_summary(requests: DataFrame, permissions: DataFrame) -> DataFrame:
    """``(role, required_permission, granted, request_count)``: requests are
    counted per pair first, so only distinct pairs meet the permission table."""
    pairs = requests.groupBy("role", "required_permission").agg(
        F.count(F.lit(1)).alias("request_count"))
    return review(pairs, permissions).select("role", "required_permission", "granted",
                                             "request_count")


def audit_rows(refused: DataFrame, run_id: str, run_ts: str) -> DataFrame:
    """Audit-log rows of refused requests; the id carries the run and the request."""
    return refused.select(
        F.concat(F.lit(f"{run_id}-ACCESS-"), F.col("request_id").cast("string")).alias("log_id"),
        F.lit(run_ts).cast("timestamp_ntz").alias("event_time"), F.lit("ACCESS").alias("pipeline_step"),
        F.col("required_permission").alias("action"), F.lit(1).cast("bigint").alias("records_in"),
        F.lit(0).cast("bigint").alias("records_out"), F.col("role").alias("user_account"),
        F.lit("DENIED").alias("status"), F.concat(F.lit("role="), F.col("role")).alias("notes"))


def denied(requests: DataFrame, permissions: DataFrame) -> DataFrame:
    """Denied requests, the rows that go to the audit log."""
    return review(requests, permissions).where(~F.col("granted"))
