"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import stage


def _rows(df: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """Rows (u, v) from each pair of columns, in one pass over ``df``."""
    both = F.array(*[F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in pairs])
    return df.select(F.explode(both).alias("p")).select("p.u", "p.v")


def _round(now: DataFrame) -> DataFrame:
    """Links (u, v), u > v, after a large-star and a small-star step: three shuffles."""
    least = F.min("v").over(Window.partitionBy("u"))
    # Large star: neighbours above a node go to the least of its neighbourhood.
    large = (_rows(now, ("u", "v"), ("v", "u")).withColumn("m", F.least("u", least)).where("v > u")
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    # Small star: a node and its neighbours below go to the least of these.
    return _rows(large.withColumn("m", least), ("u", "m"), ("v", "m")).where("u != v").distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); the root is the smallest node of its component.

    Every node ends as a direct neighbour of its root. Each round is two minima over the links
    of a node and is written to the shared folder; the number of rounds grows with the logarithm
    of the longest chain. Only two figures per round reach the driver.
    """
    now, before = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), None
    while True:
        now = stage(spark, now, "links")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before:
            return stage(spark, _rows(now, ("u", "v"), ("v", "v")).select(
                F.col("u").alias("node"), F.col("v").alias("root")).distinct(), "classes")
        now, before = _round(now), seen
