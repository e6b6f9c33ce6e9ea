"""Extraction high-water marks as an append-only state table.

Each successful run appends ``(source, last_extracted, run_id)``; the current
mark of a source is its latest value. A missing table or source gives the
initial mark ``1900-01-01 00:00:00``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tessera import config as C
from tessera.schemas import WATERMARK

SOURCES = ("ris", "pacs", "epr")


class WatermarkState:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def table(self) -> DataFrame:
        try:
            return self.spark.read.schema(WATERMARK).parquet(self.path)
        except AnalysisException:
            return self.spark.createDataFrame([], WATERMARK)

    def current(self) -> dict[str, str]:
        """Latest mark per source (a few rows, so collected)."""
        rows = (self.table().groupBy("source").agg(F.max("last_extracted").alias("wm"))
                .collect())
        marks = {s: C.INITIAL_WATERMARK for s in SOURCES}
        for r in rows:
            if r["wm"] is not None:
                marks[r["source"]] = r["wm"].isoformat(sep=" ")
        return marks

    def save(self, marks: DataFrame, run_id: str) -> None:
        """K6: append the marks ``(source, last_extracted)`` of a loaded batch."""
        (marks.select("source", "last_extracted", F.lit(run_id).alias("run_id"))
         .write.mode("append").parquet(self.path))
