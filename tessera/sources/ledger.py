"""Ledger of loaded export files: what a run has to read follows from the files, not from event times.

A watermark alone loses rows that arrive late with an event time at or before the mark,
and reads files again that hold nothing new. The ledger names every file that a finished
run has loaded by path, length and modification time; a file that is not in it, or has
changed since, is read whole. Loads skip rows that are in the warehouse already, so a
file read twice, because a run died or the file grew, adds only what is new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tessera.schemas import FILE_LEDGER


def listed(spark: SparkSession, source: str, export: str) -> DataFrame:
    """Files of an export (a file, folder or glob): source, path, length, modified. No content is read."""
    return spark.read.format("binaryFile").load(export).select(
        F.lit(source).alias("source"), "path", "length", F.col("modificationTime").alias("modified"))


class FileLedger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def table(self) -> DataFrame:
        try:
            return self.spark.read.schema(FILE_LEDGER).parquet(self.path)
        except AnalysisException:
            return self.spark.createDataFrame([], FILE_LEDGER)

    def unseen(self, exports: dict[str, str]) -> list[Row]:
        """Files that no run has loaded as they are now, in path order; names with pattern
        characters are an error.

        The list goes to the driver, as the reader that is to open these files holds
        their names there too; it has the files since the last run only."""
        files = None
        for source, export in exports.items():
            some = listed(self.spark, source, export)
            files = some if files is None else files.unionByName(some)
        rows = files.join(self.table(), ["source", "path", "length", "modified"], "left_anti").orderBy("source", "path").collect()
        # Spark's reader takes the names it is given as patterns.
        if odd := [r.path for r in rows if set(r.path) & set("[]{}*?\\")]:
            raise ValueError(f"file names with pattern characters: {odd}")
        return rows

    def save(self, files: list[Row], run_id: str) -> None:
        """Add the files of a finished run, as they were listed before it read them."""
        rows = self.spark.createDataFrame([(f.source, f.path, f.length, f.modified, run_id) for f in files], FILE_LEDGER)
        rows.coalesce(1).write.mode("append").parquet(self.path)
