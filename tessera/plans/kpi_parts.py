"""K9, Q1-Q8 kept incrementally: partial sums per load, merged when a KPI is asked for.

Each load adds, for the fact rows it inserts, one row per combination of the columns that
the KPIs group by (counts, exact sums) and bitmaps of its radiologists' keys, 32,768 keys
to a bitmap. Sums add and bitmaps are or-ed, so KPIs of all loads need neither the fact nor
the order of the loads, and the distinct count stays exact.

A load's parts are written before its fact rows, under the load's id, and count from when
the load is published after them. A load that is run again replaces its own parts. What a
crash between the two writes leaves unpublished is settled by :meth:`KpiParts.settle`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tessera.plans import kpis
from tessera.schemas import FACT_RADIOLOGY

KEYS = ("modality_key", "location_key", "tat_band", "priority", "tat_flag", "year_month")


def measures(fact: DataFrame) -> DataFrame:
    """Partial sums of fact rows by everything that a KPI groups or filters by."""
    return fact.withColumn("year_month", kpis.year_month()).groupBy(*KEYS).agg(*kpis._parts())


def radiologist_bits(fact: DataFrame) -> DataFrame:
    """Bitmaps of the radiologist keys of studies with an OK turnaround."""
    key = F.col("radiologist_key")
    return (fact.where((F.col("tat_flag") == "OK") & key.isNotNull()).groupBy(F.bitmap_bucket_number(key).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bitmap")))


class KpiParts:
    """The kept parts under a folder: ``measures/load=..``, ``radiologists/load=..``, ``published``."""

    TABLES = {"measures": measures, "radiologists": radiologist_bits}

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def add(self, rows: DataFrame, load_id: str) -> None:
        """The parts of the fact rows that a load is about to insert."""
        for name, of in self.TABLES.items():
            of(rows).write.mode("overwrite").parquet(f"{self.root}/{name}/load={load_id}")

    def publish(self, load_id: str) -> None:
        """Count a load from now on, once however often it is published."""
        self._list([(load_id, True)], "append")

    def _list(self, loads: list[tuple[str, bool]], mode: str) -> None:
        self.spark.createDataFrame(loads, "load string, counted boolean").write.mode(mode).parquet(f"{self.root}/published")

    def _read(self, path: str) -> DataFrame | None:
        try:
            return self.spark.read.option("basePath", f"{self.root}/{path}").parquet(f"{self.root}/{path}")
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def table(self, name: str) -> DataFrame:
        """The rows of all published loads; none before the first."""
        df, listed = self._read(name), self._read("published")
        if df is None or listed is None:
            return self.TABLES[name](self.spark.createDataFrame([], FACT_RADIOLOGY))
        counted = listed.where("counted").select("load").distinct()
        return df.withColumn("load", F.col("load").cast("string")).join(counted, "load", "left_semi").drop("load")

    def settle(self, fact: DataFrame) -> None:
        """Before a load: if the parts may not equal the fact (rows from before they were kept, or
        a load that died before it was published), take them from the whole fact anew and count
        no other load."""
        df, listed = self._read("measures"), self._read("published")
        if df is None and fact.isEmpty():
            return
        loads = [r.load for r in df.select(F.col("load").cast("string")).distinct().collect()] if df is not None else []
        known = {r.load for r in listed.select("load").distinct().collect()} if listed is not None else set()
        if df is not None and known.issuperset(loads):
            return
        base = f"settled-{uuid.uuid4().hex}"
        self.add(fact, base)
        self._list([(base, True), *((x, False) for x in loads)], "overwrite")

    def kpis(self, dim_modality: DataFrame, dim_location: DataFrame) -> dict[str, DataFrame]:
        """All KPI tables; reads the parts and two dimensions only."""
        return kpis.all_kpis(self.table("measures"), dim_modality, dim_location, self.table("radiologists"))
