import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
for p in (ROOT, os.path.join(ROOT, "tests")):
    if p not in sys.path:
        sys.path.insert(0, p)


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    spark.sparkContext.environment.setdefault("OMP_NUM_THREADS", "1")


@pytest.fixture()
def frame(spark):
    """documents-like frame from (doc_id, text) with extra columns whose names operators use inside."""
    def make(rows, extra=True):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        if not extra:
            return df
        from pyspark.sql import functions as F
        return df.selectExpr("doc_id", "text", "'x' AS blob", "'y' AS digest", "1 AS n", "2 AS k", "'z' AS content",
                             "0.5D AS score", "'q' AS shard", "'p' AS path", "1 AS a", "2 AS b").withColumn("n_words", F.lit(9))
    return make
