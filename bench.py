"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query's full plan is executed into the ``noop`` sink (no collect to the
driver). Every query runs twice and the second (warm) run is reported, as
JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans import catalog  # noqa: E402
from tessera.session import local_session  # noqa: E402

HEADLINE = (
    "validated",            # extract + V01..V07 over every study
    "quality_report",       # V-REP incl. V06 over the image metadata
    "error_table",          # V-ERR
    "fact",                 # T7 star fact
    "dim_radiologist",      # T4 largest dimension
    "fact_append_counts",   # L2 incremental append of a second load
    "dim_upsert",           # L1 type-1 upsert
    "fk_orphans",           # L5
    "kpi_summary",          # Q1
    "kpi_by_modality",      # Q2 (flagship)
    "kpi_by_site",          # Q3
    "kpi_monthly_trend",    # Q6
    "kpi_top_modalities",   # Q8
    "access_review",        # A1
)


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def warm(spark, name: str, sf_dir: str) -> float:
    run(spark, name, sf_dir)
    return run(spark, name, sf_dir)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus if cpus != "*" else "8"))
    spark = local_session(cores=cpus, shuffle_partitions=parts, app="tessera-bench")
    for name in ("validated", "kpi_by_modality"):
        run(spark, name, sf_dir)  # warm-up
    times = {name: round(warm(spark, name, sf_dir), 3) for name in HEADLINE}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
