"""Physical plan shapes that matter at scale."""

from tessera.operators import quality
from tessera.plans import catalog

from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted") \
        if hasattr(df._sc._jvm, "PythonSQLUtils") else plan(df)


def test_extract_filter_is_pushed_into_scan(spark):
    p = plan(catalog.q_extract_pacs(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in p


def test_column_pruning_on_scan(spark):
    p = plan(catalog.q_v06_orphans(spark, SF_SMALL))
    schemas = [part.split("\n")[0] for part in p.split("ReadSchema")[1:]]
    assert schemas and all("props" not in s and "event_type" not in s for s in schemas)


def scans(p: str) -> int:
    return p.count("FileScan")


def test_stand_in_filter_sits_on_the_events_scan(spark):
    p = plan(catalog.q_extract_ris(spark, SF_SMALL))
    assert scans(p) == 1 and "Exchange" not in p and "Filter" in p


def test_passing_rows_take_one_scan_and_one_exchange(spark):
    p = plan(catalog.q_validated(spark, SF_SMALL))
    assert scans(p) == 1 and p.count("Exchange hashpartitioning") == 1
    assert "WindowGroupLimit" in p and "Partial" in p  # a hot key sends one row per task


def test_rejects_join_only_repeated_keys(spark):
    p = plan(catalog.q_v02_reject(spark, SF_SMALL))
    assert "Window [" not in p and scans(p) == 2
    agg = p[p.index("HashAggregate"):]
    assert "> 1" in p and "count" in agg


def test_hot_key_sends_one_row_per_task(spark):
    hot = spark.range(0, 40_000, 1, 8).selectExpr(
        "id AS row_ix", "CASE WHEN id % 3 = 0 THEN concat('S', id) ELSE 'HOT' END AS study_id")
    df = quality.first_rows(hot, "study_id", "row_ix")
    assert df.where("study_id = 'HOT'").first().row_ix == 1
    assert df.count() == 13_334 + 1


def test_modality_kpi_aggregates_before_it_joins(spark):
    p = plan(catalog.q_kpi_by_modality(spark, SF_SMALL))
    join = p.index("Join")
    assert "partial_count" in p[join:]  # the fact side is aggregated below the join
    assert "FileScan" not in p  # and reads the one staged validation


def test_samples_use_group_limit(spark):
    p = plan(catalog.q_quality_samples(spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_no_cartesian_products(spark):
    jobs = {"warehouse_sql", "watermark_saved", "staged_outputs", "run_history", "stream_fact", "stream_v06"}  # run a whole job each
    for name, fn in catalog.QUERIES.items():
        if name in jobs:
            continue
        p = plan(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
