"""Warehouse and run properties: pass + reject = input, idempotent loads,
unique fact keys, upsert semantics, stream = batch."""

import os

import pytest
from pyspark.sql import functions as F

from tessera import session
from tessera.operators import quality, warehouse
from tessera.plans import catalog
from tessera.plans.batch import run_batch
from tessera.sources import standins
from tessera.streaming import incremental
from tessera.streaming.incremental import start_incremental_load, write_in_order

from conftest import SF_SMALL


def test_pass_plus_reject_is_input(spark):
    j = catalog._job(spark, SF_SMALL)
    f = j.flagged
    n = j.ris.count()
    v01_fail = f.where(F.col(quality.FLAG_V01)).count()
    v02_fail = f.where(~F.col(quality.FLAG_V01) & F.col(quality.FLAG_V02)).count()
    assert j.valid.count() + v01_fail + v02_fail == n
    assert j.rejects.count() == v01_fail + v02_fail
    assert j.pacs.count() == (quality.referential_integrity(j.pacs, j.valid).count()
                              + quality.referential_integrity(j.pacs, j.valid, how="left_anti").count())


def test_fact_keys_unique(spark):
    f = catalog._job(spark, SF_SMALL).fact()
    assert f.count() == f.select("study_id").distinct().count()


def test_upsert_replaces_and_keeps(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    out = sorted(tuple(r) for r in warehouse.upsert_type1(old, new, "k").collect())
    assert out == [(1, "a"), (2, "B"), (3, "C")]


def test_append_same_batch_twice_inserts_nothing(spark):
    f = catalog._job(spark, SF_SMALL).fact()
    c = warehouse.append_counts(f, f).first()
    assert (c.inserted, c.skipped) == (0, c.records_in)


def test_batch_job_twice(spark, scratch):
    ev = standins.read_table(spark, SF_SMALL, "events")
    s, i, p = standins.studies(ev), standins.images(ev), standins.patients(ev)
    r1 = run_batch(spark, s, i, p, scratch, run_ts="2024-02-01 05:00:00")
    expected = catalog._job(spark, SF_SMALL).valid.count()
    assert r1["load"] == {"records_in": expected, "inserted": expected, "skipped": 0}
    assert all(t["status"] == "SUCCESS" for t in r1["tasks"])
    # second run: the watermark moved past every row; nothing new
    r2 = run_batch(spark, s, i, p, scratch, run_ts="2024-02-02 05:00:00")
    assert r2["load"]["inserted"] == 0
    wh = warehouse.Warehouse(spark, f"{scratch}/warehouse")
    assert wh.table("fact_radiology").count() == expected
    assert wh.table("dim_modality").count() == 9
    audit = wh.table("audit_log").where(F.col("pipeline_step") == "LOAD").orderBy("log_id").collect()
    assert [(a.records_in, a.records_out) for a in audit] == [(expected, expected), (0, 0)]
    # the KPI tables of the first run equal the registered KPI query
    kpi = spark.read.parquet(f"{scratch}/kpi/{r1['run_id']}/by_modality")
    want = catalog.q_kpi_by_modality(spark, SF_SMALL)
    assert kpi.exceptAll(want).count() == 0 and want.exceptAll(kpi).count() == 0
    # the same batch replayed through the load alone inserts nothing
    fact = wh.table("fact_radiology")
    assert warehouse.append_counts(fact, fact).first().inserted == 0


def test_stream_equals_batch(spark, scratch):
    ev = standins.read_table(spark, SF_SMALL, "events")
    write_in_order(standins.studies(ev), f"{scratch}/inbox", "row_ix", 3)
    schema = spark.read.parquet(f"{scratch}/inbox").schema
    q = start_incremental_load(spark, f"{scratch}/inbox", schema, f"{scratch}/wh",
                               f"{scratch}/ckpt")
    q.awaitTermination()
    got = spark.read.parquet(f"{scratch}/wh/fact_radiology").drop("load_timestamp")
    want = catalog.q_fact(spark, SF_SMALL).drop("load_timestamp").select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # restarting on the same checkpoint processes nothing again
    q2 = start_incremental_load(spark, f"{scratch}/inbox", schema, f"{scratch}/wh",
                                f"{scratch}/ckpt")
    q2.awaitTermination()
    assert spark.read.parquet(f"{scratch}/wh/fact_radiology").count() == want.count()


def test_warehouse_views_and_history(spark, scratch):
    from tessera.operators import runs
    ev = standins.read_table(spark, SF_SMALL, "events")
    s, i, p = standins.studies(ev), standins.images(ev), standins.patients(ev)
    r = run_batch(spark, s, i, p, scratch, run_ts="2024-02-01 05:00:00")
    wh = warehouse.Warehouse(spark, f"{scratch}/warehouse")
    wh.register_views(prefix="wh_")
    top = spark.sql("""
        SELECT m.modality_name, COUNT(*) AS study_count
        FROM wh_fact_radiology f JOIN wh_dim_modality m ON f.modality_key = m.modality_key
        GROUP BY m.modality_name ORDER BY study_count DESC, m.modality_name LIMIT 10""").collect()
    want = catalog.q_kpi_top_modalities(spark, SF_SMALL).collect()
    assert [(t.modality_name, t.study_count) for t in top] == [
        (w.modality_name, w.study_count) for w in want]
    hist = spark.read.parquet(f"{scratch}/_state/run_history")
    assert {x.status for x in runs.status_counts(hist).collect()} == {"SUCCESS"}
    slow = runs.slowest_steps(hist).collect()
    assert len(slow) == 1 and slow[0].run_id == r["run_id"]


def test_unparseable_starts_reach_error_table(spark, scratch):
    ev = standins.read_table(spark, SF_SMALL, "events")
    s = standins.studies(ev)
    broken = s.withColumn("exam_start_dt", F.when(F.col("row_ix") % 100 == 1, F.lit(None))
                          .otherwise(F.col("exam_start_dt")))
    run_batch(spark, broken, standins.images(ev), standins.patients(ev), scratch,
              run_ts="2024-02-01 05:00:00")
    errs = warehouse.Warehouse(spark, f"{scratch}/warehouse").table("error_table")
    e1 = errs.where(F.col("error_rule") == "E1")
    assert e1.count() == broken.where(F.col("exam_start_dt").isNull()).count() > 0
    assert e1.where(F.col("error_detail").isNull()).count() == 0
    # The same export again, beside a record that fits no header: no row is logged twice.
    bad = spark.createDataFrame([("a,b",), ("a,b",), ("c",)], "record string")
    for day in (2, 3):
        run_batch(spark, broken, standins.images(ev), standins.patients(ev), scratch,
                  run_ts=f"2024-02-0{day} 05:00:00", bad_records=bad)
    assert wh_errors(spark, scratch) == {"E1": broken.where(F.col("exam_start_dt").isNull()).count(), "S1": 2}


def wh_errors(spark, scratch):
    errs = warehouse.Warehouse(spark, f"{scratch}/warehouse").table("error_table")
    return {r.error_rule: r["count"] for r in errs.where("error_rule IN ('E1', 'S1')").groupBy("error_rule").count().collect()}


def test_stream_with_a_checkpoint_made_anew_logs_under_new_ids(spark, scratch):
    from tessera.streaming.incremental import start_incremental_load
    studies = standins.studies(standins.read_table(spark, SF_SMALL, "events"))
    for day, part in enumerate((studies.where("row_ix < 300"), studies.where("row_ix >= 300"))):
        part.coalesce(1).write.parquet(f"{scratch}/inbox{day}")
        # the first checkpoint folder is gone on the second day: the same path, a new query
        start_incremental_load(spark, f"{scratch}/inbox{day}", part.schema, f"{scratch}/wh",
                               f"{scratch}/checkpoint").awaitTermination()
        if day == 0:
            import os
            os.rename(f"{scratch}/checkpoint", f"{scratch}/checkpoint-old")
    wh = warehouse.Warehouse(spark, f"{scratch}/wh")
    loads = wh.table("audit_log").where("pipeline_step = 'LOAD'")
    assert loads.count() == loads.select("log_id").distinct().count() == 2
    want = catalog.q_error_table(spark, SF_SMALL)
    assert wh.table("error_table").count() >= want.where("error_rule = 'V01'").count() > 0


def test_stream_dedupe_within_watermark(spark, scratch):
    ev = standins.read_table(spark, SF_SMALL, "events")
    studies = standins.studies(ev)
    first = studies.where(F.col("row_ix") < 500)
    copies = first.where(F.col("row_ix") % 10 == 2)  # exact copies arrive again later
    first.coalesce(1).write.parquet(f"{scratch}/inbox")
    studies.where(F.col("row_ix") >= 500).unionByName(copies).coalesce(1) \
        .write.mode("append").parquet(f"{scratch}/inbox")
    schema = spark.read.parquet(f"{scratch}/inbox").schema
    want = catalog.q_fact(spark, SF_SMALL).drop("load_timestamp")
    # study ids the source sends as two *different* rows: in-stream dedupe keeps
    # the first arrival there, batch keeps the first by row_ix (they may differ)
    differing = studies.groupBy("study_id").count().where(F.col("count") > 1).select("study_id")
    skipped = {}
    for label, within in (("plain", None), ("dedupe", "30 days")):
        root = f"{scratch}/{label}"
        q = start_incremental_load(spark, f"{scratch}/inbox", schema, f"{root}/wh",
                                   f"{root}/ckpt", dedupe_within=within)
        q.awaitTermination()
        got = spark.read.parquet(f"{root}/wh/fact_radiology").drop("load_timestamp")
        assert got.count() == got.select("study_id").distinct().count()
        w = want.select(*got.columns)
        if within:
            got = got.join(differing, "study_id", "left_anti")
            w = w.join(differing, "study_id", "left_anti").select(*got.columns)
        assert got.exceptAll(w).count() == 0 and w.exceptAll(got).count() == 0
        audit = spark.read.parquet(f"{root}/wh/audit_log")
        skipped[label] = audit.agg(F.sum(F.regexp_extract("notes", r"skipped=(\d+)", 1)
                                         .cast("long"))).first()[0]
    # exact copies: the fact append skips them, or the stream never lets them in
    assert skipped["plain"] > 0 and skipped["dedupe"] == 0


def test_dimension_upsert_versions(spark, scratch):
    wh = warehouse.Warehouse(spark, f"{scratch}/wh")
    wh.initialise()
    schema = "location_key bigint, site_code string, department string, trust string, region string"
    a = spark.createDataFrame([(1, "A", "A", "t", "r"), (2, "B", "B", "t", "r")], schema)
    b = spark.createDataFrame([(2, "B", "B2", "t", "r"), (3, "C", "C", "t", "r")], schema)
    assert wh.upsert_dimension("dim_location", a, "RUN_1") == 2
    assert wh.upsert_dimension("dim_location", b, "RUN_2") == 2
    assert wh.upsert_dimension("dim_location", b.limit(0), "RUN_3") == 0
    cur = sorted((r.location_key, r.department) for r in wh.table("dim_location").collect())
    assert cur == [(1, "A"), (2, "B2"), (3, "C")]
    versions = spark.read.parquet(wh.path("dim_location")).select("version").distinct().count()
    assert versions == 2  # one per non-empty load; the empty batch wrote none


def test_two_streams_keep_their_audit_rows_and_rejects(spark, scratch):
    ev = standins.read_table(spark, SF_SMALL, "events")
    studies = standins.studies(ev)
    n = 0
    for i, part in enumerate((studies.where("row_ix < 500"), studies.where("row_ix >= 500"))):
        part.coalesce(1).write.parquet(f"{scratch}/inbox{i}")
        q = start_incremental_load(spark, f"{scratch}/inbox{i}", part.schema, f"{scratch}/wh", f"{scratch}/ckpt{i}")
        q.awaitTermination()
        f = quality.flag_rules(part)
        n += f.where(F.col(quality.FLAG_V01) | F.col(quality.FLAG_V02)).count()
    wh = warehouse.Warehouse(spark, f"{scratch}/wh")
    log = wh.table("audit_log").where("pipeline_step = 'LOAD'")
    assert log.count() == 2 and log.agg(F.sum("records_out")).first()[0] == wh.table("fact_radiology").count()
    assert wh.table("error_table").count() == n > 0
    assert spark.read.parquet(f"{scratch}/wh/quality_report").select("run_id").distinct().count() == 2


def test_failed_runs_are_recorded(spark, scratch):
    ev = standins.read_table(spark, SF_SMALL, "events")
    broken = standins.images(ev).drop("pacs_study_id")  # the validation needs it
    with pytest.raises(Exception):
        run_batch(spark, standins.studies(ev), broken, standins.patients(ev), scratch, run_id="RUN_X")
    hist = {r.task_id: r.status for r in spark.read.parquet(f"{scratch}/_state/run_history").collect()}
    assert hist == {"extract": "SUCCESS", "validate": "FAILED", "transform_load": "SKIPPED", "report": "SKIPPED"}


def test_half_written_dimension_version_is_not_read(spark, scratch):
    wh = warehouse.Warehouse(spark, f"{scratch}/wh")
    wh.initialise()
    schema = "location_key bigint, site_code string, department string, trust string, region string"
    a = spark.createDataFrame([(1, "A", "A", "t", "r"), (2, "B", "B", "t", "r")], schema)
    wh.upsert_dimension("dim_location", a, "RUN_1")
    (a.limit(1).withColumn("version", F.lit("99999999_half")).write.mode("append").partitionBy("version")
     .parquet(wh.path("dim_location")))
    assert wh.table("dim_location").count() == 2


def test_null_ids_are_not_loaded_twice(spark):
    f = catalog._job(spark, SF_SMALL).fact()
    assert f.where("study_id IS NULL").count() == 1
    assert warehouse.append_counts(f, f).first().inserted == 0 and warehouse.append_new(f, f).count() == 0


def test_shared_folder_is_needed_on_a_cluster(spark):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda k, d=None: d)

    from tessera.session import shared_dir
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_job_from_csv_files(spark, scratch):
    from tessera.sources import exports
    ev = standins.read_table(spark, SF_SMALL, "events")
    for name, df in (("ris", standins.studies(ev).orderBy("row_ix").drop("row_ix")), ("pacs", standins.images(ev)),
                     ("epr", standins.patients(ev))):
        catalog._write_csv(df.coalesce(1), f"{scratch}/{name}")
    out = run_batch(spark, exports.read_ris_csv(spark, f"{scratch}/ris"), exports.read_pacs_csv(spark, f"{scratch}/pacs"),
                    exports.read_epr_csv(spark, f"{scratch}/epr"), f"{scratch}/job", run_ts="2024-02-01 05:00:00")
    assert out["load"]["inserted"] == catalog._job(spark, SF_SMALL).valid.count()


def test_a_step_of_many_files_is_one_micro_batch(spark, scratch, monkeypatch):
    monkeypatch.setattr(incremental, "FILE_ROWS", 25)
    monkeypatch.setattr(session, "scratch_path", lambda s, name, new=session.scratch_path: f"{scratch}/{name}" if name == "stream_fact" else new(s, name))
    got = catalog.q_stream_fact(spark, SF_SMALL)
    want = catalog.Job(spark, SF_SMALL).fact(catalog.FIRST_LOAD_TS).select(*got.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    rows = standins.read_table(spark, SF_SMALL, "events").count()
    names = [f for f in os.listdir(f"{scratch}/stream_fact/inbox") if f.endswith(".parquet")]
    assert len(names) == 4 * incremental.files_of_step(rows, 4) > 16
    reports = [f for f in os.listdir(f"{scratch}/stream_fact/warehouse/quality_report") if f.startswith("run_id=")]
    assert len(reports) == 4
