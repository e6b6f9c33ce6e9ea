"""The whole batch job: extract -> validate -> transform -> load -> report.

Each stage writes its outputs to the shared file system and the next stage
reads them back (the staging contract of the source system). That cuts the
lineage at every stage, so a lost executor costs a re-run of one stage's
tasks, not of the job; nothing passes through the driver except row counts.

Layout under ``root`` (a folder of the shared file system)::

    _staging/<run_id>/{ris,pacs,epr,validated_ris,validated_pacs,validated_epr,rejects}
    star/<run_id>/{dim_*,fact_radiology}
    warehouse/{dim_* (versioned), fact_radiology (by partition_key), audit_log, error_table}
    kpi/<run_id>/<kpi name>
    _state/watermark, _state/run_history, _state/files
"""

from __future__ import annotations

import datetime as dt
import time
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import config as C
from tessera.config import JobConfig
from tessera.operators import extract, quality, runs, star, warehouse
from tessera.plans.kpi_parts import KpiParts
from tessera.sources import exports
from tessera.sources.ledger import FileLedger
from tessera.sources.state import WatermarkState

STEPS = ("extract", "validate", "transform_load", "report")


class _Steps:
    def __init__(self):
        self.tasks: list[dict] = []

    @contextmanager
    def step(self, task_id: str):
        t0 = time.time()
        rec = {"task_id": task_id, "status": "RUNNING", "attempts": 1}
        self.tasks.append(rec)
        try:
            yield rec
            rec["status"] = "SUCCESS"
        except Exception:
            rec["status"] = "FAILED"
            raise
        finally:
            rec["seconds"] = round(time.time() - t0, 3)


def stage_output(df: DataFrame, path: str) -> DataFrame:
    """Write a stage output and continue from the written copy."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def load_batch(spark: SparkSession, valid: DataFrame, wh: warehouse.Warehouse, run_id: str,
               run_ts: str, cfg: JobConfig = C.DEFAULT, star_dir: str | None = None) -> dict:
    """Transform + load of validated studies; returns the append counts.
    Shared by the batch job and each streaming micro-batch."""
    tables = star.star(valid, cfg)
    if star_dir:
        tables = {k: stage_output(v, f"{star_dir}/{k}") for k, v in tables.items()}
    for name in ("dim_date", "dim_modality", "dim_radiologist", "dim_location"):
        wh.upsert_dimension(name, tables[name], version=run_id)
    fact = star.with_load_columns(tables["fact_radiology"], run_ts)
    parts = KpiParts(spark, f"{wh.root}/_kpi_parts")
    parts.settle(wh.table("fact_radiology"))
    counts = wh.append_fact(fact, parts, run_id)
    wh.append_audit(warehouse.audit_row(wh.counts_frame(counts), run_id, run_ts))
    return counts


def _named(run_id: str | None, run_ts: str | None) -> tuple[str, str]:
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    run_ts = run_ts or now.strftime("%Y-%m-%d %H:%M:%S")
    return run_id or "RUN_" + dt.datetime.fromisoformat(run_ts).strftime("%Y%m%d_%H%M%S"), run_ts


def run_exports(spark: SparkSession, ris: str, pacs: str, epr: str, root: str, cfg: JobConfig = C.DEFAULT,
                run_ts: str | None = None, run_id: str | None = None) -> dict:
    """Run the job over those CSV files of the RIS and PACS exports that no run has loaded.

    Late rows in new files are loaded whatever the marks, and records of files that were
    read before are not reported again. Without such files nothing is written. The patient
    export has no event time and is read whole, for the extracted studies only. Images are
    held against the studies of the same run (V06), as in a run by marks. A run that fails
    leaves its files to the next one."""
    run_id, run_ts = _named(run_id, run_ts)
    ledger = FileLedger(spark, f"{root.rstrip('/')}/_state/files")
    files = ledger.unseen({"ris": ris, "pacs": pacs})
    if not files:
        return {"run_id": run_id, "run_ts": run_ts, "files": 0}
    studies, images = ([f.path for f in files if f.source == s] for s in ("ris", "pacs"))
    bad = (exports.csv_bad_records(spark, studies).select("record")
           .unionByName(exports.csv_bad_records(spark, images).select("record"))
           .unionByName(exports.csv_bad_records(spark, epr).select("record")))
    out = run_batch(spark, exports.read_ris_csv(spark, studies), exports.read_pacs_csv(spark, images),
                    exports.read_epr_csv(spark, epr), root, cfg, run_ts, run_id, bad, unseen_only=True)
    ledger.save(files, run_id)
    return out | {"files": len(files)}


def run_batch(spark: SparkSession, studies: DataFrame, images: DataFrame, patients: DataFrame,
              root: str, cfg: JobConfig = C.DEFAULT, run_ts: str | None = None,
              run_id: str | None = None, bad_records: DataFrame | None = None,
              unseen_only: bool = False) -> dict:
    """Run the job once over the given sources; returns the run summary.

    ``bad_records`` are records of the exports that do not fit their header
    (``sources.exports.csv_bad_records``). ``unseen_only`` says that the sources hold
    nothing but rows no run has loaded: all are taken, whatever the marks."""
    run_id, run_ts = _named(run_id, run_ts)
    root = root.rstrip("/")
    stage_dir, star_dir = f"{root}/_staging/{run_id}", f"{root}/star/{run_id}"
    wh = warehouse.Warehouse(spark, f"{root}/warehouse")
    state = WatermarkState(spark, f"{root}/_state/watermark")
    steps = _Steps()
    cfg = replace(cfg, run_ts=run_ts)
    out: dict = {"run_id": run_id, "run_ts": run_ts}
    if cfg.order_col not in studies.columns:
        raise ValueError(f"studies need a source position column {cfg.order_col!r} (see sources.exports)")
    studies, images, patients = exports.type_ris(studies), exports.type_pacs(images), exports.type_epr(patients)

    try:
        with steps.step("extract"):
            wh.initialise()
            marks = state.current()
            since = dict.fromkeys(marks, C.INITIAL_WATERMARK) if unseen_only else marks
            ris = extract.extract_ris(studies, since["ris"], cfg)
            pacs = stage_output(extract.extract_pacs(images, since["pacs"], cfg), f"{stage_dir}/pacs")
            # No raw id reaches an output that outlives the run: studies are staged with
            # their rule flags and pseudonyms, patients with pseudonyms.
            flagged = stage_output(quality.masked(quality.flag_rules(ris, cfg), cfg), f"{stage_dir}/ris")
            epr = stage_output(extract.masked_epr(extract.extract_epr(patients, flagged, cfg), cfg), f"{stage_dir}/epr")
            events = extract.access_events(flagged, pacs, epr, cfg)
            wh.append_audit(events.select(
                F.concat(F.lit(run_id + "-EXTRACT-"), F.col("source")).alias("log_id"),
                "event_time", F.lit("EXTRACT").alias("pipeline_step"), "action",
                F.col("record_count").alias("records_in"), F.col("record_count").alias("records_out"),
                "user_account", "status", F.concat(F.lit("source="), F.col("source")).alias("notes")))
        with steps.step("validate"):
            valid = stage_output(quality.validated(flagged, cfg), f"{stage_dir}/validated_ris")
            quality.referential_integrity(pacs, valid, cfg, "left_semi").write.mode(
                "overwrite").parquet(f"{stage_dir}/validated_pacs")
            epr.write.mode("overwrite").parquet(f"{stage_dir}/validated_epr")
            rejects = stage_output(quality.rejects(flagged, list(studies.columns), cfg), f"{stage_dir}/rejects")
            wh.append_errors(quality.error_table(rejects, run_id, cfg))
            # H3: rows the extract dropped for a missing or unparseable start, and records
            # that no row could be made of; an export that is read again adds none.
            bad_start = extract.unparseable_starts(studies, cfg.start_col, cfg).select(*studies.columns)
            wh.append_errors(quality.source_errors(bad_start, "E1", cfg, F.col(cfg.key_col)))
            if bad_records is not None:
                wh.append_errors(quality.source_errors(bad_records, "S1", cfg))
            report = quality.quality_report(flagged, quality.pacs_flagged(pacs, valid, cfg))
            report.write.mode("overwrite").parquet(f"{stage_dir}/quality_report")
        with steps.step("transform_load"):
            out["load"] = load_batch(spark, valid, wh, run_id, run_ts, cfg, star_dir=star_dir)
            # H2: the next marks are the latest event times of this batch, saved only
            # after the load succeeded.
            state.save(extract.next_watermark(flagged, pacs, marks, cfg), run_id)
        with steps.step("report"):
            # K9 from the parts that the loads keep; the fact is not read.
            parts = KpiParts(spark, f"{wh.root}/_kpi_parts")
            for name, df in parts.kpis(wh.table("dim_modality"), wh.table("dim_location")).items():
                df.write.mode("overwrite").parquet(f"{root}/kpi/{run_id}/{name}")
    finally:
        # Failed runs are recorded too, with the steps they never reached.
        reached = {t["task_id"] for t in steps.tasks}
        steps.tasks += [{"task_id": s, "status": "SKIPPED", "attempts": 0} for s in STEPS if s not in reached]
        runs.history_rows(spark, run_id, steps.tasks).write.mode("append").parquet(
            f"{root}/_state/run_history")
    out["tasks"] = steps.tasks
    out["quality_report"] = [r.asDict() for r in spark.read.parquet(
        f"{stage_dir}/quality_report").collect()]
    return out
