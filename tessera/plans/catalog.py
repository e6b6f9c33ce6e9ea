"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables under ``sf_dir`` (the stand-in sources are
projections of ``events``), so its work grows with them. The matching DuckDB
texts are in :mod:`tessera.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import config as C
from tessera.config import JobConfig
from tessera.operators import access, extract, quality, runs, star, warehouse
from tessera.plans import kpis
from tessera.sources import standins

FIRST_LOAD_TS = C.DEFAULT_RUN_TS
SECOND_LOAD_TS = "2024-02-02 05:00:00"
FIRST_RUN_ID = "RUN_20240201_050000"
SECOND_RUN_ID = "RUN_20240202_050000"
SPLIT_MONTH = "2023_06"


class Job:
    """The lazily built batch plan over one set of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: JobConfig = C.DEFAULT,
                 watermark: str = C.INITIAL_WATERMARK, studies: DataFrame | None = None,
                 stage_valid: bool = False):
        self.spark, self.sf_dir, self.cfg, self.watermark = spark, sf_dir, cfg, watermark
        self._studies = studies
        # Outputs that derive several tables from one validation write the
        # validated rows once (checkpoint to the shared folder) instead of
        # re-running V02 in every branch, as the batch job's staging does.
        self.stage_valid = stage_valid

    @cached_property
    def events(self) -> DataFrame:
        return standins.read_table(self.spark, self.sf_dir, "events")

    @cached_property
    def studies(self) -> DataFrame:
        if self._studies is not None:
            return self._studies
        return standins.studies(self.events)

    @cached_property
    def images(self) -> DataFrame:
        return standins.images(self.events)

    @cached_property
    def patients(self) -> DataFrame:
        return standins.patients(self.events)

    @cached_property
    def ris(self) -> DataFrame:
        return extract.extract_ris(self.studies, self.watermark, self.cfg)

    @cached_property
    def pacs(self) -> DataFrame:
        return extract.extract_pacs(self.images, self.watermark, self.cfg)

    @cached_property
    def epr(self) -> DataFrame:
        return extract.extract_epr(self.patients, self.ris, self.cfg)

    @cached_property
    def flagged(self) -> DataFrame:
        return quality.flag_rules(self.ris, self.cfg)

    @cached_property
    def valid(self) -> DataFrame:
        v = quality.validated(quality.flag_passing(self.ris, self.cfg), self.cfg)
        if self.stage_valid:
            from tessera.session import shared_dir
            shared_dir(self.spark)
            v = v.checkpoint(eager=True)
        return v

    @cached_property
    def pacs_linked(self) -> DataFrame:
        return quality.pacs_flagged(self.pacs, self.valid, self.cfg)

    @cached_property
    def rejects(self) -> DataFrame:
        return quality.rejects(self.flagged, list(self.ris.columns), self.cfg)

    @cached_property
    def dims(self) -> "_LazyStar":
        return _LazyStar(self)

    def fact(self, run_ts: str = FIRST_LOAD_TS) -> DataFrame:
        return star.with_load_columns(self.dims["fact_radiology"], run_ts)


class _LazyStar(dict):
    """Star tables built on first use (a KPI needs the fact and one dimension)."""

    BUILDERS = {
        "dim_date": lambda j: star.dim_date(j.valid, j.cfg.start_col),
        "dim_modality": lambda j: star.dim_modality(j.valid, j.cfg),
        "dim_radiologist": lambda j: star.dim_radiologist(j.valid, j.cfg),
        "dim_location": lambda j: star.dim_location(j.valid, j.cfg),
        "fact_radiology": lambda j: star.fact_radiology(j.valid, j.cfg),
    }

    def __init__(self, job: Job):
        super().__init__()
        self._job = job

    def __missing__(self, name: str) -> DataFrame:
        df = self.BUILDERS[name](self._job)
        self[name] = df
        return df


def _job(spark, sf_dir, **kw) -> Job:
    return Job(spark, sf_dir, **kw)


def _split_jobs(spark: SparkSession, sf_dir: str) -> tuple[Job, Job]:
    """Two loads: rows in the first half of the source order, then rows from
    the last two thirds (they overlap, so both match and no-match run).
    The bounds come from the least and greatest position as scalar subqueries.
    The second load grades ``DR`` radiologists by two letters, so members that
    both loads hold differ in an attribute."""
    base = _job(spark, sf_dir)
    lo = base.studies.select(F.min("row_ix").cast("double")).scalar()
    hi = base.studies.select(F.max("row_ix").cast("double")).scalar()
    first = base.studies.where(F.col("row_ix") < lo + (hi - lo) / 2)
    second = base.studies.where(F.col("row_ix") >= lo + (hi - lo) / 3)
    return (_job(spark, sf_dir, studies=first),
            _job(spark, sf_dir, studies=second, cfg=replace(C.DEFAULT, fix_dr_grade=True)))


# ---------------------------------------------------------------- extraction
def q_extract_ris(spark, d):
    j = _job(spark, d)
    return extract.extract_ris(j.studies, C.CHECK_WATERMARK)


def q_extract_pacs(spark, d):
    j = _job(spark, d)
    return extract.extract_pacs(j.images, C.CHECK_WATERMARK)


def q_extract_epr_semi(spark, d):
    j = _job(spark, d)
    return extract.extract_epr(j.patients, extract.extract_ris(j.studies, C.CHECK_WATERMARK))


def q_next_watermark(spark, d):
    j = _job(spark, d, watermark=C.CHECK_WATERMARK)
    prev = {"ris": C.CHECK_WATERMARK, "pacs": C.CHECK_WATERMARK}
    return extract.next_watermark(j.ris, j.pacs, prev)


def q_extract_counts(spark, d):
    j = _job(spark, d)
    return extract.extract_counts(j.studies, j.images, j.patients,
                                  C.CHECK_WATERMARK, C.CHECK_WATERMARK)


def q_extract_audit(spark, d):
    j = _job(spark, d)
    return extract.access_events(j.ris, j.pacs, j.epr)


# ---------------------------------------------------------------- validation
def _ris_out(df: DataFrame, ris_cols) -> DataFrame:
    return df.select(*ris_cols)


def q_v01_pass(spark, d):
    j = _job(spark, d)
    return _ris_out(quality.passes_v01(j.flagged), j.ris.columns)


def q_v01_reject(spark, d):
    j = _job(spark, d)
    return _ris_out(j.flagged.where(F.col(quality.FLAG_V01)), j.ris.columns)


def q_v02_pass(spark, d):
    j = _job(spark, d)
    return _ris_out(quality.flag_passing(j.ris), j.ris.columns)


def q_v02_reject(spark, d):
    j = _job(spark, d)
    return _ris_out(j.flagged.where(~F.col(quality.FLAG_V01) & F.col(quality.FLAG_V02)),
                    j.ris.columns)


def q_v03_modality(spark, d):
    j = _job(spark, d)
    return quality.flag_passing(j.ris).select(
        "row_ix", "study_id", "modality_raw", "modality_standard",
        F.col(quality.FLAG_V03).alias("unmapped"))


def q_v04_patient_id(spark, d):
    j = _job(spark, d)
    return quality.flag_passing(j.ris).select(
        "row_ix", "study_id", F.col("patient_id_checked").alias("patient_id"),
        (~F.col(quality.FLAG_V04)).alias("patient_id_valid"))


def q_v05_turnaround(spark, d):
    j = _job(spark, d)
    return quality.flag_passing(j.ris).select("row_ix", "study_id", "turnaround_mins",
                                                "tat_flag")


def q_v06_valid(spark, d):
    j = _job(spark, d)
    return quality.referential_integrity(j.pacs, j.valid, how="left_semi")


def q_v06_orphans(spark, d):
    j = _job(spark, d)
    return quality.referential_integrity(j.pacs, j.valid, how="left_anti")


def q_stream_v06(spark, d):
    """Studies and images as files in three steps each, linked in the stream. The stand-ins
    are in no order of time, so the bounds span all of it; a closing heartbeat lets orphans out."""
    from tessera.session import scratch_path
    from tessera.streaming import linkage
    from tessera.streaming.incremental import files_of_step
    root, j = scratch_path(spark, "stream_v06"), _job(spark, d)
    files = files_of_step(j.events.count(), steps=3)
    j.images.repartitionByRange(3 * files, "accession_number").write.parquet(f"{root}/images")
    j.studies.repartitionByRange(3 * files, "row_ix").write.parquet(f"{root}/studies")
    dirs, schemas = (f"{root}/images", f"{root}/studies"), (j.images.schema, j.studies.schema)
    for last in (False, True):  # the second run goes on from the checkpoint of the first
        linkage.start_linkage(spark, *dirs, f"{root}/out", f"{root}/checkpoint", *schemas,
                              bound_days=700, delay_days=1500, max_files_per_trigger=files).awaitTermination()
        if not last:
            linkage.heartbeat(spark, *dirs, *schemas, "2040-01-01 00:00:00")
    return linkage.outcomes(spark, f"{root}/out")


def q_v07_pseudonym(spark, d):
    j = _job(spark, d)
    return j.valid.select("row_ix", "study_id", "patient_id_pseudo")


def q_validated(spark, d):
    return _job(spark, d).valid


def q_validated_from_csv(spark, d):
    """S1 end to end: the studies exported as text CSV with the ten export columns
    in source order, read back as text with the position in the files, typed,
    extracted and validated."""
    from tessera.session import scratch_path
    from tessera.sources import exports
    path = scratch_path(spark, "ris_csv")
    _write_csv(_job(spark, d).studies.repartitionByRange("row_ix").sortWithinPartitions("row_ix").drop("row_ix"), path)
    typed = exports.type_ris(exports.read_ris_csv(spark, path))
    return _job(spark, d, studies=typed).valid.drop("row_ix")


def _write_csv(df: DataFrame, path: str) -> None:
    (df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
     .write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def q_validated_from_reordered_csv(spark, d):
    """The studies exported with their columns in another order, beside a column of
    notes with commas, quotes and line ends, read back by header name and validated."""
    from tessera.session import scratch_path
    from tessera.sources import exports
    path = scratch_path(spark, "ris_csv")
    rows = _job(spark, d).studies.repartitionByRange("row_ix").sortWithinPartitions("row_ix")
    note = F.concat(F.lit('seen, "as\nsent" '), F.col("row_ix").cast("string")).alias("note")
    half = len(exports.RIS_COLUMNS) // 2
    _write_csv(rows.select(*exports.RIS_COLUMNS[:half:-1], note, *exports.RIS_COLUMNS[half::-1]), path)
    typed = exports.type_ris(exports.read_ris_csv(spark, path))
    return _job(spark, d, studies=typed).valid.drop("row_ix")


# Lines of an export of three columns: too short, too long, a quoted line end, plain.
RAGGED_HEADER = "study_id,patient_id,note"
RAGGED_LINE = ("CASE event_id % 50 WHEN 3 THEN concat(sid, ',', pid) WHEN 4 THEN concat(sid, ',', pid, ',x,y') "
               "WHEN 5 THEN concat(sid, ',', pid, ',\"a', chr(10), '\"\"b\"\",c\"') "
               "ELSE concat(sid, ',', pid, ',n', cast(event_id AS varchar(20))) END")


def q_csv_bad_records(spark, d):
    """An export with ragged records and quoted line ends: its rows, and the records
    that do not fit the header."""
    from tessera.session import scratch_path
    from tessera.sources import exports
    path = scratch_path(spark, "ragged_csv")
    ids = _job(spark, d).studies.selectExpr("row_ix AS event_id", "coalesce(study_id, '') AS sid", "coalesce(patient_id, '') AS pid")
    # One column under the whole header, line by line and without quoting: the text as it is.
    lines = ids.selectExpr(f"explode(split({RAGGED_LINE}, chr(10))) AS `{RAGGED_HEADER}`")
    (lines.write.option("header", True).option("sep", "\x01").option("quote", "\x02").option("escapeQuotes", False)
     .option("quoteAll", False).option("emptyValue", "").option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    none = F.lit(None).cast("string")
    good = exports.read_csv_export(spark, path, RAGGED_HEADER.split(","))
    bad = exports.csv_bad_records(spark, path)
    return (good.select(F.lit("row").alias("kind"), "study_id", "patient_id", "note")
            .unionByName(bad.select(F.lit("bad").alias("kind"), F.col("record").alias("study_id"), none.alias("patient_id"),
                                    F.col("record_sha256").alias("note"))))


def q_pacs_from_csv(spark, d):
    """S1 + F15: the image export as text, typed and extracted."""
    from tessera.session import scratch_path
    from tessera.sources import exports
    path = scratch_path(spark, "pacs_csv")
    _write_csv(_job(spark, d).images, path)
    return extract.extract_pacs(exports.type_pacs(exports.read_pacs_csv(spark, path)), C.CHECK_WATERMARK)


def q_epr_from_csv(spark, d):
    """The patient export as text, typed, with pseudonyms."""
    from tessera.session import scratch_path
    from tessera.sources import exports
    path = scratch_path(spark, "epr_csv")
    _write_csv(_job(spark, d).patients, path)
    return extract.masked_epr(exports.type_epr(exports.read_epr_csv(spark, path)))


def q_quality_report(spark, d):
    j = _job(spark, d)
    return quality.quality_report(j.flagged, j.pacs_linked)


def q_quality_samples(spark, d):
    j = _job(spark, d)
    return quality.quality_samples(j.flagged, j.pacs_linked)


def q_error_records(spark, d):
    return _job(spark, d).rejects


def q_error_table(spark, d):
    return quality.error_table(_job(spark, d).rejects, FIRST_RUN_ID)


def q_error_table_two_runs(spark, d):
    """V-ERR: two loads whose source positions repeat, appended to one error table."""
    from tessera.session import scratch_path
    wh = warehouse.Warehouse(spark, scratch_path(spark, "errors"))
    wh.initialise()
    for run_id in (FIRST_RUN_ID, SECOND_RUN_ID, SECOND_RUN_ID):  # the last is a replay
        wh.append_errors(quality.error_table(_job(spark, d).rejects, run_id))
    return wh.table("error_table")


def q_source_errors_three_runs(spark, d):
    """V-ERR, K3: rows without a start in an export that three runs read; each is logged once."""
    from tessera.session import scratch_path
    wh = warehouse.Warehouse(spark, scratch_path(spark, "errors"))
    wh.initialise()
    studies = _job(spark, d).studies
    broken = studies.withColumn("exam_start_dt", F.expr("CASE WHEN row_ix % 100 = 1 THEN NULL ELSE exam_start_dt END"))
    for _ in range(3):
        bad = extract.unparseable_starts(broken, "exam_start_dt").select(*broken.columns)
        wh.append_errors(quality.source_errors(bad, "E1", key=F.col("study_id")))
    return wh.table("error_table").select("study_id", "error_rule", "error_detail", "captured_at")


# ---------------------------------------------------------------- star schema
def q_surrogate_key(spark, d):
    j = _job(spark, d)
    from tessera.functions import exprs as X
    names = j.valid.select(F.col("modality_standard").alias("value")).union(
        j.valid.select(F.col("radiologist_id").alias("value"))).union(
        j.valid.select(F.col("site_code").alias("value"))).where(F.col("value").isNotNull())
    return names.distinct().select("value", X.surrogate_key("value").alias("surrogate_key"))


def q_dim_date(spark, d):
    return _job(spark, d).dims["dim_date"]


def q_dim_date_orders(spark, d):
    orders = standins.read_table(spark, d, "orders")
    return star.dim_date(orders, "o_orderdate")


def q_dim_modality(spark, d):
    return _job(spark, d).dims["dim_modality"]


def q_dim_radiologist(spark, d):
    return _job(spark, d).dims["dim_radiologist"]


def q_dim_location(spark, d):
    return _job(spark, d).dims["dim_location"]


def q_fact(spark, d):
    return _job(spark, d).fact()


def q_fact_without_tat(spark, d):
    """Validated rows without the computed minutes and one attribute."""
    return star.fact_radiology(_job(spark, d).valid.drop("turnaround_mins", "priority"))


def q_tat_band(spark, d):
    j = _job(spark, d)
    return j.dims["fact_radiology"].groupBy("tat_band").agg(
        F.count(F.lit(1)).alias("study_count"),
        F.min("turnaround_mins").alias("min_mins"),
        F.max("turnaround_mins").alias("max_mins"))


# ---------------------------------------------------------------- warehouse
def q_dim_upsert(spark, d):
    a, b = _split_jobs(spark, d)
    return warehouse.upsert_type1(a.dims["dim_radiologist"], b.dims["dim_radiologist"],
                                  "radiologist_key")


def q_dim_upsert_date(spark, d):
    a, b = _split_jobs(spark, d)
    return warehouse.upsert_type1(a.dims["dim_date"], b.dims["dim_date"], "date_key")


def q_fact_append(spark, d):
    a, b = _split_jobs(spark, d)
    return warehouse.append_fact(a.fact(FIRST_LOAD_TS), b.fact(SECOND_LOAD_TS))


def q_fact_append_counts(spark, d):
    a, b = _split_jobs(spark, d)
    return warehouse.append_counts(a.fact(FIRST_LOAD_TS), b.fact(SECOND_LOAD_TS))


def q_fact_append_null_ids(spark, d):
    """L2: a batch that holds a null id, appended and replayed."""
    a, b = _split_jobs(spark, d)
    once = warehouse.append_fact(a.fact(FIRST_LOAD_TS), b.fact(SECOND_LOAD_TS))
    return warehouse.append_counts(once, b.fact(SECOND_LOAD_TS)).unionByName(
        warehouse.append_counts(a.fact(FIRST_LOAD_TS), b.fact(SECOND_LOAD_TS).where("study_id IS NULL")))


def _loaded_twice(spark, d):
    """A warehouse that holds the first load, and the second load's fact rows."""
    from tessera.session import scratch_path
    wh = warehouse.Warehouse(spark, scratch_path(spark, "sketched"))
    wh.initialise()
    a, b = _split_jobs(spark, d)
    wh.append_fact(a.fact(FIRST_LOAD_TS))
    return wh, b.fact(SECOND_LOAD_TS)


def q_fact_append_sketched(spark, d):
    """L2 on disk: both loads appended, loaded keys read by way of the key filters."""
    wh, second = _loaded_twice(spark, d)
    wh.append_fact(second)
    return wh.table("fact_radiology")


def q_fact_partitions_read(spark, d):
    """L2: the partitions that the key filters of the first load let the second load read: for all
    of its rows, for its later months, and for the rows that are not loaded yet (none)."""
    wh, second = _loaded_twice(spark, d)
    rows = []
    for batch, part in (("all", second), ("later", second.where(F.col("partition_key") > SPLIT_MONTH)),
                        ("new", warehouse.append_new(wh.table("fact_radiology"), second))):
        read = sorted(wh.fact_keys().partitions(part))
        rows.append((batch, len(read), *((read[0], read[-1]) if read else (None, None))))
    return spark.createDataFrame(rows, "batch string, partitions bigint, first string, last string")


def q_audit_row(spark, d):
    a, b = _split_jobs(spark, d)
    counts = warehouse.append_counts(a.fact(FIRST_LOAD_TS), b.fact(SECOND_LOAD_TS))
    return warehouse.audit_row(counts, SECOND_RUN_ID, SECOND_LOAD_TS)


def q_partition_counts(spark, d):
    a, b = _split_jobs(spark, d)
    f = warehouse.append_fact(a.fact(FIRST_LOAD_TS), b.fact(SECOND_LOAD_TS))
    return f.groupBy("partition_key", "load_timestamp").agg(
        F.count(F.lit(1)).alias("row_count"))


def q_fk_orphans(spark, d):
    j = _job(spark, d, stage_valid=True)
    dims = j.dims
    return warehouse.orphan_keys(j.fact(), {
        "date_key": (dims["dim_date"], "date_key"),
        "modality_key": (dims["dim_modality"], "modality_key"),
        "radiologist_key": (dims["dim_radiologist"], "radiologist_key"),
        "location_key": (dims["dim_location"], "location_key"),
    })


def q_duplicate_keys(spark, d):
    j = _job(spark, d, stage_valid=True)
    dims = j.dims
    return warehouse.duplicate_keys({
        "staging_ris": (j.ris, "study_id"),
        "fact_radiology": (j.fact(), "study_id"),
        "dim_date": (dims["dim_date"], "date_key"),
        "dim_modality": (dims["dim_modality"], "modality_key"),
        "dim_radiologist": (dims["dim_radiologist"], "radiologist_key"),
        "dim_location": (dims["dim_location"], "location_key"),
    })


def q_key_collisions(spark, d):
    """H5 on keys of two hex digits, which do collide."""
    from tessera.functions import exprs as X
    j = _job(spark, d)
    return warehouse.key_collisions(j.valid, {
        "dim_modality": "modality_standard", "dim_radiologist": j.cfg.radiologist_col,
        "dim_location": j.cfg.site_col}, lambda v: X.surrogate_key(v, digits=2))


def q_stream_fact(spark, d):
    """A3: the studies arrive as files in source order; the streaming job
    loads them micro-batch by micro-batch; the result is the fact table."""
    from tessera.session import scratch_path
    from tessera.streaming.incremental import files_of_step, start_incremental_load, write_in_order
    root, j = scratch_path(spark, "stream_fact"), _job(spark, d)
    files = files_of_step(j.events.count(), steps=4, least=4)
    write_in_order(j.studies, f"{root}/inbox", "row_ix", steps=4, files=files)
    schema = spark.read.parquet(f"{root}/inbox").schema
    q = start_incremental_load(spark, f"{root}/inbox", schema, f"{root}/warehouse",
                               f"{root}/checkpoint", max_files_per_trigger=files, run_ts=FIRST_LOAD_TS)
    q.awaitTermination()
    return spark.read.parquet(f"{root}/warehouse/fact_radiology").select(
        *star.with_load_columns(_job(spark, d).dims["fact_radiology"], FIRST_LOAD_TS).columns)


def _median(rows: DataFrame, col: str, bins: int = 4096) -> int | None:
    """``percentile_disc(0.5)`` of whole numbers. Each pass counts the rows of ``bins`` ranges and goes
    on in the one that holds the middle; the aggregate itself would hold every value in one task."""
    lo, hi, n = rows.agg(F.min(col), F.max(col), F.count(col)).first()
    rank = (n + 1) // 2
    while n and lo < hi:
        width = (hi - lo) // bins + 1
        at = F.call_function("div", F.col(col).cast("decimal(20,0)") - F.lit(Decimal(lo)), F.lit(Decimal(width)))
        counts = rows.where(F.col(col).between(lo, hi)).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        for b in sorted(counts.collect()):
            if rank <= b.n:
                break
            rank -= b.n
        lo, hi = lo + b.bin * width, min(hi, lo + (b.bin + 1) * width - 1)
    return lo


def _ran_by_file(spark, d) -> str:
    """Root of a job that ran over the first half of the studies as CSV files, again over the
    same files and the second half, which came late, and once more over unchanged exports.
    Event times of both halves overlap, so by its marks the second run would lose most rows."""
    from tessera.plans.batch import run_exports
    from tessera.session import scratch_path
    root, j = scratch_path(spark, "by_file"), _job(spark, d)
    half = _median(j.studies, "row_ix")
    _write_csv(j.images, f"{root}/pacs")
    _write_csv(j.patients, f"{root}/epr")
    for run_id, part, late in ((FIRST_RUN_ID, "a", F.col("row_ix") <= half), (SECOND_RUN_ID, "b", F.col("row_ix") > half),
                               ("RUN_20240203_050000", None, None)):
        if part:
            rows = j.studies.where(late).repartitionByRange("row_ix").sortWithinPartitions("row_ix").drop("row_ix")
            _write_csv(rows, f"{root}/ris/part={part}")
        run_exports(spark, f"{root}/ris/*", f"{root}/pacs", f"{root}/epr", f"{root}/job", run_ts=FIRST_LOAD_TS, run_id=run_id)
    return f"{root}/job"


def q_fact_by_file(spark, d):
    """The fact after late files; rows at or before the mark are loaded too."""
    return warehouse.Warehouse(spark, f"{_ran_by_file(spark, d)}/warehouse").table("fact_radiology").select(
        *star.with_load_columns(_job(spark, d).dims["fact_radiology"], FIRST_LOAD_TS).columns)


def _audit_log(j: Job) -> DataFrame:
    ext = extract.access_events(j.ris, j.pacs, j.epr)
    ext_rows = ext.select(
        F.concat(F.lit(FIRST_RUN_ID + "-EXTRACT-"), F.col("source")).alias("log_id"),
        "event_time", F.lit("EXTRACT").alias("pipeline_step"), "action",
        F.col("record_count").alias("records_in"), F.col("record_count").alias("records_out"),
        "user_account", "status", F.concat(F.lit("source="), F.col("source")).alias("notes"))
    # First load into an empty warehouse: every fact row is inserted.
    counts = j.fact().agg(F.count(F.lit(1)).alias("records_in"),
                          F.count(F.lit(1)).alias("inserted"),
                          F.lit(0).cast("bigint").alias("skipped"))
    load = warehouse.audit_row(counts, FIRST_RUN_ID, FIRST_LOAD_TS)
    return ext_rows.unionByName(load)


def q_warehouse_counts(spark, d):
    j = _job(spark, d, stage_valid=True)
    dims = j.dims
    return warehouse.table_counts({
        "fact_radiology": j.fact(), "dim_date": dims["dim_date"],
        "dim_modality": dims["dim_modality"], "dim_radiologist": dims["dim_radiologist"],
        "dim_location": dims["dim_location"], "audit_log": _audit_log(j),
        "error_table": j.rejects,
    })


def q_audit_log(spark, d):
    return _audit_log(_job(spark, d))


# ---------------------------------------------------------------- KPIs
def _kpi_inputs(spark, d):
    return _job(spark, d).fact(), None, None


def _kpi_star(spark, d):
    """Fact and dimensions from one validated table, written once, as the loaded warehouse has them."""
    j = _job(spark, d, stage_valid=True)
    return j.fact(), j.dims["dim_modality"], j.dims["dim_location"]


def q_kpi_summary(spark, d):
    return kpis.summary(_kpi_inputs(spark, d)[0])


def q_kpi_by_modality(spark, d):
    f, m, _ = _kpi_star(spark, d)
    return kpis.by_modality(f, m)


def q_kpi_by_site(spark, d):
    f, _, loc = _kpi_star(spark, d)
    return kpis.by_site(f, loc)


def q_kpi_tat_distribution(spark, d):
    return kpis.tat_distribution(_kpi_inputs(spark, d)[0])


def q_kpi_by_priority(spark, d):
    return kpis.by_priority(_kpi_inputs(spark, d)[0])


def q_kpi_monthly_trend(spark, d):
    return kpis.monthly_trend(_kpi_inputs(spark, d)[0])


def q_kpi_data_quality(spark, d):
    return kpis.data_quality(_kpi_inputs(spark, d)[0])


def q_kpi_top_modalities(spark, d):
    f, m, _ = _kpi_star(spark, d)
    return kpis.top_modalities(f, m)


def q_kpi_modality_head(spark, d):
    f, m, _ = _kpi_star(spark, d)
    return kpis.modality_head(f, m)


def q_kpi_cards(spark, d):
    return kpis.cards(kpis.summary(_kpi_inputs(spark, d)[0]))


def q_kpi_fact_sample(spark, d):
    return kpis.fact_sample(_kpi_inputs(spark, d)[0])


def _kpis_of_three_loads(spark, d) -> dict[str, DataFrame]:
    """K9: the studies loaded in three parts in source order, each part validated against its
    own rows; KPIs from the sums and bitmaps that the loads kept."""
    from tessera.plans.kpi_parts import KpiParts
    from tessera.session import scratch_path
    root, base = scratch_path(spark, "kpi_parts"), _job(spark, d, stage_valid=True)
    wh = warehouse.Warehouse(spark, root)
    wh.initialise()
    parts = KpiParts(spark, f"{root}/_kpi_parts")
    lo, hi = base.studies.agg(F.min("row_ix"), F.max("row_ix")).first()
    step = ((hi or 0) - (lo or 0)) // 3 + 1
    for i in range(3):
        part = base.studies.where(f"row_ix >= {(lo or 0) + i * step} AND row_ix < {(lo or 0) + (i + 1) * step}")
        wh.append_fact(_job(spark, d, studies=part).fact(), parts, f"LOAD_{i}")
    return parts.kpis(base.dims["dim_modality"], base.dims["dim_location"])


def _kept(name: str):
    def query(spark, d):
        return _kpis_of_three_loads(spark, d)[name]
    query.__doc__ = f"K9: {name} after three loads, from their partial sums."
    return query


# ---------------------------------------------------------------- access, runs
def q_access_review(spark, d):
    ev = standins.read_table(spark, d, "events")
    return access.review_summary(standins.access_requests(ev), access.role_permissions(spark))


def q_access_denied_audit(spark, d):
    """A1: refused requests as audit rows."""
    ev = standins.read_table(spark, d, "events")
    refused = access.denied(standins.access_requests(ev), access.role_permissions(spark))
    return access.audit_rows(refused, FIRST_RUN_ID, FIRST_LOAD_TS)


# ---------------------------------------------------------------- the whole job
def _ran(spark, d) -> str:
    """Root folder of one finished run of the job."""
    from tessera.plans.batch import run_batch
    from tessera.session import scratch_path
    root, j = scratch_path(spark, "job"), _job(spark, d)
    run_batch(spark, j.studies, j.images, j.patients, root, run_ts=FIRST_LOAD_TS, run_id=FIRST_RUN_ID)
    return root


def q_warehouse_sql(spark, d):
    """Ad-hoc SQL over the tables that a run created and loaded."""
    names = warehouse.Warehouse(spark, f"{_ran(spark, d)}/warehouse").register_views("wh_")
    return spark.sql(" UNION ALL ".join(f"SELECT '{n[3:]}' AS table_name, count(*) AS row_count FROM {n}" for n in names))


def q_watermark_saved(spark, d):
    """The marks that a run saved, read back."""
    from tessera.sources.state import WatermarkState
    marks = WatermarkState(spark, f"{_ran(spark, d)}/_state/watermark").current()
    return spark.createDataFrame(sorted(marks.items()), "source string, last_extracted string").select(
        "source", F.col("last_extracted").cast("timestamp_ntz").alias("last_extracted"))


def q_staged_outputs(spark, d):
    """Rows of the staged and validated outputs of a run, re-read."""
    root = _ran(spark, d)
    out = None
    for name in ("ris", "pacs", "epr", "validated_ris", "validated_pacs", "validated_epr", "rejects"):
        df = spark.read.parquet(f"{root}/_staging/{FIRST_RUN_ID}/{name}")
        raw = sum(c in df.columns for c in ("patient_id", "nhs_number"))
        row = df.agg(F.lit(name).alias("output"), F.count(F.lit(1)).alias("row_count")).withColumn("raw_id_columns", F.lit(raw))
        out = row if out is None else out.unionByName(row)
    return out


def q_run_history(spark, d):
    """A2: steps of a finished run by status."""
    history = spark.read.parquet(f"{_ran(spark, d)}/_state/run_history")
    return history.select("run_id", "task_id", "status")


def q_run_summary(spark, d):
    j = _job(spark, d)
    return runs.step_counts(j.studies, j.flagged)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "extract_ris": q_extract_ris,
    "extract_pacs": q_extract_pacs,
    "extract_epr_semi": q_extract_epr_semi,
    "next_watermark": q_next_watermark,
    "extract_counts": q_extract_counts,
    "extract_audit": q_extract_audit,
    "v01_pass": q_v01_pass,
    "v01_reject": q_v01_reject,
    "v02_pass": q_v02_pass,
    "v02_reject": q_v02_reject,
    "v03_modality": q_v03_modality,
    "v04_patient_id": q_v04_patient_id,
    "v05_turnaround": q_v05_turnaround,
    "v06_valid": q_v06_valid,
    "v06_orphans": q_v06_orphans,
    "stream_v06": q_stream_v06,
    "v07_pseudonym": q_v07_pseudonym,
    "validated": q_validated,
    "validated_from_csv": q_validated_from_csv,
    "validated_from_reordered_csv": q_validated_from_reordered_csv,
    "csv_bad_records": q_csv_bad_records,
    "source_errors_three_runs": q_source_errors_three_runs,
    "quality_report": q_quality_report,
    "quality_samples": q_quality_samples,
    "error_records": q_error_records,
    "error_table": q_error_table,
    "surrogate_key": q_surrogate_key,
    "dim_date": q_dim_date,
    "dim_date_orders": q_dim_date_orders,
    "dim_modality": q_dim_modality,
    "dim_radiologist": q_dim_radiologist,
    "dim_location": q_dim_location,
    "fact": q_fact,
    "tat_band": q_tat_band,
    "dim_upsert": q_dim_upsert,
    "dim_upsert_date": q_dim_upsert_date,
    "fact_append": q_fact_append,
    "fact_append_counts": q_fact_append_counts,
    "fact_append_sketched": q_fact_append_sketched,
    "fact_partitions_read": q_fact_partitions_read,
    "partition_counts": q_partition_counts,
    "fk_orphans": q_fk_orphans,
    "key_collisions": q_key_collisions,
    "duplicate_keys": q_duplicate_keys,
    "warehouse_counts": q_warehouse_counts,
    "audit_row": q_audit_row,
    "audit_log": q_audit_log,
    "kpi_summary": q_kpi_summary,
    "kpi_by_modality": q_kpi_by_modality,
    "kpi_by_site": q_kpi_by_site,
    "kpi_tat_distribution": q_kpi_tat_distribution,
    "kpi_by_priority": q_kpi_by_priority,
    "kpi_monthly_trend": q_kpi_monthly_trend,
    "kpi_data_quality": q_kpi_data_quality,
    "kpi_top_modalities": q_kpi_top_modalities,
    "kpi_modality_head": q_kpi_modality_head,
    "kpi_cards": q_kpi_cards,
    "kpi_fact_sample": q_kpi_fact_sample,
    "kept_kpi_summary": _kept("summary"),
    "kept_kpi_by_modality": _kept("by_modality"),
    "kept_kpi_by_site": _kept("by_site"),
    "kept_kpi_monthly_trend": _kept("monthly_trend"),
    "kept_kpi_data_quality": _kept("data_quality"),
    "access_review": q_access_review,
    "run_summary": q_run_summary,
    "stream_fact": q_stream_fact,
    "fact_by_file": q_fact_by_file,
    "pacs_from_csv": q_pacs_from_csv,
    "epr_from_csv": q_epr_from_csv,
    "error_table_two_runs": q_error_table_two_runs,
    "fact_without_tat": q_fact_without_tat,
    "fact_append_null_ids": q_fact_append_null_ids,
    "access_denied_audit": q_access_denied_audit,
    "warehouse_sql": q_warehouse_sql,
    "watermark_saved": q_watermark_saved,
    "staged_outputs": q_staged_outputs,
    "run_history": q_run_history,
}
