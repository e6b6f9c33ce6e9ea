"""Column lists and StructTypes of sources and warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

RIS_COLUMNS = ("study_id", "patient_id", "exam_start_dt", "exam_end_dt", "report_issued_dt",
               "modality_raw", "radiologist_id", "site_code", "priority", "referral_source")
PACS_COLUMNS = ("pacs_study_id", "accession_number", "num_images", "image_size_mb",
                "modality_dicom", "acquisition_dt", "storage_path", "dicom_status")
EPR_COLUMNS = ("study_id", "patient_id", "date_of_birth", "gender", "gp_practice",
               "trust_code", "nhs_number", "ethnicity")

S, I, L, D, TS, DT = (T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(),
                      T.TimestampNTZType(), T.DateType())


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


DIM_DATE = _struct(("date_key", I), ("calendar_date", DT), ("day_name", S), ("day_of_week", I),
                   ("week_number", I), ("month_num", I), ("month_name", S), ("quarter", I),
                   ("calendar_year", I), ("financial_year", S), ("is_weekend", I))
DIM_MODALITY = _struct(("modality_key", L), ("modality_code", S), ("modality_name", S),
                       ("modality_group", S))
DIM_RADIOLOGIST = _struct(("radiologist_key", L), ("radiologist_id", S), ("grade", S),
                          ("speciality", S), ("is_active", I))
DIM_LOCATION = _struct(("location_key", L), ("site_code", S), ("department", S), ("trust", S),
                       ("region", S))
FACT_COLUMNS = ("study_id", "date_key", "modality_key", "radiologist_key", "location_key",
                "patient_id_pseudo", "turnaround_mins", "study_count", "report_issued_flag",
                "tat_band", "priority", "referral_source", "tat_flag")
FACT_RADIOLOGY = _struct(("study_id", S), ("date_key", I), ("modality_key", L),
                         ("radiologist_key", L), ("location_key", L), ("patient_id_pseudo", S),
                         ("turnaround_mins", D), ("study_count", I), ("report_issued_flag", I),
                         ("tat_band", S), ("priority", S), ("referral_source", S), ("tat_flag", S),
                         ("load_timestamp", TS), ("partition_key", S))
AUDIT_LOG = _struct(("log_id", S), ("event_time", TS), ("pipeline_step", S), ("action", S),
                    ("records_in", L), ("records_out", L), ("user_account", S), ("status", S),
                    ("notes", S))
ERROR_TABLE = _struct(("error_id", S), ("study_id", S), ("error_rule", S), ("error_detail", S),
                      ("captured_at", TS))
FILE_LEDGER = _struct(("source", S), ("path", S), ("length", L), ("modified", T.TimestampType()), ("run_id", S))
WATERMARK = _struct(("source", S), ("last_extracted", TS), ("run_id", S))

# name -> (schema, primary key)
WAREHOUSE = {
    "dim_date": (DIM_DATE, "date_key"),
    "dim_modality": (DIM_MODALITY, "modality_key"),
    "dim_radiologist": (DIM_RADIOLOGIST, "radiologist_key"),
    "dim_location": (DIM_LOCATION, "location_key"),
    "fact_radiology": (FACT_RADIOLOGY, "study_id"),
    "audit_log": (AUDIT_LOG, "log_id"),
    "error_table": (ERROR_TABLE, "error_id"),
}
