"""Stand-in RIS / PACS / EPR exports: row projections of the ``events`` table.

The driver tables hold no imaging data, so each source is a projection of
``events``: every column of a row follows from that row alone, no join, window
or copy. The column texts below are valid in Spark SQL and in DuckDB, which the
oracle uses. Codes that a rule looks up come from :mod:`tessera.config`, all
other values are made from the row's ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tessera import config as C
from tessera.session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _pick(values: Sequence[str], number: str) -> str:
    """SQL text: the value at ``number`` modulo their count."""
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {number} % {len(values)} {whens} END"


def _minutes(number: str) -> str:
    return f"interval '1' minute * ({number})"


# Raw modality codes: the vocabulary, then a padded one, one behind a no-break
# space, an unknown one and a missing one.
_N_CODES = len(C.MODALITY_VOCABULARY) + 4
_CODE = f"event_id % {_N_CODES}"
_CODE_TEXT = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(C.MODALITY_VOCABULARY))
_MODALITY = (f"CASE {_CODE} {_CODE_TEXT} WHEN {_N_CODES - 4} THEN '  CT ' "
             f"WHEN {_N_CODES - 3} THEN concat(chr(160), 'MRI') WHEN {_N_CODES - 2} THEN 'OTHER1' ELSE NULL END")
_GRADED = [*C.RADIOLOGIST_GRADES, "LOC"]
_SITES = [*C.SITE_DEPARTMENTS, "ANNEX"]

# Exams lie up to 19 months before the event; they take 5 to 44 minutes.
_START = "ts - interval '30' day * (event_id % 20)"
_LENGTH = "5 + event_id % 40"
# Minutes from the exam's end to the report: every band with both sides of its
# bounds, the sanity limit, negative and missing.
_DELAYS = (20, 60, 61, 240, 1440, 4320, 4321, C.MAX_TURNAROUND_MINS, C.MAX_TURNAROUND_MINS + 1, -30)
_DELAY = _pick([str(d) for d in _DELAYS], "event_id").replace("'", "")

STUDY_COLUMNS = {
    "row_ix": "event_id",
    "study_id": ("CASE WHEN event_id % 101 = 50 THEN NULL WHEN event_id % 33 = 0 AND event_id > 0 "
                 "THEN concat('STU', lpad(cast(event_id - 1 AS varchar(20)), 9, '0')) "
                 "ELSE concat('STU', lpad(cast(event_id AS varchar(20)), 9, '0')) END"),
    "patient_id": ("CASE WHEN event_id % 25 = 0 THEN NULL WHEN event_id % 25 = 1 THEN concat('AB', cast(user_id AS varchar(20))) "
                   "ELSE cast(10000000 + user_id AS varchar(20)) END"),
    "exam_start_dt": _START,
    "exam_end_dt": f"CASE WHEN event_id % 50 = 7 THEN NULL ELSE {_START} + {_minutes(_LENGTH)} END",
    "report_issued_dt": (f"CASE WHEN event_id % 20 = 3 THEN NULL ELSE {_START} + {_minutes(_LENGTH)} + {_minutes(_DELAY)} END"),
    "modality_raw": _MODALITY,
    "radiologist_id": (f"CASE WHEN event_id % 31 = 0 THEN NULL ELSE concat({_pick(_GRADED, 'user_id')}, "
                       "cast(100 + user_id AS varchar(20))) END"),
    "site_code": f"CASE WHEN event_id % 67 = 9 THEN NULL ELSE {_pick(_SITES, 'user_id')} END",
    "priority": "concat('P', cast(1 + event_id % 4 AS varchar(2)))",
    "referral_source": "concat('REF-', cast(event_id % 5 AS varchar(2)))",
}

IMAGE_COLUMNS = {
    "pacs_study_id": ("CASE WHEN event_id % 211 = 7 THEN NULL ELSE concat(CASE WHEN event_id % 40 = 11 THEN 'ORP' ELSE 'STU' END, "
                      "lpad(cast(event_id AS varchar(20)), 9, '0')) END"),
    "accession_number": "concat('ACC', cast(100000 + event_id AS varchar(20)))",
    "num_images": "cast(1 + event_id % 800 AS int)",
    "image_size_mb": "value",
    "modality_dicom": "CASE WHEN event_id % 9 = 8 THEN NULL ELSE concat('D', cast(event_id % 9 AS varchar(2))) END",
    "acquisition_dt": "ts",
    "storage_path": "concat('/images/', cast(event_id AS varchar(20)))",
    "dicom_status": "concat('S', cast(event_id % 3 AS varchar(2)))",
}

PATIENT_COLUMNS = {
    "study_id": "concat('STU', lpad(cast(event_id AS varchar(20)), 9, '0'))",
    "patient_id": "cast(10000000 + user_id AS varchar(20))",
    "date_of_birth": ("concat(cast(1940 + user_id % 66 AS varchar(4)), '-', lpad(cast(1 + user_id % 12 AS varchar(2)), 2, '0'), "
                      "'-', lpad(cast(1 + user_id % 28 AS varchar(2)), 2, '0'))"),
    "gender": "concat('G', cast(user_id % 3 AS varchar(2)))",
    "gp_practice": "concat('PR', cast(1000 + user_id AS varchar(20)))",
    "trust_code": "concat('T', cast(user_id % 5 AS varchar(2)))",
    "nhs_number": "CASE WHEN user_id % 25 = 0 THEN NULL ELSE cast(1000000000 + user_id AS varchar(20)) END",
    "ethnicity": "concat('E', cast(user_id % 11 AS varchar(2)))",
}


def _sql(columns: dict[str, str]) -> str:
    return "SELECT " + ",\n ".join(f"{text} AS {name}" for name, text in columns.items()) + "\nFROM events"


STUDIES_SQL, IMAGES_SQL, PATIENTS_SQL = _sql(STUDY_COLUMNS), _sql(IMAGE_COLUMNS), _sql(PATIENT_COLUMNS)


def _project(events: DataFrame, columns: dict[str, str]) -> DataFrame:
    return events.selectExpr(*[f"{text} AS {name}" for name, text in columns.items()])


def studies(events: DataFrame) -> DataFrame:
    """RIS stand-in: one study per event; ``row_ix`` is the source order."""
    return _project(events, STUDY_COLUMNS)


def images(events: DataFrame) -> DataFrame:
    """PACS stand-in: image metadata per event, some with orphan study ids."""
    return _project(events, IMAGE_COLUMNS)


def patients(events: DataFrame) -> DataFrame:
    """EPR stand-in: demographics per study."""
    return _project(events, PATIENT_COLUMNS)


# Access requests for the bulk review (A1): each event is a request by the
# user's role for the permission its event type needs. One role is unknown.
REQUEST_ROLES = [*C.ROLE_PERMISSIONS, "visitor"]
EVENT_PERMISSIONS = (("view", "read"), ("click", "read"), ("purchase", "write"),
                     ("signup", "admin"), ("error", "delete"))
REQUEST_COLUMNS = {
    "request_id": "event_id",
    "role": _pick(REQUEST_ROLES, "user_id"),
    "required_permission": "CASE event_type " + " ".join(f"WHEN '{e}' THEN '{p}'" for e, p in EVENT_PERMISSIONS) + " ELSE 'read' END",
}
REQUESTS_SQL = _sql(REQUEST_COLUMNS)


def access_requests(events: DataFrame) -> DataFrame:
    """``(request_id, role, required_permission)`` derived from ``events``."""
    return _project(events, REQUEST_COLUMNS)
