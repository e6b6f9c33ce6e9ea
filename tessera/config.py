"""Rule parameters and the fixed vocabularies of the imaging-study job.

Every rule in ``tessera.operators`` takes its columns and vocabularies from a
:class:`JobConfig`, so a rule is a general operator and the imaging job is one
preset of it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from types import MappingProxyType

# ---------------------------------------------------------------------------
# Fixed values. These must equal the source system's values for identical
# results (codes, names, labels and thresholds), so they are stated as text.
# ---------------------------------------------------------------------------

MODALITY_VOCABULARY = MappingProxyType({
    "XR": "X-Ray",
    "XRAY": "X-Ray",
    "x-ray": "X-Ray",
    "CT": "CT Scan",
    "ct": "CT Scan",
    "CAT": "CT Scan",
    "MRI": "MRI",
    "mri": "MRI",
    "MR": "MRI",
    "US": "Ultrasound",
    "ULTR": "Ultrasound",
    "NM": "Nuclear Medicine",
    "NMED": "Nuclear Medicine",
    "FL": "Fluoroscopy",
    "FLURO": "Fluoroscopy",
    "DXA": "Bone Density",
    "DEXA": "Bone Density",
    "MAM": "Mammography",
    "MAMM": "Mammography",
})

MODALITY_GROUPS = MappingProxyType({
    "X-Ray": "X-Ray",
    "CT Scan": "CT",
    "MRI": "MRI",
    "Ultrasound": "US",
    "Nuclear Medicine": "NM",
    "Fluoroscopy": "Fluoro",
    "Bone Density": "Dxa",
    "Mammography": "Mammo",
    "Interventional": "IR",
})
MODALITY_GROUP_DEFAULT = "Other"
UNKNOWN_MODALITY = "UNKNOWN"

RADIOLOGIST_GRADES = MappingProxyType({
    "RAD": "Registrar",
    "DR": "Consultant",
    "CON": "Consultant",
})
RADIOLOGIST_GRADE_DEFAULT = "Unknown"
RADIOLOGIST_SPECIALITY = "Radiology"

SITE_DEPARTMENTS = MappingProxyType({
    "ESH": ("ESH", "East Surrey Hospitals"),
    "Crawley": ("CR", "Crawley Hospitals"),
    "Horsham": ("HR", "Horsham Hospitals"),
    "Caterham": ("CT", "Caterham Hospitals"),
    "Redhill CDC": ("RH", "Redhill CDC"),
})
SITE_TRUST_DEFAULT = "Unknown Trust"
SITE_REGION = "East Surrey "  # trailing space is part of the value

ROLE_PERMISSIONS = MappingProxyType({
    "admin": ("read", "write", "delete", "admin"),
    "engineer": ("read", "write"),
    "analyst": ("read",),
    "dashboard": ("read",),
})

MAX_TURNAROUND_MINS = 10_080
MIN_TURNAROUND_MINS = 0
PATIENT_ID_LENGTH = 8
INVALID_PATIENT_ID = "INVALID_ID"
INVALID_PSEUDONYM = "PSEUDONYMISED_INVALID"
NO_MEMBER_KEY = -1
INITIAL_WATERMARK = "1900-01-01 00:00:00"
SERVICE_ACCOUNT = "etl_service_account"

# TAT bands: (upper bound in minutes, inclusive; label). En dash U+2013.
TAT_BANDS = (
    (60, "< 1 hour"),
    (240, "1–4 hours"),
    (1440, "4–24 hours"),
    (4320, "1–3 days"),
)
TAT_BAND_OVER = "> 3 days"
TAT_BAND_INVALID = "Invalid"

RULE_DESCRIPTIONS = MappingProxyType({
    "V01": "Null timestamp detection",
    "V02": "Duplicate Study_ID removal (keep first occurrence)",
    "V03": "Modality code standardisation to controlled vocabulary",
    "V04": "Patient ID format validation (8-digit numeric)",
    "V05": "Turnaround time sanity (0–10080 mins)",
    "V07": "Patient ID pseudonymised (SHA-256, GDPR Art.25)",
    "V06": "PACS referential integrity (must link to RIS study)",
})
# Order in which the rules run and are reported.
RULE_ORDER = ("V01", "V02", "V03", "V04", "V05", "V07", "V06")

# KPI cards: (label, summary column, unit).
KPI_CARDS = (
    ("Total Studies Loaded", "total_studies", ""),
    ("Average TAT (hours)", "avg_tat_hours", "hrs"),
    ("Reports Issued", "reports_issued", ""),
    ("Report Completion Rate", "report_rate_pct", "%"),
    ("Active Radiologists", "active_radiologists", ""),
)

# Error rule of this engine (not a source rule): rows the extract drops for a
# missing or unparseable start time (H3).
EXTRA_RULE_DESCRIPTIONS = MappingProxyType({
    "S1": "Record with more or fewer fields than the export's header",
    "E1": "Missing or unparseable exam start (dropped by extract)",
})

# ---------------------------------------------------------------------------
# Run parameters.
# ---------------------------------------------------------------------------

# Constant run time stamp for reproducible load_timestamp / audit rows.
DEFAULT_RUN_TS = "2024-02-01 05:00:00"
# Watermark the extract checks use (events cover January 2024).
CHECK_WATERMARK = "2024-01-15 00:00:00"


@dataclass(frozen=True)
class JobConfig:
    """Column names and vocabularies of one job; the defaults are the imaging job."""

    key_col: str = "study_id"
    order_col: str = "row_ix"
    start_col: str = "exam_start_dt"
    end_col: str = "exam_end_dt"
    report_col: str = "report_issued_dt"
    required_ts_cols: tuple = ("exam_start_dt", "exam_end_dt")
    modality_col: str = "modality_raw"
    patient_col: str = "patient_id"
    radiologist_col: str = "radiologist_id"
    site_col: str = "site_code"
    pacs_key_col: str = "pacs_study_id"
    pacs_time_col: str = "acquisition_dt"
    vocabulary: MappingProxyType = field(default=MODALITY_VOCABULARY)
    modality_groups: MappingProxyType = field(default=MODALITY_GROUPS)
    grades: MappingProxyType = field(default=RADIOLOGIST_GRADES)
    departments: MappingProxyType = field(default=SITE_DEPARTMENTS)
    max_tat_mins: int = MAX_TURNAROUND_MINS
    min_tat_mins: int = MIN_TURNAROUND_MINS
    patient_id_length: int = PATIENT_ID_LENGTH
    # Parity switches (see README "Deviations").
    normalise_modality_case: bool = False
    fix_dr_grade: bool = False
    pseudonym_salt: str = ""
    run_ts: str = DEFAULT_RUN_TS
    # Hours before the watermark that an extract reads again, for rows that arrive
    # late or tie with the mark; rows already loaded are skipped by the fact append.
    lookback_hours: int = 0


DEFAULT = JobConfig()
