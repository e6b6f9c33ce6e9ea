"""DuckDB texts equivalent to every registered query (the correctness oracle).

The texts are written independently of the Spark plans (for example V02 is a
``row_number`` window here and an aggregate + join in Spark), read the same
parquet tables as views (``events``, ``orders``) and alias every column to the
Spark name. Lookups are generated from the same fixed vocabularies in
:mod:`tessera.config`.
"""

from __future__ import annotations

from tessera import config as C
from tessera.plans import catalog as Q
from tessera.sources import standins

# White space of any script, as a list of characters.
_SPACE = " || ".join(f"chr({c})" for c in (*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233,
                                            8239, 8287, 12288))
STRIP = f"trim({{x}}, {_SPACE})"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(expr: str, mapping, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    return f"CASE {expr} {whens} ELSE {default} END"


def _key(x: str, digits: int = 8) -> str:
    return f"CAST(('0x' || substr(md5({x}), 1, {digits})) AS BIGINT)"


def _member(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN CAST(-1 AS BIGINT) ELSE {_key(x)} END"


def _sha(x: str) -> str:
    return f"upper(substr(sha256({x}), 1, 16))"


def _rhu(x: str, d: int) -> str:
    return f"round({x}, {d})"


def _date_key(x: str) -> str:
    return f"CAST(year({x}) * 10000 + month({x}) * 100 + day({x}) AS INTEGER)"


def _band(m: str) -> str:
    parts = [f"WHEN {m} IS NULL OR {m} < 0 THEN {_q(C.TAT_BAND_INVALID)}"]
    parts += [f"WHEN {m} <= {ub} THEN {_q(label)}" for ub, label in C.TAT_BANDS]
    return f"CASE {' '.join(parts)} ELSE {_q(C.TAT_BAND_OVER)} END"


def _ts(s: str) -> str:
    return f"TIMESTAMP '{s}'"


US_PER_MIN = 60_000_000
RIS_COLS = ("row_ix, study_id, patient_id, exam_start_dt, exam_end_dt, report_issued_dt, "
            "modality_raw, radiologist_id, site_code, priority, referral_source")
VALID_COLS = ("row_ix, study_id, exam_start_dt, exam_end_dt, report_issued_dt, modality_raw, "
              "radiologist_id, site_code, priority, referral_source, modality_standard, "
              "turnaround_mins, tat_flag, patient_id_pseudo")

def dim_date_cte(name: str, src: str, ts_col: str) -> str:
    fy = "(year(d) - CASE WHEN month(d) < 4 THEN 1 ELSE 0 END)"
    return (
        f"{name} AS (SELECT {_date_key('d')} AS date_key, d AS calendar_date, dayname(d) AS day_name, "
        f"CAST(isodow(d) AS INTEGER) AS day_of_week, CAST(weekofyear(d) AS INTEGER) AS week_number, "
        f"CAST(month(d) AS INTEGER) AS month_num, monthname(d) AS month_name, "
        f"CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS calendar_year, "
        f"'FY' || CAST({fy} AS VARCHAR) || '/' || substr(CAST({fy} + 1 AS VARCHAR), 3, 2) AS financial_year, "
        f"CAST(isodow(d) >= 6 AS INTEGER) AS is_weekend "
        f"FROM (SELECT DISTINCT CAST({ts_col} AS DATE) AS d FROM {src} "
        f"WHERE {ts_col} IS NOT NULL) x)")


def chain(p: str, src: str, wm: str = C.INITIAL_WATERMARK, run_ts: str = Q.FIRST_LOAD_TS,
          fix_dr: bool = False) -> list[str]:
    """CTEs of one batch run over the studies CTE ``src``, names prefixed ``p``."""
    std = _case(STRIP.format(x="modality_raw"), C.MODALITY_VOCABULARY)
    pid_ok = (f"coalesce(regexp_full_match({STRIP.format(x='patient_id')}, "
              f"'[0-9]{{{C.PATIENT_ID_LENGTH}}}'), false)")
    max_us = C.MAX_TURNAROUND_MINS * US_PER_MIN
    depts = {k: v[0] for k, v in C.SITE_DEPARTMENTS.items()}
    trusts = {k: v[1] for k, v in C.SITE_DEPARTMENTS.items()}
    grade = _case("upper(substr(radiologist_id, 1, 3))", C.RADIOLOGIST_GRADES,
                  _q(C.RADIOLOGIST_GRADE_DEFAULT))
    if fix_dr:
        two = _case("upper(substr(radiologist_id, 1, 2))", C.RADIOLOGIST_GRADES, _q(C.RADIOLOGIST_GRADE_DEFAULT))
        grade = _case("upper(substr(radiologist_id, 1, 3))", C.RADIOLOGIST_GRADES, two)
    dk = "CAST(date_key AS VARCHAR)"
    return [
        f"{p}ris AS (SELECT * FROM {src} WHERE exam_start_dt > {_ts(wm)})",
        f"{p}f1 AS (SELECT *, (exam_start_dt IS NULL OR exam_end_dt IS NULL) AS v01_fail FROM {p}ris)",
        f"{p}f2 AS (SELECT *, CASE WHEN v01_fail THEN NULL ELSE row_number() OVER "
        f"(PARTITION BY study_id, v01_fail ORDER BY row_ix) > 1 END AS v02_dup FROM {p}f1)",
        f"{p}f3 AS (SELECT *, {std} AS std, {pid_ok} AS pid_ok, "
        f"date_diff('microsecond', exam_end_dt, report_issued_dt) AS tat_us FROM {p}f2)",
        f"{p}flagged AS (SELECT *, std IS NULL AS v03_unmapped, "
        f"coalesce(std, {_q(C.UNKNOWN_MODALITY)}) AS modality_standard, NOT pid_ok AS v04_invalid, "
        f"CASE WHEN pid_ok THEN patient_id ELSE {_q(C.INVALID_PATIENT_ID)} END AS patient_id_checked, "
        f"CAST(tat_us AS DOUBLE) / CAST({US_PER_MIN} AS DOUBLE) AS turnaround_mins, "
        f"CASE WHEN tat_us < 0 THEN 'NEGATIVE_TAT' WHEN tat_us > {max_us} THEN 'EXCESSIVE_TAT' "
        f"ELSE 'OK' END AS tat_flag, "
        f"CASE WHEN pid_ok THEN {_sha('patient_id')} ELSE {_q(C.INVALID_PSEUDONYM)} END "
        f"AS patient_id_pseudo FROM {p}f3)",
        f"{p}pass2 AS (SELECT * FROM {p}flagged WHERE NOT v01_fail AND NOT v02_dup)",
        f"{p}valid AS (SELECT {VALID_COLS} FROM {p}pass2)",
        f"{p}factx AS (SELECT study_id, {_date_key('exam_start_dt')} AS date_key, "
        f"{_member('modality_standard')} AS modality_key, {_member('radiologist_id')} AS radiologist_key, "
        f"{_member('site_code')} AS location_key, patient_id_pseudo, turnaround_mins, "
        f"CAST(1 AS INTEGER) AS study_count, CAST(report_issued_dt IS NOT NULL AS INTEGER) AS report_issued_flag, "
        f"{_band('turnaround_mins')} AS tat_band, priority, referral_source, tat_flag, tat_us "
        f"FROM {p}pass2)",
        f"{p}fact AS (SELECT study_id, date_key, modality_key, radiologist_key, location_key, "
        f"patient_id_pseudo, turnaround_mins, study_count, report_issued_flag, tat_band, priority, "
        f"referral_source, tat_flag, {_ts(run_ts)} AS load_timestamp, "
        f"coalesce(substr({dk}, 1, 4) || '_' || substr({dk}, 5, 2), 'UNKNOWN') AS partition_key "
        f"FROM {p}factx)",
        dim_date_cte(f"{p}dim_date", f"{p}valid", "exam_start_dt"),
        f"{p}dim_modality AS (SELECT modality_key, "
        f"substr(upper(replace(modality_name, ' ', '_')), 1, 10) AS modality_code, modality_name, "
        f"{_case('modality_name', C.MODALITY_GROUPS, _q(C.MODALITY_GROUP_DEFAULT))} AS modality_group "
        f"FROM (SELECT {_key('modality_standard')} AS modality_key, min(modality_standard) AS modality_name "
        f"FROM {p}valid WHERE modality_standard IS NOT NULL GROUP BY 1) x)",
        f"{p}dim_radiologist AS (SELECT radiologist_key, radiologist_id, {grade} AS grade, "
        f"{_q(C.RADIOLOGIST_SPECIALITY)} AS speciality, CAST(1 AS INTEGER) AS is_active "
        f"FROM (SELECT {_key('radiologist_id')} AS radiologist_key, min(radiologist_id) AS radiologist_id "
        f"FROM {p}valid WHERE radiologist_id IS NOT NULL GROUP BY 1) x)",
        f"{p}dim_location AS (SELECT location_key, site_code, "
        f"{_case('site_code', depts, 'site_code')} AS department, "
        f"{_case('site_code', trusts, _q(C.SITE_TRUST_DEFAULT))} AS trust, "
        f"{_q(C.SITE_REGION)} AS region "
        f"FROM (SELECT {_key('site_code')} AS location_key, min(site_code) AS site_code "
        f"FROM {p}valid WHERE site_code IS NOT NULL GROUP BY 1) x)",
    ]


def base_ctes() -> list[str]:
    return [f"studies AS ({standins.STUDIES_SQL})",
            f"images AS ({standins.IMAGES_SQL})",
            f"patients AS ({standins.PATIENTS_SQL})"]


def run_ctes() -> list[str]:
    linked = ("pacs_linked AS (SELECT i.*, EXISTS (SELECT 1 FROM valid v "
              "WHERE v.study_id IS NOT DISTINCT FROM i.pacs_study_id) AS v06_linked FROM pacs i)")
    return (base_ctes() + chain("", "studies")
            + [f"pacs AS (SELECT * FROM images WHERE acquisition_dt > {_ts(C.INITIAL_WATERMARK)})",
               linked])


def split_ctes() -> list[str]:
    lo, span = "(SELECT min(row_ix) FROM studies)", "(SELECT CAST(max(row_ix) - min(row_ix) AS DOUBLE) FROM studies)"
    return (base_ctes()
            + [f"first_src AS (SELECT * FROM studies WHERE row_ix < {lo} + {span} / 2)",
               f"second_src AS (SELECT * FROM studies WHERE row_ix >= {lo} + {span} / 3)"]
            + chain("a_", "first_src", run_ts=Q.FIRST_LOAD_TS)
            + chain("b_", "second_src", run_ts=Q.SECOND_LOAD_TS, fix_dr=True))


def sql(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _avg(s="s_us", c="c_us", d=1, per=None) -> str:
    x = f"CAST({s} AS DOUBLE) / NULLIF({c}, 0) / CAST({US_PER_MIN} AS DOUBLE)"
    if per:
        x = f"({x}) / CAST({per} AS DOUBLE)"
    return _rhu(x, d)


def _rate(r="r", n="n") -> str:
    return _rhu(f"CAST({r} AS DOUBLE) / NULLIF({n}, 0) * CAST(100 AS DOUBLE)", 1)


PARTS = ("count(*) AS n, sum(tat_us) AS s_us, count(tat_us) AS c_us, "
         "CAST(sum(report_issued_flag) AS BIGINT) AS r")
MERGE = "sum(n) AS n, sum(s_us) AS s_us, sum(c_us) AS c_us, CAST(sum(r) AS BIGINT) AS r"


def _pct_text(p: str, f: str) -> str:
    t = f"greatest({p} + {f}, 1)"
    tenths = f"((2000 * {p} + {t}) // (2 * {t}))"
    return (f"CAST({tenths} // 10 AS VARCHAR) || '.' || CAST({tenths} % 10 AS VARCHAR) || '%'")


def _summary_body() -> str:
    return (f"SELECT n AS total_studies, {_avg()} AS avg_tat_mins, {_avg(d=2, per=60)} AS avg_tat_hours, "
            f"r AS reports_issued, {_rate()} AS report_rate_pct, active_radiologists FROM "
            f"(SELECT {PARTS}, count(DISTINCT radiologist_key) AS active_radiologists "
            f"FROM factx WHERE tat_flag = 'OK') s")


def _by_modality_body(ok_only=True) -> str:
    where = "WHERE tat_flag = 'OK'" if ok_only else ""
    return (f"SELECT modality_name, modality_group, n AS study_count, {_avg()} AS avg_tat_mins, "
            f"r AS reports_issued, {_rate()} AS report_rate_pct FROM "
            f"(SELECT m.modality_name, m.modality_group, {MERGE} FROM "
            f"(SELECT modality_key, {PARTS} FROM factx {where} GROUP BY modality_key) f "
            f"JOIN dim_modality m ON f.modality_key = m.modality_key "
            f"GROUP BY m.modality_name, m.modality_group) g")


def _audit_ext() -> str:
    rows = []
    for src, cte in (("RIS", "ris"), ("PACS", "pacs"), ("EPR", "epr")):
        rows.append(f"SELECT {_ts(C.DEFAULT_RUN_TS)} AS event_time, {_q(C.SERVICE_ACCOUNT)} AS user_account, "
                    f"'EXTRACT' AS action, '{src}' AS source, count(*) AS record_count, "
                    f"'SUCCESS' AS status FROM {cte}")
    return " UNION ALL ".join(rows)


def _counts_table(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {t}"
                              for n, t in tables.items())


def oracle_sql() -> dict[str, str]:
    R = run_ctes()
    S = split_ctes()
    wm = _ts(C.CHECK_WATERMARK)
    epr = ("epr AS (SELECT * FROM patients p WHERE p.study_id IN "
           "(SELECT study_id FROM ris WHERE study_id IS NOT NULL))")
    out: dict[str, str] = {}
    out["extract_ris"] = sql(base_ctes(), f"SELECT * FROM studies WHERE exam_start_dt > {wm}")
    out["extract_pacs"] = sql(base_ctes(), f"SELECT * FROM images WHERE acquisition_dt > {wm}")
    out["extract_epr_semi"] = sql(base_ctes(), (
        f"SELECT * FROM patients p WHERE p.study_id IN "
        f"(SELECT study_id FROM studies WHERE exam_start_dt > {wm} AND study_id IS NOT NULL)"))
    out["next_watermark"] = sql(base_ctes(), (
        f"SELECT 'ris' AS source, coalesce(max(exam_start_dt), {wm}) AS last_extracted "
        f"FROM studies WHERE exam_start_dt > {wm} UNION ALL "
        f"SELECT 'pacs', coalesce(max(acquisition_dt), {wm}) FROM images WHERE acquisition_dt > {wm} "
        f"UNION ALL SELECT 'epr', coalesce(max(exam_start_dt), {wm}) FROM studies "
        f"WHERE exam_start_dt > {wm}"))
    out["extract_counts"] = sql(base_ctes(), (
        f"SELECT 'RIS' AS source, count(*) AS total_records, "
        f"count(*) FILTER (WHERE exam_start_dt > {wm}) AS new_records FROM studies UNION ALL "
        f"SELECT 'PACS', count(*), count(*) FILTER (WHERE acquisition_dt > {wm}) FROM images UNION ALL "
        f"SELECT 'EPR', (SELECT count(*) FROM patients), count(*) FROM patients p WHERE p.study_id IN "
        f"(SELECT study_id FROM studies WHERE exam_start_dt > {wm} AND study_id IS NOT NULL)"))
    out["extract_audit"] = sql(R + [epr], _audit_ext())

    out["v01_pass"] = sql(R, f"SELECT {RIS_COLS} FROM flagged WHERE NOT v01_fail")
    out["v01_reject"] = sql(R, f"SELECT {RIS_COLS} FROM flagged WHERE v01_fail")
    out["v02_pass"] = sql(R, f"SELECT {RIS_COLS} FROM pass2")
    out["v02_reject"] = sql(R, f"SELECT {RIS_COLS} FROM flagged WHERE NOT v01_fail AND v02_dup")
    out["v03_modality"] = sql(R, ("SELECT row_ix, study_id, modality_raw, modality_standard, "
                                  "v03_unmapped AS unmapped FROM pass2"))
    out["v04_patient_id"] = sql(R, ("SELECT row_ix, study_id, patient_id_checked AS patient_id, "
                                    "NOT v04_invalid AS patient_id_valid FROM pass2"))
    out["v05_turnaround"] = sql(R, "SELECT row_ix, study_id, turnaround_mins, tat_flag FROM pass2")
    out["v06_valid"] = sql(R, ("SELECT * FROM pacs i WHERE EXISTS (SELECT 1 FROM valid v "
                               "WHERE v.study_id IS NOT DISTINCT FROM i.pacs_study_id)"))
    out["v06_orphans"] = sql(R, ("SELECT * FROM pacs i WHERE NOT EXISTS (SELECT 1 FROM valid v "
                                 "WHERE v.study_id IS NOT DISTINCT FROM i.pacs_study_id)"))
    out["stream_v06"] = sql(R, ("SELECT i.*, EXISTS (SELECT 1 FROM valid v "
                                "WHERE v.study_id IS NOT DISTINCT FROM i.pacs_study_id) AS linked FROM pacs i"))
    out["v07_pseudonym"] = sql(R, "SELECT row_ix, study_id, patient_id_pseudo FROM valid")
    out["validated"] = sql(R, "SELECT * FROM valid")
    out["validated_from_csv"] = sql(R, "SELECT * EXCLUDE (row_ix) FROM valid")
    out["validated_from_reordered_csv"] = out["validated_from_csv"]
    ids = ("SELECT row_ix AS event_id, coalesce(study_id, '') AS sid, coalesce(patient_id, '') AS pid FROM studies")
    out["csv_bad_records"] = sql(base_ctes() + [f"l AS (SELECT *, {Q.RAGGED_LINE} AS line FROM ({ids}) s)"], (
        "SELECT 'row' AS kind, nullif(sid, '') AS study_id, nullif(pid, '') AS patient_id, "
        "CASE event_id % 50 WHEN 5 THEN concat('a', chr(10), '\"b\",c') ELSE concat('n', event_id) END AS note "
        "FROM l WHERE event_id % 50 NOT IN (3, 4) "
        "UNION ALL SELECT 'bad', line, NULL, sha256(line) FROM l WHERE event_id % 50 IN (3, 4)"))
    out["source_errors_three_runs"] = sql(base_ctes(), (
        f"SELECT DISTINCT ON (study_id, patient_id, exam_end_dt, report_issued_dt, modality_raw, radiologist_id, site_code, "
        f"priority, referral_source) study_id, 'E1' AS error_rule, {_q(C.EXTRA_RULE_DESCRIPTIONS['E1'])} AS error_detail, "
        f"{_ts(C.DEFAULT_RUN_TS)} AS captured_at FROM studies WHERE row_ix % 100 = 1"))
    out["pacs_from_csv"] = out["extract_pacs"]
    out["epr_from_csv"] = sql(base_ctes(), (
        f"SELECT study_id, {_sha('patient_id')} AS patient_id_pseudo, CAST(date_of_birth AS DATE) AS date_of_birth, gender, "
        f"gp_practice, trust_code, {_sha('nhs_number')} AS nhs_number_pseudo, ethnicity FROM patients"))

    counts = (
        "c AS (SELECT count(*) FILTER (WHERE NOT v01_fail) AS v01_p, count(*) FILTER (WHERE v01_fail) AS v01_f, "
        "count(*) FILTER (WHERE NOT v01_fail AND NOT v02_dup) AS v02_p, "
        "count(*) FILTER (WHERE NOT v01_fail AND v02_dup) AS v02_f, "
        "count(*) FILTER (WHERE NOT v01_fail AND NOT v02_dup AND NOT v03_unmapped) AS v03_p, "
        "count(*) FILTER (WHERE NOT v01_fail AND NOT v02_dup AND v03_unmapped) AS v03_f, "
        "count(*) FILTER (WHERE NOT v01_fail AND NOT v02_dup AND NOT v04_invalid) AS v04_p, "
        "count(*) FILTER (WHERE NOT v01_fail AND NOT v02_dup AND v04_invalid) AS v04_f, "
        "count(*) FILTER (WHERE NOT v01_fail AND NOT v02_dup AND tat_flag = 'OK') AS v05_p, "
        "count(*) FILTER (WHERE NOT v01_fail AND NOT v02_dup AND tat_flag <> 'OK') AS v05_f, "
        "count(*) FILTER (WHERE NOT v01_fail AND NOT v02_dup) AS v07_p, CAST(0 AS BIGINT) AS v07_f "
        "FROM flagged)")
    pc = ("pc AS (SELECT count(*) FILTER (WHERE v06_linked) AS v06_p, "
          "count(*) FILTER (WHERE NOT v06_linked) AS v06_f FROM pacs_linked)")
    rows = " UNION ALL ".join(
        f"SELECT '{r}' AS rule_id, {r.lower()}_p AS passed, {r.lower()}_f AS failed FROM "
        f"{'pc' if r == 'V06' else 'c'}" for r in C.RULE_ORDER)
    desc = _case("rule_id", C.RULE_DESCRIPTIONS)
    pos = _case("rule_id", {r: str(i) for i, r in enumerate(C.RULE_ORDER, 1)}, "99")
    out["quality_report"] = sql(R + [counts, pc], (
        f"SELECT rule_id, {desc} AS description, CAST(passed AS BIGINT) AS passed, "
        f"CAST(failed AS BIGINT) AS failed, {_pct_text('passed', 'failed')} AS pass_rate, "
        f"CAST(sum(failed) OVER (ORDER BY {pos} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
        f"AS BIGINT) AS total_failed FROM ({rows}) x"))
    samples = (
        "SELECT 'V01' AS rule_id, study_id AS sample, row_ix AS ord FROM flagged WHERE v01_fail "
        "UNION ALL SELECT 'V02', study_id, row_ix FROM flagged WHERE NOT v01_fail AND v02_dup "
        "UNION ALL SELECT 'V03', modality_raw, row_ix FROM pass2 WHERE v03_unmapped "
        "UNION ALL SELECT 'V05', study_id, row_ix FROM pass2 WHERE tat_flag <> 'OK' "
        "UNION ALL SELECT 'V06', pacs_study_id, CAST(NULL AS BIGINT) FROM pacs_linked "
        "WHERE NOT v06_linked")
    out["quality_samples"] = sql(R, (
        f"SELECT rule_id, sample_no, sample FROM (SELECT rule_id, sample, row_number() OVER "
        f"(PARTITION BY rule_id ORDER BY ord ASC NULLS LAST, sample ASC NULLS FIRST) AS sample_no "
        f"FROM ({samples}) s) x WHERE sample_no <= 3"))
    rej_pid = (f"CASE WHEN patient_id IS NULL OR patient_id = '' OR patient_id = "
               f"{_q(C.INVALID_PATIENT_ID)} THEN {_q(C.INVALID_PSEUDONYM)} ELSE {_sha('patient_id')} END")
    rejects = (
        f"rejects AS (SELECT row_ix, study_id, {rej_pid} AS patient_id_pseudo, exam_start_dt, exam_end_dt, "
        f"report_issued_dt, modality_raw, radiologist_id, site_code, priority, referral_source, "
        f"CASE WHEN v01_fail THEN 'V01' ELSE 'V02' END AS rule_id, {_ts(C.DEFAULT_RUN_TS)} AS captured_at "
        f"FROM flagged WHERE v01_fail OR v02_dup)")
    out["error_records"] = sql(R + [rejects], "SELECT * FROM rejects")
    errors = lambda run: (
        f"SELECT '{run}-' || rule_id || '-' || CAST(row_ix AS VARCHAR) AS error_id, study_id, rule_id AS error_rule, "
        f"{desc} AS error_detail, captured_at FROM rejects")
    out["error_table"] = sql(R + [rejects], errors(Q.FIRST_RUN_ID))
    out["error_table_two_runs"] = sql(R + [rejects], f"{errors(Q.FIRST_RUN_ID)} UNION ALL {errors(Q.SECOND_RUN_ID)}")

    out["surrogate_key"] = sql(R, (
        f"SELECT value, {_key('value')} AS surrogate_key FROM (SELECT DISTINCT value FROM ("
        f"SELECT modality_standard AS value FROM valid UNION ALL SELECT radiologist_id FROM valid "
        f"UNION ALL SELECT site_code FROM valid) u WHERE value IS NOT NULL) d"))
    out["dim_date"] = sql(R, "SELECT * FROM dim_date")
    out["dim_date_orders"] = sql([dim_date_cte("o_dim_date", "orders", "o_orderdate")],
                                 "SELECT * FROM o_dim_date")
    out["dim_modality"] = sql(R, "SELECT * FROM dim_modality")
    out["dim_radiologist"] = sql(R, "SELECT * FROM dim_radiologist")
    out["dim_location"] = sql(R, "SELECT * FROM dim_location")
    out["fact"] = sql(R, "SELECT * FROM fact")
    out["fact_without_tat"] = sql(R, "SELECT * EXCLUDE (priority, load_timestamp, partition_key) FROM fact")
    out["tat_band"] = sql(R, ("SELECT tat_band, count(*) AS study_count, min(turnaround_mins) AS min_mins, "
                              "max(turnaround_mins) AS max_mins FROM fact GROUP BY tat_band"))

    out["dim_upsert"] = sql(S, (
        "SELECT * FROM a_dim_radiologist a WHERE NOT EXISTS (SELECT 1 FROM b_dim_radiologist b "
        "WHERE b.radiologist_key = a.radiologist_key) UNION ALL SELECT * FROM b_dim_radiologist"))
    out["dim_upsert_date"] = sql(S, (
        "SELECT * FROM a_dim_date a WHERE NOT EXISTS (SELECT 1 FROM b_dim_date b "
        "WHERE b.date_key = a.date_key) UNION ALL SELECT * FROM b_dim_date"))
    appended = ("appended AS (SELECT * FROM a_fact UNION ALL SELECT * FROM b_fact b WHERE NOT EXISTS "
                "(SELECT 1 FROM a_fact a WHERE a.study_id IS NOT DISTINCT FROM b.study_id))")
    def counted(name: str, loaded: str, where: str = "") -> str:
        return (f"{name} AS (SELECT count(*) AS records_in, count(*) FILTER (NOT known) AS inserted, "
                f"count(*) FILTER (known) AS skipped FROM (SELECT EXISTS (SELECT 1 FROM {loaded} a "
                f"WHERE a.study_id IS NOT DISTINCT FROM b.study_id) AS known FROM b_fact b {where}))")

    cnt = counted("cnt", "a_fact")
    out["fact_append_null_ids"] = sql(S + [appended, counted("again", "appended"),
                                           counted("nulls", "a_fact", "WHERE b.study_id IS NULL")],
                                      "SELECT * FROM again UNION ALL SELECT * FROM nulls")
    out["fact_append"] = sql(S + [appended], "SELECT * FROM appended")
    out["fact_append_sketched"] = out["fact_append"]
    held = ("held AS (SELECT DISTINCT a.partition_key AS held_in, b.partition_key AS sent_in FROM a_fact a JOIN b_fact b "
            "ON a.study_id IS NOT DISTINCT FROM b.study_id)")
    out["fact_partitions_read"] = sql(S + [held], (
        "SELECT batch, count(DISTINCT held_in) AS partitions, min(held_in) AS first, max(held_in) AS last "
        f"FROM (VALUES ('all', ''), ('later', '{Q.SPLIT_MONTH}'), ('new', NULL)) AS t(batch, after) "
        "LEFT JOIN held ON sent_in > after GROUP BY batch"))
    out["fact_append_counts"] = sql(S + [cnt], "SELECT * FROM cnt")
    out["audit_row"] = sql(S + [cnt], (
        f"SELECT '{Q.SECOND_RUN_ID}-001' AS log_id, {_ts(Q.SECOND_LOAD_TS)} AS event_time, "
        f"'LOAD' AS pipeline_step, 'FACT_APPEND' AS action, CAST(records_in AS BIGINT) AS records_in, "
        f"CAST(inserted AS BIGINT) AS records_out, {_q(C.SERVICE_ACCOUNT)} AS user_account, "
        f"'SUCCESS' AS status, 'skipped=' || CAST(skipped AS VARCHAR) AS notes FROM cnt"))
    out["partition_counts"] = sql(S + [appended], (
        "SELECT partition_key, load_timestamp, count(*) AS row_count FROM appended "
        "GROUP BY partition_key, load_timestamp"))
    fk_rows = []
    for fk, dim, pk in (("date_key", "dim_date", "date_key"),
                        ("modality_key", "dim_modality", "modality_key"),
                        ("radiologist_key", "dim_radiologist", "radiologist_key"),
                        ("location_key", "dim_location", "location_key")):
        fk_rows.append(
            f"SELECT '{fk}' AS fk_column, CAST(coalesce(sum(n), 0) AS BIGINT) AS orphan_rows, "
            f"count(*) AS orphan_keys FROM (SELECT {fk} AS k, count(*) AS n FROM fact GROUP BY {fk}) f "
            f"WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{pk} = f.k)")
    out["fk_orphans"] = sql(R, " UNION ALL ".join(fk_rows))
    dup_rows = []
    for name, table, pk in (("staging_ris", "ris", "study_id"), ("fact_radiology", "fact", "study_id"),
                            ("dim_date", "dim_date", "date_key"),
                            ("dim_modality", "dim_modality", "modality_key"),
                            ("dim_radiologist", "dim_radiologist", "radiologist_key"),
                            ("dim_location", "dim_location", "location_key")):
        dup_rows.append(
            f"SELECT '{name}' AS table_name, count(*) AS duplicate_keys, "
            f"CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows FROM "
            f"(SELECT {pk}, count(*) AS n FROM {table} GROUP BY {pk} HAVING count(*) > 1) d")
    out["duplicate_keys"] = sql(R, " UNION ALL ".join(dup_rows))
    out["key_collisions"] = sql(R, (
        f"SELECT dimension, {_key('value', 2)} AS surrogate_key, count(DISTINCT value) AS members FROM ("
        f"SELECT 'dim_modality' AS dimension, modality_standard AS value FROM valid UNION ALL "
        f"SELECT 'dim_radiologist', radiologist_id FROM valid UNION ALL "
        f"SELECT 'dim_location', site_code FROM valid) u WHERE value IS NOT NULL "
        f"GROUP BY 1, 2 HAVING count(DISTINCT value) > 1"))
    out["stream_fact"] = sql(R, "SELECT * FROM fact")
    out["fact_by_file"] = out["stream_fact"]
    audit = (
        f"audit AS (SELECT '{Q.FIRST_RUN_ID}-EXTRACT-' || source AS log_id, event_time, "
        f"'EXTRACT' AS pipeline_step, action, record_count AS records_in, record_count AS records_out, "
        f"user_account, status, 'source=' || source AS notes FROM ({_audit_ext()}) e UNION ALL "
        f"SELECT '{Q.FIRST_RUN_ID}-001', {_ts(Q.FIRST_LOAD_TS)}, 'LOAD', 'FACT_APPEND', count(*), count(*), "
        f"{_q(C.SERVICE_ACCOUNT)}, 'SUCCESS', 'skipped=0' FROM fact)")
    out["audit_log"] = sql(R + [epr, audit], "SELECT * FROM audit")
    out["warehouse_sql"] = sql(R + [epr, audit, rejects], _counts_table({
        "dim_date": "dim_date", "dim_modality": "dim_modality", "dim_radiologist": "dim_radiologist",
        "dim_location": "dim_location", "fact_radiology": "fact", "audit_log": "audit", "error_table": "rejects"}))
    out["watermark_saved"] = sql(R, (
        "SELECT 'ris' AS source, max(exam_start_dt) AS last_extracted FROM ris UNION ALL "
        "SELECT 'epr', max(exam_start_dt) FROM ris UNION ALL SELECT 'pacs', max(acquisition_dt) FROM pacs"))
    linked = ("linked AS (SELECT * FROM pacs_linked WHERE v06_linked)")
    out["staged_outputs"] = sql(R + [epr, rejects, linked], " UNION ALL ".join(
        f"SELECT '{n}' AS output, count(*) AS row_count, 0 AS raw_id_columns FROM {t}" for n, t in (
            ("ris", "ris"), ("pacs", "pacs"), ("epr", "epr"), ("validated_ris", "valid"), ("validated_pacs", "linked"),
            ("validated_epr", "epr"), ("rejects", "rejects"))))
    out["run_history"] = " UNION ALL ".join(
        f"SELECT '{Q.FIRST_RUN_ID}' AS run_id, '{t}' AS task_id, 'SUCCESS' AS status"
        for t in ("extract", "validate", "transform_load", "report"))
    out["warehouse_counts"] = sql(R + [epr, audit, rejects], _counts_table({
        "fact_radiology": "fact", "dim_date": "dim_date", "dim_modality": "dim_modality",
        "dim_radiologist": "dim_radiologist", "dim_location": "dim_location",
        "audit_log": "audit", "error_table": "rejects"}))

    out["kpi_summary"] = sql(R, _summary_body())
    out["kpi_by_modality"] = sql(R, _by_modality_body() + " ORDER BY study_count DESC, modality_name")
    out["kpi_by_site"] = sql(R, (
        f"SELECT site_code, department, n AS study_count, {_avg()} AS avg_tat_mins FROM "
        f"(SELECT l.site_code, l.department, {MERGE} FROM "
        f"(SELECT location_key, {PARTS} FROM factx WHERE tat_flag = 'OK' GROUP BY location_key) f "
        f"JOIN dim_location l ON f.location_key = l.location_key GROUP BY l.site_code, l.department) g"))
    bands = [label for _, label in C.TAT_BANDS] + [C.TAT_BAND_OVER]
    out["kpi_tat_distribution"] = sql(R, (
        f"SELECT tat_band, count(*) AS study_count FROM fact WHERE tat_flag = 'OK' AND "
        f"tat_band <> {_q(C.TAT_BAND_INVALID)} GROUP BY tat_band ORDER BY "
        f"{_case('tat_band', {b: str(i) for i, b in enumerate(bands, 1)}, '6')}"))
    out["kpi_by_priority"] = sql(R, (
        f"SELECT priority, n AS study_count, {_avg()} AS avg_tat_mins FROM "
        f"(SELECT priority, {PARTS} FROM factx WHERE tat_flag = 'OK' GROUP BY priority) g"))
    out["kpi_monthly_trend"] = sql(R, (
        f"SELECT year_month, n AS study_count, {_avg()} AS avg_tat_mins FROM "
        f"(SELECT substr(CAST(date_key AS VARCHAR), 1, 6) AS year_month, {PARTS} FROM factx "
        f"WHERE tat_flag = 'OK' AND date_key IS NOT NULL GROUP BY 1) g ORDER BY year_month"))
    out["kpi_data_quality"] = sql(R, "SELECT tat_flag, count(*) AS record_count FROM fact GROUP BY tat_flag")
    out["kpi_top_modalities"] = sql(R, (
        f"SELECT modality_name, study_count, avg_tat_mins, report_rate_pct FROM "
        f"({_by_modality_body(False)}) m ORDER BY study_count DESC, modality_name LIMIT 10"))
    out["kpi_modality_head"] = sql(R, (
        f"SELECT modality_name, study_count, avg_tat_mins FROM ({_by_modality_body()}) m "
        f"ORDER BY study_count DESC, modality_name LIMIT 8"))
    card_rows = []
    for i, (label, col, unit) in enumerate(C.KPI_CARDS, 1):
        is_float = col in ("avg_tat_mins", "avg_tat_hours", "report_rate_pct")
        shown = (f"format('{{:,.1f}}', {col})" if is_float
                 else f"format('{{:,}}', CAST({col} AS BIGINT))")
        card_rows.append(f"SELECT CAST({i} AS INTEGER) AS card_no, {_q(label)} AS label, "
                         f"CAST({col} AS DOUBLE) AS value, {_q(unit)} AS unit, "
                         f"{shown} || {_q(unit)} AS display FROM s")
    out["kpi_cards"] = sql(R + [f"s AS ({_summary_body()})"], " UNION ALL ".join(card_rows))
    for name in ("summary", "by_modality", "by_site", "monthly_trend", "data_quality"):
        out[f"kept_kpi_{name}"] = out[f"kpi_{name}"]
    out["kpi_fact_sample"] = sql(R, "SELECT * FROM fact ORDER BY study_id LIMIT 10")

    perms = " UNION ALL ".join(f"SELECT {_q(r)} AS role, {_q(p)} AS permission"
                               for r, ps in C.ROLE_PERMISSIONS.items() for p in ps)
    out["access_review"] = (
        f"WITH perms AS ({perms}), req AS ({standins.REQUESTS_SQL}), "
        f"pairs AS (SELECT role, required_permission, count(*) AS request_count FROM req GROUP BY 1, 2)\n"
        f"SELECT p.role, p.required_permission, EXISTS (SELECT 1 FROM perms g WHERE g.role = p.role "
        f"AND g.permission = p.required_permission) AS granted, p.request_count FROM pairs p")
    out["access_denied_audit"] = (
        f"WITH perms AS ({perms}), req AS ({standins.REQUESTS_SQL})\n"
        f"SELECT '{Q.FIRST_RUN_ID}-ACCESS-' || CAST(request_id AS VARCHAR) AS log_id, {_ts(Q.FIRST_LOAD_TS)} AS event_time, "
        f"'ACCESS' AS pipeline_step, required_permission AS action, CAST(1 AS BIGINT) AS records_in, "
        f"CAST(0 AS BIGINT) AS records_out, role AS user_account, 'DENIED' AS status, 'role=' || role AS notes "
        f"FROM req r WHERE NOT EXISTS (SELECT 1 FROM perms g WHERE g.role = r.role AND g.permission = r.required_permission)")
    out["run_summary"] = sql(R, (
        "SELECT CAST(1 AS INTEGER) AS step_no, 'extract' AS task_id, 'SUCCESS' AS status, "
        "(SELECT count(*) FROM studies) AS records_in, (SELECT count(*) FROM ris) AS records_out "
        "UNION ALL SELECT 2, 'validate', 'SUCCESS', (SELECT count(*) FROM ris), (SELECT count(*) FROM valid) "
        "UNION ALL SELECT 3, 'transform', 'SUCCESS', (SELECT count(*) FROM valid), (SELECT count(*) FROM valid) "
        "UNION ALL SELECT 4, 'load', 'SUCCESS', (SELECT count(*) FROM valid), (SELECT count(*) FROM valid)"))
    return out
