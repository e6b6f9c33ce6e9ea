"""Runs over the export files that no run has loaded."""

import os

import pytest
from pyspark.sql import functions as F

from tessera.operators import warehouse
from tessera.plans import catalog
from tessera.plans.batch import run_exports
from tessera.schemas import EPR_COLUMNS, PACS_COLUMNS, RIS_COLUMNS
from tessera.sources.ledger import FileLedger

RIS = dict.fromkeys(RIS_COLUMNS, "x") | {
    "patient_id": "12345678", "exam_start_dt": "2023-05-01 10:00:00", "exam_end_dt": "2023-05-01 10:30:00",
    "report_issued_dt": "2023-05-01 12:00:00", "modality_raw": "CT"}


def put(path, columns, rows, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as f:
        if mode == "w":
            f.write(",".join(columns) + "\n")
        f.writelines(r if isinstance(r, str) else ",".join(r[c] for c in columns) + "\n" for r in rows)


def study(key, day="2023-05-01"):
    return RIS | {"study_id": key, "exam_start_dt": f"{day} 10:00:00", "exam_end_dt": f"{day} 10:30:00",
                  "report_issued_dt": f"{day} 12:00:00"}


@pytest.fixture
def exports(scratch):
    put(f"{scratch}/ris/a.csv", RIS_COLUMNS, [study("s1", "2023-06-01"), study("s2"), study("s3") | {"exam_start_dt": "never"}, "short,row\n"])
    put(f"{scratch}/pacs/a.csv", PACS_COLUMNS, [])
    put(f"{scratch}/epr/a.csv", EPR_COLUMNS, [])
    return scratch


def run(spark, root, n):
    return run_exports(spark, f"{root}/ris", f"{root}/pacs", f"{root}/epr", f"{root}/job", run_ts="2024-02-01 05:00:00", run_id=f"RUN_{n}")


def state(spark, root):
    wh = warehouse.Warehouse(spark, f"{root}/job/warehouse")
    return {t: wh.table(t).count() for t in ("fact_radiology", "audit_log", "error_table")}


def keys(spark, root):
    return {r.study_id for r in warehouse.Warehouse(spark, f"{root}/job/warehouse").table("fact_radiology").select("study_id").collect()}


def test_late_grown_and_unchanged_files(spark, exports):
    assert run(spark, exports, 1)["files"] == 2
    assert keys(spark, exports) == {"s1", "s2"}
    before = state(spark, exports)
    assert before["error_table"] >= 2  # the bad start and the ragged record
    assert run(spark, exports, 2)["files"] == 0 and state(spark, exports) == before
    # a late file: its study is older than the mark
    put(f"{exports}/ris/late 1.csv", RIS_COLUMNS, [study("s4", "2022-01-01"), study("s2")])
    assert run(spark, exports, 3)["files"] == 1
    assert keys(spark, exports) == {"s1", "s2", "s4"}
    assert state(spark, exports)["error_table"] == before["error_table"]
    # a file that grew is read again; what it had is loaded once
    put(f"{exports}/ris/a.csv", RIS_COLUMNS, [study("s5", "2022-02-02")], mode="a")
    assert run(spark, exports, 4)["files"] == 1
    assert keys(spark, exports) == {"s1", "s2", "s4", "s5"} and state(spark, exports)["fact_radiology"] == 4
    assert state(spark, exports)["error_table"] == before["error_table"]


def test_a_failed_run_leaves_its_files(spark, exports):
    put(f"{exports}/ris/b.csv", RIS_COLUMNS[1:], [study("s9")])  # lacks a column
    with pytest.raises(Exception):
        run(spark, exports, 1)
    ledger = FileLedger(spark, f"{exports}/job/_state/files")
    assert ledger.table().count() == 0
    put(f"{exports}/ris/b.csv", RIS_COLUMNS, [study("s9")])
    assert run(spark, exports, 2)["files"] == 3 and "s9" in keys(spark, exports)


def test_names_with_pattern_characters_are_refused(spark, exports):
    put(f"{exports}/ris/late[1].csv", RIS_COLUMNS, [study("s4")])
    with pytest.raises(ValueError, match="pattern"):
        run(spark, exports, 1)


def test_listing_reads_no_content(spark, exports):
    from tessera.sources.ledger import listed
    plan = listed(spark, "ris", f"{exports}/ris")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan
    assert listed(spark, "ris", f"{exports}/ris").where(F.col("length") > 0).count() == 1


@pytest.mark.parametrize("bins", [2, 4096])
def test_the_middle_of_the_studies_by_counts(spark, bins):
    for values in ([], [None], [7], [7, 7, 9], [1, 2], [-5, None, 3, 10**6, 4], [-2**63, 0, 2**63 - 1, 2**62]):
        rows = spark.createDataFrame([(v,) for v in values], "row_ix bigint")
        exact = rows.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY row_ix)")).first()[0]
        assert catalog._median(rows, "row_ix", bins) == (None if exact is None else int(exact)), values
