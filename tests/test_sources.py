"""Sources: stand-in views, CSV exports, watermark state."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.functions import exprs as X
from tessera.operators import extract
from tessera.sources import exports, standins
from tessera.sources.state import WatermarkState

from conftest import SF_MID, SF_SMALL


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_standins_equal_sql_texts(spark):
    ev = standins.read_table(spark, SF_MID, "events")
    ev.createOrReplaceTempView("events")
    assert _same(standins.studies(ev), spark.sql(standins.STUDIES_SQL))
    assert _same(standins.images(ev), spark.sql(standins.IMAGES_SQL))
    assert _same(standins.patients(ev), spark.sql(standins.PATIENTS_SQL))


def test_standins_cover_the_rules(spark):
    s = standins.studies(standins.read_table(spark, SF_MID, "events"))
    assert s.select(F.date_format("exam_start_dt", "yyyy-MM")).distinct().count() >= 18
    assert s.where("study_id IS NULL").count() > 0 and s.where("site_code IS NULL").count() > 0


def test_csv_positions_are_unique_and_ordered(spark, scratch):
    rows = spark.range(500).selectExpr("id AS row_ix", *[f"cast(id AS string) AS {c}" for c in exports.RIS_COLUMNS])
    rows.drop("row_ix").repartition(3).write.option("header", True).csv(f"{scratch}/ris")
    got = exports.read_ris_csv(spark, f"{scratch}/ris")
    assert got.select("row_ix").distinct().count() == 500


def test_standin_counts(spark):
    ev = standins.read_table(spark, SF_MID, "events")
    assert standins.studies(ev).count() == 10_000


def test_csv_export_roundtrip(spark, scratch):
    ev = standins.read_table(spark, SF_SMALL, "events")
    studies = standins.studies(ev).drop("row_ix")
    text = studies.select(*[F.col(c).cast("string").alias(c) for c in studies.columns])
    # a few pandas-style null tokens written as text
    text = text.withColumn("modality_raw", F.coalesce("modality_raw", F.lit("NA")))
    text.write.option("header", True).csv(f"{scratch}/ris")
    back = exports.type_ris(exports.read_ris_csv(spark, f"{scratch}/ris"))
    assert back.count() == studies.count()
    assert dict(back.dtypes)["exam_start_dt"] == "timestamp_ntz"
    assert back.where(F.col("modality_raw") == "NA").count() == 0
    assert back.where(F.col("modality_raw").isNull()).count() == studies.where(
        F.col("modality_raw").isNull()).count()
    # timestamps survive the text round trip
    assert back.agg(F.max("exam_start_dt")).first()[0] == studies.agg(
        F.max("exam_start_dt")).first()[0]


def test_null_tokens_and_bad_timestamps(spark):
    df = spark.createDataFrame([("NULL",), ("nan",), ("x",), ("",), ("2024-01-02 03:04:05",),
                                ("05/12/2025 10:11",), ("2024-13-45 00:00:00",)], "v string")
    out = df.select(X.null_tokens_to_null("v").alias("n"),
                    X.parse_timestamp("v").alias("t")).collect()
    assert [r.n for r in out[:4]] == [None, None, "x", None]
    assert out[4].t == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert out[5].t == dt.datetime(2025, 12, 5, 10, 11)
    assert out[6].t is None


def test_extract_strict_and_text_input(spark):
    df = spark.createDataFrame([("2024-01-15 00:00:00",), ("2024-01-15 00:00:01",), ("bad",)],
                               "exam_start_dt string")
    assert extract.since_watermark(df, "exam_start_dt", "2024-01-15 00:00:00").count() == 1
    assert extract.unparseable_starts(df, "exam_start_dt").count() == 1


def test_lookback_rereads_ties_and_late_rows(spark):
    df = spark.createDataFrame([("2024-01-14 22:00:00",), ("2024-01-14 23:30:00",), ("2024-01-15 00:00:00",)], "t string")
    assert extract.since_watermark(df, "t", "2024-01-15 00:00:00").count() == 0
    assert extract.since_watermark(df, "t", "2024-01-15 00:00:00", lookback_hours=1).count() == 2


def test_watermark_state(spark, scratch):
    st = WatermarkState(spark, f"{scratch}/wm")
    assert st.current()["ris"] == "1900-01-01 00:00:00"
    marks = spark.createDataFrame([("ris", dt.datetime(2024, 1, 30, 1, 2, 3, 456))],
                                  "source string, last_extracted timestamp_ntz")
    st.save(marks, "RUN_1")
    cur = st.current()
    assert cur["ris"] == "2024-01-30 01:02:03.000456" and cur["pacs"] == "1900-01-01 00:00:00"


def _write(scratch, name, text):
    import os
    os.makedirs(f"{scratch}/{name}", exist_ok=True)
    path = f"{scratch}/{name}/export.csv"
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def test_csv_columns_go_by_header_name(spark, scratch):
    path = _write(scratch, "a", 'extra,b,a\r\nx,"two, ""2""\r\nlines",1\r\n\r\n,,NA\r\ny,  z ,3\r\n')
    got = exports.read_csv_export(spark, path, ["a", "b"], "at")
    assert [tuple(r) for r in got.orderBy("at").select("a", "b").collect()] == [
        ("1", 'two, "2"\nlines'), (None, None), ("3", "  z ")]
    assert got.columns == ["at", "a", "b"]
    import pandas as pd
    want = pd.read_csv(path, dtype=str)[["a", "b"]]
    assert [tuple(None if pd.isna(v) else v.replace("\r\n", "\n") for v in r) for r in want.itertuples(index=False)] == [
        tuple(None if v is None else v.replace("\r\n", "\n") for v in r) for r in got.orderBy("at").select("a", "b").collect()]


def test_csv_missing_column_is_an_error(spark, scratch):
    import pytest
    path = _write(scratch, "m", "a,b\n1,2\n")
    with pytest.raises(ValueError, match="lacks"):
        exports.read_csv_export(spark, path, ["a", "c"])


def test_csv_files_of_another_header_are_an_error(spark, scratch):
    import pytest
    _write(scratch, "h", "a,b\n1,2\n")
    with open(f"{scratch}/h/other.csv", "w") as f:
        f.write("b,a\n1,2\n")
    with pytest.raises(Exception):
        exports.read_csv_export(spark, f"{scratch}/h", ["a", "b"]).collect()


def test_csv_ragged_records_are_never_shifted(spark, scratch):
    path = _write(scratch, "r", 'a,b,c\n1,2,3\n4,5\n6,7,8,9\n"x\ny",,\n10,11,"open\n12,13,14\n')
    good = exports.read_csv_export(spark, path, ["a", "c"]).collect()
    assert ("4", None) not in [tuple(r) for r in good] and {("1", "3"), ("x\ny", None)} <= {tuple(r) for r in good}
    assert exports.read_csv_export(spark, path, ["c"]).count() == len(good)  # whatever columns are needed
    assert {"4,5", "6,7,8,9"} <= {r.record for r in exports.csv_bad_records(spark, path).collect()}


def test_csv_plan_reads_once_and_by_name(spark, scratch):
    path = _write(scratch, "p", "b,a\n1,2\n")
    plan = exports.read_csv_export(spark, path, ["a"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "Exchange" not in plan
