"""V06 in the stream: images before, with and after their study equal the batch rule."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera import session
from tessera.operators import extract, quality
from tessera.plans import catalog
from tessera.streaming import incremental, linkage

STUDY = "study_id string, exam_start_dt timestamp_ntz, exam_end_dt timestamp_ntz, row_ix bigint"
IMAGE = "pacs_study_id string, accession_number string, acquisition_dt timestamp_ntz"


def frame(spark, rows, schema):
    return spark.createDataFrame([[str(v) if v is not None else None for v in r] for r in rows],
                                 ", ".join(f.split()[0] + " string" for f in schema.split(", "))
                                 ).selectExpr(*[f"CAST({f.split()[0]} AS {f.split()[1]}) AS {f.split()[0]}" for f in schema.split(", ")])


def study(key, day, end=True, ix=0):
    at = f"2024-01-{day:02d} 10:00:00"
    return key, at, at if end else None, ix


def image(key, name, day):
    return key, name, None if day is None else f"2024-01-{day:02d} 12:00:00"


# micro-batches of (studies, images)
STEPS = [
    ([study("A", 1), study("A", 1, ix=1)], [image("A", "with", 1), image("B", "before", 2), image("X", "orphan", 2),
                                            image("V", "invalid study", 2), image("A", "no time", None)]),
    ([study("B", 3), study("V", 2, end=False), study(None, 3)], [image(None, "null key", 3), image("", "empty key", 3)]),
    ([study("A", 3), study("L" * 50_000, 4)], [image("A", "after", 2), image("A", "after", 2), image("L" * 50_000, "long", 4)]),
]


def run(spark, root, **kw):
    q = linkage.start_linkage(spark, f"{root}/images", f"{root}/studies", f"{root}/out", f"{root}/ckpt",
                              frame(spark, [], IMAGE).schema, frame(spark, [], STUDY).schema,
                              watermark="2020-01-01 00:00:00", **kw)
    q.awaitTermination()


def beat(spark, root, at="2024-06-01 00:00:00"):
    linkage.heartbeat(spark, f"{root}/images", f"{root}/studies", frame(spark, [], IMAGE).schema,
                      frame(spark, [], STUDY).schema, at)


def test_micro_batches_equal_the_batch_rule(spark, scratch):
    for i, (studies, images) in enumerate(STEPS):
        frame(spark, studies, STUDY).coalesce(1).write.mode("append").parquet(f"{scratch}/studies")
        frame(spark, images, IMAGE).coalesce(1).write.mode("append").parquet(f"{scratch}/images")
        run(spark, scratch)
        if i == 0:
            early = {r.accession_number for r in linkage.outcomes(spark, f"{scratch}/out").collect()}
            assert early == {"with"}  # the others wait for a study
    beat(spark, scratch)
    run(spark, scratch)
    out = linkage.outcomes(spark, f"{scratch}/out")
    studies = extract.extract_ris(frame(spark, [r for s, _ in STEPS for r in s], STUDY), "2020-01-01 00:00:00")
    images = extract.extract_pacs(frame(spark, [r for _, p in STEPS for r in p], IMAGE), "2020-01-01 00:00:00")
    valid = quality.first_rows(studies.where(~quality.v01_null_timestamps(studies)), "study_id", "row_ix")
    want = quality.pacs_flagged(images, valid).withColumnRenamed("_v06_linked", "linked").select(*out.columns)
    key = F.substring("pacs_study_id", 1, 5)
    assert sorted(map(str, out.withColumn("pacs_study_id", key).collect())) == sorted(
        map(str, want.withColumn("pacs_study_id", key).collect()))
    assert out.where("accession_number = 'after'").count() == 2  # equal images are all kept


def test_bounds_and_clashing_columns_are_refused(spark):
    images, studies = frame(spark, [], IMAGE), frame(spark, [], STUDY)
    with pytest.raises(ValueError):
        linkage.linked_stream(images, studies, 3, 6)
    with pytest.raises(ValueError):
        linkage.linked_stream(images.withColumn("linked", F.lit(1)), studies, 1, 3)


def test_the_join_is_a_stream_join_on_the_key(spark, scratch, capsys):
    j = catalog.Job(spark, SF_SMALL)
    for name, df in (("images", j.images), ("studies", j.studies)):
        df.limit(5).write.parquet(f"{scratch}/{name}")
    q = linkage.start_linkage(spark, f"{scratch}/images", f"{scratch}/studies", f"{scratch}/out", f"{scratch}/ckpt",
                              j.images.schema, j.studies.schema)
    q.awaitTermination()
    q.explain()
    p = capsys.readouterr().out
    assert "StreamingSymmetricHashJoin" in p and "StreamingDeduplicateWithinWatermark" in p
    assert "CartesianProduct" not in p and "referral_source" not in p


def test_a_step_of_many_files_links_as_the_batch(spark, scratch, monkeypatch):
    monkeypatch.setattr(incremental, "FILE_ROWS", 100)
    monkeypatch.setattr(session, "scratch_path", lambda s, name: f"{scratch}/{name}")
    got = catalog.q_stream_v06(spark, SF_SMALL)
    j = catalog.Job(spark, SF_SMALL)
    want = j.pacs_linked.withColumnRenamed("_v06_linked", "linked").select(*got.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    names = [f for f in os.listdir(f"{scratch}/stream_v06/images") if f.endswith(".parquet")]
    assert len(names) > 3 * 2 and spark.conf.get("spark.sql.streaming.maxBatchesToRetainInMemory") == "2"
