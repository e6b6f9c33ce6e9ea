import hashlib

from pyspark.sql import functions as F

from llm_fixtures import *  # noqa: F401,F403
from tessera.llm import exact_dedup as op

AZ = {c: c + 32 for c in range(65, 91)}


def brute(rows):
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        groups.setdefault((text or "").translate(AZ), []).append((doc_id, i))
    out = []
    for t, members in groups.items():
        keep = max((d for d, _ in members if d is not None), default=None)
        out += [(d, keep, len(members), hashlib.sha256(t.encode()).hexdigest()) for d, _ in members]
    return sorted(out, key=str)


ROWS = [(1, "Abc"), (2, "aBC"), (3, "abc "), (4, None), (5, ""), (6, "ÄÉ"), (7, "äé"), (8, "x" * 200_000), (9, "X" * 200_000),
        (10, "İ K"), (11, "same"), (11, "same"), (12, "SAME"), (None, "same"), (None, "alone"), (-5, "Abc")]


def result(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=str)


def test_edge_cases_and_kept_rows(spark, frame, scratch):
    frame(ROWS).write.parquet(f"{scratch}/docs")
    out = op.exact_dedup(spark, f"{scratch}/docs", f"{scratch}/state").cache()
    assert result(out) == brute(ROWS)
    kept = out.where("kept").groupBy("text_sha256").count().collect()
    assert len(kept) == len({t for *_, t in brute(ROWS)}) and all(r["count"] == 1 for r in kept)


def test_colliding_digests_are_told_apart_by_their_bytes(spark, frame, scratch, monkeypatch):
    monkeypatch.setattr(op, "ROWS_PER_SALT", 2)
    frame(ROWS).write.parquet(f"{scratch}/docs")
    weak = lambda c: F.substring(F.sha2(c.cast("binary"), 256), 1, 1)
    out = op.exact_dedup(spark, f"{scratch}/docs", f"{scratch}/state", digest=weak)
    assert result(out) == brute(ROWS)


def test_state_goes_on_with_new_files_only(spark, frame, scratch):
    first, later = ROWS[:8], ROWS[8:]
    frame(first).coalesce(1).write.parquet(f"{scratch}/docs")
    args = dict(max_files_per_trigger=1)
    assert result(op.exact_dedup(spark, f"{scratch}/docs", f"{scratch}/state", **args)) == brute(first)
    frame(later).repartition(3).write.mode("append").parquet(f"{scratch}/docs")
    assert result(op.exact_dedup(spark, f"{scratch}/docs", f"{scratch}/state", **args)) == brute(ROWS)
    batches = spark.read.parquet(f"{scratch}/state/ledger").agg(F.countDistinct("batch")).first()[0]
    assert batches > 2  # micro-batches of the same state


def test_empty_table(spark, frame, scratch):
    frame([]).write.parquet(f"{scratch}/docs")
    assert op.exact_dedup(spark, f"{scratch}/docs", f"{scratch}/state").count() == 0


def test_plan_has_no_python(spark, frame, scratch):
    frame(ROWS).write.parquet(f"{scratch}/docs")
    plan = op.exact_dedup(spark, f"{scratch}/docs", f"{scratch}/state")._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"))
