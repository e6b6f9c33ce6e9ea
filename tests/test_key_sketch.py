"""L2 through key filters: no key is missed, partitions without a key of the batch stay shut."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import key_sketch, warehouse
from tessera.operators.key_sketch import KeySketches
from tessera.plans import catalog


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def fact(spark):
    return catalog.Job(spark, SF_SMALL, stage_valid=True).fact().checkpoint()


def loaded(spark, scratch, *batches):
    wh = warehouse.Warehouse(spark, f"{scratch}/wh")
    wh.initialise()
    return wh, [wh.append_fact(b) for b in batches]


def keyed(spark, rows):
    return spark.createDataFrame(rows, "k string, p string")


def test_loads_that_overlap_equal_the_exact_append(spark, scratch, fact):
    first, second = fact.where("pmod(hash(study_id), 3) < 2"), fact.where("pmod(hash(study_id), 3) > 0")
    wh, counts = loaded(spark, scratch, first, second, second)
    want = warehouse.append_counts(first, second).first().asDict()
    assert counts[1] == want and counts[2] == {"records_in": want["records_in"], "inserted": 0, "skipped": want["records_in"]}
    got = wh.table("fact_radiology")
    assert got.exceptAll(fact.select(got.columns)).count() == 0 and got.count() == fact.count()


def test_a_batch_of_a_new_month_reads_no_old_partition(spark, scratch, fact):
    wh, _ = loaded(spark, scratch, fact)
    later = fact.select(F.concat(F.lit("NEW"), "study_id").alias("study_id"), *[c for c in fact.columns if c != "study_id"])
    later = later.where("study_id IS NOT NULL").withColumn("partition_key", F.lit("2031_01"))
    known = wh.fact_keys().may_hold(wh.table("fact_radiology"), later)
    assert wh.fact_keys().partitions(later) == [] and "FileScan" not in plan(known)


def test_one_known_key_opens_its_partition_only(spark, scratch, fact):
    wh, _ = loaded(spark, scratch, fact)
    one = fact.where("study_id IS NOT NULL").orderBy("study_id").limit(1)
    month = one.first().partition_key
    known = wh.fact_keys().may_hold(wh.table("fact_radiology"), one.withColumn("partition_key", F.lit("2031_01")))
    assert f"PartitionFilters: [isnotnull(partition_key" in plan(known) and month in plan(known)
    assert {r.partition_key for r in known.select("partition_key").distinct().collect()} == {month}


def test_a_fact_from_before_the_filters_is_settled(spark, scratch, fact):
    wh = warehouse.Warehouse(spark, f"{scratch}/wh")
    fact.write.partitionBy("partition_key").parquet(wh.path("fact_radiology"))
    with pytest.raises(ValueError):
        wh.fact_keys().partitions(fact)
    assert wh.append_fact(fact)["inserted"] == 0


def test_filters_of_a_load_that_died_lose_nothing(spark, scratch, fact):
    """Filters without rows only open a partition; the load that follows inserts all."""
    wh, _ = loaded(spark, scratch, fact.where("false"))
    wh.fact_keys().add(fact)
    assert wh.append_fact(fact)["inserted"] == fact.count()
    assert wh.append_fact(fact)["inserted"] == 0


def test_nulls_ties_repeats_and_a_null_partition(spark, scratch):
    rows = [("a", "x"), ("a", "x"), (None, "x"), ("b", None), ("", "y"), ("z" * 100_000, "y")]
    keys = KeySketches(spark, f"{scratch}/k", "k", "p")
    keys.settle(keyed(spark, rows))
    for key, part in rows:
        assert keys.partitions(keyed(spark, [(key, "other")])) == [part]
    assert keys.partitions(keyed(spark, [("c", "x")])) == [] and keys.partitions(keyed(spark, [])) == []
    table = keyed(spark, rows)
    assert keys.may_hold(table, keyed(spark, [("b", "q"), ("", "q")])).count() == 3


def test_no_key_is_missed_and_few_others_pass(spark, scratch):
    """A month with a hot share of the keys beside small ones, in loads of several sizes."""
    rows = spark.range(200_000).selectExpr("concat('S', id) AS k", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('m', id % 40) END AS p")
    keys = KeySketches(spark, f"{scratch}/k", "k", "p")
    keys.settle(rows.where("false"))
    for low, high in ((0, 150_000), (150_000, 199_000), (199_000, 200_000)):
        keys.add(rows.where(f"int(substr(k, 2)) >= {low} AND int(substr(k, 2)) < {high}"))
    kept = spark.read.parquet(f"{scratch}/k/filters")
    from tessera.operators.key_sketch import hits
    sizes = [r["size"] for r in kept.select("size").distinct().collect()]
    assert len(sizes) > 3
    found = hits(kept, rows, "k", sizes).distinct()
    assert rows.select("p", "k").exceptAll(found.select(F.col("part").alias("p"), "k")).count() == 0
    strange = rows.select(F.concat(F.lit("T"), "k").alias("k"), "p")
    assert hits(kept, strange, "k", sizes).count() <= 5


def test_a_probe_of_few_bytes_runs_in_many_tasks(spark):
    rows = keyed(spark, [(f"k{i}", f"p{i % 5}") for i in range(2000)])
    made = key_sketch.sketch(rows, "k", "p")
    sizes = [r.size for r in made.select("size").distinct().collect()]
    met = key_sketch.hits(made, rows, "k", sizes)
    assert {(r.k, r.part) for r in met.collect()} >= {(r.k, r.p) for r in rows.collect()}
    assert met.select(F.spark_partition_id().alias("i")).distinct().count() > 1


def test_a_load_computes_its_batch_once(spark, scratch, fact):
    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for f in frames:
            seen.add(f.num_rows)
            yield f

    _, counts = loaded(spark, scratch, fact.mapInArrow(count, fact.schema))
    assert seen.value == counts[0]["records_in"] == fact.count()
