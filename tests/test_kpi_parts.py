"""K9: KPIs of kept parts against those of the whole fact."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import warehouse
from tessera.plans import catalog, kpis
from tessera.plans.kpi_parts import KpiParts


@pytest.fixture(scope="module")
def star(spark):
    j = catalog.Job(spark, SF_SMALL, stage_valid=True)
    odd = "CASE WHEN hash(study_id) % 9 = 0 THEN NULL ELSE {0} END"
    fact = j.fact().withColumns({c: F.expr(odd.format(c)) for c in ("turnaround_mins", "date_key", "priority")})
    fact = fact.withColumn("radiologist_key", F.expr("CASE WHEN hash(study_id) % 7 = 0 THEN -1 WHEN hash(study_id) % 7 = 1 "
                                                     "THEN 0 WHEN hash(study_id) % 7 = 2 THEN 4294967295 ELSE radiologist_key END"))
    return fact.checkpoint(), j.dims["dim_modality"].checkpoint(), j.dims["dim_location"].checkpoint()


def rows(tables):
    return {k: sorted(map(str, t.collect())) for k, t in tables.items()}


def parts_of(spark, scratch):
    wh = warehouse.Warehouse(spark, f"{scratch}/wh")
    wh.initialise()
    return wh, KpiParts(spark, f"{scratch}/parts")


def test_three_loads_equal_the_whole_fact(spark, scratch, star):
    fact, modality, location = star
    wh, parts = parts_of(spark, scratch)
    for i in range(3):
        wh.append_fact(fact.where(f"pmod(hash(study_id), 3) <= {i}"), parts, f"L{i}")  # later loads repeat the earlier rows
        parts.settle(wh.table("fact_radiology"))
    assert rows(parts.kpis(modality, location)) == rows(kpis.all_kpis(fact, modality, location))
    plans = [t._jdf.queryExecution().executedPlan().toString() for t in parts.kpis(modality, location).values()]
    assert not any("fact_radiology" in p for p in plans)


def test_a_replayed_load_counts_once(spark, scratch, star):
    fact, modality, location = star
    wh, parts = parts_of(spark, scratch)
    for _ in range(2):
        wh.append_fact(fact, parts, "L0")
    parts.publish("L0")
    assert rows(parts.kpis(modality, location)) == rows(kpis.all_kpis(fact, modality, location))


@pytest.mark.parametrize("written", [False, True])
def test_a_load_that_died_is_settled(spark, scratch, star, written):
    """Parts without a publication, with and without their fact rows; then another load."""
    fact, modality, location = star
    wh, parts = parts_of(spark, scratch)
    first, second = fact.where("pmod(hash(study_id), 2) = 0"), fact.where("pmod(hash(study_id), 2) = 1")
    parts.add(first, "DEAD")
    if written:
        wh.append_fact(first)
    for load, part in (("L1", second), ("L2", fact)):
        parts.settle(wh.table("fact_radiology"))
        wh.append_fact(part, parts, load)
    assert rows(parts.kpis(modality, location)) == rows(kpis.all_kpis(fact, modality, location))


def test_without_loads_the_kpis_are_those_of_an_empty_fact(spark, scratch, star):
    fact, modality, location = star
    _, parts = parts_of(spark, scratch)
    none = fact.where("false")
    parts.settle(none)
    assert rows(parts.kpis(modality, location)) == rows(kpis.all_kpis(none, modality, location))
