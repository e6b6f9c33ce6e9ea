"""Every registered query against its DuckDB oracle (rows, columns, values)."""

import pytest

import __spark_entry__ as entry
from tessera.plans import catalog
from oracle_harness import compare, duck_connection

from conftest import SF_SMALL

QUERIES = {k: v for k, v in entry.queries().items() if k in catalog.QUERIES}
SQLS = {k: v for k, v in entry.oracle_sql().items() if k in catalog.QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQLS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    r = compare(spark, SF_SMALL, name, QUERIES[name], SQLS[name], con)
    assert r["values"], r.get("detail")


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["modality_name", "modality_group", "study_count", "avg_tat_mins",
                          "reports_issued", "report_rate_pct"]
