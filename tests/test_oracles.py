"""Every registered query against its DuckDB oracle (the driver's gate, at a
small scale factor so the suite stays fast)."""

import pytest

import __spark_entry__ as entry
from scripts.oracle_check import digest
from tests.conftest import SF_SMALL

ORACLES = entry.oracle_sql()
# queries whose fixture needs the larger scale factor to be non-trivial
MID = {"m01_cap_outliers_iqr", "m02_cap_outliers_zscore"}


@pytest.fixture(scope="module")
def con_small(duck):
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con_small, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    rel = con_small.sql(ORACLES[name])
    drows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert len(srows) == len(drows)
    hs, ls = digest(sdf.columns, srows)
    hd, ld = digest(rel.columns, drows)
    assert hs == hd, (sorted(set(ls) - set(ld))[:3], sorted(set(ld) - set(ls))[:3])


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "total_load_actual" in df.columns
