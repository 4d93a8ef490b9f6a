"""Every registered query against its DuckDB twin on the small driver tables."""

import os

import pytest

from tests.conftest import SF_SMALL

import __spark_entry__ as entry  # noqa: E402
from tools.oracle_check import TABLES, _rows

from stocktake.plans import registry  # noqa: E402

registry.load_all()
QUERIES, SQL = registry.QUERIES, registry.ORACLE_SQL


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    from pyspark.sql import types as T
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    # Plan shape: no cartesian product or nested-loop join anywhere.
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # A single-partition exchange may only carry partial aggregates (one row
    # per task), never unaggregated rows.
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            assert "partial_" in lines[i + 1], lines[i + 1]
    # Decimal results are reported as text with all their digits (see registry.DECIMAL_SCALES).
    if name != "a1_csv_stage":
        assert not any(isinstance(f.dataType, T.DecimalType) for f in df.schema.fields)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    drows = [tuple(r[dcols.index(c)] for c in cols) for r in cur.fetchall()]
    assert len(srows) == len(drows)
    assert _rows(cols, srows) == _rows(cols, drows)


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["publisher_name", "catalog_presence", "median_rating"]
    assert df.count() > 0

