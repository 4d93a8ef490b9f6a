"""Data-quality checks: duplicates, NULLs, orphans, load report."""

import re

import pytest

from stocktake.operators import quality
from stocktake.plans.normalize import Catalog
from tests.fixtures import ROWS, raw_frame


def test_duplicates_and_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (3, "c"), (3, "c")],
                               "k int, v string")
    dups = sorted(tuple(r) for r in quality.duplicate_keys(df, ["k"]).collect())
    assert dups == [(1, 2), (3, 2)]
    assert sorted(tuple(r) for r in quality.duplicate_keys(df, ["k", "v"]).collect()) == [(3, "c", 2)]
    assert quality.null_counts(df, ["k", "v"]).first().asDict() == {"k": 0, "v": 1}


def test_orphans_allow_null_references(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(10, 1), (11, None), (12, 3)], "cid int, pid int")
    assert [r.cid for r in quality.orphans(child, "pid", parent, "id").collect()] == [12]


def test_load_report_clean_after_normalise(spark):
    cat = Catalog(raw_frame(spark))
    tables = dict(cat.items())
    tables["raw"] = raw_frame(spark)
    report = {r.table_name: r for r in quality.load_report(tables).collect()}
    assert report["inventory"].row_count == 7
    assert report["title_genre"].row_count == 8
    for r in report.values():
        assert (r.duplicate_key_rows, r.null_violations, r.orphan_rows) == (0, 0, 0), r
    quality.assert_clean(quality.load_report(tables))


def test_load_report_flags_violations(spark):
    rows = ROWS + [dict(ROWS[0], title="dup id")]
    tables = {"raw": raw_frame(spark, rows)}
    report = quality.load_report(tables).first()
    assert report.duplicate_key_rows == 2


def _no_broadcast(spark):
    return {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}


@pytest.fixture
def sort_merge(spark):
    old = _no_broadcast(spark)
    for k in old:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _below_exchanges(df):
    """The plan node under each exchange that hashes its rows."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]


def test_references_shuffle_counted_keys_only(spark, sort_merge):
    """A hot key and NULLs cost one row per task; no row of the child is shuffled."""
    child = spark.range(0, 9000, numPartitions=6).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id % 40 END AS a",
        "cast(id % 5 AS int) AS b", "repeat('x', 50) AS payload")
    parents = spark.range(30).withColumnRenamed("id", "pk"), spark.range(4).withColumnRenamed("id", "pk")
    keys = quality.orphan_keys(child, [("a", parents[0], "pk"), ("b", parents[1], "pk")])
    under = _below_exchanges(keys)
    # Counted child keys, and parents' keys (a union of distinct ones, or on the way to them).
    assert any("partial_count" in line for line in under), under
    assert all("HashAggregate" in line or "Union" in line for line in under), under
    assert "payload" not in keys._jdf.queryExecution().executedPlan().toString()
    got = {(r.ref, r.key): r.occurrences for r in keys.collect()}
    assert got == {(0, k): 75 for k in range(30, 40)} | {(1, 4): 1800}
    report = quality.load_report({"c": child, "p": parents[0], "q": parents[1]}, primary={"c": ["id"], "p": ["pk"], "q": ["pk"]},
                                 unique={}, not_null={}, refs=[("c", "a", "p", "pk"), ("c", "b", "q", "pk")])
    assert {r.table_name: r.orphan_rows for r in report.collect()} == {"c": 750 + 1800, "p": 0, "q": 0}


def test_orphan_rows_are_sorted_out_in_place(spark, sort_merge):
    child = spark.range(0, 3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id = 1 THEN 'gone' ELSE concat('k', id % 9) END AS k")
    parent = spark.sql("SELECT explode(array('hot', 'k0', 'k1', 'k2', 'k3', 'k4', 'k5', 'k6', 'k7', 'k8')) AS name")
    found = quality.orphans(child, "k", parent, "name")
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Rows of the child meet the bitmap before they are shuffled.
    assert re.search(r"Exchange hashpartitioning\(k#.*\n.*Project.*\n.*BroadcastHashJoin .*LeftSemi", plan), plan
    assert [tuple(r) for r in found.collect()] == [(1, "gone")]
    assert quality.orphans(child, "k", parent.limit(0), "name").count() == 3000
