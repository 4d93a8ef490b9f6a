"""Plan shape: pushdown, semi-joins, no cartesian products, no needless shuffles."""

import pytest

from stocktake.plans import analytics, registry
from stocktake.plans.normalize import Catalog
from stocktake.session import scratch_path
from stocktake.sources.tables import read_tables, write_tables
from tests.conftest import SF_SMALL
from tests.fixtures import raw_frame


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def written(spark):
    cat = Catalog(raw_frame(spark))
    out = scratch_path(spark, "plan-tables")
    write_tables(dict(cat.items()), out)
    return read_tables(spark, out, cat.names)


def test_filters_and_columns_reach_the_scan(written):
    plan = _plan(analytics.currency_price(written))
    assert "PushedFilters: [IsNotNull(base_amount), GreaterThan(base_amount,0" in plan
    assert "ReadSchema: struct<title_id:bigint,base_amount:decimal(38,18)," \
           "final_amount:decimal(38,18),currency:string>" in plan


def test_bridge_needs_no_join_to_inventory(spark):
    cat = Catalog(raw_frame(spark))
    plan = _plan(cat["title_genre"])
    # Only the genre lookup joins; inventory (and its party lookups) is not read.
    assert "Generate" in plan and "LeftSemi" not in plan
    assert "party_id" not in plan and "publisher_id" not in plan


def test_semi_join_planned_as_left_semi(spark):
    registry.load_all()
    plan = _plan(registry.QUERIES["c7_semi"](spark, SF_SMALL))
    assert "LeftSemi" in plan


def test_outer_join_with_null_rejecting_filter_becomes_inner(written):
    plan = _plan(analytics.platform_breadth(written))
    assert "LeftOuter" not in plan


def test_static_dimension_is_broadcast(written):
    assert "Broadcast" in _plan(analytics.type_contribution(written))


def test_bucketed_title_tables_join_without_shuffle(spark):
    from stocktake.sources.tables import load_saved_tables, save_tables
    cat = Catalog(raw_frame(spark))
    save_tables(dict(cat.items()), "plan_check", num_buckets=4)
    saved = load_saved_tables(spark, "plan_check", cat.names)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = _plan(analytics.era_quality(saved))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan
    assert "hashpartitioning(title_id" not in plan
    assert analytics.era_quality(saved).count() == analytics.era_quality(cat).count()
