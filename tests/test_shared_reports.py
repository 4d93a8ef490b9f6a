"""Seven reports from one pass: the same rows as each by itself, and one scan of each title table."""

import pytest

from stocktake.plans import analytics
from stocktake.plans.listing import listing
from stocktake.plans.normalize import Catalog
from stocktake.session import scratch_path
from stocktake.sources.tables import load_saved_tables, read_tables, save_tables, write_tables
from tests.conftest import SF_SMALL
from tests.fixtures import ROWS, raw_frame

MORE = [dict(ROWS[0], id=31, baseamount="1e40", amount="", overallavgrating="", type=None, agelimit=""),
        dict(ROWS[1], id=32, ismovie="t", reviewscount="", finalamount="-1e40"), dict(ROWS[2], id=33, globalreleasedate="1700000000")]


def _same(tables, names=analytics.BY_TITLE):
    shared = analytics.reports_by_title(analytics.title_groups(tables))
    assert tuple(shared) == analytics.BY_TITLE
    for name in names:
        alone = analytics.REPORTS[name](tables)
        assert shared[name].dtypes == alone.dtypes, name
        assert sorted(map(str, shared[name].collect())) == sorted(map(str, alone.collect())), name


def test_same_rows_as_the_single_reports(spark):
    _same(Catalog(raw_frame(spark)))
    _same(Catalog(listing(spark, SF_SMALL), keys="hash"))
    _same(Catalog(raw_frame(spark, ROWS[:1])))
    _same(Catalog(raw_frame(spark).limit(0)))


def test_an_amount_beyond_the_type_ends_only_the_reports_that_sum_it(spark):
    cat = Catalog(raw_frame(spark, ROWS + MORE[1:]))
    _same(cat, [n for n in analytics.BY_TITLE if n != "release_price"])
    cat = Catalog(raw_frame(spark, ROWS + [dict(ROWS[1], id=34, baseamount="1e40")]))
    shared = analytics.reports_by_title(analytics.title_groups(cat))
    _same(cat, ["reviews_by_age_tier", "free_vs_paid", "support_skeleton"])
    for report in (shared["content_groups"], analytics.REPORTS["content_groups"](cat)):
        with pytest.raises(Exception, match="beyond 20 digits"):
            report.collect()


def test_tables_without_all_titles(spark):
    """Titles that a status table lacks are left out where the single reports leave them out."""
    cat = dict(Catalog(listing(spark, SF_SMALL)).items())
    cat["pricing"] = cat["pricing"].where("title_id % 3 > 0")
    cat["rating"] = cat["rating"].where("title_id % 5 > 0")
    _same(cat)


def test_each_title_table_is_read_once_and_not_shuffled_when_bucketed(spark):
    cat = Catalog(raw_frame(spark))
    out = scratch_path(spark, "shared-tables")
    write_tables(dict(cat.items()), out)
    plan = analytics.title_groups(read_tables(spark, out, cat.names))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 4  # the three, and the product types
    save_tables(dict(cat.items()), "shared_check", num_buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = analytics.title_groups(load_saved_tables(spark, "shared_check", cat.names))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Expand" in plan and "hashpartitioning(title_id" not in plan
