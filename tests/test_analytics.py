"""Reports on the hand-written catalogue (hand-computed expectations)."""

import pytest

from stocktake.functions import tiers
from stocktake.plans import analytics
from stocktake.plans.normalize import Catalog
from tests.fixtures import ROWS, raw_frame


@pytest.fixture(scope="module")
def cat(spark):
    return Catalog(raw_frame(spark))


def test_median_by_party(cat):
    out = analytics.median_by_party(cat, "developer", min_titles=2).collect()
    assert [(r.developer_name, r.catalog_presence, r.median_rating) for r in out] == [
        ("Alpha", 2, 4.5)]


def test_median_having_default_filters_small_parties(cat):
    assert analytics.median_by_party(cat, "publisher").count() == 0


def test_age_by_genre(cat):
    out = analytics.age_by_genre(cat, min_titles=1).collect()
    assert [(r.genre_name, r.title_count, r.avg_age_limit) for r in out] == [
        ("action", 2, 12.5), ("rpg", 1, 12.0)]


def test_reviews_by_age_tier(cat):
    out = {r.age_restriction_group: (r.game_count, r.total_reviews_sum)
           for r in analytics.reviews_by_age_tier(cat).collect()}
    L = tiers.AGE_TIER_LABELS
    assert out == {L[0]: (1, 10), L[1]: (1, 5), L[2]: (1, 7), L[3]: (1, 1)}


def test_support_skeleton(cat):
    out = {r.support_status: (r.game_count, r.avg_customer_rating, r.total_reviews_sum)
           for r in analytics.support_skeleton(cat).collect()}
    missing = out[tiers.SUPPORT_MISSING_LABEL]
    assert out[tiers.SUPPORT_PRESENT_LABEL] == (2, 3.5, 15)
    assert missing[0] == 3 and abs(missing[1] - 8.5 / 3) < 1e-12 and missing[2] == 1


def test_support_skeleton_empty_category(spark):
    rows = [dict(r, supporturl="http://ok") for r in ROWS]
    out = {r.support_status: (r.game_count, r.avg_customer_rating, r.total_reviews_sum)
           for r in analytics.support_skeleton(Catalog(raw_frame(spark, rows))).collect()}
    assert out[tiers.SUPPORT_MISSING_LABEL] == (0, None, None)


def test_type_contribution_sorted_nulls_first(cat):
    out = analytics.type_contribution(cat).collect()
    # Bundle (title 2) and DLC (title 3) and Game (1, 6, 7); DLC has no review count.
    assert [r.product_category for r in out][0] == "DLC"
    got = {r.product_category: (r.catalog_count, r.total_reviews_proxy) for r in out}
    assert got == {"Game": (3, 10), "Bundle": (1, 5), "DLC": (1, None)}


def test_platform_breadth(cat):
    out = [(r.num_platforms, r.game_count) for r in analytics.platform_breadth(cat).collect()]
    assert out == [(2, 1), (1, 1)]


def test_all_reports_run(cat):
    for name, report in analytics.REPORTS.items():
        assert report(cat).columns, name


def test_order_desc_nulls_first(spark):
    from stocktake.plans import registry
    from tests.conftest import SF_SMALL
    registry.load_all()
    df = registry.QUERIES["f_order_nulls_first"](spark, SF_SMALL)
    import re
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"returned_qty#\d+ DESC NULLS FIRST", plan)
    qty = [None if r.returned_qty is None else float(r.returned_qty) for r in df.collect()]
    nulls = [q for q in qty if q is None]
    assert qty[:len(nulls)] == nulls                      # NULLs (if any) come first
    rest = qty[len(nulls):]
    assert rest == sorted(rest, reverse=True)             # then descending
