"""Hash-key mode: same tables up to key values, same reports, no dimension joins."""

import pytest

from stocktake.operators import quality
from stocktake.plans import analytics
from stocktake.plans.listing import listing
from stocktake.plans.normalize import Catalog
from tests.conftest import SF_SMALL
from tests.fixtures import raw_frame


def _named(cat):
    """Key-free view of the tables: foreign keys replaced by the names."""
    names = {d: {r[1]: r[0] for r in cat[d].collect()} for d in
             ("party", "genre", "os_platform", "promotion")}
    back = {d: {k: n for n, k in m.items()} for d, m in names.items()}
    inv = sorted((r.title_id, back["party"].get(r.publisher_id), back["party"].get(r.developer_id))
                 for r in cat["inventory"].collect())
    tg = sorted((r.title_id, back["genre"][r.genre_id]) for r in cat["title_genre"].collect())
    to = sorted((r.title_id, back["os_platform"][r.os_id]) for r in cat["title_os"].collect())
    ds = sorted((r.title_id, back["promotion"][r.promo_id], r.is_discounted)
                for r in cat["discount_status"].collect())
    return {"names": {d: sorted(m) for d, m in names.items()}, "inventory": inv,
            "title_genre": tg, "title_os": to, "discount_status": ds}


@pytest.mark.parametrize("source", ["fixture", "driver"])
def test_hash_mode_matches_dense_mode(spark, source):
    raw = raw_frame(spark) if source == "fixture" else listing(spark, SF_SMALL)
    dense, hashed = Catalog(raw), Catalog(raw, keys="hash")
    assert _named(dense) == _named(hashed)
    for name, report in analytics.REPORTS.items():
        a = sorted((tuple(r) for r in report(dense).collect()), key=repr)
        b = sorted((tuple(r) for r in report(hashed).collect()), key=repr)
        assert a == b, name


def test_hash_mode_fact_tables_need_no_join(spark):
    cat = Catalog(raw_frame(spark), ids_unique=True, keys="hash")  # as the job does after its id check
    for name in ("inventory", "discount_status", "title_genre", "title_os"):
        plan = cat[name]._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan, name


def test_hash_mode_quality_clean(spark):
    cat = Catalog(raw_frame(spark), keys="hash")
    quality.assert_clean(quality.load_report(dict(cat.items())))
