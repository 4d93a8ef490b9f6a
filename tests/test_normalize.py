"""Normalisation end to end on hand-written staging rows (hand-computed results)."""

import datetime as dt
from decimal import Decimal

import pytest

from stocktake.plans.normalize import Catalog, build_pricing, build_title_genre
from tests.fixtures import raw_frame


@pytest.fixture(scope="module")
def cat(spark):
    return Catalog(raw_frame(spark))


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_party_dense_keys_in_name_order(cat):
    assert _rows(cat["party"], "party_id", "name") == [
        (1, " Alpha"), (2, "Alpha"), (3, "Beta"), (4, "Gamma")]


def test_genre_folded_deduped_blanks_dropped(cat):
    assert _rows(cat["genre"], "genre_id", "genre_name") == [
        (1, '"x"'), (2, "a"), (3, "action"), (4, "b"), (5, "rpg")]


def test_os_platform_case_kept(cat):
    assert _rows(cat["os_platform"], "os_id", "os_name") == [
        (1, "linux"), (2, "osx"), (3, "windows")]


def test_promotion_trimmed(cat):
    assert _rows(cat["promotion"], "promo_id", "promo_name") == [(1, "summer"), (2, "winter")]


def test_inventory_one_row_per_title(cat):
    inv = {r.title_id: r for r in cat["inventory"].collect()}
    assert sorted(inv) == [1, 2, 3, 4, 5, 6, 7]
    assert (inv[1].publisher_id, inv[1].developer_id) == (2, 2)
    assert (inv[2].publisher_id, inv[2].developer_id) == (2, 3)
    assert (inv[3].publisher_id, inv[3].developer_id) == (None, 1)
    assert (inv[4].publisher_id, inv[4].developer_id) == (4, None)
    assert inv[1].release_date == dt.datetime(2010, 1, 1)
    assert inv[2].release_date == dt.datetime(2009, 12, 31, 23, 59, 59)
    assert inv[4].release_date is None
    assert inv[1].is_game is True and inv[7].is_game is False  # 'T' is not true
    assert inv[7].is_movie is True and inv[6].age_limit == -1


def test_pricing_free_rules(cat):
    rows = {r.title_id: r for r in cat["pricing"].collect()}
    assert [rows[i].is_free for i in range(1, 8)] == [True, True, False, True, False, False,
                                                      False]
    assert rows[3].base_amount == Decimal("9.9900") and rows[4].base_amount is None


def test_rating(cat):
    rows = {r.title_id: r for r in cat["rating"].collect()}
    assert rows[3].overall_avg_rating is None and rows[3].reviews_count is None
    assert rows[1].reviews_count == 10 and rows[1].is_reviewable is True


def test_discount_status(cat):
    rows = {r.title_id: r for r in cat["discount_status"].collect()}
    assert sorted(rows) == [1, 2, 6]
    assert (rows[1].promo_id, rows[1].discount_percentage, rows[1].is_discounted) == (1, None, True)
    assert rows[2].discount_percentage == Decimal("25.0000") and rows[2].is_discounted is True
    assert (rows[6].promo_id, rows[6].is_discounted) == (2, False)


def test_bridges(cat):
    assert _rows(cat["title_genre"], "title_id", "genre_id") == [
        (1, 3), (1, 5), (2, 3), (2, 5), (3, 3), (6, 2), (6, 4), (7, 1)]
    assert _rows(cat["title_os"], "title_id", "os_id") == [(1, 2), (1, 3), (2, 3), (3, 1)]


def test_semi_join_form_matches_filter_form(spark, cat):
    raw = raw_frame(spark)
    inv = cat["inventory"]
    assert _rows(build_pricing(raw, inv), "title_id", "is_free") == _rows(
        cat["pricing"], "title_id", "is_free")
    explicit = build_title_genre(raw, cat["genre"], inv, ids_unique=False)
    assert _rows(explicit, "title_id", "genre_id") == _rows(cat["title_genre"], "title_id",
                                                            "genre_id")


def test_rows_without_id_are_dropped(spark):
    from tests.fixtures import ROWS
    rows = ROWS + [dict(id=None, title="orphan", developer="Zed")]
    cat = Catalog(raw_frame(spark, rows))
    assert cat["inventory"].count() == 7
    assert cat["pricing"].count() == 7
    assert "Zed" in [r.name for r in cat["party"].collect()]
