"""Column helpers on the edge rows the source listing produces."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from stocktake.functions import clean, tiers


def _one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_text_flag_only_exact_t(spark):
    vals = ["t", "f", None, "", "T", "true", "t "]
    assert _one_col(spark, vals, clean.text_flag) == [True, False, False, False, False, False,
                                                      False]


def test_trimmed_flag(spark):
    assert _one_col(spark, ["t", " t ", "f", None], clean.trimmed_text_flag) == [
        True, True, False, False]


def test_epoch_seconds(spark):
    out = _one_col(spark, ["1262304000", "1262303999", None, ""],
                   clean.epoch_seconds_to_timestamp)
    assert out == [dt.datetime(2010, 1, 1), dt.datetime(2009, 12, 31, 23, 59, 59), None, None]


def test_epoch_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        out = _one_col(spark, ["1262304000"], clean.epoch_seconds_to_timestamp)
        assert out == [dt.datetime(2010, 1, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_guarded_decimal(spark):
    vals = ["FALSE", "true", "", None, "0", "25"]
    assert _one_col(spark, vals, clean.guarded_decimal) == [
        None, None, None, None, Decimal("0.0000"), Decimal("25.0000")]


def test_blank_decimal_strict(spark):
    assert _one_col(spark, ["9.99", ""], clean.blank_decimal) == [Decimal("9.9900"), None]
    with pytest.raises(Exception):
        _one_col(spark, ["TRUE"], clean.blank_decimal)


def test_strict_int_cast(spark):
    assert _one_col(spark, [" 12 ", "0", "-1"], clean.to_int) == [12, 0, -1]
    with pytest.raises(Exception):
        _one_col(spark, ["12.0"], clean.to_int)


def test_json_list_items(spark):
    vals = ["['windows', 'osx']", '["windows"]', '[""linux""]', "[]", None]
    out = _one_col(spark, vals, clean.json_list_items)
    assert out == [["windows", "osx"], ["windows"], ["linux"], [], None]


@pytest.mark.parametrize("text", ["bad", "['a']['b']", "['a'] junk", "['a'], ['b']", "['a'"])
def test_json_list_items_bad_text_fails(spark, text):
    with pytest.raises(Exception):
        _one_col(spark, [text], clean.json_list_items)


def test_json_list_items_other_mode_gives_null(spark):
    vals = ["['a'] junk", "['a'], ['b']", "['a', 1]", ""]
    assert _one_col(spark, vals, lambda c: clean.json_list_items(c, strict=False)) == [None, None, ["a", "1"], None]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_conversions_are_strict_whatever_the_session(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for text, fn in (("abc", clean.blank_decimal), ("1x", clean.blank_int), ("12.0", clean.to_int),
                         ("soon", clean.epoch_seconds_to_timestamp), ("9" * 15, clean.epoch_seconds_to_timestamp),
                         ("1e", clean.blank_decimal), (".", clean.blank_decimal), ("1.2.3", clean.blank_decimal)):
            with pytest.raises(Exception):
                _one_col(spark, [text], fn)
            assert _one_col(spark, [text, "", None], lambda c: fn(c, strict=False) if fn is not clean.to_int else fn(
                clean.blank_to_null(c), strict=False)) == [None] * 3
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_small_amounts_keep_their_digits(spark):
    vals = ["0.00004", "4.333333", "0.00001", "1e-3"]
    assert _one_col(spark, vals, clean.blank_decimal) == [Decimal(v) for v in vals]
    lossy = ["0." + "0" * 18 + "1", "4.3333333333333333333333", "1.50000000000000000000", "1e30", "", None, "x"]
    assert _one_col(spark, lossy, clean.loses_digits) == [True, True, False, True, False, False, False]
    df = spark.createDataFrame([("0.00004", "0", "0", "f", "0.00001", "f")], "b string, f string, a string, t string, p string, d string")
    row = df.select(clean.free_title(*(clean.blank_decimal(c) for c in "bfa"), "t").alias("free"),
                    clean.discounted(clean.guarded_decimal("p"), "d").alias("off")).first()
    assert (row.free, row.off) == (False, True)


NUMBERS = ["1e-20", "4.333333333333333", "123456789012345678901234567890", "-1e-20", "-5e40", "+007.500", " 12 ", "-0.0", "0e9", ".5", "5.",
           "-.25E2", "1E+3", "99999999999999999999.9999999999999999999", "99999999999999999999.999999999999999999", "0.1234567890123456785",
           "0.0000000000000000005", "0.00000000000000000049", "1e-00300", "12345.678e-3"]


def test_no_number_is_refused_or_loses_digits(spark):
    """Every number: canonical digits as Python's decimals have them, and the nearest stored value that keeps the sign."""
    with localcontext() as exact:
        exact.prec = 500
        want = [Decimal(t.strip()) for t in NUMBERS]
        got = _one_col(spark, NUMBERS, clean.canonical_number)
        for text, value in zip(got, want):
            assert Decimal(text) == value and not set(text) & set("+eE ") and text != "-0"
            assert text == "0" or text.strip("-")[0] != "0" or text.strip("-").startswith("0.")
            assert "." not in text or text[-1] not in "0."
        stored = _one_col(spark, NUMBERS, clean.blank_decimal)
        beside = _one_col(spark, NUMBERS, clean.exact_digits)
        top, tiny = Decimal(10 ** 38 - 1).scaleb(-18), Decimal(1).scaleb(-18)
        for value, near, digits, text in zip(want, stored, beside, got):
            nearest = min(max(value.quantize(tiny, ROUND_HALF_UP), -top), top)
            assert near == (nearest or (tiny if value > 0 else -tiny if value < 0 else 0))
            assert digits == (None if near == value else text)


def test_amounts_beyond_the_type_compare_but_do_not_sum(spark):
    df = spark.createDataFrame([("1e30",), ("-1e30",), ("1e-30",), ("0",)], "t string").select(clean.blank_decimal("t").alias("a"))
    assert [r[0] for r in df.select(F.signum("a")).collect()] == [1, -1, 1, 0]
    assert df.where("a < 1 AND a > -1").agg(F.sum(clean.in_range("a"))).first()[0] == Decimal("1e-18")
    with pytest.raises(Exception, match="beyond 20 digits"):
        df.agg(F.sum(clean.in_range("a"))).collect()


def test_rejected_text(spark):
    assert _one_col(spark, ["1", "1.0", "", None, "x", " 7 "], lambda c: clean.rejected(c, "integer")) == [False, True, False, False, True, False]
    assert _one_col(spark, ["1", "", None, "x"], lambda c: clean.rejected(c, "filled integer")) == [False, True, False, True]
    assert _one_col(spark, ["1e400", "1e", "TRUE", "", None], lambda c: clean.rejected(c, "amount")) == [False, True, True, False, False]
    assert _one_col(spark, ["1", "9" * 14, "x"], lambda c: clean.rejected(c, "epoch")) == [False, True, True]
    assert _one_col(spark, ["['a']", "['a'] x", " ", "[]"], lambda c: clean.rejected(c, "list")) == [False, True, False, False]


def test_epochs_beyond_twelve_digits(spark):
    out = _one_col(spark, ["1262304000000", "-1"], lambda c: clean.epoch_seconds_to_timestamp(c).cast("string"))
    assert out == ["+41970-10-28 00:00:00", "1969-12-31 23:59:59"]


def test_text_list_items(spark):
    vals = ["['Action', 'RPG']", "[action,rpg]", "['a', , 'b']", '["x"]', "", None]
    out = _one_col(spark, vals, clean.text_list_items)
    assert out == [["Action", "RPG"], ["action", "rpg"], ["a", "", "b"], ['"x"'], [""], None]


def test_missing_text(spark):
    vals = [None, "", "  ", "N/A", " none ", "TBD", "http://x"]
    assert _one_col(spark, vals, clean.is_missing_text) == [True] * 6 + [False]


def test_age_tiers(spark):
    out = _one_col(spark, [0, -1, 12, 13, 16, 17, None], tiers.age_tier, "int")
    L = tiers.AGE_TIER_LABELS
    assert out == [L[0], L[1], L[1], L[2], L[2], L[3], L[4]]


def test_cutoffs_null_dates(spark):
    vals = [dt.datetime(2009, 12, 31, 23, 59), dt.datetime(2010, 1, 1), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v timestamp_ntz")
    two = [r[0] for r in df.orderBy("i").select(tiers.cutoff_two_way("v")).collect()]
    assert two == [tiers.CLASSIC_LABEL, tiers.MODERN_LABEL, tiers.MODERN_LABEL]
    three = [r[0] for r in df.orderBy("i").select(tiers.cutoff_three_way("v")).collect()]
    assert three == [tiers.BACK_CATALOG_LABEL, tiers.BACK_CATALOG_LABEL, tiers.UNKNOWN_DATE_LABEL]


def test_bool_label_and_content_group(spark):
    df = spark.createDataFrame([(True, "Game"), (False, "Bundle"), (False, "DLC"),
                                (False, "Game"), (False, "Other"), (None, None)],
                               "m boolean, t string")
    out = [r[0] for r in df.select(tiers.content_group("m", "t")).collect()]
    assert out == ["Movie Content", "Bundle (Package)", "DLC/Add-on Content", "Full Game Title",
                   "Other/Unknown Content", "Other/Unknown Content"]
    labels = [r[0] for r in df.select(tiers.bool_label("m")).collect()]
    assert labels[0] == tiers.FREE_LABEL and labels[1] == tiers.PAID_LABEL
    assert labels[-1] == tiers.UNKNOWN_PRICE_LABEL
