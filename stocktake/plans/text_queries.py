"""Registered checks for scalar conversions, rule chains, tiers and list parsing.

The raw text each helper converts is produced by a deterministic expression
over a driver table (shared verbatim with the DuckDB twin). Where the library has
a helper for the conversion (:mod:`stocktake.functions`), the check uses it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import clean, tiers
from ..operators.aggregates import mean
from ..sources.tables import read_table
from . import sql_rules
from .registry import register


def _t(spark: SparkSession, base: str, name: str) -> DataFrame:
    return read_table(spark, base, name)


def _with(df: DataFrame, **exprs: str) -> DataFrame:
    for name, e in exprs.items():
        df = df.withColumn(name, F.expr(e))
    return df


_JSON_ITEMS_SQL = ("from_json(replace(replace(trim({c}), '''', '\"'), '\"\"', '\"'), "
                   "'[\"VARCHAR\"]')")
# --- H1-H8: CASE, NULLIF, COALESCE, TRIM, case folding, REPLACE, casts ---------

_BALANCE_BAND_SQL = """CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 1000 THEN 'low'
    WHEN c_acctbal < 5000 THEN 'mid' ELSE 'high' END"""


@register("h1_case", f"""SELECT {_BALANCE_BAND_SQL} AS balance_band,
  COUNT(c_custkey) AS customer_count FROM customer GROUP BY 1""")
def h1_case(spark, base):
    b = F.col("c_acctbal")
    band = (F.when(b < 0, "negative").when(b < 1000, "low").when(b < 5000, "mid")
            .otherwise("high"))
    return (_t(spark, base, "customer").withColumn("balance_band", band)
            .groupBy("balance_band").agg(F.count("c_custkey").alias("customer_count")))


_SEGMENT_TEXT = "CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE c_mktsegment END"


@register("h2_blank_to_null", f"""SELECT c_custkey, NULLIF({_SEGMENT_TEXT}, '') AS segment
FROM customer""")
def h2_blank_to_null(spark, base):
    c = _with(_t(spark, base, "customer"), seg_text=_SEGMENT_TEXT)
    return c.select("c_custkey", clean.blank_to_null("seg_text").alias("segment"))


_MAYBE_BALANCE = "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal END"


@register("h3_coalesce", f"""SELECT c_custkey, COALESCE({_MAYBE_BALANCE}, 0) AS balance_or_zero
FROM customer""")
def h3_coalesce(spark, base):
    c = _with(_t(spark, base, "customer"), bal=_MAYBE_BALANCE)
    return c.select("c_custkey",
                    F.coalesce(F.col("bal"), F.lit(0).cast("double")).alias("balance_or_zero"))


_PADDED_BRAND = "CASE WHEN p_partkey % 2 = 0 THEN '  ' || p_brand || ' ' ELSE p_brand END"


@register("h4_trim", f"SELECT p_partkey, trim({_PADDED_BRAND}) AS brand FROM part")
def h4_trim(spark, base):
    p = _with(_t(spark, base, "part"), padded=_PADDED_BRAND)
    return p.select("p_partkey", F.trim("padded").alias("brand"))


@register("h5_case_fold", """SELECT p_partkey, lower(p_type) AS type_lower,
  upper(p_name) AS name_upper FROM part""")
def h5_case_fold(spark, base):
    p = _t(spark, base, "part")
    return p.select("p_partkey", F.lower("p_type").alias("type_lower"),
                    F.upper("p_name").alias("name_upper"))


_PY_LIST = """CASE WHEN p_partkey % 3 = 0 THEN ' [""' || p_brand || '""] '
    ELSE '[''' || p_brand || ''', ''' || p_type || ''']' END"""


@register("h6_replace", f"""SELECT p_partkey,
  replace(replace(trim({_PY_LIST}), '''', '"'), '""', '"') AS json_text FROM part""")
def h6_replace(spark, base):
    p = _with(_t(spark, base, "part"), raw=_PY_LIST)
    return p.select("p_partkey", clean.pylist_to_json("raw").alias("json_text"))


_SIZE_TEXT = "' ' || CAST(p_size AS STRING) || ' '"


@register("h7_int_cast", f"SELECT p_partkey, CAST({_SIZE_TEXT} AS INTEGER) AS size_int FROM part")
def h7_int_cast(spark, base):
    p = _with(_t(spark, base, "part"), txt=_SIZE_TEXT)
    return p.select("p_partkey", clean.to_int("txt").alias("size_int"))


_PRICE_TEXT = ("CASE p_partkey % 31 WHEN 3 THEN '1e-20' WHEN 5 THEN '4.333333333333333' WHEN 7 THEN '123456789012345678901234567890' "
               "WHEN 9 THEN '0.12345678901234567891' ELSE "
               "CAST(p_size AS STRING) || '.' || lpad(CAST(p_partkey % 100 AS STRING), 2, '0') "
               "|| CAST(p_partkey % 7 AS STRING) || CASE WHEN p_partkey % 5 = 0 THEN '00001' ELSE '' END END")


@register("h8_decimal_cast", f"""SELECT p_partkey, {sql_rules.stored('t')} AS price, {sql_rules.exact_digits('t')} AS price_exact,
  coalesce({sql_rules.exact_digits('t')}, rtrim(rtrim(CAST(t::DECIMAL(38,18) AS VARCHAR), '0'), '.')) AS digits
FROM (SELECT p_partkey, {_PRICE_TEXT} AS t FROM part) x""")
def h8_decimal_cast(spark, base):
    p = _with(_t(spark, base, "part"), t=_PRICE_TEXT)
    return p.select("p_partkey", clean.blank_decimal("t").alias("price"), clean.exact_digits("t").alias("price_exact"),
                    clean.canonical_number("t").alias("digits"))


# --- H9-H15: epochs, flags, guarded casts, rule chains, missing text -----------

_EPOCH_CASE = """CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 11 = 1 THEN ''
    ELSE CAST({days} * 86400 + o_orderkey % 86400 AS STRING) END"""
_DAYS_SPARK = "datediff(CAST(o_orderdate AS DATE), DATE'1970-01-01')"
_DAYS_DUCK = "date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE))"


@register("h9_epoch", f"""SELECT o_orderkey, CASE WHEN e IS NOT NULL AND e <> ''
    THEN make_timestamp(CAST(e AS BIGINT) * 1000000) END AS released_at
FROM (SELECT o_orderkey, {_EPOCH_CASE.format(days=_DAYS_DUCK)} AS e FROM orders) x""")
def h9_epoch(spark, base):
    o = _with(_t(spark, base, "orders"), e=_EPOCH_CASE.format(days=_DAYS_SPARK))
    return o.select("o_orderkey", clean.epoch_seconds_to_timestamp("e").alias("released_at"))


_FLAG_TEXT = """CASE o_orderkey % 7 WHEN 0 THEN 't' WHEN 1 THEN 'f' WHEN 2 THEN NULL
    WHEN 3 THEN '' WHEN 4 THEN 'T' WHEN 5 THEN 'true' ELSE 't ' END"""


@register("h10_flag", f"""SELECT raw_flag, CASE WHEN raw_flag = 't' THEN TRUE ELSE FALSE END AS flag,
  COUNT(o_orderkey) AS order_count
FROM (SELECT o_orderkey, {_FLAG_TEXT} AS raw_flag FROM orders) x GROUP BY 1, 2""")
def h10_flag(spark, base):
    o = _with(_t(spark, base, "orders"), raw_flag=_FLAG_TEXT)
    return (o.withColumn("flag", clean.text_flag("raw_flag")).groupBy("raw_flag", "flag")
            .agg(F.count("o_orderkey").alias("order_count")))


_PADDED_FLAG = """CASE o_orderkey % 5 WHEN 0 THEN ' t ' WHEN 1 THEN 't' WHEN 2 THEN ' f'
    WHEN 3 THEN NULL ELSE 'f' END"""


@register("h11_trimmed_flag", f"""SELECT raw_flag,
  CASE WHEN trim(raw_flag) = 't' THEN TRUE ELSE FALSE END AS flag, COUNT(o_orderkey) AS order_count
FROM (SELECT o_orderkey, {_PADDED_FLAG} AS raw_flag FROM orders) x GROUP BY 1, 2""")
def h11_trimmed_flag(spark, base):
    o = _with(_t(spark, base, "orders"), raw_flag=_PADDED_FLAG)
    return (o.withColumn("flag", clean.trimmed_text_flag("raw_flag"))
            .groupBy("raw_flag", "flag").agg(F.count("o_orderkey").alias("order_count")))


_PCT_TEXT = """CASE o_orderkey % 8 WHEN 0 THEN 'FALSE' WHEN 1 THEN 'true' WHEN 2 THEN ''
    WHEN 3 THEN NULL WHEN 4 THEN '0' WHEN 5 THEN '0.00001' ELSE
    CASE o_orderkey % 29 WHEN 1 THEN '1e-20' WHEN 2 THEN '-123456789012345678901234567890'
    ELSE CAST(o_orderkey % 50 AS STRING) END END"""


@register("h12_guarded_cast", f"""SELECT o_orderkey, {sql_rules.stored('n')} AS discount_pct, {sql_rules.exact_digits('n')} AS discount_pct_exact
FROM (SELECT o_orderkey, {sql_rules.unworded('t')} AS n FROM (SELECT o_orderkey, {_PCT_TEXT} AS t FROM orders) x) y""")
def h12_guarded_cast(spark, base):
    o = _with(_t(spark, base, "orders"), t=_PCT_TEXT)
    return o.select("o_orderkey", clean.guarded_decimal("t").alias("discount_pct"),
                    clean.exact_digits(clean.guarded_text("t")).alias("discount_pct_exact"))


_AMOUNTS = {
    "base_t": "CASE p_partkey % 6 WHEN 0 THEN '0' WHEN 1 THEN '0' WHEN 2 THEN '' WHEN 3 THEN '0.00004' "
              "ELSE CAST(p_size AS STRING) || '.99' END",
    "final_t": "CASE p_partkey % 6 WHEN 0 THEN '0' WHEN 1 THEN '0' WHEN 2 THEN '0' WHEN 3 THEN '0' "
               "ELSE CAST(p_size AS STRING) || '.49' END",
    "amount_t": "CASE p_partkey % 6 WHEN 0 THEN CASE WHEN p_partkey % 5 = 0 THEN '1e-20' ELSE '0' END WHEN 1 THEN '' WHEN 3 THEN '0' "
                "ELSE '1.00' END",
    "free_t": "CASE WHEN p_partkey % 4 = 1 THEN 't' ELSE 'f' END",
}


# None of the amounts is negative: they are all zero where the three that there are sum to it.
@register("h13_rules", f"""SELECT p_partkey, free_t = 't' OR (count(n) = 3 AND sum(n) = 0) AS is_free
FROM (SELECT p_partkey, free_t, {sql_rules.stored('t')} AS n
      FROM (SELECT p_partkey, free_t, unnest([base_t, final_t, amount_t]) AS t
            FROM (SELECT p_partkey, {', '.join(f'{e} AS {n}' for n, e in _AMOUNTS.items())} FROM part) x) y) z
GROUP BY p_partkey, free_t""")
def h13_rules(spark, base):
    p = _with(_t(spark, base, "part"), **_AMOUNTS)
    b, f, a = (clean.blank_decimal(c) for c in ("base_t", "final_t", "amount_t"))
    return p.select("p_partkey", clean.free_title(b, f, a, "free_t").alias("is_free"))


_DISC = {
    "pct_t": "CASE p_partkey % 6 WHEN 0 THEN 'FALSE' WHEN 1 THEN '0' WHEN 2 THEN '' "
             "WHEN 3 THEN NULL WHEN 4 THEN '0.00001' ELSE CASE p_size % 20 WHEN 0 THEN '1e-20' WHEN 1 THEN '-1e-20' "
             "ELSE CAST(p_size % 20 - 2 AS STRING) END END",
    "flag_t": "CASE p_partkey % 4 WHEN 0 THEN ' t ' WHEN 1 THEN 't' WHEN 2 THEN NULL ELSE 'f' END",
}


# A text names a positive number if it has a digit other than 0 and no minus sign in front.
@register("h14_rules", f"""SELECT p_partkey, regexp_full_match(coalesce(flag_t, ''), ' *t *')
  OR regexp_matches(split_part(coalesce(pct_t, ''), 'e', 1), '^[0-9.]*[1-9]') AS is_discounted
FROM (SELECT p_partkey, {', '.join(f'{e} AS {n}' for n, e in _DISC.items())} FROM part) x""")
def h14_rules(spark, base):
    p = _with(_t(spark, base, "part"), **_DISC)
    return p.select("p_partkey", clean.discounted(clean.guarded_decimal("pct_t"), "flag_t").alias("is_discounted"))


_URL_TEXT = """CASE page_id % 9 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  '
    WHEN 3 THEN 'N/A' WHEN 4 THEN ' none ' WHEN 5 THEN 'TBD' ELSE url END"""


@register("h15_missing_text", f"""SELECT page_id, {sql_rules.missing('u')} AS url_missing
FROM (SELECT page_id, {_URL_TEXT} AS u FROM pages) x""")
def h15_missing_text(spark, base):
    p = _with(_t(spark, base, "pages"), u=_URL_TEXT)
    return p.select("page_id", clean.is_missing_text("u").alias("url_missing"))


# --- H16-H20: cut-offs, tiers, labels -------------------------------------------

_MAYBE_DATE = "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderdate END"


@register("h16_cutoff2", f"""SELECT CASE WHEN d < CAST(DATE '1998-01-01' AS TIMESTAMP) THEN 'before'
    ELSE 'after or unknown' END AS period, COUNT(o_orderkey) AS order_count
FROM (SELECT o_orderkey, {_MAYBE_DATE} AS d FROM orders) x GROUP BY 1""")
def h16_cutoff2(spark, base):
    o = _with(_t(spark, base, "orders"), d=_MAYBE_DATE)
    period = tiers.cutoff_two_way("d", dt.date(1998, 1, 1), "before", "after or unknown")
    return o.groupBy(period.alias("period")).agg(F.count("o_orderkey").alias("order_count"))


@register("h17_cutoff3", f"""SELECT CASE WHEN d >= CAST(DATE '2000-01-01' AS TIMESTAMP) THEN 'recent'
    WHEN d < CAST(DATE '2000-01-01' AS TIMESTAMP) THEN 'older' ELSE 'unknown' END AS period,
  COUNT(o_orderkey) AS order_count
FROM (SELECT o_orderkey, {_MAYBE_DATE} AS d FROM orders) x GROUP BY 1""")
def h17_cutoff3(spark, base):
    o = _with(_t(spark, base, "orders"), d=_MAYBE_DATE)
    period = tiers.cutoff_three_way("d", dt.date(2000, 1, 1), "recent", "older", "unknown")
    return o.groupBy(period.alias("period")).agg(F.count("o_orderkey").alias("order_count"))


_AGE = "CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE p_size - 5 END"


# Labels of their own that fit the driver tables: the helpers take them as parameters.
_SIZES = ("none", "small or odd", "middle", "large", "unknown")


@register("h18_tiers", f"""SELECT label AS size_tier, count(p_partkey) AS part_count, sum(age)::BIGINT AS size_sum
FROM (SELECT p_partkey, {_AGE} AS age FROM part) x
JOIN (VALUES (0, 0, 'none'), (-99, -1, 'small or odd'), (1, 12, 'small or odd'), (13, 16, 'middle'), (17, 99, 'large'),
      (NULL, NULL, 'unknown')) v(low, high, label)
  ON age BETWEEN low AND high OR (age IS NULL AND low IS NULL)
GROUP BY label""")
def h18_tiers(spark, base):
    p = _with(_t(spark, base, "part"), age=_AGE)
    return p.groupBy(tiers.age_tier("age", _SIZES).alias("size_tier")).agg(
        F.count("p_partkey").alias("part_count"), F.sum("age").cast("long").alias("size_sum"))


_URGENT = "o_orderkey % 10 = 7"
_PRIORITY_LABELS = {"1-URGENT": "today", "2-HIGH": "this week"}


@register("h19_priority_label", f"""SELECT if({_URGENT}, 'escalated',
    coalesce(MAP {{'1-URGENT': 'today', '2-HIGH': 'this week'}}[o_orderpriority], 'later')) AS handling,
  count(*) AS order_count FROM orders GROUP BY ALL""")
def h19_priority_label(spark, base):
    o = _with(_t(spark, base, "orders"), escalated=_URGENT)
    label = tiers.content_group("escalated", "o_orderpriority", "escalated", _PRIORITY_LABELS, "later")
    return o.groupBy(label.alias("handling")).agg(F.count(F.lit(1)).alias("order_count"))


_STATUS_BOOL = "CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE ELSE NULL END"


@register("h20_bool_label", """SELECT coalesce(MAP {'F': 'filled', 'O': 'open'}[o_orderstatus], 'in part') AS state,
  count(o_orderkey) AS order_count, sum(o_totalprice::DECIMAL(18,2))::DOUBLE / count(o_totalprice) AS avg_total
FROM orders GROUP BY ALL""")
def h20_bool_label(spark, base):
    o = _with(_t(spark, base, "orders"), b=_STATUS_BOOL)
    return o.groupBy(tiers.bool_label("b", "filled", "open", "in part").alias("state")).agg(
        F.count("o_orderkey").alias("order_count"),
        mean(F.col("o_totalprice").cast("decimal(18,2)")).alias("avg_total"))


# --- I: list-like text ----------------------------------------------------------

_BRAND_TYPE_LIST = "'[''' || p_brand || ''', ''' || p_type || ''']'"


@register("i2_json_list", f"""SELECT item, COUNT(*) AS part_count FROM (
  SELECT unnest({_JSON_ITEMS_SQL.format(c=_BRAND_TYPE_LIST)}) AS item FROM part) x
GROUP BY item""")
def i2_json_list(spark, base):
    p = _with(_t(spark, base, "part"), lst=_BRAND_TYPE_LIST)
    items = p.select(F.explode(clean.json_list_items("lst")).alias("item"))
    return items.groupBy("item").agg(F.count(F.lit(1)).alias("part_count"))


_WORDS_WITH_BLANK = """CASE WHEN p_partkey % 4 = 0
    THEN '[''' || split_part(p_name, ' ', 1) || ''', , ''' || split_part(p_name, ' ', 2) || ''']'
    ELSE '[''' || split_part(p_name, ' ', 1) || ''', ''' || split_part(p_name, ' ', 2) || ''']' END"""


@register("i3_text_list", f"""SELECT word, COUNT(*) AS part_count FROM (
  SELECT unnest({sql_rules.text_items(_WORDS_WITH_BLANK)}) AS word FROM part) x
WHERE word IS NOT NULL AND trim(word) <> ''
GROUP BY word""")
def i3_text_list(spark, base):
    p = _with(_t(spark, base, "part"), lst=_WORDS_WITH_BLANK)
    words = p.select(F.explode(clean.text_list_items("lst")).alias("word"))
    words = words.where(clean.non_blank("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("part_count"))
