"""Registered checks for scans, predicates, joins, de-duplication, aggregates and keys.

Each check runs one operator family over whole driver tables. Where the
tables hold no NULL / blank / orphan cases, a deterministic SQL expression
(shared verbatim with the DuckDB twin) injects them; the operator itself is
library code.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions import clean
from ..operators import aggregates as agg
from ..operators import profile, quality
from ..operators.dedupe import (distinct_items, distinct_pairs, distinct_values,
                                entity_from_columns, insert_if_absent)
from ..operators.joins import (lookup_key, restrict_to, spread_lookup, static_table,
                               with_required_categories)
from ..operators.keymap import KeyMap
from ..operators.keys import dense_keys
from ..session import scratch_path
from ..sources import csv_stage
from ..sources.tables import read_table, read_tables, write_tables
from . import sql_rules
from .catalog_queries import TABLE_CTES, catalog
from .listing import LISTING_COLUMNS, listing, listing_sql
from .normalize import rejected_values
from .registry import register


def _t(spark: SparkSession, base: str, name: str) -> DataFrame:
    return read_table(spark, base, name)


def _avg_sql(expr: str) -> str:
    return f"CAST(SUM({expr}) AS DOUBLE) / COUNT({expr})"


def _dec2(col: str):
    return F.col(col).cast("decimal(18,2)")


# --- A: sources ---------------------------------------------------------------

# Staged-only columns get awkward CSV text: embedded quotes, commas, newlines.
_STAGE_EXTRA = {
    "gallery": """CASE p_partkey % 5 WHEN 0 THEN 'shot "one", ' || p_name
        WHEN 1 THEN p_name || chr(10) || p_brand WHEN 2 THEN '' ELSE NULL END""",
    "video": "CASE WHEN p_partkey % 3 = 0 THEN ' padded ' ELSE NULL END",
}


def _a1_sql() -> str:
    cols = []
    for c in schemas.RAW_COLUMNS:
        typ = {"id": "BIGINT", "type": "INTEGER"}.get(c, "VARCHAR")
        expr = f"x.{c}" if c in LISTING_COLUMNS else _STAGE_EXTRA.get(c, "NULL")
        cols.append(f"CAST({expr} AS {typ}) AS {c}")
    inner = listing_sql().replace("SELECT\n", "SELECT p_partkey, p_name, p_brand,\n", 1)
    return "SELECT " + ",\n  ".join(cols) + f"\nFROM ({inner}) x"


@register("a1_csv_stage", _a1_sql())
def a1_csv_stage(spark: SparkSession, base: str) -> DataFrame:
    """Write the listing as CSV (all 51 positional columns) and read it back
    under the declared staging schema."""
    src = listing(spark, base)
    part = _t(spark, base, "part").select("p_partkey", "p_name", "p_brand")
    extra = part.select(F.col("p_partkey").alias("_id"),
                        *[F.expr(e).alias(n) for n, e in _STAGE_EXTRA.items()])
    wide = src.join(extra, src["id"] == extra["_id"], "left")
    cols = [(F.col(c) if c in wide.columns else F.lit(None)).cast(f.dataType).alias(c)
            for c, f in zip(schemas.RAW_COLUMNS, schemas.RAW_SCHEMA.fields)]
    path = scratch_path(spark, "csv-stage")
    csv_stage.write_csv(wide.select(*cols), path)
    return csv_stage.read_csv(spark, path, schemas.RAW_SCHEMA, multiline=True)


_TYPE_DIM = [(1, "ECONOMY"), (2, "LARGE"), (3, "MEDIUM"), (4, "PROMO"), (5, "SMALL")]


@register("a5_static_dim", """SELECT d.type_id, d.type_name, COUNT(p.p_partkey) AS part_count
FROM part p JOIN (VALUES (1, 'ECONOMY'), (2, 'LARGE'), (3, 'MEDIUM'), (4, 'PROMO'), (5, 'SMALL'))
  d(type_id, type_name) ON p.p_type = d.type_name
GROUP BY d.type_id, d.type_name""")
def a5_static_dim(spark, base):
    dim = static_table(spark, _TYPE_DIM, "type_id int, type_name string")
    rows = _t(spark, base, "part").join(dim, F.col("p_type") == F.col("type_name"))
    return rows.groupBy("type_id", "type_name").agg(F.count("p_partkey").alias("part_count"))


@register("a6_scan", "SELECT * FROM nation")
def a6_scan(spark, base):
    return _t(spark, base, "nation")


def _profile_sql() -> str:
    number = r"^[ ]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ ]*$"
    return f"WITH listing AS (\n{listing_sql()}\n)\n" + "\nUNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls,
  count(*) FILTER (WHERE trim({c}::VARCHAR) = '') AS blanks, min(length({c}::VARCHAR)) AS min_length,
  max(length({c}::VARCHAR)) AS max_length, min({c}::VARCHAR) AS smallest, max({c}::VARCHAR) AS largest,
  count(*) FILTER (WHERE regexp_matches({c}::VARCHAR, '{number}')) AS numbers FROM listing""" for c in LISTING_COLUMNS)


@register("a6_load_profile", _profile_sql())
def a6_load_profile(spark, base):
    return profile.column_profile(listing(spark, base)).select("column_name", *profile.EXACT)


# --- B: projections and predicates ------------------------------------------

_MAYBE_BRAND = "CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_brand END"
# Missing, blank and sentinel text, so that every arm of the predicate rejects rows.
_B_TEXT = {
    "name_t": "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_name END",
    "brand_t": "CASE WHEN p_partkey % 9 = 0 THEN '  ' ELSE p_brand END",
    "type_t": "CASE p_partkey % 11 WHEN 0 THEN '' WHEN 1 THEN '[]' ELSE p_type END",
}


@register("b_predicates", f"""SELECT p_partkey, p_name, p_size FROM part
WHERE ({_B_TEXT["name_t"]}) IS NOT NULL AND trim({_B_TEXT["brand_t"]}) <> '' AND ({_B_TEXT["type_t"]}) NOT IN ('', '[]')
  AND ((p_type IN ('SMALL', 'PROMO') AND p_size BETWEEN 13 AND 16)
       OR (p_retailprice >= 990 AND (p_size < 5) = TRUE)
       OR ({_MAYBE_BRAND}) IS NULL)""")
def b_predicates(spark, base):
    p = _t(spark, base, "part")
    name, brand, kind = (F.expr(e) for e in _B_TEXT.values())
    cond = (name.isNotNull() & clean.non_blank(brand) & ~kind.isin("", "[]")
            & ((F.col("p_type").isin("SMALL", "PROMO") & F.col("p_size").between(13, 16))
               | ((F.col("p_retailprice") >= 990) & ((F.col("p_size") < 5) == F.lit(True)))
               | F.expr(_MAYBE_BRAND).isNull()))
    return p.where(cond).select("p_partkey", "p_name", "p_size")


@register("b1_project_rename", """SELECT c_custkey AS customer_id, c_name AS customer_name,
  c_acctbal AS balance, c_mktsegment AS segment FROM customer""")
def b1_project_rename(spark, base):
    c = _t(spark, base, "customer")
    return c.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
                    F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))


@register("b10_having", """SELECT p.p_brand, COUNT(l.l_orderkey) AS line_count
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_brand HAVING COUNT(l.l_orderkey) >= 2450""")
def b10_having(spark, base):
    rows = _t(spark, base, "lineitem").join(_t(spark, base, "part"),
                                             F.col("l_partkey") == F.col("p_partkey"))
    out = rows.groupBy("p_brand").agg(F.count("l_orderkey").alias("line_count"))
    return agg.at_least(out, "line_count", 2450)


# --- C: joins -------------------------------------------------------------------

@register("c1_inner_star", """SELECT n.n_name, COUNT(*) AS line_count,
  CAST(SUM(CAST(l.l_quantity AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS quantity_sum
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name""")
def c1_inner_star(spark, base):
    li = _t(spark, base, "lineitem").select("l_orderkey", "l_quantity")
    o = _t(spark, base, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, base, "customer").select("c_custkey", "c_nationkey")
    n = _t(spark, base, "nation").select("n_nationkey", "n_name")
    rows = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(c, F.col("o_custkey") == F.col("c_custkey"))
            .join(n, F.col("c_nationkey") == F.col("n_nationkey")))
    return rows.groupBy("n_name").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum(_dec2("l_quantity")).cast("decimal(38,2)").alias("quantity_sum"))


_PADDED_PRIORITY = """CASE o_orderkey % 3 WHEN 0 THEN '  ' || o_orderpriority
    WHEN 1 THEN o_orderpriority || ' ' ELSE o_orderpriority END"""


@register("c2_computed_key_join", f"""WITH src AS (SELECT o_orderkey, {_PADDED_PRIORITY} AS prio
  FROM orders),
dim AS (SELECT CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS priority_id, name
  FROM (SELECT DISTINCT trim(prio) AS name FROM src) d)
SELECT dim.priority_id, dim.name AS priority_name, COUNT(src.o_orderkey) AS order_count
FROM src JOIN dim ON trim(src.prio) = dim.name
GROUP BY dim.priority_id, dim.name""")
def c2_computed_key_join(spark, base):
    src = _t(spark, base, "orders").select("o_orderkey", F.expr(_PADDED_PRIORITY).alias("prio"))
    dim = dense_keys(src.select(F.trim("prio").alias("name")), "name", "priority_id")
    # Inner join on a computed key: the trimmed text equals the dimension name.
    rows = src.join(dim, F.trim(F.col("prio")) == F.col("name"))
    return rows.groupBy("priority_id", F.col("name").alias("priority_name")).agg(
        F.count("o_orderkey").alias("order_count"))


_CUST_NATION_KEY = "CASE WHEN c_custkey % 10 = 0 THEN 99 ELSE c_nationkey END"


@register("c3_role_lookup", f"""SELECT cn.n_name AS customer_nation, sn.n_name AS supplier_nation,
  COUNT(*) AS line_count
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN (SELECT c_custkey, {_CUST_NATION_KEY} AS c_nationkey FROM customer) c
  ON o.o_custkey = c.c_custkey
LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
GROUP BY cn.n_name, sn.n_name""")
def c3_role_lookup(spark, base):
    nation = _t(spark, base, "nation")
    li = _t(spark, base, "lineitem").select("l_orderkey", "l_suppkey")
    o = _t(spark, base, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, base, "customer").select("c_custkey", F.expr(_CUST_NATION_KEY).alias("c_nk"))
    s = _t(spark, base, "supplier").select("s_suppkey", "s_nationkey")
    rows = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(c, F.col("o_custkey") == F.col("c_custkey"))
            .join(s, F.col("l_suppkey") == F.col("s_suppkey"), "left"))
    # The same dimension in two roles: the buyer's nation and the seller's nation.
    rows = spread_lookup(rows, nation, "c_nk", "n_nationkey", "n_name", "customer_nation", look_in=c)
    rows = spread_lookup(rows, nation, "s_nationkey", "n_nationkey", "n_name", "supplier_nation", look_in=s)
    return rows.groupBy("customer_nation", "supplier_nation").agg(
        F.count(F.lit(1)).alias("line_count"))


_RETURNED_SQL = """SELECT p.p_partkey, COALESCE(r.returned_lines, 0) AS returned_lines,
  r.returned_qty
FROM part p LEFT JOIN (
  SELECT l_partkey, COUNT(l_orderkey) AS returned_lines,
    CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS returned_qty
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey) r ON p.p_partkey = r.l_partkey"""


def _returned(spark, base) -> DataFrame:
    ret = (_t(spark, base, "lineitem").where(F.col("l_returnflag") == "R")
           .groupBy("l_partkey").agg(
               F.count("l_orderkey").alias("returned_lines"),
               F.sum(_dec2("l_quantity")).cast("decimal(38,2)").alias("returned_qty")))
    rows = _t(spark, base, "part").select("p_partkey").join(
        ret, F.col("p_partkey") == F.col("l_partkey"), "left")
    return rows.select("p_partkey",
                       F.coalesce("returned_lines", F.lit(0)).cast("long").alias("returned_lines"),
                       "returned_qty")


@register("c5_left_enrich", _RETURNED_SQL)
def c5_left_enrich(spark, base):
    return _returned(spark, base)


_PAGE_URL = ("CASE WHEN page_id % 13 = 0 THEN NULL WHEN page_id % 17 = 0 THEN '  ' "
             "WHEN page_id % 11 = 0 THEN 'gopher://old' ELSE url END")
_URL_CATEGORIES = ["Secure (https)", "Plain (http)", "FTP (ftp)", "Missing"]


@register("c6_skeleton", f"""WITH cats AS (
  SELECT * FROM (VALUES ('Secure (https)'), ('Plain (http)'), ('FTP (ftp)'), ('Missing')) v(category)
), pages_c AS (
  SELECT CASE WHEN {sql_rules.missing('u')} THEN 'Missing'
              WHEN u LIKE 'https://%' THEN 'Secure (https)'
              WHEN u LIKE 'http://%' THEN 'Plain (http)'
              WHEN u LIKE 'ftp://%' THEN 'FTP (ftp)' ELSE 'Other' END AS cat,
         page_id, length(html) AS html_len
  FROM (SELECT page_id, html, {_PAGE_URL} AS u FROM pages) s
), agg AS (
  SELECT cat, COUNT(page_id) AS page_count, {_avg_sql('html_len')} AS avg_html_length
  FROM pages_c GROUP BY cat
)
SELECT COALESCE(cats.category, agg.cat) AS category, COALESCE(agg.page_count, 0) AS page_count, agg.avg_html_length
FROM cats FULL JOIN agg ON cats.category = agg.cat""")
def c6_skeleton(spark, base):
    p = _t(spark, base, "pages").select("page_id", "html", F.expr(_PAGE_URL).alias("u"))
    u = F.col("u")
    cat = (F.when(clean.is_missing_text(u), "Missing")
           .when(u.startswith("https://"), "Secure (https)")
           .when(u.startswith("http://"), "Plain (http)")
           .when(u.startswith("ftp://"), "FTP (ftp)").otherwise("Other"))
    grouped = (p.withColumn("cat", cat).withColumn("html_len", F.length("html"))
               .groupBy("cat").agg(F.count("page_id").alias("page_count"),
                                   agg.mean("html_len").alias("avg_html_length")))
    return with_required_categories(spark, _URL_CATEGORIES, "category", grouped, "cat",
                                    zero_fill=["page_count"])


@register("c7_semi", """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def c7_semi(spark, base):
    good = _t(spark, base, "customer").where(F.col("c_acctbal") > 0)
    return restrict_to(_t(spark, base, "orders"), good, "o_custkey", "c_custkey") \
        .select("o_orderkey", "o_custkey", "o_orderstatus")


_WORD_LIST = ("'[''' || split_part(p_name, ' ', 1) || ''', ''' || split_part(p_name, ' ', 2) "
              "|| ''']'")
@register("c8_lateral_unnest", f"""SELECT DISTINCT p.p_partkey, w.word
FROM (SELECT p_partkey, {_WORD_LIST} AS words FROM part) p
CROSS JOIN LATERAL (SELECT unnest({sql_rules.text_items('p.words')}) AS word) w""")
def c8_lateral_unnest(spark, base):
    p = _t(spark, base, "part").select("p_partkey", F.expr(_WORD_LIST).alias("words"))
    rows = p.select("p_partkey", F.explode(clean.text_list_items("words")).alias("word"))
    return distinct_pairs(rows, ["p_partkey", "word"])


@register("c9_outer_to_inner", """SELECT c.c_mktsegment, COUNT(o.o_orderkey) AS big_orders,
  CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS big_order_value
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
WHERE o.o_totalprice > 100000
GROUP BY c.c_mktsegment""")
def c9_outer_to_inner(spark, base):
    c = _t(spark, base, "customer").select("c_custkey", "c_mktsegment")
    o = _t(spark, base, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    rows = c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left") \
        .where(F.col("o_totalprice") > 100000)
    return rows.groupBy("c_mktsegment").agg(
        F.count("o_orderkey").alias("big_orders"),
        F.sum(_dec2("o_totalprice")).cast("decimal(38,2)").alias("big_order_value"))


# --- D: de-duplication ----------------------------------------------------------

@register("d1_distinct", "SELECT DISTINCT p_brand AS brand FROM part WHERE p_brand IS NOT NULL")
def d1_distinct(spark, base):
    return distinct_values(_t(spark, base, "part"), "p_brand", "brand")


_BRAND_VARIANT = """CASE p_partkey % 3 WHEN 0 THEN upper(p_brand)
    WHEN 1 THEN ' ' || p_brand || ' ' ELSE p_brand END"""


@register("d2_normalised_distinct", f"""SELECT DISTINCT trim(lower({_BRAND_VARIANT})) AS brand_norm
FROM part""")
def d2_normalised_distinct(spark, base):
    p = _t(spark, base, "part")
    return distinct_values(p, clean.fold_name(F.expr(_BRAND_VARIANT)), "brand_norm")


_FLAG_LIST = "'[' || l_returnflag || ', ' || l_linestatus || ']'"


@register("d3_unnested_distinct", f"""SELECT DISTINCT flag FROM (
  SELECT unnest({sql_rules.text_items(_FLAG_LIST)}) AS flag FROM lineitem) x""")
def d3_unnested_distinct(spark, base):
    li = _t(spark, base, "lineitem")
    return distinct_items(li, clean.text_list_items(F.expr(_FLAG_LIST)), "flag")


@register("d4_pair_distinct", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def d4_pair_distinct(spark, base):
    return distinct_pairs(_t(spark, base, "lineitem"), ["l_orderkey", "l_linenumber"])


_SUPP_NATION = "CASE WHEN s_suppkey % 4 = 0 THEN lower(n_name) ELSE n_name END"


@register("d5_insert_if_absent", f"""WITH existing AS (
  SELECT DISTINCT n.n_name AS name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE c.c_mktsegment = 'BUILDING'),
incoming AS (
  SELECT DISTINCT {_SUPP_NATION} AS name FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey)
SELECT name FROM existing
UNION ALL
SELECT name FROM incoming WHERE name NOT IN (SELECT name FROM existing)""")
def d5_insert_if_absent(spark, base):
    nation = _t(spark, base, "nation")
    existing = (_t(spark, base, "customer").where(F.col("c_mktsegment") == "BUILDING")
                .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
                .select(F.col("n_name").alias("name")).distinct())
    incoming = (_t(spark, base, "supplier")
                .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
                .select(F.expr(_SUPP_NATION).alias("name")))
    return insert_if_absent(existing, incoming, "name")


@register("d6_two_column_entity", f"""SELECT CAST(row_number() OVER (ORDER BY name) AS BIGINT) AS party_id,
  name FROM (
  SELECT cn.n_name AS name FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation cn ON c.c_nationkey = cn.n_nationkey
  UNION
  SELECT {_SUPP_NATION.replace('n_name', 'sn.n_name')} FROM lineitem l
    JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation sn ON s.s_nationkey = sn.n_nationkey
) u""")
def d6_two_column_entity(spark, base):
    nation = _t(spark, base, "nation")
    li = _t(spark, base, "lineitem").select("l_orderkey", "l_suppkey")
    o = _t(spark, base, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, base, "customer").select("c_custkey", "c_nationkey")
    s = _t(spark, base, "supplier").select("s_suppkey", "s_nationkey")
    rows = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(c, F.col("o_custkey") == F.col("c_custkey"))
            .join(s, F.col("l_suppkey") == F.col("s_suppkey")))
    rows = lookup_key(rows, nation, "c_nationkey", "n_nationkey", "n_name", "buyer_nation",
                      how="inner")
    rows = lookup_key(rows, nation, "s_nationkey", "n_nationkey", "n_name", "n_name", how="inner")
    rows = rows.withColumn("seller_nation", F.expr(_SUPP_NATION))
    names = entity_from_columns(rows, ["buyer_nation", "seller_nation"], "name")
    return dense_keys(names, "name", "party_id")


# --- E: aggregates --------------------------------------------------------------

@register("e1_count", """SELECT l_returnflag, COUNT(l_orderkey) AS line_count
FROM lineitem GROUP BY l_returnflag""")
def e1_count(spark, base):
    return _t(spark, base, "lineitem").groupBy("l_returnflag").agg(
        F.count("l_orderkey").alias("line_count"))


@register("e2_sum_int", """SELECT l_linestatus, CAST(SUM(l_linenumber) AS BIGINT) AS linenumber_sum
FROM lineitem GROUP BY l_linestatus""")
def e2_sum_int(spark, base):
    return _t(spark, base, "lineitem").groupBy("l_linestatus").agg(
        F.sum("l_linenumber").cast("long").alias("linenumber_sum"))


@register("e3_sum_decimal", """SELECT l_returnflag,
  CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS price_sum
FROM lineitem GROUP BY l_returnflag""")
def e3_sum_decimal(spark, base):
    return _t(spark, base, "lineitem").groupBy("l_returnflag").agg(
        F.sum(_dec2("l_extendedprice")).cast("decimal(38,2)").alias("price_sum"))


@register("e4_avg_decimal", f"""SELECT c_mktsegment,
  {_avg_sql('CAST(c_acctbal AS DECIMAL(18,2))')} AS avg_balance
FROM customer GROUP BY c_mktsegment""")
def e4_avg_decimal(spark, base):
    return _t(spark, base, "customer").groupBy("c_mktsegment").agg(
        agg.mean(_dec2("c_acctbal")).alias("avg_balance"))


@register("e5_avg_int", "SELECT p_type, AVG(p_size) AS avg_size FROM part GROUP BY p_type")
def e5_avg_int(spark, base):
    return _t(spark, base, "part").groupBy("p_type").agg(F.avg("p_size").alias("avg_size"))


@register("e6_median", """SELECT l_returnflag, COUNT(l_quantity) AS line_count,
  quantile_cont(l_quantity, 0.5) AS median_quantity
FROM lineitem GROUP BY l_returnflag""")
def e6_median(spark, base):
    return agg.grouped_percentile(_t(spark, base, "lineitem"), ["l_returnflag"], "l_quantity",
                                  0.5, alias="median_quantity", count_alias="line_count")


_MAYBE_SEGMENT = "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END"


@register("e7_null_group", f"""SELECT {_MAYBE_SEGMENT} AS segment, COUNT(c_custkey) AS customer_count
FROM customer GROUP BY 1""")
def e7_null_group(spark, base):
    c = _t(spark, base, "customer").withColumn("segment", F.expr(_MAYBE_SEGMENT))
    return c.groupBy("segment").agg(F.count("c_custkey").alias("customer_count"))


@register("e8_tier_group", f"""SELECT CASE WHEN o_totalprice < 50000 THEN 'small'
    WHEN o_totalprice < 200000 THEN 'medium' ELSE 'large' END AS order_size,
  COUNT(o_orderkey) AS order_count,
  {_avg_sql('CAST(o_totalprice AS DECIMAL(18,2))')} AS avg_total
FROM orders GROUP BY 1""")
def e8_tier_group(spark, base):
    size = (F.when(F.col("o_totalprice") < 50000, "small")
            .when(F.col("o_totalprice") < 200000, "medium").otherwise("large"))
    return (_t(spark, base, "orders").withColumn("order_size", size).groupBy("order_size")
            .agg(F.count("o_orderkey").alias("order_count"),
                 agg.mean(_dec2("o_totalprice")).alias("avg_total")))


@register("e9_count_histogram", """WITH per AS (
  SELECT o_custkey, COUNT(o_orderkey) AS num_orders FROM orders GROUP BY o_custkey)
SELECT num_orders, COUNT(o_custkey) AS customers FROM per GROUP BY num_orders""")
def e9_count_histogram(spark, base):
    per = agg.count_histogram(_t(spark, base, "orders"), "o_custkey", "o_orderkey", "num_orders")
    return per.groupBy("num_orders").agg(F.count("o_custkey").alias("customers"))


@register("e10_multi_agg", f"""SELECT o_orderpriority, COUNT(o_orderkey) AS order_count,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_sum,
  {_avg_sql('CAST(o_totalprice AS DECIMAL(18,2))')} AS total_avg,
  MIN(o_totalprice) AS total_min, MAX(o_totalprice) AS total_max,
  MIN(o_orderdate) AS first_order, MAX(o_orderdate) AS last_order
FROM orders GROUP BY o_orderpriority""")
def e10_multi_agg(spark, base):
    return _t(spark, base, "orders").groupBy("o_orderpriority").agg(
        F.count("o_orderkey").alias("order_count"),
        F.sum(_dec2("o_totalprice")).cast("decimal(38,2)").alias("total_sum"),
        agg.mean(_dec2("o_totalprice")).alias("total_avg"),
        F.min("o_totalprice").alias("total_min"), F.max("o_totalprice").alias("total_max"),
        F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"))


# --- F: ordering ----------------------------------------------------------------

@register("f_order_nulls_first", _RETURNED_SQL + "\nORDER BY returned_qty DESC NULLS FIRST, "
          "p_partkey DESC")
def f_order_nulls_first(spark, base):
    return _returned(spark, base).orderBy(F.col("returned_qty").desc_nulls_first(),
                                          F.col("p_partkey").desc_nulls_first())


# --- G: set operations and CTEs -------------------------------------------------

@register("g1_union_all", """SELECT 'https' AS scheme, COUNT(*) AS page_count FROM pages
WHERE url LIKE 'https://%'
UNION ALL SELECT 'http', COUNT(*) FROM pages WHERE url LIKE 'http://%'
UNION ALL SELECT 'other', COUNT(*) FROM pages WHERE url NOT LIKE 'http%'""")
def g1_union_all(spark, base):
    p = _t(spark, base, "pages")

    def part(label, cond):
        return p.where(cond).agg(F.count(F.lit(1)).alias("page_count")) \
            .select(F.lit(label).alias("scheme"), "page_count")
    return (part("https", F.col("url").startswith("https://"))
            .unionByName(part("http", F.col("url").startswith("http://")))
            .unionByName(part("other", ~F.col("url").startswith("http"))))


@register("g3_cte_chain", """WITH big AS (
  SELECT o_custkey, COUNT(*) AS n FROM orders WHERE o_totalprice > 200000 GROUP BY o_custkey
), seg AS (
  SELECT c_custkey, c_mktsegment FROM customer
)
SELECT seg.c_mktsegment, COUNT(big.o_custkey) AS customers_with_big_orders,
  CAST(SUM(big.n) AS BIGINT) AS big_orders
FROM seg JOIN big ON seg.c_custkey = big.o_custkey
GROUP BY seg.c_mktsegment""")
def g3_cte_chain(spark, base):
    big = (_t(spark, base, "orders").where(F.col("o_totalprice") > 200000)
           .groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")))
    seg = _t(spark, base, "customer").select("c_custkey", "c_mktsegment")
    rows = seg.join(big, F.col("c_custkey") == F.col("o_custkey"))
    return rows.groupBy("c_mktsegment").agg(
        F.count("o_custkey").alias("customers_with_big_orders"),
        F.sum("n").cast("long").alias("big_orders"))


# --- K: keys and integrity ------------------------------------------------------

@register("k1_surrogate_key", """SELECT CAST(row_number() OVER (ORDER BY c_name) AS BIGINT) AS customer_key,
  c_name FROM (SELECT DISTINCT c_name FROM customer WHERE c_name IS NOT NULL) d""")
def k1_surrogate_key(spark, base):
    return dense_keys(_t(spark, base, "customer"), "c_name", "customer_key")


@register("k1_key_map", """WITH early AS (
  SELECT c_name, row_number() OVER (ORDER BY c_name) AS k FROM (SELECT DISTINCT c_name FROM customer WHERE c_custkey % 3 = 0))
SELECT c_name, k AS customer_key FROM early
UNION ALL SELECT c_name, (SELECT count(*) FROM early) + row_number() OVER (ORDER BY c_name)
FROM (SELECT DISTINCT c_name FROM customer WHERE c_name IS NOT NULL AND c_name NOT IN (SELECT c_name FROM early))""")
def k1_key_map(spark, base):
    # A third of the names come first; the later load, of all, leaves them their keys.
    customers = _t(spark, base, "customer").select("c_custkey", "c_name")
    keys = KeyMap(spark, scratch_path(spark, "key-map"), "c_name", "customer_key")
    keys.extend(customers.where("c_custkey % 3 = 0"))
    return keys.keyed(customers).select("c_name", "customer_key")


@register("k2_duplicates", """SELECT l_orderkey, l_linenumber, COUNT(*) AS occurrences
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""")
def k2_duplicates(spark, base):
    return quality.duplicate_keys(_t(spark, base, "lineitem"), ["l_orderkey", "l_linenumber"])


_NULLY_CUSTOMER = {
    "c_name": "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_name END",
    "c_acctbal": "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal END",
    "c_mktsegment": "CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_mktsegment END",
    "c_nationkey": "c_nationkey",
}


@register("k3_nulls", "SELECT " + ", ".join(
    f"COUNT(*) - COUNT({e}) AS {c}" for c, e in _NULLY_CUSTOMER.items()) + " FROM customer")
def k3_nulls(spark, base):
    c = _t(spark, base, "customer").select(*[F.expr(e).alias(n) for n, e in _NULLY_CUSTOMER.items()])
    return quality.null_counts(c, list(_NULLY_CUSTOMER))


_ORPHAN_CUST = "o_custkey + CASE WHEN o_orderkey % 50 = 0 THEN 1000000000 ELSE 0 END"


@register("k4_orphans", f"""SELECT o_orderkey, {_ORPHAN_CUST} AS o_custkey FROM orders
WHERE {_ORPHAN_CUST} NOT IN (SELECT c_custkey FROM customer)""")
def k4_orphans(spark, base):
    o = _t(spark, base, "orders").select("o_orderkey", F.expr(_ORPHAN_CUST).alias("o_custkey"))
    return quality.orphans(o, "o_custkey", _t(spark, base, "customer"), "c_custkey")


def _report_sql() -> str:
    parts = []
    tables = [n for n in schemas.PRIMARY_KEYS if n != "raw"]
    for name in tables:
        metrics = [f"SELECT '{name}' AS table_name, 'row_count' AS metric, COUNT(*) AS value "
                   f"FROM {name}"]
        for keys in [schemas.PRIMARY_KEYS[name]] + (
                [schemas.UNIQUE_KEYS[name]] if name in schemas.UNIQUE_KEYS else []):
            k = ", ".join(keys)
            metrics.append(f"SELECT '{name}', 'duplicate_key_rows', COALESCE(SUM(c), 0) FROM "
                           f"(SELECT COUNT(*) AS c FROM {name} GROUP BY {k} HAVING COUNT(*) > 1) d")
        nn = list(dict.fromkeys(schemas.NOT_NULL.get(name, []) + schemas.PRIMARY_KEYS[name]))
        metrics.append(f"SELECT '{name}', 'null_violations', "
                       + " + ".join(f"(COUNT(*) - COUNT({c}))" for c in nn) + f" FROM {name}")
        for child, fk, parent, pk in schemas.FOREIGN_KEYS:
            if child == name:
                metrics.append(f"SELECT '{name}', 'orphan_rows', COUNT(*) FROM {name} "
                               f"WHERE {fk} IS NOT NULL AND {fk} NOT IN (SELECT {pk} FROM {parent})")
        parts.extend(metrics)
    union = "\nUNION ALL ".join(parts)
    pick = ", ".join(
        f"CAST(COALESCE(SUM(CASE WHEN metric = '{m}' THEN value END), 0) AS BIGINT) AS {m}"
        for m in ("row_count", "duplicate_key_rows", "null_violations", "orphan_rows"))
    return TABLE_CTES + f", metrics AS (\n{union}\n)\nSELECT table_name, {pick}\n" \
        "FROM metrics GROUP BY table_name"


@register("k5_report", _report_sql())
def k5_report(spark, base):
    # The report reads each table several times, so the tables are stored first.
    built = catalog(spark, base)
    path = scratch_path(spark, "report-tables")
    write_tables(dict(built.items()), path)
    return quality.load_report(read_tables(spark, path, built.names))


_FAULTY = """CASE WHEN p_partkey % 10 = 3 THEN p_partkey - 1 ELSE p_partkey END AS id,
  CASE WHEN p_partkey % 8 = 5 THEN NULL ELSE p_name END AS title,
  CASE WHEN p_partkey % 6 = 0 THEN 9 WHEN p_partkey % 6 = 1 THEN NULL ELSE 1 + p_partkey % 3 END AS kind"""


@register("k5_faulty_report", f"""WITH child AS (SELECT {_FAULTY} FROM part),
twice AS (SELECT id FROM child GROUP BY id HAVING count(*) > 1)
SELECT 'titles' AS table_name, count(*) AS row_count, count(*) FILTER (WHERE id IN (FROM twice)) AS duplicate_key_rows,
  count(*) FILTER (WHERE title IS NULL) AS null_violations, count(*) FILTER (WHERE kind > 3) AS orphan_rows FROM child
UNION ALL SELECT 'kinds', 3, 0, 0, 0""")
def k5_faulty_report(spark, base):
    titles = _t(spark, base, "part").selectExpr(*[x.strip() for x in re.split(r",\n", _FAULTY)])
    kinds = static_table(spark, [(1,), (2,), (3,)], "kind_id int")
    return quality.load_report({"titles": titles, "kinds": kinds}, primary={"titles": ["id"], "kinds": ["kind_id"]}, unique={},
                               not_null={"titles": ["title"]}, refs=[("titles", "kind", "kinds", "kind_id")])


# Staging columns with text that no conversion takes, for the quarantine.
_BAD_TEXT = {
    "agelimit": "CASE WHEN id % 7 = 1 THEN 'twelve' WHEN id % 7 = 2 THEN ' 12 ' WHEN id % 7 = 3 THEN '' END",
    "baseamount": "CASE WHEN id % 11 = 3 THEN 'free' WHEN id % 11 = 4 THEN '1e-20' ELSE '1' END",
    "globalreleasedate": "CASE WHEN id % 13 = 5 THEN '2020-01-01' ELSE '0' END",
    "discountpercentage": "CASE WHEN id % 5 = 2 THEN 'much' WHEN id % 5 = 3 THEN 'False' ELSE '5' END",
    "supportedoperatingsystems": "CASE WHEN id % 17 = 6 THEN '[''a''] and more' ELSE '[''a'']' END",
}


@register("k5_quarantine", f"""WITH listing AS (
{listing_sql()}
), bad AS (SELECT id, promoid, {', '.join(f'{e} AS {c}' for c, e in _BAD_TEXT.items())} FROM listing)
SELECT id, 'agelimit' AS column_name, agelimit AS text, 'not an integer' AS reason FROM bad WHERE agelimit IN ('twelve', '')
UNION ALL SELECT id, 'baseamount', baseamount, 'not a number' FROM bad WHERE baseamount = 'free'
UNION ALL SELECT id, 'globalreleasedate', globalreleasedate, 'not an epoch in seconds' FROM bad WHERE globalreleasedate LIKE '%-%'
UNION ALL SELECT id, 'discountpercentage', discountpercentage, 'not a number' FROM bad WHERE discountpercentage = 'much' AND trim(promoid) <> ''
UNION ALL SELECT id, 'supportedoperatingsystems', supportedoperatingsystems, 'not one list' FROM bad WHERE supportedoperatingsystems LIKE '%more'
""")
def k5_quarantine(spark, base):
    rows = listing(spark, base).withColumns({c: F.expr(e) for c, e in _BAD_TEXT.items()})
    return rejected_values(rows)


_AMOUNT_TEXT = """CASE p_partkey % 9 WHEN 0 THEN '0.1234567890123456789' WHEN 1 THEN 'free' WHEN 2 THEN '' WHEN 3 THEN NULL
  ELSE p_size || '.5' END"""
_LIST_TEXT = "CASE p_partkey % 5 WHEN 0 THEN '[''a'', null]' WHEN 1 THEN '[''a''] tail' ELSE '[''a'', ''b'']' END"


@register("k5_conversions", f"""SELECT 'price' AS column_name, count(*) FILTER (WHERE t LIKE '0.1234%') AS lost_digits,
  count(*) FILTER (WHERE t = 'free') AS rejected, 0 AS null_items FROM (SELECT {_AMOUNT_TEXT} AS t FROM part)
UNION ALL SELECT 'labels', 0, count(*) FILTER (WHERE t LIKE '% tail'), count(*) FILTER (WHERE t LIKE '%null%')
FROM (SELECT {_LIST_TEXT} AS t FROM part)""")
def k5_conversions(spark, base):
    df = _t(spark, base, "part").select(F.expr(_AMOUNT_TEXT).alias("price"), F.expr(_LIST_TEXT).alias("labels"))
    return quality.conversion_report(df, amounts=["price"], lists=["labels"])

