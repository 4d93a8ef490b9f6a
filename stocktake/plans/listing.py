"""A staging listing derived from the driver tables (for checks and benchmarks).

One listing row per ``part`` row, every field as text like the real source,
with deterministic injections of the awkward cases the normaliser must handle
(NULL vs blank, padded names, mixed-case list items, boolean words in numeric
fields, placeholder URLs, epoch seconds on the cut-off). Parties come from
``nation`` names and review counts from an aggregate of ``lineitem``, so the
work grows with the tables.

The per-column expressions are plain SQL understood by both Spark SQL and
DuckDB, so the Spark frame and the oracle's CTE describe the same input; the
operators under test are then the normalisation and report code, not this.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import read_table

_DEV = "dev_nation || ' ' || CAST(p_size % 16 AS STRING)"
_W1 = "split_part(p_name, ' ', 1)"
_W2 = "split_part(p_name, ' ', 2)"

LISTING_COLUMNS: dict[str, str] = {
    "id": "CAST(p_partkey AS BIGINT)",
    "developer": f"""CASE WHEN p_partkey % 11 = 0 THEN NULL
        WHEN p_partkey % 13 = 0 THEN ' ' || {_DEV} ELSE {_DEV} END""",
    "publisher": f"""CASE WHEN p_partkey % 17 = 0 THEN NULL
        WHEN p_partkey % 5 = 0 THEN {_DEV} ELSE pub_nation || ' Publishing' END""",
    "supportedoperatingsystems": """CASE p_partkey % 7
        WHEN 0 THEN '[''windows'', ''osx'', ''linux'']'
        WHEN 1 THEN '[''windows'']'
        WHEN 2 THEN '[""osx"", "linux"]'
        WHEN 3 THEN '[]'
        WHEN 4 THEN NULL
        WHEN 5 THEN ' [''Windows'', ''linux''] '
        ELSE '' END""",
    "genres": f"""CASE p_partkey % 9
        WHEN 0 THEN NULL
        WHEN 1 THEN '[]'
        WHEN 2 THEN ''
        WHEN 3 THEN '[' || upper({_W1}) || ',' || {_W2} || ']'
        WHEN 4 THEN '[''' || {_W1} || ''', ''' || upper({_W1}) || ''', ''' || {_W2} || ''']'
        WHEN 5 THEN '[''' || {_W1} || ''', , ''' || {_W2} || ''']'
        WHEN 6 THEN '["' || {_W2} || '"]'
        ELSE '[''' || {_W1} || ''', ''' || {_W2} || ''']' END""",
    "globalreleasedate": """CASE p_partkey % 19
        WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '1262304000' WHEN 3 THEN '1262303999'
        ELSE CAST(1104537600 + ((p_partkey * 7919) % 7000) * 86400 + p_size AS STRING) END""",
    "buyable": "CASE p_partkey % 4 WHEN 0 THEN 't' WHEN 1 THEN 'f' WHEN 2 THEN 'T' ELSE NULL END",
    "title": "p_name",
    "supporturl": """CASE p_partkey % 10
        WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' WHEN 3 THEN 'N/A'
        WHEN 4 THEN ' none ' WHEN 5 THEN 'TBD'
        ELSE 'https://support.example/' || CAST(p_partkey AS STRING) END""",
    "type": "CAST(CASE p_size % 5 WHEN 0 THEN NULL WHEN 4 THEN 1 ELSE p_size % 5 END AS INT)",
    "ismovie": "CASE WHEN p_partkey % 10 = 7 THEN 't' ELSE 'f' END",
    "isgame": "CASE WHEN p_size % 5 = 3 THEN 'f' ELSE 't' END",
    "slug": "replace(p_name, ' ', '-')",
    "agelimit": "CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE CAST(p_size % 20 - 1 AS STRING) END",
    "currency": """CASE p_partkey % 6 WHEN 0 THEN 'EUR' WHEN 1 THEN 'GBP'
        WHEN 2 THEN NULL ELSE 'USD' END""",
    "amount": """CASE WHEN p_partkey % 41 = 7 THEN '1e-20' WHEN p_partkey % 43 = 5 THEN '123456789012345678901234567890'
        ELSE CASE p_partkey % 8 WHEN 0 THEN '0' WHEN 1 THEN '' WHEN 3 THEN '0.00002'
        ELSE CAST(p_size AS STRING) || '.' || lpad(CAST(p_partkey % 37 AS STRING), 2, '0') END END""",
    "baseamount": """CASE p_partkey % 8 WHEN 0 THEN '0' WHEN 1 THEN '0' WHEN 2 THEN '' WHEN 3 THEN '0.00004'
        ELSE CAST(p_size AS STRING) || '.' || lpad(CAST(p_partkey % 100 AS STRING), 2, '0') END""",
    "finalamount": """CASE WHEN p_partkey % 47 = 11 THEN '1e-20' ELSE CASE p_partkey % 8 WHEN 0 THEN '0' WHEN 1 THEN '0' WHEN 2 THEN '' WHEN 3 THEN '0.00001'
        ELSE CAST(p_size AS STRING) || '.' || lpad(CAST(p_partkey % 37 AS STRING), 2, '0') END END""",
    "isdiscounted": "CASE p_partkey % 5 WHEN 0 THEN ' t ' WHEN 1 THEN 't' ELSE 'f' END",
    "discountpercentage": """CASE p_partkey % 12 WHEN 0 THEN 'FALSE' WHEN 1 THEN 'true'
        WHEN 2 THEN '' WHEN 3 THEN NULL WHEN 4 THEN '0' WHEN 5 THEN '0.00001'
        WHEN 7 THEN '1e-20' ELSE CAST(p_size % 30 AS STRING) END""",
    "discountdifference": """CASE p_partkey % 12 WHEN 0 THEN 'TRUE' WHEN 2 THEN ''
        WHEN 5 THEN '-123456789012345678901234567890' ELSE CAST(p_size AS STRING) || '.5' END""",
    "isfree": "CASE WHEN p_partkey % 16 IN (1, 5) THEN 't' ELSE 'f' END",
    "promoid": """CASE p_partkey % 6
        WHEN 0 THEN ' ' || p_brand || '-' || CAST(p_size % 4 AS STRING) || ' '
        WHEN 1 THEN '' WHEN 2 THEN '   ' WHEN 3 THEN NULL
        ELSE p_brand || '-' || CAST(p_size % 4 AS STRING) END""",
    "filteredavgrating": """CASE WHEN p_partkey % 9 = 4 THEN ''
        ELSE CAST(p_size % 5 AS STRING) || '.5' END""",
    "overallavgrating": """CASE p_partkey % 10 WHEN 3 THEN NULL WHEN 7 THEN '' WHEN 5 THEN '4.333333333333333'
        ELSE CAST(p_size % 5 AS STRING) || CASE p_partkey % 4 WHEN 0 THEN '.00'
            WHEN 1 THEN '.25' WHEN 2 THEN '.50' ELSE '.75' END END""",
    "reviewscount": "CASE WHEN p_partkey % 14 = 0 THEN '' ELSE CAST(n_lines AS STRING) END",
    "isreviewable": "CASE WHEN p_partkey % 3 = 0 THEN 'f' ELSE 't' END",
    "reviewpages": "CASE WHEN n_lines IS NULL THEN '' ELSE CAST(n_lines % 7 AS STRING) END",
}


def listing(spark: SparkSession, base_dir: str) -> DataFrame:
    """The staging listing as a Spark frame (28 used columns, all text but id/type)."""
    part = read_table(spark, base_dir, "part")
    nation = read_table(spark, base_dir, "nation")
    lines = (read_table(spark, base_dir, "lineitem")
             .groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n_lines")))
    dev = nation.select(F.col("n_nationkey").alias("_dk"), F.col("n_name").alias("dev_nation"))
    pub = nation.select(F.col("n_nationkey").alias("_pk"), F.col("n_name").alias("pub_nation"))
    src = (part.join(dev, F.col("_dk") == F.col("p_partkey") % 25, "left")
           .join(pub, F.col("_pk") == (F.col("p_partkey") * 7) % 25, "left")
           .join(lines, F.col("l_partkey") == F.col("p_partkey"), "left"))
    return src.select(*[F.expr(e).alias(name) for name, e in LISTING_COLUMNS.items()])


def listing_sql() -> str:
    """The same listing as DuckDB SQL (tables ``part``, ``nation``, ``lineitem``)."""
    cols = ",\n  ".join(f"{e} AS {name}" for name, e in LISTING_COLUMNS.items())
    return f"""SELECT
  {cols}
FROM (
  SELECT p.*, n1.n_name AS dev_nation, n2.n_name AS pub_nation, li.n_lines
  FROM part p
  LEFT JOIN nation n1 ON n1.n_nationkey = p.p_partkey % 25
  LEFT JOIN nation n2 ON n2.n_nationkey = (p.p_partkey * 7) % 25
  LEFT JOIN (SELECT l_partkey, COUNT(*) AS n_lines FROM lineitem GROUP BY l_partkey) li
    ON li.l_partkey = p.p_partkey
) src"""
