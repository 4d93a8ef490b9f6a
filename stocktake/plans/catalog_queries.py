"""Registered checks for the normalised tables (L*) and the reports (M*).

Input: the staging listing derived from ``part``/``nation``/``lineitem``
(:mod:`stocktake.plans.listing`). The DuckDB twin answers each of them directly
from the listing, without the tables and joins in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import analytics, sql_rules
from .listing import listing, listing_sql
from .normalize import Catalog
from .registry import register

def _numbers(text: str, name: str) -> str:
    return f"{sql_rules.stored(text)} AS {name}, {sql_rules.exact_digits(text)} AS {name}_exact"


# The twin needs none of the tables: a title is one listing row, so every table
# and report follows from one typed view of the listing.
CATALOG_CTES = rf"""WITH listing AS (
{listing_sql()}
),
typed AS (
  SELECT id AS title_id, * EXCLUDE (id),
    epoch_ms(1000 * TRY_CAST(globalreleasedate AS BIGINT)) AS released,
    agelimit::INTEGER AS age, coalesce(ismovie, '') = 't' AS movie,
    {_numbers("baseamount", "base")},
    {_numbers("finalamount", "final")},
    {_numbers("amount", "paid")},
    {_numbers("overallavgrating", "stars")},
    {_numbers("filteredavgrating", "filtered_stars")},
    nullif(reviewscount, '')::INTEGER AS reviews,
    {_numbers(sql_rules.unworded("discountpercentage"), "off")},
    {_numbers(sql_rules.unworded("discountdifference"), "off_by")},
    nullif(trim(promoid), '') AS promo,
    {sql_rules.missing("supporturl")} AS unsupported,
    [x FOR x IN list_distinct([trim(lower(y)) FOR y IN regexp_split_to_array(
       translate(trim(genres), '[]''', ''), ',\s*')]) IF x <> ''] AS tags,
    [x FOR x IN list_distinct([trim(y, ' "''') FOR y IN string_split(
       regexp_extract(trim(supportedoperatingsystems), '^\[(.*)\]$', 1), ',')]) IF x <> ''] AS systems
  FROM listing
)
"""


def catalog(spark: SparkSession, base_dir: str) -> Catalog:
    return Catalog(listing(spark, base_dir))


def _table_query(name: str):
    def run(spark: SparkSession, base_dir: str) -> DataFrame:
        return catalog(spark, base_dir)[name]
    return run


#: Keys are ranks in name order, so a fact's key is the rank of its own name.
L_SQL = {
    "l1_party": """SELECT DISTINCT dense_rank() OVER (ORDER BY name) AS party_id, name
FROM (SELECT unnest([developer, publisher]) AS name FROM typed) WHERE name IS NOT NULL""",
    "l2_product_type": """SELECT k::INTEGER AS type_id, ['Game', 'Bundle', 'DLC'][k] AS type_name
FROM (SELECT unnest(range(1, 4)) AS k)""",
    "l3_inventory": """SELECT title_id, any_value(title) AS title, any_value(slug) AS slug,
  any_value(released) AS release_date, any_value(age) AS age_limit,
  bool_or(coalesce(isgame, '') = 't') AS is_game, bool_or(movie) AS is_movie,
  bool_or(coalesce(buyable, '') = 't') AS buyable, any_value(supporturl) AS support_url,
  max(k) FILTER (WHERE role = 'publisher') AS publisher_id,
  max(k) FILTER (WHERE role = 'developer') AS developer_id, any_value(type) AS type_id
FROM (SELECT *, CASE WHEN name IS NOT NULL THEN dense_rank() OVER (ORDER BY name NULLS LAST) END AS k
      FROM (SELECT *, unnest(['developer', 'publisher']) AS role, unnest([developer, publisher]) AS name FROM typed))
GROUP BY title_id""",
    "l4_os_platform": """SELECT DISTINCT dense_rank() OVER (ORDER BY os_name) AS os_id, os_name
FROM (SELECT unnest(systems) AS os_name FROM typed)""",
    "l5_genre": """SELECT DISTINCT dense_rank() OVER (ORDER BY genre_name) AS genre_id, genre_name
FROM (SELECT unnest(tags) AS genre_name FROM typed)""",
    "l6_promotion": """SELECT DISTINCT dense_rank() OVER (ORDER BY promo) AS promo_id, promo AS promo_name
FROM typed WHERE promo IS NOT NULL""",
    "l7_pricing": """SELECT title_id, base AS base_amount, final AS final_amount, paid AS amount, currency,
  base_exact AS base_amount_exact, final_exact AS final_amount_exact, paid_exact AS amount_exact,
  coalesce(base = 0 AND final = 0 AND paid = 0, false)
    OR coalesce(isfree, '') = 't' AS is_free
FROM typed""",
    "l8_rating": """SELECT title_id, stars AS overall_avg_rating, filtered_stars AS filtered_avg_rating,
  stars_exact AS overall_avg_rating_exact, filtered_stars_exact AS filtered_avg_rating_exact,
  reviews AS reviews_count, coalesce(isreviewable, '') = 't' AS is_reviewable,
  nullif(reviewpages, '')::INTEGER AS review_pages
FROM typed""",
    "l9_discount_status": """SELECT title_id, dense_rank() OVER (ORDER BY promo) AS promo_id,
  off AS discount_percentage, off_by AS discount_difference,
  off_exact AS discount_percentage_exact, off_by_exact AS discount_difference_exact,
  coalesce(off, 0) > 0 OR coalesce(trim(isdiscounted), '') = 't' AS is_discounted
FROM typed WHERE promo IS NOT NULL""",
    "l10_title_genre": """SELECT title_id, dense_rank() OVER (ORDER BY name) AS genre_id
FROM (SELECT title_id, unnest(tags) AS name FROM typed)""",
    "l11_title_os": """SELECT title_id, dense_rank() OVER (ORDER BY name) AS os_id
FROM (SELECT title_id, unnest(systems) AS name FROM typed)""",
}

#: The tables by name, for checks over the whole set.
TABLE_CTES = CATALOG_CTES + "".join(f", {q.partition('_')[2]} AS ({sql})\n" for q, sql in L_SQL.items())

# The product types are a fixed list, which reads no table: no query of their own.
for _qname, _sql in L_SQL.items():
    if _qname == "l2_product_type":
        continue
    register(_qname, CATALOG_CTES + _sql)(_table_query(_qname.partition("_")[2]))


def _report_query(report):
    def run(spark: SparkSession, base_dir: str) -> DataFrame:
        return report(catalog(spark, base_dir))
    return run


def _mean(expr: str) -> str:
    # Through text: a decimal of 38 digits is rounded once on its way to a double.
    return f"sum({expr})::VARCHAR::DOUBLE / nullif(count({expr}), 0)"


def _median_sql(role: str) -> str:
    return f"""SELECT {role} AS {role}_name, count(*) AS catalog_presence, median(stars::VARCHAR::DOUBLE) AS median_rating
FROM typed WHERE stars IS NOT NULL AND {role} IS NOT NULL GROUP BY ALL HAVING count(*) >= 5"""


M_SQL = {
    "m1_median_by_party": _median_sql("developer"),
    "m2_median_by_publisher": _median_sql("publisher"),
    "m3_era_quality": f"""SELECT if(coalesce(year(released), 9999) < 2010, 'Classic (Pre-2010)', 'Modern (2010+)') AS game_era,
  count(*) AS titles_in_group, {_mean('stars')} AS avg_quality_rating, {_mean('base')} AS avg_base_price
FROM typed WHERE stars IS NOT NULL GROUP BY ALL""",
    "m4_age_by_genre": f"""SELECT genre_name, count(*) AS title_count, {_mean('age')} AS avg_age_limit
FROM (SELECT age, unnest(tags) AS genre_name FROM typed WHERE age > 0) GROUP BY ALL HAVING count(*) >= 5""",
    "m5_reviews_by_age_tier": """SELECT label AS age_restriction_group, count(*) AS game_count,
  sum(reviews)::BIGINT AS total_reviews_sum
FROM typed JOIN (VALUES (-1000, -1, '1-12 (Child/Pre-Teen)'), (0, 0, '0 (No Restriction/Unknown)'),
  (1, 12, '1-12 (Child/Pre-Teen)'), (13, 16, '13-16 (Teen)'), (17, 1000, '17+ (Mature Audience)')) tier(low, high, label)
  ON age BETWEEN low AND high
WHERE reviews IS NOT NULL GROUP BY ALL""",
    "m6_type_contribution": """SELECT ['Game', 'Bundle', 'DLC'][type] AS product_category, count(*) AS catalog_count,
  sum(reviews)::BIGINT AS total_reviews_proxy, sum(base) AS total_base_amount_proxy
FROM typed WHERE type BETWEEN 1 AND 3 GROUP BY ALL""",
    "m7_content_groups": """SELECT ['Movie Content', 'Full Game Title', 'Bundle (Package)', 'DLC/Add-on Content'][if(movie, 1, type + 1)]
    AS content_type_group, count(*) AS titles_in_group, sum(base) AS total_base_amount_value
FROM typed WHERE type BETWEEN 1 AND 3 GROUP BY ALL""",
    "m8_free_vs_paid": f"""SELECT if(is_free, 'Free-to-Play (F2P)', 'Paid/Premium Title') AS revenue_model, count(*) AS title_count,
  {_mean('stars')} AS avg_user_rating, sum(reviews)::BIGINT AS total_reviews_sum
FROM typed JOIN ({L_SQL['l7_pricing']}) USING (title_id) WHERE stars IS NOT NULL GROUP BY ALL""",
    "m9_release_price": f"""SELECT coalesce(if(released >= make_timestamp(2023, 6, 1, 0, 0, 0), 'New Release (Last 2 Years)',
    if(released IS NULL, NULL, 'Back Catalog')), 'Unknown/Unlisted Date') AS release_category,
  count(*) AS title_count, {_mean('base')} AS avg_base_price, {_mean('final')} AS avg_final_price
FROM typed WHERE base > 0 GROUP BY ALL""",
    "m10_currency_price": f"""SELECT currency, count(*) AS title_count, {_mean('base')} AS avg_base_price_msrp,
  {_mean('final')} AS avg_final_price_current
FROM typed WHERE base > 0 GROUP BY ALL""",
    "m11_promo_effect": f"""SELECT promo AS promo_name, count(*) AS titles_in_promotion, {_mean('off')} AS avg_discount_depth,
  sum(reviews)::BIGINT AS total_reviews_driven
FROM typed WHERE promo IS NOT NULL AND reviews IS NOT NULL GROUP BY ALL HAVING count(*) >= 10""",
    "m12_platform_breadth": f"""SELECT len(systems) AS num_platforms, count(*) AS game_count, {_mean('base')} AS avg_base_price,
  {_mean('stars')} AS avg_quality_rating
FROM typed WHERE len(systems) > 0 AND base IS NOT NULL AND stars IS NOT NULL GROUP BY ALL""",
    "m13_support_skeleton": f"""SELECT unnest(['Support URL Missing/Not Provided', 'Dedicated Support URL Present']) AS support_status,
  unnest([count(*) FILTER (WHERE unsupported), count(*) FILTER (WHERE NOT unsupported)]) AS game_count,
  unnest([{_mean('if(unsupported, stars, NULL)')}, {_mean('if(unsupported, NULL, stars)')}]) AS avg_customer_rating,
  unnest([sum(reviews) FILTER (WHERE unsupported), sum(reviews) FILTER (WHERE NOT unsupported)])::BIGINT AS total_reviews_sum
FROM typed WHERE stars IS NOT NULL""",
}

_M_REPORTS = {
    "m1_median_by_party": analytics.REPORTS["top_developers"],
    "m2_median_by_publisher": analytics.REPORTS["top_publishers"],
    "m3_era_quality": analytics.era_quality,
    "m4_age_by_genre": analytics.age_by_genre,
    "m5_reviews_by_age_tier": analytics.reviews_by_age_tier,
    "m6_type_contribution": analytics.type_contribution,
    "m7_content_groups": analytics.content_groups,
    "m8_free_vs_paid": analytics.free_vs_paid,
    "m9_release_price": analytics.release_price,
    "m10_currency_price": analytics.currency_price,
    "m11_promo_effect": analytics.promo_effect,
    "m12_platform_breadth": analytics.platform_breadth,
    "m13_support_skeleton": analytics.support_skeleton,
}

for _qname, _report in _M_REPORTS.items():
    register(_qname, CATALOG_CTES + M_SQL[_qname])(_report_query(_report))


def flagship(spark: SparkSession, base_dir: str) -> DataFrame:
    """Top publishers by median rating over the normalised listing (the
    median-per-party report; at the smallest scale the publisher groups are
    the ones that reach the five-title minimum)."""
    return analytics.median_by_party(catalog(spark, base_dir), "publisher")


__all__ = ["CATALOG_CTES", "M_SQL", "TABLE_CTES", "catalog", "flagship"]


# --- hash-key mode, compared key-free -------------------------------------------
# Hash keys cannot be recomputed by the oracle, so these checks resolve every
# foreign key of a hash-keyed fact table back to its dimension name; the SQL
# twin does the same over its dense-keyed chain. Equal results mean the
# in-place hash keys point at the right dimension rows.

def _hash_catalog(spark: SparkSession, base_dir: str) -> Catalog:
    return Catalog(listing(spark, base_dir), keys="hash")


def _names_view(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, name: str,
                alias: str, how: str = "inner") -> DataFrame:
    """Replace ``fact_key`` by the dimension name it points at."""
    d = dim.select(F.col(dim_key).alias("_k"), F.col(name).alias(alias))
    return fact.join(d, fact[fact_key] == d["_k"], how).drop("_k", fact_key)


@register("l3_inventory_hash", CATALOG_CTES + "SELECT title_id, publisher AS publisher_name, developer AS developer_name FROM typed")
def l3_inventory_hash(spark, base_dir):
    cat = _hash_catalog(spark, base_dir)
    party = cat["party"]
    inv = cat["inventory"].select("title_id", "publisher_id", "developer_id")
    inv = _names_view(inv, party, "publisher_id", "party_id", "name", "publisher_name", "left")
    return _names_view(inv, party, "developer_id", "party_id", "name", "developer_name", "left")


@register("l9_discount_status_hash", CATALOG_CTES + f"""SELECT title_id, promo AS promo_name,
  discount_percentage::VARCHAR::DOUBLE AS discount_percentage, is_discounted
FROM typed JOIN ({L_SQL['l9_discount_status']}) USING (title_id)""")
def l9_discount_status_hash(spark, base_dir):
    cat = _hash_catalog(spark, base_dir)
    ds = cat["discount_status"].select(
        "title_id", "promo_id", F.col("discount_percentage").cast("double"), "is_discounted")
    return _names_view(ds, cat["promotion"], "promo_id", "promo_id", "promo_name", "promo_name")


@register("l10_title_genre_hash", CATALOG_CTES + "SELECT title_id, unnest(tags) AS genre_name FROM typed")
def l10_title_genre_hash(spark, base_dir):
    cat = _hash_catalog(spark, base_dir)
    return _names_view(cat["title_genre"], cat["genre"], "genre_id", "genre_id", "genre_name",
                       "genre_name")


@register("l11_title_os_hash", CATALOG_CTES + "SELECT title_id, unnest(systems) AS os_name FROM typed")
def l11_title_os_hash(spark, base_dir):
    cat = _hash_catalog(spark, base_dir)
    return _names_view(cat["title_os"], cat["os_platform"], "os_id", "os_id", "os_name",
                       "os_name")
