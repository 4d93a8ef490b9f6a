"""The business reports over the normalised catalogue.

Each report takes the table dict from :func:`stocktake.plans.normalize.normalize`
(or the same tables read back from Parquet) and returns a small aggregated
DataFrame, sorted like the source report (descending, NULLs first). Sorting
always happens after aggregation, so it never touches unaggregated rows.

Averages are exact ``sum / count`` doubles (:func:`~stocktake.operators.aggregates.mean`),
medians the exact frequency-based percentile. Joins to dimensions are left to
AQE (broadcast once measured small, otherwise sort-merge with skew splitting);
literal-sized tables are broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import clean, tiers
from ..operators.aggregates import at_least, count_histogram, grouped_percentile, mean
from ..operators.joins import with_required_categories

Tables = dict[str, DataFrame]


def _desc(*cols: str):
    return [F.col(c).desc_nulls_first() for c in cols]


def _sum_decimal(col: str):
    # An amount beyond the type, of which the decimal is only the limit, must not pass for a price.
    return F.sum(clean.in_range(col))


def _mean_decimal(col: str):
    return mean(clean.in_range(col))


def _sum_long(col: str):
    return F.sum(F.col(col)).cast("long")


def _types(t: Tables) -> DataFrame:
    """The product types: three literal rows, however they are stored. Their few keys must not be shuffled on."""
    return F.broadcast(t["product_type"])


def median_by_party(t: Tables, role: str = "developer", min_titles: int = 5) -> DataFrame:
    """Parties with at least ``min_titles`` rated titles: title count and median
    overall rating (role = ``developer`` or ``publisher``)."""
    inv = t["inventory"].select("title_id", F.col(f"{role}_id").alias("_party"))
    party = t["party"].select(F.col("party_id").alias("_party"), F.col("name").alias(f"{role}_name"))
    rated = t["rating"].select("title_id", "overall_avg_rating") \
        .where(F.col("overall_avg_rating").isNotNull())
    # Titles meet their ratings first (no shuffle where both are bucketed), then
    # frequencies per party key; names come last, for the parties that remain.
    rows = inv.where(F.col("_party").isNotNull()).join(rated, "title_id")
    out = at_least(grouped_percentile(rows, ["_party"], "overall_avg_rating", 0.5, alias="median_rating",
                                      count_alias="catalog_presence"), "catalog_presence", min_titles)
    return (out.join(party, "_party").select(f"{role}_name", "catalog_presence", "median_rating")
            .orderBy(*_desc("median_rating", "catalog_presence")))


def era_quality(t: Tables) -> DataFrame:
    """Classic (before 2010) vs modern titles: count, mean rating, mean base price."""
    inv = t["inventory"].select("title_id", "release_date")
    rated = t["rating"].select("title_id", "overall_avg_rating") \
        .where(F.col("overall_avg_rating").isNotNull())
    price = t["pricing"].select("title_id", "base_amount")
    rows = inv.join(rated, "title_id").join(price, "title_id", "left") \
        .withColumn("game_era", tiers.cutoff_two_way("release_date"))
    return rows.groupBy("game_era").agg(
        F.count("title_id").alias("titles_in_group"),
        _mean_decimal("overall_avg_rating").alias("avg_quality_rating"),
        _mean_decimal("base_amount").alias("avg_base_price"),
    ).orderBy(*_desc("avg_quality_rating"))


def age_by_genre(t: Tables, min_titles: int = 5) -> DataFrame:
    """Mean age limit per genre (a title counts once per genre it has)."""
    inv = t["inventory"].select("title_id", "age_limit") \
        .where(F.col("age_limit").isNotNull() & (F.col("age_limit") > 0))
    rows = inv.join(t["title_genre"], "title_id")
    out = at_least(rows.groupBy("genre_id").agg(
        F.count("title_id").alias("title_count"),
        mean("age_limit").alias("avg_age_limit")), "title_count", min_titles)
    return (out.join(t["genre"], "genre_id").select("genre_name", "title_count", "avg_age_limit")
            .orderBy(*_desc("avg_age_limit")))


def reviews_by_age_tier(t: Tables) -> DataFrame:
    inv = t["inventory"].select("title_id", "age_limit").where(F.col("age_limit").isNotNull())
    rated = t["rating"].select("title_id", "reviews_count") \
        .where(F.col("reviews_count").isNotNull())
    rows = inv.join(rated, "title_id") \
        .withColumn("age_restriction_group", tiers.age_tier("age_limit"))
    return rows.groupBy("age_restriction_group").agg(
        F.count("title_id").alias("game_count"),
        _sum_long("reviews_count").alias("total_reviews_sum"),
    ).orderBy(*_desc("total_reviews_sum"))


def type_contribution(t: Tables) -> DataFrame:
    """Per product type: titles, review total and base-price total (titles
    without a known type are left out)."""
    inv = t["inventory"].select("title_id", "type_id")
    rows = (inv.join(_types(t), "type_id")
            .join(t["rating"].select("title_id", "reviews_count"), "title_id", "left")
            .join(t["pricing"].select("title_id", "base_amount"), "title_id", "left"))
    return rows.groupBy(F.col("type_name").alias("product_category")).agg(
        F.count("title_id").alias("catalog_count"),
        _sum_long("reviews_count").alias("total_reviews_proxy"),
        _sum_decimal("base_amount").alias("total_base_amount_proxy"),
    ).orderBy(*_desc("total_reviews_proxy"))


def content_groups(t: Tables) -> DataFrame:
    """Movies first, then bundle / DLC / game: titles and base-price total."""
    inv = t["inventory"].select("title_id", "type_id", "is_movie")
    rows = (inv.join(_types(t), "type_id")
            .join(t["pricing"].select("title_id", "base_amount"), "title_id", "left")
            .withColumn("content_type_group", tiers.content_group("is_movie", "type_name")))
    return rows.groupBy("content_type_group").agg(
        F.count("title_id").alias("titles_in_group"),
        _sum_decimal("base_amount").alias("total_base_amount_value"),
    ).orderBy(*_desc("titles_in_group"))


def free_vs_paid(t: Tables) -> DataFrame:
    inv = t["inventory"].select("title_id")
    price = t["pricing"].select("title_id", "is_free")
    rated = t["rating"].select("title_id", "overall_avg_rating", "reviews_count") \
        .where(F.col("overall_avg_rating").isNotNull())
    rows = inv.join(price, "title_id").join(rated, "title_id") \
        .withColumn("revenue_model", tiers.bool_label("is_free"))
    return rows.groupBy("revenue_model").agg(
        F.count("title_id").alias("title_count"),
        _mean_decimal("overall_avg_rating").alias("avg_user_rating"),
        _sum_long("reviews_count").alias("total_reviews_sum"),
    ).orderBy(*_desc("total_reviews_sum"))


def release_price(t: Tables) -> DataFrame:
    """New releases vs back catalogue vs unknown date, priced titles only."""
    inv = t["inventory"].select("title_id", "release_date")
    price = t["pricing"].select("title_id", "base_amount", "final_amount") \
        .where(F.col("base_amount").isNotNull() & (F.col("base_amount") > 0))
    rows = inv.join(price, "title_id") \
        .withColumn("release_category", tiers.cutoff_three_way("release_date"))
    return rows.groupBy("release_category").agg(
        F.count("title_id").alias("title_count"),
        _mean_decimal("base_amount").alias("avg_base_price"),
        _mean_decimal("final_amount").alias("avg_final_price"),
    ).orderBy(*_desc("avg_base_price"))


def currency_price(t: Tables) -> DataFrame:
    """Per currency (NULL is its own group), priced titles only."""
    price = t["pricing"].where(F.col("base_amount").isNotNull() & (F.col("base_amount") > 0))
    return price.groupBy("currency").agg(
        F.count("title_id").alias("title_count"),
        _mean_decimal("base_amount").alias("avg_base_price_msrp"),
        _mean_decimal("final_amount").alias("avg_final_price_current"),
    ).orderBy(*_desc("title_count"))


def promo_effect(t: Tables, min_titles: int = 10) -> DataFrame:
    rated = t["rating"].select("title_id", "reviews_count") \
        .where(F.col("reviews_count").isNotNull())
    rows = t["discount_status"].join(rated, "title_id")
    out = at_least(rows.groupBy("promo_id").agg(
        F.count("title_id").alias("titles_in_promotion"),
        _mean_decimal("discount_percentage").alias("avg_discount_depth"),
        _sum_long("reviews_count").alias("total_reviews_driven")), "titles_in_promotion", min_titles)
    return (out.join(t["promotion"], "promo_id")
            .select("promo_name", "titles_in_promotion", "avg_discount_depth", "total_reviews_driven")
            .orderBy(*_desc("total_reviews_driven")))


def platform_breadth(t: Tables) -> DataFrame:
    """Titles per number of supported platforms, with mean price and rating.

    The outer joins are followed by a filter that rejects their NULLs, so
    Catalyst plans them as inner joins (titles without a price or rating drop).
    """
    counts = count_histogram(t["title_os"], "title_id", "os_id", "num_platforms")
    rows = (counts.join(t["inventory"].select("title_id"), "title_id")
            .join(t["pricing"].select("title_id", "base_amount"), "title_id", "left")
            .join(t["rating"].select("title_id", "overall_avg_rating"), "title_id", "left")
            .where(F.col("base_amount").isNotNull() & F.col("overall_avg_rating").isNotNull()))
    return rows.groupBy("num_platforms").agg(
        F.count("title_id").alias("game_count"),
        _mean_decimal("base_amount").alias("avg_base_price"),
        _mean_decimal("overall_avg_rating").alias("avg_quality_rating"),
    ).orderBy(*_desc("num_platforms"))


def support_skeleton(t: Tables) -> DataFrame:
    """Rated titles with and without a support URL; both rows always present."""
    rated = t["rating"].select("title_id", "overall_avg_rating", "reviews_count") \
        .where(F.col("overall_avg_rating").isNotNull())
    rows = t["inventory"].select("title_id", "support_url").join(rated, "title_id") \
        .withColumn("status", tiers.support_status("support_url"))
    agg = rows.groupBy("status").agg(
        F.count("title_id").alias("game_count"),
        _mean_decimal("overall_avg_rating").alias("avg_customer_rating"),
        _sum_long("reviews_count").alias("total_reviews_sum"))
    spark = rows.sparkSession
    out = with_required_categories(
        spark, [tiers.SUPPORT_PRESENT_LABEL, tiers.SUPPORT_MISSING_LABEL], "support_status",
        agg, "status", zero_fill=["game_count"])
    return out.orderBy(*_desc("support_status"))


# --- seven reports from one pass -------------------------------------------------

#: Reports that group titles by one label of their own.
BY_TITLE = ("era_quality", "reviews_by_age_tier", "type_contribution", "content_groups", "free_vs_paid",
            "release_price", "support_skeleton")


def title_labels(t: Tables) -> DataFrame:
    """One row per title: what the reports measure, and its label in each of ``BY_TITLE``.

    A label is NULL where the report leaves the title out. Each title table is
    read once; bucketed ones are joined without a shuffle. Titles must be unique
    in them, as the load report checks.
    """
    rows = (t["inventory"].select("title_id", "release_date", "age_limit", "type_id", "is_movie", "support_url")
            .join(t["rating"].select("title_id", "overall_avg_rating", "reviews_count"), "title_id", "left")
            .join(t["pricing"].select("title_id", "base_amount", "final_amount", "is_free", F.lit(True).alias("priced")), "title_id", "left")
            .join(_types(t), "type_id", "left"))
    rated = F.col("overall_avg_rating").isNotNull()
    labels = {
        "era_quality": F.when(rated, tiers.cutoff_two_way("release_date")),
        "reviews_by_age_tier": F.when(F.col("age_limit").isNotNull() & F.col("reviews_count").isNotNull(), tiers.age_tier("age_limit")),
        "type_contribution": F.col("type_name"),
        "content_groups": F.when(F.col("type_name").isNotNull(), tiers.content_group("is_movie", "type_name")),
        "free_vs_paid": F.when(F.col("priced") & rated, tiers.bool_label("is_free")),
        "release_price": F.when(F.col("base_amount") > 0, tiers.cutoff_three_way("release_date")),
        "support_skeleton": F.when(rated, tiers.support_status("support_url")),
    }
    return rows.select("overall_avg_rating", "reviews_count", "base_amount", "final_amount",
                       *[labels[name].alias(name) for name in BY_TITLE])


def title_groups(t: Tables) -> DataFrame:
    """report, label and all measures of the groups of the seven reports: a few dozen rows, by grouping sets."""
    groups = title_labels(t).groupingSets([[name] for name in BY_TITLE], *BY_TITLE)
    sums = [("rating", "overall_avg_rating"), ("base", "base_amount"), ("final", "final_amount")]
    low, high = clean.amount_limits()
    kept = lambda c: F.when((F.col(c) > low) & (F.col(c) < high), F.col(c))
    return groups.agg(
        F.coalesce(*[F.when(F.grouping(name) == 0, F.lit(name)) for name in BY_TITLE]).alias("report"),
        F.coalesce(*BY_TITLE).alias("label"), F.count(F.lit(1)).alias("titles"), _sum_long("reviews_count").alias("reviews"),
        *[F.sum(kept(c)).alias(n) for n, c in sums], *[F.count(c).alias(f"{n}_count") for n, c in sums],
        *[F.count(F.when((F.col(c) <= low) | (F.col(c) >= high), 1)).alias(f"{n}_beyond") for n, c in sums],
    ).where(F.col("label").isNotNull()).drop(*BY_TITLE)


def reports_by_title(groups: DataFrame) -> dict[str, DataFrame]:
    """The reports of ``BY_TITLE`` from :func:`title_groups`, as the single functions give them."""
    spark = groups.sparkSession
    beyond = lambda n: F.when(F.col(f"{n}_beyond") > 0, F.raise_error(F.lit(f"an amount beyond 20 digits: {n}")))
    total = lambda n: beyond(n).otherwise(F.col(n))
    average = lambda n: F.try_divide(total(n).cast("double"), F.col(f"{n}_count").cast("double"))
    # Per report: the name of its label, its measures in order, and what it is sorted by.
    shapes = {
        "era_quality": ("game_era", {"titles_in_group": F.col("titles"), "avg_quality_rating": average("rating"),
                                     "avg_base_price": average("base")}, "avg_quality_rating"),
        "reviews_by_age_tier": ("age_restriction_group", {"game_count": F.col("titles"), "total_reviews_sum": F.col("reviews")},
                                "total_reviews_sum"),
        "type_contribution": ("product_category", {"catalog_count": F.col("titles"), "total_reviews_proxy": F.col("reviews"),
                                                   "total_base_amount_proxy": total("base")}, "total_reviews_proxy"),
        "content_groups": ("content_type_group", {"titles_in_group": F.col("titles"), "total_base_amount_value": total("base")},
                           "titles_in_group"),
        "free_vs_paid": ("revenue_model", {"title_count": F.col("titles"), "avg_user_rating": average("rating"),
                                           "total_reviews_sum": F.col("reviews")}, "total_reviews_sum"),
        "release_price": ("release_category", {"title_count": F.col("titles"), "avg_base_price": average("base"),
                                               "avg_final_price": average("final")}, "avg_base_price"),
        "support_skeleton": ("status", {"game_count": F.col("titles"), "avg_customer_rating": average("rating"),
                                        "total_reviews_sum": F.col("reviews")}, "support_status"),
    }
    out = {}
    for name, (label, measures, order) in shapes.items():
        rows = groups.where(F.col("report") == name).select(F.col("label").alias(label), *[c.alias(n) for n, c in measures.items()])
        if name == "support_skeleton":
            rows = with_required_categories(spark, [tiers.SUPPORT_PRESENT_LABEL, tiers.SUPPORT_MISSING_LABEL], order,
                                            rows, label, zero_fill=["game_count"])
        out[name] = rows.orderBy(*_desc(order))
    return out


REPORTS = {
    "top_developers": lambda t: median_by_party(t, "developer"),
    "top_publishers": lambda t: median_by_party(t, "publisher"),
    "era_quality": era_quality,
    "age_by_genre": age_by_genre,
    "reviews_by_age_tier": reviews_by_age_tier,
    "type_contribution": type_contribution,
    "content_groups": content_groups,
    "free_vs_paid": free_vs_paid,
    "release_price": release_price,
    "currency_price": currency_price,
    "promo_effect": promo_effect,
    "platform_breadth": platform_breadth,
    "support_skeleton": support_skeleton,
}
