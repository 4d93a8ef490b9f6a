"""Declared schemas, keys and references of the catalogue model.

The staging table keeps text first and converts later: every column is a
string except ``id`` and ``type``. Identifiers are the lower-case names the
source DDL folds to. Typed tables widen the integer surrogate and title keys to
``bigint`` so they cannot overflow at cluster scale.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The 51 staging columns in file order (the CSV is positional).
RAW_COLUMNS = [
    "id", "developer", "publisher", "gallery", "video",
    "supportedoperatingsystems", "genres",
    "globalreleasedate", "istba", "isdiscounted_main", "isindevelopment", "releasedate",
    "availability", "salesvisibility", "buyable",
    "title", "image", "url", "supporturl", "forumurl", "workson",
    "category", "originalcategory", "rating", "type",
    "iscomingsoon", "ispricevisible", "ismovie", "isgame", "slug", "iswishlistable",
    "agelimit", "boximage", "ismod",
    "currency", "amount", "baseamount", "finalamount", "isdiscounted", "discountpercentage",
    "discountdifference", "discount", "isfree", "promoid",
    "filteredavgrating", "overallavgrating", "reviewscount", "isreviewable", "reviewpages",
    "dateglobal", "datereleasedate",
]

# ``id`` is widened from the source's INTEGER to bigint (title ids of a
# 100 TB listing exceed 2^31); ``type`` stays an integer code.
_RAW_TYPES = {"id": T.LongType(), "type": T.IntegerType()}

RAW_SCHEMA = T.StructType([
    T.StructField(name, _RAW_TYPES.get(name, T.StringType()),
                  nullable=name not in ("id", "title"))
    for name in RAW_COLUMNS
])

# The 28 staging columns the normalisation reads; the rest are staged only.
USED_RAW_COLUMNS = [
    "id", "developer", "publisher", "supportedoperatingsystems", "genres",
    "globalreleasedate", "buyable", "title", "supporturl", "type", "ismovie", "isgame",
    "slug", "agelimit", "currency", "amount", "baseamount", "finalamount", "isdiscounted",
    "discountpercentage", "discountdifference", "isfree", "promoid", "filteredavgrating",
    "overallavgrating", "reviewscount", "isreviewable", "reviewpages",
]

# The source's NUMERIC has no bound: the decimal is for arithmetic, and where it cannot hold an
# amount exactly, the column <name>_exact holds its digits (see ``functions.clean``).
MONEY = T.DecimalType(38, 18)
EXACT_SUFFIX = "_exact"


def _struct(*fields):
    """Amounts come first with their own column, then, at the end, with that of their digits."""
    exact = [(n + EXACT_SUFFIX, T.StringType(), True) for n, t, _ in fields if t is MONEY]
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in [*fields, *exact]])


TABLE_SCHEMAS = {
    "party": _struct(("party_id", T.LongType(), False), ("name", T.StringType(), False)),
    "product_type": _struct(("type_id", T.IntegerType(), False),
                            ("type_name", T.StringType(), False)),
    "inventory": _struct(
        ("title_id", T.LongType(), False), ("title", T.StringType(), False),
        ("slug", T.StringType(), True), ("release_date", T.TimestampNTZType(), True),
        ("age_limit", T.IntegerType(), True), ("is_game", T.BooleanType(), True),
        ("is_movie", T.BooleanType(), True), ("buyable", T.BooleanType(), True),
        ("support_url", T.StringType(), True), ("publisher_id", T.LongType(), True),
        ("developer_id", T.LongType(), True), ("type_id", T.IntegerType(), True)),
    "os_platform": _struct(("os_id", T.LongType(), False), ("os_name", T.StringType(), False)),
    "genre": _struct(("genre_id", T.LongType(), False), ("genre_name", T.StringType(), False)),
    "promotion": _struct(("promo_id", T.LongType(), False),
                         ("promo_name", T.StringType(), False)),
    "pricing": _struct(
        ("title_id", T.LongType(), False), ("base_amount", MONEY, True),
        ("final_amount", MONEY, True), ("amount", MONEY, True),
        ("currency", T.StringType(), True), ("is_free", T.BooleanType(), True)),
    "rating": _struct(
        ("title_id", T.LongType(), False), ("overall_avg_rating", MONEY, True),
        ("filtered_avg_rating", MONEY, True), ("reviews_count", T.IntegerType(), True),
        ("is_reviewable", T.BooleanType(), True), ("review_pages", T.IntegerType(), True)),
    "discount_status": _struct(
        ("title_id", T.LongType(), False), ("promo_id", T.LongType(), False),
        ("discount_percentage", MONEY, True), ("discount_difference", MONEY, True),
        ("is_discounted", T.BooleanType(), True)),
    "title_genre": _struct(("title_id", T.LongType(), False), ("genre_id", T.LongType(), False)),
    "title_os": _struct(("title_id", T.LongType(), False), ("os_id", T.LongType(), False)),
}

# Keys and references of every table, as data for the checks.
PRIMARY_KEYS = {
    "raw": ["id"],
    "party": ["party_id"],
    "product_type": ["type_id"],
    "inventory": ["title_id"],
    "os_platform": ["os_id"],
    "genre": ["genre_id"],
    "promotion": ["promo_id"],
    "pricing": ["title_id"],
    "rating": ["title_id"],
    "discount_status": ["title_id", "promo_id"],
    "title_genre": ["title_id", "genre_id"],
    "title_os": ["title_id", "os_id"],
}

# Natural keys that must be unique and not null.
UNIQUE_KEYS = {
    "party": ["name"],
    "os_platform": ["os_name"],
    "genre": ["genre_name"],
    "promotion": ["promo_name"],
}

NOT_NULL = {
    "raw": ["id", "title"],
    "party": ["name"],
    "product_type": ["type_name"],
    "inventory": ["title"],
    "os_platform": ["os_name"],
    "genre": ["genre_name"],
    "promotion": ["promo_name"],
}

# (child table, child column, parent table, parent column): the 11 references.
FOREIGN_KEYS = [
    ("inventory", "publisher_id", "party", "party_id"),
    ("inventory", "developer_id", "party", "party_id"),
    ("inventory", "type_id", "product_type", "type_id"),
    ("pricing", "title_id", "inventory", "title_id"),
    ("rating", "title_id", "inventory", "title_id"),
    ("discount_status", "title_id", "inventory", "title_id"),
    ("discount_status", "promo_id", "promotion", "promo_id"),
    ("title_genre", "title_id", "inventory", "title_id"),
    ("title_genre", "genre_id", "genre", "genre_id"),
    ("title_os", "title_id", "inventory", "title_id"),
    ("title_os", "os_id", "os_platform", "os_id"),
]
