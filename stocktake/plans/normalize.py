"""Normalisation of the staging listing into the typed catalogue model.

Dependency order (every table is a pure function of the staging frame):

    raw -> party, promotion, genre, os_platform (dimensions, dense keys)
    raw + party + product_type -> inventory
    raw + inventory -> pricing, rating
    raw + promotion + inventory -> discount_status
    raw + genre + inventory -> title_genre;  raw + os_platform + inventory -> title_os

Each builder projects only the staging columns it needs first, so a Parquet
staging table is scanned column-pruned. Dimensions are checkpointed by
:func:`~stocktake.operators.keys.dense_keys`, which also cuts their lineage.

Two key modes (``Catalog(raw, keys=...)``):

* ``dense`` (default): keys 1..N in name order; the fact builders look them
  up: in place in a dimension that is counted and small; else rows without a
  name and rows of frequent names get their keys in place, the others by joins.
* ``hash``: ``xxhash64(name)``; the fact builders compute keys in place, so
  inventory, discount status and the bridges need no join and no shuffle.

Restricting the status tables and bridges to inventory's titles is a filter
when inventory comes from the same staging frame (see
:func:`_restrict_to_inventory`).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions import clean
from ..operators.dedupe import entity_from_columns
from ..operators.joins import restrict_to, spread_lookup
from ..operators.keymap import KeyMap
from ..operators.keys import dense_keys, hash_keys
from ..schemas import EXACT_SUFFIX, TABLE_SCHEMAS
from ..session import checkpoint_dir
from ..sources.static import product_type
from ..sources.tables import table_path


# --- text that no conversion takes ---------------------------------------------------

#: fail: the first such text ends the load. null: the value is NULL, and
#: :func:`rejected_values` lists the text.
ERROR_MODES = ("fail", "null")

#: Staging columns whose text is converted, by kind of conversion.
CONVERSIONS = {
    "globalreleasedate": "epoch", "agelimit": "filled integer", "reviewscount": "integer", "reviewpages": "integer",
    "baseamount": "amount", "finalamount": "amount", "amount": "amount", "overallavgrating": "amount",
    "filteredavgrating": "amount", "discountpercentage": "amount", "discountdifference": "amount",
    "supportedoperatingsystems": "list",
}
#: Of these, the columns that may hold boolean words.
GUARDED = ("discountpercentage", "discountdifference")
#: Converted only for titles with a promotion, as the tables hold no others.
PROMOTED_ONLY = ("discountpercentage", "discountdifference")


def _strict(on_error: str) -> bool:
    if on_error not in ERROR_MODES:
        raise ValueError(f"on_error must be one of {ERROR_MODES}")
    return on_error == "fail"


def conversion_text(column: str) -> Column:
    """The text that a conversion of the staging column meets; NULL where there is none."""
    text = clean.guarded_text(column) if column in GUARDED else F.col(column)
    if column in PROMOTED_ONLY:
        text = F.when(clean.non_blank("promoid"), text)
    return text


def rejected_values(raw: DataFrame) -> DataFrame:
    """id, column_name, text and reason of every value that ``on_error="null"`` makes NULL.

    One pass over the converted columns; only rows with such a value are expanded.
    """
    found = F.array_compact(F.array(*[
        F.when(clean.rejected(conversion_text(c), kind), F.struct(
            F.lit(c).alias("column_name"), F.col(c).alias("text"), F.lit(clean.REASONS[kind]).alias("reason")))
        for c, kind in CONVERSIONS.items()]))
    return raw.where(F.col("id").isNotNull()).select("id", F.explode(found).alias("r")).select("id", "r.*")


# --- dimensions ---------------------------------------------------------------
# Each dimension is "distinct names" + dense keys; the name extraction is kept
# separate so the incremental (streaming) load can reuse it per micro-batch.

def party_names(raw: DataFrame) -> DataFrame:
    """Developers and publishers merged into one party list (names not trimmed)."""
    return entity_from_columns(raw, ["developer", "publisher"], "name")


def os_names(raw: DataFrame, on_error: str = "fail") -> DataFrame:
    """Distinct items of the JSON-ish OS lists, case and spacing kept.

    Rows whose list is NULL, blank or ``[]`` are skipped; NULL items are
    dropped (the name is required).
    """
    src = F.col("supportedoperatingsystems")
    lists = raw.select(src).where(src.isNotNull() & (F.trim(src) != "[]") & (F.trim(src) != ""))
    items = lists.select(F.explode(clean.json_list_items(src, _strict(on_error))).alias("os_name"))
    return items.where(F.col("os_name").isNotNull()).distinct()


def genre_names(raw: DataFrame) -> DataFrame:
    """Distinct genre names from bare list text, trimmed and lower-cased."""
    src = F.col("genres")
    lists = raw.select(src).where(src.isNotNull() & ~F.trim(src).isin("", "[]"))
    items = lists.select(F.explode(clean.text_list_items(src)).alias("item"))
    return (items.where(F.col("item").isNotNull() & (F.trim(F.col("item")) != ""))
            .select(clean.fold_name("item").alias("genre_name")).distinct())


def promo_names(raw: DataFrame) -> DataFrame:
    """Distinct trimmed promotion ids (blank ones skipped)."""
    return (raw.select(F.trim(F.col("promoid")).alias("promo_name"))
            .where(F.col("promo_name").isNotNull() & (F.col("promo_name") != "")).distinct())


# dimension -> (name extractor, name column, key column)
DIMENSION_SPECS = {
    "party": (party_names, "name", "party_id"),
    "os_platform": (os_names, "os_name", "os_id"),
    "genre": (genre_names, "genre_name", "genre_id"),
    "promotion": (promo_names, "promo_name", "promo_id"),
}


KEY_MODES = ("dense", "hash")


def key_map(spark: SparkSession, folder: str, name: str) -> KeyMap:
    """The stored keys of a dimension."""
    _, name_col, key_col = DIMENSION_SPECS[name]
    return KeyMap(spark, table_path(folder, name), name_col, key_col)


def build_dimension(raw: DataFrame, name: str, keys: str = "dense", on_error: str = "fail",
                    key_maps: str | None = None) -> DataFrame:
    """Distinct names with keys: ``dense`` (1..N in name order, looked up by
    the fact builders) or ``hash`` (``xxhash64(name)``, computed in place by
    the fact builders, so they need no join; the quality job's key check
    catches a collision). With ``key_maps``, a folder, dense keys are kept
    there: names that have one keep it, new ones follow."""
    extract, name_col, key_col = DIMENSION_SPECS[name]
    names = extract(raw, on_error) if extract is os_names else extract(raw)
    if keys == "hash":
        return hash_keys(names, name_col, key_col)
    if keys != "dense":
        raise ValueError(f"keys must be one of {KEY_MODES}")
    if key_maps is not None:
        return key_map(raw.sparkSession, key_maps, name).keyed(names)
    return dense_keys(names, name_col, key_col)


def name_key(name) -> Column:
    """The ``hash`` key of a name (NULL stays NULL)."""
    c = F.col(name) if isinstance(name, str) else name
    return F.when(c.isNotNull(), F.xxhash64(c))


def build_party(raw: DataFrame, keys: str = "dense") -> DataFrame:
    return build_dimension(raw, "party", keys)


def build_os_platform(raw: DataFrame, keys: str = "dense", on_error: str = "fail") -> DataFrame:
    return build_dimension(raw, "os_platform", keys, on_error)


def build_genre(raw: DataFrame, keys: str = "dense") -> DataFrame:
    return build_dimension(raw, "genre", keys)


def build_promotion(raw: DataFrame, keys: str = "dense") -> DataFrame:
    return build_dimension(raw, "promotion", keys)


# --- core entity --------------------------------------------------------------

def build_inventory(raw: DataFrame, party: DataFrame | None, keys: str = "dense", on_error: str = "fail") -> DataFrame:
    """Typed titles with publisher and developer looked up in ``party``.

    One row in, one row out: ``party.name`` is unique, and a name without a
    party gives a NULL key (left lookup). With ``keys="hash"`` the keys are
    computed from the names in place (every non-NULL name is a party by
    construction), so no join is needed and ``party`` may be None.
    """
    strict = _strict(on_error)
    typed = raw.where(F.col("id").isNotNull()).select(
        F.col("id").cast("long").alias("title_id"),
        F.col("title"),
        F.col("slug"),
        clean.epoch_seconds_to_timestamp("globalreleasedate", strict).alias("release_date"),
        clean.to_int("agelimit", strict).alias("age_limit"),
        clean.text_flag("isgame").alias("is_game"),
        clean.text_flag("ismovie").alias("is_movie"),
        clean.text_flag("buyable").alias("buyable"),
        F.col("supporturl").alias("support_url"),
        F.col("publisher"),
        F.col("developer"),
        F.col("type").cast("int").alias("type_id"),
    )
    if keys == "hash":
        typed = typed.withColumn("publisher_id", name_key("publisher")) \
                     .withColumn("developer_id", name_key("developer"))
    else:
        for role in ("publisher", "developer"):
            typed = spread_lookup(typed, party, role, "name", "party_id", f"{role}_id", look_in=raw)
    return typed.select("title_id", "title", "slug", "release_date", "age_limit", "is_game",
                        "is_movie", "buyable", "support_url", "publisher_id", "developer_id",
                        "type_id")


# --- status tables ------------------------------------------------------------

def _restrict_to_inventory(rows: DataFrame, inventory: DataFrame | None) -> DataFrame:
    """``WHERE title_id IN (SELECT title_id FROM inventory)``.

    ``inventory=None`` means "the inventory built from this same staging
    frame": :func:`build_inventory` keeps every row with a non-NULL id (its
    lookups are left joins), so its id set is exactly the non-NULL staging ids
    and the semi-join reduces to ``title_id IS NOT NULL`` -- the same rows
    without shuffling both sides. Pass a stored inventory table to get the
    general left-semi join.
    """
    if inventory is None:
        return rows.where(F.col("title_id").isNotNull())
    return restrict_to(rows, inventory, "title_id", "title_id")


def _amounts(names: dict[str, str], strict: bool) -> tuple[dict[str, Column], list[Column]]:
    """Decimals by table column (of staging columns), and the columns of those and of their exact digits."""
    text = {name: conversion_text(source) for name, source in names.items()}
    values = {name: clean.blank_decimal(t, strict=strict) for name, t in text.items()}
    return values, [v.alias(n) for n, v in values.items()] + [
        clean.exact_digits(t).alias(n + EXACT_SUFFIX) for n, t in text.items()]


def build_pricing(raw: DataFrame, inventory: DataFrame | None = None, on_error: str = "fail") -> DataFrame:
    """Prices as decimals; free when all three amounts are 0, else the raw flag."""
    values, columns = _amounts({"base_amount": "baseamount", "final_amount": "finalamount", "amount": "amount"}, _strict(on_error))
    rows = raw.select(F.col("id").cast("long").alias("title_id"), *columns, F.col("currency"),
                      clean.free_title(*values.values(), "isfree").alias("is_free"))
    return _restrict_to_inventory(rows, inventory)


def build_rating(raw: DataFrame, inventory: DataFrame | None = None, on_error: str = "fail") -> DataFrame:
    strict = _strict(on_error)
    _, columns = _amounts({"overall_avg_rating": "overallavgrating", "filtered_avg_rating": "filteredavgrating"}, strict)
    rows = raw.select(
        F.col("id").cast("long").alias("title_id"), *columns,
        clean.blank_int("reviewscount", strict).alias("reviews_count"),
        clean.text_flag("isreviewable").alias("is_reviewable"),
        clean.blank_int("reviewpages", strict).alias("review_pages"))
    return _restrict_to_inventory(rows, inventory)


def build_discount_status(raw: DataFrame, promotion: DataFrame | None,
                          inventory: DataFrame | None = None, keys: str = "dense", on_error: str = "fail") -> DataFrame:
    """Discount rows for titles whose trimmed promo id names a promotion.

    ``is_discounted``: a positive percentage, else the trimmed raw flag, else
    false. The percentage used by the rule is the guarded one, so boolean
    words in the column fall through to the flag instead of failing the cast.
    """
    values, columns = _amounts({"discount_percentage": "discountpercentage", "discount_difference": "discountdifference"},
                               _strict(on_error))
    rows = raw.select(F.col("id").cast("long").alias("title_id"), F.trim(F.col("promoid")).alias("_promo"), *columns,
                      clean.discounted(values["discount_percentage"], "isdiscounted").alias("is_discounted"))
    if keys == "hash":
        # The inner join keeps exactly the rows whose trimmed id is a promotion
        # name, i.e. non-blank ones.
        rows = rows.where(F.col("_promo").isNotNull() & (F.col("_promo") != "")) \
                   .withColumn("promo_id", name_key("_promo"))
    else:
        rows = spread_lookup(rows, promotion, "_promo", "promo_name", "promo_id", "promo_id", how="inner",
                             look_in=raw.select(F.trim(F.col("promoid")).alias("_promo")))
    return _restrict_to_inventory(rows, inventory).drop("_promo")


# --- bridges ------------------------------------------------------------------

def build_title_genre(raw: DataFrame, genre: DataFrame | None,
                      inventory: DataFrame | None = None, ids_unique: bool = False,
                      keys: str = "dense") -> DataFrame:
    """(title, genre) pairs from the list text, matched on the folded name.

    Items are folded and de-duplicated inside each row before the explode, so
    with a unique staging ``id`` the pairs are distinct without a shuffle. Pass
    ``ids_unique=True`` only after checking that, as the catalogue job does.
    """
    items = F.array_distinct(F.transform(clean.text_list_items("genres"), clean.fold_name))
    rows = raw.select(F.col("id").cast("long").alias("title_id"),
                      F.explode(items).alias("_name"))
    if keys == "hash":
        # Every non-blank folded item is a genre name by construction.
        rows = rows.where(F.col("_name") != "").withColumn("genre_id", name_key("_name"))
    else:
        rows = spread_lookup(rows, genre, "_name", "genre_name", "genre_id", "genre_id", how="inner")
    rows = _restrict_to_inventory(rows, inventory).select("title_id", "genre_id")
    return rows if ids_unique else rows.dropDuplicates(["title_id", "genre_id"])


def build_title_os(raw: DataFrame, os_platform: DataFrame | None,
                   inventory: DataFrame | None = None, ids_unique: bool = False,
                   keys: str = "dense", on_error: str = "fail") -> DataFrame:
    """(title, os) pairs from the JSON-ish OS lists; blank lists are skipped."""
    src = F.col("supportedoperatingsystems")
    lists = raw.where(src.isNotNull() & (F.trim(src) != ""))
    items = F.array_distinct(clean.json_list_items(src, _strict(on_error)))
    rows = lists.select(F.col("id").cast("long").alias("title_id"),
                        F.explode(items).alias("_name"))
    if keys == "hash":
        # Every non-NULL item of a non-blank list is a platform name.
        rows = rows.where(F.col("_name").isNotNull()).withColumn("os_id", name_key("_name"))
    else:
        rows = spread_lookup(rows, os_platform, "_name", "os_name", "os_id", "os_id", how="inner")
    rows = _restrict_to_inventory(rows, inventory).select("title_id", "os_id")
    return rows if ids_unique else rows.dropDuplicates(["title_id", "os_id"])


# --- everything ---------------------------------------------------------------

def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the declared columns, in order, cast to the declared types
    (a no-op projection when the builder already produced them)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


class Catalog:
    """Lazily built table set: each table is built on first use, once.

    Reports that need three tables build only those (and what they depend
    on); ``normalize`` builds all eleven.
    """

    _BUILD = {
        "party": lambda c: build_dimension(c.raw, "party", c.keys, c.on_error, c.key_maps),
        "product_type": lambda c: product_type(c.raw.sparkSession),
        "inventory": lambda c: build_inventory(c.raw, c._dim("party"), c.keys, c.on_error),
        "os_platform": lambda c: build_dimension(c.raw, "os_platform", c.keys, c.on_error, c.key_maps),
        "genre": lambda c: build_dimension(c.raw, "genre", c.keys, c.on_error, c.key_maps),
        "promotion": lambda c: build_dimension(c.raw, "promotion", c.keys, c.on_error, c.key_maps),
        # Status tables and bridges restrict to the inventory built from the
        # same staging frame (inventory=None, see _restrict_to_inventory).
        "pricing": lambda c: build_pricing(c.raw, on_error=c.on_error),
        "rating": lambda c: build_rating(c.raw, on_error=c.on_error),
        "discount_status": lambda c: build_discount_status(c.raw, c._dim("promotion"), None,
                                                           c.keys, c.on_error),
        "title_genre": lambda c: build_title_genre(c.raw, c._dim("genre"), None, c.ids_unique,
                                                   c.keys),
        "title_os": lambda c: build_title_os(c.raw, c._dim("os_platform"), None, c.ids_unique,
                                             c.keys, c.on_error),
    }
    names = tuple(_BUILD)

    def __init__(self, raw: DataFrame, ids_unique: bool = False, keys: str = "dense", on_error: str = "fail",
                 key_maps: str | None = None):
        """``keys``: ``dense`` surrogate keys (looked up by joins) or ``hash``
        keys (computed in place: the fact tables need no dimension join).
        ``on_error``: see ``ERROR_MODES``. ``key_maps``: folder in which dense
        keys are kept, so that they outlive a rebuild."""
        _strict(on_error)
        if keys not in KEY_MODES:
            raise ValueError(f"keys must be one of {KEY_MODES}")
        self.raw = raw
        self.ids_unique = ids_unique
        self.keys = keys
        self.on_error = on_error
        self.key_maps = key_maps
        self._built: dict[str, DataFrame] = {}

    def _dim(self, name: str) -> DataFrame | None:
        """The dimension a fact builder looks keys up in (none needed for hash keys)."""
        return None if self.keys == "hash" else self[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = conform(self._BUILD[name](self), TABLE_SCHEMAS[name])
        return self._built[name]

    def __contains__(self, name: str) -> bool:
        return name in self._BUILD

    def items(self):
        return [(n, self[n]) for n in self.names]


DIMENSIONS = ("party", "os_platform", "genre", "promotion")


def normalize(raw: DataFrame, ids_unique: bool = False, parallelism: int = 4,
              keys: str = "dense", on_error: str = "fail", key_maps: str | None = None) -> dict[str, DataFrame]:
    """Build all eleven typed tables from the staging frame.

    The staging frame should be Parquet-backed (see
    :func:`stocktake.sources.csv_stage.stage_to_parquet`): it is read by
    several builders, each pruned to its columns. The four keyed dimensions
    are independent, so their (eager, checkpointed) key jobs are submitted
    concurrently and share the cluster.
    """
    cat = Catalog(raw, ids_unique, keys, on_error, key_maps)
    checkpoint_dir(raw.sparkSession)  # resolve once, before any concurrent job
    if parallelism > 1:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            list(pool.map(cat.__getitem__, DIMENSIONS))
    return dict(cat.items())
