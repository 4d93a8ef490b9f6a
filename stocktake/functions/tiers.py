"""Labelled buckets used by the reports (searched ``CASE`` -> ``when`` chains).

First matching rule wins; rule order is part of the semantics (a negative age
falls in the first ``<= 12`` tier, a NULL date is "modern" in the two-way split
but "unknown" in the three-way one).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F

from .clean import _c, is_missing_text

# Report labels and cut-offs that must match the source reports.
CLASSIC_CUTOFF = _dt.date(2010, 1, 1)
CLASSIC_LABEL = "Classic (Pre-2010)"
MODERN_LABEL = "Modern (2010+)"

NEW_RELEASE_CUTOFF = _dt.date(2023, 6, 1)
NEW_RELEASE_LABEL = "New Release (Last 2 Years)"
BACK_CATALOG_LABEL = "Back Catalog"
UNKNOWN_DATE_LABEL = "Unknown/Unlisted Date"

AGE_TIER_LABELS = (
    "0 (No Restriction/Unknown)",
    "1-12 (Child/Pre-Teen)",
    "13-16 (Teen)",
    "17+ (Mature Audience)",
    "N/A",
)

MOVIE_LABEL = "Movie Content"
TYPE_GROUP_LABELS = {
    "Bundle": "Bundle (Package)",
    "DLC": "DLC/Add-on Content",
    "Game": "Full Game Title",
}
OTHER_CONTENT_LABEL = "Other/Unknown Content"

FREE_LABEL = "Free-to-Play (F2P)"
PAID_LABEL = "Paid/Premium Title"
UNKNOWN_PRICE_LABEL = "Unknown/Unlisted Price"

SUPPORT_PRESENT_LABEL = "Dedicated Support URL Present"
SUPPORT_MISSING_LABEL = "Support URL Missing/Not Provided"

PRODUCT_TYPES = ((1, "Game"), (2, "Bundle"), (3, "DLC"))


def _date_lit(d: _dt.date) -> Column:
    # A DATE literal compared with a timestamp_ntz means midnight of that day.
    return F.lit(d.isoformat()).cast("date").cast("timestamp_ntz")


def cutoff_two_way(ts, cutoff: _dt.date = CLASSIC_CUTOFF, before: str = CLASSIC_LABEL,
                   otherwise: str = MODERN_LABEL) -> Column:
    """``before`` when strictly earlier than ``cutoff``, else ``otherwise`` (NULL too)."""
    return F.when(_c(ts) < _date_lit(cutoff), F.lit(before)).otherwise(F.lit(otherwise))


def cutoff_three_way(ts, cutoff: _dt.date = NEW_RELEASE_CUTOFF,
                     on_or_after: str = NEW_RELEASE_LABEL, before: str = BACK_CATALOG_LABEL,
                     unknown: str = UNKNOWN_DATE_LABEL) -> Column:
    """Split on a cut-off with NULL dates in their own bucket."""
    c = _c(ts)
    return (F.when(c >= _date_lit(cutoff), F.lit(on_or_after))
            .when(c < _date_lit(cutoff), F.lit(before))
            .otherwise(F.lit(unknown)))


def age_tier(age, labels: tuple[str, ...] = AGE_TIER_LABELS) -> Column:
    """0 | <=12 (negatives too) | 13-16 | >=17 | N/A (only reachable for NULL)."""
    c = _c(age)
    return (F.when(c == 0, F.lit(labels[0]))
            .when(c <= 12, F.lit(labels[1]))
            .when(c.between(13, 16), F.lit(labels[2]))
            .when(c >= 17, F.lit(labels[3]))
            .otherwise(F.lit(labels[4])))


def content_group(is_movie, type_name, movie_label: str = MOVIE_LABEL,
                  type_labels: dict[str, str] | None = None,
                  other: str = OTHER_CONTENT_LABEL) -> Column:
    """Movie first, then the product type's label, else "other"."""
    labels = TYPE_GROUP_LABELS if type_labels is None else type_labels
    expr = F.when(_c(is_movie) == F.lit(True), F.lit(movie_label))
    for name, label in labels.items():
        expr = expr.when(_c(type_name) == F.lit(name), F.lit(label))
    return expr.otherwise(F.lit(other))


def bool_label(flag, true_label: str = FREE_LABEL, false_label: str = PAID_LABEL,
               unknown: str = UNKNOWN_PRICE_LABEL) -> Column:
    """Three-way label of a nullable boolean."""
    c = _c(flag)
    return (F.when(c == F.lit(True), F.lit(true_label))
            .when(c == F.lit(False), F.lit(false_label))
            .otherwise(F.lit(unknown)))


def support_status(url, present: str = SUPPORT_PRESENT_LABEL,
                   missing: str = SUPPORT_MISSING_LABEL) -> Column:
    """Missing (NULL, blank or placeholder word) versus present."""
    return F.when(is_missing_text(url), F.lit(missing)).otherwise(F.lit(present))
