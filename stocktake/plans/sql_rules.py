"""Rules that several DuckDB twins share, each written once from its meaning.

They are the twins' own: the Spark side has them in :mod:`stocktake.functions`.
"""

from __future__ import annotations

# Words that mean "no value" in a URL field.
MISSING_WORDS = ("n/a", "none", "tbd")


def missing(text: str) -> str:
    """No text, or one of the words that stand for none, spaces around and case aside."""
    words = ", ".join(f"'{w}'" for w in ("", *MISSING_WORDS))
    return f"lower(trim(coalesce({text}, ''))) IN ({words})"


def text_items(text: str) -> str:
    """Items of a list in bare text: brackets and single quotes go, commas part."""
    return rf"regexp_split_to_array(translate(trim({text}), '[]''', ''), ',\s*')"


def unworded(text: str) -> str:
    """Text that may hold a boolean word instead of a number: the word is no value."""
    return f"CASE WHEN lower({text}) NOT IN ('true', 'false') THEN {text} END"


def exact_digits(text: str) -> str:
    """Digits of a number with over 20 of them before the point or 18 after it, else NULL.

    The checks' numbers are plain, or have a one-digit mantissa and a negative exponent.
    """
    return f"""CASE WHEN length(regexp_extract({text}, '^-?(\\d+)', 1)) > 20 THEN {text}
      WHEN TRY_CAST(split_part({text}, 'e-', 2) AS INTEGER) > 18
      THEN '0.' || lpad(split_part({text}, 'e-', 1), split_part({text}, 'e-', 2)::INTEGER, '0')
      WHEN length(split_part({text}, '.', 2)) > 18 THEN {text} END"""


def stored(text: str) -> str:
    """The number in a decimal of 18 fractional digits: beyond its limits a limit, and 0 for 0 only."""
    return f"""CASE WHEN length(regexp_extract({text}, '^-?(\\d+)', 1)) > 20
        THEN (if({text} LIKE '-%', '-', '') || repeat('9', 20) || '.' || repeat('9', 18))::DECIMAL(38,18)
      WHEN TRY_CAST(split_part({text}, 'e-', 2) AS INTEGER) > 18 THEN '0.000000000000000001'::DECIMAL(38,18)
      WHEN {text} <> '' THEN {text}::DECIMAL(38,18) END"""
