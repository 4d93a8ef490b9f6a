"""Column-level cleaning and conversion helpers (``Column -> Column``).

All of these are compositions of Spark built-ins, so they stay inside
whole-stage codegen and push no work to Python. Semantics follow the source
listing's conventions: text flags are true only for the exact text ``'t'``,
blank text means missing, numbers are cast strictly (ANSI), and list-like text
comes in two dialects (JSON-ish with quotes, or bare comma lists).
"""

from __future__ import annotations

import decimal
from collections.abc import Callable

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- blanks and flags -------------------------------------------------------

def blank_to_null(col) -> Column:
    """``NULLIF(x, '')``: the empty string becomes NULL (padding is kept)."""
    return F.nullif(_c(col), F.lit(""))


def non_blank(col) -> Column:
    """Not NULL and not empty after trimming spaces."""
    c = _c(col)
    return c.isNotNull() & (F.trim(c) != F.lit(""))


def text_flag(col, true_text: str = "t") -> Column:
    """Text flag to boolean: only the exact text ``'t'`` is true.

    NULL, ``''``, ``'T'``, ``'true'`` and ``'t '`` are all false, never NULL.
    """
    return F.coalesce(_c(col) == F.lit(true_text), F.lit(False))


def trimmed_text_flag(col, true_text: str = "t") -> Column:
    """Like :func:`text_flag`, but spaces around the text are ignored."""
    return F.coalesce(F.trim(_c(col)) == F.lit(true_text), F.lit(False))


# --- numbers and dates --------------------------------------------------------

# Amounts are stored with 38 digits, 18 of them fractional. What does not fit keeps its
# digits as text beside (:func:`exact_digits`), so no amount is refused or lost.
AMOUNT_PRECISION, AMOUNT_SCALE = 38, 18
AMOUNT = T.DecimalType(AMOUNT_PRECISION, AMOUNT_SCALE)

_NUMBER = r"^\s*([+-]?)(\d*)(?:\.(\d*))?(?:[eE]([+-]?\d{1,5}))?\s*$"
_SOME_DIGIT = r"^\s*[+-]?(\d|\.\d)"


def _strict_cast(c: Column, kind: T.DataType, what: str, strict: bool = True) -> Column:
    """Cast that fails on bad text whatever the session's ANSI setting, or gives NULL."""
    value = c.try_cast(kind)
    if not strict:
        return value
    return F.when(c.isNotNull() & value.isNull(),
                  F.raise_error(F.concat(F.lit(f"not {what}: "), c.cast("string")))).otherwise(value)


def to_int(col, strict: bool = True) -> Column:
    """Text-to-integer cast; surrounding spaces are allowed, ``'12.0'`` fails (or gives NULL)."""
    return _strict_cast(_c(col), T.IntegerType(), "an integer", strict)


def blank_int(col, strict: bool = True) -> Column:
    """``NULLIF(x, '')::INTEGER``."""
    return to_int(blank_to_null(col), strict)


def is_number(col) -> Column:
    """Decimal text, with an exponent of at most five digits or without; NULL for NULL."""
    c = _c(col)
    return c.rlike(_NUMBER) & c.rlike(_SOME_DIGIT)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value evaluated once, for the rare text that needs it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def canonical_number(col) -> Column:
    """One text per number: no plus sign, exponent or outer zeros (``'+1.50e1'`` is ``'15'``).

    Equal numbers have equal texts, whatever their number of digits. Text that
    is no number gives NULL.
    """
    c = _c(col)
    part = lambda i, name: F.regexp_extract(c, _NUMBER, i).alias(name)
    zeros = lambda k: F.repeat(F.lit("0"), F.greatest(k, F.lit(0)))

    def shifted(t: Column) -> Column:
        """Digits before and after the point, once it has moved by the exponent."""
        point = F.length(t["w"]) + F.coalesce(F.nullif(t["e"], F.lit("")).cast("int"), F.lit(0))
        digits = F.concat(t["w"], t["f"])
        return _let(F.struct(t["s"].alias("s"), digits.alias("d"), point.alias("p"), F.length(digits).alias("n")), lambda x: F.struct(
            x["s"].alias("s"),
            F.ltrim(F.concat(F.substring(x["d"], F.lit(1), F.greatest(x["p"], F.lit(0))), zeros(x["p"] - x["n"])), F.lit("0")).alias("before"),
            F.rtrim(F.concat(zeros(-x["p"]), F.substring(x["d"], F.greatest(x["p"], F.lit(0)) + 1, x["n"])), F.lit("0")).alias("after")))

    def joined(x: Column) -> Column:
        minus = (x["s"] == "-") & (F.concat(x["before"], x["after"]) != "")
        return F.concat(F.when(minus, "-").otherwise(""), F.when(x["before"] == "", "0").otherwise(x["before"]),
                        F.when(x["after"] != "", F.concat(F.lit("."), x["after"])).otherwise(""))

    parts = F.struct(part(1, "s"), part(2, "w"), part(3, "f"), part(4, "e"))
    return F.when(is_number(c), _let(_let(parts, shifted), joined))


def _fits(c: Column, precision: int, scale: int) -> Column:
    """Plain digits that the type holds as they are: the usual case, decided by one pattern."""
    return c.rlike(r"^ *[+-]?\d{1,%d}(\.\d{0,%d})? *$" % (precision - scale, scale))


def _number(digits: int, precision: int, scale: int) -> Column:
    """The literal digits / 10**scale. (Negating 38 digits in Spark rounds them to 34.)"""
    return F.lit(str(decimal.Decimal(digits).scaleb(-scale, decimal.Context(prec=precision)))).cast(T.DecimalType(precision, scale))


def amount_limits(precision: int = AMOUNT_PRECISION, scale: int = AMOUNT_SCALE) -> tuple[Column, Column]:
    """The smallest and largest number of the type; they also stand for what lies beyond."""
    return _number(1 - 10 ** precision, precision, scale), _number(10 ** precision - 1, precision, scale)


def exact_digits(col, precision: int = AMOUNT_PRECISION, scale: int = AMOUNT_SCALE) -> Column:
    """Canonical text of a number that the stored type cannot hold exactly; else NULL."""
    c = blank_to_null(col)
    beyond = r"^-?\d{%d}|\.\d{%d}" % (precision - scale + 1, scale + 1)
    return F.when(~_fits(c, precision, scale) & is_number(c), _let(canonical_number(c), lambda t: F.when(t.rlike(beyond), t)))


def loses_digits(col, precision: int = AMOUNT_PRECISION, scale: int = AMOUNT_SCALE) -> Column:
    """True where numeric text has digits that the stored type cannot hold."""
    return exact_digits(col, precision, scale).isNotNull()


def blank_decimal(col, precision: int = AMOUNT_PRECISION, scale: int = AMOUNT_SCALE, strict: bool = True) -> Column:
    """``NULLIF(x, '')::NUMERIC`` with a declared precision and scale.

    A number with more digits gets the nearest value of the type that keeps its
    sign: never 0 unless it is 0, and at most the largest; :func:`exact_digits`
    has its digits. So comparisons with 0 and the order of amounts hold. Text that
    is no number fails, or gives NULL if not ``strict``.
    """
    c = blank_to_null(col)
    kind = T.DecimalType(precision, scale)
    (low, high), one = amount_limits(precision, scale), _number(1, precision, scale)
    near = c.try_cast(kind)
    value = F.when(_fits(c, precision, scale), near).when(
        is_number(c), F.when(~c.rlike("^[^eE]*[1-9]"), F.lit(0).cast(kind))
        .when(c.rlike(r"^\s*-"), F.least(F.coalesce(near, low), _number(-1, precision, scale)))
        .otherwise(F.greatest(F.coalesce(near, high), one)))
    if strict:
        value = value.when(c.isNotNull(), F.raise_error(F.concat(F.lit("not a number: "), c)))
    return value.cast(kind)


def guarded_text(col, sentinels: tuple[str, ...] = ("TRUE", "FALSE")) -> Column:
    """Text without the boolean words (any case), which become NULL."""
    c = _c(col)
    return F.when(~F.coalesce(F.upper(c).isin(*sentinels), F.lit(False)), c)


def guarded_decimal(col, precision: int = AMOUNT_PRECISION, scale: int = AMOUNT_SCALE,
                    sentinels: tuple[str, ...] = ("TRUE", "FALSE"), strict: bool = True) -> Column:
    """Numeric text that may hold boolean words: those (any case) become NULL.

    The guard sits in front of the strict cast, so ``'FALSE'`` never reaches it.
    """
    return blank_decimal(guarded_text(col, sentinels), precision, scale, strict)


def in_range(col) -> Column:
    """An amount for sums: fails on one that stands for a number beyond the type."""
    c = _c(col)
    low, high = amount_limits()
    return F.when((c > low) & (c < high), c).when(
        c.isNotNull(), F.raise_error(F.lit("an amount beyond 20 digits cannot be summed; see the column of exact digits")))


def free_title(base: Column, final: Column, amount: Column, flag) -> Column:
    """Free when all three amounts are zero, else when the flag text says so."""
    zero = (base == 0) & (final == 0) & (amount == 0)
    return F.coalesce(zero, F.lit(False)) | text_flag(flag)


def discounted(percentage: Column, flag) -> Column:
    """Discounted by a positive percentage, else when the padded flag text says so."""
    return F.coalesce(percentage > 0, F.lit(False)) | trimmed_text_flag(flag)


#: Seconds from 1970 that a timestamp can hold, rounded down.
MAX_EPOCH = 9_000_000_000_000


def epoch_seconds(col) -> Column:
    """Epoch-seconds text as bigint; NULL if blank, no integer or beyond a timestamp."""
    secs = blank_to_null(col).try_cast("bigint")
    return F.when(secs.between(-MAX_EPOCH, MAX_EPOCH), secs)


def epoch_seconds_to_timestamp(col, strict: bool = True) -> Column:
    """Epoch-seconds text to ``timestamp_ntz``; NULL or ``''`` gives NULL.

    Computed as epoch + interval so the result does not depend on the session
    time zone (the source stores the UTC wall clock). Bad text fails, or gives NULL.
    """
    secs = epoch_seconds(col)
    if strict:
        text = blank_to_null(col)
        secs = F.when(text.isNotNull() & secs.isNull(), F.raise_error(F.concat(F.lit("not an epoch in seconds: "), text))).otherwise(secs)
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    days = F.floor(secs / 86400).cast("int")
    return epoch + F.make_dt_interval(days, F.lit(0), F.lit(0), F.pmod(secs, F.lit(86400)).cast("decimal(18,6)"))


# --- list-like text -----------------------------------------------------------

def pylist_to_json(col) -> Column:
    """Normalise a Python-style list literal to JSON.

    Trim, turn single quotes into double quotes, then collapse doubled double
    quotes: ``['a', 'b']`` -> ``["a", "b"]``.
    """
    c = F.trim(_c(col))
    c = F.replace(c, F.lit("'"), F.lit('"'))
    return F.replace(c, F.lit('""'), F.lit('"'))


def json_list_items(col, strict: bool = True) -> Column:
    """Parse list-like text into ``array<string>`` via JSON.

    ``strict`` raises on malformed text (FAILFAST), text after the list included,
    instead of giving NULL. Numbers inside the list come back as text. Empty
    text gives NULL.
    """
    # In brackets of its own, the text must be exactly one JSON value.
    text = F.concat(F.lit("["), pylist_to_json(col), F.lit("]"))
    lists = F.from_json(text, T.ArrayType(T.ArrayType(T.StringType())), {"mode": "FAILFAST" if strict else "PERMISSIVE"})
    more = F.size(lists) > 1
    if strict:
        return F.when(more, F.raise_error(F.concat(F.lit("not one list: "), text))).otherwise(F.get(lists, F.lit(0)))
    return F.when(~more, F.get(lists, F.lit(0)))


def strip_list_brackets(col) -> Column:
    """Remove ``[``, ``]`` and single quotes anywhere in the trimmed text.

    Double quotes are left in place.
    """
    c = F.trim(_c(col))
    for ch in ("[", "]", "'"):
        c = F.replace(c, F.lit(ch), F.lit(""))
    return c


def text_list_items(col) -> Column:
    """Split bare list text on a comma plus optional whitespace.

    Inner and trailing empties are kept as ``''``; ``''`` gives one empty item
    and NULL gives NULL (no rows once exploded).
    """
    return F.split(strip_list_brackets(col), r",\s*")


def fold_name(col) -> Column:
    """Case-fold then trim: the normal form used to match list items to names."""
    return F.trim(F.lower(_c(col)))


# --- missing text -------------------------------------------------------------

# Placeholder words that mean "no value" in free-text URL fields.
MISSING_TEXT_WORDS = ("n/a", "none", "tbd")


def is_missing_text(col, words: tuple[str, ...] = MISSING_TEXT_WORDS) -> Column:
    """NULL, blank after trimming, or a placeholder word (any case, trimmed)."""
    c = _c(col)
    return (c.isNull() | (F.trim(c) == F.lit(""))
            | F.lower(F.trim(c)).isin(*words))


# --- text that a conversion refuses ---------------------------------------------

#: What each kind of conversion expects, for messages. Empty text is no value, but for a filled integer.
REASONS = {"integer": "not an integer", "filled integer": "not an integer", "epoch": "not an epoch in seconds", "amount": "not a number", "list": "not one list"}


def rejected(col, kind: str) -> Column:
    """True where the conversion of ``kind`` (see ``REASONS``) refuses the text."""
    c = _c(col)
    if kind == "list":
        return F.coalesce(non_blank(c) & json_list_items(c, strict=False).isNull(), F.lit(False))
    text = c if kind == "filled integer" else blank_to_null(c)
    good = {"integer": lambda: text.try_cast("int").isNotNull(), "filled integer": lambda: text.try_cast("int").isNotNull(), "epoch": lambda: epoch_seconds(c).isNotNull(),
            "amount": lambda: is_number(text)}[kind]()
    return F.coalesce(text.isNotNull() & ~good, F.lit(False))
