"""Scalar text expressions; every one is a built-in Catalyst expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

DECIMAL_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
UNSIGNED_NUMBER = r"(\d+(?:\.\d+)?)"

# Date layouts accepted besides ISO dates and timestamps.
DATE_FORMATS = [
    "M/d/yyyy[ H:mm[:ss]]",
    "yyyy/M/d[ H:mm[:ss]]",
    "d-MMM-yyyy",
    "MMM d, yyyy",
    "yyyyMMdd",
]

# Texts that stand for "no secondary colour".
NO_MODIFIER = ["no overtone", "none", "n/a"]

_SPLICE = "\ue000 "


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value made once, however often it is used: it is the only element of a list."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def apart(value: Column) -> Column:
    """A struct for a column of its own: Spark writes the fields of a plain struct into each of their uses, where some are made again."""
    return F.element_at(F.array(value), F.lit(1))


def strip(c: Column) -> Column:
    return F.btrim(c.cast("string"), F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def clean_text(c: Column) -> Column:
    """Null becomes "", runs of any white space become one space."""
    return strip(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def title_case(c: Column) -> Column:
    """Capital after every non-letter, as Python's ``str.title``.

    ``initcap`` only starts words after a space, so a marker that ends in a
    space is put before each letter that follows a non-letter, and taken out.
    """
    spliced = F.regexp_replace(c, r"(\P{L})(?=\p{L})", "$1" + _SPLICE)
    return F.replace(F.initcap(spliced), F.lit(_SPLICE), F.lit(""))


def to_number(c: Column) -> Column:
    """Decimal text to double, anything else to null (Java suffixes too)."""
    s = strip(c)
    return F.when(s.rlike(DECIMAL_TEXT), s.try_cast("double"))


def to_percent(c: Column) -> Column:
    return to_number(F.regexp_replace(strip(c), "%$", ""))


def to_date(c: Column) -> Column:
    """Bad text gives null; a time part is dropped."""
    s = strip(c)
    tries = [F.try_to_timestamp(s, F.lit(f)).cast("date") for f in DATE_FORMATS]
    return F.coalesce(s.try_cast("date"), s.try_cast("timestamp").cast("date"), *tries)


def parse_price(c: Column) -> Column:
    """First number after removing thousands commas and dollar signs."""
    digits = F.regexp_extract(F.translate(c, ",$", ""), UNSIGNED_NUMBER, 1)
    return F.nullif(digits, F.lit("")).try_cast("double")


def parse_measurements(c: Column) -> Column:
    """``struct(length_mm, width_mm, depth_mm)``; all null under three numbers."""
    text = F.replace(F.replace(F.lower(c), F.lit("mm"), F.lit("")), F.lit("×"), F.lit("x"))
    numbers = F.regexp_extract_all(text, F.lit(UNSIGNED_NUMBER), F.lit(1))
    three = F.when(F.size(numbers) >= 3, numbers)
    names = ["length_mm", "width_mm", "depth_mm"]
    return F.struct(
        *[F.get(three, F.lit(i)).try_cast("double").alias(n) for i, n in enumerate(names)]
    )


def round_thousandths(c: Column) -> Column:
    """Round to 3 decimals by the exact binary value, ties to even.

    ``bround`` decides ties on the shortest decimal text of a double, which is
    not its value. For values in [1, 1024) the double times 2**52 is a whole
    number that fits a long, so the tie can be decided in whole numbers.
    """
    low = F.floor(c * 1000)
    doubled = (c * float(2**52)).cast("decimal(20,0)") * F.lit(2000).cast("decimal(5,0)")
    tie = (low * 2 + 1).cast("decimal(10,0)") * F.lit(2**52).cast("decimal(17,0)")
    up = (doubled > tie) | ((doubled == tie) & (low % 2 == 1))
    exact = (low + F.when(up, 1).otherwise(0)) / 1000
    return F.when((c >= 1) & (c < 1024), exact).otherwise(F.bround(c, 3))


def l_w_ratio(length: Column, width: Column) -> Column:
    longer = F.greatest(length, width)
    shorter = F.least(length, width)
    usable = (length != 0) & (width != 0)
    # Made once, since rounding reads it many times; the code of a whole listing around it would be too long to be compiled as one.
    return F.when(usable, once(longer / F.nullif(shorter, F.lit(0.0)), round_thousandths))


def clean_modifier(c: Column) -> Column:
    return F.when(F.lower(c).isin(NO_MODIFIER), F.lit("")).otherwise(F.coalesce(c, F.lit("")))


def first_text(*columns: Column) -> Column:
    """First value that is neither null nor empty, else ""."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def first_nonzero(*columns: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit(0.0)) for c in columns])


def slug_from_url(url: Column, fallback_prefix: str = "lb_") -> Column:
    """Text after the last ``/products/``; a hash of the URL where there is none."""
    tail = F.element_at(F.split(url, "/products/"), -1)
    fallback = F.concat(F.lit(fallback_prefix), F.hex(F.xxhash64(url)))
    return F.when(url.contains("/products/"), tail).otherwise(fallback)


def stock_from_url(url: Column, fallback_prefix: str = "bn_") -> Column:
    """First digits of the last path segment; a hash of the URL where there are none."""
    digits = F.regexp_extract(F.element_at(F.split(url, "/"), -1), r"(\d+)", 1)
    fallback = F.concat(F.lit(fallback_prefix), F.hex(F.xxhash64(url)))
    return F.coalesce(F.nullif(digits, F.lit("")), fallback)


def unslug(c: Column) -> Column:
    return F.replace(c, F.lit("-"), F.lit(" "))


def guarded_ratio(a: Column, b: Column, default: float = 0.0) -> Column:
    """``a / b``, or the default where ``b`` is zero or null."""
    return F.coalesce(F.try_divide(a, b), F.lit(float(default)))


def run_id_of(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")
