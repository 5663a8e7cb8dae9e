"""Numbers out of messy text.  ``try_cast`` keeps bad input NULL under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _number(c: Column, pattern: str, kind: str) -> Column:
    """First group of the first match as a number; no match casts to NULL."""
    return F.regexp_extract(c, pattern, 1).try_cast(kind)


def extract_number(c: Column) -> Column:
    """First run of digits in a text (``3days`` -> 3); the sign is not read."""
    return _number(c, r"(\d+)", "int")


def truncate_number(c: Column) -> Column:
    """Whole part of a value that already is a number."""
    return c.try_cast("int")


def discount_percent(c: Column) -> Column:
    """``1%``, ``10pct``, ``5percent``, ``10%%`` -> the number in percent."""
    bare = F.regexp_replace(F.lower(c), "[%pctern]+", "")
    return _number(bare, r"(\d+\.?\d*)", "decimal(10,2)")


def legacy_discount(c: Column) -> Column:
    """As ``discount_percent``, but only whole suffix words are removed."""
    bare = F.lower(c)
    for word in ("%", "percent", "pct"):
        bare = F.replace(bare, F.lit(word), F.lit(""))
    return _number(bare, r"([0-9]+(?:\.[0-9]+)?)", "decimal(10,2)")


def first_quantity(c: Column) -> Column:
    return _number(c, r"([0-9]+)", "bigint")


def arrival_days_before_word(c: Column) -> Column:
    """A number counts only when the word ``day`` follows it."""
    return _number(c, r"(\d+)\s*day", "bigint")


def availed_flag(c: Column, variant: str = "ingest") -> Column:
    """1/0 flag out of text.

    ``ingest``     whole numbers stay, yes-words are 1, anything else is 0
    ``transform``  yes-words are 1, ``Not Applicable`` is NULL, anything else 0
    ``direct``     as transform, without the word ``yes``
    ``set_based``  only 1/true and 0/false count, anything else is NULL
    """
    low = F.lower(F.trim(c))
    number = low.try_cast("double").try_cast("int")
    if variant == "ingest":
        flag = F.when(low.isin("true", "yes"), 1).otherwise(F.coalesce(number, F.lit(0)))
    elif variant == "transform":
        flag = F.when(c == "Not Applicable", F.lit(None)).when(low.isin("1", "true", "yes"), 1).otherwise(0)
    elif variant == "direct":
        flag = F.when(c == "Not Applicable", F.lit(None)).when(low.isin("1", "true"), 1).otherwise(0)
    elif variant == "set_based":
        flag = F.when(low.isin("1", "true"), 1).when(low.isin("0", "false"), 0)
    else:
        raise ValueError(f"unknown variant: {variant}")
    return F.when(c.isNotNull(), flag).cast("int")


def to_decimal(c: Column, precision: int = 10, scale: int = 2) -> Column:
    return F.trim(c.cast("string")).try_cast(f"decimal({precision},{scale})")


def to_double(c: Column) -> Column:
    return F.trim(c.cast("string")).try_cast("double")


def first_non_falsy(first: Column, second: Column) -> Column:
    """``first`` unless it is NULL or zero, then ``second``."""
    return F.coalesce(F.nullif(first, F.lit(0)), second)
