"""Lenient date parsing and date parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Layouts tried in turn, after Spark's own ISO parser; a day above 12 decides between the first two.
DATE_LAYOUTS = ["M/d/yyyy", "d/M/yyyy", "d-MMM-yyyy", "MMMM d, yyyy", "MMM d, yyyy", "yyyy/M/d", "yyyyMMdd"]
# What may follow a date.
TIME_LAYOUTS = ["H:mm:ss", "H:mm", "h:mm:ss a", "h:mm a"]


def lenient_timestamp(c: Column) -> Column:
    """Timestamp without zone; text that is no date becomes NULL."""
    text = F.trim(c.cast("string"))
    iso = text.try_cast("timestamp_ntz")
    # a bare year or a short number is not a date
    iso = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), iso)
    timed = text.rlike(r"\d:\d\d")
    plain = [F.try_to_timestamp(text, F.lit(p)).cast("timestamp_ntz") for p in DATE_LAYOUTS]
    with_time = [F.try_to_timestamp(text, F.lit(f"{p} {t}")).cast("timestamp_ntz") for p in DATE_LAYOUTS for t in TIME_LAYOUTS]
    return F.coalesce(iso, F.when(timed, F.coalesce(*with_time)).otherwise(F.coalesce(*plain)))


def lenient_date(c: Column) -> Column:
    return lenient_timestamp(c).cast("date")


def date_key(c: Column) -> Column:
    """yyyymmdd as a number."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def month_label(c: Column) -> Column:
    """Month name, blank-padded to nine characters; the padding is part of the value."""
    return F.rpad(F.date_format(c, "MMMM"), 9, " ")
