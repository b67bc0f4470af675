"""Text forms of numbers and dates. The display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def short_date(day: Column) -> Column:
    return F.date_format(day, "MMM dd")


def grouped_number(n: Column) -> Column:
    return F.format_string("%,d", n)


def one_decimal(x: Column) -> Column:
    return F.format_string("%.1f", x)


def two_decimals(x: Column) -> Column:
    return F.format_string("%.2f", x)


def no_decimals(x: Column) -> Column:
    return F.format_string("%.0f", x)


def clock_hour(hour: Column) -> Column:
    return F.format_string("%d:00", hour)


def timestamp_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
