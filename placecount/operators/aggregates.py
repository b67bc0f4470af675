"""Counts, totals and congestion reports: one partial/final hash aggregation each."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placecount.functions.bands import ALL_DAY, band_of
from placecount.functions.expressions import peak_code, peak_day
from placecount.operators.filters import select_obs


def count_by(df: DataFrame, key: str) -> DataFrame:
    """Rows per value, most first. Null is a group of its own."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc_nulls_first(key))
    )


def avg_by_condition(df: DataFrame) -> DataFrame:
    """Mean count and mean incidents by condition. ``normalise`` has taken missing
    numbers as 0; what it could not read is in no mean."""
    return (
        df.groupBy("condition")
        .agg(F.avg("v").alias("avg_v"), F.avg("incidents").alias("avg_incidents"))
        .orderBy("condition")
    )


def band_totals(df: DataFrame) -> DataFrame:
    """Rows and total count by place and band of the day; no hour, no band."""
    return df.groupBy("place", band_of(F.col("hour")).alias("band")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("total_v")
    )


def daily(
    df: DataFrame,
    place: str | None = None,
    lo: date | str | None = None,
    hi: date | str | None = None,
    band: str = ALL_DAY,
) -> DataFrame:
    """Total count per date: in date order for one place, in no order for each.

    With all places the result can be nearly as long as the input, and sorting it
    would be a second full shuffle.
    """
    rows, total = select_obs(df, place, lo, hi, band), F.sum("v").alias("total_v")
    if place is None:
        return rows.groupBy("place", "obs_date").agg(total)
    return rows.groupBy("obs_date").agg(total).orderBy("obs_date")


def _figures() -> list[Column]:
    return [
        F.count("v").alias("n"),
        F.sum("v").alias("total_v"),
        F.avg("v").alias("avg_v"),
        F.max("v").alias("max_v"),
        F.min("v").alias("min_v"),
        F.sum("incidents").alias("total_incidents"),
    ]


def report(
    df: DataFrame,
    place: str | None = None,
    lo: date | str | None = None,
    hi: date | str | None = None,
    band: str = ALL_DAY,
    by: tuple[str, ...] = ("place",),
) -> DataFrame:
    """Congestion figures per place. ``n`` counts the rows that have a count.

    ``by=()`` gives one row over everything selected, even if that is nothing.
    """
    return select_obs(df, place, lo, hi, band).groupBy(*by).agg(*_figures())


def report_with_peak(
    df: DataFrame,
    place: str | None = None,
    lo: date | str | None = None,
    hi: date | str | None = None,
    band: str = ALL_DAY,
) -> DataFrame:
    """``report`` per place plus date, slot and count of its peak, in one scan.

    The slot is text, which makes this a sort aggregate: about three times the
    work of ``report`` per row, but combined per place before the one shuffle.
    """
    # Smallest is the largest code, then the earliest slot. ``~`` cannot overflow.
    code = peak_code(F.col("v"), F.col("obs_date"))
    first = F.min(F.when(code.isNotNull(), F.struct(F.bitwise_not(code).alias("code"), "slot")))
    return (
        select_obs(df, place, lo, hi, band)
        .groupBy("place")
        .agg(*_figures(), first.alias("first"))
        .withColumns(
            {
                "peak_date": peak_day(F.bitwise_not("first.code")),
                "peak_slot": F.col("first.slot"),
                "peak_v": F.col("max_v"),
            }
        )
        .drop("first")
    )
