"""Distinct lists, row listings and peaks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placecount.functions.bands import ALL_DAY
from placecount.operators.filters import select_obs


def places(df: DataFrame) -> DataFrame:
    """Distinct place names that are not blank, ascending."""
    return (
        df.select("place").filter(F.trim("place") != "").distinct().orderBy("place")
    )


def conditions(df: DataFrame) -> DataFrame:
    return df.select("condition").distinct().orderBy("condition")


def slots(df: DataFrame) -> DataFrame:
    """Distinct slots of all rows, also of those ``valid_rows`` would reject."""
    return df.select("slot").dropna().distinct().orderBy("slot")


def dates(df: DataFrame) -> DataFrame:
    return df.select("obs_date").dropna().distinct().orderBy("obs_date")


def detail(
    df: DataFrame,
    place: str | None = None,
    lo: date | str | None = None,
    hi: date | str | None = None,
    band: str = ALL_DAY,
) -> DataFrame:
    """Rows in time order. The sort ends in ``seq``: the order is total, and
    the range partitioner can split a slot that holds very many rows."""
    shown = ["obs_date", "slot", "v", "weather", "condition"]
    if place is None:
        shown = ["place", *shown]
    return (
        select_obs(df, place, lo, hi, band)
        .orderBy("obs_date", "slot", "place", "seq")
        .select(*[c for c in shown if c in df.columns])
    )


def peak(
    df: DataFrame,
    place: str | None = None,
    lo: date | str | None = None,
    hi: date | str | None = None,
    band: str = ALL_DAY,
) -> DataFrame:
    """The one row with the highest count; the earliest of equals."""
    return (
        select_obs(df, place, lo, hi, band)
        .orderBy(F.desc_nulls_last("v"), "obs_date", "slot", "place", "seq")
        .limit(1)
        .select("place", "obs_date", "slot", "v")
    )
