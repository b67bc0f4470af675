"""Column resolution, argument checks and row predicates."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placecount.functions.bands import ALL_DAY, in_band

LOOKBACK_DAYS = 30


def resolve(columns: Iterable[str], name: str) -> str | None:
    """First column equal to ``name`` ignoring case, or None."""
    return next((c for c in columns if c.lower() == name.lower()), None)


def require(df: DataFrame, *columns: str) -> DataFrame:
    missing = [c for c in columns if resolve(df.columns, c) is None]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def where_place(df: DataFrame, *places: str) -> DataFrame:
    if not places or any(p is None or p == "" for p in places):
        raise ValueError("a place is required")
    return df.filter(F.col("place").isin(*places))


def where_dates(df: DataFrame, lo: date | str, hi: date | str) -> DataFrame:
    """Both ends inclusive."""
    if lo is None or hi is None:
        raise ValueError("a start date and an end date are required")
    return df.filter(
        F.col("obs_date").between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
    )


def where_band(df: DataFrame, band: str = ALL_DAY) -> DataFrame:
    return df.filter(in_band(F.col("hour"), band))


def last_n_days(
    df: DataFrame, n: int = LOOKBACK_DAYS, today: date | str | None = None
) -> DataFrame:
    end = F.current_date() if today is None else F.lit(today).cast("date")
    return df.filter(F.col("obs_date").between(F.date_sub(end, n), end))


def select_obs(
    df: DataFrame,
    place: str | None = None,
    lo: date | str | None = None,
    hi: date | str | None = None,
    band: str = ALL_DAY,
) -> DataFrame:
    """The filters of one analysis. What is not given is not filtered."""
    if place is not None:
        df = where_place(df, place)
    if (lo is None) != (hi is None):
        raise ValueError("give both ends of the period or neither")
    if lo is not None:
        df = where_dates(df, lo, hi)
    return where_band(df, band)


def valid_rows(df: DataFrame, need_slot: bool = False) -> DataFrame:
    """Rows with a place and a whole-number count (and a slot, if needed), from a line that
    fits its header where the reader tells."""
    ok = F.col("place").isNotNull() & F.col("v").isNotNull()
    if need_slot:
        ok &= F.col("slot").isNotNull()
    if "broken" in df.columns:
        ok &= F.col("broken").isNull()
    return df.filter(ok)


def quarantine(df: DataFrame, need_slot: bool = False) -> DataFrame:
    """The rows ``valid_rows`` leaves out, with the reason, and those it keeps that no
    date filter finds or whose incidents could not be read. A broken line is nothing else."""
    broken = F.col("broken") if "broken" in df.columns else F.lit(None).cast("string")
    reason = F.when(broken.isNotNull(), broken).when(F.col("place").isNull(), "no place").when(F.col("v").isNull(), "no whole-number count")
    if need_slot:
        reason = reason.when(F.col("slot").isNull(), "no slot")
    reason = reason.when(F.col("obs_date").isNull(), "no date")
    if "incidents" in df.columns:
        reason = reason.when(F.col("incidents").isNull(), "unreadable incidents")
    return df.withColumn("reason", reason).filter(F.col("reason").isNotNull())
