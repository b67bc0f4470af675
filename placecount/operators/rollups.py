"""Coarser views over time: weeks, months, conditions by date, place by slot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placecount.operators.latest import latest_by_slot

GRAINS = ("day", "week", "month", "quarter", "year")


def rollup(df: DataFrame, grain: str = "week") -> DataFrame:
    """Total and mean count per place and period; weeks start on Monday."""
    if grain not in GRAINS:
        raise ValueError(f"grain is one of {', '.join(GRAINS)}")
    period = F.date_trunc(grain, F.col("obs_date")).cast("date")
    return df.groupBy("place", period.alias("period")).agg(
        F.count("v").alias("n"),
        F.sum("v").alias("total_v"),
        F.avg("v").alias("avg_v"),
    )


def condition_trend(df: DataFrame) -> DataFrame:
    """Rows per date and condition."""
    return (
        df.groupBy("obs_date", "condition")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("obs_date", "condition")
    )


def heatmap(df: DataFrame, slots: list[str] | None = None) -> DataFrame:
    """Latest count by place and slot: long, or one column per slot given.

    Naming the slots keeps the pivot to a single pass; without them Spark would
    first have to collect the distinct ones.
    """
    cells = latest_by_slot(df)
    if slots is None:
        return cells
    return cells.groupBy("place").pivot("slot", slots).agg(F.first("v"))
