"""Latest counts, and the key figures and rankings read off them.

"Latest" is the row that is greatest by (obs_date, slot, seq): in a
chronological file, the last row of the place. Rows without a place or a
whole-number count do not take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placecount.functions.expressions import day_order, event_order
from placecount.operators.filters import valid_rows

TOP_PLACES = 8


def latest(df: DataFrame, order: Column | None = None) -> DataFrame:
    """Latest count per place.

    ``order`` replaces the event order: ``F.col("seq")`` means last in source
    order, which is cheapest where the sequence alone is chronological.
    """
    return (
        valid_rows(df)
        .groupBy("place")
        .agg(F.max_by("v", event_order() if order is None else order).alias("v"))
    )


def latest_by_slot(df: DataFrame, order: Column | None = None) -> DataFrame:
    """Latest count per place and slot, across dates."""
    return (
        valid_rows(df, need_slot=True)
        .groupBy("place", "slot")
        .agg(F.max_by("v", day_order() if order is None else order).alias("v"))
    )


def kpis(latest_counts: DataFrame) -> DataFrame:
    """Total, mean and busiest place (first by name among equals). No places, no row."""
    return (
        latest_counts.agg(
            F.count("place").alias("n_places"),
            F.sum("v").alias("total_v"),
            F.avg("v").alias("avg_v"),
            F.min_by("place", F.struct(F.bitwise_not("v"), "place")).alias("top_place"),
        )
        .filter("n_places > 0")
    )


def top_places(latest_counts: DataFrame, k: int = TOP_PLACES) -> DataFrame:
    return latest_counts.orderBy(F.desc("v"), "place").limit(k).select("place", "v")
