"""Slot profiles, series, comparisons and trends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placecount.functions.expressions import day_order
from placecount.operators.filters import valid_rows, where_place
from placecount.operators.latest import latest_by_slot


def slot_profile(df: DataFrame, relative: bool = False) -> DataFrame:
    """Mean over places of their latest count in each slot.

    ``relative`` adds the share of the busiest slot. There the profile has one
    row per slot of the day, and is the input of a single-row scalar subquery.
    """
    profile = latest_by_slot(df).groupBy("slot").agg(F.avg("v").alias("avg_v"))
    if relative:
        busiest = profile.agg(F.max("avg_v")).scalar()
        profile = profile.withColumn("load", F.try_divide("avg_v", busiest))
    return profile.orderBy("slot")


def series(df: DataFrame, place: str) -> DataFrame:
    """One place's latest count per slot; slots it lacks are left out."""
    return latest_by_slot(where_place(df, place)).select("slot", "v").orderBy("slot")


def compare(df: DataFrame, a: str, b: str) -> DataFrame:
    """Two places side by side over the slots at least one of them has.

    The filter on place runs before the aggregation. Unless both places are
    known the result is empty.
    """
    rows = valid_rows(where_place(df, a, b), need_slot=True)
    sides = latest_by_slot(rows).groupBy("slot").agg(
        F.max(F.when(F.col("place") == a, F.col("v"))).alias("v_a"),
        F.max(F.when(F.col("place") == b, F.col("v"))).alias("v_b"),
    )
    known = rows.agg(
        F.bool_or(F.col("place") == a) & F.bool_or(F.col("place") == b)
    ).scalar()
    return sides.filter(known).orderBy("slot")


def trend(df: DataFrame) -> DataFrame:
    """Percent change of each place from the first slot of all to the last.

    The end slots are global and come from all rows, as ``slots`` does. Only
    places that have both, and a positive first count, are reported. The scan
    keeps just the rows of those two slots.
    """
    ends = df.agg(F.struct(F.min("slot").alias("first"), F.max("slot").alias("last")))
    at_first, at_last = F.col("slot") == F.col("ends.first"), F.col("slot") == F.col("ends.last")

    def count_when(here):
        return F.max_by("v", F.when(here, day_order()))

    return (
        valid_rows(df, need_slot=True)
        .withColumn("ends", ends.scalar())
        .filter((F.col("ends.first") != F.col("ends.last")) & (at_first | at_last))
        .groupBy("place")
        .agg(
            count_when(at_first).alias("first_v"),
            count_when(at_last).alias("last_v"),
        )
        .filter((F.col("first_v") > 0) & F.col("last_v").isNotNull())
        .select(
            "place",
            "first_v",
            "last_v",
            (
                (F.col("last_v").cast("bigint") - F.col("first_v"))
                / F.col("first_v").cast("double")
                * 100
            ).alias("pct_change"),
        )
    )
