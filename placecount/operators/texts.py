"""Text forms of results, always beside the numbers they come from."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placecount.functions import formats
from placecount.functions.bands import ALL_DAY
from placecount.operators.aggregates import report_with_peak

# The wording of the congestion report and of its peak line.
REPORT_FORMAT = (
    "TRAFFIC CONGESTION REPORT\n"
    "==========================\n"
    "Junction: %s\n"
    "Period: %s to %s\n"
    "Time Range: %s\n\n"
    "Total Records: %d\n"
    "Total Vehicles: %d\n"
    "Average Vehicles: %s\n"
    "Maximum Vehicles: %d\n"
    "Minimum Vehicles: %d\n"
    "Total Accidents: %d\n"
)
PEAK_FORMAT = "Peak Congestion: %s at %s with %d vehicles"


def report_text(
    df: DataFrame,
    lo: date | str,
    hi: date | str,
    band: str = ALL_DAY,
    place: str | None = None,
) -> DataFrame:
    """One report and one peak line per place."""
    figures = report_with_peak(df, place, lo, hi, band)
    report = F.format_string(
        REPORT_FORMAT,
        "place",
        F.lit(str(lo)),
        F.lit(str(hi)),
        F.lit(band),
        "n",
        "total_v",
        F.when(F.col("avg_v").isNotNull(), formats.two_decimals(F.col("avg_v"))),
        "max_v",
        "min_v",
        "total_incidents",
    )
    peak_line = F.when(
        F.col("peak_v").isNotNull(),
        F.format_string(PEAK_FORMAT, F.col("peak_date").cast("string"), "peak_slot", "peak_v"),
    )
    return figures.select("place", report.alias("report"), peak_line.alias("peak"))


def daily_labels(daily_totals: DataFrame) -> DataFrame:
    """Short date label beside the date; labels repeat across years."""
    return daily_totals.withColumn("label", formats.short_date(F.col("obs_date")))


def kpi_labels(key_figures: DataFrame) -> DataFrame:
    return key_figures.withColumns(
        {
            "total_label": formats.grouped_number(F.col("total_v")),
            "avg_label": formats.one_decimal(F.col("avg_v")),
            "top_label": F.coalesce("top_place", F.lit("None")),
        }
    )


def stamped(df: DataFrame) -> DataFrame:
    """When the result was computed; one value per query."""
    return df.withColumn("as_of", formats.timestamp_text(F.current_timestamp()))
