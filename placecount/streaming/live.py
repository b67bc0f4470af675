"""The same analytics over a stream of observations.

Each function returns a streaming frame, so the caller chooses sink, trigger and
checkpoint. ``run_available`` (append mode), ``run_latest`` and ``run_totals`` drain what
is there now into shared storage, for scheduled incremental runs; see ``ledger``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placecount.functions.expressions import event_order, slot_instant, utc_day
from placecount.operators.filters import valid_rows
from placecount.operators.models import ConditionModel, CountModel, predict_condition
from placecount.session import shared_dir
from placecount.streaming.ledger import LATENESS, drain_totals, newest_rows


def with_event_time(obs: DataFrame) -> DataFrame:
    """Adds ``event_time``, the start of the slot, to normalised observations."""
    return obs.withColumn("event_time", slot_instant(F.col("obs_date"), F.col("slot_no")))


def windowed_totals(
    stream: DataFrame, grain: str = "1 day", lateness: str = LATENESS
) -> DataFrame:
    """Total count per place and window of ``event_time``. In append mode a window is
    emitted once the watermark has passed its end, in update mode at each change. Rows
    that come after that are dropped; ``ledger.drain_totals`` keeps them."""
    return (
        stream.withWatermark("event_time", lateness)
        .groupBy("place", F.window("event_time", grain).alias("window"))
        .agg(F.sum("v").alias("total_v"), F.count("v").alias("n"))
        .select(
            "place",
            F.col("window.start").alias("start"),
            utc_day(F.col("window.start")).alias("obs_date"),
            "total_v",
            "n",
        )
    )


def latest_stream(stream: DataFrame) -> DataFrame:
    """Latest count per place, for update mode. State is one row per place."""
    return (
        valid_rows(stream).groupBy("place").agg(F.max_by("v", event_order()).alias("v"))
    )


def run_latest(stream: DataFrame, root: str | None = None) -> DataFrame:
    """Drain what is there and return the latest count per place so far."""
    return newest_rows(latest_stream(stream), ["place"], root)


def run_totals(
    stream: DataFrame, grain: str = "1 day", lateness: str = LATENESS, root: str | None = None
) -> DataFrame:
    """Drain what is there and return all totals so far, those of open windows included.
    ``drain_totals`` gives the rows that came too late as well."""
    return drain_totals(stream, grain, lateness, root).rows


def score_stream(
    stream: DataFrame, count_model: CountModel, condition_model: ConditionModel
) -> DataFrame:
    """Predicted count and condition of each arriving request; no state."""
    return predict_condition(count_model, condition_model, stream)


def run_available(frame: DataFrame) -> DataFrame:
    """Drain an append-mode stream into Parquet on shared storage and read it back."""
    root = shared_dir(frame.sparkSession)
    out = f"{root}/out"
    query = (
        frame.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return frame.sparkSession.read.schema(frame.schema).parquet(out)
