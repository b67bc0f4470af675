"""Every query of the engine over the given tables, by name.

Each takes (spark, sf_dir) and reads whole tables. ``oracle`` holds the SQL that
must give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placecount import jobs
from placecount.operators import aggregates as agg
from placecount.operators import distribution as dist
from placecount.operators import filters, listing, models, rollups, slots, texts
from placecount.operators import latest as last
from placecount.operators.normalise import normalise
from placecount.plans import tables
from placecount.plans.tables import events, lineitem, orders
from placecount.roles import DATA_COLUMNS, OBS_SCHEMA
from placecount.session import shared_dir
from placecount.sources import export, land, load_report, read_layouts, read_obs, read_stream
from placecount.sources.report import load_counts
from placecount.streaming import ledger, live

Query = Callable[[SparkSession, str], DataFrame]

# The place, period and bands the single-place analyses ask for.
PLACE, OTHER_PLACE = "7", "12"
FROM, TO = "2024-01-05", "2024-01-20"
MORNING, NIGHT = "Morning (6:00-12:00)", "Night (20:00-6:00)"
TODAY = "2024-02-10"
HALF = "2024-01-15"
HOURS = [f"{h:02d}:00" for h in range(24)]


_written: dict[tuple[str, str], str] = {}


def _raw_folder(spark: SparkSession, sf_dir: str) -> str:
    """Events as traffic files in the shared folder, written once for each application."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _written:
        path = shared_dir(spark)
        export(tables.events_as_files(spark, sf_dir), path, fmt="csv", partition_by=None)
        _written[key] = path
    return _written[key]


def _raw_files(spark: SparkSession, sf_dir: str, null_v: str = "zero") -> DataFrame:
    return normalise(read_obs(spark, _raw_folder(spark, sf_dir)), null_v=null_v)


def _raw_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same traffic files as a stream, told apart by their header."""
    names = tables.events_as_files(spark, sf_dir).columns
    text = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return normalise(read_stream(spark, _raw_folder(spark, sf_dir), text, fmt="csv"), null_v="keep")


def _decimal_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as files whose numbers carry a decimal point, dates of signups unreadable
    and incidents of user 12 no number."""
    path = shared_dir(spark)
    kind = F.col("condition")
    rows = events(spark, sf_dir).select(
        F.when(kind == "signup", F.date_format("obs_date", "yyyy-MM-dd 00:00:00"))
        .otherwise(F.col("obs_date").cast("string"))
        .alias("Date"),
        F.col("slot").alias("Time"),
        F.col("place").alias("Junction"),
        F.concat(F.col("v").cast("string"), F.lit(".0")).alias("Vehicles"),
        F.when(F.col("place") == "12", "some")
        .otherwise(F.concat(F.col("incidents").cast("string"), F.lit(".0")))
        .alias("Accidents Reported"),
        kind.alias("Road Condition"),
        "seq",
    )
    export(rows, path, fmt="csv", partition_by=None)
    return normalise(read_obs(spark, path), null_v="keep")


def _sparse_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as files without time, condition, accidents and weather, under names in
    other letter case; the default hour and condition stand in."""
    path = shared_dir(spark)
    rows = events(spark, sf_dir).select(
        F.col("obs_date").cast("string").alias("DATE"),
        F.when(F.col("hour") != 3, F.col("place")).alias("junction"),
        F.col("v").alias("VEHICLES"),
        "seq",
    )
    export(rows, path, fmt="csv", partition_by=None)
    return normalise(read_obs(spark, path), drop_null_place=True)


def _fixed_schema_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as files read under the fixed schema."""
    path = shared_dir(spark)
    rows = events(spark, sf_dir).select(
        F.col("obs_date").cast("string").alias("Date"),
        F.col("slot").alias("Time"),
        F.col("place").alias("Junction"),
        F.col("v").alias("Vehicles"),
        F.col("incidents").alias("Accidents Reported"),
        F.col("weather").alias("Weather"),
        F.col("condition").alias("Road Condition"),
    )
    export(rows, path, fmt="csv", partition_by=None)
    return normalise(read_obs(spark, path, schema=OBS_SCHEMA))


def _write_lines(lines: DataFrame, header: str, path: str) -> None:
    """Lines as they are, below ``header``, more files in the folder ``path``."""
    lines.select(F.col("line").alias(header)).write.mode("append").option("header", True).option("sep", "\x01").option(
        "quote", "\x00"
    ).csv(path)


def _mixed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as one folder of files under three headers. Night hours have all columns, by
    day names are in other order and letter case and there is no weather; hour 12 has
    neither date nor place. Of hour 3 lines lack two fields, of hour 4 they have two more
    if there was an error, and of hour 5 the quote before a purchase never closes."""
    path = shared_dir(spark)
    obs = events(spark, sf_dir)
    hour, kind = F.col("hour"), F.col("condition")
    full = F.concat_ws(",", F.col("obs_date").cast("string"), "slot", F.concat(F.lit('"'), "place", F.lit('"')), "v")
    rest = F.concat_ws(",", "incidents", "weather", "condition", "seq")
    line = (
        F.when(hour == 3, F.concat_ws(",", full, "incidents", "weather"))
        .when((hour == 4) & (kind == "error"), F.concat_ws(",", full, rest, F.lit("x"), F.lit("y")))
        .when((hour == 5) & (kind == "purchase"), F.concat_ws(",", full, "incidents", "weather", F.concat(F.lit('"'), "condition"), "seq"))
        .otherwise(F.concat_ws(",", full, rest))
    )
    header = "Date,Time,Junction,Vehicles,Accidents Reported,Weather,Road Condition,seq"
    _write_lines(obs.where(hour < 6).select(line.alias("line")), header, path)
    day = F.concat_ws(",", "seq", "place", F.col("obs_date").cast("string"), "v", "condition", "slot")
    _write_lines(obs.where((hour >= 6) & (hour != 12)).select(day.alias("line")), "SEQ,junction,DATE,vehicles,Road_Condition,TIME", path)
    bare = F.concat_ws(",", "slot", "v", "seq")
    _write_lines(obs.where(hour == 12).select(bare.alias("line")), "time,VEHICLES,seq", path)
    return read_layouts(spark, path, null_v="keep", default_date=TODAY)


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    land(events(spark, sf_dir), path)
    return normalise(read_obs(spark, path, fmt="parquet"), null_v="keep")


def _exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    export(agg.daily(events(spark, sf_dir)), path)
    return spark.read.parquet(path).select("place", "obs_date", "total_v")


def _observed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_counts(load_report(events(spark, sf_dir)).observed)


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three summaries stacked, to compare them in one go."""
    parts = jobs.summary(events(spark, sf_dir))
    counts = [
        parts[name].select(
            F.lit(name).alias("summary"),
            F.col(key).alias("label"),
            F.col("n"),
            F.lit(None).cast("double").alias("avg_v"),
            F.lit(None).cast("double").alias("avg_incidents"),
        )
        for name, key in (("by_place", "place"), ("by_weather", "weather"))
    ]
    means = parts["by_condition"].select(
        F.lit("by_condition").alias("summary"),
        F.col("condition").alias("label"),
        F.lit(None).cast("bigint").alias("n"),
        "avg_v",
        "avg_incidents",
    )
    return counts[0].unionByName(counts[1]).unionByName(means)


def _latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last.latest(events(spark, sf_dir))


def _latest_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last.latest(tables.lineitem_keyed(spark, sf_dir), tables.lineitem_order())


def _latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last.latest(orders(spark, sf_dir))


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each observed place and hour, asked for one week after the event."""
    return events(spark, sf_dir).select(
        "place", F.date_add("obs_date", 7).alias("obs_date"), "hour"
    ).distinct()


def _predicted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = models.fit_count(events(spark, sf_dir))
    return models.predict_count(model, _requests(spark, sf_dir))


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.train(events(spark, sf_dir)).predict(_requests(spark, sf_dir))


def _reloaded_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark)
    models.retrain(events(spark, sf_dir), root, "v1")
    return models.Predictor.load(root, "v1").predict(_requests(spark, sf_dir))


def _condition_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the fitted model expects of each condition over the rows it learnt from."""
    obs = events(spark, sf_dir)
    return models.condition_totals(models.fit_condition(obs), obs)


def _totals_with_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where rows lack a weather, a count or an hour and so are no part of the fit."""
    kind = F.col("condition")
    obs = events(spark, sf_dir).withColumns(
        {
            "weather": F.when(F.col("hour") != 3, F.col("weather")),
            "v": F.when(~((kind == "click") & (F.col("dow") == 2)), F.col("v")),
            "hour": F.when(F.col("place") != "7", F.col("hour")),
        }
    )
    return models.condition_totals(models.fit_condition(obs), obs.dropna())


def _count_part(scored: DataFrame) -> DataFrame:
    """What scoring says of the count, without the condition predicted from it."""
    return scored.select("place", "obs_date", "hour", "dow", "predicted_v")


def _count_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction texts up to the condition."""
    texts_ = models.prediction_text(_predictions(spark, sf_dir))
    upto = F.substring_index("text", "Predicted Road Condition", 1)
    return texts_.select("place", "obs_date", "hour", upto.alias("text"))


def _stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictor = models.train(events(spark, sf_dir))
    stream = tables.events_stream(spark, sf_dir).select("place", "obs_date", "hour", "seq")
    return live.run_available(
        live.score_stream(stream, predictor.count_model, predictor.condition_model)
    )


def _late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that reach a stream of daily totals after their day was closed: of two drains
    the first brings the later half of the events."""
    source, root = shared_dir(spark), shared_dir(spark)
    obs = live.with_event_time(events(spark, sf_dir))
    for part in (obs.where(F.col("obs_date") >= HALF), obs.where(F.col("obs_date") < HALF)):
        part.write.mode("append").parquet(source)
        drained = ledger.drain_totals(spark.readStream.schema(obs.schema).parquet(source), root=root)
    return drained.late.select("place", "obs_date", "slot", "v", "seq", "reason")


def queries() -> dict[str, Query]:
    return {
        # Loading and normalising
        "observations": lambda s, d: events(s, d).select(*DATA_COLUMNS),
        "raw_files_normalised": lambda s, d: _raw_files(s, d).select(*DATA_COLUMNS, "seq"),
        "raw_files_quarantine": lambda s, d: filters.quarantine(
            _raw_files(s, d, "keep"), need_slot=True
        ).select("seq", "place", "v", "reason"),
        "raw_files_decimals": lambda s, d: agg.report(_decimal_files(s, d)),
        "raw_files_decimals_quarantine": lambda s, d: filters.quarantine(
            _decimal_files(s, d), need_slot=True
        ).select("seq", "place", "v", "incidents", "reason"),
        "raw_files_defaults": lambda s, d: _sparse_files(s, d).select(
            "obs_date", "place", "slot", "hour", "v", "incidents", "condition", "dow", "seq"
        ),
        "raw_files_fixed_schema": lambda s, d: _fixed_schema_files(s, d).select(*DATA_COLUMNS),
        "raw_files_latest": lambda s, d: last.latest(_raw_files(s, d, "keep")),
        "raw_files_histogram": lambda s, d: dist.histogram(last.latest(_raw_files(s, d, "keep"))),
        "raw_files_trend": lambda s, d: slots.trend(_raw_files(s, d, "keep")),
        "mixed_files": lambda s, d: filters.valid_rows(_mixed_files(s, d)).select(
            *[c for c in DATA_COLUMNS], "seq"
        ),
        "mixed_files_quarantine": lambda s, d: filters.quarantine(_mixed_files(s, d)).select("line", "reason"),
        "landed_daily": lambda s, d: agg.daily(_landed(s, d), None, FROM, TO),
        "exported_daily": _exported,
        "load_counts": _observed_rows,
        # Lists and listings
        "places": lambda s, d: listing.places(events(s, d)),
        "conditions": lambda s, d: listing.conditions(events(s, d)),
        "slots": lambda s, d: listing.slots(events(s, d)),
        "dates": lambda s, d: listing.dates(events(s, d)),
        "detail": lambda s, d: listing.detail(events(s, d)),
        "detail_of_place": lambda s, d: listing.detail(events(s, d), PLACE, FROM, TO, NIGHT),
        "peak": lambda s, d: listing.peak(events(s, d)),
        "peak_of_place": lambda s, d: listing.peak(events(s, d), PLACE, FROM, TO, MORNING),
        # Aggregates
        "summary": _summary,
        "count_by_place": lambda s, d: agg.count_by(events(s, d), "place"),
        "count_by_weather": lambda s, d: agg.count_by(events(s, d), "weather"),
        "avg_by_condition": lambda s, d: agg.avg_by_condition(events(s, d)),
        "count_by_weather_lineitem": lambda s, d: agg.count_by(lineitem(s, d), "weather"),
        "avg_by_condition_lineitem": lambda s, d: agg.avg_by_condition(lineitem(s, d)),
        "bands": lambda s, d: agg.band_totals(events(s, d)),
        "daily": lambda s, d: agg.daily(events(s, d)),
        "daily_of_place": lambda s, d: agg.daily(events(s, d), PLACE, FROM, TO, NIGHT),
        "daily_labels": lambda s, d: texts.daily_labels(agg.daily(events(s, d))),
        "daily_lineitem": lambda s, d: agg.daily(lineitem(s, d)),
        "last_30_days": lambda s, d: agg.daily(filters.last_n_days(events(s, d), today=TODAY)),
        "report": lambda s, d: agg.report(events(s, d)),
        "report_lineitem": lambda s, d: agg.report(lineitem(s, d)),
        "report_of_place": lambda s, d: agg.report(events(s, d), PLACE, FROM, TO, MORNING),
        "report_overall": lambda s, d: agg.report(events(s, d), by=()),
        "report_with_peak": lambda s, d: agg.report_with_peak(events(s, d)),
        "report_text": lambda s, d: texts.report_text(events(s, d), FROM, TO, NIGHT),
        # Latest values
        "latest": _latest_events,
        "latest_in_source_order": lambda s, d: last.latest(events(s, d), F.col("seq")),
        "latest_lineitem": _latest_lineitem,
        "latest_orders": _latest_orders,
        "latest_by_slot": lambda s, d: last.latest_by_slot(events(s, d)),
        "latest_by_slot_lineitem": lambda s, d: last.latest_by_slot(
            tables.lineitem_keyed(s, d), tables.lineitem_order()
        ),
        "kpis": lambda s, d: last.kpis(_latest_events(s, d)),
        "kpi_labels": lambda s, d: texts.kpi_labels(last.kpis(_latest_orders(s, d))),
        "top_places": lambda s, d: last.top_places(_latest_events(s, d)),
        "histogram": lambda s, d: dist.histogram(_latest_events(s, d)),
        "histogram_lineitem": lambda s, d: dist.histogram(_latest_lineitem(s, d)),
        "quartiles": lambda s, d: dist.quartiles(_latest_events(s, d)),
        "quartiles_orders": lambda s, d: dist.quartiles(_latest_orders(s, d)),
        "quartile_shares": lambda s, d: dist.quartile_shares(_latest_events(s, d)),
        "points": lambda s, d: dist.points(_latest_events(s, d)),
        "points_orders": lambda s, d: dist.points(_latest_orders(s, d)),
        # Slots
        "slot_profile": lambda s, d: slots.slot_profile(events(s, d)),
        "slot_load": lambda s, d: slots.slot_profile(events(s, d), relative=True),
        "series": lambda s, d: slots.series(events(s, d), PLACE),
        "compare": lambda s, d: slots.compare(events(s, d), PLACE, OTHER_PLACE),
        "compare_with_itself": lambda s, d: slots.compare(events(s, d), PLACE, PLACE),
        "trend": lambda s, d: slots.trend(events(s, d)),
        # Roll-ups
        "rollup_week": lambda s, d: rollups.rollup(events(s, d), "week"),
        "rollup_month": lambda s, d: rollups.rollup(lineitem(s, d), "month"),
        "condition_trend": lambda s, d: rollups.condition_trend(events(s, d)),
        "heatmap": lambda s, d: rollups.heatmap(events(s, d), HOURS),
        # Models
        "place_index": lambda s, d: dist.index_of_places(events(s, d)),
        "predicted_counts": _predicted_counts,
        "condition_totals": _condition_totals,
        "condition_totals_with_holes": _totals_with_holes,
        "predictions": _predictions,
        "prediction_text": lambda s, d: models.prediction_text(_predictions(s, d)),
        "prediction_text_count": _count_text,
        "predictions_count": lambda s, d: _count_part(_predictions(s, d)),
        "reloaded_predictions_count": lambda s, d: _count_part(_reloaded_predictions(s, d)),
        "stream_scores_count": lambda s, d: _count_part(_stream_scores(s, d)),
        "reloaded_predictions": _reloaded_predictions,
        # Streams
        "stream_daily": lambda s, d: live.run_totals(tables.events_stream(s, d)).select(
            "place", "obs_date", "total_v", "n"
        ),
        "raw_stream_daily": lambda s, d: live.run_totals(
            live.with_event_time(_raw_stream(s, d))
        ).select("place", "obs_date", "total_v", "n"),
        "raw_stream_latest": lambda s, d: live.run_latest(_raw_stream(s, d)),
        "stream_late_rows": _late_rows,
        "stream_latest": lambda s, d: live.run_latest(tables.events_stream(s, d)),
        "stream_scores": _stream_scores,
    }
