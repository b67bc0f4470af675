"""Other tables read as observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placecount.functions.expressions import utc_instant
from placecount.roles import Roles, conform
from placecount.sources import read_stream

# event_id rises with ts, so it serves as the source order.
EVENTS = Roles(
    place="cast(user_id as string)",
    obs_date="to_date(ts)",
    slot="concat(lpad(cast(hour(ts) as string), 2, '0'), ':00')",
    slot_no="hour(ts) * 3600",
    hour="hour(ts)",
    v="cast(floor(value) as int)",
    incidents="if(event_type = 'error', 1, 0)",
    weather="event_type",
    condition="event_type",
    seq="event_id",
)

# A month stands in for the slot; the table has no time of day and no unique key.
LINEITEM = Roles(
    place="cast(l_suppkey as string)",
    obs_date="to_date(l_shipdate)",
    slot="lpad(cast(month(l_shipdate) as string), 2, '0')",
    v="cast(floor(l_quantity) as int)",
    incidents="if(l_returnflag = 'R', 1, 0)",
    weather="l_linestatus",
    condition="l_returnflag",
    seq="l_orderkey",
)

ORDERS = Roles(
    place="cast(o_custkey as string)",
    obs_date="to_date(o_orderdate)",
    slot="lpad(cast(month(o_orderdate) as string), 2, '0')",
    v="cast(floor(o_totalprice) as int)",
    weather="o_orderstatus",
    condition="o_orderpriority",
    seq="o_orderkey",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(table(spark, sf_dir, "events"), EVENTS)


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(table(spark, sf_dir, "lineitem"), LINEITEM)


def lineitem_order():
    """(date, order, line, part, count) of line items as one exact decimal of 38 digits,
    so that the aggregate needs no sort; the count itself breaks the last ties."""
    packed = F.unix_date("obs_date").cast("decimal(38,0)")
    for column, digits in (("l_orderkey", 13), ("l_linenumber", 2), ("l_partkey", 11), ("v", 6)):
        packed = (packed * F.expr(f"1{'0' * digits}BD")).cast("decimal(38,0)") + F.col(column).cast("decimal(38,0)")
        packed = packed.cast("decimal(38,0)")
    return packed


def lineitem_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as observations, beside the keys that order them."""
    raw = table(spark, sf_dir, "lineitem")
    return conform(raw, LINEITEM, keep=("l_orderkey", "l_linenumber", "l_partkey"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(table(spark, sf_dir, "orders"), ORDERS)


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events files as a stream, with the event time the windows use."""
    schema = table(spark, sf_dir, "events").schema
    # A glob that fits this name only, as a file stream takes no plain single file.
    raw = read_stream(spark, f"{sf_dir}/event[s].parquet", schema)
    return conform(raw.withColumn("event_time", utc_instant(F.col("ts"))), EVENTS, keep=("event_time",))


def events_as_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events under the raw traffic headers, roughened the way field data is.

    Hours below 10 lose their leading zero, purchases have no count, signups
    have text for a count, and the clicks of user 7 have no place.
    """
    obs = events(spark, sf_dir)
    kind = F.col("condition")
    return obs.select(
        F.col("obs_date").cast("string").alias("Date"),
        F.concat(F.col("hour").cast("string"), F.lit(":00")).alias("Time"),
        F.when((kind == "click") & (F.col("place") == "7"), None)
        .otherwise(F.col("place"))
        .alias("Junction"),
        F.when(kind == "purchase", None)
        .when(kind == "signup", "n/a")
        .otherwise(F.col("v").cast("string"))
        .alias("Vehicles"),
        F.col("incidents").alias("Accidents Reported"),
        F.col("weather").alias("Weather"),
        kind.alias("Road Condition"),
        "seq",
    )
