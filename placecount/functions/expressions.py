"""Column expressions shared by the operators. All are JVM built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# seq spans the signed 64-bit range, so one tick must outweigh 2 * 2**63.
_TICK_WEIGHT = "20000000000000000000BD"
# Below the day number of 0001-01-01; a row without a date is older than any other.
_BEFORE_ALL_DAYS = -800_000
_SECONDS = 86_400


def whole_number(raw: Column, dtype: str) -> Column:
    """32-bit integer. Fractions truncate, in text (``100.0``) as in numbers; what is no
    number, or too large, is null."""
    return (raw.try_cast("decimal(38,10)") if dtype == "string" else raw).try_cast("int")


def parsed_date(raw: Column, dtype: str) -> Column:
    if dtype == "string":
        return F.try_to_date(raw, "yyyy-MM-dd")
    return raw.cast("date")


def iso_weekday(day: Column) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(day) + 1


def hour_of(slot: Column) -> Column:
    """Text before the first colon, so both ``8:30`` and ``08:30`` give 8."""
    return F.split(slot, ":").getItem(0).try_cast("int")


def padded_slot(slot: Column) -> Column:
    """``8:30`` to ``08:30``, so that text order is time order."""
    return F.when(F.substring(slot, 2, 1) == ":", F.concat(F.lit("0"), slot)).otherwise(slot)


def seconds_of_day(slot: Column) -> Column:
    """Seconds since midnight of ``HH:mm`` or ``HH:mm:ss``; null if it is neither."""
    part = F.split(slot, ":")
    hour, minute, second = (F.get(part, F.lit(i)).try_cast("int") for i in range(3))
    second = F.when(F.size(part) == 2, 0).otherwise(second)
    in_day = hour.between(0, 23) & minute.between(0, 59) & second.between(0, 59)
    return F.when(in_day & (F.size(part) <= 3), hour * 3600 + minute * 60 + second)


def _pack(tick: Column, seq: Column) -> Column:
    return tick.cast("decimal(13,0)") * F.expr(_TICK_WEIGHT) + F.coalesce(
        seq, F.lit(0)
    ).cast("decimal(19,0)")


def _day_number(day: Column) -> Column:
    return F.coalesce(F.unix_date(day), F.lit(_BEFORE_ALL_DAYS)).cast("bigint")


def event_order() -> Column:
    """(obs_date, slot, seq) as one exact decimal, for ``max_by``.

    A struct would be the plain way to say it, but a struct (or string) in an
    aggregation buffer makes Spark sort the whole input by group key. A
    fixed-width number keeps the hash aggregate and its map-side combine.
    """
    tick = _day_number(F.col("obs_date")) * (_SECONDS + 1) + F.coalesce(
        F.col("slot_no") + 1, F.lit(0)
    )
    return _pack(tick, F.col("seq"))


def day_order() -> Column:
    """(obs_date, seq) as one exact decimal; see :func:`event_order`."""
    return _pack(_day_number(F.col("obs_date")), F.col("seq"))


# 32-bit halves of a peak code. A row without a date counts as the earliest.
_HALF = 2**32
_LAST_DAY = 2**31 - 1


def peak_code(v: Column, day: Column) -> Column:
    """(count, earlier day) as one bigint: the largest code is the first peak."""
    day = F.coalesce(F.unix_date(day), F.lit(-(2**31))).cast("bigint")
    return v.cast("bigint") * F.lit(_HALF) + (F.lit(_LAST_DAY).cast("bigint") - day)


def peak_day(code: Column) -> Column:
    """The day inside a peak code."""
    day = F.lit(_LAST_DAY).cast("bigint") - F.pmod(code, F.lit(_HALF))
    return F.when(day > -(2**31), F.date_from_unix_date(day.cast("int")))


def half_up(x: Column) -> Column:
    """Nearest whole number, halves towards +infinity (-2.5 to -2)."""
    return F.floor(x + 0.5)


def utc_instant(ts_ntz: Column) -> Column:
    """Zone-free wall clock as the instant with the same digits in UTC.

    Event-time windows align to the UTC epoch, so a window of one day is a
    calendar day whatever zone the session runs in.
    """
    seconds = (
        F.unix_date(F.to_date(ts_ntz)).cast("bigint") * _SECONDS
        + F.hour(ts_ntz) * 3600
        + F.minute(ts_ntz) * 60
    )
    return F.timestamp_seconds(
        seconds.cast("decimal(18,6)") + F.extract(F.lit("SECOND"), ts_ntz)
    )


def slot_instant(day: Column, slot_no: Column) -> Column:
    """Start of a slot as an instant, days and slots taken as UTC; without a time of day
    the start of the day."""
    seconds = F.unix_date(day).cast("bigint") * _SECONDS + F.coalesce(slot_no, F.lit(0))
    return F.timestamp_seconds(seconds)


def utc_day(instant: Column) -> Column:
    """Calendar day in UTC of an instant, whatever the session zone."""
    return F.date_from_unix_date(
        F.floor(F.unix_seconds(instant) / F.lit(_SECONDS)).cast("int")
    )
