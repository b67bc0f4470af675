"""Raw traffic files to the observation contract."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placecount.functions.expressions import (
    hour_of,
    iso_weekday,
    padded_slot,
    parsed_date,
    seconds_of_day,
    whole_number,
)
from placecount.operators.filters import resolve
from placecount.roles import OBS_COLUMNS

# Accepted spellings in order of preference, and defaults for
# columns the source lacks.
SPELLINGS = {
    "obs_date": ("Date", "obs_date"),
    "slot": ("Time", "slot"),
    "hour": ("Hour",),
    "place": ("Junction", "place"),
    "v": ("Vehicles", "v"),
    "incidents": ("Accidents Reported", "Accidents_Reported", "incidents"),
    "condition": ("Road Condition", "Road_Condition", "RoadCondition", "condition"),
    "weather": ("Weather",),
    "dow": ("DayOfWeek", "dow"),
    "seq": ("seq",),
}
DEFAULT_HOUR = 12
DEFAULT_PLACE = "Default Junction"
DEFAULT_CONDITION = "Normal"
NO_WEEKDAY = 0


def normalise(
    df: DataFrame,
    null_v: str = "zero",
    default_date: date | str | None = None,
    drop_null_place: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Project raw rows to the contract, repairing what can be repaired.

    ``null_v="zero"`` counts a missing number as 0, ``"keep"`` leaves it null.
    Text that is no number is null either way, so ``quarantine`` can show it.
    Without a ``seq`` column the row's position in the scan is taken; for a single
    file that is file order. A stream has no such position and needs the column,
    which ``read_stream`` gives to files that lack it. Columns to ``keep`` follow.
    """
    if null_v not in ("zero", "keep"):
        raise ValueError("null_v is 'zero' or 'keep'")
    found = {
        role: next(filter(None, (resolve(df.columns, n) for n in names)), None)
        for role, names in SPELLINGS.items()
    }
    types = dict(df.dtypes)
    if df.isStreaming and not found["seq"]:
        raise ValueError("a stream needs a seq column")

    def raw(role: str) -> Column | None:
        return F.col(f"`{found[role]}`") if found[role] else None

    def number(role: str) -> Column:
        if found[role] is None:
            return F.lit(0)
        parsed = whole_number(raw(role), types[found[role]])
        return F.when(raw(role).isNull(), 0).otherwise(parsed) if null_v == "zero" else parsed

    parts: dict[str, Column] = {}
    if found["obs_date"]:
        parts["obs_date"] = parsed_date(raw("obs_date"), types[found["obs_date"]])
        parts["dow"] = iso_weekday(parts["obs_date"])
    else:
        parts["obs_date"] = (
            F.current_date() if default_date is None else F.lit(default_date).cast("date")
        )
        parts["dow"] = F.lit(NO_WEEKDAY)
    if found["dow"]:
        parts["dow"] = raw("dow").try_cast("int")

    if found["slot"]:
        text = raw("slot").cast("string")
        parts["slot"] = padded_slot(text)
        parts["hour"] = hour_of(text)
        parts["slot_no"] = seconds_of_day(text)
    else:
        parts["slot"] = F.lit(None)
        parts["hour"] = raw("hour").try_cast("int") if found["hour"] else F.lit(DEFAULT_HOUR)
        parts["slot_no"] = F.lit(None)

    parts["place"] = raw("place") if found["place"] else F.lit(DEFAULT_PLACE)
    parts["condition"] = raw("condition") if found["condition"] else F.lit(DEFAULT_CONDITION)
    parts["v"] = number("v")
    parts["incidents"] = number("incidents")
    parts["seq"] = raw("seq") if found["seq"] else F.monotonically_increasing_id()
    if found["weather"]:
        parts["weather"] = raw("weather")

    out = df.select(
        *[parts[n].cast(t).alias(n) for n, t in OBS_COLUMNS.items() if n in parts], *keep
    )
    return out.filter(F.col("place").isNotNull()) if drop_null_place else out
