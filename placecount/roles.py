"""The observation contract: which columns every operator may rely on.

One row is one count taken at one place on one date in one time slot.
``normalise`` builds the contract from raw traffic files; ``conform`` builds it
from any other table once a ``Roles`` mapping says which expression plays
which part.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placecount.functions.expressions import iso_weekday, seconds_of_day

# Raw file schema, in file order. Names and order are fixed values of the format.
OBS_SCHEMA = T.StructType(
    [
        T.StructField("Date", T.StringType()),
        T.StructField("Time", T.StringType()),
        T.StructField("Junction", T.StringType()),
        T.StructField("Vehicles", T.IntegerType()),
        T.StructField("Accidents Reported", T.IntegerType()),
        T.StructField("Weather", T.StringType()),
        T.StructField("Road Condition", T.StringType()),
    ]
)

# The contract in output order. ``weather`` is present only if the source has it.
# ``slot_no`` (seconds since midnight) and ``seq`` (source order) are helpers for
# ordering; the first nine are the data.
OBS_COLUMNS = {
    "obs_date": "date",
    "place": "string",
    "slot": "string",
    "hour": "int",
    "v": "int",
    "incidents": "int",
    "condition": "string",
    "weather": "string",
    "dow": "int",
    "slot_no": "int",
    "seq": "bigint",
}
DATA_COLUMNS = list(OBS_COLUMNS)[:9]


@dataclass(frozen=True)
class Roles:
    """Expressions (columns, or SQL text) that play each part in a table."""

    place: Column | str
    obs_date: Column | str
    slot: Column | str
    v: Column | str
    seq: Column | str
    hour: Column | str = "cast(null as int)"
    incidents: Column | str = "0"
    condition: Column | str = "'Normal'"
    weather: Column | str | None = None
    slot_no: Column | str | None = None

    def column(self, role: str) -> Column | None:
        expression = getattr(self, role)
        return F.expr(expression) if isinstance(expression, str) else expression


def conform(df: DataFrame, roles: Roles, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project ``df`` to the observation contract, plus the columns to ``keep``."""
    parts = {f.name: roles.column(f.name) for f in fields(roles)}
    if parts["slot_no"] is None:
        parts["slot_no"] = seconds_of_day(parts["slot"])
    parts["dow"] = iso_weekday(parts["obs_date"])
    return df.select(
        *[
            parts[name].cast(dtype).alias(name)
            for name, dtype in OBS_COLUMNS.items()
            if parts[name] is not None
        ],
        *keep,
    )
