"""Bands of the day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ALL_DAY = "All Day"

# Label -> hours [from, to). The night wraps midnight, and each of
# its rows stays on its own calendar date.
BANDS = {
    "Morning (6:00-12:00)": (6, 12),
    "Afternoon (12:00-16:00)": (12, 16),
    "Evening (16:00-20:00)": (16, 20),
    "Night (20:00-6:00)": (20, 6),
}


def in_band(hour: Column, band: str) -> Column:
    """Predicate of one band. Any other label means the whole day."""
    if band not in BANDS:
        return F.lit(True)
    start, end = BANDS[band]
    after, before = hour >= start, hour < end
    return (after & before) if start < end else (after | before)


def band_of(hour: Column) -> Column:
    """Label of the band an hour falls in; null for a null hour."""
    return F.coalesce(*[F.when(in_band(hour, label), label) for label in BANDS])
