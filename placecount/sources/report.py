"""What a load brought in."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LoadReport:
    columns: list[str]
    schema: str
    sample: DataFrame
    observed: DataFrame
    counts: Observation

    def rows(self) -> int:
        """Row count, known once an action has run over ``observed``."""
        return self.counts.get["rows"]


def load_report(df: DataFrame, sample_rows: int = 5) -> LoadReport:
    """Schema and sample at once; the row count rides on the caller's own action."""
    counts = Observation("load")
    return LoadReport(
        columns=df.columns,
        schema=df.schema.simpleString(),
        sample=df.limit(sample_rows),
        observed=df.observe(counts, F.count(F.lit(1)).alias("rows")),
        counts=counts,
    )


def load_counts(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, non-null and total row counts."""
    totals = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    per_column = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("name"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col(f"n{i}").alias("non_null"),
            F.col("n_rows"),
        )
        for i, f in enumerate(df.schema)
    ]
    return totals.select(F.inline(F.array(*per_column)))
