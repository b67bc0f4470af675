"""Command line: ``spark-submit placecount/jobs.py [--out DIR] PATH [PATH ...]``.

Prints the start of each summary of the files and its number of rows; with ``--out``
each summary is written whole to a folder of its own.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame

from placecount.operators.aggregates import avg_by_condition, count_by
from placecount.operators.normalise import normalise
from placecount.session import session
from placecount.sources import load_report, read_obs


SHOWN = 20


def summary(df: DataFrame) -> dict[str, DataFrame]:
    """Rows by place, rows by weather (if known), and means by condition."""
    parts = {"by_place": count_by(df, "place")}
    if "weather" in df.columns:
        parts["by_weather"] = count_by(df, "weather")
    parts["by_condition"] = avg_by_condition(df)
    return parts


def main(argv: list[str]) -> int:
    out = None
    if argv[:1] == ["--out"]:
        out, argv = argv[1] if len(argv) > 1 else None, argv[2:]
    if not argv:
        print("usage: jobs.py [--out DIR] PATH [PATH ...]", file=sys.stderr)
        return 2
    spark = session("placecount summary")
    report = load_report(normalise(read_obs(spark, argv)))
    print(report.schema)
    report.sample.show()
    for title, part in summary(report.observed).items():
        if out:
            part.write.mode("errorifexists").parquet(f"{out}/{title}")
            part = spark.read.parquet(f"{out}/{title}")
        print(f"{title}: {part.count()} rows, the first {SHOWN} below")
        part.show(SHOWN, truncate=False)
    print(f"{report.rows()} rows")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
