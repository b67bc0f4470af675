"""How the latest counts spread over places: histogram, quartiles, ranked points.

Place counts can be large, so nothing here sorts all places in one task: window
functions without a partition run only over frames whose size has a fixed bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placecount.session import durable

BINS = 5
# A 32-bit count splits into a high and a low half of this many values each.
_HALF_BITS = 16
_QUARTERS = (1, 2, 3)


def histogram(latest_counts: DataFrame, bins: int = BINS) -> DataFrame:
    """Places per equal-width bin. All bins are listed, also empty ones.

    The width is max div bins; the last bin takes the rest. ``bin`` is the key,
    since labels collide when the maximum is below ``bins``.
    """
    width = latest_counts.agg(F.expr(f"cast(max(v) div {bins} as bigint)"))
    counted = (
        # A column first: a subquery may not stand inside an aggregate function.
        latest_counts.withColumn("width", width.scalar())
        .agg(
            F.max("width").alias("width"),
            F.array(
                *[F.count_if(_in_bin(F.col("v"), F.col("width"), b, bins)) for b in range(bins)]
            ).alias("n"),
        )
        .filter("width is not null")
    )
    return (
        counted.select("width", F.posexplode("n").alias("bin", "n"))
        .select("bin", _bin_label(F.col("width"), F.col("bin"), bins).alias("label"), "n")
        .orderBy("bin")
    )


def _in_bin(v: Column, width: Column, b: int, bins: int) -> Column:
    above = v > width * b if b else F.lit(True)
    return above & (v <= width * (b + 1)) if b < bins - 1 else above


def _bin_label(step: Column, b: Column, bins: int) -> Column:
    start = F.when(b == 0, F.lit(0)).otherwise(step * b + 1).cast("string")
    end = F.when(b == bins - 1, F.lit("+")).otherwise(
        F.concat(F.lit("-"), (step * (b + 1)).cast("string"))
    )
    return F.concat(start, end)


def quartiles(latest_counts: DataFrame) -> DataFrame:
    """Sorted counts at positions n div 4, n div 2 and 3n div 4, as one row.

    Exact selection by halves of the number: count places per high half (at
    most 65 536 rows), find the half that holds each position, then count per
    value inside those three halves only.
    """
    high = F.shiftright("v", _HALF_BITS)
    running = Window.orderBy("high")
    coarse = (
        latest_counts.groupBy(high.alias("high"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "high",
            "n",
            (F.sum("n").over(running) - F.col("n")).alias("before"),
            F.sum("n").over(Window.partitionBy()).alias("total"),
        )
    )
    # Three rows, one per quarter.
    wanted = (
        coarse.withColumn("quarter", F.explode(F.array(*[F.lit(q) for q in _QUARTERS])))
        .withColumn("position", F.expr("quarter * total div 4"))
        .filter("position >= before and position < before + n")
        .agg(
            F.collect_list(
                F.struct("high", "quarter", (F.col("position") - F.col("before")).alias("position"))
            )
        )
    )
    inside = Window.partitionBy("quarter").orderBy("v")
    fine = (
        latest_counts.withColumn("wanted", wanted.scalar())
        # Outer, or Spark would infer a filter for the scan and not share the shuffle.
        .select("v", F.inline_outer("wanted"))
        .filter(F.col("high") == high)
        .groupBy("quarter", "position", "v")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.sum("n").over(inside) - F.col("n"))
        .filter("position >= before and position < before + n")
    )
    return fine.agg(
        *[F.max(F.when(F.col("quarter") == q, F.col("v"))).alias(f"q{q}") for q in _QUARTERS]
    ).filter("q1 is not null")


def quartile_shares(latest_counts: DataFrame) -> DataFrame:
    """Percent of places in each of the four classes the quartiles cut."""
    cuts = quartiles(latest_counts).select(F.struct("q1", "q2", "q3"))
    v, q1, q2, q3 = (F.col(c) for c in ("v", "q1", "q2", "q3"))
    n = (
        latest_counts.withColumn("cuts", cuts.scalar())
        .select("v", "cuts.*")
        .agg(
            F.count("v").alias("n_places"),
            *[F.max(q).alias(f"q{i}") for i, q in zip(_QUARTERS, (q1, q2, q3), strict=True)],
            F.array(
                F.count_if(v <= q1),
                F.count_if((v > q1) & (v <= q2)),
                F.count_if((v > q2) & (v <= q3)),
                F.count_if(v > q3),
            ).alias("n"),
        )
        .filter("n_places > 0")
    )
    labels = F.array(
        F.format_string("Low Traffic (0-%d)", q1),
        F.format_string("Medium-Low (%d-%d)", q1.cast("bigint") + 1, q2),
        F.format_string("Medium-High (%d-%d)", q2.cast("bigint") + 1, q3),
        F.format_string("High Traffic (>%d)", q3),
    )
    return (
        n.select("n_places", labels.alias("labels"), F.posexplode("n").alias("class", "n"))
        .select(
            "class",
            F.get("labels", F.col("class")).alias("label"),
            "n",
            (F.col("n") / F.col("n_places") * 100).alias("pct"),
        )
        .orderBy("class")
    )


def numbered(df: DataFrame, *order: Column, name: str = "idx") -> DataFrame:
    """Rows numbered from 0 in the given order, which must tell all rows apart.

    A row number over all rows would sort them in one task. Instead they are dealt by
    ranges of the order, as many as the session has shuffle partitions, and written to
    the shared folder, so that later steps see the same ranges; numbers are given
    within ranges and shifted by what the ranges before hold.
    """
    ranged = durable(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id())
    )
    sizes = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("range")) - F.col("n")
    offsets = sizes.select("range", before.alias("before"))
    row = F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1
    return (
        ranged.withColumn("row", row)
        # One row for each shuffle partition.
        .join(F.broadcast(offsets), "range")
        .select((F.col("before") + F.col("row")).alias(name), *df.columns)
    )


def points(latest_counts: DataFrame) -> DataFrame:
    """Places numbered from 0 in name order, with their counts."""
    return numbered(latest_counts.dropna().select("place", "v"), F.col("place"))


def index_of_places(df: DataFrame) -> DataFrame:
    """Place names that are not blank with their index by frequency, the most frequent
    first and equals in name order: what ``index_labels`` gives, but distributed."""
    counts = df.where(F.col("place").isNotNull()).groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    ranked = numbered(counts, F.desc("n"), F.col("place"), name="place_index")
    return ranked.where(F.trim("place") != "").select("place", F.col("place_index").cast("double").alias("place_index"))
