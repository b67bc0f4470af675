"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from placecount.roles import OBS_COLUMNS


def export(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: str | None = "obs_date",
    mode: str = "errorifexists",
) -> None:
    """Write any result. Partitioned output gets files of even size.

    The rebalance hint gathers each partition value into few files and lets AQE
    split a value that holds much more than the others.
    """
    if partition_by is None:
        df.write.mode(mode).format(fmt).option("header", True).save(path)
        return
    (
        df.hint("rebalance", partition_by)
        .write.mode(mode)
        .format(fmt)
        .option("header", True)
        .partitionBy(partition_by)
        .save(path)
    )


def land(obs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Keep normalised observations as date-partitioned Parquet.

    Date filters then prune folders, and place filters skip row groups because
    each file is sorted by place.
    """
    columns = [c for c in OBS_COLUMNS if c in obs.columns]
    (
        obs.select(*columns)
        .hint("rebalance", "obs_date")
        .sortWithinPartitions("obs_date", "place", "slot_no", "seq")
        .write.mode(mode)
        .partitionBy("obs_date")
        .parquet(path)
    )
