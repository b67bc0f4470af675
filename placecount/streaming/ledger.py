"""What drained streams have given so far, kept as tables on shared storage.

A drain writes what each of its batches changes into a folder of its own, named by the
batch, so that writing it again after a failure replaces it. At its end it merges those
batches into a snapshot and names that in a manifest, which Spark shows only once it is
committed. The next drain reads one snapshot and its own batches, however many there
were before. Batches lie below the snapshot that they follow, so nothing merged is even
listed again.

Totals need no state store: sums of batches add up. The watermark is part of what a
batch commits, and the next one is split against it before anything is aggregated, so
rows that come too late are known one by one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placecount.functions.expressions import utc_day
from placecount.session import shared_dir

LATENESS = "1 hour"
TOO_LATE, NO_TIME = "too late", "no time"
_MANIFEST = "upto long, path string"


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


@dataclass(frozen=True)
class Ledger:
    """The tables of one stream below ``root``."""

    spark: SparkSession
    root: str

    def snapshot(self) -> tuple[int, str | None]:
        """The last batch that is merged, -1 at first, and where the snapshot lies."""
        if not exists(self.spark, f"{self.root}/manifests"):
            return -1, None
        found = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifests").orderBy(F.desc("upto")).first()
        return (-1, None) if found is None else (found["upto"], found["path"])

    def deltas(self, upto: int) -> str:
        return f"{self.root}/deltas/after={upto}"

    def drain(self, stream: DataFrame, mode: str, write: Callable[[DataFrame, int, str], None]) -> None:
        """Run ``write(changed, batch, folder)`` for each batch that is there now."""
        folder = self.deltas(self.snapshot()[0])
        query = (
            stream.writeStream.foreachBatch(lambda changed, batch: write(changed, batch, f"{folder}/batch={batch}"))
            .outputMode(mode)
            .option("checkpointLocation", f"{self.root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def merge(self, schema: str, merged: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """The snapshot with all batches since. ``merged`` makes one row of each key from
        rows of ``schema``, which ends in the number of their batch."""
        upto, path = self.snapshot()
        folder, reader = self.deltas(upto), self.spark.read.schema(schema)
        if exists(self.spark, folder):
            rows = reader.parquet(folder)
            if path:
                rows = rows.unionByName(reader.parquet(f"{self.root}/{path}"))
            # A batch without rows leaves its folder; the next drain starts after it as well.
            last = max(int(name.rpartition("=")[2]) for name in self._names(folder))
            path = f"snapshots/upto={last}"
            merged(rows).write.mode("overwrite").parquet(f"{self.root}/{path}")
            manifest = self.spark.range(1).select(F.lit(last).cast("long").alias("upto"), F.lit(path).alias("path"))
            manifest.write.mode("append").parquet(f"{self.root}/manifests")
        if path is None:
            return self.spark.createDataFrame([], schema)
        return reader.parquet(f"{self.root}/{path}")

    def _names(self, folder: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return [f.getPath().getName() for f in path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)]


@dataclass(frozen=True)
class Drained:
    """Totals so far, and every row that took no part in them, with ``reason`` and the
    ``batch`` it came in."""

    rows: DataFrame
    late: DataFrame

    @property
    def late_rows(self) -> int:
        return self.late.where(F.col("reason") == TOO_LATE).count()


def newest_rows(frame: DataFrame, keys: list[str], root: str | None = None) -> DataFrame:
    """Drain an update-mode stream and return the newest row of each key so far. Give the
    same root again to continue."""
    ledger = Ledger(frame.sparkSession, root or shared_dir(frame.sparkSession))

    def write(changed: DataFrame, batch: int, folder: str) -> None:
        changed.write.mode("overwrite").parquet(folder)

    ledger.drain(frame, "update", write)
    values = [c for c in frame.columns if c not in keys]
    schema = ", ".join(f"`{c}` {kind}" for c, kind in (*frame.dtypes, ("batch", "long")))

    def newest(rows: DataFrame) -> DataFrame:
        last = F.max_by(F.struct(*values), "batch").alias("last")
        return rows.groupBy(*keys).agg(last, F.max("batch").alias("batch")).select(*keys, "last.*", "batch")

    return ledger.merge(schema, newest).select(*frame.columns)


def drain_totals(stream: DataFrame, grain: str = "1 day", lateness: str = LATENESS, root: str | None = None) -> Drained:
    """Drain ``stream`` (place, event_time, v) and return total and number of counts of each
    place and window so far, open windows included.

    As with Spark's watermark, a row comes too late if the window it belongs to ended by
    the newest time seen in earlier batches less ``lateness``. Such rows are kept in a
    table beside the totals, and so are rows without a time. Give the same root again to
    continue.
    """
    spark = stream.sparkSession
    ledger = Ledger(spark, root or shared_dir(spark))
    commits, late_folder = f"{ledger.root}/commits", f"{ledger.root}/late"

    def watermark_before(batch: int) -> int | None:
        """In microseconds; what the batch before this one has committed."""
        if not batch:
            return None
        return spark.read.schema("watermark long").parquet(f"{commits}/batch={batch - 1}").first()["watermark"]

    def write(rows: DataFrame, batch: int, folder: str) -> None:
        watermark = watermark_before(batch)
        windowed = rows.where("event_time is not null").withColumn("__window", F.window("event_time", grain))
        too_late: Column = F.lit(False)
        if watermark is not None:
            too_late = F.unix_micros("__window.end") <= watermark
        totals = (
            windowed.where(~too_late)
            .groupBy("place", F.col("__window.start").alias("start"))
            .agg(F.sum("v").alias("total_v"), F.count("v").alias("n"), F.max("event_time").alias("newest"))
        )
        totals.write.mode("overwrite").parquet(folder)
        untimed = rows.where("event_time is null").withColumn("reason", F.lit(NO_TIME))
        late = windowed.where(too_late).drop("__window").withColumn("reason", F.lit(TOO_LATE))
        late.unionByName(untimed).write.mode("overwrite").parquet(f"{late_folder}/batch={batch}")
        # Late rows are older than the watermark, so the newest time is among the others.
        newest = F.unix_micros(F.max("newest") - F.expr(f"interval {lateness}"))
        committed = spark.read.schema("newest timestamp").parquet(folder).agg(
            F.greatest(newest, F.lit(watermark).cast("long")).alias("watermark")
        )
        committed.coalesce(1).write.mode("overwrite").parquet(f"{commits}/batch={batch}")

    ledger.drain(stream, "append", write)

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy("place", "start").agg(
            F.sum("total_v").alias("total_v"), F.sum("n").alias("n"), F.max("batch").alias("batch")
        )

    totals = ledger.merge("place string, start timestamp, total_v long, n long, batch long", summed)
    schema = ", ".join(f"`{c}` {kind}" for c, kind in (*stream.dtypes, ("reason", "string"), ("batch", "long")))
    late = spark.createDataFrame([], schema)
    if exists(spark, late_folder):
        late = spark.read.schema(schema).parquet(late_folder)
    return Drained(totals.select("place", "start", utc_day(F.col("start")).alias("obs_date"), "total_v", "n"), late)
