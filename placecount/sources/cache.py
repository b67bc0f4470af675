"""Reuse of loaded frames, one per path."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def fingerprint(path: str) -> tuple:
    """Number, sizes and times of the files that ``path`` holds now, and a hash over their
    names and those: one row from Spark's listing, however many files there are. A
    missing path has the empty one."""
    spark = SparkSession.active()
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop_path) in (None, []):
        return (0, None, None, None)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    of_file = F.xxhash64("path", "length", "modificationTime")
    return tuple(
        listed.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime"), F.bit_xor(of_file)).first()
    )


class ObservationCache:
    """Persists what ``load`` returns for a path until it is released, or until the files
    there have changed: their fingerprint is taken before each load and compared at each
    ``get``. What ``replace`` puts in a path's place stays whatever the files do.

    Persisting pays only where one frame feeds several actions, such as model
    training; single-pass reports should read the source directly.
    """

    def __init__(self, load: Callable[[str], DataFrame], fingerprint: Callable[[str], object] = fingerprint):
        self._load = load
        self._fingerprint = fingerprint
        self._frames: dict[str, tuple[DataFrame, object]] = {}

    def get(self, path: str) -> DataFrame:
        held = self._frames.get(path)
        if held and held[1] is None:
            return held[0]
        now = self._fingerprint(path)
        if held and held[1] == now:
            return held[0]
        self.release(path)
        return self._keep(path, self._load(path), now)

    def _keep(self, path: str, df: DataFrame, found: object) -> DataFrame:
        self._frames[path] = df.persist(StorageLevel.MEMORY_AND_DISK), found
        return df

    def release(self, path: str | None = None) -> None:
        for key in [path] if path is not None else list(self._frames):
            held = self._frames.pop(key, None)
            if held is not None:
                held[0].unpersist()

    def replace(self, path: str, df: DataFrame) -> DataFrame:
        """Release what the path held and persist ``df`` in its place."""
        self.release(path)
        return self._keep(path, df, None)
