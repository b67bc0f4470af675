"""Readers of raw observation files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placecount.operators.filters import resolve

# Never inferred: inference would turn 08:30 into a timestamp of today.
_TEXT_COLUMNS = ("Date", "Time")


def read_obs(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType | None = None,
    infer: bool = False,
    fmt: str = "csv",
) -> DataFrame:
    """Raw observations from files, globs or folders of any Hadoop file system.

    * default: column names from the header, every CSV column as text, so that
      ``normalise`` decides about each malformed value;
    * ``schema``: fixed names and types by position (``OBS_SCHEMA``), malformed
      fields null;
    * ``infer``: types inferred by an extra pass, except ``Date`` and ``Time``.

    A header that contradicts the schema raises instead of silently reading
    the wrong columns. A missing path raises ``PATH_NOT_FOUND``.
    """
    if fmt != "csv":
        reader = spark.read.format(fmt)
        return (reader.schema(schema) if schema else reader).load(paths)
    plain = spark.read.option("header", True)
    if schema is None:
        schema = plain.option("inferSchema", infer).csv(paths).schema
        names = {resolve(schema.names, c) for c in _TEXT_COLUMNS} - {None}
        schema = T.StructType(
            [
                T.StructField(f.name, T.StringType()) if f.name in names else f
                for f in schema
            ]
        )
    return plain.schema(schema).option("enforceSchema", False).csv(paths)


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The same files as a stream; each new file becomes part of a micro-batch.

    A CSV file whose header contradicts the schema stops the stream. Without a ``seq``
    column the time at which a file was written is the sequence of its rows.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(path)
    if resolve(schema.names, "seq"):
        return stream
    return stream.withColumn("seq", F.unix_micros("_metadata.file_modification_time"))
