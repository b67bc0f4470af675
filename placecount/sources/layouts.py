"""Folders of CSV files that do not share one header.

One distributed pass reads the first line of each file. Files with the same header are
read together, under the names it gives, and normalised by those; so each file gets the
defaults for the columns that it lacks itself. Lines are parsed beside their own text,
so a line that does not fit its header is known by file and text.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placecount.operators.filters import resolve
from placecount.operators.normalise import SPELLINGS, normalise

TOO_FEW, TOO_MANY, UNCLOSED = "too few fields", "too many fields", "unclosed quote"
FIRST_BYTES = 1 << 16
# File systems that tasks open themselves; on others the first lines come from a scan.
_OPENED = ("/", "file:", "hdfs:", "s3:", "s3a:", "gs:")
# A quoted field, by what stands before a quote inside it.
_CLOSED_FIELD = {"\\": r'(^|,)"[^"\\]*(?:\\.[^"\\]*)*"(?=,|$)', '"': r'(^|,)"[^"]*(?:""[^"]*)*"(?=,|$)'}


def first_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, header) of every file that is not empty. Reads ``FIRST_BYTES`` of each, or
    more where the first line is longer. A missing path raises ``PATH_NOT_FOUND``."""
    files = spark.read.format("binaryFile").load(paths).where("length > 0").select("path")
    schemes = files.select(F.regexp_extract("path", "^([A-Za-z0-9+.-]+:|/)", 1).alias("s")).distinct().collect()
    if any(row["s"] not in _OPENED for row in schemes):
        return _first_lines_by_scan(spark, paths)
    n_bytes = FIRST_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        def first_line(path: str) -> str:
            if path.startswith(("/", "file:")):
                system, at = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
            else:
                system, at = fs.FileSystem.from_uri("s3:" + path[4:] if path.startswith("s3a:") else path)
            with system.open_input_stream(at, compression="detect") as stream:
                found = b""
                while not (b"\n" in found or b"\r" in found) and (more := stream.read(n_bytes)):
                    found += more
            # Spark's text reader leaves out the mark at the beginning of a file as well.
            return (found.decode("utf-8-sig", errors="replace").splitlines() or [""])[0]

        for batch in batches:
            names = batch.column("path").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array([first_line(name) for name in names], pa.string())], names=["path", "header"]
            )

    # Opening a file takes long beside its name, so few names make a task.
    return files.repartition(spark.sparkContext.defaultParallelism).mapInArrow(run, "path string, header string")


def _first_lines_by_scan(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    lines = spark.read.text(paths).select("value", "_metadata.file_path", "_metadata.file_block_start")
    begun = lines.where("file_block_start = 0").withColumn("at", F.monotonically_increasing_id())
    return begun.groupBy(F.col("file_path").alias("path")).agg(F.min_by("value", "at").alias("header"))


def read_layouts(spark: SparkSession, paths: str | list[str], escape: str = "\\", **options) -> DataFrame:
    """Normalised observations of all files, with ``file`` and, for a line that does not fit
    its header, ``line`` and the reason in ``broken``; ``quarantine`` reports those, and
    ``valid_rows`` leaves them out. ``escape`` stands before a quote inside a quoted field: a
    backslash, as Spark writes, or another quote. ``options`` go to ``normalise``.

    Headers match ignoring case, as in ``normalise``; of equal names the first counts. A
    quote that opens a field and never closes breaks its line, as a field does not go on
    in the next one. Blank lines and repeated headers are skipped. Files without a
    ``seq`` column are in the order of their layouts, then of the scan. A header
    without any known name raises an error that names a file.
    """
    layouts = (
        first_lines(spark, paths).groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("files")).orderBy("header").collect()
    )
    if not layouts:
        raise ValueError("no file with a header")
    parts = [_read_layout(spark, row["header"], row["files"], escape, options) for row in layouts]
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return united.withColumn("seq", F.coalesce("seq", F.monotonically_increasing_id()))


def _read_layout(spark: SparkSession, header: str, files: list[str], escape: str, options: dict) -> DataFrame:
    names = [name.strip() for name in next(csv.reader([header]), [])]
    known = [s for spellings in SPELLINGS.values() for s in spellings if resolve(names, s)]
    if not known:
        raise ValueError(f"no known column in the header of {files[0]}: {header[:200]!r}")
    fields = [f"c{i}" for i in range(len(names))]
    schema = T.StructType([T.StructField(f, T.StringType()) for f in (*fields, "line")])
    parsing = {"columnNameOfCorruptRecord": "line", "escape": escape}
    lines = (
        spark.read.text(files)
        .where((F.col("value") != header) & (F.trim("value") != ""))
        .select("value", F.col("_metadata.file_path").alias("file"))
        .withColumn("row", F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), parsing))
    )
    broken = _broken(F.col("value"), len(names), F.col("row.line").isNotNull(), escape)
    seen: set[str] = set()
    columns = []
    for field, name in zip(fields, names):
        if name and name.lower() not in seen and name.lower() not in ("broken", "line", "file"):
            seen.add(name.lower())
            columns.append(F.col(f"row.{field}").alias(name))
    raw = lines.select(
        *columns, "file", broken.alias("broken"), F.when(broken.isNotNull(), F.col("value")).alias("line")
    )
    out = normalise(raw, **options, keep=("file", "broken", "line"))
    return out if resolve(names, "seq") else out.withColumn("seq", F.lit(None).cast("long"))


def _broken(line: Column, n_fields: int, unfit: Column, escape: str) -> Column:
    """Why ``line`` does not fit a header of ``n_fields``, or null."""
    rest = F.regexp_replace(line, _CLOSED_FIELD[escape], "$1")
    found = F.size(F.split(rest, ",", -1))
    return (
        F.when(rest.rlike('(^|,)"'), UNCLOSED)
        .when(unfit & (found < n_fields), TOO_FEW)
        .when(unfit & (found > n_fields), TOO_MANY)
        .when(unfit, "unreadable line")
    )
