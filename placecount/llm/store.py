"""Files of the shared folder, as tasks see them.

Spark's writers and readers cover whole tables. Where a task needs a byte range, or
one small file of many, it goes to the folder's file system directly; paths are URIs
such as ``file:///data``, ``hdfs://name/data`` or ``s3://bucket/data``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from placecount.session import durable, shared_dir

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("s3a://"):
        uri = "s3://" + uri.removeprefix("s3a://")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def names(uri: str) -> list[str]:
    """URIs of the files in a folder, in name order; none if it does not exist."""
    system, path = _at(uri)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f"{uri.rstrip('/')}/{f.base_name}" for f in found if f.is_file)


def read(uri: str) -> bytes:
    system, path = _at(uri)
    with system.open_input_file(path) as file:
        return file.read()


def open_ranges(uri: str):
    """A file open for ``read_at(n_bytes, offset)``."""
    system, path = _at(uri)
    return system.open_input_file(path)


def create(uri: str):
    """A new file open for writing. Its folder is made if need be."""
    system, path = _at(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)  # bytes as they are given


def release(*written: DataFrame) -> None:
    """Delete the folders of written frames that nothing reads any more. Only for frames
    that ``durable`` gave."""
    for folder in {file.rpartition("/")[0] for df in written for file in df.inputFiles()}:
        system, path = _at(folder)
        system.delete_dir(path)


@contextmanager
def _sweeping(spark: SparkSession) -> Iterator[None]:
    """Shuffles of what is written meanwhile are deleted at its end. Otherwise they stay until
    the driver collects its garbage."""
    conf = spark.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


def swept(df: DataFrame) -> DataFrame:
    """``durable``, with the shuffles of the write deleted at its end."""
    with _sweeping(df.sparkSession):
        return durable(df)


def parted(df: DataFrame, column: str) -> str:
    """The folder to which ``df`` is written, with a folder in it for each value of ``column``.
    The shuffles of the write are deleted at its end."""
    path = shared_dir(df.sparkSession)
    with _sweeping(df.sparkSession):
        df.write.partitionBy(column).parquet(path)
    return path


def part(spark: SparkSession, path: str, column: str, value: int, schema: StructType) -> DataFrame:
    """The rows of one value of a ``parted`` folder, which may be none."""
    folder = f"{path}/{column}={value}"
    system, at = _at(folder)
    if system.get_file_info(at).type != fs.FileType.Directory:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)
