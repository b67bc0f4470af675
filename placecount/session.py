"""Session defaults, and the shared folder for results that must outlive executors."""

from __future__ import annotations

import atexit
import shutil
import sys
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# Applied by jobs that create their own session; a caller's session is left alone.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def session(app: str = "placecount", **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SESSION_DEFAULTS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _local_root() -> str:
    """One temporary folder for this process, removed at its end."""
    root = tempfile.mkdtemp(prefix="placecount-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    print(f"spark.checkpoint.dir is not set; intermediate tables go to {root}", file=sys.stderr)
    return root


def shared_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, left to that folder's clean-up.

    Only a local-mode session without that setting falls back to a temporary folder,
    which it names once and removes at its end; on a cluster a machine-local path
    would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/placecount-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Used where several jobs read one small aggregate of a large input: a lost
    executor then costs a re-read of the aggregate, not of the input.
    """
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
