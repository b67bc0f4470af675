"""The package itself, sent to executors that do not have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parent.parent
_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package: once for each application, as a small zip
    that Spark distributes. Needless where the package is installed on all machines."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    target = Path(tempfile.mkdtemp(prefix="placecount-")) / f"{_PACKAGE.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as bundle:
        for path in sorted(_PACKAGE.rglob("*.py")):
            bundle.write(path, path.relative_to(_PACKAGE.parent))
    spark.sparkContext.addPyFile(str(target))
    _sent.add(app)
