import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def tables(spark):
    """Rows of a given table as tuples."""

    def read(name, *columns):
        return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/{name}.parquet").select(*columns).collect()]

    return read


@pytest.fixture(scope="session")
def results(spark):
    """Each registered query's rows over the small tables, run once."""
    from placecount.llm.queries import queries

    found = {}

    def run(name):
        if name not in found:
            found[name] = queries()[name](spark, SF_DIR).toPandas()
        return found[name]

    return run
