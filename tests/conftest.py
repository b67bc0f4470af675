import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from placecount.session import session

    spark = session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def small_csv():
    return str(ROOT / "tests" / "data" / "obs_small.csv")


@pytest.fixture(scope="session")
def small(spark, small_csv):
    """The golden fixture with missing counts kept."""
    from placecount.operators.normalise import normalise
    from placecount.sources import read_obs

    return normalise(read_obs(spark, small_csv), null_v="keep")


@pytest.fixture
def rows():
    """Rows of a frame as plain tuples, sorted unless order matters."""

    def collect(df, ordered=False):
        out = [tuple(r) for r in df.collect()]
        return out if ordered else sorted(out, key=repr)

    return collect
