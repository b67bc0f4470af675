"""Every registered query against its SQL, on the small tables."""

import pytest

from compare import canonical, oracle_connection
from conftest import SF_DIR
from placecount.plans import oracle_sql, queries

ROWS_ONLY = {
    "predictions",
    "prediction_text",
    "reloaded_predictions",
    "stream_scores",
}


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


def test_what_has_no_sql():
    assert set(queries()) - set(oracle_sql()) == ROWS_ONLY
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows_as_sql(spark, oracle, name):
    got = queries()[name](spark, SF_DIR).toPandas()
    want = oracle.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 15
    assert set(queries()) <= set(__spark_entry__.queries())
