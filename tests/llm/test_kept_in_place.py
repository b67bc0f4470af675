"""Few masked or taken documents are sent to the texts; the texts are not shuffled."""

from contextlib import redirect_stdout
from io import StringIO

import pytest
from pyspark.sql import functions as F

from placecount.llm import mixing, secret_scan

KEY = "password = abcdef123456"
DOCS = [(1, f"a {KEY}", "s", 25), (1, f"a {KEY}", "s", 25), (1, f"bc {KEY}", "s", 26), (2, "clean", "s", 5), (3, None, None, 0),
        (None, f"x {KEY}", "t", 25), (None, "none", None, 4)]
MASKED = [(None, "none", 4), (None, "x [secret]", 10), (1, "a [secret]", 10), (1, "a [secret]", 10), (1, "bc [secret]", 11),
          (2, "clean", 5), (3, None, 0)]
MIXED = [(1, 2), (1, 0), (2, 1), (None, 3), (3, 0)]
TIMES = {1: 2, 2: 1, None: 3, 3: 0}


@pytest.fixture
def no_small_tables(spark):
    """Sizes of files never make Spark send a table by itself."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def plan(df):
    with redirect_stdout(StringIO()) as out:
        df.explain()
    return out.getvalue()


def by_text(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_masked(spark, no_small_tables, monkeypatch, limit):
    monkeypatch.setattr(secret_scan, "BROADCAST_SPANS", limit, raising=False)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, source string, n_chars long")
    found = secret_scan.mask_live(docs, F.col("source"), F.col("doc_id"))
    assert by_text(tuple(r) for r in found.select("doc_id", "text", "n_chars").collect()) == by_text(MASKED)
    assert ("hashpartitioning" not in plan(found)) == bool(limit)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_repeated(spark, no_small_tables, monkeypatch, limit):
    monkeypatch.setattr(mixing, "BROADCAST_IDS", limit, raising=False)
    docs = spark.createDataFrame([(i, t) for i, t, *_ in DOCS], "doc_id long, text string")
    found = mixing.repeat_documents(docs, spark.createDataFrame(MIXED, "doc_id long, repeats int"))
    want = [(i, t) for i, t, *_ in DOCS for _ in range(TIMES[i])]
    assert by_text(tuple(r) for r in found.collect()) == by_text(want)
    assert ("hashpartitioning" not in plan(found)) == bool(limit)
