"""Shapes of physical plans that matter at scale."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from placecount.operators import aggregates, distribution, filters, latest, listing, slots
from placecount.plans import tables
from placecount.plans.tables import events


@pytest.fixture
def plan(spark):
    def text(df, run=False):
        if run:
            df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    return text


@pytest.mark.parametrize(
    "build",
    [
        latest.latest,
        latest.latest_by_slot,
        lambda o: latest.latest(o, F.col("seq")),
        aggregates.report,
        lambda o: o.groupBy("place").agg(F.sum("v")),
        lambda o: latest.latest(tables.lineitem_keyed(o.sparkSession, SF_DIR), tables.lineitem_order()),
    ],
)
def test_hash_aggregates_with_map_side_combine(spark, plan, build):
    text = plan(build(events(spark, SF_DIR)))
    assert "SortAggregate" not in text and "partial_" in text
    assert text.count("Exchange hashpartitioning") == 1


def test_no_python_and_no_cross_join(spark, plan):
    obs = events(spark, SF_DIR)
    counts = latest.latest(obs)
    for df in (
        aggregates.report_with_peak(obs),
        distribution.histogram(counts),
        distribution.quartile_shares(counts),
        slots.trend(obs),
        slots.slot_profile(obs, relative=True),
        slots.compare(obs, "1", "2"),
    ):
        text = plan(df)
        for bad in ("Python", "CartesianProduct", "NestedLoop", "SortMergeJoin"):
            assert bad not in text


def test_filters_and_columns_reach_the_scan(spark, plan):
    text = plan(aggregates.daily(filters.where_dates(events(spark, SF_DIR), "2024-01-05", "2024-01-06")))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "GreaterThanOrEqual(ts" in scan and "props" not in scan and "event_type" not in scan


def test_peak_is_a_top_k(spark, plan):
    assert "TakeOrderedAndProject(limit=1" in plan(listing.peak(events(spark, SF_DIR)))


@pytest.mark.parametrize(
    "build", [distribution.histogram, distribution.quartiles]
)
def test_latest_counts_are_computed_once(spark, plan, build):
    """The subqueries read the shuffle of the main query, not the table again."""
    final = plan(build(latest.latest(events(spark, SF_DIR))), run=True)
    assert "ReusedExchange" in final
