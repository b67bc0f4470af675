"""Hand-checked results on the small fixture."""

from datetime import date

import pytest

from placecount import jobs
from placecount.functions.bands import BANDS
from placecount.operators import aggregates, distribution, filters, latest, listing, slots, texts
from placecount.operators import rollups
from placecount.operators.normalise import normalise
from placecount.sources import read_obs

D1, D2, D3 = date(2025, 4, 1), date(2025, 4, 2), date(2025, 4, 3)
NIGHT, EVENING = list(BANDS)[3], list(BANDS)[2]


def test_counts_by_place_and_weather(small, rows):
    assert rows(aggregates.count_by(small, "place"), ordered=True) == [
        ("A", 5), ("C", 3), ("B", 2), (None, 1), ("D", 1), ("E", 1),
    ]
    assert set(rows(aggregates.count_by(small, "weather"))) == {
        ("Clear", 8), ("Rain", 3), ("Fog", 1), (None, 1),
    }


def test_means_by_condition(spark, small_csv, small, rows):
    want = [("Congested", 250.0, 0.5), ("Damaged", 75.0, 2.0), ("Smooth", 62.5, 0.0)]
    zero = normalise(read_obs(spark, small_csv))
    assert rows(aggregates.avg_by_condition(zero), ordered=True) == want
    # Kept as null, a missing count is in no mean.
    assert rows(aggregates.avg_by_condition(small))[2][1] == pytest.approx(625 / 9)


def test_summary_leaves_out_unknown_weather(small):
    assert list(jobs.summary(small)) == ["by_place", "by_weather", "by_condition"]
    assert list(jobs.summary(small.drop("weather"))) == ["by_place", "by_condition"]


def test_daily(small, rows):
    got = rows(aggregates.daily(small, "A", "2025-04-01", D2), ordered=True)
    assert got == [(D1, 400), (D2, 300)]


def test_report(small, rows):
    got = rows(aggregates.report(small, "A", D1, D2))
    assert got == [("A", 4, 700, 175.0, 300, 100, 1)]
    assert rows(aggregates.report(small, "E")) == [("E", 0, None, None, None, None, 0)]
    assert rows(aggregates.report(small, "Z", by=())) == [(0, None, None, None, None, None)]


def test_report_with_peak(small, rows):
    got = {r[0]: r[1:] for r in rows(aggregates.report_with_peak(small))}
    assert got["A"] == (5, 790, 158.0, 300, 90, 1, D1, "20:15", 300)
    assert got["E"] == (0, None, None, None, None, 0, None, None, None)


def test_peak(small, rows):
    assert rows(listing.peak(small, "A", D1, D2)) == [("A", D1, "20:15", 300)]


def test_bands(small, rows):
    night = filters.where_band(small, NIGHT).groupBy("place").agg({"*": "count", "v": "sum"})
    assert set(rows(night.select("place", "count(1)", "sum(v)"))) == {
        ("A", 2, 480), ("B", 1, 75), ("C", 2, 25), ("D", 1, 20), ("E", 1, None),
    }
    assert filters.where_band(small, EVENING).isEmpty()
    assert filters.where_band(small, "no such band").count() == 13


def test_lists(small, rows):
    assert [r[0] for r in rows(listing.slots(small), True)] == [
        "05:00", "08:30", "12:00", "20:15", "23:00",
    ]
    assert [r[0] for r in rows(listing.places(small), True)] == list("ABCDE")
    assert [r[0] for r in rows(listing.dates(small), True)] == [D1, D2, D3]
    assert len(rows(listing.conditions(small))) == 3


def test_detail_in_time_order(small, rows):
    got = rows(listing.detail(small, "A", D1, D2), ordered=True)
    assert [r[:3] for r in got] == [
        (D1, "08:30", 100), (D1, "20:15", 300), (D2, "08:30", 120), (D2, "20:15", 180),
    ]


def test_weekday(small, rows):
    assert rows(small.select("obs_date", "dow").distinct()) == [(D1, 2), (D2, 3), (D3, 4)]


def test_quarantine(small, rows):
    rejected = filters.quarantine(small).select("place", "v", "reason")
    assert rows(rejected) == [("E", None, "no whole-number count"), (None, 40, "no place")]
    assert filters.valid_rows(small).count() == 11


def test_latest(small, rows):
    counts = latest.latest(small)
    assert rows(counts) == [("A", 90), ("B", 75), ("C", 15), ("D", 20)]
    assert rows(latest.latest(small, small.seq)) == rows(counts)
    assert rows(latest.top_places(counts), True) == [("A", 90), ("B", 75), ("D", 20), ("C", 15)]
    assert rows(latest.top_places(counts, 1)) == [("A", 90)]
    assert rows(latest.kpis(counts)) == [(4, 200, 50.0, "A")]


def test_latest_by_slot(small, rows):
    assert rows(latest.latest_by_slot(small)) == [
        ("A", "08:30", 90), ("A", "20:15", 180), ("B", "08:30", 50), ("B", "20:15", 75),
        ("C", "05:00", 10), ("C", "08:30", 200), ("C", "23:00", 15), ("D", "20:15", 20),
    ]


def test_histogram(small, rows):
    assert rows(distribution.histogram(latest.latest(small)), True) == [
        (0, "0-18", 1), (1, "19-36", 1), (2, "37-54", 0), (3, "55-72", 0), (4, "73+", 2),
    ]


def test_quartiles_and_shares(small, rows):
    counts = latest.latest(small)
    assert rows(distribution.quartiles(counts)) == [(20, 75, 90)]
    assert rows(distribution.quartile_shares(counts), True) == [
        (0, "Low Traffic (0-20)", 2, 50.0),
        (1, "Medium-Low (21-75)", 1, 25.0),
        (2, "Medium-High (76-90)", 1, 25.0),
        (3, "High Traffic (>90)", 0, 0.0),
    ]


def test_points(small, rows):
    got = rows(distribution.points(latest.latest(small)))
    assert got == [(0, "A", 90), (1, "B", 75), (2, "C", 15), (3, "D", 20)]


def test_slot_profile(small, rows):
    got = rows(slots.slot_profile(small, relative=True), True)
    assert [r[0] for r in got] == ["05:00", "08:30", "20:15", "23:00"]
    assert [r[1] for r in got] == pytest.approx([10.0, 113.3333333, 91.6666667, 15.0])
    assert max(r[2] for r in got) == 1.0


def test_compare(small, rows):
    assert rows(slots.compare(small, "A", "B"), True) == [("08:30", 90, 50), ("20:15", 180, 75)]
    assert rows(slots.compare(small, "A", "C"), True) == [
        ("05:00", None, 10), ("08:30", 90, 200), ("20:15", 180, None), ("23:00", None, 15),
    ]
    mirrored = [(s, b, a) for s, a, b in rows(slots.compare(small, "C", "A"), True)]
    assert mirrored == rows(slots.compare(small, "A", "C"), True)
    assert rows(slots.compare(small, "A", "A"), True) == [("08:30", 90, 90), ("20:15", 180, 180)]
    # E has no count, Z does not exist
    assert slots.compare(small, "A", "E").isEmpty()
    assert slots.compare(small, "A", "Z").isEmpty()


def test_series_and_trend(small, rows):
    assert rows(slots.series(small, "C"), True) == [("05:00", 10), ("08:30", 200), ("23:00", 15)]
    assert rows(slots.trend(small)) == [("C", 10, 15, 50.0)]
    one_slot = small.filter("slot = '08:30'")
    assert slots.trend(one_slot).isEmpty()


def test_rollups(small, rows):
    week = {r[0]: r[1:] for r in rows(rollups.rollup(small, "week"))}
    assert week["A"] == (date(2025, 3, 31), 5, 790, 158.0)
    month = {r[0]: r[1:] for r in rows(rollups.rollup(small, "month"))}
    assert month["B"] == (D1, 2, 125, 62.5)
    days = rollups.rollup(small, "day").filter("place = 'A'").select("period", "total_v")
    assert rows(days) == [(D1, 400), (D2, 300), (D3, 90)]
    with pytest.raises(ValueError):
        rollups.rollup(small, "fortnight")
    trend = rows(rollups.condition_trend(small), True)
    assert trend[0] == (D1, "Congested", 1) and sum(r[2] for r in trend) == 13
    wide = rows(rollups.heatmap(small, ["05:00", "08:30"]))
    assert wide == [("A", None, 90), ("B", None, 50), ("C", 10, 200), ("D", None, None)]
    assert rows(rollups.heatmap(small)) == rows(latest.latest_by_slot(small))


def test_texts(small, rows):
    got = rows(texts.report_text(small, D1, D2, place="A"))
    assert got == [
        (
            "A",
            "TRAFFIC CONGESTION REPORT\n==========================\nJunction: A\n"
            "Period: 2025-04-01 to 2025-04-02\nTime Range: All Day\n\n"
            "Total Records: 4\nTotal Vehicles: 700\nAverage Vehicles: 175.00\n"
            "Maximum Vehicles: 300\nMinimum Vehicles: 100\nTotal Accidents: 1\n",
            "Peak Congestion: 2025-04-01 at 20:15 with 300 vehicles",
        )
    ]
    labels = rows(texts.daily_labels(aggregates.daily(small, "A", D1, D2)), True)
    assert [r[2] for r in labels] == ["Apr 01", "Apr 02"]
    k = texts.kpi_labels(latest.kpis(latest.latest(small))).first()
    assert (k.total_label, k.avg_label, k.top_label) == ("200", "50.0", "A")
    assert len(texts.stamped(small.limit(1)).first().as_of) == 19


def test_argument_checks(small):
    for call in (
        lambda: aggregates.daily(small, ""),
        lambda: aggregates.daily(small, "A", D1, None),
        lambda: filters.where_dates(small, None, D1),
        lambda: filters.where_place(small),
        lambda: filters.require(small, "place", "speed"),
    ):
        with pytest.raises(ValueError):
            call()


def test_last_n_days(small):
    assert filters.last_n_days(small, 1, "2025-04-02").count() == 11
    assert filters.last_n_days(small, today="2025-05-02").count() == 9
    assert filters.last_n_days(small, today="2020-01-01").isEmpty()


def test_no_rows_gives_no_results(spark, small_csv, rows):
    none = normalise(read_obs(spark, small_csv)).filter("place = 'nowhere'")
    counts = latest.latest(none)
    for empty in (
        counts,
        latest.kpis(counts),
        latest.top_places(counts),
        distribution.histogram(counts),
        distribution.quartiles(counts),
        distribution.quartile_shares(counts),
        distribution.points(counts),
        slots.slot_profile(none, relative=True),
        slots.trend(none),
        aggregates.report_with_peak(none),
        listing.peak(none),
    ):
        assert rows(empty) == []
