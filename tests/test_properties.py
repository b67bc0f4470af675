"""Brute force and invariants over generated data."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from placecount.functions.bands import BANDS, band_of, in_band
from placecount.functions.expressions import half_up, seconds_of_day
from placecount.operators import aggregates, distribution, latest, slots
from placecount.roles import OBS_COLUMNS

SCHEMA = ", ".join(f"{c} {t}" for c, t in OBS_COLUMNS.items())


def counts_frame(spark, values):
    rows = [(f"p{i:05d}", v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "place string, v int")


VALUES = {
    "none": [],
    "one": [7],
    "two": [3, 9],
    "below five": [0, 1, 4, 4],
    "all equal": [12] * 9,
    "zeros": [0, 0, 0],
    "five": [5, 4, 3, 2, 1],
    "negative": [-70000, -5, 0, 3, 66000],
    "far apart": [2**31 - 1, -(2**31), 0, 65535, 65536, -65536, 131072],
    "many": [random.Random(4).randint(-(10**6), 10**6) for _ in range(3001)],
    "repeats": [random.Random(5).randint(0, 40) for _ in range(2000)],
}


@pytest.mark.parametrize("name", VALUES)
def test_quartiles_and_shares(spark, name):
    values = sorted(VALUES[name])
    frame = counts_frame(spark, VALUES[name]).repartition(5)
    got = distribution.quartiles(frame).collect()
    shares = distribution.quartile_shares(frame).collect()
    if not values:
        assert got == [] and shares == []
        return
    n = len(values)
    cuts = [values[n // 4], values[n // 2], values[3 * n // 4]]
    assert [list(r) for r in got] == [cuts]
    assert sum(r.n for r in shares) == n
    assert sum(r.pct for r in shares) == pytest.approx(100)
    inside = [sum(v <= cuts[0] for v in values), sum(v > cuts[2] for v in values)]
    assert [shares[0].n, shares[3].n] == inside


@pytest.mark.parametrize("name", VALUES)
def test_histogram(spark, name):
    values = VALUES[name]
    got = distribution.histogram(counts_frame(spark, values)).collect()
    if not values:
        assert got == []
        return
    top = max(values)
    width = abs(top) // 5 * (1 if top >= 0 else -1)
    want = [0] * 5
    for v in values:
        want[next((b for b in range(4) if v <= width * (b + 1)), 4)] += 1
    assert [r.bin for r in got] == [0, 1, 2, 3, 4]
    assert [r.n for r in got] == want


def test_points_rank_many_names(spark):
    rng = random.Random(9)
    names = list({f"{rng.choice('aåzZ0')}{rng.randint(0, 10**6)}" for _ in range(4000)})
    frame = spark.createDataFrame([(p, i) for i, p in enumerate(names)], "place string, v int")
    got = distribution.points(frame.repartition(7)).collect()
    by_bytes = sorted(names, key=lambda p: p.encode())
    assert [r.place for r in sorted(got, key=lambda r: r.idx)] == by_bytes
    assert sorted(r.idx for r in got) == list(range(len(names)))


def observations(seed, n=4000, hot=0.4):
    """Rows of a few places, one of which holds more than a third of all."""
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        place = "hot" if rng.random() < hot else rng.choice(["a", "b", "c", None])
        hour = rng.choice([0, 5, 6, 11, 12, 15, 16, 19, 20, 23, None])
        slot = None if hour is None else f"{hour:02d}:{rng.choice(['00', '30'])}"
        day = rng.choice([None, *[f"2025-01-{d:02d}" for d in range(1, 9)]])
        v = rng.choice([None, rng.randint(-5, 30)])
        second = None if slot is None else hour * 3600 + int(slot[3:]) * 60
        rows.append((day, place, slot, hour, v, rng.randint(0, 2), "x", "y", 1, second, seq))
    rng.shuffle(rows)
    return rows


def frame_of(spark, rows):
    text = SCHEMA.replace("obs_date date", "obs_date string")
    frame = spark.createDataFrame(rows, text)
    return frame.withColumn("obs_date", F.col("obs_date").cast("date"))


def lowest_first(*keys):
    """Nulls before everything, as in a Spark ascending order."""
    return tuple((k is not None, k if k is not None else 0) for k in keys)


@pytest.mark.parametrize("seed", [1, 2])
def test_latest_against_a_loop(spark, seed):
    rows = observations(seed)
    by_place, by_slot = {}, {}
    for day, place, slot, _, v, _, _, _, _, second, seq in rows:
        if place is None or v is None:
            continue
        key = lowest_first(day, second, seq)
        by_place[place] = max(by_place.get(place, (key, v)), (key, v))
        if slot is not None:
            cell = (lowest_first(day, seq), v)
            by_slot[place, slot] = max(by_slot.get((place, slot), cell), cell)
    frame = frame_of(spark, rows)
    for shuffled in (frame, frame.repartition(6, "seq")):
        assert dict(map(tuple, latest.latest(shuffled).collect())) == {
            p: v for p, (_, v) in by_place.items()
        }
        assert {(r.place, r.slot): r.v for r in latest.latest_by_slot(shuffled).collect()} == {
            k: v for k, (_, v) in by_slot.items()
        }
        profile = defaultdict(list)
        for (_, slot), (_, v) in by_slot.items():
            profile[slot].append(v)
        assert {r.slot: r.avg_v for r in slots.slot_profile(shuffled).collect()} == {
            s: pytest.approx(sum(v) / len(v)) for s, v in profile.items()
        }


@pytest.mark.parametrize("seed", [3, 4])
def test_report_with_peak_against_a_loop(spark, seed):
    rows = observations(seed)
    groups = defaultdict(list)
    for day, place, slot, _, v, incidents, *_ in rows:
        groups[place].append((day, slot, v, incidents))
    got = {r.place: r for r in aggregates.report_with_peak(frame_of(spark, rows)).collect()}
    plain = {r.place: r for r in aggregates.report(frame_of(spark, rows)).collect()}
    assert set(got) == set(groups)
    for place, group in groups.items():
        counted = [(day, slot, v) for day, slot, v, _ in group if v is not None]
        top = max(v for _, _, v in counted)
        first = min(
            ((day, slot) for day, slot, v in counted if v == top), key=lambda k: lowest_first(*k)
        )
        r = got[place]
        assert (str(r.peak_date) if r.peak_date else None, r.peak_slot, r.peak_v) == (*first, top)
        assert r.n == len(counted) and r.total_v == sum(v for _, _, v in counted)
        assert r.total_incidents == sum(g[3] for g in group)
        assert r.avg_v == pytest.approx(r.total_v / r.n)
        assert [r[c] for c in plain[place].asDict()] == list(plain[place])


def test_order_reaches_the_ends_of_its_range(spark):
    """Day outranks slot, and slot outranks sequence, even for extreme sequences."""
    big = 2**63 - 1
    rows = [
        ("2025-01-01", "a", "23:59:59", 23, 1, 0, "x", "y", 1, 86399, big),
        ("2025-01-02", "a", None, None, 2, 0, "x", "y", 1, None, -big),
        ("2025-01-01", "b", "08:00", 8, 1, 0, "x", "y", 1, 28800, big),
        ("2025-01-01", "b", "08:00:01", 8, 2, 0, "x", "y", 1, 28801, -big - 1),
        (None, "c", "23:00", 23, 1, 0, "x", "y", 1, 82800, big),
        ("0001-01-01", "c", "00:00", 0, 2, 0, "x", "y", 1, 0, 0),
        ("9999-12-31", "d", "23:59", 23, 2, 0, "x", "y", 1, 86340, 5),
        ("9999-12-31", "d", "23:59", 23, 1, 0, "x", "y", 1, 86340, 4),
    ]
    got = dict(map(tuple, latest.latest(frame_of(spark, rows)).collect()))
    assert got == {"a": 2, "b": 2, "c": 2, "d": 2}


def test_bands_partition_the_day(spark):
    hours = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    flags = [in_band(F.col("hour"), b).cast("int") for b in BANDS]
    assert {r[0] for r in hours.select(sum(flags[1:], flags[0])).collect()} == {1}
    named = {r[0]: r[1] for r in hours.select("hour", band_of(F.col("hour"))).collect()}
    assert named[6] == named[11] and named[5] == named[20] == "Night (20:00-6:00)"
    nothing = spark.sql("select cast(null as int) hour")
    assert nothing.select(band_of(F.col("hour"))).first()[0] is None
    assert all(nothing.filter(in_band(F.col("hour"), b)).isEmpty() for b in BANDS)


def test_rounding_halves_up(spark):
    frame = spark.createDataFrame([(-2.5,), (-0.5,), (0.49,), (2.5,)], "x double")
    assert [r[0] for r in frame.select(half_up(F.col("x"))).collect()] == [-2, 0, 0, 3]


def test_seconds_of_day(spark):
    texts = ["00:00", "23:59:59", "24:00", "8:05", "08", "08:60", "a:b", None, "1:2:3:4"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in frame.select(seconds_of_day(F.col("t"))).collect()]
    assert got == [0, 86399, None, 29100, None, None, None, None, None]


def test_mirrored_comparison(spark):
    frame = frame_of(spark, observations(6))
    ab = {r.slot: (r.v_a, r.v_b) for r in slots.compare(frame, "hot", "a").collect()}
    ba = {r.slot: (r.v_b, r.v_a) for r in slots.compare(frame, "a", "hot").collect()}
    assert ab == ba and ab
