import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from placecount.operators import aggregates, latest, models
from placecount.plans.tables import events, events_stream
from placecount.streaming import live


def test_closed_days_equal_batch(spark, rows):
    batch = rows(aggregates.daily(events(spark, SF_DIR)))
    got = rows(
        live.run_available(live.windowed_totals(events_stream(spark, SF_DIR))).select(
            "place", "obs_date", "total_v"
        )
    )
    assert len(got) == 383 and len(batch) == 397
    missing = set(batch) - set(got)
    assert set(got) <= set(batch) and {str(r[1]) for r in missing} == {"2024-01-30"}


def test_hourly_windows(spark, rows):
    hourly = live.run_available(live.windowed_totals(events_stream(spark, SF_DIR), "1 hour"))
    want = (
        events(spark, SF_DIR)
        .groupBy("place", "obs_date", "hour")
        .agg(F.sum("v").alias("v"))
        .filter("obs_date < '2024-01-30'")
    )
    got = hourly.filter("obs_date < '2024-01-30'")
    assert got.count() == want.count()
    assert rows(got.agg(F.sum("total_v"))) == rows(want.agg(F.sum("v")))


def test_windows_are_utc_days_in_any_zone(spark, rows):
    zone = spark.conf.get("spark.sql.session.timeZone")
    want = rows(live.run_available(live.windowed_totals(events_stream(spark, SF_DIR))).drop("start"))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        got = live.run_available(live.windowed_totals(events_stream(spark, SF_DIR))).drop("start")
        assert rows(got) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_all_days_equal_batch(spark, rows):
    """Open windows are there as well."""
    got = live.run_totals(events_stream(spark, SF_DIR)).select("place", "obs_date", "total_v")
    assert rows(got) == rows(aggregates.daily(events(spark, SF_DIR)))


def timed_files(spark, folder, batches):
    """A stream of one file for each batch of (place, minute, v), in order."""
    import os

    schema = "place string, event_time timestamp, v int"
    made = len(list(folder.glob("*"))) if folder.exists() else 0
    folder.mkdir(exist_ok=True)
    for i, batch in enumerate(batches, made):
        at = [f"('{p}', {'null' if m is None else f'timestamp_seconds({m * 60})'}, {v})" for p, m, v in batch]
        frame = spark.sql(f"select place, cast(event_time as timestamp) event_time, cast(v as int) v from values {', '.join(at)} t(place, event_time, v)")
        target = folder / f"{i:04d}.parquet"
        frame.toPandas().to_parquet(target, coerce_timestamps="us")
        os.utime(target, (1_000_000 + i, 1_000_000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def replayed(batches, grain=60, lateness=60):
    """Totals and late rows of (place, minute, v) batches, in plain Python."""
    totals, late, newest = {}, [], None
    for number, batch in enumerate(batches):
        watermark = None if newest is None else newest - lateness
        for place, minute, v in batch:
            if minute is None:
                late.append((place, minute, v, "no time", number))
                continue
            start = minute // grain * grain
            if watermark is not None and start + grain <= watermark:
                late.append((place, minute, v, "too late", number))
                continue
            total = totals.setdefault((place, start), [0, 0])
            total[0] += v
            total[1] += 1
        newest = max([m for _, m, _ in batch if m is not None] + ([] if newest is None else [newest]), default=None)
    return sorted((p, s, *t) for (p, s), t in totals.items()), sorted(late, key=repr)


def drained(spark, stream, root):
    from placecount.streaming import ledger

    found = ledger.drain_totals(stream, "1 hour", "1 hour", root)
    totals = sorted((r.place, int(r.at), r.total_v, r.n) for r in found.rows.select("*", (F.unix_seconds("start") / 60).alias("at")).collect())
    late = found.late.select("place", (F.unix_seconds("event_time") / 60).cast("int").alias("m"), "v", "reason", "batch").collect()
    return totals, sorted(map(tuple, late), key=repr), found.late_rows


def test_late_rows_over_many_batches(spark, tmp_path):
    """Each row that comes too late is kept, over more batches than a query reports on."""
    import random

    r = random.Random(8)
    batches = []
    for i in range(104):
        now = 5_000 + 30 * i
        batch = [(r.choice("ab"), now + r.randrange(30), r.randrange(9)) for _ in range(3)]
        if i % 9 == 4:
            batch += [("a", now - 600 - k, 1) for k in range(5)]  # five rows of one place and window
        if i % 20 == 7:
            batch.append(("b", None, 2))
        batches.append(batch)
    root, folder = str(tmp_path / "run"), tmp_path / "in"
    stream = timed_files(spark, folder, batches[:102])
    totals, late, n = drained(spark, stream, root)
    want = replayed(batches[:102])
    assert (totals, late) == want
    assert n == sum(row[3] == "too late" for row in late) == 55
    # The watermark outlives the drain.
    stream = timed_files(spark, folder, [*batches[102:], [("a", 100, 7), ("c", 9_000, 1)]])
    totals, late, _ = drained(spark, stream, root)
    assert (totals, late) == replayed([*batches, [("a", 100, 7), ("c", 9_000, 1)]])


def test_a_drain_reads_one_snapshot_and_its_batches(spark, tmp_path):
    from placecount.streaming.ledger import Ledger

    root, folder = str(tmp_path / "run"), tmp_path / "in"
    batches = [[("a", 6_000 + 10 * i, i)] for i in range(6)]
    for i in range(0, 6, 2):
        stream = timed_files(spark, folder, batches[i : i + 2])
        assert drained(spark, stream, root)[0] == replayed(batches[: i + 2])[0]
        upto, path = Ledger(spark, root).snapshot()
        assert (upto, path) == (i + 1, f"snapshots/upto={i + 1}")
        names = sorted(p.name for p in (tmp_path / "run" / "deltas" / f"after={i - 1}").iterdir())
        assert names == [f"batch={i}", f"batch={i + 1}"]
    assert drained(spark, stream, root)[0] == replayed(batches)[0]  # nothing new
    assert Ledger(spark, root).snapshot()[0] == 5


def test_a_failed_merge_changes_nothing(spark, tmp_path, monkeypatch):
    """Without a manifest a snapshot does not count, and the next drain merges again."""
    from placecount.streaming import ledger

    root, folder = str(tmp_path / "run"), tmp_path / "in"
    batches = [[("a", 6_000, 1)], [("a", 6_001, 2)], [("b", 6_002, 4)]]
    drained(spark, timed_files(spark, folder, batches[:1]), root)

    def failing(self, *args):
        raise OSError("lost")

    whole = ledger.Ledger.merge
    monkeypatch.setattr(ledger.Ledger, "merge", failing)
    with pytest.raises(OSError):
        drained(spark, timed_files(spark, folder, batches[1:2]), root)
    monkeypatch.setattr(ledger.Ledger, "merge", whole)
    assert drained(spark, timed_files(spark, folder, batches[2:]), root)[0] == replayed(batches)[0]


def test_an_empty_stream(spark, tmp_path):
    from placecount.streaming import ledger

    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema("place string, event_time timestamp, v int").parquet(str(tmp_path / "in"))
    found = ledger.drain_totals(stream, root=str(tmp_path / "run"))
    assert found.rows.collect() == [] and found.late_rows == 0


def test_csv_streams_check_their_header(spark, tmp_path):
    from pyspark.errors import StreamingQueryException

    from placecount.operators.normalise import normalise
    from placecount.roles import OBS_SCHEMA
    from placecount.sources import read_stream

    header = "Date,Time,Junction,Vehicles,Accidents Reported,Weather,Road Condition\n"
    for name, first in (("good", header), ("bad", header.replace("Date,Time", "Time,Date"))):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.csv").write_text(first + "2025-04-01,08:30,A,3,0,Sunny,Smooth\n")
    good = normalise(read_stream(spark, str(tmp_path / "good"), OBS_SCHEMA, fmt="csv"))
    assert [tuple(r) for r in live.run_latest(good).collect()] == [("A", 3)]
    bad = normalise(read_stream(spark, str(tmp_path / "bad"), OBS_SCHEMA, fmt="csv"))
    with pytest.raises(StreamingQueryException):
        live.run_latest(bad)


def test_latest_equals_batch(spark, rows):
    got = live.run_latest(events_stream(spark, SF_DIR))
    assert rows(got) == rows(latest.latest(events(spark, SF_DIR)))


def test_latest_continues_from_its_checkpoint(spark, tmp_path, rows):
    """Files that arrive later, out of order, change only what they should."""
    source, checkpoint = tmp_path / "in", str(tmp_path / "state")
    every = events(spark, SF_DIR)
    every.filter("obs_date >= '2024-01-15'").write.parquet(str(source))

    def stream():
        return spark.readStream.schema(every.schema).parquet(str(source))

    first = rows(live.run_latest(stream(), checkpoint))
    every.filter("obs_date < '2024-01-15'").write.mode("append").parquet(str(source))
    second = rows(live.run_latest(stream(), checkpoint))
    assert second == rows(latest.latest(every))
    assert set(first) <= set(second)


def test_scores_equal_batch(spark, rows):
    obs = events(spark, SF_DIR)
    predictor = models.train(obs)
    columns = ("place", "obs_date", "hour", "seq")
    scored = live.run_available(
        live.score_stream(
            events_stream(spark, SF_DIR).select(*columns),
            predictor.count_model,
            predictor.condition_model,
        )
    )
    assert rows(scored) == rows(predictor.predict(obs.select(*columns)).select(*scored.columns))
