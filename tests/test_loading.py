"""Readers, normalisation variants, cache, sinks."""

from datetime import date

import pytest
from pyspark.errors import AnalysisException

from placecount import OBS_SCHEMA, jobs
from placecount.operators import aggregates, filters
from placecount.operators.normalise import normalise
from placecount.roles import DATA_COLUMNS, OBS_COLUMNS
from placecount.sources import ObservationCache, export, land, load_report, read_obs
from placecount.sources.report import load_counts


@pytest.fixture
def load(spark, tmp_path):
    def write(text, **options):
        path = tmp_path / f"in{len(list(tmp_path.iterdir()))}.csv"
        path.write_text(text)
        return read_obs(spark, str(path), **options)

    return write


def only(df):
    return df.collect()[0]


def test_contract(small):
    assert small.dtypes == list(OBS_COLUMNS.items())


def test_three_ways_to_read_agree(spark, small_csv, rows):
    by_header = normalise(read_obs(spark, small_csv))
    fixed = normalise(read_obs(spark, small_csv, schema=OBS_SCHEMA))
    inferred = normalise(read_obs(spark, small_csv, infer=True))
    assert rows(by_header) == rows(fixed) == rows(inferred)


def test_inference_never_touches_time(spark, small_csv):
    raw = dict(read_obs(spark, small_csv, infer=True).dtypes)
    assert raw["Time"] == raw["Date"] == "string" and raw["Vehicles"] == "int"


def test_header_must_match_fixed_schema(load):
    swapped = "Time,Date,Junction,Vehicles,Accidents Reported,Weather,Road Condition\n"
    with pytest.raises(Exception, match="(?i)header"):
        load(swapped + "08:30,2025-04-01,A,1,0,Clear,Smooth\n", schema=OBS_SCHEMA).collect()


def test_missing_path(spark):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_obs(spark, "/nowhere/*.csv")


def test_several_paths(spark, small_csv):
    assert read_obs(spark, [small_csv, small_csv]).count() == 26


def test_hour_without_time(load):
    row = only(normalise(load("Date,Hour,Junction,Vehicles\n2025-04-01,9,A,3\n")))
    assert (row.hour, row.slot, row.slot_no, row.v) == (9, None, None, 3)


def test_neither_time_nor_hour(load):
    row = only(normalise(load("Date,Junction,Vehicles\n2025-04-01,A,3\n")))
    assert (row.hour, row.slot) == (12, None)


@pytest.mark.parametrize("name", ["Road Condition", "Road_Condition", "RoadCondition"])
def test_condition_spellings(load, name):
    row = only(normalise(load(f"Date,Time,Junction,Vehicles,{name}\n2025-04-01,08:00,A,3,Wet\n")))
    assert row.condition == "Wet"


def test_defaults_for_absent_columns(load):
    df = normalise(load("Time\n08:00\n"), default_date="2025-01-02")
    row = only(df)
    assert "weather" not in df.columns
    assert (row.obs_date, row.place, row.v, row.incidents, row.condition, row.dow) == (
        date(2025, 1, 2), "Default Junction", 0, 0, "Normal", 0,
    )


def test_current_date_by_default(spark, load):
    row = only(normalise(load("Time,Junction\n08:00,A\n")))
    assert row.obs_date == spark.sql("select current_date()").first()[0]


def test_lower_case_headers_and_extra_columns(load):
    df = normalise(load("date,time,junction,vehicles,noise\n2025-04-01,08:00,A,3,x\n"))
    assert "noise" not in df.columns and only(df).v == 3


def test_unpadded_and_odd_times(load):
    text = "Date,Time,Junction,Vehicles\n" + "".join(
        f"2025-04-01,{t},A,1\n" for t in ("8:30", "08:30:15", "25:00", "noon", "")
    )
    got = [(r.slot, r.hour, r.slot_no) for r in normalise(load(text)).collect()]
    assert got == [
        ("08:30", 8, 30600), ("08:30:15", 8, 30615), ("25:00", 25, None),
        ("noon", None, None), (None, None, None),
    ]


def test_counts_missing_or_text(load):
    text = "Date,Time,Junction,Vehicles\n" + "".join(
        f"2025-04-01,08:00,A,{v}\n" for v in ("", "n/a", "12.7", "7", "3000000000", "-4")
    )
    zero = [r.v for r in normalise(load(text)).collect()]
    keep = [r.v for r in normalise(load(text), null_v="keep").collect()]
    assert zero == [0, None, 12, 7, None, -4]
    assert keep == [None, None, 12, 7, None, -4]
    with pytest.raises(ValueError):
        normalise(load(text), null_v="drop")


def test_fractional_numbers_truncate(spark):
    df = spark.createDataFrame([("A", 12.7)], "Junction string, Vehicles double")
    assert only(normalise(df)).v == 12


def test_bad_date(load):
    row = only(normalise(load("Date,Time,Junction,Vehicles\n01/04/2025,08:00,A,3\n")))
    assert (row.obs_date, row.dow) == (None, None)


def test_given_weekday_wins(load):
    row = only(normalise(load("Date,Time,DayOfWeek\n2025-04-01,08:00,7\n")))
    assert row.dow == 7


def test_header_only_file(load):
    df = normalise(load("Date,Time,Junction,Vehicles\n"))
    assert df.isEmpty() and aggregates.daily(df).isEmpty()


def test_rows_without_place(load):
    text = "Date,Time,Junction,Vehicles\n2025-04-01,08:00,,3\n"
    assert normalise(load(text)).count() == 1
    assert normalise(load(text), drop_null_place=True).isEmpty()


def test_text_and_numeric_columns_agree(load, spark):
    text = "Date,Time,Junction,Vehicles,Accidents Reported\n2025-04-01,08:00,A,100.0,1.0\n"
    row = only(normalise(load(text)))
    assert (row.v, row.incidents) == (100, 1)


def test_unreadable_numbers_are_in_no_mean(load):
    text = "Date,Time,Junction,Vehicles\n2025-04-01,08:00,A,10\n2025-04-01,08:00,A,many\n"
    means = aggregates.avg_by_condition(normalise(load(text)))
    assert only(means).avg_v == 10.0


def test_dates_and_incidents_have_reasons(load):
    text = (
        "Date,Time,Junction,Vehicles,Accidents Reported\n"
        "2025-04-01 00:00:00,08:00,A,3,0\n2025-04-01,08:00,A,3,few\n2025-04-01,08:00,A,3,0\n"
    )
    reasons = [r.reason for r in filters.quarantine(normalise(load(text)), need_slot=True).collect()]
    assert sorted(reasons) == ["no date", "unreadable incidents"]


def test_rejected_rows_have_reasons(load):
    text = "Date,Time,Junction,Vehicles\n2025-04-01,,A,3\n2025-04-01,08:00,,3\n"
    df = normalise(load(text))
    assert {r.reason for r in filters.quarantine(df, need_slot=True).collect()} == {
        "no slot", "no place",
    }
    assert filters.valid_rows(df).count() == 1


def test_load_report(small):
    report = load_report(small)
    assert report.columns == small.columns and len(report.sample.collect()) == 5
    report.observed.groupBy("place").count().collect()
    assert report.rows() == 13
    counts = {r["name"]: r["non_null"] for r in load_counts(small).collect()}
    assert counts["v"] == 12 and counts["place"] == 12 and counts["slot"] == 13


def test_cache_is_keyed_by_path(spark, small_csv):
    loads = []

    def load_path(path):
        loads.append(path)
        return normalise(read_obs(spark, path))

    cache = ObservationCache(load_path)
    first = cache.get(small_csv)
    assert cache.get(small_csv) is first and first.is_cached and len(loads) == 1
    other = cache.replace(small_csv, normalise(read_obs(spark, small_csv)).filter("v > 0"))
    assert cache.get(small_csv) is other and not first.is_cached
    cache.release()
    assert not other.is_cached
    cache.get(small_csv)
    assert len(loads) == 2
    cache.release(small_csv)


def test_land_and_read_back(spark, small, tmp_path, rows):
    path = str(tmp_path / "landed")
    land(small, path)
    back = normalise(read_obs(spark, path, fmt="parquet"), null_v="keep")
    assert rows(back.select(*DATA_COLUMNS, "seq")) == rows(small.select(*DATA_COLUMNS, "seq"))
    pruned = filters.where_dates(back, "2025-04-03", "2025-04-03")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(obs_date" in plan


def test_export(spark, small, tmp_path, rows):
    report = aggregates.report(small)
    export(report, str(tmp_path / "report"), fmt="csv", partition_by=None)
    back = spark.read.option("header", True).csv(str(tmp_path / "report"))
    assert back.columns == report.columns and back.count() == 6
    daily = aggregates.daily(small, "A")
    export(daily, str(tmp_path / "daily"))
    assert rows(spark.read.parquet(str(tmp_path / "daily")).select("obs_date", "total_v")) == rows(
        daily
    )


def test_command_line(small_csv, spark, capsys, monkeypatch):
    monkeypatch.setattr(jobs, "session", lambda *a, **k: spark)
    assert jobs.main([small_csv]) == 0
    assert "13 rows" in capsys.readouterr().out
    assert jobs.main([]) == 2
