"""Folders of mixed headers, broken lines, and changed sources."""

import gzip

import pytest
from pyspark.errors import AnalysisException

from placecount.operators import filters
from placecount.operators.normalise import normalise
from placecount.sources import ObservationCache, layouts, read_layouts, read_obs

FULL = "Date,Time,Junction,Vehicles,Accidents Reported,Weather,Road Condition\n"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()

    def write(name, text):
        path = tmp_path / "in" / name
        path.write_bytes(gzip.compress(text.encode()) if name.endswith("gz") else text.encode())
        return str(tmp_path / "in")

    return write


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_each_file_by_its_own_header(spark, folder):
    folder("a.csv", FULL + "2025-04-01,08:30,A,3,1,Sunny,Smooth\n")
    folder("b.csv", "VEHICLES,junction\r\n7,B\r\n")
    folder("c.csv.gz", "﻿time,junction,vehicles\n9:00,C,5\n")
    path = folder("d.csv", FULL + "2025-04-02,09:30,A,4,0,,Smooth\n")
    folder("empty.csv", "")
    got = read_layouts(spark, path, default_date="2025-05-05")
    assert values(got, "obs_date", "place", "hour", "v", "incidents", "condition", "dow") == sorted(
        [
            (d(2025, 4, 1), "A", 8, 3, 1, "Smooth", 2),
            (d(2025, 4, 2), "A", 9, 4, 0, "Smooth", 3),
            (d(2025, 5, 5), "B", 12, 7, 0, "Normal", 0),
            (d(2025, 5, 5), "C", 9, 5, 0, "Normal", 0),
        ],
        key=repr,
    )
    assert got.select("seq").distinct().count() == 4
    assert values(got.where("broken is not null"), "line") == []


def d(*parts):
    from datetime import date

    return date(*parts)


def test_one_layout_reads_as_before(spark, small_csv):
    got, want = read_layouts(spark, small_csv, null_v="keep"), normalise(read_obs(spark, small_csv), null_v="keep")
    columns = [c for c in want.columns if c != "seq"]
    assert values(got, *columns) == values(want, *columns)


LINES = {
    "2025-04-01,08:30,A,3": layouts.TOO_FEW,
    "2025-04-01,08:30,A,3,0,Sunny,Smooth,x,y": layouts.TOO_MANY,
    '2025-04-01,08:30,"A,3,0,Sunny,Smooth': layouts.UNCLOSED,
    '2025-04-01,08:30,A,3,0,Sunny,"Smooth': layouts.UNCLOSED,
    '"2025-04-01,08:30,A,3,0,Sunny,Smooth': layouts.UNCLOSED,
    "lonely": layouts.TOO_FEW,
}
GOOD = {
    '2025-04-01,08:30,"B, C",3,0,Sunny,Smooth': ("B, C", 3),
    '2025-04-01,08:30,"B ""x"", C",3,0,Sunny,"Smooth, wet"': ('B "x", C', 3),
    "2025-04-01,08:30,D,4,0,,": ("D", 4),
    '2025-04-01,08:30,5" pipe,4,0,,"a, b"': ('5" pipe', 4),
}


@pytest.mark.parametrize("escape", ['"', "\\"])
def test_broken_lines_are_told_apart(spark, folder, escape):
    lines = [line.replace('""', f'{escape}"') for line in GOOD]
    text = FULL + "\n".join([*LINES, "", *lines, FULL.strip()]) + "\n"
    got = read_layouts(spark, folder("a.csv", text), escape=escape, null_v="keep")
    assert got.count() == len(LINES) + len(GOOD)
    bad = filters.quarantine(got)
    assert values(bad, "line", "reason") == sorted(LINES.items(), key=repr)
    assert all(r.file.endswith("/in/a.csv") for r in bad.collect())
    good = filters.valid_rows(got)
    assert {r[0] for r in values(good, "place")} == {'B, C', 'B "x", C', "D", '5" pipe'}
    assert good.where("line is not null").count() == 0
    assert bad.select("reason").count() == len(LINES)  # without any parsed column


def test_long_quoted_fields(spark, folder):
    """Neither a long field nor many escaped quotes exhaust the stack."""
    text = FULL + f'2025-04-01,08:30,"{"x" * 200_000}",3,0,Sunny,"{chr(34) * 2_000}"\n'
    got = read_layouts(spark, folder("a.csv", text), escape='"')
    assert [len(r.place) for r in filters.valid_rows(got).collect()] == [200_000]


def test_headers_that_say_nothing(spark, folder, tmp_path):
    path = folder("a.csv", "2025-04-01,08:30,A,3,0,Sunny,Smooth\n")
    with pytest.raises(ValueError, match="no known column in the header of .*a.csv"):
        read_layouts(spark, path)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_layouts(spark, str(tmp_path / "nowhere"))
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.csv").write_text("")
    with pytest.raises(ValueError, match="no file with a header"):
        read_layouts(spark, str(tmp_path / "none"))


def test_headers_by_a_scan_are_the_same(spark, folder):
    for i in range(5):
        path = folder(f"{i}.csv", ("place,v\n" if i % 2 else FULL) + "x,1\n" * 50)
    opened, scanned = (
        {(r.path.rpartition("/")[2], r.header) for r in f(spark, path).collect()}
        for f in (layouts.first_lines, layouts._first_lines_by_scan)
    )
    assert opened == scanned and len(opened) == 5


def test_long_headers(spark, folder, monkeypatch):
    monkeypatch.setattr(layouts, "FIRST_BYTES", 7)
    got = read_layouts(spark, folder("a.csv", FULL + "2025-04-01,08:30,A,3,1,Sunny,Smooth\n"))
    assert values(got, "place", "v") == [("A", 3)]


def test_repeated_and_taken_names(spark, folder):
    text = "Junction,Vehicles,JUNCTION,broken,line,file,seq\nA,3,B,x,y,z,9\n"
    assert values(read_layouts(spark, folder("a.csv", text)), "place", "v", "broken", "line", "seq") == [("A", 3, None, None, 9)]


def test_a_changed_folder_is_read_again(spark, folder):
    path, loads = folder("a.csv", "place,v\nA,1\n"), []

    def load(p):
        loads.append(p)
        return read_layouts(spark, p)

    cache = ObservationCache(load)
    first = cache.get(path)
    assert values(first, "place", "v") == [("A", 1)]
    assert cache.get(path) is first and len(loads) == 1
    folder("b.csv", "place,v\nB,2\n")
    assert values(cache.get(path), "place", "v") == [("A", 1), ("B", 2)]
    assert not first.is_cached and len(loads) == 2
    folder("b.csv", "place,v\nB,22\n")
    assert values(cache.get(path), "place", "v") == [("A", 1), ("B", 22)]
    kept = cache.replace(path, first.limit(0))
    folder("b.csv", "place,v\nB,333\n")
    assert cache.get(path) is kept
    cache.release()
    assert values(cache.get(path), "v") == [(1,), (333,)]
    cache.release()
