"""Run registered queries beside their SQL: ``python tests/compare.py SF_DIR [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    """Rows with columns by name, floats at 9 digits, in a sorted order."""

    def cell(x):
        if pd.isna(x):
            return None
        if isinstance(x, pd.Timestamp):
            return str(x.date())
        if hasattr(x, "item"):
            x = x.item()
        if isinstance(x, float):
            return int(x) if x == int(x) else float(f"{x:.9g}")
        return x

    frame = frame.astype(object)
    rows = [
        tuple(cell(x) for x in row)
        for row in frame[sorted(frame.columns)].itertuples(index=False, name=None)
    ]
    return sorted(
        [tuple(str(x) if not isinstance(x, (int, float, type(None))) else x for x in r) for r in rows],
        key=repr,
    )


def main(argv: list[str]) -> int:
    from placecount.plans import oracle_sql, queries
    from placecount.session import session

    spark = session(
        "compare",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    sf_dir, names = argv[0], argv[1:]
    con, sql = oracle_connection(sf_dir), oracle_sql()
    bad = 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = query(spark, sf_dir).toPandas()
        except Exception as error:
            bad += 1
            print(f"ERROR {name}: {str(error)[:1500]}", flush=True)
            continue
        took = time.time() - start
        if name not in sql:
            print(f"rows  {name} {len(got)} {took:.2f}s", flush=True)
            continue
        want = con.execute(sql[name]).df()
        a, b = canonical(got), canonical(want)
        ok = a == b and sorted(got.columns) == sorted(want.columns)
        bad += not ok
        print(f"{'ok   ' if ok else 'DIFF '} {name} {len(a)} {len(b)} {took:.2f}s", flush=True)
        if not ok:
            print("   ", sorted(got.columns), sorted(want.columns))
            print("   ", [r for r in a if r not in b][:3], [r for r in b if r not in a][:3])
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
