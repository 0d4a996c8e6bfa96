"""Run queries against their check SQL in DuckDB; also usable from the shell.

    python -m tests.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = []
    for row in frame.itertuples(index=False, name=None):
        cells = []
        for value in row:
            if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
                cells.append("~")
            elif isinstance(value, bool):
                cells.append(str(value))
            elif hasattr(value, "isoformat"):
                cells.append(pd.Timestamp(value).isoformat())
            elif isinstance(value, float) or type(value).__name__.startswith("float"):
                cells.append(repr(float(value)))
            elif value is pd.NA:
                cells.append("~")
            else:
                cells.append(str(value))
        rows.append(tuple(cells))
    return sorted(rows)


def difference(actual: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    """First difference between two results, or None."""
    if sorted(actual.columns) != sorted(expected.columns):
        return f"columns {sorted(actual.columns)} != {sorted(expected.columns)}"
    for column in actual.columns:
        a, b = actual[column], expected[column]
        if pd.api.types.is_integer_dtype(a) and pd.api.types.is_float_dtype(b):
            if b.notna().all() and (b == b.round()).all():
                return f"{column}: integer against {b.dtype}"
    left, right = _normal_ints(actual, expected)
    one, two = _canonical(left), _canonical(right)
    if len(one) != len(two):
        return f"{len(one)} rows != {len(two)}"
    for x, y in zip(one, two):
        if x != y:
            return f"{str(x)[:300]} != {str(y)[:300]}"
    return None


def _normal_ints(a: pd.DataFrame, b: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Columns with nulls come back as floats on one side only; make them alike."""
    a, b = a.copy(), b.copy()
    for column in a.columns:
        kinds = {pd.api.types.is_float_dtype(f[column]) for f in (a, b)}
        if kinds == {True, False}:
            for frame in (a, b):
                if pd.api.types.is_numeric_dtype(frame[column]) or frame[column].dtype == object:
                    try:
                        frame[column] = frame[column].astype("Int64")
                    except (TypeError, ValueError):
                        pass
    return a, b


def check(spark, con, folder: str, query) -> tuple[str, float, int]:
    started = time.time()
    actual = query.run(spark, folder).toPandas()
    seconds = time.time() - started
    if query.sql is None:
        return ("rows only" if len(actual) else "EMPTY"), seconds, len(actual)
    expected = con.execute(query.sql).df()
    found = difference(actual, expected)
    return (found or "ok"), seconds, len(actual)


def main(argv: list[str]) -> int:
    from forumtide.plans.catalog import load_all
    from forumtide.session import build_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    queries = load_all()
    names = argv[1:] or list(queries)
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                              "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in names:
        try:
            verdict, seconds, rows = check(spark, con, folder, queries[name])
        except Exception as error:  # report and go on to the next query
            lines = str(error).strip().splitlines()
            verdict, seconds, rows = f"ERROR {type(error).__name__}: {' '.join(lines[:3])[:600]}", 0, 0
            if "-v" in sys.argv:
                traceback.print_exc()
        good = verdict in ("ok", "rows only")
        bad += not good
        print(f"{'  ' if good else '✗ '}{name:26s} {seconds:6.2f}s {rows:7d}  {verdict}", flush=True)
    print(f"{len(names) - bad} good, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main([a for a in sys.argv[1:] if a != "-v"]))
