"""Run registered queries and their comparison SQL side by side.

    python tests/conformance.py [folder] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wardline.plans import catalog  # noqa: E402


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, float) and math.isnan(value):
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float) and value == int(value) and abs(value) < 2**53:
        return int(value)
    return value


def rows_of(frame) -> list:
    frame = frame[sorted(frame.columns)]
    rows = [tuple(plain(v) for v in row) for row in frame.itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(spark, con, folder: str, name: str) -> str:
    """'' when equal, otherwise what differs."""
    ours = catalog.queries()[name](spark, folder).toPandas()
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        return "" if len(ours) else "no rows"
    theirs = con.execute(sql).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for c in sorted(ours.columns):
        if ours[c].dtype.kind != theirs[c].dtype.kind:
            print(f"    note: {name}.{c}: {ours[c].dtype} / {theirs[c].dtype}")
    a, b = rows_of(ours), rows_of(theirs)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}" if bad else ""


def main(argv: list[str]) -> int:
    from wardline.session import build_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(catalog.queries())
    spark = build_session(
        "conformance", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g",
                                     "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    for name in names:
        start = time.monotonic()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += bool(problem)
        mark = "R " if name not in catalog.oracle_sql() else "  "
        print(f"{'FAIL' if problem else 'ok  '} {mark}{name} {time.monotonic() - start:.1f}s {problem}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
