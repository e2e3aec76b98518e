"""Run every registered query and its SQL counterpart, and compare types and rows.

    python tools/check_oracle.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from millrace.queries import QUERIES  # noqa: E402
from millrace.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        files = f"{path}/*.parquet" if path.is_dir() else str(path)
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{files}')")
    return db


def kind(t: pa.DataType) -> str:
    if pa.types.is_timestamp(t):
        return "timestamp" + ("tz" if t.tz else "")
    return {"large_string": "string", "string_view": "string", "date32[day]": "date"}.get(str(t), str(t))


def plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def rows(t: pa.Table) -> Counter:
    names = sorted(t.column_names)
    columns = [t.column(n).to_pylist() for n in names]
    return Counter(tuple(plain(v) for v in row) for row in zip(*columns))


def compare(got: pa.Table, want: pa.Table) -> list[str]:
    found = []
    types_got = {f.name: kind(f.type) for f in got.schema}
    types_want = {f.name: kind(f.type) for f in want.schema}
    if types_got != types_want:
        found.append(f"types differ: {sorted(set(types_got.items()) ^ set(types_want.items()))}")
    if got.num_rows != want.num_rows:
        found.append(f"{got.num_rows} rows, not {want.num_rows}")
    if set(types_got) == set(types_want):
        a, b = rows(got), rows(want)
        if a != b:
            found.append(f"only in Spark {list((a - b).items())[:3]}; only in SQL {list((b - a).items())[:3]}")
    return found


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(options.sf)
    failed = 0
    for name in options.names or QUERIES:
        item = QUERIES[name]
        start = time.time()
        try:
            got = item.run(spark, options.sf).toArrow()
            spent = time.time() - start
            found = compare(got, db.sql(item.sql).to_arrow_table()) if item.sql else []
        except Exception as error:  # report and go on with the next query
            spent, found, got = time.time() - start, [f"{type(error).__name__}: {str(error)[:600]}"], None
        failed += bool(found)
        size = got.num_rows if got is not None else "-"
        print(f"{'FAIL' if found else 'ok  '} {name:26} {spent:6.2f}s {size:>8} rows", *found, flush=True)
    print(f"{failed} failed of {len(options.names or QUERIES)}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
