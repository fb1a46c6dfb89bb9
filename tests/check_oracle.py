"""Compare registered queries with their SQL: ``check_oracle.py [sf_dir] [query …]``."""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, float) and math.isnan(value):
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, (bool, str)):
        return value
    if isinstance(value, (int, float)):
        return round(float(value), 9)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: [(v is None, str(v)) for v in r])


def compare(spark, con, name: str, sf_dir: str):
    """None when equal, else a description of the first difference."""
    df = entry.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(entry.oracle_sql()[name])
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        extra = [r for r in got[1] if r not in set(want[1])][:1]
        missing = [r for r in want[1] if r not in set(got[1])][:1]
        return f"rows {len(got[1])} != {len(want[1])}; only here {extra}; only SQL {missing}"
    wanted, mine = set(want[1]), set(got[1])
    a, b = [r for r in got[1] if r not in wanted], [r for r in want[1] if r not in mine]
    if a or b:
        return f"{len(a)} rows differ; here {a[0] if a else None}\n      SQL {b[0] if b else None}"
    return None if got[1] else "no rows"


def main() -> int:
    from corpuslake.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session(
        "check", f"local[{os.environ.get('CHECK_CPUS', '8')}]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="corpuslake-check-"),
    )
    spark.sparkContext.setLogLevel("OFF")
    con, bad = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir) if name in entry.oracle_sql() else "no SQL"
        except Exception as err:  # report and go on with the other queries
            problem = f"{type(err).__name__}: {str(err)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'DIFF'} {name:24s} {time.time() - start:6.1f}s {problem or ''}"[:1500], flush=True)
    print(f"{len(names) - bad}/{len(names)} equal")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
