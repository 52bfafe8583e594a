"""Run every query and its SQL on one scale folder and compare rows, columns and types.

usage: python tools/compare.py [folder] [key prefix ...]
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

import duckdb
import pyarrow as pa

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from lakesift.probes import load_all  # noqa: E402
from lakesift.probes.registry import NAMES  # noqa: E402
from lakesift.session import build  # noqa: E402


def rows_of(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    cols = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*cols), key=repr) if cols else []


def type_of(t: pa.DataType) -> str:
    text = str(t).replace("large_", "")
    return "timestamp" if text.startswith("timestamp") else text


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    os.chdir(tempfile.mkdtemp(prefix="run-"))
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build(
        "compare", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("OFF")
    con = duckdb.connect()
    for n in NAMES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{folder}/{n}.parquet')")
    bad = 0
    for key, p in load_all().items():
        if prefixes and not key.startswith(prefixes):
            continue
        start = time.time()
        try:
            got = p.run(spark, folder).toArrow()
        except Exception as e:  # noqa: BLE001
            print(f"ERROR {key}: {type(e).__name__}: {str(e)[:600]}")
            bad += 1
            continue
        took = time.time() - start
        if p.sql is None:
            print(f"rows  {key}: {got.num_rows} rows {took:.2f}s")
            continue
        want = con.execute(p.sql).to_arrow_table()
        problems = []
        if sorted(got.column_names) != sorted(want.column_names):
            problems.append(f"columns {got.column_names} / {want.column_names}")
        else:
            for n in got.column_names:
                a, b = type_of(got.schema.field(n).type), type_of(want.schema.field(n).type)
                if a != b:
                    problems.append(f"type of {n}: {a} / {b}")
            a, b = rows_of(got), rows_of(want)
            if a != b:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
                problems.append(f"rows {len(a)} / {len(b)}, first differences {diff}")
        bad += bool(problems)
        print(f"{'BAD  ' if problems else 'ok   '} {key}: {got.num_rows} rows {took:.2f}s {'; '.join(problems)}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
