"""Compare queries with their SQL in DuckDB: python tests/oracle.py SF [NAME...]."""

from __future__ import annotations

import math
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def canonical_rows(columns: list[str], rows: list) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value) -> str:
        if value is None:
            return "null"
        if isinstance(value, bool):
            return str(value).lower()
        if isinstance(value, float):
            return "nan" if math.isnan(value) else f"{round(value, 6):.6f}"
        if type(value).__name__ == "Decimal":
            return f"{round(float(value), 6):.6f}"
        if isinstance(value, (list, tuple)):
            return "[" + ",".join(map(cell, value)) + "]"
        return str(value)

    return sorted("|".join(cell(row[i]) for i in order) for row in rows)


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def compare(spark, con, sf_dir: str, query, sql: str) -> str:
    df = query(spark, sf_dir)
    ours = canonical_rows(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    theirs = canonical_rows(columns, found.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} and {sorted(columns)}"
    if ours != theirs:
        only, other = sorted(set(ours) - set(theirs))[:3], sorted(set(theirs) - set(ours))[:3]
        return f"{len(ours)} and {len(theirs)} rows; only ours {only}; only theirs {other}"
    return ""


def main(sf: str, names: list[str]) -> int:
    import time

    import __spark_entry__ as entry

    from corvida.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/{sf}"
    con, bad = duck(sf_dir), 0
    queries, sql = entry.queries(), entry.oracle_sql()
    for name in names or sorted(sql):
        began = time.time()
        try:
            why = compare(spark, con, sf_dir, queries[name], sql[name])
        except Exception as e:  # noqa: BLE001
            why = "failed: " + str(e)[:600]
        bad += bool(why)
        print(f"{name}: {why[:900] or 'same'} ({time.time() - began:.1f} s)", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
