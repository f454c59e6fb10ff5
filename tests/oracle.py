"""Compare a query with its SQL: names, types and the bag of rows, exactly."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def _rows(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    rows = [tuple(_plain(v) for v in row) for row in zip(*columns, strict=True)]
    return names, sorted(rows, key=repr)


def _types(table):
    return {f.name: str(f.type).replace("item: ", "").replace("element: ", "") for f in table.schema}


def differences(spark_table, duck_table) -> list[str]:
    out = []
    a_names, a = _rows(spark_table)
    b_names, b = _rows(duck_table)
    if a_names != b_names:
        return [f"columns {a_names} != {b_names}"]
    ta, tb = _types(spark_table), _types(duck_table)
    for n in a_names:
        if ta[n] != tb[n] and not ta[n].startswith("list"):
            out.append(f"type of {n}: {ta[n]} != {tb[n]}")
    if len(a) != len(b):
        out.append(f"rows {len(a)} != {len(b)}")
    if a != b:
        extra = [x for x, y in zip(a, b) if x != y][:2]
        other = [y for x, y in zip(a, b) if x != y][:2]
        out.append(f"values differ: {str(extra)[:600]} / {str(other)[:600]}")
    return out


def arrow(df):
    return df.toArrow()


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from conftest import make_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = make_session()
    con = database(sf_dir)
    bad = 0
    for name, fn in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            got = arrow(fn(spark, sf_dir))
            sql = oracle_sql().get(name)
            found = differences(got, con.sql(sql).to_arrow_table()) if sql else []
            note = f"{got.num_rows} rows" + ("" if sql else " (no SQL)")
        except Exception as error:  # noqa: BLE001
            found, note = [f"{type(error).__name__}: {str(error)[:1200]}"], ""
        bad += bool(found)
        print(f"{'BAD ' if found else 'ok  '}{name:32}{time.time() - start:6.2f}s {note}", flush=True)
        for line in found:
            print("     ", line)
    print("bad:", bad)
