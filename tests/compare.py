"""Compare registered queries with their SQL: names, types and values, in any row order."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pyarrow as pa

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TYPE_NAMES = {"large_string": "string", "string_view": "string"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def _columns(table: pa.Table) -> dict[str, str]:
    names = sorted(table.column_names)
    kinds = {n: str(table.schema.field(n).type) for n in names}
    return {n: TYPE_NAMES.get(kind, kind) for n, kind in kinds.items()}


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    # Adding 0.0 turns the negative zero into zero.
    plain = [
        [v + 0.0 if isinstance(v, float) else v for v in table.column(n).to_pylist()]
        for n in names
    ]
    return sorted(zip(*plain), key=repr)


def difference(spark_df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same rows, else what differs first."""
    ours, theirs = spark_df.toArrow(), connection.execute(sql).to_arrow_table()
    if _columns(ours) != _columns(theirs):
        return f"columns: {_columns(ours)} against {_columns(theirs)}"
    left, right = _rows(ours), _rows(theirs)
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}: {left[:3]} against {right[:3]}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from session import local_session

    spark = local_session()
    connection = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                found = difference(df, connection, oracles[name])
            else:
                found = None if df.count() else "no rows"
        except Exception as problem:  # noqa: BLE001
            found = f"{type(problem).__name__}: {str(problem)[:1500]}"
        failed += found is not None
        kind = "sql" if name in oracles else "rows"
        print(f"{name:22} {kind:4} {time.time() - start:6.2f}s {found or 'same'}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
