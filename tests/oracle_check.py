"""Compare registered queries with their SQL: `python tests/oracle_check.py [sf_dir] [names...]`."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(directory) / f"{name}.parquet"
        if path.exists():
            files = f"{path}/*.parquet" if path.is_dir() else path
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{files}')")
    return con


# What an engine calls a type, by the kind of value it delivers.
KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def compare(spark_df, con, sql: str) -> tuple[str, int]:
    """("ok" or what differs, number of rows), columns by name and rows in any order."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    columns = sorted(names)
    if sorted(spark_df.columns) != columns:
        return f"columns {sorted(spark_df.columns)} != {columns}", 0
    wrong = {c: (t, kinds[c]) for c, t in spark_df.dtypes if KINDS.get(t, t) != kinds[c]}
    if wrong:
        return f"types {wrong}", 0
    order = [names.index(c) for c in columns]
    expected = sorted((repr(tuple(r[i] for i in order)) for r in result.fetchall()))
    actual = sorted(repr(tuple(r)) for r in spark_df.select(*[f"`{c}`" for c in columns]).collect())
    if actual == expected:
        return "ok", len(actual)
    extra = sorted(set(actual) - set(expected))[:2]
    missing = sorted(set(expected) - set(actual))[:2]
    return f"rows {len(actual)} != {len(expected)}; spark {extra}; sql {missing}", len(actual)


def main() -> None:
    import __spark_entry__ as entry
    from conftest import session

    directory = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con = session(), connect(directory)
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = entry.queries()[name](spark, directory)
            sql = entry.oracle_sql().get(name)
            verdict, rows = compare(df, con, sql) if sql else ("no sql", len(df.collect()))
        except Exception as error:  # report every query, whatever happens to one
            verdict, rows = f"{type(error).__name__}: {str(error)[:600]}", 0
        failed += verdict not in ("ok", "no sql")
        print(f"{name:30} {rows:>8} {time.time() - start:6.2f}s {verdict}", flush=True)
    print(f"{failed} of {len(names)} differ")


if __name__ == "__main__":
    main()
