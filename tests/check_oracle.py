"""Compare queries with their SQL: ``python tests/check_oracle.py [sf_dir] [query ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(df, con, name: str) -> str:
    """Empty when query and SQL agree on columns, types and rows."""
    columns = sorted(df.columns)
    got = df.select(*columns).toArrow()
    sql = con.sql(entry.oracle_sql()[name]).to_arrow_table()
    if sorted(sql.column_names) != columns:
        return f"columns {columns} != {sorted(sql.column_names)}"
    want = sql.select(columns)
    kinds = [(c, str(got.schema.field(c).type), str(want.schema.field(c).type)) for c in columns]
    def plain(kind):
        return kind.replace("large_", "").replace("_view", "")
    differing = [k for k in kinds if plain(k[1]) != plain(k[2])]
    if differing:
        return f"types differ: {differing}"
    rows = [sorted(zip(*(t.column(c).to_pylist() for c in columns)), key=repr) for t in (got, want)]
    if rows[0] == rows[1]:
        return ""
    only = [sorted(set(a) - set(b), key=repr)[:3] for a, b in (rows, rows[::-1])]
    return f"{len(rows[0])} rows, SQL {len(rows[1])}; only in query {only[0]}; only in SQL {only[1]}"


def main() -> int:
    from dropweave.session import build_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
                          spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in names:
        began = time.time()
        try:
            problem = compare(entry.queries()[name](spark, sf_dir), con, name)
        except Exception as exc:  # report and go on with the other queries
            problem = f"{type(exc).__name__}: {str(exc)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:24s} {time.time() - began:6.2f}s {problem}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
