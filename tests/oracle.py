"""Compare a registered query with its SQL on the same parquet tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(round(value, 6) + 0.0)
    if isinstance(value, bool):
        return repr(value)
    return f"{type(value).__name__}:{value!r}"


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty if names and the multiset of rows agree."""
    want = con.execute(sql)
    want_columns = [d[0] for d in want.description]
    want_rows = rows_of(want_columns, want.fetchall())
    got_rows = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    out = []
    if sorted(want_columns) != sorted(spark_df.columns):
        out.append(f"columns {sorted(spark_df.columns)} != {sorted(want_columns)}")
    if len(want_rows) != len(got_rows):
        out.append(f"rows {len(got_rows)} != {len(want_rows)}")
    if not out and want_rows != got_rows:
        missing = [w for w in want_rows if w not in set(got_rows)][:3]
        extra = [g for g in got_rows if g not in set(want_rows)][:3]
        out.append(f"values differ: missing {missing} extra {extra}")
    if not out and not want_rows:
        out.append("both empty")
    return out
