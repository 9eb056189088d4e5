"""Compare a Spark result with a DuckDB result as a multiset of rows.

Used by the tests on small fixtures only: both results are brought into the
test process, which is fine for a few thousand rows and never done by the
library itself.
"""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame


TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_connection(base_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TEST_TABLES:
        con.execute(
            f"create view {name} as select * from read_parquet('{base_dir}/{name}.parquet')"
        )
    return con


def _norm(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 6)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows_of_spark(df: DataFrame) -> tuple[list[str], Counter]:
    cols = sorted(df.columns)
    rows = df.select(*cols).collect()
    return cols, Counter(tuple(_norm(r[c]) for c in cols) for r in rows)


def rows_of_duckdb(con, sql: str) -> tuple[list[str], Counter]:
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = rel.fetchall()
    return [names[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(df: DataFrame, con, sql: str) -> tuple[bool, str]:
    s_cols, s_rows = rows_of_spark(df)
    d_cols, d_rows = rows_of_duckdb(con, sql)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duckdb={d_cols}"
    if s_rows != d_rows:
        only_s = list((s_rows - d_rows).elements())[:5]
        only_d = list((d_rows - s_rows).elements())[:5]
        return False, (
            f"rows differ: spark={sum(s_rows.values())} duckdb={sum(d_rows.values())}; "
            f"only spark {only_s}; only duckdb {only_d}"
        )
    return True, f"{sum(s_rows.values())} rows equal"


def compare_frames(df: DataFrame, con, sql: str) -> tuple[bool, str]:
    """Stricter form: both results as pandas frames (columns sorted by name,
    rows sorted) must be equal including dtypes."""
    import pandas as pd

    s = df.toPandas()
    d = con.sql(sql).df()
    s, d = s[sorted(s.columns)], d[sorted(d.columns)]
    if list(s.columns) != list(d.columns):
        return False, f"columns differ: {list(s.columns)} vs {list(d.columns)}"
    s = s.sort_values(list(s.columns)).reset_index(drop=True)
    d = d.sort_values(list(d.columns)).reset_index(drop=True)
    try:
        pd.testing.assert_frame_equal(s, d, check_dtype=True)
    except AssertionError as exc:
        return False, str(exc)[:500]
    return True, f"{len(s)} rows equal"
