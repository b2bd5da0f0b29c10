"""Row-for-row comparison of a Spark result with a DuckDB result."""

import math
from collections import Counter
from pathlib import Path

import duckdb

TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 5) + 0.0
    return value


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str, limit: int = 5) -> list[str]:
    """Empty when columns, types and the multisets of rows agree."""
    cursor = con.execute(sql)
    expected_types = {c[0]: TYPES.get(str(c[1]), str(c[1])) for c in cursor.description}
    expected_rows = cursor.fetchall()
    actual_types = dict(spark_df.dtypes)
    found = []
    if expected_types != actual_types:
        diff = {c: (actual_types.get(c), expected_types.get(c)) for c in actual_types.keys() | expected_types.keys()}
        found.append(f"types (spark, sql): { {c: t for c, t in diff.items() if t[0] != t[1]} }")
    if set(expected_types) != set(actual_types):
        return found
    names = sorted(actual_types)
    at = [list(expected_types).index(n) for n in names]
    expected = Counter(tuple(_cell(row[i]) for i in at) for row in expected_rows)
    actual = Counter(tuple(_cell(row[n]) for n in names) for row in spark_df.collect())
    if expected != actual:
        found.append(f"rows: spark {actual.total()}, sql {expected.total()}, columns {names}")
        found += [f"only spark: {row}" for row in list((actual - expected))[:limit]]
        found += [f"only sql:   {row}" for row in list((expected - actual))[:limit]]
    return found
