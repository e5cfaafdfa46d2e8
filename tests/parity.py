"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return float(f"{value:.12g}")
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs first."""
    result = con.execute(sql)
    names = [item[0] for item in result.description]
    kinds = {item[0]: KINDS.get(str(item[1]), str(item[1])) for item in result.description}
    expected = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = dict(df.dtypes)
    wrong = {name: (types[name], kinds[name]) for name in names if types[name] != kinds[name]}
    if wrong:
        return f"types (spark, duckdb) {wrong}"
    actual = rows_of(df.columns, df.collect())
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    for got, want in zip(actual, expected):
        if got != want:
            return f"{sorted(names)}\n  spark  {got}\n  duckdb {want}"
    return None
