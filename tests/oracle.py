"""Compare a registered query with its SQL on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def duckdb_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    connection = duckdb.connect()
    for table in Path(sf_dir).glob("*.parquet"):
        connection.execute(
            f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')"
        )
    result = connection.execute(sql)
    return [column[0] for column in result.description], result.fetchall()


def _cell(value: object) -> str:
    if isinstance(value, float) and not math.isnan(value):
        return f"{value:.9g}"
    return repr(value)


def normalized(columns: list[str], rows: list) -> list[tuple[str, ...]]:
    """Rows as sorted text, columns in name order."""
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def mismatch(spark, query, sql: str, sf_dir: str) -> str | None:
    """Describe how the two results differ; None if they agree."""
    df = query(spark, sf_dir)
    columns, expected = duckdb_rows(sql, sf_dir)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    actual = normalized(df.columns, df.collect())
    wanted = normalized(columns, expected)
    if len(actual) != len(wanted):
        return f"{len(actual)} rows != {len(wanted)}"
    for left, right in zip(actual, wanted):
        if left != right:
            return f"{left} != {right}"
    return None
