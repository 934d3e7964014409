"""Small column-set helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..spec import require_columns


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; a name that does not exist is an error."""
    require_columns(df, names)
    return df.drop(*names)


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most that many rows (counts no further than one beyond)."""
    return df.limit(rows + 1).count() <= rows
