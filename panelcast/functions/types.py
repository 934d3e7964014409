"""Type-driven column selection and casts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F, types as T


def cast_where(df: DataFrame, matches: Callable[[T.DataType], bool], to: str | T.DataType) -> DataFrame:
    """Cast every column whose type matches, in one projection."""
    return df.select(
        *(
            F.col(f"`{field.name}`").cast(to).alias(field.name) if matches(field.dataType) else F.col(f"`{field.name}`")
            for field in df.schema.fields
        )
    )


def narrow_numeric(df: DataFrame) -> DataFrame:
    """Every numeric column to 32-bit float."""
    return cast_where(df, lambda t: isinstance(t, T.NumericType), T.FloatType())


def narrow_fractional(df: DataFrame) -> DataFrame:
    """Every floating-point column to 32-bit float."""
    return cast_where(df, lambda t: isinstance(t, (T.FloatType, T.DoubleType)), T.FloatType())


def narrow_double(df: DataFrame) -> DataFrame:
    """Only 64-bit floating-point columns to 32-bit float."""
    return cast_where(df, lambda t: isinstance(t, T.DoubleType), T.FloatType())


def is_integral(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)
