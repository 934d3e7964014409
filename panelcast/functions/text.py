"""Text clean-up of series names and hour codes."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def pad_hour(hour: Column) -> Column:
    """Two-digit hour: 9 becomes ``09``; longer text stays, so that strict parsing refuses it."""
    text = hour.cast("string")
    return F.when(F.length(text) == 1, F.concat(F.lit("0"), text)).otherwise(text)


def join_text(*parts: Column | str, separator: str = "") -> Column:
    """Concatenate; null if any part is null (so not ``concat_ws``)."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    pieces = []
    for position, column in enumerate(columns):
        if position and separator:
            pieces.append(F.lit(separator))
        pieces.append(column.cast("string"))
    return F.concat(*pieces)


def parse_hour_stamp(day: Column, hour: Column) -> Column:
    """Zone-less timestamp from a day and an hour; a malformed value is an error."""
    text = join_text(day, join_text(pad_hour(hour), F.lit("00"), separator="-"), separator="-")
    return F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd-HH-mm"))


def remove_all(column: Column, patterns: Sequence[str]) -> Column:
    """Remove every listed literal, wherever it stands, in one pass."""
    if not patterns:
        return column
    return F.regexp_replace(column, "|".join(re.escape(p) for p in patterns), "")


def map_values(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """Replace whole values; others stay, replaced values are not looked up again."""
    return df.replace(dict(mapping), subset=[column]) if mapping else df
