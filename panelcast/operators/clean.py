"""Raw trip records to hourly totals per series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from ..functions.text import map_values, parse_hour_stamp, remove_all
from ..spec import require_columns


@dataclass(frozen=True)
class TripColumns:
    """Column names of the raw records and of the cleaned result."""

    day: str = "transition_date"
    hour: str = "transition_hour"
    line: str = "line_name"
    station_code: str = "station_poi_desc_cd"
    count: str = "number_of_passage"
    mode: str = "road_type"
    station: str = "station"
    time: str = "timestamp"
    target: str = "passage"


@dataclass(frozen=True)
class TripRules:
    """Which records count, and how station names are unified."""

    mode: str
    lines: Sequence[str]
    removed: Sequence[str] = ()
    names: Mapping[str, str] = field(default_factory=dict)


def clean_trips(raw: DataFrame, rules: TripRules, columns: TripColumns = TripColumns()) -> DataFrame:
    """Sum of passages by (line, station, hour).

    Filters come first and reach the file scan; only six columns are read. The
    records are summed per raw (station code, day, hour) before the text work,
    so parsing and renaming run once per group instead of once per record. A
    group whose counts are all null sums to 0.
    """
    c = columns
    require_columns(raw, (c.day, c.hour, c.line, c.station_code, c.count, c.mode))
    kept = raw.where(
        (F.col(c.mode) == rules.mode)
        & F.col(c.line).isin(list(rules.lines))
        & F.col(c.station_code).isNotNull()
    )
    coarse = kept.groupBy(c.line, c.station_code, c.day, c.hour).agg(F.sum(c.count).alias(c.target))
    named = coarse.select(
        c.line,
        remove_all(F.col(c.station_code), rules.removed).alias(c.station),
        parse_hour_stamp(F.col(c.day), F.col(c.hour)).alias(c.time),
        c.target,
    )
    return (
        map_values(named, c.station, rules.names)
        .groupBy(c.line, c.station, c.time)
        .agg(F.coalesce(F.sum(c.target), F.lit(0)).alias(c.target))
    )
