"""From raw trips to the model-ready feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.time import seconds_between
from ..functions.types import narrow_numeric
from ..operators.clean import TripColumns, TripRules, clean_trips
from ..operators.date_features import add_date_features, distinct_days
from ..operators.densify import densify, time_axis, time_bounds
from ..operators.history import add_history_features
from ..session import cut_lineage
from ..sources.tables import write_features
from ..spec import DAY, PanelSpec
from . import presets


def grid_days(totals: DataFrame, spec: PanelSpec) -> DataFrame:
    """The days that the grid of ``totals`` has a step on: with steps of a day or less, all between its bounds."""
    if spec.step_seconds > DAY:
        return distinct_days(time_axis(totals, spec), spec.time)
    steps = F.floor(seconds_between(F.col("first_time"), F.col("last_time")) / spec.step_seconds)
    last = F.col("first_time") + F.make_dt_interval(secs=steps * spec.step_seconds)
    return time_bounds(totals, spec).select(F.explode(F.sequence(F.to_date("first_time"), F.to_date(last))).alias("day"))


def panel_features(
    totals: DataFrame,
    spec: PanelSpec,
    holidays: DataFrame,
    intervals: Sequence[str] = presets.INTERVALS,
    lags: Sequence[int] = presets.LAGS,
    horizon: int = presets.HORIZON_DAYS,
) -> DataFrame:
    """Grid, trailing statistics, lags and calendar of per-step totals, in full precision."""
    grid = densify(totals, spec)
    history = add_history_features(grid, spec, intervals=intervals, lags=lags, horizon=horizon)
    return add_date_features(history, spec.time, holidays, grid_days(totals, spec))


def build_features(
    raw: DataFrame,
    holidays: DataFrame,
    rules: TripRules = presets.RAIL_TRIPS,
    spec: PanelSpec = presets.PANEL,
    columns: TripColumns = TripColumns(),
    staged: bool = True,
    **settings,
) -> DataFrame:
    """Clean, sum, densify and derive all features; numeric columns become 32-bit floats.

    The totals are read several times (bounds, series, observations, days).
    ``staged`` writes them to the checkpoint folder first, so that the raw
    records are read once.
    """
    totals = clean_trips(raw, rules, columns)
    if staged:
        totals = cut_lineage(totals)
    return narrow_numeric(panel_features(totals, spec, holidays, **settings))


def run_feature_job(raw: DataFrame, holidays: DataFrame, path: str, **settings) -> None:
    """Build the feature table and write it, one folder per line."""
    write_features(build_features(raw, holidays, **settings), path)
