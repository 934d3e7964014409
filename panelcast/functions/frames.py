"""Trailing-frame statistics as native window aggregates, for panels of any shape."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from ..spec import DAY, PanelSpec, Span
from .sliding import STATISTICS, FROM_VALUES
from .time import epoch_seconds, minus, quoted

def range_frame(partition: list[str], time: str, earliest: str, latest: str) -> str:
    """OVER clause of a time-range frame."""
    keys = ", ".join(quoted(name) for name in partition)
    return f"OVER (PARTITION BY {keys} ORDER BY {quoted(time)} RANGE BETWEEN {earliest} AND {latest})"


def point_before(column: str, partition: list[str], time: str, span: Span) -> Column:
    """The value exactly ``span`` earlier, null if there is no such row."""
    at = f"{span.sql} PRECEDING"
    return F.expr(f"first({quoted(column)}) {range_frame(partition, time, at, at)}")


def sample_skew(n: Column, g1: Column) -> Column:
    """Bias-corrected skewness from the population one; null below three values."""
    return F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(n: Column, g2: Column) -> Column:
    """Bias-corrected excess kurtosis from the population one; null below four values."""
    return F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def frame_statistics(spec: PanelSpec, partition: list[str], span: Span, target_type: T.DataType) -> Column:
    """Struct of the thirteen statistics over the trailing ``span``, both ends included.

    A month span is not used as a frame bound: near month ends its start moves
    backwards (29, 30 and 31 March all start on 28 February), which a sliding
    frame does not follow. For any one row it is a whole number of days, so the
    frames of each possible length are declared and the row picks its own.
    """
    if span.months is None:
        return _fixed_frame(spec, partition, span, target_type)
    now = F.col(spec.time)
    days = (epoch_seconds(now) - epoch_seconds(minus(now, span))) / DAY
    chosen = None
    for length in span.day_lengths:
        frame = _fixed_frame(spec, partition, Span(length, "DAY"), target_type)
        chosen = F.when(days == length, frame) if chosen is None else chosen.when(days == length, frame)
    return chosen


def _fixed_frame(spec: PanelSpec, partition: list[str], span: Span, target_type: T.DataType) -> Column:
    over = range_frame(partition, spec.time, f"{span.sql} PRECEDING", "CURRENT ROW")
    x = quoted(spec.target)
    since = f"{quoted(spec.time)} - TIMESTAMP_NTZ'1970-01-01 00:00:00'"
    seconds = f"CAST(CAST({since} AS INTERVAL SECOND) AS BIGINT)"

    def agg(call: str) -> Column:
        return F.expr(f"{call} {over}")

    n = agg(f"count({x})")
    quantile = agg(f"percentile_approx({x}, array(0.25D, 0.5D, 0.75D), 1000000)")
    values = {
        "avg": agg(f"avg({x})"),
        "min": agg(f"min({x})"),
        "max": agg(f"max({x})"),
        "q25": quantile[0],
        "q50": quantile[1],
        "q75": quantile[2],
        "std": agg(f"stddev_samp({x})"),
        "skew": sample_skew(n, agg(f"skewness({x})")),
        "kurt": sample_kurtosis(n, agg(f"kurtosis({x})")),
        "geomean": F.exp(agg(f"avg(ln({x} + 1))")) - 1,
        "sum": agg(f"sum({x})"),
        "abs_energy": agg(f"sum(CAST({x} AS DOUBLE) * {x})"),
        "slope": agg(f"regr_slope({x}, {seconds})"),
    }
    return F.struct(
        *(
            (values[s].cast(target_type) if s in FROM_VALUES else values[s]).alias(s)
            for s in STATISTICS
        )
    )
