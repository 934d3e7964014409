"""Features from the past of each series: trailing statistics and lags.

``add_stat_features`` and ``add_lag_features`` are the two public operators;
``add_history_features`` computes both over the same time blocks, with one
shuffle of the panel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.frames import frame_statistics, point_before
from ..functions.growing import frame_columns, with_running_state
from ..functions.sliding import FROM_VALUES, QUANTILES, STATISTICS, block_statistics
from ..functions.time import epoch_seconds, plus, quoted
from ..functions.types import is_integral
from ..spec import PanelSpec, Span, interval_suffix, require_columns
from .blocks import BLOCK, NO_HISTORY, has_place, own_rows, with_history


def stat_columns(spec: PanelSpec, intervals: Sequence[str]) -> list[str]:
    """Names of the statistic columns, in output order."""
    return [f"{s}_{spec.target}_{interval_suffix(i)}" for i in intervals for s in STATISTICS]


def lag_columns(spec: PanelSpec, lags: Sequence[int]) -> list[str]:
    return [f"{spec.target}_lag_{lag}" for lag in lags]


def add_stat_features(
    df: DataFrame, spec: PanelSpec, intervals: Sequence[str], horizon: int = 30, native: bool = False
) -> DataFrame:
    """Thirteen trailing-window statistics per interval, as known ``horizon`` days earlier.

    The row at time t gets the statistics of the frame
    ``[t - horizon - interval, t - horizon]``, both ends included; null where
    the series has no row at ``t - horizon``. The panel may have gaps, but
    (keys, time) must be unique. Whole numbers are summed by growing window
    frames, fractional ones in Arrow blocks, since decimals do not hold them exactly.
    ``native`` computes all with Spark's sliding window
    aggregates, at a cost per row that grows with the frame; its quantiles
    pass through doubles, which round whole numbers beyond 2**53.
    """
    return add_history_features(df, spec, intervals=intervals, horizon=horizon, native=native)


def add_lag_features(df: DataFrame, spec: PanelSpec, lags: Sequence[int], unit: str = "DAY") -> DataFrame:
    """The target ``lag`` units earlier, one column per lag; null if there is no such row."""
    return add_history_features(df, spec, lags=lags, lag_unit=unit)


def add_history_features(
    df: DataFrame,
    spec: PanelSpec,
    intervals: Sequence[str] = (),
    lags: Sequence[int] = (),
    horizon: int = 30,
    lag_unit: str = "DAY",
    native: bool = False,
) -> DataFrame:
    """Statistics and lags together, over one set of blocks.

    Every row stays. One with a null time or a null key has null features. Two rows of one series and time are an error, which shows in the
    pass that computes the features; calendar-month lags take them as a join would.
    """
    require_columns(df, spec.columns)
    spans = {interval_suffix(text): Span.parse(text) for text in intervals}
    ahead = Span(horizon, "DAY")
    lag_spans = {f"{spec.target}_lag_{lag}": Span.parse(f"{lag} {lag_unit}") for lag in lags}
    if any(span.months is not None for span in lag_spans.values()):
        if spans:
            df = add_history_features(df, spec, intervals, horizon=horizon, native=native)
        return _lags_by_group(df, spec, lag_spans)

    reach = [span.seconds for span in lag_spans.values()]
    reach += [ahead.seconds + span.seconds for span in spans.values()]
    partition = [*spec.keys, BLOCK]
    blocks = with_history(df, spec, max(reach))
    if spans and not native and is_integral(df, spec.target):
        return _growing_features(df, blocks, spec, spans, lag_spans, ahead)
    if spans and not native:
        out = _sliding_features(blocks, spec, spans, lag_spans, ahead)
    else:
        if lag_spans:
            blocks = blocks.withColumns(
                {
                    name: _once(spec, partition, F.when(has_place(spec), point_before(spec.target, partition, spec.time, span)))
                    for name, span in lag_spans.items()
                }
            )
        out = own_rows(_native_statistics(df, blocks, spec, spans, ahead) if spans else blocks, spec)
    return out.select(*df.columns, *stat_columns(spec, intervals), *lag_spans)


def _once(spec: PanelSpec, partition: list[str], value: Column) -> Column:
    """``value``, whose evaluation fails where a series has two rows of one time; seen in the order that the features need anyway."""
    keys = ", ".join(map(quoted, partition))
    before = F.expr(f"lag({quoted(spec.time)}) OVER (PARTITION BY {keys} ORDER BY {quoted(spec.time)})")
    twice = has_place(spec) & (before == F.col(quoted(spec.time)))
    return F.when(twice, F.raise_error(F.lit("a series has two rows of one time; duplicate_keys lists them"))).otherwise(value)


def _growing_features(
    df: DataFrame, blocks: DataFrame, spec: PanelSpec, spans: dict[str, Span], lag_spans: dict[str, Span], ahead: Span
) -> DataFrame:
    """All but the quantiles by window frames, the quantiles then in the blocks that the windows sorted: one shuffle."""
    partition, known = [*spec.keys, BLOCK], has_place(spec)
    target = df.schema[spec.target].dataType
    others = [c for c in df.columns if c not in spec.columns]
    rows = blocks.select(*map(quoted, spec.columns), BLOCK, F.struct(F.lit(0).alias("_"), *[F.col(quoted(c)) for c in others]).alias("_others"))
    # The rows are small and the work on them is not: adaptive execution, which goes by bytes, would leave it to a few tasks.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, *map(quoted, partition))
    longest = max(span.seconds for span in spans.values())
    counted = _once(spec, partition, F.lit(1))
    framed = frame_columns(with_running_state(rows, spec, partition, longest, counted), spec, partition, spans, ahead, known)
    lagged = [F.when(known, point_before(spec.target, partition, spec.time, span)).alias(name) for name, span in lag_spans.items()]
    kept = framed.select(
        *map(quoted, spec.columns), BLOCK, "_others", F.struct(F.lit(0).alias("_"), *lagged).alias("_lags"),
        *[quoted(f"_f_{name}") for name in spans], epoch_seconds(F.col(quoted(spec.time))).alias("_seconds"),
    )
    keep = [c for c in kept.columns if c not in (BLOCK, "_seconds")]
    schema = T.StructType(
        [kept.schema[name] for name in keep] + [T.StructField(f"{q}_{spec.target}_{frame}", target) for frame in spans for q in QUANTILES]
    )
    slide = block_statistics(
        spans, {}, ahead.seconds, spec.target, spec.time, "_seconds", BLOCK, spec.block_seconds, keep, NO_HISTORY, quantiles_only=True
    )
    out = kept.groupBy(*spec.keys, BLOCK).applyInArrow(slide, schema)
    kinds = {"min": target, "max": target}
    return out.select(
        *[F.col(quoted(c)) if c in spec.columns else F.col(f"_others.{quoted(c)}") for c in df.columns],
        *(
            F.col(quoted(f"{s}_{spec.target}_{frame}")) if s in QUANTILES
            else F.col(f"{quoted('_f_' + frame)}.{s}").cast(kinds.get(s, framed.schema[f"_f_{frame}"].dataType[s].dataType)).alias(f"{s}_{spec.target}_{frame}")
            for frame in spans for s in STATISTICS
        ),
        *[F.col(f"_lags.{quoted(name)}") for name in lag_spans],
    )


def _sliding_features(
    blocks: DataFrame, spec: PanelSpec, spans: dict[str, Span], lag_spans: dict[str, Span], ahead: Span
) -> DataFrame:
    """Statistics and lags of each block with its history; yields the block's own rows."""
    keep = [name for name in blocks.columns if name != BLOCK]
    target = blocks.schema[spec.target].dataType
    kinds = {name: target for name in FROM_VALUES}
    kinds["sum"] = T.LongType() if is_integral(blocks, spec.target) else T.DoubleType()
    schema = T.StructType(
        [blocks.schema[name] for name in keep]
        + [
            T.StructField(f"{stat}_{spec.target}_{frame}", kinds.get(stat, T.DoubleType()))
            for frame in spans for stat in STATISTICS
        ]
        + [T.StructField(name, target) for name in lag_spans]
    )
    slide = block_statistics(
        spans, lag_spans, ahead.seconds, spec.target, spec.time, "_seconds", BLOCK, spec.block_seconds, keep, NO_HISTORY
    )
    # A group is at most (block + look-back) / step rows.
    return (
        blocks.withColumn("_seconds", epoch_seconds(F.col(spec.time)))
        .groupBy(*spec.keys, BLOCK)
        .applyInArrow(slide, schema)
    )


def _native_statistics(df: DataFrame, blocks: DataFrame, spec: PanelSpec, spans: dict[str, Span], ahead: Span) -> DataFrame:
    """Window aggregates at each row, then taken from the row ``ahead`` earlier."""
    partition = [*spec.keys, BLOCK]
    kind = df.schema[spec.target].dataType
    at_row = blocks.withColumns(
        {f"_s_{name}": _once(spec, partition, frame_statistics(spec, partition, span, kind)) for name, span in spans.items()}
    )
    if ahead.count:
        at_row = at_row.withColumns(
            {f"_s_{name}": point_before(f"_s_{name}", partition, spec.time, ahead) for name in spans}
        )
    at_row = at_row.withColumns({f"_s_{name}": F.when(has_place(spec), F.col(f"_s_{name}")) for name in spans})
    return at_row.selectExpr(
        *(quoted(name) for name in blocks.columns),
        *(
            f"{quoted(f'_s_{name}')}.{s} AS {quoted(f'{s}_{spec.target}_{name}')}"
            for name in spans for s in STATISTICS
        ),
    )


def _lags_by_group(df: DataFrame, spec: PanelSpec, lag_spans: dict[str, Span]) -> DataFrame:
    """Calendar-month lags: several days can land on one month end, so rows may multiply.

    Every row is sent to its own time and, for each lag, to the time that many months later; what meets at a time of a series is
    grouped once, whatever the number of lags. A group holds the rows of one time and the few days that land on it.
    """
    own, place = F.struct(*[F.col(quoted(c)) for c in df.columns]), has_place(spec)
    time, value = F.col(quoted(spec.time)), F.col(quoted(spec.target))
    kind, target = df.select(own.alias("row")).schema["row"].dataType, df.schema[spec.target].dataType
    none = F.lit(None)
    itself = F.struct(F.lit(-1).alias("lag"), time.alias("at"), own.alias("row"), none.cast(target).alias("value"))
    moved = [
        F.struct(F.lit(i).alias("lag"), plus(time, span).alias("at"), none.cast(kind).alias("row"), value.alias("value"))
        for i, span in enumerate(lag_spans.values())
    ]
    keys = [F.col(quoted(k)).alias(f"_key_{i}") for i, k in enumerate(spec.keys)]
    # Rows without a place equal no other: each is a group of its own.
    alone = F.when(~place, F.monotonically_increasing_id())
    sent = df.select(*keys, alone.alias("_alone"), F.explode(F.when(place, F.array(itself, *moved)).otherwise(F.array(itself))).alias("_sent"))
    met = sent.groupBy(*[f"_key_{i}" for i in range(len(keys))], "_alone", F.col("_sent.at").alias("_at")).agg(
        F.collect_list(F.when(F.col("_sent.lag") == -1, F.col("_sent.row"))).alias("_rows"),
        *[F.collect_list(F.when(F.col("_sent.lag") == i, F.struct("_sent.value"))).alias(f"_lag_{i}") for i in range(len(moved))],
    )
    out = met.select(F.explode("_rows").alias("_row"), *[f"_lag_{i}" for i in range(len(moved))])
    for i in range(len(moved)):
        out = out.withColumn(f"_lag_{i}", F.explode_outer(f"_lag_{i}"))
    return out.select("_row.*", *[F.col(f"_lag_{i}.value").alias(name) for i, name in enumerate(lag_spans)])
