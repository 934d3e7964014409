"""Complete time x series grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.time import seconds_between
from ..spec import PanelSpec, Span, require_columns


def time_bounds(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row: the global first and last time."""
    return df.agg(F.min(spec.time).alias("first_time"), F.max(spec.time).alias("last_time"))


def time_axis(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Every grid time from the global minimum to the maximum, both ends included.

    Block starts are generated first and each is expanded on its own, so no
    array is longer than a block.
    """
    bounds = time_bounds(df, spec)
    starts = bounds.select(
        "last_time",
        F.explode(F.sequence("first_time", "last_time", F.expr(_seconds(spec.block_seconds)))).alias("_start"),
    )
    stop = F.least(F.col("last_time"), F.col("_start") + F.expr(_seconds(spec.block_seconds - spec.step_seconds)))
    return starts.select(
        F.explode(F.sequence(F.col("_start"), stop, F.expr(_seconds(spec.step_seconds)))).alias(spec.time)
    )


def distinct_series(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.select(*spec.keys).distinct()


def densify(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Put every series on the full grid between the global first and last time.

    Missing grid points get a null target and ``was_null = 1``; nothing is
    imputed. The grid is not built as (times x series) joined to the data:
    per series and block one anchor row is added, and each row then fills the
    gap up to its successor. So only the observations are shuffled, and the
    generated rows come into being after the shuffle.
    """
    require_columns(df, spec.columns)
    step, block = F.expr(_seconds(spec.step_seconds)), F.expr(_seconds(spec.block_seconds))

    # Keys and bounds come from one pass: both uses of this small table are the
    # same plan, so Spark runs it once. The bounds enter as a scalar subquery, with
    # no join and nothing fetched to the driver program.
    series = df.groupBy(*spec.keys).agg(F.min(spec.time).alias("_first"), F.max(spec.time).alias("_last"))
    bounds = series.agg(F.struct(F.min("_first").alias("first"), F.max("_last").alias("last")).alias("b")).scalar()
    first, last = bounds.getField("first"), bounds.getField("last")
    time = F.col(spec.time)
    offset = seconds_between(first, time)

    whole = F.sequence(F.least(first, "_first"), F.greatest(last, "_last"), block)
    anchors = series.select(*spec.keys, F.posexplode_outer(whole).alias("_cell", spec.time)).withColumn("_anchor", F.lit(True))
    # Totals are sums, and Spark moves a plain filter on their keys below the sum, where it would be worked out, text parsing and
    # all, for every raw record. A filter on what a row yields stays where it is.
    on_grid = _present(df, spec) & (first + F.floor(offset / spec.step_seconds) * step == time)
    observed = (
        df.select("*", F.explode_outer(F.when(on_grid, F.array(F.lit(False)))).alias("_anchor"))
        .where(F.col("_anchor").isNotNull())
        .withColumn("_cell", F.floor(offset / spec.block_seconds).cast("int"))
    )
    rows = anchors.unionByName(observed, allowMissingColumns=True)

    following = F.lead(spec.time).over(
        Window.partitionBy(*spec.keys, "_cell").orderBy(F.col(spec.time), F.col("_anchor").desc())
    )
    cell_end = F.least(first + (F.col("_cell") + 1) * block, last + step)
    filled = (
        rows.withColumn("_until", F.coalesce(following, cell_end) - step)
        # An anchor whose place is taken by an observation yields nothing.
        .where(~F.col("_anchor") | (F.col("_until") >= time))
        .withColumn("_slots", F.sequence(time, F.greatest(F.col("_until"), time), step))
    )
    generated = F.col("_anchor") | (F.col("_slot") > 0)
    values = [name for name in df.columns if name not in (spec.time, *spec.keys)]
    # The arrays are never empty; the outer form spares Spark from computing them once more to test that.
    return filled.select(
        *spec.keys, *values, "_anchor", F.posexplode_outer("_slots").alias("_slot", spec.time)
    ).select(
        spec.time,
        *spec.keys,
        *(F.when(~generated, F.col(name)).alias(name) for name in values),
        (generated | F.col(spec.target).isNull()).cast("tinyint").alias("was_null"),
    )


def _present(df: DataFrame, spec: PanelSpec) -> Column:
    """Whether a row has a time and all keys; NaN counts as missing."""
    found = F.col(spec.time).isNotNull()
    for name in spec.keys:
        found &= F.col(name).isNotNull()
        if df.schema[name].dataType.typeName() in ("float", "double"):
            found &= ~F.isnan(name)
    return found


def duplicate_keys(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows of (keys, time) that occur more than once; features assume there are none."""
    return df.groupBy(*spec.keys, spec.time).count().where("count > 1")


def _seconds(seconds: int) -> str:
    return Span(seconds, "SECOND").sql
