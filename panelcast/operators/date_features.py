"""Calendar and holiday features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.calendar import calendar_fields, clock_cyclics, day_cyclics
from ..functions.columns import at_most
from ..spec import require_columns

REACH = (7, 6, 5, 4, 3, 2)
MAX_HOLIDAYS = 20_000  # more than fifty a year over four centuries


def distinct_days(df: DataFrame, time: str) -> DataFrame:
    return df.select(F.to_date(time).alias("day")).where("day IS NOT NULL").distinct()


def day_calendar(df: DataFrame, time: str) -> DataFrame:
    """One row per day in the data, with its integer calendar fields."""
    days = distinct_days(df, time)
    return days.select("day", *(column.alias(name) for name, column in calendar_fields(F.col("day")).items()))


def holiday_counts(days: DataFrame, holidays: DataFrame) -> DataFrame:
    """Per day near a holiday: is it one, and how many lie in the last/next 2..7 days.

    Only holidays among ``days`` count. Each holiday is spread to the days within
    reach of it and the spread rows are counted per day, so no window over all
    days is needed. Days that are not in the result have no holiday near.
    """
    present = holidays.select(F.to_date("day").alias("day")).distinct().join(days, "day", "left_semi")
    far = max(REACH) - 1
    spread = present.select(
        F.explode(F.sequence(F.lit(-far), F.lit(far))).alias("_away"), "day"
    ).select(F.date_add("day", F.col("_away")).alias("day"), "_away")
    away = F.col("_away")

    def within(low: int, high: int) -> Column:
        return F.count_if(away.between(low, high)).cast("int")

    return spread.groupBy("day").agg(
        (within(0, 0) > 0).alias("is_holiday"),
        *(within(0, k - 1).alias(f"hc_in_last_{k}_days") for k in REACH),
        *(within(1 - k, 0).alias(f"hc_in_next_{k}_days") for k in REACH),
    )


def holiday_columns() -> list[str]:
    return [
        "is_holiday",
        *(f"hc_in_last_{k}_days" for k in REACH),
        *(f"hc_in_next_{k}_days" for k in REACH),
    ]


def add_date_features(
    df: DataFrame, time: str, holidays: DataFrame, days: DataFrame | None = None
) -> DataFrame:
    """Cyclic clock and calendar encodings, weekend flag and holiday counts.

    ``holidays`` has a column ``day``. ``days`` are the days that occur in
    ``df``, if they can be had more cheaply than from ``df`` itself. The cyclic
    encodings are plain expressions of the timestamp; only the rows near a
    holiday are joined, and they are broadcast after their number is checked.
    """
    require_columns(df, [time])
    days = distinct_days(df, time) if days is None else days
    near = holiday_counts(days, holidays).withColumnRenamed("day", "_day")
    if at_most(holidays, MAX_HOLIDAYS):
        near = F.broadcast(near)
    stamp = F.col(time)
    joined = df.join(near, F.to_date(stamp) == F.col("_day"), "left")
    nothing = {name: F.lit(False) if name == "is_holiday" else F.lit(0) for name in holiday_columns()}
    return joined.select(
        *(F.col(f"`{name}`") for name in df.columns),
        *(column.alias(name) for name, column in clock_cyclics(stamp).items()),
        *(
            F.when(stamp.isNotNull(), F.coalesce(F.col(name), other)).alias(name)
            for name, other in nothing.items()
        ),
        *(column.alias(name) for name, column in day_cyclics(stamp).items()),
    )
