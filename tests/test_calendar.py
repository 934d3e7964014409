import math
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from panelcast.functions.calendar import calendar_fields
from panelcast.operators.date_features import REACH, add_date_features, day_calendar, distinct_days, holiday_counts
from panelcast.sources.holidays import turkish_holidays


def test_fields_at_the_edges(spark):
    days = [date(2020, 2, 29), date(2020, 12, 31), date(2021, 1, 1), date(2024, 12, 30), date(2023, 1, 1), date(2015, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "day date")
    for row in df.select("day", *(c.alias(n) for n, c in calendar_fields(F.col("day")).items())).collect():
        iso = row.day.isocalendar()
        assert (row.year, row.woy, row.dow) == tuple(iso)
        assert row.doy == row.day.timetuple().tm_yday
        assert row.total_days_in_year == date(row.day.year, 12, 31).timetuple().tm_yday
        assert row.total_weeks_in_year == date(iso[0], 12, 28).isocalendar()[1]
        assert row.total_days_in_month == ((row.day.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)).day
        assert (row.moy, row.dom) == (row.day.month, row.day.day)


def test_holiday_counts_against_brute_force(spark):
    # Days are missing from the data, one of them a holiday.
    days = [date(2024, 4, 1) + timedelta(days=i) for i in range(40) if i % 7 != 3]
    holidays = [date(2024, 4, 4), date(2024, 4, 10), date(2024, 4, 11), date(2024, 4, 12), date(2024, 4, 23), date(2024, 5, 10)]
    df = spark.createDataFrame([(datetime.combine(d, datetime.min.time()) + timedelta(hours=7),) for d in days], "ts timestamp_ntz")
    table = spark.createDataFrame([(d,) for d in holidays], "day date")
    counted = set(days) & set(holidays)
    got = add_date_features(df, "ts", table).collect()
    assert len(got) == len(days)
    for row in got:
        day = row.ts.date()
        assert row.is_holiday == (day in counted)
        assert row.is_weekend == int(day.isoweekday() > 5)
        assert math.isclose(row.hour_sin, math.sin(2 * math.pi * 7 / 24), abs_tol=1e-12)
        for k in REACH:
            assert row[f"hc_in_last_{k}_days"] == sum(0 <= (day - h).days < k for h in counted)
            assert row[f"hc_in_next_{k}_days"] == sum(0 <= (h - day).days < k for h in counted)


def test_null_time_has_null_calendar(spark):
    df = spark.createDataFrame([(None,), (datetime(2024, 1, 1),)], "ts timestamp_ntz")
    got = {r.ts: r for r in add_date_features(df, "ts", turkish_holidays(spark, [2024])).collect()}
    assert got[None].is_holiday is None and got[None].hc_in_last_2_days is None
    assert got[datetime(2024, 1, 1)].is_holiday and got[datetime(2024, 1, 1)].hc_in_last_2_days == 1


def test_day_calendar_and_counts_are_per_day(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, h),) for h in range(24)], "ts timestamp_ntz")
    assert day_calendar(df, "ts").count() == 1
    assert holiday_counts(distinct_days(df, "ts"), turkish_holidays(spark, [2023])).count() == 0


def test_turkish_holidays(spark):
    days = {r.day for r in turkish_holidays(spark, [2016, 2024], without_feasts=True).collect()}
    assert date(2024, 7, 15) in days and date(2016, 7, 15) not in days
    assert {date(2024, 4, 10), date(2024, 4, 12), date(2024, 6, 16), date(2024, 6, 19)} <= days
    assert date(2024, 4, 13) not in days and date(2024, 6, 20) not in days
