"""Public-holiday tables; any table with a ``day`` column serves as well."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Public holidays of Turkey. (month, day, first year it is one)
FIXED_DATES = (
    (1, 1, 1935),   # New Year's Day
    (4, 23, 1921),  # National Sovereignty and Children's Day
    (5, 1, 2009),   # Labour and Solidarity Day
    (5, 19, 1939),  # Commemoration of Ataturk, Youth and Sports Day
    (7, 15, 2017),  # Democracy and National Unity Day
    (8, 30, 1926),  # Victory Day
    (10, 29, 1925), # Republic Day
)
# First days of the two movable feasts, which last three and four days, as they were announced.
RAMADAN_FEAST = (
    date(2010, 9, 9), date(2011, 8, 30), date(2012, 8, 19), date(2013, 8, 8), date(2014, 7, 28),
    date(2015, 7, 17), date(2016, 7, 5), date(2017, 6, 25), date(2018, 6, 15), date(2019, 6, 4),
    date(2020, 5, 24), date(2021, 5, 13), date(2022, 5, 2), date(2023, 4, 21),
    date(2024, 4, 10), date(2025, 3, 30), date(2026, 3, 20),
)
SACRIFICE_FEAST = (
    date(2010, 11, 16), date(2011, 11, 6), date(2012, 10, 25), date(2013, 10, 15), date(2014, 10, 4),
    date(2015, 9, 24), date(2016, 9, 12), date(2017, 9, 1), date(2018, 8, 21), date(2019, 8, 11),
    date(2020, 7, 31), date(2021, 7, 20), date(2022, 7, 9), date(2023, 6, 28),
    date(2024, 6, 16), date(2025, 6, 6), date(2026, 5, 27),
)
# The tabular lunar calendar: month, day and length of each feast, and the day before the calendar's first. Counted from the day of the
# new moon, as here, it is never more than a day away from the feasts above.
SHAWWAL_1, DHU_AL_HIJJA_10 = (10, 1, 3), (12, 10, 4)
BEFORE_FIRST = date(622, 7, 17)


def lunar_day(year: int, month: int, day: int) -> date:
    """The day of a date of the tabular lunar calendar.

    Odd months have 30 days and even ones 29; in 30 years the last month has one day more in 11, where 11 * year + 14 leaves less
    than 11 when divided by 30.
    """
    leap_days = (11 * year + 3) // 30
    return BEFORE_FIRST + timedelta(days=354 * (year - 1) + leap_days + 29 * (month - 1) + month // 2 + day)


def feast_starts(year: int, feast: tuple[int, int, int], computed: bool = True) -> list[date]:
    """First days of a feast in a year, none to two of them: as announced where that is known, else by the tabular calendar, if ``computed``."""
    announced = RAMADAN_FEAST if feast is SHAWWAL_1 else SACRIFICE_FEAST
    if announced[0].year <= year <= announced[-1].year:
        return [first for first in announced if first.year == year]
    if not computed:
        return []
    month, day, _ = feast
    about = (year - 622) * 33 // 32
    days = (lunar_day(lunar, month, day) for lunar in range(max(1, about - 1), about + 3))
    return [first for first in days if first.year == year]


def holiday_days(years: Iterable[int], computed: bool = True) -> list[date]:
    """Full public holidays of the years given, in order; ``computed`` feasts are those not known as announced."""
    years = sorted(set(years))
    days = {date(y, m, d) for y in years for m, d, begins in FIXED_DATES if y >= begins}
    for feast in (SHAWWAL_1, DHU_AL_HIJJA_10):
        # A feast that begins in the last days of a year goes on in the next.
        starts = [first for y in {x + back for x in years for back in (-1, 0)} for first in feast_starts(y, feast, computed)]
        days.update(first + timedelta(days=i) for first in starts for i in range(feast[2]))
    return sorted(day for day in days if day.year in years)


def turkish_holidays(spark: SparkSession, years: Iterable[int], without_feasts: bool = False) -> DataFrame:
    """Full public holidays of the years given.

    Movable feasts are as announced for 2010 to 2026 and computed for other years; ``without_feasts`` leaves the computed ones out.
    """
    days = holiday_days(years, not without_feasts)
    return spark.createDataFrame(pa.table({"day": pa.array(days, pa.date32())}))
