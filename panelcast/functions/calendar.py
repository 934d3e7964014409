"""Calendar fields and their cyclic encodings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def cyclic(value: Column, period: Column | int) -> tuple[Column, Column]:
    """Sine and cosine of ``2*pi*value/period``."""
    angle = F.lit(2.0) * F.pi() * value / period
    return F.sin(angle), F.cos(angle)


def iso_year(ts: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), ts)


def iso_weekday(ts: Column) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(ts) + 1


def weeks_in_iso_year(ts: Column) -> Column:
    """28 December always lies in the last ISO week of its year."""
    return F.weekofyear(F.make_date(iso_year(ts), F.lit(12), F.lit(28)))


def days_in_year(ts: Column) -> Column:
    return F.dayofyear(F.make_date(F.year(ts), F.lit(12), F.lit(31)))


def days_in_month(ts: Column) -> Column:
    return F.day(F.last_day(ts))


def calendar_fields(ts: Column) -> dict[str, Column]:
    """The integer calendar fields of a timestamp or date."""
    return {
        "year": iso_year(ts),
        "doy": F.dayofyear(ts),
        "woy": F.weekofyear(ts),
        "moy": F.month(ts),
        "dow": iso_weekday(ts),
        "dom": F.day(ts),
        "total_days_in_month": days_in_month(ts),
        "total_weeks_in_year": weeks_in_iso_year(ts),
        "total_days_in_year": days_in_year(ts),
    }


def clock_cyclics(ts: Column) -> dict[str, Column]:
    """Hour and minute encodings."""
    out = {}
    for name, value, period in (("hour", F.hour(ts), 24), ("minute", F.minute(ts), 60)):
        out[f"{name}_sin"], out[f"{name}_cos"] = cyclic(value, period)
    return out


def day_cyclics(ts: Column) -> dict[str, Column]:
    """Month, weekday, day-of-month, ISO week and day-of-year encodings, weekend flag."""
    field = calendar_fields(ts)
    out = {}
    for name, value, period in (
        ("month", field["moy"], F.lit(12)),
        ("dow", field["dow"], F.lit(7)),
        ("dom", field["dom"], field["total_days_in_month"]),
        ("woy", field["woy"], field["total_weeks_in_year"]),
        ("doy", field["doy"], field["total_days_in_year"]),
    ):
        out[f"{name}_sin"], out[f"{name}_cos"] = cyclic(value, period)
    out["is_weekend"] = F.when(field["dow"].isin(6, 7), 1).otherwise(0)
    return out
