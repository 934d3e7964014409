"""Arithmetic on zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..spec import Span

def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``.

    Subtraction of zone-less timestamps; ``timestampdiff`` would first move both
    into the session time zone, where hours go missing or repeat.
    """
    return (end - start).cast("interval second").cast("long")


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970-01-01, without any time zone."""
    return seconds_between(F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), ts)


def minus(ts: Column, span: Span) -> Column:
    """``ts`` moved back by a span; months clamp to the last day of the month."""
    return ts - F.expr(span.sql)


def plus(ts: Column, span: Span) -> Column:
    return ts + F.expr(span.sql)


def quoted(name: str) -> str:
    """A column name for use in SQL text."""
    return "`" + name.replace("`", "``") + "`"
