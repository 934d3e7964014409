"""Panel description and calendar spans shared by every operator."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, timedelta
from functools import lru_cache

DAY = 86_400

_UNIT_SECONDS = {"SECOND": 1, "MINUTE": 60, "HOUR": 3_600, "DAY": DAY, "WEEK": 7 * DAY}
_UNIT_MONTHS = {"MONTH": 1, "QUARTER": 3, "YEAR": 12}
_SHORT_UNITS = {
    "s": "SECOND", "m": "MINUTE", "h": "HOUR", "d": "DAY", "w": "WEEK",
    "mo": "MONTH", "q": "QUARTER", "y": "YEAR",
}


@lru_cache(maxsize=None)
def _month_span_days(months: int) -> tuple[int, ...]:
    """All day counts that going back ``months`` calendar months can cover.

    The years cover a leap cycle and a century without a leap day.
    """
    lengths = set()
    for first, last in ((date(1896, 1, 1), date(1905, 1, 1)), (date(1996, 1, 1), date(2005, 1, 1))):
        day = first
        while day < last:
            index = day.year * 12 + day.month - 1 - months
            year, month = divmod(index, 12)
            following = date(year + (month == 11), (month + 1) % 12 + 1, 1)
            back = date(year, month + 1, min(day.day, (following - timedelta(days=1)).day))
            lengths.add((day - back).days)
            day += timedelta(days=1)
    return tuple(sorted(lengths))


@dataclass(frozen=True)
class Span:
    """A calendar interval: a fixed length, or a number of calendar months."""

    count: int
    unit: str

    @classmethod
    def parse(cls, text: str | "Span") -> "Span":
        """Read ``"3 months"``, ``"1 day"`` or the short form ``"1h"``."""
        if isinstance(text, Span):
            return text
        found = re.fullmatch(r"\s*(\d+)\s*([A-Za-z]+)\s*", text)
        if not found:
            raise ValueError(f"not an interval: {text!r}")
        count, unit = int(found.group(1)), found.group(2)
        name = _SHORT_UNITS.get(unit) or unit.upper().rstrip("S")
        if name not in _UNIT_SECONDS and name not in _UNIT_MONTHS:
            raise ValueError(f"unknown interval unit: {text!r}")
        return cls(count, name)

    @property
    def months(self) -> int | None:
        """Calendar months, or None for a span of fixed length."""
        return self.count * _UNIT_MONTHS[self.unit] if self.unit in _UNIT_MONTHS else None

    @property
    def seconds(self) -> int:
        """Length in seconds; for month spans the longest it can be."""
        if self.months is not None:
            return self.day_lengths[-1] * DAY
        return self.count * _UNIT_SECONDS[self.unit]

    @property
    def day_lengths(self) -> tuple[int, ...]:
        """Possible lengths in days of a month span."""
        return _month_span_days(self.months)

    @property
    def sql(self) -> str:
        """SQL interval literal."""
        if self.months is not None:
            return f"INTERVAL '{self.months}' MONTH"
        return f"INTERVAL '{self.seconds}' SECOND"


@dataclass(frozen=True)
class PanelSpec:
    """Which columns make a panel: series keys, a time axis, one target.

    ``step`` is the grid spacing (fixed length). ``block_days`` is the length of
    the time blocks long series are cut into, so that no task ever holds more
    than one block of one series plus the history its features look back on.
    """

    target: str
    time: str
    keys: tuple[str, ...]
    step: str = "1 hour"
    block_days: int = 366

    def __post_init__(self) -> None:
        object.__setattr__(self, "keys", tuple(self.keys))
        if Span.parse(self.step).months is not None:
            raise ValueError("the grid step must have a fixed length")
        if not self.keys:
            raise ValueError("a panel needs at least one key column")

    @property
    def step_seconds(self) -> int:
        return Span.parse(self.step).seconds

    @property
    def block_seconds(self) -> int:
        """Block length, a whole number of grid steps."""
        return max(1, self.block_days * DAY // self.step_seconds) * self.step_seconds

    @property
    def columns(self) -> list[str]:
        return [self.time, *self.keys, self.target]


def require_columns(df, names) -> None:
    """Fail early on a column that does not exist (Spark's drop would ignore it)."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}; available: {df.columns}")


def interval_suffix(text: str) -> str:
    """Column suffix of an interval: ``"3 months"`` gives ``3_months``."""
    return text.lower().replace(" ", "_")
