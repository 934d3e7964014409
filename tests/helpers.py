"""Slow, plain versions of the operators, to compare with."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

import pandas as pd

from panelcast.spec import Span


def back(moment: datetime, span: Span) -> datetime:
    if span.months is None:
        return moment - timedelta(seconds=span.seconds)
    return (pd.Timestamp(moment) - pd.DateOffset(months=span.months)).to_pydatetime()


def plain_statistics(values: list[tuple[datetime, float]]) -> dict[str, float | None]:
    """The thirteen statistics of (time, value) pairs, nulls already left out."""
    names = "avg min max q25 q50 q75 std skew kurt geomean sum abs_energy slope".split()
    out: dict[str, float | None] = dict.fromkeys(names)
    n = len(values)
    if not n:
        return out
    x = [v for _, v in values]
    ordered, mean = sorted(x), math.fsum(x) / n
    out.update(avg=mean, min=ordered[0], max=ordered[-1], sum=math.fsum(x), abs_energy=math.fsum(v * v for v in x))
    for name, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
        out[name] = ordered[math.ceil(q * n) - 1]
    if all(v > -1 for v in x):
        out["geomean"] = math.exp(math.fsum(math.log(v + 1) for v in x) / n) - 1
    m2, m3, m4 = (math.fsum((v - mean) ** k for v in x) / n for k in (2, 3, 4))
    if n > 1:
        out["std"] = math.sqrt(m2 * n / (n - 1))
        t = [(at - values[0][0]).total_seconds() for at, _ in values]
        middle = math.fsum(t) / n
        out["slope"] = math.fsum((a - middle) * (v - mean) for a, v in zip(t, x)) / math.fsum((a - middle) ** 2 for a in t)
    if len(set(x)) > 1:
        if n > 2:
            out["skew"] = m3 / m2**1.5 * math.sqrt(n * (n - 1)) / (n - 2)
        if n > 3:
            out["kurt"] = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * (m4 / m2**2 - 3) + 6)
    return out


def brute_force(rows: list[tuple], span: str, horizon_days: int) -> dict[tuple, dict]:
    """Statistics per (key, time) of (key, time, value) rows."""
    length, out = Span.parse(span), {}
    series: dict = {}
    for key, at, value in rows:
        series.setdefault(key, []).append((at, value))
    for key, points in series.items():
        times = {at for at, _ in points}
        for at, _ in points:
            end = at - timedelta(days=horizon_days)
            if end not in times:
                out[key, at] = plain_statistics([])
                continue
            start = back(end, length)
            out[key, at] = plain_statistics(sorted((t, v) for t, v in points if start <= t <= end and v is not None))
    return out


def close(a, b, tolerance=1e-9) -> bool:
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=tolerance, abs_tol=tolerance)
