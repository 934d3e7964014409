"""Demand-forecast features and backtests on panels of time series, on Spark."""

from .spec import PanelSpec, Span

__all__ = ["PanelSpec", "Span"]
