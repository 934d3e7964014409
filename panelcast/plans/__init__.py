"""Whole jobs: feature table and backtest."""
