"""Reading and writing the tables of the forecast job."""

from .tables import read_features, read_trips, write_features, write_metrics

__all__ = ["read_features", "read_trips", "write_features", "write_metrics"]
