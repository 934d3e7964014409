"""Rolling-origin folds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Fold:
    """Train on times up to ``start``; test on ``start < time <= end``."""

    start: datetime
    end: datetime


def make_folds(last: datetime, count: int = 4, days: int = 30) -> list[Fold]:
    """``count`` consecutive test ranges of ``days`` days, the final one ending at ``last``."""
    length = timedelta(days=days)
    return [Fold(last - length * (count - i), last - length * (count - i - 1)) for i in range(count)]


def _ntz(moment: datetime):
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def train_rows(df: DataFrame, time: str, fold: Fold) -> DataFrame:
    return df.where(F.col(time) <= _ntz(fold.start))


def held_out_rows(df: DataFrame, time: str, fold: Fold) -> DataFrame:
    return df.where((F.col(time) > _ntz(fold.start)) & (F.col(time) <= _ntz(fold.end)))


def since(df: DataFrame, time: str, first: datetime) -> DataFrame:
    return df.where(F.col(time) >= _ntz(first))


def assign_fold(df: DataFrame, time: str, folds: Sequence[Fold], split: str = "split") -> DataFrame:
    """Test rows with the id of their fold; a row in several folds appears once per fold.

    The folds are few and known, so this is an expression, not a join.
    """
    stamp = F.col(time)
    ids = F.array_compact(
        F.array(
            *(
                F.when((stamp > _ntz(fold.start)) & (stamp <= _ntz(fold.end)), F.lit(i))
                for i, fold in enumerate(folds)
            )
        )
    )
    first, last = min(f.start for f in folds), max(f.end for f in folds)
    return df.where((stamp > _ntz(first)) & (stamp <= _ntz(last))).withColumn(split, F.explode(ids))
