"""Forecast error tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.errors import absolute_error, absolute_percentage_error, reciprocal_weight
from ..functions.time import quoted
from ..functions.types import narrow_fractional
from ..session import cut_lineage
from .medians import MASS, SET, VALUE, columns_of, medians_of_sets, same_group, set_id

METRICS = ("rmse", "medae", "mae", "mape")


@dataclass(frozen=True)
class BacktestErrors:
    """Errors per (split, series), per series over all splits, per split, and the mean over splits."""

    by_split: DataFrame
    by_series: DataFrame
    folds: DataFrame
    mean: DataFrame


def _terms(results: DataFrame, columns: Sequence[str], target: str, prediction: str) -> DataFrame:
    """The errors of all rows with an actual, written once: what every metric is made of."""
    y, p = F.col(quoted(target)), F.col(quoted(prediction))
    scored = results.dropna(subset=[target])
    failed = p.isNull() | F.isnan(p.cast("double"))
    return cut_lineage(
        scored.select(
            *map(quoted, columns), failed.alias("_failed"), F.when(~failed, absolute_error(y, p)).alias(VALUE),
            F.when(~failed, absolute_percentage_error(y, p)).alias("_share"), reciprocal_weight(y).alias(MASS),
        )
    )


def _error_sets(terms: DataFrame, sets: Sequence[Sequence[str]]) -> DataFrame:
    """All metrics of all grouping sets, in one pass for the means and one for the medians; ``_set`` tells the sets apart."""
    columns = columns_of(sets)
    means = terms.groupingSets([list(groups) for groups in sets], *columns).agg(
        F.count_if("_failed").alias("_lost"), F.sqrt(F.avg(F.col(VALUE) * F.col(VALUE))).alias("rmse"), F.avg(VALUE).alias("mae"),
        F.avg("_share").alias("mape"), F.grouping_id().cast("long").alias(SET),
    )
    medians = medians_of_sets(terms.drop(MASS), sets, name="medae")
    both = means.alias("l").join(medians.alias("r"), same_group(columns), "left").select("l.*", "r.medae")
    return both.select(SET, *map(quoted, columns), *(F.when(F.col("_lost") == 0, F.col(m)).alias(m) for m in METRICS))


def _one_set(errors: DataFrame, groups: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return errors.where(F.col(SET) == set_id(groups, columns)).select(*map(quoted, groups), *METRICS)


def error_table(results: DataFrame, groups: Sequence[str], target: str, prediction: str = "prediction") -> DataFrame:
    """rmse, medae, mae and mape per group, in double precision and unsorted.

    Rows without an actual do not count. A group with an actual whose prediction is null or NaN has null errors: a model that
    fails must not score well. ``results`` is read once; its errors are written to the checkpoint folder.
    """
    return _error_sets(_terms(results, groups, target, prediction), [groups]).drop(SET)


def forecast_metrics(
    results: DataFrame, series: str, target: str, prediction: str = "prediction", split: str = "split"
) -> tuple[DataFrame, DataFrame]:
    """Errors per (split, series), and per series over all splits; sorted, 32-bit floats."""
    sets = [[split, series], [series]]
    errors = cut_lineage(_error_sets(_terms(results, [split, series], target, prediction), sets))
    by_split, by_series = (_one_set(errors, groups, [split, series]).orderBy(*map(quoted, groups)) for groups in sets)
    return narrow_fractional(by_split), narrow_fractional(by_series)


def backtest_errors(
    results: DataFrame, series: str, target: str, prediction: str = "prediction", split: str = "split"
) -> BacktestErrors:
    """All error tables of a backtest from one pass over ``results``: those of :func:`forecast_metrics`, the folds and their mean."""
    columns = [split, series]
    terms = _terms(results, columns, target, prediction)
    sets = [columns, [series], [split]]
    errors = cut_lineage(_error_sets(terms, sets))
    by_split, by_series, by_fold = (_one_set(errors, groups, columns) for groups in sets)
    folds = cut_lineage(_with_weighted_median(by_fold, terms, split))
    return BacktestErrors(
        narrow_fractional(by_split.orderBy(*map(quoted, columns))), narrow_fractional(by_series.orderBy(quoted(series))),
        folds.orderBy(quoted(split)), mean_over_folds(folds, split),
    )


def _with_weighted_median(by_fold: DataFrame, terms: DataFrame, split: str) -> DataFrame:
    weighted = medians_of_sets(terms.select(quoted(split), VALUE, MASS), [[split]], True, "medae_weighted")
    plain = by_fold.withColumn(SET, F.lit(0).cast("long"))
    both = plain.alias("l").join(weighted.alias("r"), same_group([split]), "left")
    # A fold has a row only if it has an actual, and then its rmse is null only if a prediction failed.
    scored = F.col("rmse").isNotNull()
    return both.select(f"l.{quoted(split)}", "rmse", "medae", "mape", F.when(scored, F.col("medae_weighted")).alias("medae_weighted"))


def fold_metrics(results: DataFrame, target: str, prediction: str = "prediction", split: str = "split") -> DataFrame:
    """Per fold: rmse, medae, mape and the median error weighted by 1/actual, which is null without a positive actual.

    As in :func:`error_table`, all are null in a fold with an actual whose prediction is null or NaN.
    """
    terms = _terms(results, [split], target, prediction)
    return _with_weighted_median(_error_sets(terms, [[split]]), terms, split)


def mean_over_folds(per_fold: DataFrame, split: str = "split") -> DataFrame:
    """One row: the plain mean of every fold metric.

    All are null if a fold's predictions failed, which shows in a null rmse; a weighted median that is null for want of a
    positive actual is passed over.
    """
    names = [name for name in per_fold.columns if name != split]
    scored = F.count_if(F.col("rmse").isNull()) == 0 if "rmse" in names else F.lit(True)
    return per_fold.agg(*(F.when(scored, F.avg(name)).alias(name) for name in names))
