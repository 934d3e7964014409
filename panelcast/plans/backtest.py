"""Rolling-origin backtest of a gradient-boosted regressor."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import drop_columns
from ..functions.text import join_text
from ..functions.time import quoted
from ..functions.types import narrow_double
from ..operators.folds import Fold, held_out_rows, make_folds, train_rows
from ..operators.metrics import backtest_errors
from ..session import checkpoint_dir, cut_lineage
from ..sources.tables import read_features, write_fold_metrics, write_metrics
from ..spec import PanelSpec
from . import presets

#: Bins of a feature; one more holds missing values.
BINS = 31
#: Training rows of one task.
ROWS_PER_TASK = 50_000
#: Relative error of the bins' edges, in ranks.
EDGE_ERROR = 0.002


@dataclass(frozen=True)
class BoostingSettings:
    """Settings of the regressor and of the target it is fitted to.

    A series is known to the model by the mean label of its training rows, drawn towards the mean of all as by ``key_prior`` more rows.
    """

    max_depth: int = 5
    learning_rate: float = 0.02
    n_estimators: int = 300
    subsample: float = 0.8
    feature_share: float = 0.8
    min_rows_per_leaf: int = 10
    seed: int = 42
    log_target: bool = True
    weighted: bool = True
    key_prior: float = 20.0


def joined_key(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Replace the key columns by one text key, for a model over all series."""
    return drop_columns(df.withColumn(name, join_text(*keys, separator="_")), *keys)


def feature_columns(df: DataFrame, spec: PanelSpec) -> list[str]:
    """Every numeric or boolean column but the target."""
    usable = (T.NumericType, T.BooleanType)
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, usable) and f.name not in (spec.target, spec.time, *spec.keys)
    ]


def with_label(df: DataFrame, spec: PanelSpec, settings: BoostingSettings) -> DataFrame:
    """Add ``_label`` and ``_weight``.

    The label is log1p of the target, the weight its reciprocal. A label of
    zero has no reciprocal; it weighs as much as a target of one.
    """
    target = f"CAST({quoted(spec.target)} AS DOUBLE)"
    label, least = (f"log1p({target})", "log1p(1D)") if settings.log_target else (target, "1D")
    weight = f"CASE WHEN {label} > 0 THEN 1D / {label} ELSE 1D / {least} END" if settings.weighted else "1D"
    return df.selectExpr("*", f"{label} AS _label", f"{weight} AS _weight")


@dataclass(frozen=True)
class FeatureBins:
    """Edges of the bins of each feature; as many per feature as ``BINS`` at most, so few numbers in all."""

    edges: dict[str, list[float]]

    @classmethod
    def of(cls, rows: DataFrame, features: Sequence[str]) -> FeatureBins:
        """Quantiles of all rows given, in one pass; a feature without values or with one value has one bin."""
        numbers = rows.select(*(F.col(quoted(name)).cast("double").alias(f"_{i}") for i, name in enumerate(features)))
        shares = [k / BINS for k in range(1, BINS)]
        found = numbers.approxQuantile(numbers.columns, shares, EDGE_ERROR) if features else []
        inner = [sorted({x for x in edges if abs(x) < float("inf")}) for edges in found]
        return cls({name: [float("-inf"), *edges, float("inf")] for name, edges in zip(features, inner)})

    def apply(self, rows: DataFrame, out: str) -> DataFrame:
        """Add the vector ``out`` of bin numbers; a missing value is in a bin of its own, above the others."""
        names = list(self.edges)
        numbers = rows.withColumns(
            {f"_number_{i}": F.coalesce(F.col(quoted(name)).cast("double"), F.lit(float("nan"))) for i, name in enumerate(names)}
        )
        sources, bins = [f"_number_{i}" for i in range(len(names))], [f"_bin_{i}" for i in range(len(names))]
        # A bin holds its lower edge. A feature without edges still needs a place to be cut at.
        splits = [edges if len(edges) > 2 else [edges[0], 0.0, edges[-1]] for edges in self.edges.values()]
        binned = Bucketizer(splitsArray=splits, inputCols=sources, outputCols=bins, handleInvalid="keep").transform(numbers) if names else numbers
        # Bins are numbers in order; without this they would be marked as categories.
        numbered = binned.withColumns({name: F.col(name) + 0.0 for name in bins})
        return VectorAssembler(inputCols=bins, outputCol=out).transform(numbered).drop(*sources, *bins)


def training_table(df: DataFrame, spec: PanelSpec, first_start: datetime, settings: BoostingSettings) -> DataFrame:
    """The rows with a target, their label and weight, and all features as one vector of bin numbers, written once in order of time.

    Every fold trains on a range of this table, which its row groups' bounds select, and none bins anything again. The edges come from rows
    up to the first fold's start, so that no fold's bins know what lies ahead of it.
    """
    known = narrow_double(df.dropna(subset=[spec.target]))
    features = feature_columns(known, spec)
    bins = FeatureBins.of(train_rows(known, spec.time, Fold(first_start, first_start)), features)
    rows = bins.apply(with_label(known, spec, settings), "_features")
    return cut_lineage(rows.repartitionByRange(F.col(quoted(spec.time))).sortWithinPartitions(quoted(spec.time)), "training")


def key_means(train: DataFrame, spec: PanelSpec, average: float, settings: BoostingSettings) -> DataFrame:
    """Mean label, drawn towards ``average``, and number of rows of every series in ``train``."""
    weight = settings.key_prior
    return train.groupBy(*map(quoted, spec.keys)).agg(
        ((F.sum("_label") + weight * average) / (F.count(F.lit(1)) + weight)).alias("_key_mean"), F.count(F.lit(1)).cast("double").alias("_key_rows")
    )


def with_key(rows: DataFrame, means: DataFrame, average: float, spec: PanelSpec) -> DataFrame:
    """Join a fold's series means to rows by key, and append them to their features; any number of series will do.

    A series that ``means`` lacks has the average and no rows.
    """
    same = [F.col(f"l.{quoted(k)}").eqNullSafe(F.col(f"r.{quoted(k)}")) for k in spec.keys]
    both = rows.alias("l").join(means.alias("r"), reduce(Column.__and__, same), "left").select("l.*", "r._key_mean", "r._key_rows")
    return VectorAssembler(inputCols=["_features", "_key_mean", "_key_rows"], outputCol="_inputs").transform(
        both.fillna({"_key_mean": average, "_key_rows": 0.0})
    )


def fit_trees(train: DataFrame, settings: BoostingSettings) -> GBTRegressionModel:
    """Boosted trees over ``_inputs``, by absolute loss."""
    checkpoint_dir(train.sparkSession)
    return GBTRegressor(
        featuresCol="_inputs",
        labelCol="_label",
        weightCol="_weight",
        predictionCol="_raw",
        lossType="absolute",
        maxDepth=settings.max_depth,
        maxIter=settings.n_estimators,
        stepSize=settings.learning_rate,
        subsamplingRate=settings.subsample,
        featureSubsetStrategy=str(settings.feature_share),
        minInstancesPerNode=settings.min_rows_per_leaf,
        maxBins=BINS + 1,
        checkpointInterval=10,
        seed=settings.seed,
    ).fit(train)


def _one_fold(table: DataFrame, spec: PanelSpec, fold: Fold, keep: Sequence[str], settings: BoostingSettings) -> DataFrame:
    """Fit on what lies before the fold, predict the fold; its rows with ``prediction``, written."""
    train = train_rows(table, spec.time, fold)
    average, rows = train.agg(F.avg("_label"), F.count(F.lit(1))).first()
    if average is None:
        raise ValueError(f"no row to train on up to {fold.start}")
    # A tree takes several small jobs: more tasks than these would cost more than they save.
    tasks = max(1, -(-rows // ROWS_PER_TASK))
    means = cut_lineage(key_means(train, spec, average, settings), "key-means")
    inputs = with_key(train, means, average, spec).select("_inputs", "_label", "_weight").repartition(tasks)
    # Every task of a tree is sent the lineage of its rows: from written rows it is short.
    checkpoint_dir(table.sparkSession)
    inputs = inputs.checkpoint()
    model = fit_trees(inputs, settings)
    value = F.expm1("_raw") if settings.log_target else F.col("_raw")
    scored = model.transform(with_key(held_out_rows(table, spec.time, fold), means, average, spec))
    return cut_lineage(scored.select(*map(quoted, keep), value.alias("prediction")), "scored")


def backtest(
    df: DataFrame, spec: PanelSpec, folds: Sequence[Fold], settings: BoostingSettings = BoostingSettings(),
    split: str = "split", at_once: int = 4,
) -> DataFrame:
    """Fit before each fold, predict the fold, and put the folds together.

    Rows without a target take no part. All folds read one binned table. Their fits are jobs of their own, ``at_once`` of them
    at a time, each in its scheduler pool, so that one fold's small steps fill the gaps between another's.
    """
    table = training_table(df, spec, min(fold.start for fold in folds), settings)
    keep = [name for name in table.columns if name not in ("_label", "_weight", "_features")]
    spark = df.sparkSession

    def run(i: int, fold: Fold) -> DataFrame:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fold-{i}")
        try:
            return _one_fold(table, spec, fold, keep, settings).withColumn(split, F.lit(i))
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    at_once = max(1, min(at_once, len(folds)))
    with ThreadPoolExecutor(at_once) as pool:
        scored = list(pool.map(inheritable_thread_target(spark)(run), range(len(folds)), folds))
    return reduce(DataFrame.unionByName, scored)


def run_backtest_job(
    spark: SparkSession,
    features: str,
    folder: str,
    line: str | None = None,
    settings: BoostingSettings = BoostingSettings(),
    folds: Sequence[Fold] | None = None,
    since: datetime = presets.TRAIN_SINCE,
) -> DataFrame:
    """Backtest on a feature table and write the error tables to ``folder``: by split and series, by series, by fold, and the folds' mean.

    Without ``line`` one model is fitted over all series, keyed by line and
    station; with it, one model over the stations of that line. Returns the
    scored rows, which are kept in the checkpoint folder so that the several
    passes over them do not score again.
    """
    table = read_features(spark, features, since=since, line=line)
    if line is None:
        key, table = "line_station", joined_key(table, presets.PANEL.keys, "line_station")
    else:
        key = "station"
    spec = PanelSpec(presets.PANEL.target, presets.PANEL.time, (key,), presets.PANEL.step)
    if folds is None:
        folds = make_folds(presets.LAST_TEST_HOUR, presets.FOLD_COUNT, presets.FOLD_DAYS)
    scored = backtest(table, spec, folds, settings)
    errors = backtest_errors(scored, key, spec.target)
    write_metrics(errors.by_split, errors.by_series, folder)
    write_fold_metrics(errors.folds, errors.mean, folder)
    return scored
