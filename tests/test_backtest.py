import math
from datetime import datetime, timedelta
from uuid import uuid4

from pyspark.sql import functions as F

from panelcast.operators.folds import make_folds
from panelcast.operators.history import add_history_features
from panelcast.plans.backtest import (
    BINS, BoostingSettings, FeatureBins, backtest, fit_trees, joined_key, key_means, run_backtest_job, training_table, with_key, with_label,
)
from panelcast.session import checkpoint_dir
from panelcast.sources.tables import write_features
from panelcast.spec import PanelSpec


def test_backtest(spark):
    first = datetime(2024, 1, 1)
    rows = [
        (first + timedelta(days=i), "L", s, (10 if s == "a" else 200) + 5 * (i % 7) if i % 11 else None)
        for i in range(160) for s in ("a", "b")
    ]
    # A series that exists in no training range.
    rows += [(first + timedelta(days=150), "L", "new", 50)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, line string, station string, v bigint")
    wide = PanelSpec("v", "t", ("line", "station"), step="1d")
    panel = joined_key(add_history_features(df, wide, ("1 week",), (7,), 7), wide.keys, "key")
    assert "line" not in panel.columns
    spec = PanelSpec("v", "t", ("key",), step="1d")
    folds = make_folds(first + timedelta(days=159), 2, 20)
    settings = BoostingSettings(n_estimators=4, learning_rate=0.5, min_rows_per_leaf=1)
    got = backtest(panel, spec, folds, settings).cache()
    known = panel.where("v IS NOT NULL")
    expected = sum(
        known.where((F.col("t") > F.lit(f.start).cast("timestamp_ntz")) & (F.col("t") <= F.lit(f.end).cast("timestamp_ntz"))).count()
        for f in folds
    )
    rows = got.collect()
    assert len(rows) == expected and {r.split for r in rows} == {0, 1}
    assert all(r.prediction is not None and math.isfinite(r.prediction) for r in rows)
    # The two levels are told apart.
    mean = {k: sum(r.prediction for r in rows if r.key == k) / sum(r.key == k for r in rows) for k in ("L_a", "L_b")}
    assert mean["L_b"] > 3 * mean["L_a"]
    assert any(r.key == "L_new" for r in rows)


def test_backtest_job(spark):
    """Feature table on disk, one line or all lines, error tables out."""
    first = datetime(2024, 1, 1)
    rows = [
        (first + timedelta(days=i), line, s, 20 + 3 * (i % 7), float(i % 7), i % 2 == 0)
        for i in range(60) for line, s in (("M1", "a"), ("M1", "b"), ("T1", "a"))
    ]
    rows += [(first, "M1", "c", None, 1.0, True)]
    root = f"{checkpoint_dir(spark)}/backtest-{uuid4().hex}"
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, line_name string, station string, passage bigint, f double, g boolean")
    write_features(df, f"{root}/features")
    folds = make_folds(first + timedelta(days=59), 2, 10)
    settings = BoostingSettings(n_estimators=2, min_rows_per_leaf=1)
    scored = run_backtest_job(spark, f"{root}/features", f"{root}/all", settings=settings, folds=folds)
    assert scored.count() == 60
    by_split = spark.read.parquet(f"{root}/all/by_split")
    assert {(r.split, r.line_station) for r in by_split.collect()} == {(i, k) for i in (0, 1) for k in ("M1_a", "M1_b", "T1_a")}
    run_backtest_job(spark, f"{root}/features", f"{root}/m1", line="M1", settings=settings, folds=folds)
    by_series = spark.read.parquet(f"{root}/m1/by_series")
    assert by_series.columns == ["station", "rmse", "medae", "mae", "mape"]
    assert {r.station for r in by_series.collect()} == {"a", "b"}


    folds_table = spark.read.parquet(f"{root}/m1/folds").orderBy("split").collect()
    (mean,) = spark.read.parquet(f"{root}/m1/mean").collect()
    assert [r.split for r in folds_table] == [0, 1]
    for name in ("rmse", "medae", "mape", "medae_weighted"):
        assert math.isclose(mean[name], sum(r[name] for r in folds_table) / 2)


def test_weights_and_labels(spark):
    df = spark.createDataFrame([("a", 0, None), ("a", 1, 2.0), ("a", 9, 3.0)], "key string, v bigint, f double")
    got = with_label(df, PanelSpec("v", "t", ("key",)), BoostingSettings()).collect()
    assert [round(r._label, 9) for r in got] == [0, round(math.log(2), 9), round(math.log(10), 9)]
    assert [round(r._weight, 9) for r in got] == [round(1 / math.log(k), 9) for k in (2, 2, 10)]


def test_bins(spark):
    rows = [(float(i), None if i % 3 else 7.0, i % 2 == 0, None) for i in range(200)] + [(None, None, None, None), (float("inf"), 8.0, True, None)]
    df = spark.createDataFrame(rows, "a double, `b c` double, d boolean, e double")
    bins = FeatureBins.of(df, df.columns)
    got = bins.apply(df, "v").collect()
    assert all(len(r.v) == 4 for r in got) and len(bins.edges["a"]) <= BINS + 1
    a = [r.v[0] for r in got if r.a is not None and r.a < 200]
    assert a == sorted(a) and a[0] == 0 and len(set(a)) == BINS  # in order, and all bins used
    missing = got[-2].v
    assert missing[0] > max(a) and {r.v[1] for r in got if r["b c"] == 7.0}.isdisjoint({missing[1]})
    assert len({(r.d, r.v[2]) for r in got}) == 3 and len({r.v[3] for r in got}) == 1


def test_series_means(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0), (None, 6.0)], "key string, _label double")
    spec = PanelSpec("v", "t", ("key",))
    means = key_means(train, spec, 5.0, BoostingSettings(key_prior=2.0))
    assert {r.key: (r._key_mean, r._key_rows) for r in means.collect()} == {"a": (14 / 4, 2.0), "b": (20 / 3, 1.0), None: (16 / 3, 1.0)}
    rows = spark.createDataFrame([("a", 1), ("zz", 2), (None, 3)], "key string, i int")
    from pyspark.ml.feature import VectorAssembler

    rows = VectorAssembler(inputCols=["i"], outputCol="_features").transform(rows)
    got = {r.key: r._inputs.toArray().tolist() for r in with_key(rows, means, 5.0, spec).collect()}
    assert got == {"a": [1.0, 3.5, 2.0], "zz": [2.0, 5.0, 0.0], None: [3.0, 16 / 3, 1.0]}


def test_many_series_fit(spark):
    """More series than any list of categories would take, and one that only the fold has."""
    first = datetime(2024, 1, 1)
    df = spark.range(3000).selectExpr(
        "CAST(id AS STRING) AS key", "explode(sequence(0, 5)) AS day", "id % 50 + 1 AS v"
    ).selectExpr("key", f"TIMESTAMP_NTZ'{first}' + make_dt_interval(day) AS t", "v", "CAST(day AS DOUBLE) AS f")
    df = df.unionByName(spark.createDataFrame([("new", first + timedelta(days=5), 9, 5.0)], df.schema))
    folds = make_folds(first + timedelta(days=5), 1, 1)
    got = backtest(df, PanelSpec("v", "t", ("key",), step="1d"), folds, BoostingSettings(n_estimators=3, learning_rate=0.5, weighted=False)).collect()
    assert len(got) == 3001 and len({r.key for r in got}) == 3001
    # The series' own level is what tells them apart.
    low = [r.prediction for r in got if r.v <= 10 and r.key != "new"]
    high = [r.prediction for r in got if r.v > 40]
    assert sum(high) / len(high) > 2 * sum(low) / len(low)


def test_training_table_is_in_order_of_time(spark):
    first = datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", first + timedelta(hours=7 * i % 100), i, float(i)) for i in range(100)], "key string, t timestamp_ntz, v bigint, f double")
    table = training_table(df.repartition(4), PanelSpec("v", "t", ("key",)), first + timedelta(hours=50), BoostingSettings())
    assert table.count() == 100 and table.columns == ["key", "t", "v", "f", "_label", "_weight", "_features"]
    plan = table.where("t <= timestamp_ntz'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(t), LessThanOrEqual(t" in plan


def test_trees_are_fitted_from_written_rows(spark, monkeypatch):
    """The many small jobs of a fit carry no plan of how their rows came about, and no more tasks than the rows need."""
    seen = []

    def fit(train, settings):
        seen.append((train._jdf.queryExecution().executedPlan().toString(), train.rdd.getNumPartitions(), train.count()))
        return fit_trees(train, settings)

    monkeypatch.setattr("panelcast.plans.backtest.fit_trees", fit)
    first = datetime(2024, 1, 1)
    df = spark.createDataFrame([(k, first + timedelta(days=i), i + 1, float(i)) for i in range(20) for k in "ab"], "key string, t timestamp_ntz, v bigint, f double")
    folds = make_folds(first + timedelta(days=19), 1, 5)
    assert backtest(df, PanelSpec("v", "t", ("key",), step="1d"), folds, BoostingSettings(n_estimators=1, min_rows_per_leaf=1)).count() == 10
    ((plan, tasks, rows),) = seen
    assert "ExistingRDD" in plan and not any(word in plan for word in ("Exchange", "FileScan", "Join"))
    assert (tasks, rows) == (1, 30)
