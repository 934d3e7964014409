import random
import statistics
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators.folds import assign_fold, held_out_rows, make_folds, train_rows
from panelcast.operators import medians
from panelcast.operators.medians import grouped_median
from panelcast.operators.metrics import backtest_errors, error_table, fold_metrics, forecast_metrics, mean_over_folds

from helpers import close


def scored(seed=1, size=400):
    rng = random.Random(seed)
    # One series holds most rows, and many of its errors are equal.
    out = []
    for _ in range(size):
        series = "hot" if rng.random() < 0.7 else rng.choice(["b", "c", "d"])
        y = rng.randint(0, 40)
        p = y + rng.choice([0, 0, 2, 2, 2, rng.gauss(0, 9)]) if series == "hot" else y + rng.gauss(0, 5)
        out.append((rng.randint(0, 3), series, y, float(p)))
    return out


def plain(rows):
    y, p = np.array([r[2] for r in rows], float), np.array([r[3] for r in rows])
    e = np.abs(y - p)
    return dict(
        rmse=float(np.sqrt(np.mean(e**2))), medae=float(np.median(e)), mae=float(e.mean()),
        mape=float((e / np.maximum(np.abs(y), np.finfo(float).eps)).mean()),
    )


@pytest.fixture(scope="module")
def data():
    return scored()


@pytest.fixture(scope="module")
def results(spark, data):
    return spark.createDataFrame(data, "split int, series string, y bigint, prediction double")


def test_both_tables(results, data):
    by_split, by_series = forecast_metrics(results, "series", "y")
    assert by_split.columns == ["split", "series", "rmse", "medae", "mae", "mape"]
    rows = by_split.collect()
    assert [(r.split, r.series) for r in rows] == sorted({(d[0], d[1]) for d in data})
    for r in rows:
        want = plain([d for d in data if d[:2] == (r.split, r.series)])
        assert all(close(r[m], v, 1e-6) for m, v in want.items())
    for r in by_series.collect():
        want = plain([d for d in data if d[1] == r.series])
        assert all(close(r[m], v, 1e-6) for m, v in want.items())


def weighted_median(pairs):
    pairs = sorted((e, w) for e, w in pairs)
    total, run = sum(w for _, w in pairs), 0
    for i, (e, w) in enumerate(pairs):
        run += w
        if abs(2 * run - total) < 1e-9:
            return (e + next(x for x, _ in pairs[i + 1:] if x > e)) / 2 if any(x > e for x, _ in pairs[i + 1:]) else e
        if 2 * run > total:
            return e


def test_fold_metrics(results, data):
    per_fold = {r.split: r for r in fold_metrics(results, "y").collect()}
    assert set(per_fold) == {0, 1, 2, 3}
    for split, row in per_fold.items():
        rows = [d for d in data if d[0] == split]
        want = plain(rows)
        assert all(close(row[m], want[m], 1e-9) for m in ("rmse", "medae", "mape"))
        assert close(row.medae_weighted, weighted_median([(abs(r[2] - r[3]), 1 / r[2]) for r in rows if r[2] > 0]))
    mean = mean_over_folds(fold_metrics(results, "y")).first()
    assert close(mean.rmse, statistics.fmean(r.rmse for r in per_fold.values()))


@pytest.mark.parametrize("values", [[3.0], [1.0, 2.0], [0.0, 0.0, 0.0, 5.0], [2.0] * 9, [1.0, 1.0, 3.0, 4.0], [0.1, 1e-9, 1e9]])
def test_median_hand_cases(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").withColumn("g", F.lit(None).cast("string"))
    assert grouped_median(df, ["g"], F.col("v")).first()["median"] == statistics.median(values)


def test_weighted_median_meets_half(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (5.0, 2.0), (9.0, None), (9.0, 0.0)], "v double, w double").withColumn("g", F.lit(1))
    assert grouped_median(df, ["g"], F.col("v"), F.col("w")).first()["median"] == 3.5


def test_folds(spark):
    folds = make_folds(datetime(2024, 6, 30, 23))
    assert [f.start for f in folds] == [datetime(2024, 6, 30, 23) - timedelta(days=d) for d in (120, 90, 60, 30)]
    assert folds[-1].end == datetime(2024, 6, 30, 23)
    times = [f.start for f in folds] + [f.start + timedelta(hours=1) for f in folds] + [folds[-1].end, folds[-1].end + timedelta(hours=1)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    got = sorted((r.t, r.split) for r in assign_fold(df, "t", folds).collect())
    want = sorted((t, i) for i, f in enumerate(folds) for t in times if f.start < t <= f.end)
    assert got == want
    assert {r.t for r in train_rows(df, "t", folds[1]).collect()} == {t for t in times if t <= folds[1].start}
    assert {r.t for r in held_out_rows(df, "t", folds[1]).collect()} == {t for t in times if folds[1].start < t <= folds[1].end}


def test_overlapping_folds_repeat_rows(spark):
    first, second = make_folds(datetime(2024, 3, 1), 1, 10)[0], make_folds(datetime(2024, 3, 3), 1, 10)[0]
    df = spark.createDataFrame([(datetime(2024, 2, 28),)], "t timestamp_ntz")
    assert sorted(r.split for r in assign_fold(df, "t", [first, second]).collect()) == [0, 1]


def test_failed_predictions_are_not_left_out(spark):
    rows = [("a", 1.0, 2.0), ("a", 3.0, float("nan")), ("b", 1.0, None), ("c", 1.0, 3.0), ("c", None, 1.0)]
    got = {r.k: r.mae for r in error_table(spark.createDataFrame(rows, "k string, y double, prediction double"), ["k"], "y").collect()}
    assert got == {"a": None, "b": None, "c": 2.0}


def test_fold_without_positive_actuals_stays(spark):
    rows = [(0, 2.0, 3.0), (1, 0.0, 1.0)]
    got = {r.split: r.medae_weighted for r in fold_metrics(spark.createDataFrame(rows, "split int, y double, prediction double"), "y").collect()}
    assert got == {0: 1.0, 1: None}


@pytest.mark.parametrize("failure", [None, float("nan")])
def test_a_failed_fold_has_no_weighted_median_and_no_mean(spark, failure):
    rows = [(0, 2.0, 3.0), (1, 4.0, 5.0), (1, 4.0, failure), (2, 0.0, 1.0)]
    per_fold = fold_metrics(spark.createDataFrame(rows, "split int, y double, prediction double"), "y")
    assert {r.split: r.medae_weighted for r in per_fold.collect()} == {0: 1.0, 1: None, 2: None}
    assert set(mean_over_folds(per_fold).first()) == {None}
    sound = mean_over_folds(per_fold.where("split <> 1")).first()
    assert sound.medae == 1.0 and sound.medae_weighted == 1.0


def test_values_close_together(spark, monkeypatch):
    """One narrow range holds all values: it is cut again and again, and the result stays the exact median."""
    rng = random.Random(21)
    rows = [("a", 1000 + rng.random() * 5) for _ in range(3001)] + [("b", 7.0)] * 2000 + [("b", 7.0 + rng.random() * 1e-9) for _ in range(999)]
    rows += [("c", 0.0)] * 10 + [("c", 5e-324), ("d", 1e300), ("d", 1.1e300), (None, 3.0), (None, 4.0), (None, 4.0)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(5)
    want = {k: statistics.median([x for kk, x in rows if kk == k]) for k in ("a", "b", "c", "d", None)}
    for small in (50, 10**6):
        monkeypatch.setattr(medians, "SMALL", small)
        assert {r.k: r["median"] for r in grouped_median(df, ["k"], F.col("x")).collect()} == want


def test_weights_of_any_size(spark):
    rng = random.Random(22)
    groups = {"huge": 10.0**17, "tiny": 1e-200, "one": 1.0}
    rows = [(k, rng.randrange(30) * 1.5, scale * rng.choice([1, 2, 5, 0.25])) for k, scale in groups.items() for _ in range(301)]
    rows += [("one", 99.0, 0.0), ("one", 99.0, -1.0), ("one", 99.0, None), ("one", None, 1.0), ("none", 1.0, 0.0)]
    for k in groups:
        df = spark.createDataFrame([r for r in rows if r[0] in (k, "none")], "k string, x double, w double")
        got = {r.k: r["median"] for r in grouped_median(df, ["k"], F.col("x"), F.col("w")).collect()}
        pairs = sorted((x, w) for kk, x, w in rows if kk == k and x is not None and w is not None and w > 0)
        total, upto, reached, passed = sum(w for _, w in pairs), 0.0, None, None
        for x, w in pairs:
            upto += w
            reached = x if reached is None and 2 * upto >= total * (1 - 1e-12) else reached
            passed = x if passed is None and 2 * upto > total * (1 + 1e-12) else passed
        assert got == {k: (reached + passed) / 2}


def test_grouping_sets_keep_null_groups_apart(spark):
    rows = [(0, "a", 1.0), (0, None, 3.0), (1, None, 9.0), (None, "a", 5.0), (1, "a", 2.0)]
    values = spark.createDataFrame(rows, "split int, series string, _v double")
    got = medians.medians_of_sets(values, [["split", "series"], ["series"], ["split"]]).collect()
    both, series, split = ([r for r in got if r._set == medians.set_id(s, ["split", "series"])] for s in (["split", "series"], ["series"], ["split"]))
    assert {(r.split, r.series): r["median"] for r in both} == {(s, k): v for s, k, v in rows}
    assert {r.series: r["median"] for r in series} == {"a": 2.0, None: 6.0} and {r.split: r["median"] for r in split} == {0: 2.0, 1: 5.5, None: 5.0}


def test_all_tables_of_a_backtest(spark, results, data):
    """One pass gives what the tables give one by one."""
    errors = backtest_errors(results, "series", "y")
    by_split, by_series = forecast_metrics(results, "series", "y")
    assert errors.by_split.collect() == by_split.collect() and errors.by_series.collect() == by_series.collect()
    folds = fold_metrics(results, "y").orderBy("split").collect()
    assert errors.folds.collect() == folds
    (mean,) = errors.mean.collect()
    assert all(close(mean[m], sum(r[m] for r in folds) / len(folds)) for m in ("rmse", "medae", "mape", "medae_weighted"))


def test_few_rows_are_shuffled_for_a_median(spark):
    """Beside the histogram, only the rows of the middle range."""
    df = spark.range(200_000).selectExpr("id % 3 AS k", "pow(rand(5), 3) * 1e6 AS x")
    rows = []
    original = medians._middle
    found = grouped_median(df, ["k"], F.col("x"))
    try:
        medians._middle = lambda ranges, part, order: rows.append(ranges) or original(ranges, part, order)
        found = grouped_median(df, ["k"], F.col("x"))
        assert found.count() == 3
        assert rows[-1].count() < 20_000  # distinct values of the last middle ranges
    finally:
        medians._middle = original
