import random
from datetime import datetime, timedelta

import pandas as pd
import pytest

from panelcast.functions.sliding import STATISTICS
from panelcast.operators.history import add_history_features, add_lag_features, add_stat_features
from panelcast.spec import PanelSpec, Span

from helpers import back, brute_force, close


def panel(step_hours, steps, seed, scale=50, nulls=0.3, gaps=0.0, keys=("a", "b"), start=datetime(2023, 1, 20)):
    rng, out = random.Random(seed), []
    for key in keys:
        for i in range(steps):
            if rng.random() < gaps:
                continue
            value = None if rng.random() < nulls else rng.randint(0, scale)
            out.append((key, start + timedelta(hours=step_hours * i), value))
    return out


def check(spark, data, spec, intervals, horizon, kind="bigint", tolerance=1e-9, **options):
    df = spark.createDataFrame(data, f"k string, t timestamp_ntz, v {kind}")
    got = add_stat_features(df, spec, intervals, horizon, **options).collect()
    assert len(got) == len(data)
    for interval in intervals:
        want = brute_force(data, interval, horizon)
        for row in got:
            for name in STATISTICS:
                value = row[f"{name}_v_{interval.replace(' ', '_')}"]
                assert close(value, want[row.k, row.t][name], tolerance), (interval, name, row.k, row.t, value, want[row.k, row.t][name])


@pytest.mark.parametrize("native", [False, True])
def test_daily_panel_against_brute_force(spark, native):
    spec = PanelSpec("v", "t", ("k",), step="1d", block_days=50)
    check(spark, panel(24, 150, 1), spec, ("1 day", "1 week", "1 month", "3 months"), 30, native=native)


@pytest.mark.parametrize("native", [False, True])
def test_gaps_and_no_horizon(spark, native):
    spec = PanelSpec("v", "t", ("k",), step="1d", block_days=20)
    check(spark, panel(24, 120, 2, gaps=0.4), spec, ("1 week", "1 month"), 0, native=native)


def test_subdaily_panel_over_month_ends(spark):
    # 29, 30 and 31 March and 31 May all look back to the end of a shorter month.
    spec = PanelSpec("v", "t", ("k",), step="6h", block_days=30)
    data = panel(6, 560, 3, keys=("a",), start=datetime(2023, 1, 25))
    check(spark, data, spec, ("1 month", "3 months"), 0)


def test_native_month_frames_over_month_ends(spark):
    spec = PanelSpec("v", "t", ("k",), step="12h", block_days=366)
    data = panel(12, 200, 4, keys=("a",), start=datetime(2023, 1, 25))
    check(spark, data, spec, ("1 month",), 0, native=True)


def test_large_values_stay_exact(spark):
    # Fourth powers of these leave the 64-bit range; quiet stretches follow loud ones.
    rng = random.Random(5)
    data = [
        ("a", datetime(2024, 1, 1) + timedelta(hours=i), rng.randint(0, 3) if i % 48 < 30 else 10**7 + rng.randint(0, 9))
        for i in range(240)
    ]
    spec = PanelSpec("v", "t", ("k",), block_days=3)
    check(spark, data, spec, ("1 day", "6 hours"), 0, tolerance=1e-7)


def test_fractional_values(spark):
    rng = random.Random(6)
    data = [
        ("a", datetime(2024, 1, 1) + timedelta(hours=i), None if rng.random() < 0.2 else rng.random() * 100 - 0.5)
        for i in range(120)
    ]
    check(spark, data, PanelSpec("v", "t", ("k",), block_days=2), ("1 day",), 1, kind="double")


def test_values_without_logarithm(spark):
    data = [("a", datetime(2024, 1, 1) + timedelta(hours=i), v) for i, v in enumerate([3, -4, 5, 6, 7, -1, 2])]
    check(spark, data, PanelSpec("v", "t", ("k",)), ("1 hour",), 0)


@pytest.mark.parametrize(
    "values, expected",
    [
        ([7], dict(std=None, skew=None, kurt=None, slope=None, avg=7)),
        ([1, 2], dict(std=0.70710678, skew=None, kurt=None)),
        ([1, 2, 4], dict(skew=0.93521953, kurt=None)),
        ([1, 2, 4, 9], dict(skew=1.33093773, kurt=1.5, q25=1, q50=2, q75=4)),
        ([5, 5, 5, 5], dict(std=0, skew=None, kurt=None)),
        ([None, None], dict.fromkeys(STATISTICS)),
    ],
)
@pytest.mark.parametrize("native", [False, True])
def test_hand_cases(spark, values, expected, native):
    data = [("a", datetime(2024, 2, 28, 22) + timedelta(hours=i), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, v bigint")
    last = add_stat_features(df, PanelSpec("v", "t", ("k",)), ("1 day",), 0, native).orderBy("t").collect()[-1]
    for name, value in expected.items():
        assert close(last[f"{name}_v_1_day"], value, 1e-8), name


def test_month_frame_length(spark):
    """Each row counts itself and all hours back to the same hour a month before."""
    first = datetime(2023, 2, 1)
    data = [("a", first + timedelta(hours=i), 1) for i in range(24 * 119)]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, v bigint")
    got = add_stat_features(df, PanelSpec("v", "t", ("k",), block_days=45), ("1 month",), 0)
    month = Span.parse("1 month")
    for row in got.select("t", "sum_v_1_month").collect():
        start = max(back(row.t, month), first)
        assert row.sum_v_1_month == (row.t - start) / timedelta(hours=1) + 1
    assert got.where("t = timestamp_ntz'2023-03-30 00:00:00'").first().sum_v_1_month == 721


def test_no_look_ahead(spark):
    """Features at t do not depend on anything after t less the horizon."""
    data = panel(24, 140, 8, keys=("a",))
    cut = data[100][1]
    changed = [(k, t, 999 if t > cut - timedelta(days=30) else v) for k, t, v in data]
    spec = PanelSpec("v", "t", ("k",), step="1d", block_days=60)
    tables = []
    for rows in (data, changed):
        df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v bigint")
        full = add_history_features(df, spec, ("1 week", "1 month"), (30, 42), 30)
        tables.append({r.t: r[3:] for r in full.collect() if r.t <= cut})
    assert tables[0] == tables[1]


@pytest.mark.parametrize("gaps, block_days", [(0, 7), (0.3, 10), (0.3, 366)])
def test_lags_equal_self_joins(spark, gaps, block_days):
    data = panel(24, 90, 9, gaps=gaps)
    known = {(k, t): v for k, t, v in data}
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, v bigint")
    got = add_lag_features(df, PanelSpec("v", "t", ("k",), step="1d", block_days=block_days), (1, 7, 30)).collect()
    assert len(got) == len(data)
    for row in got:
        for lag in (1, 7, 30):
            assert row[f"v_lag_{lag}"] == known.get((row.k, row.t - timedelta(days=lag)))


def test_month_lags_multiply_rows_at_month_ends(spark):
    data = [("a", datetime(2023, 1, d), d) for d in (28, 29, 30, 31)] + [("a", datetime(2023, 2, 28), 0)]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, v bigint")
    got = add_lag_features(df, PanelSpec("v", "t", ("k",), step="1d"), (1,), unit="MONTH")
    assert sorted(r.v_lag_1 for r in got.where("v = 0").collect()) == [28, 29, 30, 31]


def test_combined_equals_separate(spark):
    data = panel(24, 120, 11)
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, v bigint")
    spec = PanelSpec("v", "t", ("k",), step="1d", block_days=40)
    both = add_history_features(df, spec, ("1 week",), (7, 14), 7)
    apart = add_lag_features(add_stat_features(df, spec, ("1 week",), 7), spec, (7, 14))
    assert both.columns == apart.columns
    assert sorted(both.collect(), key=lambda r: (r.k, r.t)) == sorted(apart.collect(), key=lambda r: (r.k, r.t))


@pytest.mark.parametrize("native", [False, True])
def test_rows_without_time_or_key_stay(spark, native):
    day = datetime(2024, 1, 1)
    data = [(k, day + timedelta(days=i), i) for k in ("a", None) for i in range(6)] + [("a", None, 7), ("a", None, 8), (None, None, 9)]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, v bigint")
    spec = PanelSpec("v", "t", ("k",), step="1d", block_days=2)
    rows = add_history_features(df, spec, ("1 day",), (1,), 1, native=native).collect()
    assert sorted(((r.k, r.t, r.v) for r in rows), key=str) == sorted(data, key=str)
    for row in rows:
        place = row.k is not None and row.t is not None
        assert row.v_lag_1 == (row.v - 1 if place and row.v else None)
        assert row.sum_v_1_day == ((row.v - 1 + max(row.v - 2, 0)) if place and row.v else None)


def test_whole_numbers_beyond_doubles(spark):
    data = [("a", datetime(2024, 1, 1) + timedelta(hours=i), 2**56 + i) for i in range(6)]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, v bigint")
    spec = PanelSpec("v", "t", ("k",), block_days=1)
    names = ["t", *(f"{s}_v_1_day" for s in ("min", "max", "sum"))]
    own, windows = (add_stat_features(df, spec, ("1 day",), 0, native).select(*names).orderBy("t").collect() for native in (False, True))
    assert own == windows
    assert [r.max_v_1_day for r in own] == [v for _, _, v in data]
    assert own[-1].sum_v_1_day == sum(v for _, _, v in data)
    last = add_stat_features(df, spec, ("1 day",), 0).orderBy("t").collect()[-1]
    assert [last[f"{q}_v_1_day"] - 2**56 for q in ("q25", "q50", "q75")] == [1, 2, 4]
    with pytest.raises(Exception):
        add_stat_features(df.selectExpr("k", "t", "9223372036854775807 AS v"), spec, ("1 day",), 0).collect()


@pytest.mark.parametrize("odd", [[float("inf")], [float("-inf")], [float("inf"), float("-inf")], [float("nan")], [1e300]])
def test_odd_numbers_as_in_window_aggregates(spark, odd):
    values = [1.0, 2.5, 4.0, *odd, 8.0, 9.0, 3.0, 2.0, 7.0]
    data = [("a", datetime(2024, 1, 1) + timedelta(hours=i), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, v double")
    spec = PanelSpec("v", "t", ("k",), block_days=1)
    # Higher moments of 1e300 leave the doubles; logarithms of -inf are skipped by one and null in the other.
    stats = [s for s in STATISTICS if s not in (("skew", "kurt", "std", "slope") if odd == [1e300] else ("geomean",) if odd[-1] < 0 else ())]
    names = ["t", *(f"{s}_v_2_hours" for s in stats)]
    own, windows = (add_stat_features(df, spec, ("2 hours",), 0, native).select(*names).orderBy("t").collect() for native in (False, True))
    for a, b in zip(own, windows):
        for name in names[1:]:
            x, y = a[name], b[name]
            same = x == y or (x is not None and y is not None and (x != x and y != y or abs(x - y) <= 1e-9 * abs(y)))
            assert same, (name, a.t, x, y)


@pytest.mark.parametrize("kind, native", [("bigint", False), ("bigint", True), ("double", False)])
def test_two_rows_of_one_time_are_an_error(spark, kind, native):
    day = datetime(2024, 1, 1)
    spec = PanelSpec("v", "t", ("k",), step="1d", block_days=2)
    one = float(1) if kind == "double" else 1
    data = [("a", day + timedelta(days=i), i * one) for i in range(5)] + [("b", day, one), (None, day, one), (None, day, one), ("b", None, one), ("b", None, one)]
    fine = spark.createDataFrame(data, f"k string, t timestamp_ntz, v {kind}")
    assert add_history_features(fine, spec, ("1 day",), (1,), 1, native=native).count() == len(data)
    twice = spark.createDataFrame([*data, ("a", day + timedelta(days=3), one)], f"k string, t timestamp_ntz, v {kind}")
    for features in (add_stat_features(twice, spec, ("1 day",), 0, native).select("avg_v_1_day"), add_lag_features(twice, spec, (1,)).select("v_lag_1")):
        with pytest.raises(Exception, match="two rows of one time"):
            features.collect()


def test_lags_below_a_second(spark):
    start = datetime(2024, 1, 1)
    data = [("a", start + timedelta(milliseconds=500 * i), i) for i in range(7300)]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, v bigint")
    got = add_lag_features(df, PanelSpec("v", "t", ("k",), step="1s"), (1,), unit="HOUR").where("v_lag_1 IS NOT NULL").collect()
    assert len(got) == 100 and all(r.v - r["v_lag_1"] == 7200 for r in got)


def test_values_of_very_different_size(spark):
    """A block of wide spread: sums and extremes stay exact, moments within the spread's resolution."""
    rng = random.Random(12)
    data = [("a", datetime(2024, 1, 1) + timedelta(hours=i), rng.choice([3, 2**55 + rng.randrange(10**15), -(2**50)])) for i in range(100)]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, v bigint")
    got = add_stat_features(df, PanelSpec("v", "t", ("k",), block_days=2), ("1 day",), 0).orderBy("t").collect()
    for i, row in enumerate(got):
        values = [v for _, _, v in data[max(0, i - 24): i + 1]]
        assert (row.sum_v_1_day, row.min_v_1_day, row.max_v_1_day) == (sum(values), min(values), max(values))
        assert close(row.abs_energy_v_1_day, float(sum(v * v for v in values)), 1e-12)
    want = brute_force(data, "1 day", 0)
    for row in got[5:]:
        for name in ("avg", "std", "slope"):
            assert close(row[f"{name}_v_1_day"], want[row.k, row.t][name], 1e-9), name
        for name in ("skew", "kurt"):
            assert close(row[f"{name}_v_1_day"], want[row.k, row.t][name], 1e-5), name


def test_month_lags_of_many_rows(spark):
    """As one left join per lag: rows multiply at month ends, rows without a place stay, repeated rows are rows."""
    start = datetime(2023, 12, 20)
    data = [(k, start + timedelta(days=i), i if i % 7 else None) for k in ("a", "b") for i in range(110) if (i + len(k)) % 9]
    data += [("a", None, 5), (None, start, 6), (None, None, 7), (None, None, 7), ("b", start + timedelta(days=42), 400)]
    spec = PanelSpec("v", "t", ("k",), step="1d")
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(data)], "k string, t timestamp_ntz, v bigint, `v w` int")
    got = add_lag_features(df, spec, (1, 2), unit="MONTH")
    assert got.columns == ["k", "t", "v", "v w", "v_lag_1", "v_lag_2"]
    want = []
    for i, (k, t, v) in enumerate(data):
        found = [[x for kk, tt, x in data if k is not None and t is not None and kk == k and tt is not None and back_to(tt, n) == t] or [None] for n in (1, 2)]
        want += [(k, t, v, i, a, b) for a in found[0] for b in found[1]]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def back_to(moment, months):
    """The time that many months later, at the last day of a shorter month."""
    return (pd.Timestamp(moment) + pd.DateOffset(months=months)).to_pydatetime()
