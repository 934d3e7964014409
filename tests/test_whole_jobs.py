from panelcast.plans import presets
from panelcast.plans.backtest import BoostingSettings
from panelcast_checks import queries


def test_backtest_query_has_the_presets_settings(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(queries, "daily_trip_features", lambda spark, folder: spark.createDataFrame([("M1", "a", 1)], "line_name string, station string, passage long"))
    monkeypatch.setattr(queries, "backtest", lambda panel, spec, folds, settings: seen.append((len(folds), settings)) or panel)
    monkeypatch.setattr(queries, "error_table", lambda scored, groups, target: scored)
    queries.QUERIES["boosted_backtest"](spark, "")
    assert seen == [(presets.FOLD_COUNT, BoostingSettings())] and BoostingSettings().n_estimators == 300


def test_hourly_features_are_whole(spark, monkeypatch):
    """The query writes the whole hourly grid with every frame and lag; its rows are compared with SQL in test_queries."""
    seen = []
    write = queries.write_features
    monkeypatch.setattr(queries, "write_features", lambda df, path: seen.append(df) or write(df, path))
    got = queries.QUERIES["feature_table_hourly"](spark, "/root/testdata/sf0.001")
    (written,) = seen
    assert {f"passage_lag_{n}" for n in presets.LAGS} <= set(written.columns)
    assert {f"avg_passage_{n}" for n in ("1_day", "1_week", "1_month", "3_months")} <= set(written.columns)
    assert set(got.columns) == set(written.columns) - {"line_name"}
    assert {r[0] for r in got.selectExpr("hour(timestamp)").distinct().collect()} == set(range(24))
