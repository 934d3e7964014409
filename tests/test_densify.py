from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from panelcast.operators.clean import clean_trips
from panelcast.operators.densify import densify, duplicate_keys, time_axis
from panelcast.plans.features import grid_days
from panelcast.plans.presets import RAIL_TRIPS
from panelcast.spec import PanelSpec

START = datetime(2024, 1, 30, 22)
SCHEMA = "ts timestamp_ntz, line string, station string, v bigint, note string"


def rows():
    hour = timedelta(hours=1)
    return [
        (START, "A", "x", 5, "first"),
        (START + 3 * hour, "A", "x", None, "null"),
        (START + 50 * hour, "A", "x", 7, "gap before"),
        (START + 60 * hour, "A", "y", 1, "starts late"),
        (START + 99 * hour, "B", "x", 2, "only the end"),
        (START + timedelta(minutes=30), "B", "x", 9, "off the grid"),
        (START + 20 * hour, "B", None, 4, "no station"),
        (None, "B", "x", 4, "no time"),
    ]


@pytest.mark.parametrize("block_days", [1, 2, 366])
def test_grid_is_complete(spark, block_days):
    spec = PanelSpec("v", "ts", ("line", "station"), block_days=block_days)
    df = spark.createDataFrame(rows(), SCHEMA)
    got = {(r.line, r.station, r.ts): r for r in densify(df, spec).collect()}
    times = [START + timedelta(hours=i) for i in range(100)]
    series = [("A", "x"), ("A", "y"), ("B", "x"), ("B", None)]
    assert set(got) == {(*s, t) for s in series for t in times}
    known = {(r[1], r[2], r[0]): r for r in rows() if r[2] and r[0] in times}
    for key, row in got.items():
        want = known.get(key)
        assert row.v == (want[3] if want else None)
        assert row.note == (want[4] if want else None)
        assert row.was_null == int(row.v is None)


def test_axis_spans_blocks(spark):
    spec = PanelSpec("v", "ts", ("line", "station"), block_days=1)
    got = [r.ts for r in time_axis(spark.createDataFrame(rows(), SCHEMA), spec).orderBy("ts").collect()]
    assert got == [START + timedelta(hours=i) for i in range(100)]


def test_single_row_panel(spark):
    spec = PanelSpec("v", "ts", ("line", "station"))
    assert densify(spark.createDataFrame(rows()[:1], SCHEMA), spec).count() == 1


def test_repeated_observations_are_kept(spark):
    spec = PanelSpec("v", "ts", ("line", "station"))
    df = spark.createDataFrame([*rows()[:3], rows()[0]], SCHEMA)
    got = densify(df, spec)
    assert got.count() == 52 and got.where(F.col("ts") == F.lit(START)).count() == 2
    assert duplicate_keys(df, spec).count() == 1


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError):
        densify(spark.createDataFrame(rows(), SCHEMA), PanelSpec("w", "ts", ("line",)))


def test_session_zone_does_not_matter(spark):
    """The grid runs over a night in which New York has no two o'clock."""
    first, last = datetime(2024, 3, 9), datetime(2024, 3, 13)
    df = spark.createDataFrame([(first, "A", "x", 1, ""), (last, "A", "x", 2, "")], SCHEMA)
    spec = PanelSpec("v", "ts", ("line", "station"), block_days=1)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert densify(df, spec).count() == 97 and time_axis(df, spec).count() == 97
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("step", ["1h", "7h", "1d", "3d"])
def test_days_of_the_grid(spark, step):
    first = datetime(2024, 2, 27, 5)
    rows = [("a", first, 1), ("b", first + timedelta(days=9, hours=20), 2), ("b", first + timedelta(hours=7), 3)]
    spec = PanelSpec("v", "t", ("k",), step=step)
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v bigint")
    want = {r[0] for r in time_axis(df, spec).selectExpr("to_date(t)").distinct().collect()}
    got = [r["day"] for r in grid_days(df, spec).collect()]
    assert set(got) == want and len(got) == len(want)


def test_totals_are_not_filtered_record_by_record(spark):
    """Names and hours of raw trips are read once per raw code, day and hour, whatever densify then asks of them."""
    raw = spark.range(100).selectExpr(
        "'2024-01-0' || (1 + id % 3) AS transition_date", "CAST(0 AS INT) AS transition_hour", "'M1' AS line_name",
        "'OTOGAR ' || (1 + id % 2) AS station_poi_desc_cd", "id AS number_of_passage", "'RAYLI' AS road_type",
    )
    spec = PanelSpec("passage", "timestamp", ("line_name", "station"), step="1d")
    grid = densify(clean_trips(raw, RAIL_TRIPS), spec)
    plan = grid._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Filter")]
    assert filters and not any("replace(" in line for line in filters)
    assert grid.count() == 6 and grid.where("was_null = 1").count() == 0


def test_keys_of_nan_are_no_observations(spark):
    nan = float("nan")
    df = spark.createDataFrame([(START, 1.0, 5), (START, nan, 6), (START, None, 7)], "ts timestamp_ntz, k double, v bigint")
    got = {str(r.k): (r.v, r.was_null) for r in densify(df, PanelSpec("v", "ts", ("k",))).collect()}
    assert got == {"1.0": (5, 0), "nan": (None, 1), "None": (None, 1)}
