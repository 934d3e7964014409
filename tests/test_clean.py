import glob
from datetime import date, datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from panelcast.functions.text import pad_hour
from panelcast.operators.clean import clean_trips
from panelcast.plans import presets
from panelcast.plans.features import build_features, run_feature_job
from panelcast.session import checkpoint_dir
from panelcast.sources.holidays import (
    DHU_AL_HIJJA_10, RAMADAN_FEAST, SACRIFICE_FEAST, SHAWWAL_1, feast_starts, holiday_days, lunar_day, turkish_holidays,
)
from panelcast.sources.tables import read_features, write_features

SCHEMA = (
    "transition_date string, transition_hour int, line_name string, station_poi_desc_cd string, "
    "number_of_passage bigint, road_type string, town string"
)


def record(station, count, hour=9, line="M1", road="RAYLI", day="2024-01-05"):
    return (day, hour, line, station, count, road, "somewhere")


RECORDS = [
    record("FENER (DOGU)", 1),
    record("FENER GUNEY", 2),
    record("FENER", 4),
    record("FENER", 8, hour=10),
    record("HASTANE (DOGU/ADLIYE)", 16),
    record("SIRKECI-1", 1, line="T1"),
    record("SIRKECI-2", 2, line="T1"),
    record("CAMI", 5),
    record("X DOGUBEY", 6),
    record(None, 100),
    record("FENER", 100, road="OTOYOL"),
    record("FENER", 100, line="M9"),
    record("BOS", None),
    record("BOS", None),
]


def test_cleaning(spark):
    got = {
        (r.line_name, r.station, r.timestamp.hour): r.passage
        for r in clean_trips(spark.createDataFrame(RECORDS, SCHEMA), presets.RAIL_TRIPS).collect()
    }
    assert got == {
        ("M1", "FENER", 9): 7,
        ("M1", "FENER", 10): 8,
        ("M1", "HASTANE", 9): 16,
        ("T1", "SIRKECI", 9): 3,
        ("M1", "YAVUZSELIM", 9): 5,
        ("M1", "XBEY", 9): 6,
        ("M1", "BOS", 9): 0,
    }


def test_date_typed_day(spark):
    raw = spark.createDataFrame(RECORDS[:1], SCHEMA).selectExpr(
        "CAST(transition_date AS DATE) AS transition_date", "* EXCEPT (transition_date)"
    )
    assert clean_trips(raw, presets.RAIL_TRIPS).first().timestamp == datetime(2024, 1, 5, 9)


def test_malformed_day_is_an_error(spark):
    raw = spark.createDataFrame([record("A", 1, day="05.01.2024")], SCHEMA)
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|could not be parsed"):
        clean_trips(raw, presets.RAIL_TRIPS).collect()


def test_filters_and_columns_reach_the_scan(spark):
    path = checkpoint_dir(spark) + "/raw-trips"
    spark.createDataFrame(RECORDS, SCHEMA).write.mode("overwrite").parquet(path)
    plan = clean_trips(spark.read.parquet(path), presets.RAIL_TRIPS)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(road_type,RAYLI)" in plan and "In(line_name" in plan
    scan = plan[plan.index("ReadSchema"):].splitlines()[0]
    assert "town" not in scan


def test_feature_job(spark):
    raw = spark.createDataFrame(RECORDS, SCHEMA)
    holidays = turkish_holidays(spark, [2024])
    table = build_features(raw, holidays)
    assert len(table.columns) == 97
    kinds = dict(table.dtypes)
    assert kinds["is_holiday"] == "boolean" and kinds["timestamp"] == "timestamp_ntz"
    assert {kinds[c] for c in table.columns if c not in ("is_holiday", "timestamp", "line_name", "station")} == {"float"}
    path = checkpoint_dir(spark) + "/feature-table"
    run_feature_job(raw, holidays, path)
    line = read_features(spark, path, since=datetime(2024, 1, 5, 10), line="T1")
    assert "line_name" not in line.columns and len(line.columns) == 96
    assert [(r.station, r.passage, r.was_null) for r in line.collect()] == [("SIRKECI", None, 1.0)]
    plan = line._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(line_name" in plan


def test_only_one_digit_hours_are_padded(spark):
    got = [r.h for r in spark.createDataFrame([("9",), ("10",), ("123",), (None,)], "h string").select(pad_hour(F.col("h")).alias("h")).collect()]
    assert got == ["09", "10", "123", None]


def test_feasts_of_any_year(spark):
    # As announced where that is known; a feast may come twice in a year, and go on in the next one.
    assert feast_starts(2024, SHAWWAL_1) == [date(2024, 4, 10)] and feast_starts(2016, DHU_AL_HIJJA_10) == [date(2016, 9, 12)]
    assert len(feast_starts(2000, SHAWWAL_1)) == 2 and len(feast_starts(2006, DHU_AL_HIJJA_10)) == 2
    for announced, feast in ((RAMADAN_FEAST, SHAWWAL_1), (SACRIFICE_FEAST, DHU_AL_HIJJA_10)):
        computed = [lunar_day(lunar, *feast[:2]) for lunar in range(1429, 1450)]
        assert all(min(abs((first - day).days) for day in computed) <= 1 for first in announced)
        gaps = {(b - a).days for a, b in zip(computed, computed[1:])}
        assert gaps == {354, 355}
    # Thirty lunar years are 10631 days, and every year of a century has one or two feasts of each kind.
    assert (lunar_day(1451, 1, 1) - lunar_day(1421, 1, 1)).days == 10631
    assert all(len(feast_starts(y, f)) in (1, 2) for y in range(1950, 2050) for f in (SHAWWAL_1, DHU_AL_HIJJA_10))
    days = [r.day for r in turkish_holidays(spark, [1998, 2040]).orderBy("day").collect()]
    assert len(days) == len(set(days)) and {d.year for d in days} == {1998, 2040}
    assert len(turkish_holidays(spark, [1998], without_feasts=True).collect()) == 5
    last = feast_starts(2006, DHU_AL_HIJJA_10)[-1]
    assert last > date(2006, 12, 28) and last + timedelta(days=3) in holiday_days([2007])


def test_a_range_of_time_is_few_row_groups(spark):
    """Rows come in no order; files are few, and a month of one line lies in few of its row groups."""
    df = spark.range(48 * 8784).selectExpr(
        "TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(0, CAST(id DIV 48 AS INT)) AS timestamp", "concat('L', id % 3) AS line_name",
        "CAST(id % 48 AS STRING) AS station", "CAST(rand(1) * 1e6 AS FLOAT) AS f",
    ).repartition(7)
    path = checkpoint_dir(spark) + "/pruned"
    write_features(df, path, rows_per_group=4000)
    assert read_features(spark, path).count() == df.count()
    files = glob.glob(f"{path}/line_name=L1/*.parquet")
    assert 1 <= len(files) <= 12
    inside = groups = 0
    for file in files:
        data = pq.ParquetFile(file)
        column = data.schema_arrow.names.index("timestamp")
        for i in range(data.num_row_groups):
            bounds = data.metadata.row_group(i).column(column).statistics
            groups += 1
            inside += bounds.max >= datetime(2024, 5, 1) and bounds.min < datetime(2024, 6, 1)
    assert groups >= 30 and inside <= 0.2 * groups
    line = read_features(spark, path, since=datetime(2024, 5, 1), line="L1")
    assert "GreaterThanOrEqual(timestamp" in line._jdf.queryExecution().executedPlan().toString()
    assert line.count() == df.where("line_name = 'L1' AND timestamp >= TIMESTAMP_NTZ'2024-05-01'").count()
    write_features(df.drop("timestamp"), path + "-plain")
    assert spark.read.parquet(path + "-plain").count() == df.count()
