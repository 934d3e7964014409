"""One query per operator; ``SQL`` holds the counterpart where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelcast.functions.calendar import clock_cyclics
from panelcast.functions.columns import drop_columns
from panelcast.functions.errors import reciprocal_weight
from panelcast.functions.text import join_text, map_values, pad_hour, parse_hour_stamp, remove_all
from panelcast.functions.time import epoch_seconds
from panelcast.functions.types import narrow_double, narrow_numeric
from panelcast.operators.clean import clean_trips
from panelcast.operators.date_features import add_date_features, day_calendar
from panelcast.operators.densify import densify, distinct_series, time_axis, time_bounds
from panelcast.operators.folds import assign_fold, make_folds, since
from panelcast.operators.history import add_history_features, add_lag_features, add_stat_features, lag_columns, stat_columns
from panelcast.operators.metrics import backtest_errors, error_table, fold_metrics, forecast_metrics, mean_over_folds
from panelcast.plans import presets
from panelcast.plans.backtest import BoostingSettings, backtest, joined_key
from panelcast.plans.features import panel_features, run_feature_job
from panelcast.session import cut_lineage, run_folder
from panelcast.spec import PanelSpec
from panelcast.sources.holidays import holiday_days, turkish_holidays
from panelcast.sources.tables import one_line, read_features, read_trips, write_features, write_fold_metrics, write_metrics

from . import oracle
from .panels import (
    EVENT_TOTALS, EVENTS, ORDER_TOTALS, ORDERS, RAW_TRIPS, RULES, SHIPPED, SHIPPED_TOTALS,
    event_totals, order_totals, raw_trips, shipped_totals, table, trip_totals_sql,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query and, if given, its SQL counterpart."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            SQL[key] = sql
        return function

    return register


def nearest(column: Column, digits: int = 6) -> Column:
    return F.round(column + float(oracle.nudge(digits)), digits)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Every double column rounded."""
    return df.select(
        *(
            nearest(F.col(f"`{f.name}`"), digits).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f"`{f.name}`")
            for f in df.schema.fields
        )
    )


def comparable(df: DataFrame) -> DataFrame:
    """Statistics as the SQL counterparts give them: slope per day, energy as a whole number."""
    return rounded(
        df.withColumns(
            {
                **{c: F.col(c) * 86400 for c in df.columns if c.startswith("slope_")},
                **{c: F.col(c).cast("long") for c in df.columns if c.startswith("abs_energy_")},
            }
        )
    )


# --- sources, filters, projections -------------------------------------------------


@query("""
SELECT l_orderkey AS trip_id, l_quantity, l_shipdate FROM lineitem
WHERE l_returnflag = 'R' AND l_linestatus IN ('F', 'O') AND l_shipdate >= TIMESTAMP '1998-01-01' AND l_quantity IS NOT NULL""")
def scan_filter_rename(spark, folder):
    lines = read_trips(spark, f"{folder}/lineitem.parquet")
    kept = since(
        lines.where((F.col("l_returnflag") == "R") & F.col("l_linestatus").isin("F", "O")), "l_shipdate", datetime(1998, 1, 1)
    ).dropna(subset=["l_quantity"])
    unused = [c for c in lines.columns if c not in ("l_orderkey", "l_quantity", "l_shipdate")]
    return drop_columns(kept, *unused).withColumnRenamed("l_orderkey", "trip_id")


@query("""
SELECT p_brand, CAST(CAST(p_retailprice AS REAL) AS DOUBLE) AS price, CAST(CAST(p_size AS REAL) AS DOUBLE) AS size,
       p_size > 20 AS is_large
FROM (SELECT * EXCLUDE (p_partkey, p_name, p_type) FROM part) AS p""")
def narrow_to_float(spark, folder):
    part = drop_columns(table(spark, folder, "part"), "p_partkey", "p_name", "p_type")
    narrow = narrow_numeric(part.withColumn("is_large", F.col("p_size") > 20))
    # Back to double only so that both engines print the same digits.
    return narrow.select(
        "p_brand", F.col("p_retailprice").cast("double").alias("price"), F.col("p_size").cast("double").alias("size"),
        "is_large",
    )


@query("SELECT s_suppkey, CAST(CAST(s_acctbal AS REAL) AS DOUBLE) AS s_acctbal, s_nationkey FROM supplier")
def narrow_doubles_only(spark, folder):
    narrow = narrow_double(table(spark, folder, "supplier"))
    return narrow.select("s_suppkey", F.col("s_acctbal").cast("double").alias("s_acctbal"), "s_nationkey")


# --- text and time ------------------------------------------------------------------


@query("""
SELECT l_orderkey, l_linenumber, lpad(CAST(l_orderkey % 24 AS VARCHAR), 2, '0') AS hour_code,
       strptime(strftime(l_shipdate, '%Y-%m-%d') || '-' || lpad(CAST(l_orderkey % 24 AS VARCHAR), 2, '0') || '-00',
                '%Y-%m-%d-%H-%M') AS stamp,
       l_returnflag || '_' || l_linestatus AS code
FROM lineitem""")
def hour_stamps(spark, folder):
    hour = F.col("l_orderkey") % 24
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        pad_hour(hour).alias("hour_code"),
        parse_hour_stamp(F.date_format("l_shipdate", "yyyy-MM-dd"), hour).alias("stamp"),
        join_text("l_returnflag", "l_linestatus", separator="_").alias("code"),
    )


PART_REMOVED = (" ring", " bolt", "ECON")
PART_NAMES = {"red": "RED", "small": "red", "blue widget": "BLUE", "OMY": "CHEAP"}


@query("""
SELECT p_partkey,
       CASE name WHEN 'red' THEN 'RED' WHEN 'small' THEN 'red' WHEN 'blue widget' THEN 'BLUE' WHEN 'OMY' THEN 'CHEAP'
            ELSE name END AS name,
       CASE kind WHEN 'red' THEN 'RED' WHEN 'small' THEN 'red' WHEN 'blue widget' THEN 'BLUE' WHEN 'OMY' THEN 'CHEAP'
            ELSE kind END AS kind
FROM (SELECT p_partkey, replace(replace(replace(p_name, ' ring', ''), ' bolt', ''), 'ECON', '') AS name,
             replace(replace(replace(p_type, ' ring', ''), ' bolt', ''), 'ECON', '') AS kind FROM part) AS p""")
def name_cleanup(spark, folder):
    part = table(spark, folder, "part").select(
        "p_partkey", remove_all(F.col("p_name"), PART_REMOVED).alias("name"), remove_all(F.col("p_type"), PART_REMOVED).alias("kind")
    )
    return map_values(map_values(part, "name", PART_NAMES), "kind", PART_NAMES)


@query("""
SELECT o_orderkey, o_orderdate + INTERVAL 30 DAY AS later, o_orderdate - INTERVAL 1 MONTH AS month_before,
       o_orderdate - INTERVAL 3 MONTH AS quarter_before, CAST(epoch(o_orderdate) AS BIGINT) AS seconds
FROM orders""")
def date_shifts(spark, folder):
    day = F.col("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        (day + F.expr("INTERVAL 30 DAY")).alias("later"),
        (day - F.expr("INTERVAL 1 MONTH")).alias("month_before"),
        (day - F.expr("INTERVAL 3 MONTH")).alias("quarter_before"),
        epoch_seconds(day).alias("seconds"),
    )


@query(f"""
SELECT o_orderkey, {oracle.rounded('ln(1 + o_totalprice)')} AS label,
       {oracle.rounded('exp(ln(1 + o_totalprice)) - 1', 4)} AS restored,
       CASE WHEN o_totalprice > 0 THEN {oracle.rounded('1 / o_totalprice', 12)} END AS weight
FROM orders""")
def target_transform(spark, folder):
    price = F.col("o_totalprice")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        nearest(F.log1p(price)).alias("label"),
        nearest(F.expm1(F.log1p(price)), 4).alias("restored"),
        nearest(reciprocal_weight(price), 12).alias("weight"),
    )


# --- totals and grid ----------------------------------------------------------------


@query(EVENT_TOTALS)
def hourly_event_totals(spark, folder):
    return event_totals(spark, folder)


@query(f"SELECT min(ts) AS first_time, max(ts) AS last_time FROM ({EVENT_TOTALS}) AS t")
def panel_bounds(spark, folder):
    return time_bounds(event_totals(spark, folder), EVENTS)


@query(f"SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM ({SHIPPED_TOTALS}) AS t")
def hourly_axis(spark, folder):
    return time_axis(shipped_totals(spark, folder), SHIPPED)


@query("SELECT DISTINCT o_orderpriority FROM orders")
def series_keys(spark, folder):
    return distinct_series(order_totals(spark, folder), ORDERS)


@query(oracle.dense(EVENT_TOTALS, EVENTS, "1 HOUR"))
def dense_hourly_events(spark, folder):
    return densify(event_totals(spark, folder), EVENTS)


@query(oracle.dense(ORDER_TOTALS, ORDERS, "1 DAY"))
def dense_daily_orders(spark, folder):
    return densify(order_totals(spark, folder), ORDERS)


@query(oracle.dense(SHIPPED_TOTALS, SHIPPED, "1 HOUR"))
def dense_hourly_shipments(spark, folder):
    return densify(shipped_totals(spark, folder), SHIPPED)


@query(trip_totals_sql())
def trip_totals(spark, folder):
    return clean_trips(raw_trips(spark, folder), RULES)


# --- history features ---------------------------------------------------------------

DENSE_EVENTS = oracle.dense(EVENT_TOTALS, EVENTS, "1 HOUR")
DENSE_ORDERS = oracle.dense(ORDER_TOTALS, ORDERS, "1 DAY")
DENSE_SHIPPED = oracle.dense(SHIPPED_TOTALS, SHIPPED, "1 HOUR")


@query(oracle.lag_features(DENSE_EVENTS, EVENTS, (1, 7, 14)))
def lags_hourly_events(spark, folder):
    return add_lag_features(densify(event_totals(spark, folder), EVENTS), EVENTS, (1, 7, 14))


@query(oracle.lag_features(DENSE_ORDERS, ORDERS, presets.LAGS))
def lags_daily_orders(spark, folder):
    return add_lag_features(densify(order_totals(spark, folder), ORDERS), ORDERS, presets.LAGS)


@query(oracle.lag_features(DENSE_SHIPPED, SHIPPED, presets.LAGS))
def lags_hourly_shipments(spark, folder):
    return add_lag_features(densify(shipped_totals(spark, folder), SHIPPED), SHIPPED, presets.LAGS)


@query(oracle.lag_features(DENSE_EVENTS, EVENTS, (5, 36), "HOUR"))
def lags_in_hours(spark, folder):
    return add_lag_features(densify(event_totals(spark, folder), EVENTS), EVENTS, (5, 36), unit="HOUR")


@query(oracle.lag_features(DENSE_ORDERS, ORDERS, (1, 3), "MONTH"))
def lags_in_months(spark, folder):
    return add_lag_features(densify(order_totals(spark, folder), ORDERS), ORDERS, (1, 3), unit="MONTH")


def _hourly_statistics(interval: str) -> None:
    key = "statistics_hourly_" + interval.replace(" ", "_")

    @query(oracle.stat_features(DENSE_SHIPPED, SHIPPED, (interval,), 0), key)
    def hourly(spark, folder):
        grid = densify(shipped_totals(spark, folder), SHIPPED)
        return comparable(add_stat_features(grid, SHIPPED, (interval,), horizon=0))


for _interval in presets.INTERVALS:
    _hourly_statistics(_interval)


@query(oracle.stat_features(DENSE_EVENTS, EVENTS, ("1 day", "1 week"), 1))
def statistics_hourly_events(spark, folder):
    grid = densify(event_totals(spark, folder), EVENTS)
    return comparable(add_stat_features(grid, EVENTS, ("1 day", "1 week"), horizon=1))


@query(oracle.stat_features(DENSE_ORDERS, ORDERS, presets.INTERVALS, presets.HORIZON_DAYS))
def statistics_at_horizon(spark, folder):
    grid = densify(order_totals(spark, folder), ORDERS)
    return comparable(add_stat_features(grid, ORDERS, presets.INTERVALS, presets.HORIZON_DAYS))


@query(oracle.stat_features(ORDER_TOTALS, ORDERS, ("1 week", "1 month"), 7))
def statistics_with_gaps(spark, folder):
    return comparable(add_stat_features(order_totals(spark, folder), ORDERS, ("1 week", "1 month"), horizon=7))


@query(oracle.stat_features(ORDER_TOTALS, ORDERS, ("1 week", "1 month"), 7))
def statistics_native_windows(spark, folder):
    return comparable(
        add_stat_features(order_totals(spark, folder), ORDERS, ("1 week", "1 month"), horizon=7, native=True)
    )


BEYOND = 2**53 + 1
BEYOND_TOTALS = f"SELECT o_orderpriority, o_orderdate, n + {BEYOND} AS n FROM ({ORDER_TOTALS}) AS t"
_SMALL = oracle.stat_features(ORDER_TOTALS, ORDERS, ("1 day", "1 week"), 7)
_EXACT, _SHIFTED = ("min", "max", "q25", "q50", "q75"), ("std", "skew", "kurt", "slope")


@query(f"""
WITH small AS ({_SMALL}),
counts AS (
    SELECT o_orderdate + INTERVAL 7 DAY AS o_orderdate, o_orderpriority, count(n) OVER d AS n_1_day, count(n) OVER w AS n_1_week
    FROM ({ORDER_TOTALS}) AS t
    WINDOW d AS (PARTITION BY o_orderpriority ORDER BY o_orderdate RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW),
           w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate RANGE BETWEEN INTERVAL 1 WEEK PRECEDING AND CURRENT ROW))
SELECT s.o_orderdate, s.o_orderpriority, n + {BEYOND} AS n,
       {", ".join(f"{k}_n_{i} + {BEYOND} AS {k}_n_{i}" for i in ("1_day", "1_week") for k in _EXACT)},
       {", ".join(f"CAST(sum_n_{i} + n_{i} * {BEYOND} AS BIGINT) AS sum_n_{i}" for i in ("1_day", "1_week"))},
       {", ".join(f"{k}_n_{i}" for i in ("1_day", "1_week") for k in _SHIFTED)}
FROM small AS s LEFT JOIN counts AS c USING (o_orderdate, o_orderpriority)""")
def statistics_beyond_doubles(spark, folder):
    """Counts moved beyond 2**53: what a shift moves is moved exactly, what it leaves alone is the same."""
    totals = order_totals(spark, folder).withColumn("n", F.col("n") + BEYOND)
    features = comparable(add_stat_features(totals, ORDERS, ("1 day", "1 week"), horizon=7))
    kept = [f"{k}_n_{i}" for i in ("1_day", "1_week") for k in (*_EXACT, "sum", *_SHIFTED)]
    return features.select("o_orderdate", "o_orderpriority", "n", *kept)


PLACELESS = f"""
SELECT nullif(o_orderpriority, '5-LOW') AS o_orderpriority, nullif(o_orderdate, TIMESTAMP '1998-03-02') AS o_orderdate, n
FROM ({ORDER_TOTALS}) AS t"""


@query(f"""
SELECT s.*, l.n_lag_7 FROM ({oracle.stat_features(PLACELESS, ORDERS, ("1 week", "1 month"), 7)}) AS s
LEFT JOIN (SELECT o_orderpriority, o_orderdate + INTERVAL 7 DAY AS o_orderdate, n AS n_lag_7 FROM ({PLACELESS}) AS p
           WHERE o_orderdate IS NOT NULL) AS l USING (o_orderpriority, o_orderdate)""")
def statistics_of_placeless_rows(spark, folder):
    """One series has no key and one day no time: such rows stay, without a past."""
    totals = order_totals(spark, folder).select(
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
        F.when(F.col("o_orderdate") != F.lit("1998-03-02").cast("timestamp_ntz"), F.col("o_orderdate")).alias("o_orderdate"), "n",
    )
    return comparable(add_history_features(totals, ORDERS, ("1 week", "1 month"), (7,), 7))


# --- calendar -----------------------------------------------------------------------

HOLIDAY_YEARS = range(1995, 2022)


def _holiday_list() -> str:
    return ", ".join(f"DATE '{day}'" for day in holiday_days(HOLIDAY_YEARS))


HOLIDAYS = _holiday_list()


@query(
    "SELECT day, "
    + ", ".join(f"{sql} AS {name}" for name, sql in oracle.calendar_fields("day").items())
    + " FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders) AS d"
)
def calendar_days(spark, folder):
    return day_calendar(table(spark, folder, "orders"), "o_orderdate")


@query(f"SELECT event_id, {oracle.clock('ts')} FROM events")
def clock_encodings(spark, folder):
    encoded = clock_cyclics(F.col("ts"))
    return rounded(table(spark, folder, "events").select("event_id", *(c.alias(n) for n, c in encoded.items())))


@query(oracle.date_features(DENSE_ORDERS, "o_orderdate", HOLIDAYS))
def date_features_daily(spark, folder):
    grid = densify(order_totals(spark, folder), ORDERS)
    return rounded(add_date_features(grid, "o_orderdate", turkish_holidays(spark, HOLIDAY_YEARS)))


@query(oracle.date_features(EVENT_TOTALS, "ts", "SELECT DISTINCT CAST(o_orderdate + INTERVAL 10592 DAY AS DATE) FROM orders WHERE day(o_orderdate) = 1"))
def date_features_hourly(spark, folder):
    """Holidays from a table: the first of each month with an order, moved to the years of the events."""
    orders = table(spark, folder, "orders")
    holidays = orders.where(F.day("o_orderdate") == 1).select(
        F.to_date(F.col("o_orderdate") + F.expr("INTERVAL 10592 DAY")).alias("day")
    ).distinct()
    return rounded(add_date_features(event_totals(spark, folder), "ts", holidays))


# --- whole feature table ------------------------------------------------------------

DAILY_TRIPS = PanelSpec("passage", "timestamp", ("line_name", "station"), step="1d")
DENSE_TRIPS = oracle.dense(trip_totals_sql("0"), DAILY_TRIPS, "1 DAY")


def _feature_table_sql(grid: str = DENSE_TRIPS, spec: PanelSpec = DAILY_TRIPS, digits: int | None = 6) -> str:
    # Every operator's SQL adds its columns to the same panel rows.
    stats = oracle.stat_features("SELECT * FROM grid", spec, presets.INTERVALS, presets.HORIZON_DAYS, digits)
    lags = oracle.lag_features("SELECT * FROM grid", spec, presets.LAGS)
    dates = oracle.date_features("SELECT * FROM grid", "timestamp", HOLIDAYS)
    on = 'USING ("timestamp", line_name, station)'
    return f"""
    WITH grid AS MATERIALIZED ({grid})
    SELECT s.*, l.* EXCLUDE ("timestamp", line_name, station, passage, was_null),
           d.* EXCLUDE ("timestamp", line_name, station, passage, was_null)
    FROM ({stats}) AS s JOIN ({lags}) AS l {on} JOIN ({dates}) AS d {on}"""


def _daily_trip_totals(spark, folder) -> DataFrame:
    return clean_trips(raw_trips(spark, folder).withColumn("transition_hour", F.lit(0)), RULES)


def daily_trip_features(spark, folder) -> DataFrame:
    totals = cut_lineage(_daily_trip_totals(spark, folder))
    return panel_features(totals, DAILY_TRIPS, turkish_holidays(spark, HOLIDAY_YEARS))


@query(_feature_table_sql())
def feature_table(spark, folder):
    return comparable(daily_trip_features(spark, folder))


def _scratch(spark) -> str:
    """A folder of its own for each call, below the application's own folder."""
    return f"{run_folder(spark)}/query-{uuid4().hex}"


HOURLY_SINCE = datetime(2001, 9, 1)


@query(f"""
SELECT * EXCLUDE (line_name) FROM ({_feature_table_sql(oracle.dense(trip_totals_sql(), presets.PANEL, "1 HOUR"), presets.PANEL)}) AS f
WHERE line_name = 'MARMARAY' AND "timestamp" >= TIMESTAMP '{HOURLY_SINCE}'""")
def feature_table_hourly(spark, folder):
    """The whole hourly feature table with the presets' frames, horizon and lags, written by line; of one line the last weeks are read back."""
    totals = cut_lineage(clean_trips(raw_trips(spark, folder), RULES))
    path = _scratch(spark)
    write_features(panel_features(totals, presets.PANEL, turkish_holidays(spark, HOLIDAY_YEARS)), path)
    return comparable(read_features(spark, path, since=HOURLY_SINCE, line="MARMARAY"))


_JOB_COLUMNS = [
    "passage", "was_null", *stat_columns(presets.PANEL, presets.INTERVALS), *lag_columns(presets.PANEL, presets.LAGS),
    *(f"{part}_{fn}" for part in ("hour", "minute", "month", "dow", "dom", "woy", "doy") for fn in ("sin", "cos")),
    *(f"hc_in_{side}_{k}_days" for side in ("last", "next") for k in range(7, 1, -1)), "is_weekend",
]
_JOB_SQL = _feature_table_sql(oracle.dense(trip_totals_sql(), presets.PANEL, "1 HOUR"), presets.PANEL, None)


def _tenths_sql(name: str) -> str:
    """The column as the job's 32-bit float, in tenths; its slopes are per second, SQL's here per day."""
    daily = 86400.0 if name.startswith("slope_") else 1.0
    return f"CAST(round(CAST(CAST({name} / {daily} AS REAL) AS DOUBLE) * {daily * 10}) AS BIGINT)"




@query(f"""
SELECT line_name, year("timestamp") AS y, month("timestamp") AS m, count(*) AS n, count_if(is_holiday) AS holidays,
       {", ".join(f"CAST(sum({_tenths_sql(c)}) AS BIGINT) AS {c}, count({c}) AS n_{c}" for c in _JOB_COLUMNS)}
FROM ({_JOB_SQL}) AS f GROUP BY ALL""")
def feature_job_checksums(spark, folder):
    """The whole job from raw records to 32-bit floats on disk; of every line and month the number of values of each column and their sum in tenths."""
    path = _scratch(spark)
    run_feature_job(raw_trips(spark, folder), turkish_holidays(spark, HOLIDAY_YEARS), path)
    table_ = read_features(spark, path)

    def tenths(name: str) -> Column:
        daily = 86400.0 if name.startswith("slope_") else 1.0
        return F.sum(F.round(F.col(name).cast("double") * (daily * 10)).cast("long")).alias(name)

    return table_.groupBy("line_name", F.year("timestamp").alias("y"), F.month("timestamp").alias("m")).agg(
        F.count("*").alias("n"), F.count_if("is_holiday").alias("holidays"),
        *(c for name in _JOB_COLUMNS for c in (tenths(name), F.count(name).alias(f"n_{name}"))),
    )


@query(oracle.lag_features(DENSE_TRIPS, DAILY_TRIPS, (30,)).replace("SELECT p.*", "SELECT p.* EXCLUDE (line_name)") + """
WHERE p.line_name = 'M1' AND p."timestamp" >= TIMESTAMP '1997-06-01'""")
def feature_sink_and_line_scope(spark, folder):
    """Write the features by line, read one line back from a date on."""
    features = add_lag_features(densify(_daily_trip_totals(spark, folder), DAILY_TRIPS), DAILY_TRIPS, (30,))
    path = _scratch(spark)
    write_features(features, path)
    return read_features(spark, path, since=datetime(1997, 6, 1), line="M1")


@query(f"SELECT * EXCLUDE (line_name, station), line_name || '_' || station AS line_station FROM ({trip_totals_sql()}) AS t")
def joined_series_key(spark, folder):
    return joined_key(clean_trips(raw_trips(spark, folder), RULES), ("line_name", "station"), "line_station")


@query(f"SELECT * EXCLUDE (line_name) FROM ({trip_totals_sql()}) AS t WHERE line_name = 'MARMARAY'")
def single_line_scope(spark, folder):
    return one_line(clean_trips(raw_trips(spark, folder), RULES), "MARMARAY")


# --- folds and errors ---------------------------------------------------------------

FOLDS = make_folds(datetime(2001, 7, 31), presets.FOLD_COUNT, presets.FOLD_DAYS)

# The forecast scored here is the value thirty days before, so that SQL can follow.
WITH_LAG = oracle.lag_features(DENSE_ORDERS, ORDERS, (30,))
SCORED = f"""
SELECT o_orderdate, o_orderpriority, n, n_lag_30 AS prediction, split
FROM ({WITH_LAG}) AS p
JOIN (VALUES {', '.join(f"({i}, TIMESTAMP '{f.start}', TIMESTAMP '{f.end}')" for i, f in enumerate(FOLDS))})
     AS f(split, first, last) ON o_orderdate > first AND o_orderdate <= last
WHERE n IS NOT NULL AND n_lag_30 IS NOT NULL"""


def scored_orders(spark, folder) -> DataFrame:
    lagged = add_lag_features(densify(order_totals(spark, folder), ORDERS), ORDERS, (30,))
    return (
        assign_fold(lagged.dropna(subset=["n", "n_lag_30"]), "o_orderdate", FOLDS)
        .select("o_orderdate", "o_orderpriority", "n", F.col("n_lag_30").alias("prediction"), "split")
    )


@query(SCORED)
def fold_rows(spark, folder):
    return scored_orders(spark, folder)


@query(oracle.errors(SCORED, ("split", "o_orderpriority"), "n") + " ORDER BY split, o_orderpriority")
def errors_by_split_and_series(spark, folder):
    return rounded(
        error_table(scored_orders(spark, folder), ["split", "o_orderpriority"], "n").orderBy("split", "o_orderpriority")
    )


@query(oracle.errors(SCORED, ("o_orderpriority",), "n") + " ORDER BY o_orderpriority")
def errors_by_series(spark, folder):
    return rounded(error_table(scored_orders(spark, folder), ["o_orderpriority"], "n").orderBy("o_orderpriority"))


@query(oracle.errors("SELECT l_shipmonth, l_returnflag, l_extendedprice, 2000 * l_quantity AS prediction FROM "
                     "(SELECT *, month(l_shipdate) AS l_shipmonth FROM lineitem) AS m",
                     ("l_shipmonth", "l_returnflag"), "l_extendedprice"))
def errors_of_price_rule(spark, folder):
    """Continuous errors over every order line: a fixed price per unit against the price charged."""
    lines = table(spark, folder, "lineitem").select(
        F.month("l_shipdate").alias("l_shipmonth"), "l_returnflag", "l_extendedprice",
        (2000 * F.col("l_quantity")).alias("prediction"),
    )
    return rounded(error_table(lines, ["l_shipmonth", "l_returnflag"], "l_extendedprice"))


FOLD_ERRORS = f"""
WITH scored AS ({SCORED}),
weighted AS (
    SELECT split, abs(n - prediction) AS e, CAST(1 / n AS DECIMAL(38, 15)) AS w FROM scored WHERE n > 0),
cumulated AS (
    SELECT split, e, sum(w) OVER (PARTITION BY split ORDER BY e) AS upto, sum(w) OVER (PARTITION BY split) AS total
    FROM weighted),
medians AS (
    SELECT split, CAST(min(CASE WHEN 2 * upto >= total THEN e END) + min(CASE WHEN 2 * upto > total THEN e END) AS DOUBLE) / 2
           AS medae_weighted
    FROM cumulated GROUP BY split)
SELECT e.* EXCLUDE (mae), m.medae_weighted
FROM ({oracle.errors('SELECT * FROM scored', ('split',), 'n')}) AS e JOIN medians AS m USING (split)"""


@query(FOLD_ERRORS)
def errors_by_fold(spark, folder):
    return rounded(fold_metrics(scored_orders(spark, folder), "n"))


@query(f"""
SELECT {', '.join(f'round(avg({m}) + {oracle.nudge(4)}, 4) AS {m}' for m in ('rmse', 'medae', 'mape', 'medae_weighted'))}
FROM ({FOLD_ERRORS}) AS f""")
def errors_mean_over_folds(spark, folder):
    return rounded(mean_over_folds(fold_metrics(scored_orders(spark, folder), "n")), 4)


@query()
def metric_tables_sink(spark, folder):
    """Write both error tables and read the one per split back."""
    scored, path = scored_orders(spark, folder), _scratch(spark)
    write_metrics(
        error_table(scored, ["split", "o_orderpriority"], "n").orderBy("split", "o_orderpriority"),
        error_table(scored, ["o_orderpriority"], "n").orderBy("o_orderpriority"),
        path,
    )
    return rounded(spark.read.parquet(f"{path}/by_split"))


SQL["metric_tables_sink"] = SQL["errors_by_split_and_series"]


def _as_floats(sql: str) -> str:
    """Errors as 32-bit floats, back in doubles so that both engines print the same digits."""
    return ", ".join(f"round(CAST(CAST({m} AS REAL) AS DOUBLE), 3) AS {m}" for m in sql.split())


FLOAT_ERRORS = _as_floats("rmse medae mae mape")


def _floats(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(F.col(f.name).cast("double"), 3).alias(f.name) if f.dataType.simpleString() in ("float", "double") else f.name for f in df.schema.fields))


@query(f"""
SELECT split, o_orderpriority, {FLOAT_ERRORS} FROM ({oracle.errors(SCORED, ("split", "o_orderpriority"), "n")}) AS a
UNION ALL SELECT NULL, o_orderpriority, {FLOAT_ERRORS} FROM ({oracle.errors(SCORED, ("o_orderpriority",), "n")}) AS b""")
def forecast_metric_tables(spark, folder):
    """Both error tables as 32-bit floats, written and read back; the table over all splits has none."""
    path = _scratch(spark)
    write_metrics(*forecast_metrics(scored_orders(spark, folder), "o_orderpriority", "n"), path)
    by_series = spark.read.parquet(f"{path}/by_series").withColumn("split", F.lit(None).cast("int"))
    return _floats(spark.read.parquet(f"{path}/by_split").unionByName(by_series))


@query(f"""
SELECT split, {_as_floats("rmse medae mape medae_weighted")} FROM ({FOLD_ERRORS}) AS f
UNION ALL SELECT NULL, {", ".join(f"round(CAST(CAST(avg({m}) AS REAL) AS DOUBLE), 3) AS {m}" for m in ("rmse", "medae", "mape", "medae_weighted"))}
FROM ({FOLD_ERRORS}) AS g""")
def fold_metric_tables(spark, folder):
    """The folds' errors and their mean (without a split) from the one pass that serves all tables, written and read back."""
    path = _scratch(spark)
    errors = backtest_errors(scored_orders(spark, folder), "o_orderpriority", "n")
    write_fold_metrics(errors.folds, errors.mean, path)
    mean = spark.read.parquet(f"{path}/mean").withColumn("split", F.lit(None).cast("int"))
    both = spark.read.parquet(f"{path}/folds").unionByName(mean)
    return _floats(both.select("split", *(F.col(m).cast("float") for m in both.columns if m != "split")))


HUGE = 9_007_199_254_740_993 * 400
HUGE_ERRORS = f"""
SELECT l_shipmonth, l_partkey * {HUGE} AS actual, l_partkey * CAST({HUGE} AS DOUBLE) + 1000 * l_extendedprice * l_quantity AS prediction
FROM (SELECT *, month(l_shipdate) AS l_shipmonth FROM lineitem WHERE l_partkey < 2) AS m"""


@query(f"""
WITH scored AS ({HUGE_ERRORS}),
weighted AS (SELECT l_shipmonth, abs(CAST(actual AS DOUBLE) - prediction) AS e, 1 / CAST(actual AS DOUBLE) AS w FROM scored WHERE actual > 0)
SELECT l_shipmonth, count(*) AS n, round(quantile_cont(e, 0.5), 0) AS medae_weighted FROM weighted GROUP BY l_shipmonth""")
def weighted_median_of_huge_actuals(spark, folder):
    """Weights of 1e-19, all alike: the weighted median is the plain one."""
    lines = table(spark, folder, "lineitem").where("l_partkey < 2").select(
        F.month("l_shipdate").alias("l_shipmonth"), (F.col("l_partkey") * HUGE).alias("actual"),
        (F.col("l_partkey") * float(HUGE) + 1000 * F.col("l_extendedprice") * F.col("l_quantity")).alias("prediction"),
    )
    counts = lines.where("actual > 0").groupBy("l_shipmonth").agg(F.count("*").alias("n"))
    folds = fold_metrics(lines, "actual", split="l_shipmonth").select("l_shipmonth", F.round("medae_weighted", 0).alias("medae_weighted"))
    return counts.join(folds, "l_shipmonth")


@query()
def boosted_backtest(spark, folder):
    """Four folds of the boosted model with the presets' settings on the daily trip features, scored per series."""
    features = cut_lineage(daily_trip_features(spark, folder))
    panel = joined_key(features, ("line_name", "station"), "line_station")
    spec = PanelSpec("passage", "timestamp", ("line_station",), step="1d")
    folds = make_folds(datetime(2001, 10, 31), presets.FOLD_COUNT, presets.FOLD_DAYS)
    scored = backtest(panel, spec, folds, BoostingSettings())
    return error_table(scored, ["split", "line_station"], "passage")
