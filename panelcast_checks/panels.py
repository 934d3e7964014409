"""Panels derived from the test tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelcast.operators.clean import TripRules
from panelcast.plans import presets
from panelcast.spec import PanelSpec


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def at_hour(day: Column, hour: Column) -> Column:
    """Zone-less timestamp at an hour of a day."""
    return F.to_date(day).cast("timestamp_ntz") + F.expr("INTERVAL '1' HOUR") * hour


# Hourly event counts per event type.
EVENTS = PanelSpec("n", "ts", ("event_type",), step="1h")


def event_totals(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return events.groupBy("event_type", at_hour(F.col("ts"), F.hour("ts")).alias("ts")).agg(F.count("*").alias("n"))


EVENT_TOTALS = "SELECT event_type, date_trunc('hour', ts) AS ts, count(*) AS n FROM events GROUP BY 1, 2"

# Daily order counts per priority.
ORDERS = PanelSpec("n", "o_orderdate", ("o_orderpriority",), step="1d")


def order_totals(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").groupBy("o_orderpriority", "o_orderdate").agg(F.count("*").alias("n"))


ORDER_TOTALS = "SELECT o_orderpriority, o_orderdate, count(*) AS n FROM orders GROUP BY 1, 2"

# Hourly shipped quantity per return flag.
SHIPPED = PanelSpec("qty", "ts", ("l_returnflag",), step="1h")


def shipped_totals(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return lines.groupBy(
        "l_returnflag", at_hour(F.col("l_shipdate"), F.col("l_orderkey") % 24).alias("ts")
    ).agg(F.sum("l_quantity").cast("long").alias("qty"))


SHIPPED_TOTALS = """
SELECT l_returnflag, l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS ts, CAST(sum(l_quantity) AS BIGINT) AS qty
FROM lineitem GROUP BY 1, 2"""

# Raw trip records in the shape of a fare-gate export, made from the order lines.
STATIONS = (
    "CAMI", "SIRKECI-1", "SIRKECI-2", "LEVENT DOGU", "HASTANE (DOGU/ADLIYE)",
    "FENER DOGUBEY", "OSMANBEY (KUZEY)", "TAKSIM",
)
RULES: TripRules = presets.RAIL_TRIPS


def raw_trips(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    names = F.array(*(F.lit(name) for name in STATIONS))
    return lines.select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("transition_date"),
        (F.col("l_orderkey") % 24).cast("int").alias("transition_hour"),
        F.when(F.col("l_returnflag") == "A", "M1").when(F.col("l_returnflag") == "N", "MARMARAY").otherwise("F9")
        .alias("line_name"),
        F.when(F.col("l_linenumber") != 3, F.get(names, (F.col("l_suppkey") % 8).cast("int")))
        .alias("station_poi_desc_cd"),
        F.when(F.col("l_discount") != 0, F.col("l_quantity").cast("long")).alias("number_of_passage"),
        F.when(F.col("l_tax") != 0, "RAYLI").otherwise("OTOYOL").alias("road_type"),
    )


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


RAW_TRIPS = f"""
SELECT strftime(l_shipdate, '%Y-%m-%d') AS transition_date,
       CAST(l_orderkey % 24 AS INTEGER) AS transition_hour,
       CASE l_returnflag WHEN 'A' THEN 'M1' WHEN 'N' THEN 'MARMARAY' ELSE 'F9' END AS line_name,
       CASE WHEN l_linenumber <> 3
            THEN list_extract([{', '.join(map(_literal, STATIONS))}], CAST(l_suppkey % 8 AS INTEGER) + 1) END
            AS station_poi_desc_cd,
       CASE WHEN l_discount <> 0 THEN CAST(l_quantity AS BIGINT) END AS number_of_passage,
       CASE WHEN l_tax <> 0 THEN 'RAYLI' ELSE 'OTOYOL' END AS road_type
FROM lineitem"""


def trip_totals_sql(hour: str = "transition_hour") -> str:
    """Cleaned totals of the raw trips; ``hour`` may be replaced to get daily ones."""
    name = "station_poi_desc_cd"
    for suffix in RULES.removed:
        name = f"replace({name}, {_literal(suffix)}, '')"
    mapped = " ".join(f"WHEN {_literal(a)} THEN {_literal(b)}" for a, b in RULES.names.items())
    return f"""
    SELECT line_name, station, "timestamp", CAST(coalesce(sum(number_of_passage), 0) AS BIGINT) AS passage
    FROM (
        SELECT line_name, number_of_passage,
               CASE name {mapped} ELSE name END AS station,
               strptime(transition_date || '-' || lpad(CAST({hour} AS VARCHAR), 2, '0') || '-00', '%Y-%m-%d-%H-%M')
                   AS "timestamp"
        FROM (SELECT *, {name} AS name FROM ({RAW_TRIPS}) AS r)
        WHERE road_type = {_literal(RULES.mode)}
          AND line_name IN ({', '.join(map(_literal, RULES.lines))}) AND name IS NOT NULL
    ) AS t GROUP BY ALL"""
