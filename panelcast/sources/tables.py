"""Parquet tables: raw trips in, features in between, error tables out."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import drop_columns
from ..functions.time import quoted
from ..operators.folds import since as rows_since


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_features(
    df: DataFrame, path: str, partition_by: str | None = "line_name", max_records_per_file: int = 5_000_000, time: str = "timestamp",
    span_days: int = 92, rows_per_group: int = 100_000,
) -> None:
    """Write the feature table, by default in one folder per line, in order of time.

    Reading one line is then a matter of listing its folder, and reading a range of time a matter of the row groups' bounds: rows
    are brought together by line and span of time, adaptive execution splits what is large and merges what is small, and every
    file is sorted by time in row groups of bounded size. A table without a column ``time`` is written as it is.
    """
    if time in df.columns:
        together = [] if partition_by is None else [partition_by]
        span = F.floor(F.unix_date(F.to_date(quoted(time))) / span_days).alias("_span")
        df = df.select("*", span).hint("rebalance", *together, "_span").sortWithinPartitions(*map(quoted, together), quoted(time)).drop("_span")
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).option("parquet.block.row.count.limit", rows_per_group)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def read_features(
    spark: SparkSession,
    path: str,
    since: datetime | None = None,
    line: str | None = None,
    time: str = "timestamp",
    line_column: str = "line_name",
) -> DataFrame:
    """The feature table from a point in time on; one line only if ``line`` is given."""
    df = spark.read.parquet(path)
    if since is not None:
        df = rows_since(df, time, since)
    return one_line(df, line, line_column) if line is not None else df


def one_line(df: DataFrame, line: str, line_column: str = "line_name") -> DataFrame:
    """Rows of one line, without the column that is constant then."""
    return drop_columns(df.where(F.col(line_column) == line), line_column)


def write_metrics(by_split: DataFrame, by_series: DataFrame, folder: str) -> None:
    """Both error tables under ``folder``; they hold one row per series (and split)."""
    by_split.write.mode("overwrite").parquet(f"{folder}/by_split")
    by_series.write.mode("overwrite").parquet(f"{folder}/by_series")


def write_fold_metrics(folds: DataFrame, mean: DataFrame, folder: str) -> None:
    """The folds' errors and their mean under ``folder``."""
    folds.write.mode("overwrite").parquet(f"{folder}/folds")
    mean.write.mode("overwrite").parquet(f"{folder}/mean")
