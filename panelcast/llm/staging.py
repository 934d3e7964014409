"""Tables written to the shared folder, and the size of Arrow batches."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from panelcast.session import run_folder

#: Rows and bytes that a Python worker is handed at once.
BATCH_ROWS, BATCH_BYTES = 1024, 16 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound what one Python worker holds, so that long texts do not meet in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own below the folder that driver and executors share."""
    return f"{run_folder(spark)}/llm-{name}-{uuid4().hex}"


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage ends there.

    Also returns the path, to be given to :func:`drop` once nothing reads it.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def release(spark: SparkSession) -> None:
    """Let the driver notice which shuffles nothing refers to any more: Spark deletes their files only then."""
    spark._jvm.System.gc()


def drop(spark: SparkSession, *paths: str) -> None:
    """Delete tables written by :func:`staged`, through the file system they lie in."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
