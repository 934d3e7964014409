"""Session settings the library is meant to run under."""

from __future__ import annotations

import re
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "panelcast", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume (UTC, ANSI, AQE)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only where the session names none (tests on one machine) a folder is made.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        # ``local`` and ``local[8]``, not ``local-cluster[...]``, whose executors have folders of their own.
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="panelcast-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession) -> str:
    """The one folder below the checkpoint folder that holds all tables this application writes for itself."""
    return f"{checkpoint_dir(spark).rstrip('/')}/panelcast-{spark.sparkContext.applicationId}"


def drop_run_folder(spark: SparkSession) -> None:
    """Delete what this application wrote for itself, through the file system it lies in; results that read it are gone with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet to the run's folder and read it back: later passes prune columns and rows, and lineage ends there."""
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
