"""Joins by a key that a large share of all rows may have."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.staging import staged


def split_join(rows: DataFrame, table: DataFrame, key: str, tracked: int = 4096, candidates: int = 1024) -> DataFrame:
    """``rows`` left-joined with ``table``, which has at most one row per ``key``.

    A summary of ``tracked`` counters names keys that are frequent in ``rows``; what ``table`` has for these, at most ``candidates`` rows, is
    broadcast, and only the other rows are shuffled. Which keys are named decides where the work is done, not what comes out. Both
    sides are read more than once and should be written tables.
    """
    summary = rows.agg(F.expr(f"approx_top_k(`{key}`, {candidates}, {tracked})").alias("found"), F.count("*").alias("total"))
    named = summary.select("total", F.explode("found").alias("of")).filter(F.col("of.count") > F.greatest(F.lit(1), F.col("total") / tracked))
    hot, _ = staged(table.join(F.broadcast(named.select(F.col("of.item").alias(key))), key, "left_semi"), "frequent")
    heavy = rows.join(F.broadcast(hot), key)
    light = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(table, key, "left")
    return heavy.unionByName(light)
