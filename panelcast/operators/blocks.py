"""Cutting series into time blocks.

A window partitioned by the series key alone puts a whole series into one task.
Here a series is cut into blocks of fixed length instead, and every row is also
copied to the following block(s) whose rows still look back on it. A group is
then at most one block plus the look-back long, however long or hot the series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.time import epoch_seconds
from ..spec import PanelSpec

BLOCK = "_block"
#: Blocks from here downwards hold rows without a place in a series.
NO_HISTORY = -(1 << 40)


def has_place(spec: PanelSpec) -> Column:
    """Whether a row has a time and all keys; a null key equals no other key, so such rows have no past."""
    found = F.col(spec.time).isNotNull()
    for name in spec.keys:
        found &= F.col(name).isNotNull()
    return found


def _scattered(df: DataFrame) -> Column:
    """Block ids for rows without a place, which may be many: spread by content."""
    names = [name for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    return F.lit(NO_HISTORY) - F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in names]), F.lit(1 << 20))


def block_of(seconds: Column, spec: PanelSpec) -> Column:
    return F.floor(seconds / F.lit(spec.block_seconds)).cast("long")


def with_history(df: DataFrame, spec: PanelSpec, lookback_seconds: int) -> DataFrame:
    """Add the block id; each row appears in its own block and in those that need it.

    Rows with a null time or key stay, once each, in blocks at or below ``NO_HISTORY``.
    """
    seconds = epoch_seconds(F.col(spec.time))
    blocks = F.sequence(block_of(seconds, spec), block_of(seconds + lookback_seconds, spec))
    return df.withColumn(BLOCK, F.explode(F.when(has_place(spec), blocks).otherwise(F.array(_scattered(df)))))


def own_rows(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Keep each row in its own block only, and drop the block id."""
    own = F.col(BLOCK) == block_of(epoch_seconds(F.col(spec.time)), spec)
    return df.where((F.col(BLOCK) <= NO_HISTORY) | own).drop(BLOCK)
