"""Exact medians of groups of any size, for several groupings at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.time import quoted
from ..session import cut_lineage

#: Ranges of values that double from one to the next are cut into so many at first, and middle ranges that hold more than SMALL rows then again.
PARTS_PER_OCTAVE, PARTS = 64, 1024
SMALL = 20_000
WEIGHT = "decimal(38,0)"
#: Bits of the largest weight.
WEIGHT_BITS = 80

VALUE, MASS, SET = "_v", "_w", "_set"


def grouped_median(
    df: DataFrame, groups: Sequence[str], value: Column, weight: Column | None = None, name: str = "median"
) -> DataFrame:
    """Exact median of a non-negative ``value`` per group; weighted if ``weight`` is given. See :func:`medians_of_sets`."""
    narrow = df.select(*map(quoted, groups), value.cast("double").alias(VALUE), *([] if weight is None else [weight.cast("double").alias(MASS)]))
    return medians_of_sets(cut_lineage(narrow), [groups], weight is not None, name).drop(SET)


def set_id(groups: Sequence[str], columns: Sequence[str]) -> int:
    """What ``grouping_id`` gives for a grouping set: a bit for each column that is not in it."""
    return sum((name not in groups) << (len(columns) - 1 - i) for i, name in enumerate(columns))


def same_group(columns: Sequence[str], left: str = "l", right: str = "r") -> Column:
    """Rows of one group of one grouping set; null is a value."""
    both = F.col(f"{left}.{SET}") == F.col(f"{right}.{SET}")
    for name in columns:
        both = both & F.col(f"{left}.{quoted(name)}").eqNullSafe(F.col(f"{right}.{quoted(name)}"))
    return both


def columns_of(sets: Sequence[Sequence[str]]) -> list[str]:
    return list(dict.fromkeys(name for groups in sets for name in groups))


def _weighed(values: DataFrame, weighted: bool) -> DataFrame:
    """Weights as whole numbers, so that sums do not depend on their order.

    They are relative to the power of two at the largest one, so there is no fixed scale below which a weight would vanish; the
    least is 1. Without weights every row weighs 1.
    """
    present = F.col(VALUE).isNotNull()
    if not weighted:
        return values.where(present).withColumn(MASS, F.lit(1).cast(WEIGHT))
    values = values.where(present & (F.col(MASS) > 0) & (F.col(MASS) < float("inf")))
    shift = F.pow(F.lit(2.0), -F.ceil(F.log2(values.agg(F.max(MASS)).scalar())))
    whole = (F.col(MASS) * shift * float(1 << WEIGHT_BITS)).cast(WEIGHT)
    return values.withColumn(MASS, F.greatest(whole, F.lit(1).cast(WEIGHT)))


def _expanded(values: DataFrame, columns: Sequence[str], sets: Sequence[Sequence[str]]) -> DataFrame:
    """Every row once per grouping set, as ``GROUPING SETS`` has them."""
    kinds = {f.name: f.dataType for f in values.schema.fields}
    rows = [
        F.struct(
            F.lit(set_id(groups, columns)).cast("long").alias(SET),
            *[(F.col(quoted(c)) if c in groups else F.lit(None).cast(kinds[c])).alias(c) for c in columns],
        )
        for groups in sets
    ]
    return values.select(F.explode(F.array(*rows)).alias("_group"), VALUE, MASS).select("_group.*", VALUE, MASS)


def _middle(ranges: DataFrame, part: Sequence[str], order: str) -> DataFrame:
    """Of rows (range, ``low``, ``high``, ``rows``, ``mass``, ``below`` the whole, ``total``) those that the middle of the mass lies in or next to."""
    along = Window.partitionBy(*map(quoted, part)).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = (F.col("below") + F.sum("mass").over(along)).cast(WEIGHT)
    return (
        ranges.withColumn("_upto", upto).withColumn("_before", (F.col("_upto") - F.col("mass")).cast(WEIGHT))
        .where("2 * _before <= total AND 2 * _upto >= total")
    )


def medians_of_sets(values: DataFrame, sets: Sequence[Sequence[str]], weighted: bool = False, name: str = "median") -> DataFrame:
    """Exact medians of ``_v`` (not negative) for every group of every grouping set: the sets' columns, ``_set`` (see :func:`set_id`), and ``name``.

    The median is the first value whose cumulated weight reaches half the total, averaged with the next one where it meets the half exactly;
    without weights that is the usual interpolated median. Rows with a null value do not count, nor do weights that are null, zero or less.

    ``values`` is read several times and should be a written table. Spark's own ``percentile`` keeps all distinct values of a group in one
    buffer. Here a histogram over narrow ranges, summed before it is shuffled, tells which range holds the middle of each group. While such
    a range holds many rows, it alone is cut again into ``PARTS`` equal parts, by another histogram. Only the rows of the last
    middle ranges are shuffled and sorted, so no task needs a whole group, also where all values are close together.
    """
    columns = columns_of(sets)
    values = _weighed(values, weighted)
    ranged = values.withColumn(
        "_range",  # increasing in the value; zero comes first
        F.when(F.col(VALUE) > 0, F.floor(F.log2(VALUE) * PARTS_PER_OCTAVE).cast("int")).otherwise(F.lit(-(2**31))),
    )
    key = [SET, *columns]
    summed = [
        F.min(VALUE).alias("low"), F.max(VALUE).alias("high"), F.count(F.lit(1)).alias("rows"), F.sum(MASS).cast(WEIGHT).alias("mass"),
    ]
    whole = Window.partitionBy(*map(quoted, key))
    ranges = (
        ranged.groupingSets([[*groups, "_range"] for groups in sets], *columns, "_range")
        .agg(*summed, F.shiftright(F.grouping_id(), 1).cast("long").alias(SET))
        .withColumn("total", F.sum("mass").over(whole).cast(WEIGHT)).withColumn("below", F.lit(0).cast(WEIGHT))
    )
    kept = [*map(quoted, key), "low", "high", "rows", F.col("_before").alias("below"), "total"]
    middle = cut_lineage(_middle(ranges, key, "_range").select(*kept))
    rows = _expanded(values, columns, sets).alias("l")

    def inside(middle: DataFrame) -> DataFrame:
        found = rows.join(middle.alias("r"), same_group(columns) & F.col(f"l.{VALUE}").between(F.col("r.low"), F.col("r.high")))
        return found.select("l.*", "r.low", "r.high", "r.below", "r.total")

    while (middle.where("high > low").agg(F.max("rows")).first()[0] or 0) > SMALL:
        part = F.least(F.lit(PARTS - 1), F.floor((F.col(VALUE) - F.col("low")) / (F.col("high") - F.col("low")) * PARTS).cast("int"))
        cut = (
            inside(middle).withColumn("_part", F.when(F.col("high") > F.col("low"), part).otherwise(F.lit(0)))
            .groupBy(*map(quoted, key), F.col("low").alias("_low"), "_part", "below", "total").agg(*summed)
        )
        middle = cut_lineage(_middle(cut, [*key, "_low"], "_part").select(*kept))

    merged = inside(middle).groupBy(*map(quoted, key), "low", VALUE, "below", "total").agg(F.sum(MASS).cast(WEIGHT).alias("mass"))
    last = _middle(merged, [*key, "low"], VALUE)
    reaches = F.min(F.when(2 * F.col("_upto") >= F.col("total"), F.col(VALUE)))
    passes = F.min(F.when(2 * F.col("_upto") > F.col("total"), F.col(VALUE)))
    return last.groupBy(*map(quoted, key)).agg(((reaches + passes) / 2).alias(name))
