"""Trailing-frame statistics of whole numbers as differences of growing window frames.

A sliding frame of Spark's reads itself again for every row. A frame that only grows does not, so here every row gets the running
sums of its block, and a trailing frame is the sums as of its end less those as of before its start; both are looked up by frames that
grow with the time. Sums are of whole numbers, so differences are exact and nothing cancels. Minima and maxima come from
tables over power-of-two numbers of rows, two look-ups per frame.
"""

from __future__ import annotations

from math import ceil, comb, log2

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..spec import DAY, PanelSpec, Span
from .frames import sample_kurtosis, sample_skew
from .time import minus, quoted

EXACT = "decimal(38,0)"
#: Rows of a block that may lie within one step, beyond which the tables of minima would not reach.
ROWS_PER_STEP = 2
#: Values that spread over less than two to this many bits have exact moments.
BITS = 25
#: Squared mean over variance from which moments are taken from exact sums about the mean; doubles have enough digits below.
CONDITION = 100.0

_X, _STATE = "_x", "_state"
#: Sums that only blocks of wide spread need; the others have them from the rest.
_WIDE = ("s", "xx", "z", "zz")
_SUMS = ("n", "outside", "log", "t", "y", "yy", "zzz", "zzzz", "ty", "tt", *_WIDE)
_WHOLE = ("n", "outside", "log", "t")


def _levels(spec: PanelSpec, longest_seconds: int) -> int:
    """Levels of the tables: the last spans more rows than any frame has."""
    return ceil(log2(ROWS_PER_STEP * (longest_seconds // spec.step_seconds + 2))) + 1


def _with_extremes(df: DataFrame, order, levels: int) -> DataFrame:
    """Add ``_tables``: minima and maxima of the 1, 2, 4, ... rows that end at a row, and of those that follow it."""
    x = F.col(_X)
    kinds = {
        "low_to": (F.least, x, F.lag), "high_to": (F.greatest, x, F.lag),
        "low_from": (F.least, F.lead(x, 1).over(order), F.lead), "high_from": (F.greatest, F.lead(x, 1).over(order), F.lead),
    }
    df = df.withColumns({f"_{kind}_0": start for kind, (_, start, _) in kinds.items()})
    for level in range(0, levels, 2):  # two levels per pass, both from the one before
        added = {}
        for kind, (pick, _, move) in kinds.items():
            own, step = F.col(f"_{kind}_{level}"), 1 << level
            parts = [own, *(move(own, k * step).over(order) for k in (1, 2, 3))]
            added[f"_{kind}_{level + 1}"] = pick(*parts[:2])
            if level + 2 <= levels:
                added[f"_{kind}_{level + 2}"] = pick(*parts)
        df = df.withColumns(added)
    tables = F.struct(*[F.array(*[f"_{kind}_{level}" for level in range(levels + 1)]).alias(kind) for kind in kinds])
    return df.withColumn("_tables", tables).drop(*[f"_{kind}_{level}" for kind in kinds for level in range(levels + 1)])


def with_running_state(df: DataFrame, spec: PanelSpec, partition: list[str], longest_seconds: int, counted: Column) -> DataFrame:
    """Add ``_state`` (running sums up to each row, and its tables of extremes) and the constants of its block.

    ``y`` are the values less a whole number ``_c`` near the middle of the block, ``z`` the same as far as up to ``BITS`` bits show it; second
    moments are taken from y and higher ones from z, so that all sums fit 38 digits. Unless a block spreads wider than that, both are
    the same and exact. What a wider block cannot resolve are differences below 2**-25 of its spread, in higher moments
    alone. ``counted`` is 1, or fails on rows that must not be.
    """
    order = Window.partitionBy(*partition).orderBy(spec.time)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    grown = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = F.col(_X)
    df = _with_extremes(df.withColumn(_X, F.col(spec.target).cast("long")), order, _levels(spec, longest_seconds))
    df = df.withColumn(
        "_extent",
        F.struct(
            F.min(x).over(whole).alias("low"), F.max(x).over(whole).alias("high"), F.count(F.lit(1)).over(whole).alias("rows"),
            F.min(spec.time).over(whole).alias("since"),
        ),
    )
    low, high = F.col("_extent.low"), F.col("_extent.high")
    small = (low >= -(1 << BITS)) & (high <= 1 << BITS)
    middle = F.when(small | ((low < 0) & (high > 0)), F.lit(0).cast("long")).otherwise(F.expr("_extent.low div 2 + _extent.high div 2"))
    df = df.withColumn("_c", middle)
    spread = F.greatest(F.abs(high.cast("double") - F.col("_c").cast("double")), F.abs(low.cast("double") - F.col("_c").cast("double")))
    bits, rows = F.ceil(F.log2(spread + 2)).cast("int"), F.ceil(F.log2(F.col("_extent.rows") + 1)).cast("int")
    df = df.withColumn(
        "_cut",  # bits to leave out of y and of z, and bits of logarithms below one
        F.struct(
            F.greatest(F.lit(0), bits - F.floor((120 - rows) / 2).cast("int")).alias("y"),
            F.greatest(F.lit(0), bits - F.least(F.lit(BITS), F.floor((120 - rows) / 4).cast("int"))).alias("z"), (55 - rows).alias("log"),
        ),
    )
    wide = F.col("_cut.z") > 0
    since = F.expr(f"CAST(CAST({quoted(spec.time)} - _extent.since AS INTERVAL SECOND) * 1000 AS INTERVAL SECOND)").cast("long")
    df = df.withColumns(
        {
            "_one": F.when(x.isNotNull(), counted).otherwise(counted * 0), "_t": F.when(x.isNotNull(), since),
            "_y": F.expr("shiftright(_x - _c, _cut.y)").cast("decimal(20,0)"), "_z": F.expr("shiftright(_x - _c, _cut.z)").cast("decimal(20,0)"),
        }
    )

    def product(*names: str) -> Column:
        out = F.col(names[0])
        for name in names[1:]:
            out = out * F.col(name)
        return out.cast(EXACT)

    square = F.try_multiply(x.cast(EXACT), x.cast(EXACT))
    terms = {
        "n": F.col("_one"), "outside": F.when(x <= -1, 1), "t": F.col("_t"),
        "log": F.round(F.when(x > -1, F.ln(x + F.lit(1.0))) * F.pow(F.lit(2.0), F.col("_cut.log"))).cast("long"),
        "y": F.col("_y").cast(EXACT), "yy": product("_y", "_y"), "zzz": product("_z", "_z", "_z"), "zzzz": product("_zz", "_zz"),
        "ty": (F.col("_t") * F.col("_y")).cast(EXACT), "tt": (F.col("_t").cast("decimal(20,0)") * F.col("_t")).cast(EXACT),
        "s": F.when(wide, x.cast(EXACT)), "z": F.when(wide, F.col("_z")).cast(EXACT), "zz": F.when(wide, F.col("_zz")).cast(EXACT),
    }
    kinds = {name: "long" if name in _WHOLE else EXACT for name in terms}
    sums = {f"_s_{name}": F.coalesce(F.sum(term).over(grown), F.lit(0)).cast(kinds[name]) for name, term in terms.items()}
    # The square of a 64-bit number fits, a sum of such squares may not; it is null then.
    sums["_s_xx"] = F.try_sum(F.when(wide, F.when(x.isNull(), F.lit(0).cast(EXACT)).otherwise(square))).over(grown).cast(EXACT)
    df = df.withColumn("_zz", (F.col("_z") * F.col("_z")).cast(EXACT)).withColumns({**sums, "_s_rows": F.row_number().over(order).cast("long")})
    state = F.struct(F.col(spec.time).alias("at"), *[F.col(f"_s_{name}").alias(name) for name in (*_SUMS, "rows")], "_tables.*")
    return df.withColumn(_STATE, state).drop(*sums, "_s_rows", "_tables", "_one", "_t", "_y", "_z", "_zz", "_extent")


def _as_of(spec: PanelSpec, partition: list[str], seconds: int, before: bool = False) -> Column:
    """The state ``seconds`` earlier, or just before that: the last row of a frame that grows with the time."""
    keys = ", ".join(quoted(name) for name in partition)
    bound = f"INTERVAL '{seconds}.{'000001' if before else '000000'}' SECOND PRECEDING"
    return F.expr(f"last({_STATE}) OVER (PARTITION BY {keys} ORDER BY {quoted(spec.time)} RANGE BETWEEN UNBOUNDED PRECEDING AND {bound})")


def frame_columns(df: DataFrame, spec: PanelSpec, partition: list[str], spans: dict[str, Span], ahead: Span, known: Column) -> DataFrame:
    """Add ``_f_<frame>``, a struct of all statistics but the quantiles; null where ``known`` fails or the series has no row ``ahead`` earlier.

    A span of months is one of a few numbers of days long, which depends on the row; the state before its start is looked up for each of them.
    """
    end = minus(F.col(spec.time), ahead)
    before: dict[str, Column] = {}
    for name, span in spans.items():
        if span.months is None:
            before[name] = _as_of(spec, partition, ahead.seconds + span.seconds, True)
        else:
            days = F.date_diff(F.to_date(end), F.to_date(minus(end, span)))
            choice = F.when(F.lit(False), F.lit(None))
            for length in span.day_lengths:
                choice = choice.when(days == length, _as_of(spec, partition, ahead.seconds + length * DAY, True))
            before[name] = choice
    df = df.withColumns({"_end": F.when(known, _as_of(spec, partition, ahead.seconds)), "_starts": F.array(*before.values())})
    df = df.drop(_STATE).withColumn("_end", F.when(F.col("_end.at") == end, F.col("_end")))

    def difference(start: Column, part: str) -> Column:
        # A sum that did not fit is null, and so is the difference; no row before the frame is a sum of zero.
        earlier = F.when(start.isNull(), F.lit(0)).otherwise(start[part])
        return (F.col(f"_end.{part}") - earlier).cast("long" if part in (*_WHOLE, "rows") else EXACT).alias(part)

    # One expression for all frames: generated code for each of them would outgrow what the virtual machine compiles.
    df = df.withColumn("_frames", F.transform("_starts", lambda start: F.struct(*[difference(start, part) for part in (*_SUMS, "rows")], start.alias("start"))))
    df = df.withColumn("_frames", F.expr(f"transform(_frames, d -> named_struct('d', d, 'm', {_moments('d')}))"))
    df = df.withColumn("_frames", F.transform("_frames", lambda frame: _finished(frame["d"], frame["m"])))
    return df.withColumns({f"_f_{name}": F.col("_frames")[i] for i, name in enumerate(spans)}).drop("_end", "_starts", "_frames")


def _moments(d: str) -> str:
    """Second to fourth central moments, the second one of y, and both parts of the slope.

    From doubles where these lose nothing that matters; else from sums about a whole number next to the mean, which are exact.
    """
    n, wide = f"CAST({d}.n AS DOUBLE)", "_cut.z > 0"
    y, yy = f"{d}.y", f"{d}.yy"
    z, zz = f"CASE WHEN {wide} THEN {d}.z ELSE {y} END", f"CASE WHEN {wide} THEN {d}.zz ELSE {yy} END"

    def plain(sums: list[str]) -> list[str]:
        m, s2, s3, s4 = (f"(CAST({s} AS DOUBLE) / {n})" for s in [*sums, *sums[-1:] * 2][:4])
        return [
            f"({s2} - {m} * {m})", f"({s3} - 3 * {m} * {s2} + 2 * {m} * {m} * {m})",
            f"({s4} - 4 * {m} * {s3} + 6 * {m} * {m} * {s2} - 3 * {m} * {m} * {m} * {m})",
        ][: len(sums) - 1]

    def about(sums: list[str]) -> list[str]:
        one, e, all_ = sums[0], f"CAST(({sums[0]}) div {d}.n AS decimal(20,0))", f"CAST({d}.n AS decimal(20,0))"
        first = f"(({one}) - {all_} * {e})"
        out = [first]
        for k, s in enumerate(sums[1:], 2):
            # sum((v - e)^k) from sums of powers, by Horner's rule in e.
            inner = f"({k} * ({one}) - {all_} * {e})"
            for low, power in enumerate(sums[1: k - 1], 2):
                inner = f"({comb(k, low)} * ({power}) - {e} * {inner})"
            out.append(f"(({s}) - {e} * {inner})")
        return [f"(CAST({x} AS DOUBLE) / {n})" for x in out]

    def centred(found: list[str]) -> list[str]:
        e, a2, a3, a4 = [*found, *found[-1:] * 2][:4]
        return [
            f"({a2} - {e} * {e})", f"({a3} - 3 * {e} * {a2} + 2 * {e} * {e} * {e})",
            f"({a4} - 4 * {e} * {a3} + 6 * {e} * {e} * {a2} - 3 * {e} * {e} * {e} * {e})",
        ][: len(found) - 1]

    seconds, all_powers = [y, yy], [z, zz, f"{d}.zzz", f"{d}.zzzz"]
    mean = f"(CAST({y} AS DOUBLE) / {n})"
    fine = f"{mean} * {mean} <= {CONDITION} * (CAST({yy} AS DOUBLE) / {n} - {mean} * {mean})"
    own, exact = plain(all_powers), centred(about(all_powers))
    parts = {
        "v": f"CASE WHEN {fine} THEN {plain(seconds)[0]} ELSE {centred(about(seconds))[0]} END",
        **{f"m{k + 2}": f"CASE WHEN {fine} THEN {own[k]} ELSE {exact[k]} END" for k in range(3)},
        "top": f"CAST(CAST({d}.n AS decimal(20,0)) * {d}.ty - CAST({d}.t AS decimal(20,0)) * {y} AS DOUBLE)",
        "low": f"CAST(CAST({d}.n AS decimal(20,0)) * {d}.tt - CAST({d}.t AS decimal(20,0)) * {d}.t AS DOUBLE)",
        "level": f"CAST(floor(log2({d}.rows)) AS INT)",
    }
    fields = ", ".join(f"'{part}', {sql}" for part, sql in parts.items())
    return f"CASE WHEN {d}.n > 0 THEN named_struct({fields}) END"


def _finished(d: Column, m: Column) -> Column:
    n, some, wide = d["n"].cast("double"), d["n"] > 0, F.col("_cut.z") > 0
    c, count = F.col("_c").cast("decimal(20,0)"), d["n"].cast("decimal(20,0)")
    scale = F.pow(F.lit(2.0), F.col("_cut.y"))
    varies = F.when(m["m2"] > 0, m["m2"])
    total = F.when(wide, d["s"]).otherwise((d["y"] + count * c).cast(EXACT))
    level = m["level"]

    def extreme(kind: str, pick) -> Column:
        # From the block's first row on, the next level reaches no further back than that row.
        return F.when(d["start"].isNull(), F.get(F.col(f"_end.{kind}_to"), level + 1)).otherwise(
            pick(F.get(F.col(f"_end.{kind}_to"), level), F.get(d["start"][f"{kind}_from"], level))
        )

    far = F.raise_error(F.lit(f"more than {ROWS_PER_STEP} rows within a step")).cast("long")
    inside = level + 1 < F.size("_end.low_to")
    real, ys = c.cast("double"), d["y"].cast("double") * scale
    energy = F.when(
        wide,
        # Beyond 38 digits: from sums about the middle, in doubles.
        F.coalesce(d["xx"].cast("double"), n * real * real + 2 * real * ys + d["yy"].cast("double") * scale * scale),
    ).otherwise((d["yy"] + (d["y"] * 2 + count * c).cast(EXACT) * c).cast("double"))
    return F.struct(
        F.when(some, total.cast("double") / n).alias("avg"),
        F.when(some, F.when(inside, extreme("low", F.least)).otherwise(far)).alias("min"),
        F.when(some, F.when(inside, extreme("high", F.greatest)).otherwise(far)).alias("max"),
        F.when(n > 1, F.sqrt(F.greatest(m["v"], F.lit(0.0)) * n / (n - 1)) * scale).alias("std"),
        sample_skew(n, m["m3"] / F.pow(varies, F.lit(1.5))).alias("skew"),
        sample_kurtosis(n, m["m4"] / (varies * varies) - 3).alias("kurt"),
        F.when(some & (d["outside"] == 0), F.exp(d["log"] / F.pow(F.lit(2.0), F.col("_cut.log")) / n) - 1).alias("geomean"),
        F.when(some, total.cast("long")).alias("sum"),
        F.when(some, energy).alias("abs_energy"),
        F.when(m["low"] > 0, m["top"] / m["low"] * 1000 * scale).alias("slope"),
    )
