"""The thirteen statistics of trailing frames over one block of one series.

Spark's sliding window frames read the whole frame again for every row, and
refuse exact quantiles. Here Spark partitions the panel into blocks and hands
each block over as an Arrow table; the sliding itself costs the same per row
whatever the frame length (sums) or its logarithm (order statistics). Sums are
taken over whole numbers, so they are exact and differences of them do not cancel.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa

from ..spec import Span

STATISTICS = (
    "avg", "min", "max", "q25", "q50", "q75", "std", "skew", "kurt",
    "geomean", "sum", "abs_energy", "slope",
)
QUANTILES = {"q25": 0.25, "q50": 0.50, "q75": 0.75}
FROM_VALUES = ("min", "max", *QUANTILES)


def block_statistics(
    frames: dict[str, Span], lags: dict[str, Span], horizon_seconds: int, target: str, time: str, seconds: str, block: str,
    block_seconds: int, keep: Sequence[str], no_history: int, quantiles_only: bool = False,
) -> Callable[[pa.Table], pa.Table]:
    """Function for a grouped map over Arrow tables, one block of one series each.

    The table holds the block's rows and the history before them, in any order,
    with epoch seconds in ``seconds`` and the block id in ``block``. The result
    holds the block's own rows: the columns ``keep``, ``<stat>_<target>_<frame>``
    and the lags. Blocks up to ``no_history`` hold rows without a past. Whole numbers stay exact; a sum
    beyond 64 bits is an error. ``quantiles_only`` leaves out all other statistics. NaN is a value, larger than all others, as in Spark's
    aggregates, and a frame with a NaN or an infinite value has such sums and moments.
    """
    spans = {name: (span.months, span.seconds) for name, span in frames.items()}
    lag_seconds = {name: span.seconds for name, span in lags.items()}
    quantile_points, from_values_of = dict(QUANTILES), FROM_VALUES
    statistics = tuple(QUANTILES) if quantiles_only else STATISTICS

    # Everything used inside is local, so executors need no copy of this package.
    def slide(table):
        import math

        import numpy as np
        import pandas as pd
        import pyarrow as pa
        from pandas.api.indexers import BaseIndexer

        class Given(BaseIndexer):
            def get_window_bounds(self, num_values=0, min_periods=None, center=None, closed=None, step=None):
                return self.lo, self.hi

        def whole_numbers(x):
            """Integers v and a power of two d with x = v / d, exactly."""
            if x.dtype.kind == "i":
                return x.astype("int64"), 1
            if (x == np.rint(x)).all() and np.abs(x).max(initial=0) < 2**53:
                return x.astype("int64"), 1
            ratios = [value.as_integer_ratio() for value in x.tolist()]
            d = max(bottom for _, bottom in ratios)
            return np.array([top * (d // bottom) for top, bottom in ratios], dtype=object), d

        def running(values):
            return np.concatenate([np.zeros(1, dtype=values.dtype), np.cumsum(values)])

        def real(values):
            """As doubles; infinite where too large for one."""
            try:
                return values.astype("float64")
            except OverflowError:
                return np.array([float(v) if abs(v) < 2**1023 else math.inf if v > 0 else -math.inf for v in values])

        def prefix_sums(t, x, present):
            """Running sums that every frame of the block is a difference of."""
            valid = present & np.isfinite(x)
            v, d = whole_numbers(np.where(valid, x, x.dtype.type(0)))
            x = x.astype("float64")
            unit = int(np.gcd.reduce(np.diff(t))) if len(t) > 1 else 1
            k = (t - t[0]) // unit
            size, top, reach = len(t), max(int(v.max(initial=0)), -int(v.min(initial=0))), int(k[-1])
            # 64-bit sums may wrap on the way; what comes out is right as long as
            # the shifted sums themselves fit. Otherwise Python's integers do it.
            width = int(v[valid].max(initial=0) - v[valid].min(initial=0)) + 1
            largest = max(size * width**4, size * top**2, size**2 * reach * max(reach, width))
            fits = v.dtype != object and largest < 2**63
            v = v.astype("int64" if fits else object)
            k = np.where(valid, k, 0).astype(v.dtype)
            inside = valid & (x > -1)
            logs = np.log(np.where(inside, x, 0.0) + 1)
            bits = 61 - math.ceil(math.log2(size * (np.abs(logs).max(initial=0) + 1)))
            sums = {
                "n": valid.astype("int64"),
                "nan": (present & np.isnan(x)).astype("int64"),
                "up": (present & (x == np.inf)).astype("int64"),
                "down": (present & (x == -np.inf)).astype("int64"),
                "outside": (valid & ~inside).astype("int64"),
                "log": np.rint(np.ldexp(logs, bits)).astype("int64"),
                "s1": v, "s2": v * v, "s3": v * v * v, "s4": v * v * v * v,
                "t1": k, "t2": k * k, "tx": k * v,
            }
            return {name: running(values) for name, values in sums.items()}, d, unit, bits

        def from_sums(sums, lo, hi, d, unit, bits, whole):
            f = {name: total[hi] - total[lo] for name, total in sums.items()}
            count, n = f["n"], f["n"].astype("float64")
            # Shift to a whole number next to the mean: still exact, and small.
            c = (2 * f["s1"] + count) // (2 * np.maximum(count, 1))
            d1 = f["s1"] - count * c
            d2 = f["s2"] - c * (2 * f["s1"] - count * c)
            d3 = f["s3"] - c * (3 * f["s2"] - c * (3 * f["s1"] - count * c))
            d4 = f["s4"] - c * (4 * f["s3"] - c * (6 * f["s2"] - c * (4 * f["s1"] - count * c)))
            e, a2, a3, a4 = (real(part) / n for part in (d1, d2, d3, d4))
            m2 = a2 - e * e
            m3 = a3 - 3 * e * a2 + 2 * e**3
            m4 = a4 - 4 * e * a3 + 6 * e * e * a2 - 3 * e**4
            spread = np.where(m2 > 0, m2, np.nan)
            g1, g2 = m3 / spread**1.5, m4 / (spread * spread) - 3
            t_top = real(count * f["tx"] - f["t1"] * f["s1"])
            t_low = real(count * f["t2"] - f["t1"] * f["t1"])
            total = real(f["s1"])
            found = {
                "avg": total / n / d,
                "std": np.where(n > 1, np.sqrt(np.maximum(m2, 0) * n / (n - 1)) / d, np.nan),
                "skew": np.where(n > 2, g1 * np.sqrt(n * (n - 1)) / (n - 2), np.nan),
                "kurt": np.where(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6), np.nan),
                "geomean": np.where(f["outside"] == 0, np.exp(np.ldexp(f["log"] / n, -bits)) - 1, np.nan),
                "sum": np.where(n > 0, total / d, np.nan),
                "abs_energy": np.where(n > 0, real(f["s2"]) / d / d, np.nan),
                "slope": np.where(t_low > 0, t_top / t_low / unit / d, np.nan),
            }
            missing = {name: np.isnan(values) for name, values in found.items()}
            hot = f["nan"] + f["up"] + f["down"] > 0
            if hot.any():
                n = count + f["nan"] + f["up"] + f["down"]
                both = (f["nan"] > 0) | ((f["up"] > 0) & (f["down"] > 0))
                total = np.where(both, np.nan, np.where(f["up"] > 0, np.inf, -np.inf))
                below = (f["outside"] > 0) | (f["down"] > 0)
                given = {
                    "avg": (total, 1), "sum": (total, 1), "abs_energy": (np.where(f["nan"] > 0, np.nan, np.inf), 1),
                    "geomean": (np.where(f["nan"] > 0, np.nan, np.inf), 1), "std": (np.nan, 2), "skew": (np.nan, 3),
                    "kurt": (np.nan, 4), "slope": (np.nan, 2),
                }
                for name, (values, least) in given.items():
                    found[name] = np.where(hot, values, found[name])
                    missing[name] = np.where(hot, n < least, missing[name])
                missing["geomean"] |= hot & below
            else:
                n = count
            if whole:
                found["sum"] = f["s1"]
            return n, {name: (values, missing[name]) for name, values in found.items()}

        def place(n, q):
            """Position of the discrete quantile among n sorted values."""
            return np.ceil(q * n) - 1

        def months_before(end, months):
            """The same time of day some months earlier, clamped to the month's last day."""
            moment = end.astype("M8[s]")
            day = moment.astype("M8[D]")
            month = day.astype("M8[M]")
            earlier = month - months
            last = (earlier + 1).astype("M8[D]") - 1
            moved = np.minimum(earlier.astype("M8[D]") + (day - month.astype("M8[D]")), last)
            return (moved.astype("M8[s]") + (moment - day)).astype("int64")

        def order_statistics(values, present, lo, hi, n):
            # Ranks instead of values: exact for long integers, and in order for infinite ones.
            distinct, rank = np.unique(values[present], return_inverse=True)
            x = np.full(len(values), np.nan)
            x[present] = rank
            ranks = ranks_in_frames(x, lo, hi, n)
            if not len(distinct):
                distinct = np.zeros(1, values.dtype)
            return {
                name: (distinct[np.where(np.isnan(at), 0, at).astype("int64")], np.isnan(at)) for name, at in ranks.items()
            }

        def ranks_in_frames(x, lo, hi, n):
            # Month frames step back at month ends. Rolling needs starts that
            # only advance; the few rows that step back are done one by one.
            first = len(x) - len(lo)
            steady = np.maximum.accumulate(lo)
            history = np.zeros(first, dtype="int64")
            rolling = pd.Series(x).rolling(
                Given(lo=np.concatenate([history, steady]), hi=np.concatenate([history, hi])), min_periods=1
            )

            def own(result):
                return result.to_numpy(copy=True)[first:]

            found = {"min": own(rolling.min()), "max": own(rolling.max())}
            for name, q in quantile_points.items():
                found[name] = own(rolling.quantile(q, interpolation="lower"))
                # The discrete position is one of the two neighbours of q*(n-1).
                upper = (n > 0) & (place(n, q) > np.floor(q * (n - 1)))
                if upper.any():
                    found[name][upper] = own(rolling.quantile(q, interpolation="higher"))[upper]
            for i in np.flatnonzero(lo < steady):
                values = x[lo[i]:hi[i]]
                values = np.sort(values[~np.isnan(values)])
                picks = {"min": 0, "max": len(values) - 1}
                picks.update({name: int(place(len(values), q)) for name, q in quantile_points.items()})
                for name, pick in picks.items():
                    found[name][i] = values[pick] if len(values) else np.nan
            return found

        def column(values, missing, kind):
            if values.dtype == object:  # fails where a sum does not fit
                return pa.array([None if gone else int(v) for v, gone in zip(values, missing)], pa.int64()).cast(kind)
            return pa.array(values, mask=missing, from_pandas=False).cast(kind)

        kind = table.schema.field(target).type
        kinds = {name: kind for name in from_values_of}
        kinds["sum"] = pa.int64() if pa.types.is_integer(kind) else pa.float64()
        if table.num_rows and table[block][0].as_py() <= no_history:
            own = table.select(list(keep))
            for frame in spans:
                for name in statistics:
                    own = own.append_column(f"{name}_{target}_{frame}", pa.nulls(len(own), kinds.get(name, pa.float64())))
            for name in lag_seconds:
                own = own.append_column(name, pa.nulls(len(own), kind))
            return own
        t = table[seconds].to_numpy()
        if (np.diff(t) < 0).any():
            order = np.argsort(t, kind="stable")
            table, t = table.take(order), t[order]
        moments = table[time].to_numpy()
        if (moments[1:] == moments[:-1]).any():
            raise ValueError("a series has two rows of one time; duplicate_keys lists them")
        first = int(np.searchsorted(t, table[block][0].as_py() * block_seconds))
        whole = pa.types.is_integer(kind)
        present = table[target].is_valid().to_numpy()
        x = table[target].cast(pa.int64() if whole else pa.float64(), safe=False).combine_chunks()
        x = x.fill_null(0).to_numpy(zero_copy_only=False)
        own = table.slice(first).select(list(keep))
        end = t[first:] - horizon_seconds
        hi = np.searchsorted(t, end, side="right")
        known = (hi > 0) & (t[hi - 1] == end)
        sums = None if quantiles_only or not len(end) else prefix_sums(t, x, present)
        held = running(present.astype("int64"))
        names, arrays = list(keep), list(own.columns)
        for frame, (months, length) in spans.items():
            if not len(end):  # nothing but history, as after the last block of a series
                found = dict.fromkeys(statistics, (np.empty(0), np.empty(0, bool)))
            else:
                start = end - length if months is None else months_before(end, months)
                lo = np.searchsorted(t, start, side="left")
                with np.errstate(all="ignore"):
                    n, found = (held[hi] - held[lo], {}) if sums is None else from_sums(sums[0], lo, hi, *sums[1:], whole)
                    found.update(order_statistics(x, present, lo, hi, n))
            for name in statistics:
                names.append(f"{name}_{target}_{frame}")
                values, missing = found[name]
                arrays.append(column(values, missing | ~known, kinds.get(name, pa.float64())))
        for name, length in lag_seconds.items():
            at = np.searchsorted(t, t[first:] - length)
            names.append(name)
            arrays.append(table[target].take(pa.array(at, mask=t[at] != t[first:] - length)))
        return pa.Table.from_arrays(arrays, names)

    return slide
