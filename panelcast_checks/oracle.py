"""SQL building blocks for the counterparts of the operators."""

from __future__ import annotations

from collections.abc import Sequence

from panelcast.spec import PanelSpec, interval_suffix


def nudge(digits: int) -> str:
    """Added before rounding. Many results are exact halves of the last digit, which each
    engine reaches with its own noise in the last bit; this makes both round them up."""
    return f"3e-{digits + 4}"


def rounded(expression: str, digits: int | None = 6) -> str:
    """Rounded, with NaN as NULL and no negative zero; without ``digits`` as it is, with NaN as NULL."""
    if digits is None:
        return f"CASE WHEN NOT isnan({expression}) THEN {expression} END"
    value = f"round({expression} + {nudge(digits)}, {digits})"
    return f"CASE WHEN isnan({expression}) THEN NULL WHEN {value} = 0 THEN 0 ELSE {value} END"


def dense(totals: str, spec: PanelSpec, step: str) -> str:
    """Totals on the full grid."""
    keys = ", ".join(f"k.{key}" for key in spec.keys)
    on = " AND ".join(f"o.{key} = k.{key}" for key in spec.keys)
    return f"""
    SELECT a."{spec.time}", {keys}, o.{spec.target},
           CAST(CASE WHEN o.{spec.target} IS NULL THEN 1 ELSE 0 END AS TINYINT) AS was_null
    FROM (SELECT unnest(generate_series(min("{spec.time}"), max("{spec.time}"), INTERVAL {step})) AS "{spec.time}"
          FROM ({totals}) AS b) AS a
    CROSS JOIN (SELECT DISTINCT {', '.join(spec.keys)} FROM ({totals}) AS d) AS k
    LEFT JOIN ({totals}) AS o ON o."{spec.time}" = a."{spec.time}" AND {on}"""


def statistics(spec: PanelSpec, window: str, digits: int | None = 6) -> dict[str, str]:
    """Window expressions of the statistics, rounded."""
    x = spec.target
    over = f"OVER {window}"

    def rounded(expression: str) -> str:
        return globals()["rounded"](expression, digits)

    return {
        "avg": rounded(f"avg({x}) {over}"),
        "min": f"min({x}) {over}",
        "max": f"max({x}) {over}",
        "q25": f"quantile_disc({x}, 0.25) {over}",
        "q50": f"quantile_disc({x}, 0.5) {over}",
        "q75": f"quantile_disc({x}, 0.75) {over}",
        "std": rounded(f"stddev_samp({x}) {over}"),
        "skew": rounded(f"skewness({x}) {over}"),
        "kurt": rounded(f"kurtosis({x}) {over}"),
        "geomean": rounded(f"exp(avg(ln({x} + 1)) {over}) - 1"),
        "sum": f"CAST(sum({x}) {over} AS BIGINT)",
        "abs_energy": f"CAST(sum({x} * {x}) {over} AS BIGINT)",
        "slope": rounded(f"86400 * regr_slope({x}, epoch(\"{spec.time}\")) {over}"),
    }


def stat_features(panel: str, spec: PanelSpec, intervals: Sequence[str], horizon: int, digits: int | None = 6) -> str:
    """Every panel row with the statistics known ``horizon`` days before."""
    keys = ", ".join(spec.keys)
    columns, windows = [], []
    for text in intervals:
        name = interval_suffix(text)
        windows.append(
            f'w_{name} AS (PARTITION BY {keys} ORDER BY "{spec.time}" '
            f"RANGE BETWEEN INTERVAL {text} PRECEDING AND CURRENT ROW)"
        )
        columns += [f"{e} AS {s}_{spec.target}_{name}" for s, e in statistics(spec, f"w_{name}", digits).items()]
    on = " AND ".join(f"s.{key} = p.{key}" for key in spec.keys)
    return f"""
    WITH panel AS ({panel}),
    stats AS (SELECT "{spec.time}", {keys}, {', '.join(columns)} FROM panel WINDOW {', '.join(windows)})
    SELECT p.*, s.* EXCLUDE ("{spec.time}", {keys})
    FROM panel AS p LEFT JOIN stats AS s ON s."{spec.time}" + INTERVAL {horizon} DAY = p."{spec.time}" AND {on}"""


def lag_features(panel: str, spec: PanelSpec, lags: Sequence[int], unit: str = "DAY") -> str:
    """Every panel row with the values that fall on its time when they are moved by each lag.

    In months several values can fall on one time, which multiplies rows: one self-join per lag. Else there is one value at most: one
    join with all moved values.
    """
    keys = ", ".join(spec.keys)
    if unit == "MONTH":
        joins, columns = [], []
        for lag in lags:
            on = " AND ".join(f"b{lag}.{key} = p.{key}" for key in spec.keys)
            joins.append(
                f'LEFT JOIN panel AS b{lag} ON b{lag}."{spec.time}" + INTERVAL {lag} {unit} = p."{spec.time}" AND {on}'
            )
            columns.append(f"b{lag}.{spec.target} AS {spec.target}_lag_{lag}")
        return f"WITH panel AS MATERIALIZED ({panel}) SELECT p.*, {', '.join(columns)} FROM panel AS p {' '.join(joins)}"
    names = [f"{spec.target}_lag_{lag}" for lag in lags]
    values = ", ".join(f"any_value(CASE WHEN lag = {lag} THEN value END) AS {name}" for lag, name in zip(lags, names))
    on = " AND ".join(f"m.{key} = p.{key}" for key in spec.keys)
    return f"""
    WITH panel AS MATERIALIZED ({panel}),
    moved AS (
        SELECT {keys}, "{spec.time}" + lag * INTERVAL 1 {unit} AS moment, lag, {spec.target} AS value
        FROM panel, (VALUES {', '.join(f'({lag})' for lag in lags)}) AS l(lag)),
    pivoted AS (SELECT {keys}, moment, {values} FROM moved GROUP BY {keys}, moment)
    SELECT p.*, {', '.join(f'm.{name}' for name in names)}
    FROM panel AS p LEFT JOIN pivoted AS m ON m.moment = p."{spec.time}" AND {on}"""


def cyclic(name: str, value: str, period: str) -> str:
    return ", ".join(
        f"{rounded(f'{fn}(2 * pi() * {value} / {period})')} AS {name}_{fn}" for fn in ("sin", "cos")
    )


def clock(stamp: str) -> str:
    return cyclic("hour", f"hour({stamp})", "24") + ", " + cyclic("minute", f"minute({stamp})", "60")


def calendar_fields(stamp: str) -> dict[str, str]:
    return {
        "year": f"isoyear({stamp})",
        "doy": f"dayofyear({stamp})",
        "woy": f"weekofyear({stamp})",
        "moy": f"month({stamp})",
        "dow": f"isodow({stamp})",
        "dom": f"day({stamp})",
        "total_days_in_month": f"day(last_day(CAST({stamp} AS DATE)))",
        "total_weeks_in_year": f"weekofyear(make_date(CAST(isoyear({stamp}) AS INTEGER), 12, 28))",
        "total_days_in_year": f"dayofyear(make_date(CAST(year({stamp}) AS INTEGER), 12, 31))",
    }


def date_features(panel: str, time: str, holidays: str) -> str:
    """Clock and calendar encodings and holiday counts of every panel row."""
    fields = ", ".join(f"{sql} AS {name}" for name, sql in calendar_fields("day").items())
    counts = ", ".join(
        f"CAST(sum(h) OVER (ORDER BY day RANGE BETWEEN {low} AND {high}) AS INTEGER) AS hc_in_{side}_{k}_days"
        for side in ("last", "next")
        for k in range(7, 1, -1)
        for low, high in [
            (f"INTERVAL {k - 1} DAY PRECEDING", "CURRENT ROW")
            if side == "last" else ("CURRENT ROW", f"INTERVAL {k - 1} DAY FOLLOWING")
        ]
    )
    parts = ", ".join(
        cyclic(name, value, period)
        for name, value, period in (
            ("month", "moy", "12"), ("dow", "dow", "7"), ("dom", "dom", "total_days_in_month"),
            ("woy", "woy", "total_weeks_in_year"), ("doy", "doy", "total_days_in_year"),
        )
    )
    return f"""
    WITH panel AS ({panel}),
    days AS (SELECT DISTINCT CAST("{time}" AS DATE) AS day FROM panel),
    marked AS (SELECT day, CASE WHEN day IN ({holidays}) THEN 1 ELSE 0 END AS h, {fields} FROM days),
    calendar AS (
        SELECT day, h = 1 AS is_holiday, {counts}, {parts},
               CASE WHEN dow IN (6, 7) THEN 1 ELSE 0 END AS is_weekend
        FROM marked)
    SELECT p.*, {clock(f'p."{time}"')}, c.* EXCLUDE (day)
    FROM panel AS p LEFT JOIN calendar AS c ON CAST(p."{time}" AS DATE) = c.day"""


def errors(scored: str, groups: Sequence[str], target: str, prediction: str = "prediction") -> str:
    """rmse, medae, mae and mape per group."""
    gap = f"abs({target} - {prediction})"
    keys = "".join(f"{g}, " for g in groups)
    return f"""
    SELECT {keys}
           {rounded(f'sqrt(avg(power(CAST({target} - {prediction} AS DOUBLE), 2)))')} AS rmse,
           {rounded(f'quantile_cont(CAST({gap} AS DOUBLE), 0.5)')} AS medae,
           {rounded(f'avg({gap})')} AS mae,
           {rounded(f'avg({gap} / greatest(abs(CAST({target} AS DOUBLE)), 2.220446049250313e-16))')} AS mape
    FROM ({scored}) AS scored GROUP BY {', '.join(groups)}"""
