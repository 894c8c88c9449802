"""The registered queries as plain SQL on the test tables, for an independent check."""

from __future__ import annotations

# --- Grids -------------------------------------------------------------------

_DENSE = """
  TIMESTAMP '2024-01-01' + to_hours(CAST(6 * ({k} // 25) AS BIGINT)) AS valid_time,
  CAST(50 - 10 * (({k} // 5) % 5) AS DOUBLE) AS latitude,
  CAST(60 + 10 * ({k} % 5) AS DOUBLE) AS longitude"""
_K = _DENSE.format(k="event_id")

GI = f"gi AS (SELECT {_K}, 293.15 + value / 10 AS t2m, (value % 100) / 100 AS tcc FROM events)"
GN = (
    f"gn AS (SELECT {_K}, CASE WHEN event_type <> 'error' THEN 293.15 + value / 10 END AS t2m,"
    " (value % 100) / 100 AS tcc FROM events)"
)
GA = (
    f"ga AS (SELECT {_DENSE.format(k='o_orderkey')}, 2 * o_totalprice AS ssr, -o_totalprice / 2 AS str,"
    " 4 * o_totalprice AS tisr, 3 * o_totalprice AS tsr, -o_totalprice AS ttr FROM orders)"
)
GS = """gs AS (SELECT
  TIMESTAMP '2021-01-01' + to_days(CAST(4 * ((event_id // 16) // 6) AS INTEGER))
    + to_hours(CAST(4 * ((event_id // 16) % 6) AS BIGINT)) AS valid_time,
  CAST(35 - 5 * ((event_id // 4) % 4) AS DOUBLE) AS latitude,
  CAST(70 + 5 * (event_id % 4) AS DOUBLE) AS longitude,
  293.15 + value / 10 AS t2m, 90000 + 20 * value AS sp, value * 1e-5 AS tp FROM events)"""

SA = "latitude >= 5 AND latitude <= 35 AND longitude >= 65 AND longitude <= 100"
CI = "latitude >= 20 AND latitude <= 30 AND longitude >= 75 AND longitude <= 85"


def _wmean(x: str) -> str:
    w = "cos(radians(latitude))"
    return f"sum(({x}) * {w}) / sum(CASE WHEN ({x}) IS NOT NULL THEN {w} END)"


# --- South Asia: steps and days ----------------------------------------------


def _steps(instant: str = "gi") -> str:
    """Step series: both step types reduced on their own, then joined on time."""
    return f"""si AS (SELECT valid_time, {_wmean('t2m - 273.15')} AS t2m_c, {_wmean('tcc')} AS tcc,
    avg(CASE WHEN t2m - 273.15 > 35 THEN 1.0 ELSE 0.0 END) AS frac_above_35c,
    avg(CASE WHEN t2m - 273.15 > 40 THEN 1.0 ELSE 0.0 END) AS frac_above_40c
  FROM {instant} WHERE {SA} GROUP BY 1),
sa AS (SELECT valid_time, {_wmean('ssr / 21600')} AS ssr, {_wmean('str / 21600')} AS str_nlw,
    {_wmean('tisr / 21600')} AS tisr, {_wmean('tsr / 21600')} AS tsr, {_wmean('ttr / 21600')} AS ttr
  FROM ga WHERE {SA} GROUP BY 1),
steps AS (SELECT coalesce(si.valid_time, sa.valid_time) AS valid_time, t2m_c, tcc, ssr, str_nlw, tisr, tsr, ttr,
    frac_above_35c, frac_above_40c FROM si FULL JOIN sa ON si.valid_time = sa.valid_time)"""


_PLAIN_STEPS = f"""pi AS (SELECT valid_time, avg(t2m - 273.15) AS t2m_c, avg(tcc) AS tcc FROM gi WHERE {SA} GROUP BY 1),
pa AS (SELECT valid_time, avg(ssr / 21600) AS ssr, avg(str / 21600) AS str_nlw, avg(tisr / 21600) AS tisr,
    avg(tsr / 21600) AS tsr, avg(ttr / 21600) AS ttr FROM ga WHERE {SA} GROUP BY 1),
psteps AS (SELECT coalesce(pi.valid_time, pa.valid_time) AS valid_time, t2m_c, tcc, ssr, str_nlw, tisr, tsr, ttr
  FROM pi FULL JOIN pa ON pi.valid_time = pa.valid_time)"""

_MEANS = ("t2m_c", "tcc", "ssr", "str_nlw", "tisr", "tsr", "ttr")
_METRICS = (*_MEANS, "t2m_c_max", "t2m_c_min", "net_rad", "reflected_solar")
_HEAT = ("frac_above_35c", "frac_above_40c")
_COMPARED = ("t2m_c", "tcc", "ssr", "str_nlw", "net_rad")


def _days(name: str, steps: str, heat: bool = False) -> str:
    peaks = ", max(frac_above_35c) AS frac_above_35c, max(frac_above_40c) AS frac_above_40c" if heat else ""
    return f"""{name} AS (SELECT date_trunc('day', valid_time) AS time,
    {', '.join(f'avg({c}) AS {c}' for c in _MEANS)},
    max(t2m_c) AS t2m_c_max, min(t2m_c) AS t2m_c_min,
    avg(ssr) + avg(str_nlw) AS net_rad, avg(tisr) - avg(tsr) AS reflected_solar{peaks}
  FROM {steps} GROUP BY 1)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _r(*columns: str, digits: int = 8) -> str:
    return ", ".join(f"round({c}, {digits}) + 0.0 AS {c}" for c in columns)


_DAILY = (GI, GA, _steps(), _days("daily", "steps"))
_DAILY_HEAT = (GI, GA, _steps(), _days("daily", "steps", heat=True))
_PAIR = (GI, GA, _steps(), _days("daily", "steps"), _PLAIN_STEPS, _days("plain", "psteps"))
_HEAT_DAYS = (
    "heat AS (SELECT date_trunc('day', valid_time) AS time, max(f35) AS frac_above_35c, max(f40) AS frac_above_40c"
    " FROM (SELECT valid_time, avg(CASE WHEN t2m - 273.15 > 35 THEN 1.0 ELSE 0.0 END) AS f35,"
    f" avg(CASE WHEN t2m - 273.15 > 40 THEN 1.0 ELSE 0.0 END) AS f40 FROM gi WHERE {SA} GROUP BY 1) GROUP BY 1)"
)

_CENTRAL = (
    GS,
    "cs AS (SELECT valid_time, avg(t2m - 273.15) AS t, avg(sp / 100) AS p, avg(tp * 1000) AS r"
    f" FROM gs WHERE {CI} GROUP BY 1)",
    "central AS (SELECT date_trunc('day', valid_time) AS date, avg(t) AS t2m_c_mean, avg(p) AS sp_hpa_mean,"
    " coalesce(sum(r), 0) AS tp_mm_total, CAST(month(valid_time) AS INTEGER) AS month,"
    " CAST(year(valid_time) AS INTEGER) AS year FROM cs GROUP BY ALL)",
)
_C = ("t2m_c_mean", "sp_hpa_mean", "tp_mm_total")

_ANOM = (
    "anom AS (SELECT time, "
    + ", ".join(f"{c} - avg({c}) OVER (PARTITION BY month(time)) AS {c}_anom" for c in _METRICS)
    + " FROM daily)"
)
_ANOM_OF = (
    "anom_{t} AS (SELECT time, "
    + ", ".join(f"{c} - avg({c}) OVER (PARTITION BY month(time)) AS {c}_anom" for c in _COMPARED)
    + " FROM {t})"
)


def _label(month: str) -> str:
    return f"substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(3 * {month} - 2 AS BIGINT), 3)"


def _rolling(x: str, before: int, after: int, need: int, order: str, partition: str = "") -> str:
    w = f"({partition} ORDER BY {order} ROWS BETWEEN {before} PRECEDING AND {after} FOLLOWING)"
    return f"CASE WHEN count({x}) OVER {w} >= {need} THEN avg({x}) OVER {w} END"


_CAL = ("t2m", "tcc", "ssr", "str", "tisr", "tsr", "ttr")
_CALENDAR = (
    GI,
    GA,
    "gsteps AS (SELECT * FROM (SELECT valid_time, avg(t2m) AS t2m, avg(tcc) AS tcc FROM gi GROUP BY 1) a"
    " FULL JOIN (SELECT valid_time, avg(ssr) AS ssr, avg(str) AS str, avg(tisr) AS tisr, avg(tsr) AS tsr,"
    " avg(ttr) AS ttr FROM ga GROUP BY 1) b USING (valid_time))",
    "cal AS (SELECT CAST(last_day(valid_time) AS TIMESTAMP) AS valid_time, avg(t2m) - 273.15 AS \"t2m_C\","
    " avg(tcc) AS tcc_fraction, "
    + ", ".join(f'avg({c}) / 21600 AS "{c}_Wm2"' for c in _CAL[2:])
    + " FROM gsteps GROUP BY 1)",
)


def _diff_rows(left: str, right: str, columns, name: str) -> str:
    """One row per column and common time with both values."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"{name}\", {left}.{c} AS r, {right}.{c} AS c FROM {left} JOIN {right} ON {left}.time = {right}.time"
        for c in columns
    )


def _consistency(left: str, right: str, columns) -> str:
    return (
        f"SELECT metric, count(*) AS rows_compared, round(max(abs(r - c)), 8) + 0.0 AS max_abs_diff,"
        f" round(avg(abs(r - c)), 8) + 0.0 AS mean_abs_diff FROM ({_diff_rows(left, right, columns, 'metric')}) GROUP BY 1"
    )


def _metrics(label: str, left: str, right: str, columns, atol: float, rtol: float) -> str:
    ok = (
        f"coalesce((r IS NOT DISTINCT FROM c) OR abs(c - r) <= {atol} + {rtol} * abs(r), false)"
    )
    return f"""SELECT '{label}' AS "table", "column", count(*) AS rows_compared, avg(abs(c - r)) AS mae,
    max(abs(c - r)) AS max_abs, sqrt(avg((c - r) * (c - r))) AS rmse,
    max(abs(c - r) / greatest(abs(r), 1e-12)) AS max_rel,
    avg(CASE WHEN {ok} THEN 1.0 ELSE 0.0 END) AS pass_rate, bool_and({ok}) AS passed
  FROM ({_diff_rows(left, right, columns, 'column')}) GROUP BY 2"""


_HEAT_GAPS = _HEAT_DAYS.replace("heat AS", "heat_gaps AS", 1).replace("FROM gi", "FROM gn")
_CHECKS = (
    *_PAIR,
    GN,
    _HEAT_DAYS,
    _HEAT_GAPS,
    "checks AS ("
    + _metrics("daily", "plain", "daily", _METRICS, 0.5, 1e-2)
    + " UNION ALL "
    + _metrics("heat", "heat", "heat_gaps", _HEAT, 0.02, 1e-3)
    + ")",
)

_STEP = "(epoch(valid_time) - 1704067200) / 21600"
_BT = "CAST(floor(floor({s}) / {k}) AS BIGINT) AS block_t"
_BY = "CAST(floor(round((50 - latitude) / 10) / 2) AS BIGINT) AS block_y"
_BX = "CAST(floor(round((longitude - 60) / 10) / 2) AS BIGINT) AS block_x"

_MONTHLY_MEANS = "avg({c}) AS {c}"


def _oracles() -> dict[str, str]:
    q: dict[str, str] = {}

    # Sources
    q["grid_scan"] = _with(GI) + "SELECT valid_time, latitude, longitude, round(t2m, 8) AS t2m FROM gi"
    q["multi_open"] = _with(GI, GN, GA) + (
        "SELECT coalesce(gi.valid_time, ga.valid_time) AS valid_time, coalesce(gi.latitude, ga.latitude) AS latitude,"
        " coalesce(gi.longitude, ga.longitude) AS longitude, round(coalesce(gi.t2m, gn.t2m), 8) AS t2m,"
        " round(gn.tcc, 8) AS tcc, round(ga.ssr, 8) AS ssr"
        " FROM gi JOIN gn USING (valid_time, latitude, longitude)"
        " FULL JOIN ga ON gi.valid_time = ga.valid_time AND gi.latitude = ga.latitude AND gi.longitude = ga.longitude"
    )
    thick = "tcc > 0.9 AND gn.t2m IS NOT NULL"
    q["open_conflicts"] = _with(GI, GN) + (
        "SELECT valid_time, latitude, longitude, 't2m' AS variable, 'a' AS low_file, round(gi.t2m, 8) AS low_value, 'b' AS high_file,"
        f" round(gn.t2m + 0.5, 8) AS high_value, 2 AS files FROM gi JOIN gn USING (valid_time, latitude, longitude, tcc) WHERE {thick}"
    )
    q["open_agreeing"] = _with(GI, GN) + (
        "SELECT valid_time, latitude, longitude, round(gi.t2m, 8) AS t2m, round(tcc, 8) AS tcc"
        f" FROM gi JOIN gn USING (valid_time, latitude, longitude, tcc) WHERE NOT ({thick})"
    )
    q["guarded_open"] = _with(GA) + (
        "SELECT valid_time, latitude, longitude, " + ", ".join(f"round({v} / 21600, 8) AS {v}" for v in ("ssr", "str", "tisr", "tsr", "ttr")) + " FROM ga"
    )
    q["ordered_table"] = _with(*_DAILY) + "SELECT time, round(t2m_c, 8) AS t2m_c, true AS follows FROM daily"
    q["distinct_months"] = _with(GI) + "SELECT DISTINCT date_trunc('month', valid_time)::TIMESTAMP AS month FROM gi"
    facts = {
        "temperature_summary.mean_t2m_c": "avg(t2m_c_mean)", "temperature_summary.max_t2m_c": "max(t2m_c_mean)",
        "temperature_summary.min_t2m_c": "min(t2m_c_mean)", "pressure_summary.mean_sp_hpa": "avg(sp_hpa_mean)",
        "precipitation_summary.mean_daily_tp_mm": "avg(tp_mm_total)", "precipitation_summary.total_tp_mm": "sum(tp_mm_total)",
    }
    first_only = {"correlations.temp_pressure": "corr(t2m_c_mean, sp_hpa_mean)", "range_c[0]": "min(t2m_c_mean)", "range_c[1]": "max(t2m_c_mean)"}
    y = " FROM central WHERE year = (SELECT min(year) FROM central)"
    told = " UNION ALL ".join(
        [f"SELECT '{p}' AS path, (SELECT {x} FROM central) AS f, (SELECT {x}{y}) AS s, NULL AS status" for p, x in facts.items()]
        + [f"SELECT '{p}', (SELECT {x} FROM central), NULL, 'first only'" for p, x in first_only.items()]
    )
    q["summary_diff"] = _with(*_CENTRAL, f"told AS ({told})") + (
        "SELECT path, round(f, 8) AS first, round(s, 8) AS second, round(abs(f - s), 8) AS difference,"
        " coalesce(status, CASE WHEN abs(f - s) <= 1e-6 THEN 'same' ELSE 'different' END) AS status FROM told"
    )
    q["unpack_scale_offset"] = (
        f"WITH raw AS (SELECT {_K}, CASE WHEN event_type = 'error' THEN -32767"
        " ELSE CAST(round(value * 100) AS INTEGER) END AS raw FROM events)"
        " SELECT valid_time, latitude, longitude,"
        " round(CASE WHEN raw = -32767 THEN NULL ELSE raw * CAST(0.01 AS DOUBLE) + CAST(273.15 AS DOUBLE) END, 8) AS t2m"
        " FROM raw"
    )
    q["explode_grid"] = q["grid_scan"]
    q["epoch_decode"] = (
        "SELECT event_id, TIMESTAMP '1970-01-01' + to_seconds(1704067200 + 21600 * (event_id // 25)) AS valid_time"
        " FROM events"
    )
    q["csv_roundtrip"] = _with(*_DAILY) + f"SELECT time, {_r(*_METRICS)} FROM daily"

    # Filters, units, calendar
    q["region_filter"] = _with(GI) + (
        f"SELECT valid_time, latitude, longitude, {_r('t2m', 'tcc')} FROM gi WHERE {SA}"
    )
    q["stored_grid"] = _with(GI) + (
        f"SELECT valid_time, latitude, longitude, round(t2m, 8) AS t2m FROM gi WHERE {SA}"
        " AND valid_time BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'"
    )
    q["time_window"] = _with(GI) + (
        f"SELECT valid_time, latitude, longitude, {_r('t2m', 'tcc')} FROM gi"
        " WHERE valid_time <= (SELECT min(valid_time) FROM gi) + INTERVAL 5 DAY"
    )
    q["unit_convert"] = _with(GS, GA) + (
        "SELECT valid_time, latitude, longitude, round(t2m - 273.15, 8) AS t2m, round(sp / 100, 8) AS sp,"
        " round(tp * 1000, 8) AS tp, CAST(NULL AS DOUBLE) AS ssr_6h, CAST(NULL AS DOUBLE) AS ssr_1h FROM gs"
        " UNION ALL SELECT valid_time, latitude, longitude, NULL, NULL, NULL, round(ssr / 21600, 8),"
        " round(ssr / 3600, 8) FROM ga"
    )
    q["calendar_keys"] = _with(GS) + (
        "SELECT valid_time, latitude, longitude, date_trunc('day', valid_time)::TIMESTAMP AS date,"
        " CAST(month(valid_time) AS INTEGER) AS month, CAST(year(valid_time) AS INTEGER) AS year FROM gs"
    )
    q["first_year"] = _with(*_CENTRAL) + (
        f"SELECT date, {_r(*_C)}, month, year FROM central WHERE year = (SELECT min(year) FROM central)"
    )
    q["grid_preview"] = _with(GI) + (
        f"SELECT valid_time, latitude, longitude, {_r('t2m', 'tcc')} FROM gi"
        " ORDER BY valid_time, latitude DESC, longitude LIMIT 5"
    )

    # Combining
    merged = (
        "SELECT coalesce(gi.valid_time, ga.valid_time) AS valid_time, coalesce(gi.latitude, ga.latitude) AS latitude,"
        " coalesce(gi.longitude, ga.longitude) AS longitude, "
        + _r("t2m", "tcc", "ssr", "str", "tisr", "tsr", "ttr")
        + " FROM gi {how} JOIN ga ON gi.valid_time = ga.valid_time AND gi.latitude = ga.latitude"
        " AND gi.longitude = ga.longitude"
    )
    q["merge_steps_outer"] = _with(GI, GA) + merged.format(how="FULL")
    q["merge_steps_inner"] = _with(GI, GA) + merged.format(how="INNER")
    q["merge_packed"] = q["merge_steps_inner"]
    fine = (
        "SELECT {k} // 25 AS s, ({k} // 5) % 5 AS r, {k} % 5 AS c, {v} FROM {t}"
    )
    q["merge_steps_indexed"] = (
        "SELECT TIMESTAMP '2024-01-01' + to_hours(CAST(6 * s AS BIGINT)) AS valid_time, round(50 - r * CAST(0.1 AS DOUBLE), 8) AS latitude,"
        " round(60 + c * CAST(0.1 AS DOUBLE), 8) AS longitude, round(t2m, 8) AS t2m, round(ssr, 8) AS ssr FROM ("
        + fine.format(k="event_id", v="293.15 + value / 10 AS t2m", t="events")
        + ") FULL JOIN ("
        + fine.format(k="o_orderkey", v="2 * o_totalprice AS ssr", t="orders")
        + ") USING (s, r, c)"
    )
    q["pack_grid"] = _with(GI) + (
        "SELECT valid_time, latitude, longitude, CASE WHEN event_type <> 'error' THEN round(t2m, 8) END AS t2m,"
        f" CASE WHEN event_type <> 'error' THEN round(tcc, 8) END AS tcc FROM gi JOIN (SELECT {_K}, event_type FROM events)"
        " USING (valid_time, latitude, longitude)"
    )
    q["daily_with_heat"] = _with(*_DAILY, _HEAT_DAYS) + (
        f"SELECT daily.time, {_r(*_METRICS, *_HEAT)} FROM daily LEFT JOIN heat ON daily.time = heat.time"
    )
    q["common_keys"] = _with(GI, GA) + "SELECT valid_time FROM gi INTERSECT SELECT valid_time FROM ga"
    q["month_spine"] = _with(*_DAILY) + (
        f"SELECT CAST(m AS INTEGER) AS month, {_r(*_METRICS)} FROM range(1, 13) r(m) LEFT JOIN"
        f" (SELECT month(time) AS mm, {', '.join(f'avg({c}) AS {c}' for c in _METRICS)} FROM daily GROUP BY 1) d"
        " ON mm = m"
    )
    q["daily_gap_filled"] = _with(*_CENTRAL) + (
        "SELECT d.date, round(t2m_c_mean, 8) AS t2m_c_mean, round(sp_hpa_mean, 8) AS sp_hpa_mean,"
        " round(coalesce(tp_mm_total, 0), 8) AS tp_mm_total FROM (SELECT unnest(generate_series("
        "(SELECT min(date) FROM central), (SELECT max(date) FROM central), INTERVAL 1 DAY)) AS date) d"
        " LEFT JOIN central ON central.date = d.date"
    )

    # Space
    q["spatial_mean"] = _with(GN) + (
        "SELECT valid_time, round(avg(t2m), 8) AS t2m, round(avg(tcc), 8) AS tcc FROM gn GROUP BY 1"
    )
    q["weighted_mean"] = _with(GN) + (
        f"SELECT valid_time, round({_wmean('t2m - 273.15')}, 8) AS t2m_c, round({_wmean('tcc')}, 8) AS tcc"
        f" FROM gn WHERE {SA} GROUP BY 1"
    )
    for name, rest in (("heat_fraction", "ELSE 0.0"), ("heat_fraction_present", "WHEN t2m IS NOT NULL THEN 0.0")):
        q[name] = _with(GN) + (
            "SELECT valid_time, "
            + ", ".join(
                f"round(avg(CASE WHEN t2m - 273.15 > {x} THEN 1.0 {rest} END), 8) AS frac_above_{x}c" for x in (35, 40)
            )
            + f" FROM gn WHERE {SA} GROUP BY 1"
        )
    q["packed_means"] = q["weighted_mean"]
    hot = ", ".join(f"round(avg(CASE WHEN t2m - 273.15 > {x} THEN 1.0 ELSE 0.0 END), 8) AS frac_above_{x}c" for x in (35, 40))
    q["packed_heat"] = _with(GN) + (
        f"SELECT valid_time, round(avg(t2m - 273.15), 8) AS t2m_c, round(avg(tcc), 8) AS tcc, {hot} FROM gn WHERE {SA} GROUP BY 1"
    )

    boxes = {"south_asia": SA, "central_india": CI, "north_west": "latitude BETWEEN 30 AND 50 AND longitude BETWEEN 60 AND 80", "globe": "true"}
    shares = ", ".join(f"avg(CASE WHEN t2m - 273.15 > {x} THEN 1.0 ELSE 0.0 END) AS frac_above_{x}c" for x in (35, 40))
    each = " UNION ALL ".join(
        f"SELECT '{name}' AS region, valid_time, {_wmean('t2m - 273.15')} AS t2m_c, {_wmean('tcc')} AS tcc, {shares} FROM gn WHERE {box} GROUP BY valid_time"
        for name, box in boxes.items()
    )
    day = ", ".join(f"round(avg({c}), 8) AS {c}, round(max({c}), 8) AS {c}_max, round(min({c}), 8) AS {c}_min" for c in ("t2m_c", "tcc"))
    q["regions_daily"] = _with(GN, f"rs AS ({each})") + (
        f"SELECT region, date_trunc('day', valid_time)::TIMESTAMP AS time, {day},"
        " round(max(frac_above_35c), 8) AS frac_above_35c, round(max(frac_above_40c), 8) AS frac_above_40c FROM rs GROUP BY 1, 2"
    )
    q["kept_refresh"] = _with(
        GI, f"si AS (SELECT valid_time, {_wmean('t2m - 273.15')} AS t2m_c, {_wmean('tcc')} AS tcc FROM gi WHERE {SA} GROUP BY 1)"
    ) + f"SELECT date_trunc('day', valid_time)::TIMESTAMP AS time, {day} FROM si GROUP BY 1"

    def both(table: str, variables: tuple[str, ...]) -> str:
        means = ", ".join(f"avg({v}) AS {v}_global, avg({v}) FILTER (WHERE {SA}) AS {v}_region" for v in variables)
        return f"SELECT valid_time, {means} FROM {table} GROUP BY 1"

    names = [f"{v}_{part}" for v in ("t2m", "tcc", "tsr", "ttr") for part in ("global", "region")]
    q["both_steps_means"] = _with(GN, GA) + (
        f"SELECT coalesce(a.valid_time, b.valid_time) AS valid_time, {_r(*names)}"
        f" FROM ({both('gn', ('t2m', 'tcc'))}) a FULL JOIN ({both('ga', ('tsr', 'ttr'))}) b ON a.valid_time = b.valid_time"
    )
    q["region_vs_global"] = _with(GN) + (
        "SELECT valid_time, "
        + ", ".join(
            f"round(avg({v}), 8) AS {v}_global, round(avg({v}) FILTER (WHERE {SA}), 8) AS {v}_region"
            for v in ("t2m", "tcc")
        )
        + " FROM gn GROUP BY 1"
    )
    q["regional_step_series"] = _with(GI, GA, _steps()) + f"SELECT valid_time, {_r(*_MEANS, *_HEAT)} FROM steps"
    extents = ", ".join(
        f"{f}({c}) AS {c}_{f}" for c in ("valid_time", "latitude", "longitude") for f in ("min", "max")
    )
    q["grid_shape"] = _with(GS) + (
        "SELECT count(*) AS rows, count(DISTINCT valid_time) AS time_steps, count(DISTINCT latitude) AS latitudes,"
        f" count(DISTINCT longitude) AS longitudes, {extents} FROM gs"
    )

    # Days and months
    q["daily_metrics"] = _with(*_DAILY) + f"SELECT time, {_r(*_METRICS)} FROM daily"
    q["kept_daily"] = q["daily_metrics"]
    q["daily_metrics_gaps"] = _with(GN, GA, _steps("gn"), _days("daily", "steps", heat=True)) + (
        f"SELECT time, {_r(*_METRICS, *_HEAT)} FROM daily"
    )
    q["daily_heat"] = _with(GI, _HEAT_DAYS) + f"SELECT time, {_r(*_HEAT)} FROM heat"
    q["daily_precip"] = _with(GS) + (
        "SELECT date_trunc('day', valid_time) AS date, round(sum(r), 8) AS tp_mm_total FROM"
        " (SELECT valid_time, avg(tp * 1000) AS r FROM gs GROUP BY 1) GROUP BY 1"
    )
    q["central_daily"] = _with(*_CENTRAL) + f"SELECT date, {_r(*_C)}, month, year FROM central"
    means = ", ".join(_MONTHLY_MEANS.format(c=c) for c in (*_METRICS, *_HEAT))
    q["monthly_climatology"] = _with(*_DAILY_HEAT) + (
        f"SELECT month, {_r(*_METRICS, *_HEAT)} FROM (SELECT CAST(month(time) AS INTEGER) AS month, {means}"
        " FROM daily GROUP BY 1)"
    )
    q["central_climatology"] = _with(*_CENTRAL) + (
        f"SELECT month, {_r(*_C)} FROM (SELECT month, {', '.join(f'avg({c}) AS {c}' for c in _C)} FROM central GROUP BY 1)"
    )
    names = ('"t2m_C"', "tcc_fraction", *(f'"{c}_Wm2"' for c in _CAL[2:]))
    q["calendar_month"] = _with(*_CALENDAR) + (
        f"SELECT valid_time, {_r(*names)}, CAST(month(valid_time) AS INTEGER) AS month,"
        f" {_label('month(valid_time)')} AS month_abbr FROM cal"
    )
    q["calendar_month_sum"] = _with(GS) + (
        "SELECT valid_time, round(t - 273.15, 8) AS \"t2m_C\", round(p / 100, 8) AS \"sp_hPa\", round(r * 1000, 8) AS tp_mm,"
        f" CAST(month(valid_time) AS INTEGER) AS month, {_label('month(valid_time)')} AS month_abbr FROM"
        " (SELECT CAST(last_day(valid_time) AS TIMESTAMP) AS valid_time, avg(t2m) AS t, avg(sp) AS p, sum(tp) AS r FROM"
        " (SELECT valid_time, avg(t2m) AS t2m, avg(sp) AS sp, avg(tp) AS tp FROM gs"
        f" WHERE {CI} GROUP BY 1) GROUP BY 1)"
    )
    q["season_compare"] = _with(*_CENTRAL) + (
        "SELECT season, count(date) AS day_count, round(avg(t2m_c_mean), 8) AS t2m_c_mean,"
        " round(avg(sp_hpa_mean), 8) AS sp_hpa_mean, round(avg(tp_mm_total), 8) AS tp_mm_total_mean"
        " FROM (VALUES ('Monsoon sampled days', true), ('Other sampled days', false)) s(season, wet)"
        " LEFT JOIN central ON (month IN (6, 7, 8, 9)) = wet GROUP BY 1"
    )
    q["temp_pressure_corr"] = _with(
        *_CENTRAL,
        "whole AS (SELECT date_trunc('day', valid_time) AS date, avg(p) AS p FROM"
        " (SELECT valid_time, avg(sp / 100) AS p FROM gs GROUP BY 1) GROUP BY 1)",
    ) + "SELECT round(corr(t2m_c_mean, p), 8) AS temp_pressure FROM central JOIN whole USING (date)"
    q["argmax_month"] = _with(*_DAILY) + (
        f"SELECT CAST(month AS INTEGER) AS month, {_label('month')} AS month_abbr FROM"
        " (SELECT month(time) AS month, avg(ssr) AS v FROM daily GROUP BY 1) ORDER BY v DESC, month LIMIT 1"
    )
    q["table_stats"] = _with(*_CENTRAL) + (
        "SELECT round(avg(tp_mm_total), 8) AS mean, round(max(tp_mm_total), 8) AS max,"
        " round(min(tp_mm_total), 8) AS min, round(sum(tp_mm_total), 8) AS sum FROM central"
    )

    def best(column: str) -> str:
        return (
            f"(SELECT {_label('month')} FROM (SELECT month(time) AS month, avg({column}) AS v FROM daily GROUP BY 1)"
            " ORDER BY v DESC NULLS LAST, month LIMIT 1)"
        )

    q["region_summary"] = _with(*_DAILY_HEAT) + (
        "SELECT count(*) AS rows_daily, round(avg(t2m_c), 8) AS annual_mean_c, round(max(t2m_c_max), 8) AS annual_max_c,"
        " round(min(t2m_c_min), 8) AS annual_min_c,"
        " count(*) FILTER (WHERE frac_above_35c > 0) AS days_with_any_area_above_35c,"
        " count(*) FILTER (WHERE frac_above_40c > 0) AS days_with_any_area_above_40c,"
        " round(max(frac_above_35c) * 100, 8) AS peak_frac_above_35c_pct,"
        f" {best('t2m_c')} AS hottest_month,"
        " round(avg(net_rad), 8) AS annual_mean_net_surface_rad_wm2,"
        f" {best('ssr')} AS peak_solar_month, round(avg(tcc) * 100, 8) AS annual_mean_pct,"
        f" {best('tcc')} AS peak_cloud_month FROM daily"
    )
    q["sampled_summary"] = _with(*_CENTRAL) + (
        "SELECT round(avg(t2m_c_mean), 8) AS mean_t2m_c, round(max(t2m_c_mean), 8) AS max_t2m_c,"
        " round(min(t2m_c_mean), 8) AS min_t2m_c, round(avg(sp_hpa_mean), 8) AS mean_sp_hpa,"
        " round(avg(tp_mm_total), 8) AS mean_daily_tp_mm, round(sum(tp_mm_total), 8) AS total_tp_mm,"
        " round(corr(t2m_c_mean, sp_hpa_mean), 8) AS temp_pressure FROM central"
    )

    # Windows
    q["daily_anomaly"] = _with(*_DAILY, _ANOM) + f"SELECT time, {_r(*(c + '_anom' for c in _METRICS))} FROM anom"
    q["rolling15"] = _with(*_DAILY) + (
        f"SELECT time, round(t2m_c, 8) AS t2m_c, round({_rolling('t2m_c', 7, 7, 7, 'time')}, 8) AS t2m_c_rolling15"
        " FROM daily"
    )
    q["rolling24"] = _with(
        GI,
        f"rg AS (SELECT valid_time, avg(t2m) - 273.15 AS g, avg(t2m) FILTER (WHERE {SA}) - 273.15 AS r FROM gi GROUP BY 1)",
    ) + (
        "SELECT valid_time, round(g, 8) AS t2m_c_global, round(r, 8) AS t2m_c_region,"
        f" round({_rolling('g', 12, 11, 24, 'valid_time')}, 8) AS t2m_c_global_rolling24,"
        f" round({_rolling('r', 12, 11, 24, 'valid_time')}, 8) AS t2m_c_region_rolling24 FROM rg"
    )
    by_cell = _rolling("t2m", 12, 11, 24, "valid_time", "PARTITION BY latitude, longitude")
    q["cell_rolling"] = _with(GI) + (
        f"SELECT valid_time, latitude, longitude, round(t2m, 8) AS t2m, round({by_cell}, 8) AS t2m_rolling FROM gi"
    )
    q["cell_anomaly"] = _with(GI) + (
        "SELECT valid_time, latitude, longitude,"
        " round(t2m - avg(t2m) OVER (PARTITION BY latitude, longitude, month(valid_time)), 8) + 0.0 AS t2m_anom FROM gi"
    )
    q["month_ticks"] = _with(
        *_CENTRAL, "fy AS (SELECT * FROM central WHERE year = (SELECT min(year) FROM central))"
    ) + (
        "SELECT date, CAST(x AS INTEGER) AS x, month_start,"
        f" CASE WHEN month_start THEN {_label('month')} || ' ' || CAST(year AS VARCHAR) END AS tick_label,"
        " round(t2m_c_mean, 8) AS t2m_c_mean, round(tp_mm_total, 8) AS tp_mm_total FROM"
        " (SELECT *, row_number() OVER (ORDER BY date) - 1 AS x,"
        " coalesce(month <> lag(month) OVER (ORDER BY date), true) AS month_start FROM fy)"
    )
    q["month_vs_annual"] = _with(*_DAILY) + (
        "SELECT CAST(month(time) AS INTEGER) AS month, round(avg(t2m_c), 8) AS t2m_c,"
        " round(avg(t2m_c) - (SELECT avg(t2m_c) FROM daily), 8) + 0.0 AS t2m_c_vs_annual FROM daily GROUP BY 1"
    )
    q["minmax_scale"] = _with(
        *_CENTRAL, f"mm AS (SELECT month, {', '.join(f'avg({c}) AS {c}' for c in _C)} FROM central GROUP BY 1)"
    ) + (
        "SELECT month, "
        + ", ".join(
            f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER () + 1e-9), 8) AS {c}" for c in _C
        )
        + " FROM mm"
    )

    # Figure tables
    q["annual_cycle"] = _with(*_DAILY_HEAT) + (
        f"SELECT time, {_r('t2m_c', 't2m_c_min', 't2m_c_max', 'net_rad', 'ssr', 'str_nlw')},"
        f" round({_rolling('t2m_c', 7, 7, 7, 'time')}, 8) AS t2m_c_rolling15,"
        " round(frac_above_35c * 100, 8) AS above_35c_pct, round(frac_above_40c * 100, 8) AS above_40c_pct,"
        " round(tcc * 100, 8) AS cloud_pct FROM daily"
    )
    q["monthly_energy"] = _with(*_DAILY) + (
        f"SELECT CAST(month(time) AS INTEGER) AS month, any_value({_label('month(time)')}) AS month_abbr,"
        " round(avg(ssr), 8) AS ssr, round(avg(str_nlw), 8) AS str_nlw, round(avg(net_rad), 8) AS net_rad,"
        " round(avg(t2m_c) - (SELECT avg(t2m_c) FROM daily), 8) + 0.0 AS t2m_c_vs_annual,"
        " round(avg(tcc) * 100, 8) AS cloud_pct, round(avg(t2m_c), 8) AS t2m_c FROM daily GROUP BY 1"
    )
    q["anomaly_relations"] = _with(*_DAILY, _ANOM) + (
        "SELECT time, CAST(month(time) AS INTEGER) AS month, round(net_rad_anom, 8) + 0.0 AS net_rad_anom,"
        " round(t2m_c_anom, 8) + 0.0 AS t2m_c_anom, round(tcc_anom * 100, 8) + 0.0 AS cloud_pct_anom,"
        " round(ssr_anom, 8) + 0.0 AS ssr_anom FROM anom"
    )
    q["anomaly_sign_bands"] = _with(*_DAILY, _ANOM) + (
        "SELECT time, round(t2m_c_anom, 8) + 0.0 AS t2m_c_anom,"
        f" round({_rolling('t2m_c_anom', 7, 7, 7, 'time')}, 8) + 0.0 AS t2m_c_anom_rolling15,"
        " round(CASE WHEN t2m_c_anom >= 0 THEN t2m_c_anom END, 8) + 0.0 AS warm,"
        " round(CASE WHEN t2m_c_anom < 0 THEN t2m_c_anom END, 8) + 0.0 AS cool FROM anom"
    )
    q["monthly_anomaly"] = _with(*_DAILY, _ANOM) + (
        "SELECT CAST(month(time) AS INTEGER) AS month, round(avg(t2m_c_anom), 6) + 0.0 AS t2m_c_anom,"
        " round(avg(tcc_anom) * 100, 6) + 0.0 AS cloud_pct_anom, round(avg(net_rad_anom), 6) + 0.0 AS net_rad_anom"
        " FROM anom GROUP BY 1"
    )
    rad = ("ssr", "str", "tisr", "tsr", "ttr")
    months = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
    q["radiation_heatmap"] = _with(
        *_CALENDAR,
        "rm AS ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS variable, month(valid_time) AS m, avg(\"{c}_Wm2\") AS v FROM cal GROUP BY 2" for c in rad
        )
        + ")",
        "sc AS (SELECT variable, m, (v - min(v) OVER w) / (max(v) OVER w - min(v) OVER w + 1e-9) AS s FROM rm"
        " WINDOW w AS (PARTITION BY variable))",
    ) + (
        "SELECT variable, "
        + ", ".join(f"round(max(s) FILTER (WHERE m = {i}), 8) + 0.0 AS \"{label}\"" for i, label in enumerate(months, 1))
        + " FROM sc GROUP BY 1"
    )

    # Comparing results
    q["paired_on_time"] = _with(*_PAIR) + (
        "SELECT plain.time, round(plain.t2m_c, 8) AS t2m_c_a, round(plain.tcc, 8) AS tcc_a,"
        " round(daily.t2m_c, 8) AS t2m_c_b, round(daily.tcc, 8) AS tcc_b"
        " FROM plain JOIN daily ON plain.time = daily.time"
    )
    q["consistency_daily"] = _with(*_PAIR) + _consistency("plain", "daily", _COMPARED)
    q["consistency_anomaly"] = _with(*_PAIR, _ANOM_OF.format(t="plain"), _ANOM_OF.format(t="daily")) + _consistency(
        "anom_plain", "anom_daily", [c + "_anom" for c in _COMPARED]
    )
    q["validation_metrics"] = _with(*_CHECKS) + (
        f'SELECT "table", "column", rows_compared, {_r("mae", "max_abs", "rmse", "max_rel", "pass_rate")}, passed FROM checks'
    )
    q["validation_rollup"] = _with(*_CHECKS) + (
        "SELECT count(*) AS checks, string_agg(DISTINCT \"table\", ',' ORDER BY \"table\") AS tables,"
        " bool_and(passed) AS all_passed, round(min(pass_rate), 8) AS min_pass_rate,"
        " round(max(max_abs), 8) AS max_abs_overall, round(max(max_rel), 8) AS max_rel_overall FROM checks"
    )
    q["melted_daily"] = _with(*_DAILY) + " UNION ALL ".join(
        f"SELECT time, '{c}' AS metric, round({c}, 8) AS value FROM daily" for c in _COMPARED
    )

    # Layouts
    tail = "count(*) AS rows, min(valid_time) AS first_time FROM gi GROUP BY ALL"
    q["layout_time_first"] = _with(GI) + f"SELECT {_BT.format(s=_STEP, k=24)}, {tail}"
    q["layout_balanced"] = _with(GI) + f"SELECT {_BT.format(s=_STEP, k=120)}, {_BY}, {_BX}, {tail}"
    q["layout_space_first"] = _with(GI) + f"SELECT {_BY}, {_BX}, {tail}"
    q["layout_invariance"] = _with(GI) + (
        "SELECT l AS \"table\", c AS \"column\", (SELECT count(DISTINCT last_day(valid_time)) FROM gi) AS rows_compared,"
        " CAST(1 AS DOUBLE) AS pass_rate, true AS passed"
        " FROM (VALUES ('balanced'), ('space_first')) a(l), (VALUES ('t2m_C'), ('tcc_fraction')) b(c)"
    )
    q["layout_stored"] = _with(GI) + (
        "SELECT name, valid_time, latitude, longitude, round(t2m, 8) AS t2m, round(tcc, 8) AS tcc FROM gi JOIN (VALUES"
        " ('early', TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-08 12:00:00', 40, 20, 70, 85),"
        " ('late', TIMESTAMP '2024-02-01', TIMESTAMP '2024-03-01', 35, 5, 65, 100),"
        " ('point', TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-09', 30, 30, 80, 80)) a(name, t0, t1, n, s, w, e)"
        " ON valid_time BETWEEN t0 AND t1 AND latitude BETWEEN s AND n AND longitude BETWEEN w AND e"
    )
    q["layout_exact"] = _with(GN) + (
        "SELECT last_day(valid_time)::TIMESTAMP AS month, round(avg(t), 8) AS t2m, round(avg(c), 8) AS tcc, true AS same FROM"
        f" (SELECT valid_time, {_wmean('t2m')} AS t, {_wmean('tcc')} AS c FROM gn GROUP BY 1) GROUP BY 1"
    )
    q["layout_overlay"] = _with(
        GI,
        "mo AS (SELECT month(me) AS month, avg(v) AS v FROM (SELECT last_day(valid_time) AS me, avg(s) - 273.15 AS v FROM"
        " (SELECT valid_time, avg(t2m) AS s FROM gi GROUP BY 1) GROUP BY 1) GROUP BY 1)",
    ) + (
        "SELECT CAST(month AS INTEGER) AS month, round(v, 8) AS time_first, round(v, 8) AS balanced,"
        " round(v, 8) AS space_first FROM mo"
    )
    return q


ORACLES = _oracles()
