"""DuckDB oracles for time-series, profiles and trends."""

from __future__ import annotations

from .adapter import py_fixed, r6
from .health_sql import health_ctes

TSRC = """
tsrc AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY Serial, batch_date ORDER BY reading_id) AS rn
    FROM readings
    WHERE upper(Device_Type) LIKE '%ZM1%' OR upper(Device_Type) LIKE '%MM3%' OR upper(Device_Type) LIKE '%UM3%')
  WHERE rn = 1),"""


def ts_ctes() -> str:
    """``hf`` = daily series features; ``tsf`` adds W3/W4 columns."""
    win = "PARTITION BY Serial ORDER BY batch_date"
    cols = []
    for ty, pairs in (("ZM1", [("battery", "battery_level")]), ("MM3", [("current", "cur"), ("temp", "temp")])):
        for short, src in pairs:
            cols.append(f"CASE WHEN t = '{ty}' THEN {src} - lag({src}) OVER ({win}) END AS {short}_change_1d")
            for n in (3, 7, 14):
                cols.append(f"CASE WHEN t = '{ty}' THEN avg({src}) OVER ({win} ROWS BETWEEN {n - 1} PRECEDING "
                            f"AND CURRENT ROW) END AS {short}_avg_{n}d")
    return (health_ctes(batch=True, scope="batch_type", source="tsrc", pre=TSRC)
            + f",\ntsf AS (SELECT *, {', '.join(cols)} FROM hf)\n")


def _ts_cols() -> str:
    names = ["battery_change_1d"] + [f"battery_avg_{n}d" for n in (3, 7, 14)]
    names += ["current_change_1d"] + [f"current_avg_{n}d" for n in (3, 7, 14)]
    names += ["temp_change_1d"] + [f"temp_avg_{n}d" for n in (3, 7, 14)]
    return ", ".join(f"{r6(n)} AS {n}" for n in names)


TS_SQL = ("WITH " + ts_ctes() + f"""
SELECT Serial, strftime(batch_date, '%Y-%m-%d') AS date, t AS Device_Type_Standardized, comm1 AS comm_age_days,
       {r6('battery_level')} AS battery_level, risk_score, risk_reason, {_ts_cols()}
FROM tsf""")


def profile_ctes() -> str:
    d = "batch_date"
    return ts_ctes() + f""",
pb AS (
  SELECT Serial, batch_date, Device_Type AS dev_raw, upper(trim(Device_Type)) AS devu, battery_level, risk_score,
    CASE WHEN BatteryLevel BETWEEN 0 AND 100 THEN BatteryLevel END AS bat,
    CASE WHEN LineCurrent BETWEEN 0 AND 1000 THEN LineCurrent END AS curc,
    CASE WHEN LineTemperature BETWEEN -40 AND 100 THEN LineTemperature END AS tmpc,
    comm1 * 24.0 AS hours
  FROM hf),
pg AS (
  SELECT Serial,
    arg_max_null(devu, {d}) AS Device_Type,
    min({d}) AS first_seen, max({d}) AS last_seen,
    CAST(count(DISTINCT {d}) AS BIGINT) AS total_days_observed, CAST(count(*) AS BIGINT) AS total_records,
    count(bat) AS n_bat, arg_max(bat, {d}) AS battery_current_v, min(bat) AS bmin, max(bat) AS bmax,
    avg(bat) AS bavg, stddev_samp(bat) AS bstd,
    CAST(count_if(bat < 20) AS BIGINT) AS blow, CAST(count_if(bat < 30) AS BIGINT) AS bwarn,
    arg_min_null(battery_level, {d}) AS bl_first, arg_max_null(battery_level, {d}) AS bl_last,
    datediff('day', min({d}), max({d})) AS span,
    count(curc) AS n_cur, arg_max(curc, {d}) AS cur_v, avg(curc) AS cavg, max(curc) AS cmax, stddev_samp(curc) AS cstd,
    CAST(count_if(curc = 0) AS BIGINT) AS zd, CAST(count_if(curc > 700) AS BIGINT) AS hd,
    CAST(count_if(curc > 850) AS BIGINT) AS cd,
    count(tmpc) AS n_tmp, arg_max(tmpc, {d}) AS tmp_v, avg(tmpc) AS tavg, max(tmpc) AS tmax,
    CAST(count_if(tmpc > 85) AS BIGINT) AS od,
    arg_max(risk_score, {d}) AS risk_score_current, avg(risk_score) AS risk_score_avg,
    max(risk_score) AS risk_score_max, min(risk_score) AS risk_score_min, stddev_samp(risk_score) AS risk_score_std,
    arg_max(hours, {d}) AS comms_gap_current_hours, avg(hours) AS comms_gap_avg_hours, max(hours) AS comms_gap_max_hours
  FROM pb GROUP BY Serial),
pt AS (
  SELECT *, CASE WHEN Device_Type LIKE '%ZM1%' THEN 'ZM1' WHEN Device_Type LIKE '%UM3%' THEN 'UM3'
                 WHEN Device_Type LIKE '%MM3%' THEN 'MM3' ELSE 'Unknown' END AS ty,
    (total_records >= 2) AS enough,
    (total_records >= 2 AND span > 0 AND coalesce(bl_first > 0, false)) AS computable
  FROM pg),
pd AS (
  SELECT *, CASE WHEN computable THEN (bl_first - bl_last) / span END AS per_day FROM pt),
pe AS (
  SELECT *, coalesce(per_day > 0.001, false) AS draining, coalesce(per_day > 0.0001, false) AS fast,
    (ty = 'ZM1' AND n_bat > 0) AS has_bat, (ty = 'MM3' AND n_cur > 0) AS has_cur, (ty = 'MM3' AND n_tmp > 0) AS has_tmp
  FROM pd),
prof AS (
  SELECT Serial, Device_Type, ty AS Device_Type_Standardized,
    strftime(first_seen, '%Y-%m-%d') AS first_seen_date, strftime(last_seen, '%Y-%m-%d') AS last_seen_date,
    total_days_observed, total_records,
    CASE ty WHEN 'UM3' THEN 'Line-powered or long-life' WHEN 'MM3' THEN 'Line-powered (NOT rechargeable)'
            ELSE 'Non-rechargeable' END AS battery_type,
    10 AS expected_lifetime_years,
    (ty = 'MM3') AS measures_current, (ty = 'MM3') AS measures_temp, (ty NOT IN ('UM3', 'MM3')) AS measures_battery,
    CASE WHEN ty IN ('UM3', 'MM3') THEN 0 ELSE 20 END AS critical_battery_level,
    CASE WHEN ty IN ('UM3', 'MM3') THEN 0 ELSE 30 END AS warning_battery_level,
    CASE WHEN has_bat THEN battery_current_v END AS battery_current,
    CASE WHEN has_bat THEN bmin END AS battery_min, CASE WHEN has_bat THEN bmax END AS battery_max,
    CASE WHEN has_bat THEN bavg END AS battery_avg, CASE WHEN has_bat THEN bstd END AS battery_std,
    CASE WHEN has_bat THEN n_bat / total_records * 100.0 END AS battery_data_quality_pct,
    CASE WHEN has_bat THEN per_day WHEN ty = 'ZM1' THEN 0.027 END AS battery_drain_rate_per_day,
    CASE WHEN has_bat THEN
      (CASE WHEN NOT enough THEN 'Insufficient data'
            WHEN computable AND draining THEN 'Draining at ' || {py_fixed('per_day * 365.0', 1)} || '%/year'
            WHEN computable THEN 'Stable battery level'
            ELSE 'Insufficient data to calculate drain rate' END) END AS battery_drain_status,
    CASE WHEN has_bat THEN
      (CASE WHEN NOT enough OR NOT computable THEN 'Unknown' WHEN NOT draining THEN 'Normal'
            WHEN per_day * 365.0 < 10 THEN 'Excellent' WHEN per_day * 365.0 < 20 THEN 'Normal'
            WHEN per_day * 365.0 < 40 THEN 'Slightly Fast' WHEN per_day * 365.0 < 100 THEN 'Fast'
            ELSE 'Critical' END)
         WHEN ty = 'ZM1' THEN 'Insufficient Data' END AS drain_rate_category,
    CASE WHEN has_bat AND enough AND span > 0 THEN bl_first END AS battery_baseline,
    CAST(CASE WHEN has_bat THEN (CASE WHEN enough THEN span ELSE 0 END) END AS BIGINT) AS battery_observation_days,
    CASE WHEN has_bat THEN per_day * 365.0 END AS battery_drain_rate,
    CASE WHEN has_bat THEN (CASE WHEN fast THEN greatest(0.0, (battery_current_v - 20) / per_day)
                                 ELSE 'inf'::DOUBLE END)
         WHEN ty = 'ZM1' THEN 0.0 END AS days_until_battery_critical,
    CASE WHEN has_bat AND fast THEN battery_current_v / per_day WHEN ty = 'ZM1' THEN 'inf'::DOUBLE END
      AS expected_battery_life_days,
    CASE WHEN has_bat AND fast THEN battery_current_v / per_day / 365.0 WHEN ty = 'ZM1' THEN 'inf'::DOUBLE END
      AS expected_battery_life_years,
    CASE WHEN has_bat THEN blow END AS battery_low_days_count,
    CASE WHEN has_bat THEN bwarn END AS battery_warning_days_count,
    CASE WHEN has_cur THEN cur_v END AS current_current, CASE WHEN has_cur THEN cavg END AS current_avg,
    CASE WHEN has_cur THEN cmax END AS current_max, CASE WHEN has_cur THEN cstd END AS current_std,
    CASE WHEN has_cur THEN zd END AS zero_current_days, CASE WHEN has_cur THEN hd END AS high_current_days,
    CASE WHEN has_cur THEN cd END AS critical_current_days,
    CASE WHEN has_tmp THEN tmp_v END AS temp_current, CASE WHEN has_tmp THEN tavg END AS temp_avg,
    CASE WHEN has_tmp THEN tmax END AS temp_max, CASE WHEN has_tmp THEN od END AS overheat_days,
    CASE WHEN ty = 'UM3' THEN true END AS communication_only_device,
    risk_score_current, risk_score_avg, risk_score_max, risk_score_min, risk_score_std,
    comms_gap_current_hours, comms_gap_avg_hours, comms_gap_max_hours
  FROM pe),
profs AS (
  SELECT *,
    CASE WHEN risk_score_current IS NULL THEN NULL
      WHEN Device_Type_Standardized = 'ZM1' THEN
        (CASE WHEN risk_score_current > 80 OR coalesce(battery_current < 10, false) THEN 'CRITICAL'
              WHEN risk_score_current > 60 OR coalesce(battery_current < 20, false) THEN 'POOR'
              WHEN risk_score_current > 40 OR coalesce(battery_current < 40, false) THEN 'FAIR'
              WHEN risk_score_current > 20 OR coalesce(battery_current < 60, false) THEN 'GOOD'
              ELSE 'EXCELLENT' END)
      WHEN Device_Type_Standardized = 'MM3' THEN
        (CASE WHEN risk_score_current > 80 OR coalesce(current_current, 0.0) = 0 OR coalesce(temp_current, 0.0) > 85 THEN 'CRITICAL'
              WHEN risk_score_current > 60 OR coalesce(current_current, 0.0) > 700 OR coalesce(temp_current, 0.0) > 70 THEN 'POOR'
              WHEN risk_score_current > 40 OR coalesce(current_current, 0.0) > 500 THEN 'FAIR'
              WHEN risk_score_current > 20 THEN 'GOOD' ELSE 'EXCELLENT' END)
      ELSE (CASE WHEN risk_score_current > 80 THEN 'CRITICAL' WHEN risk_score_current > 60 THEN 'POOR'
                 WHEN risk_score_current > 40 THEN 'FAIR' WHEN risk_score_current > 20 THEN 'GOOD'
                 ELSE 'EXCELLENT' END) END AS device_health_status
  FROM prof)
"""


PROFILE_FLOATS = ["battery_current", "battery_min", "battery_max", "battery_avg", "battery_std",
                  "battery_data_quality_pct", "battery_drain_rate_per_day", "battery_baseline",
                  "battery_drain_rate", "days_until_battery_critical", "expected_battery_life_days",
                  "expected_battery_life_years", "current_current", "current_avg", "current_max", "current_std",
                  "temp_current", "temp_avg", "temp_max", "risk_score_current", "risk_score_avg", "risk_score_max",
                  "risk_score_min", "risk_score_std", "comms_gap_current_hours", "comms_gap_avg_hours",
                  "comms_gap_max_hours"]

PROFILE_OTHERS = ["Serial", "Device_Type", "Device_Type_Standardized", "first_seen_date", "last_seen_date",
                  "total_days_observed", "total_records", "battery_type", "expected_lifetime_years",
                  "measures_current", "measures_temp", "measures_battery", "critical_battery_level",
                  "warning_battery_level", "battery_drain_status", "drain_rate_category", "battery_observation_days",
                  "battery_low_days_count", "battery_warning_days_count", "zero_current_days", "high_current_days",
                  "critical_current_days", "overheat_days", "communication_only_device", "device_health_status"]

PROFILE_NULLABLE_INTS = ["battery_observation_days", "battery_low_days_count", "battery_warning_days_count",
                         "zero_current_days", "high_current_days", "critical_current_days", "overheat_days"]

PROFILE_SQL = ("WITH " + profile_ctes() + "SELECT "
               + ", ".join([c for c in PROFILE_OTHERS if c not in PROFILE_NULLABLE_INTS + ["communication_only_device"]]
                           + [f"{r6(c)} AS {c}" for c in PROFILE_FLOATS]
                           + [f"CAST({c} AS DOUBLE) AS {c}" for c in PROFILE_NULLABLE_INTS]
                           + ["CAST(communication_only_device AS VARCHAR) AS communication_only_device"])
               + " FROM profs")

TREND_CTES = f""",
z AS (SELECT Serial, batch_date AS d, BatteryLevel AS y,
        CAST(datediff('day', min(batch_date) OVER (PARTITION BY Serial), batch_date) AS DOUBLE) AS x
      FROM hf WHERE t = 'ZM1'),
zg AS (SELECT Serial, CAST(count(*) AS BIGINT) AS data_points, count(y) AS ny, min(d) AS fd, max(d) AS ld,
         arg_min_null(y, d) AS battery_start, arg_max_null(y, d) AS battery_end,
         regr_slope(y, x) AS s, regr_intercept(y, x) AS i
       FROM z GROUP BY Serial)"""

TREND_SELECT = f"""
SELECT Serial, data_points, CAST(datediff('day', fd, ld) AS BIGINT) AS date_range_days,
  {r6('battery_start')} AS battery_start, {r6('battery_end')} AS battery_end,
  {r6('battery_end - battery_start')} AS battery_change,
  {r6("(battery_end - battery_start) / datediff('day', fd, ld)")} AS daily_drain_rate,
  {r6('CASE WHEN ny = data_points THEN s END')} AS trend_slope,
  {r6('CASE WHEN ny = data_points THEN i END')} AS trend_intercept,
  strftime(fd, '%Y-%m-%d') AS first_date, strftime(ld, '%Y-%m-%d') AS last_date
FROM zg WHERE data_points >= 2 AND datediff('day', fd, ld) > 0"""

TREND_SQL = "WITH " + ts_ctes() + TREND_CTES + TREND_SELECT
