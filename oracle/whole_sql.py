"""DuckDB oracles for the whole export, the processing log and single operators."""

from __future__ import annotations

from voltwatch.functions.categories import AGE_BINS, AGE_LABELS

from .adapter import CTES, cut, flag, np_round, r6
from .export_sql import AS_OF, EXPORT_CTES
from .labels_sql import LABEL_CTES, PREDICT_PREFIXED, whole_days
from .timeseries_sql import TREND_CTES, TREND_SELECT, profile_ctes, ts_ctes

SQL = {}

WHOLE = "WITH " + EXPORT_CTES + PREDICT_PREFIXED + f""",
xdc AS (SELECT *, CASE reading_id % 3 WHEN 0 THEN 'NO_ACTION' WHEN 1 THEN 'RECONFIGURE' ELSE 'REPLACE' END AS declared,
    CASE WHEN reading_id % 11 <> 0 THEN (900 + reading_id * (CASE device_type WHEN 'MM3' THEN 37 ELSE 53 END) % 100) / 1000
         ELSE 0.0 END AS conf FROM pr_d),
xgt AS (SELECT *, CASE WHEN pct_life_used > 90.0 THEN 'REPLACE' WHEN conf < 0.95 THEN rule_name ELSE declared END AS action
  FROM xdc),
rsn AS (SELECT Serial, arg_max(risk_reason, batch_date) AS risk_reason FROM hf GROUP BY Serial),
xj AS (SELECT ex.*, kpi.*, g.action, g.conf, g.device_age_days, g.BatteryLevel, g.days_since_last_report,
    g.coord_missing_flag, g.battery_low_flag, g.offline_flag, rsn.risk_reason,
    (ex.Device_Type_Standardized = 'ZM1' AND g.BatteryLevel IS NOT NULL) AS has_ttl,
    {np_round('g.device_age_days / 365.0', 1)} AS install_years,
    bool_or(ex.Device_Type_Standardized = 'ZM1' AND ex.battery_drain_rate_per_day IS NOT NULL) OVER () AS any_drain
  FROM ex CROSS JOIN kpi LEFT JOIN xgt g ON g.Serial = ex.Serial LEFT JOIN rsn ON rsn.Serial = ex.Serial),
xr AS (SELECT *, CASE WHEN any_drain THEN battery_drain_rate_per_day ELSE 0.027 END AS drain FROM xj),
xt AS (SELECT *, CASE WHEN has_ttl THEN BatteryLevel / (CASE WHEN drain < 0.001 THEN 0.001 ELSE drain END) END AS ttl_days FROM xr),
whole AS (SELECT *, CASE WHEN NOT coalesce(has_ttl, false) THEN 'Unknown' WHEN ttl_days < 30 THEN 'Critical (<1 month)'
       WHEN ttl_days < 90 THEN 'Urgent (1-3 months)' WHEN ttl_days < 180 THEN 'Soon (3-6 months)'
       WHEN ttl_days < 365 THEN 'Near (6-12 months)' ELSE 'Future (>1 year)' END AS ttl_category,
    coalesce(action, 'NO_ACTION') AS PredictedAction FROM xt)
"""

_kpis = ("total_devices, global_devices_below_20, global_devices_below_30, global_emergency_7d, global_critical_30d, "
         "global_urgent_90d")
SQL["c5_whole_export"] = WHOLE + f"""
SELECT Serial, Device_Type_Standardized, battery_status, battery_level_category, replacement_timeline, needs_replacement_30d,
  risk_category, is_high_risk, is_critical_risk, export_drain_category AS drain_rate_category, is_fast_drain, is_critical_device,
  strftime(rts, '%Y-%m-%d') AS estimated_replacement_date,
  CASE WHEN rts IS NOT NULL THEN 'Q' || quarter(rts) || '-' || year(rts) END AS replacement_quarter,
  {cut('coalesce(install_years, 0.0)', AGE_BINS, AGE_LABELS)} AS age_category, ttl_category, risk_reason, PredictedAction,
  CASE PredictedAction WHEN 'NO_ACTION' THEN 0 WHEN 'RECONFIGURE' THEN 1 ELSE 2 END AS PredictedActionLabel,
  'voltwatch' AS data_source, '2024-01-31' AS PredictionDate, '2024-01-31' AS export_date,
  {r6('install_years')} AS device_age_years, {r6('device_age_days')} AS device_age_days, {r6('BatteryLevel')} AS BatteryLevel,
  {r6('ttl_days')} AS ttl_days, {r6('ttl_days / 30.44')} AS ttl_months, {r6('ttl_days / 365.0')} AS ttl_years,
  {r6('risk_score_current')} AS risk_score, {r6('coalesce(conf, 0.0)')} AS PredictionConfidence,
  {r6('global_avg_battery')} AS global_avg_battery, CAST(days_since_last_report AS DOUBLE) AS days_since_last_report,
  CAST(coord_missing_flag AS DOUBLE) AS coord_missing_flag, CAST(battery_low_flag AS DOUBLE) AS battery_low_flag,
  CAST(offline_flag AS DOUBLE) AS offline_flag, {_kpis}
FROM whole"""


def _count(section, item, cond):
    return f"SELECT '{section}' AS section, '{item}' AS item, CAST(count_if({cond}) AS BIGINT) AS devices, CAST(NULL AS DOUBLE) AS value FROM whole"


def _mean(section, item, x):
    return f"SELECT '{section}' AS section, '{item}' AS item, CAST(count({x}) AS BIGINT) AS devices, {r6(f'avg({x})')} AS value FROM whole"


def _share(section, key):
    return (f"SELECT '{section}' AS section, {key} AS item, CAST(count(*) AS BIGINT) AS devices, "
            f"{r6('count(*) / (SELECT count(*) FROM whole) * 100.0')} AS value FROM whole GROUP BY {key}")


SQL["a26_export_totals"] = WHOLE + "\nUNION ALL\n".join([
    _mean("battery", "average", "battery_current"), _count("battery", "critical_below_20", "battery_current < 20"),
    _count("battery", "low_20_to_30", "battery_current >= 20 AND battery_current < 30"),
    _count("replacement", "emergency_7d", "days_until_battery_critical < 7"),
    _count("replacement", "critical_30d", "days_until_battery_critical < 30"),
    _count("replacement", "urgent_90d", "days_until_battery_critical < 90"),
    _count("replacement", "this_year", "days_until_battery_critical < 365"),
    _mean("ttl", "average_days", "ttl_days"), _count("ttl", "critical_30d", "ttl_days < 30"),
    _count("ttl", "urgent_30_to_90d", "ttl_days >= 30 AND ttl_days < 90"),
    _mean("age", "average_days", "device_age_days"), _count("age", "new_below_1y", "device_age_days < 365"),
    _count("age", "old_above_5y", "device_age_days > 1825"), _count("critical", "devices", "is_critical_device"),
    _share("prediction", "PredictedAction"), _share("type", "Device_Type_Standardized")])

SQL["j4_profiles_with_trend"] = "WITH " + profile_ctes() + TREND_CTES + f""",
tr AS ({TREND_SELECT})
SELECT p.Serial, p.Device_Type_Standardized, CAST(tr.data_points AS DOUBLE) AS data_points, {r6('p.battery_current')} AS battery_current,
  tr.battery_start, tr.battery_change, tr.trend_slope
FROM profs p LEFT JOIN tr ON tr.Serial = p.Serial"""

_FILED = "WITH " + ts_ctes() + """,
fd AS (SELECT *, strftime(batch_date, '%Y-%m-%d') || '-' || (Serial % 4) || '.csv' AS file FROM hf)
"""
SQL["a24_processing_log"] = _FILED + """
SELECT file, strftime(batch_date, '%Y-%m-%d') AS date, t AS device_type, CAST(count(*) AS BIGINT) AS rows_processed,
  CAST(count(DISTINCT Serial) AS BIGINT) AS unique_devices FROM fd GROUP BY file, batch_date, t"""
SQL["a24_processed_by_type"] = _FILED + """
SELECT t AS device_type, CAST(count(DISTINCT file) AS BIGINT) AS files_processed, CAST(count(*) AS BIGINT) AS rows_processed,
  CAST(count(DISTINCT Serial) AS BIGINT) AS unique_devices, CAST(count(DISTINCT batch_date) AS BIGINT) AS days_processed,
  strftime(min(batch_date), '%Y-%m-%d') AS first_date, strftime(max(batch_date), '%Y-%m-%d') AS last_date FROM fd GROUP BY t"""

SQL["a7_comm_gaps"] = "WITH " + ts_ctes() + f""",
gh AS (SELECT Serial, batch_date, CASE WHEN reading_id % 13 <> 0 THEN
    (epoch_us(CAST(batch_date + INTERVAL 1 DAY AS TIMESTAMP)) - epoch_us(Last_Heard)) / 3600000000.0 END AS h FROM hf)
SELECT Serial, {r6('arg_max(h, batch_date)')} AS comms_gap_current_hours, {r6('avg(h)')} AS comms_gap_avg_hours,
  {r6('max(h)')} AS comms_gap_max_hours FROM gh GROUP BY Serial"""

SQL["p17_status_failure"] = f"""WITH readings AS ({CTES['readings']})
SELECT reading_id, {flag("Status = 'OFFLINE'")} AS status_failure,
  CASE WHEN Status = 'OFFLINE' THEN 'offline_status' ELSE 'active' END AS status_cause FROM readings"""

SQL["w7_three_causes"] = "WITH " + ts_ctes() + """,
fl AS (SELECT *, list(struct_pack(d := batch_date, c := CASE WHEN reading_id % 200 > 168 THEN 'communication'
          WHEN battery_level < 10 THEN 'battery' WHEN temp > 85 THEN 'overheating' END))
        OVER (PARTITION BY Serial ORDER BY batch_date ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING) AS nxt FROM hf),
fh AS (SELECT *, list_filter(nxt, lambda s: s.c IS NOT NULL AND datediff('day', batch_date, s.d) <= 7) AS hits FROM fl)
SELECT Serial, strftime(batch_date, '%Y-%m-%d') AS date, CASE WHEN len(hits) > 0 THEN 1 ELSE 0 END AS failure_next_7d,
  coalesce(hits[1].c, 'none') AS failure_cause FROM fh"""

_UM3 = """    WHEN device_type_display = 'UM3+' THEN (CASE
      WHEN reconfigure_count >= 1 AND coord_missing_flag = 1 THEN 'RECONFIGURE'
      WHEN reconfigure_count >= 1 AND (comm_age_days > 90 OR offline_flag = 1) THEN 'REPLACE'
      WHEN reconfigure_count = 1 AND (comm_age_days > 30 OR intermittent_flag = 1) THEN 'RECONFIGURE'
      WHEN reconfigure_count = 0 AND ((comm_age_days > 7 AND comm_age_days <= 90) OR intermittent_flag = 1
           OR coord_missing_flag = 1 OR offline_flag = 1) THEN 'RECONFIGURE'
      ELSE 'NO_ACTION' END)
    ELSE 'NO_ACTION' END AS action_name"""
_LABELS = (LABEL_CTES.replace("IN ('MM3', 'ZM1')", "IN ('MM3', 'ZM1', 'UM3+')").replace("BatteryLevel < 20", "BatteryLevel < 35")
           .replace("<= 1.0", "<= 50.0").replace("    ELSE 'NO_ACTION' END AS action_name", _UM3))
SQL["d10_um3_actions"] = "WITH " + _LABELS + """
SELECT reading_id, Serial, device_type_display, battery_low_flag, zero_current_flag, action_name,
  CASE action_name WHEN 'NO_ACTION' THEN 0 WHEN 'RECONFIGURE' THEN 1 ELSE 2 END AS action_label
FROM lab"""

SQL["p26_ml_inputs"] = f"""WITH readings AS ({CTES['readings']}), install AS ({CTES['install']}),
i AS (SELECT Serial, max(InstallDate) AS d FROM install GROUP BY Serial),
m AS (SELECT reading_id, CAST({whole_days(AS_OF, 'd')} AS DOUBLE) AS age, (epoch_us({AS_OF}) - epoch_us(Last_Heard)) / 3600000000.0 AS hours,
    CASE WHEN reading_id % 7 > 1 THEN LineCurrent END AS cur FROM readings r LEFT JOIN i ON i.Serial = r.Serial)
SELECT reading_id, {r6('age / 30.44')} AS device_age_months, {r6('hours / 24.0')} AS comm_age_days, {r6('cur')} AS current_finite,
  {r6('coalesce(cur, 0.0)')} AS current_ml, 0 AS gps_jump_flag, CAST(0.0 AS DOUBLE) AS drift, CAST(NULL AS VARCHAR) AS note,
  false AS checked FROM m"""

SQL["p23_placeholders"] = "SELECT event_id AS reading_id, " + ", ".join(
    f"CAST(0.0 AS DOUBLE) AS {c}" for c in ("current_variance", "temp_variance", "zero_current_frequency", "overheat_frequency",
                                            "comm_fail_frequency", "gps_jump_frequency")) + " FROM events"
