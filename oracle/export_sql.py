"""DuckDB oracles for export categories, summary and alerts."""

from __future__ import annotations

from voltwatch.functions.categories import (AGE_BINS, AGE_LABELS, BATTERY_BINS, BATTERY_LABELS, DRAIN_BINS,
                                            DRAIN_LABELS, RISK_BINS, RISK_LABELS)

from .adapter import CTES, cut, py_fixed, r6
from .health_sql import health_ctes
from .labels_sql import PREDICT_PREFIXED
from .timeseries_sql import profile_ctes

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

EXPORT_CTES = profile_ctes() + f""",
ex AS (
  SELECT *,
    CASE WHEN coalesce(battery_current < 10, false) THEN 'CRITICAL' WHEN coalesce(battery_current < 20, false) THEN 'Warning'
         WHEN coalesce(battery_current < 30, false) THEN 'Low' WHEN coalesce(battery_current < 50, false) THEN 'Moderate'
         ELSE 'Good' END AS battery_status,
    {cut('coalesce(battery_current, 0.0)', BATTERY_BINS, BATTERY_LABELS)} AS battery_level_category,
    CASE WHEN coalesce(days_until_battery_critical < 7, false) THEN 'EMERGENCY (<1 week)'
         WHEN coalesce(days_until_battery_critical < 30, false) THEN 'Critical (<1 month)'
         WHEN coalesce(days_until_battery_critical < 90, false) THEN 'Urgent (1-3 months)'
         WHEN coalesce(days_until_battery_critical < 180, false) THEN 'Soon (3-6 months)'
         WHEN coalesce(days_until_battery_critical < 365, false) THEN 'Near (6-12 months)'
         ELSE 'Future (>1 year)' END AS replacement_timeline,
    coalesce(days_until_battery_critical < 30, false) AS needs_replacement_30d,
    coalesce(days_until_battery_critical < 90, false) AS needs_replacement_90d,
    coalesce(days_until_battery_critical < 365, false) AS needs_replacement_1yr,
    {cut('coalesce(risk_score_current, 0.0)', RISK_BINS, RISK_LABELS)} AS risk_category,
    coalesce(risk_score_current > 60, false) AS is_high_risk,
    coalesce(risk_score_current > 80, false) AS is_critical_risk,
    total_days_observed / 365.0 AS device_age_years,
    {cut('coalesce(total_days_observed / 365.0, 0.0)', AGE_BINS, AGE_LABELS)} AS age_category,
    {cut('coalesce(battery_drain_rate, 0.0)', DRAIN_BINS, DRAIN_LABELS)} AS export_drain_category,
    coalesce(battery_drain_rate <= 15.0, false) AS is_normal_drain,
    coalesce(battery_drain_rate > 15.0, false) AS is_fast_drain,
    (coalesce(battery_current < 20, false) OR coalesce(days_until_battery_critical < 30, false)
     OR coalesce(risk_score_current > 80, false)) AS is_critical_device,
    CASE WHEN days_until_battery_critical > 0 THEN
      make_timestamp(epoch_us({AS_OF}) + CAST(least(days_until_battery_critical, 3650.0) * 86400000000.0 AS BIGINT))
    END AS rts
  FROM profs),
kpi AS (
  SELECT CAST(count(*) AS BIGINT) AS total_devices, avg(battery_current) AS global_avg_battery,
    CAST(count_if(battery_current < 20) AS BIGINT) AS global_devices_below_20,
    CAST(count_if(battery_current < 30) AS BIGINT) AS global_devices_below_30,
    CAST(count_if(days_until_battery_critical < 7) AS BIGINT) AS global_emergency_7d,
    CAST(count_if(days_until_battery_critical < 30) AS BIGINT) AS global_critical_30d,
    CAST(count_if(days_until_battery_critical < 90) AS BIGINT) AS global_urgent_90d
  FROM ex)
"""

EXPORT_SQL = "WITH " + EXPORT_CTES + f"""
SELECT Serial, battery_status, battery_level_category, replacement_timeline, needs_replacement_30d,
  needs_replacement_90d, needs_replacement_1yr, risk_category, is_high_risk, is_critical_risk,
  {r6('device_age_years')} AS device_age_years, age_category, export_drain_category AS drain_rate_category,
  is_normal_drain, is_fast_drain, is_critical_device,
  strftime(rts, '%Y-%m-%d') AS estimated_replacement_date,
  CASE WHEN rts IS NOT NULL THEN 'Q' || quarter(rts) || '-' || year(rts) END AS replacement_quarter,
  CAST(year(rts) AS DOUBLE) AS replacement_year, strftime(rts, '%Y-%m') AS replacement_month,
  total_devices, {r6('global_avg_battery')} AS global_avg_battery, global_devices_below_20, global_devices_below_30,
  global_emergency_7d, global_critical_30d, global_urgent_90d
FROM ex CROSS JOIN kpi"""

SUMMARY_SQL = "WITH " + EXPORT_CTES + f"""
SELECT CAST(count(*) AS BIGINT) AS devices, {r6('avg(battery_current)')} AS battery_avg,
  CAST(count_if(battery_current < 20) AS BIGINT) AS battery_critical,
  CAST(count_if(battery_current >= 20 AND battery_current < 30) AS BIGINT) AS battery_low,
  CAST(count_if(days_until_battery_critical < 7) AS BIGINT) AS emergency_7d,
  CAST(count_if(days_until_battery_critical < 30) AS BIGINT) AS critical_30d,
  CAST(count_if(days_until_battery_critical < 90) AS BIGINT) AS urgent_90d,
  CAST(count_if(days_until_battery_critical < 365) AS BIGINT) AS this_year,
  CAST(count_if(is_critical_device) AS BIGINT) AS critical_devices
FROM ex"""

ALERT_SQL = "WITH " + health_ctes(batch=False) + f"""
SELECT reading_id, Serial, risk_score,
  CASE WHEN risk_score >= 80 THEN 'Critical' WHEN risk_score >= 50 THEN 'High' WHEN risk_score >= 20 THEN 'Medium'
       WHEN risk_score > 0 THEN 'Low' WHEN risk_score = 0 THEN 'OK' END AS alert_level,
  CASE WHEN risk_score >= 80 THEN 'Immediate field inspection' WHEN risk_score >= 50 THEN 'Investigate soon'
       WHEN risk_score >= 20 THEN 'Monitoring needed' WHEN risk_score > 0 THEN 'Normal'
       WHEN risk_score = 0 THEN 'Healthy' END AS alert_description,
  coalesce(risk_score >= 50, false) AS needs_inspection,
  'Device ' || CAST(Serial AS VARCHAR) || ': ' ||
    (CASE WHEN risk_score >= 80 THEN 'Critical' WHEN risk_score >= 50 THEN 'High' WHEN risk_score >= 20 THEN 'Medium'
          WHEN risk_score > 0 THEN 'Low' WHEN risk_score = 0 THEN 'OK' END)
    || ' Risk (' || {py_fixed('risk_score', 1)} || ') — ' || risk_reason AS alert_message,
  CASE WHEN risk_score >= 80 THEN 'red' WHEN risk_score >= 50 THEN 'orange' WHEN risk_score >= 20 THEN 'yellow'
       WHEN risk_score >= 0 THEN 'green' END AS powerbi_severity_color
FROM hf"""

J5_SQL = "WITH " + profile_ctes() + PREDICT_PREFIXED + f"""
SELECT f.Serial, f.Device_Type_Standardized, {r6('f.risk_score_current')} AS risk_score_current,
  {r6('f.battery_current')} AS battery_current,
  coalesce(p.PredictedActionName, 'NO_ACTION') AS PredictedAction,
  coalesce(CASE p.PredictedActionName WHEN 'NO_ACTION' THEN 0 WHEN 'RECONFIGURE' THEN 1 WHEN 'REPLACE' THEN 2 END, 0)
    AS PredictedActionLabel,
  '2024-01-31' AS PredictionDate,
  CAST(p.coord_missing_flag AS DOUBLE) AS coord_missing_flag, CAST(p.battery_low_flag AS DOUBLE) AS battery_low_flag,
  CAST(p.offline_flag AS DOUBLE) AS offline_flag, CAST(p.days_since_last_report AS DOUBLE) AS days_since_last_report,
  '2024-01-31' AS export_date, 'voltwatch' AS data_source
FROM profs f LEFT JOIN pr_p p ON p.Serial = f.Serial"""

_BASE = (f"readings AS ({CTES['readings']}),\ninstall AS ({CTES['install']}),\n"
         f"attempts AS ({CTES['attempts']})")
TTL_SQL = "WITH " + _BASE + PREDICT_PREFIXED + f"""
SELECT Serial, device_type,
  {r6("CASE WHEN device_type = 'ZM1' AND BatteryLevel IS NOT NULL THEN BatteryLevel / 0.027 END")} AS ttl_days,
  {r6("CASE WHEN device_type = 'ZM1' AND BatteryLevel IS NOT NULL THEN BatteryLevel / 0.027 / 30.44 END")} AS ttl_months,
  {r6("CASE WHEN device_type = 'ZM1' AND BatteryLevel IS NOT NULL THEN BatteryLevel / 0.027 / 365.0 END")} AS ttl_years,
  CASE WHEN NOT (device_type = 'ZM1' AND BatteryLevel IS NOT NULL) THEN 'Unknown'
       WHEN BatteryLevel / 0.027 < 30 THEN 'Critical (<1 month)' WHEN BatteryLevel / 0.027 < 90 THEN 'Urgent (1-3 months)'
       WHEN BatteryLevel / 0.027 < 180 THEN 'Soon (3-6 months)' WHEN BatteryLevel / 0.027 < 365 THEN 'Near (6-12 months)'
       ELSE 'Future (>1 year)' END AS ttl_category
FROM pr_l"""
