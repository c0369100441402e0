"""DuckDB oracles for labels and rule predictions."""

from __future__ import annotations

from .adapter import CTES, days_between, flag, np_round, r6

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


def type_a(x: str) -> str:
    s = f"upper(trim({x}))"
    s2 = f"replace(replace(replace(replace({s}, ' ', ''), '-', ''), '_', ''), '/', '')"
    return (f"(CASE WHEN {s} IS NULL OR {s} IN ('', 'NONE', 'NAN', 'NULL') THEN NULL "
            f"WHEN {s} = 'M3' THEN 'MM3' WHEN {s} = 'UM3' THEN 'UM3+' "
            f"WHEN {s2} LIKE '%ZM1%' THEN 'ZM1' WHEN {s2} LIKE '%MM3%' OR {s2} = 'M3' THEN 'MM3' "
            f"WHEN {s2} LIKE '%UM3%' THEN 'UM3+' ELSE {s} END)")


def whole_days(later: str, earlier: str) -> str:
    return f"floor({days_between(later, earlier)})"


BASE = f"""
readings AS ({CTES['readings']}),
install AS ({CTES['install']}),
attempts AS ({CTES['attempts']}),
inst AS (SELECT Serial, max(InstallDate) AS InstallDate FROM install GROUP BY Serial),
rcnt AS (SELECT Serial, CAST(count(*) AS INTEGER) AS reconfigure_count FROM attempts GROUP BY Serial)"""

LABEL_CTES = BASE + f""",
h AS (SELECT r.*, i.InstallDate, coalesce(rc.reconfigure_count, 0) AS reconfigure_count
      FROM readings r LEFT JOIN inst i ON i.Serial = r.Serial LEFT JOIN rcnt rc ON rc.Serial = r.Serial),
ta AS (SELECT *, {type_a('Device_Type')} AS device_type_display FROM h),
f0 AS (SELECT *, max(BatteryLatestReport) OVER () AS mx FROM ta WHERE device_type_display IN ('MM3', 'ZM1')),
f1 AS (
  SELECT *, BatteryLatestReport IS NULL AS timestamp_missing, coalesce(BatteryLatestReport, mx) AS tsf,
    {flag('LineTemperature > 85')} AS overheat_flag, {flag('BatteryLevel < 20')} AS battery_low_flag,
    {flag("upper(trim(Status)) = 'OFFLINE'")} AS offline_flag, {flag("upper(trim(Status)) = 'ONLINE'")} AS online_flag,
    {flag("upper(trim(Status)) = 'INTERMITTENT'")} AS intermittent_flag,
    {flag("upper(trim(Status)) = 'STANDBY'")} AS standby_flag,
    {flag('abs(coalesce(LineCurrent, 0.0)) <= 1.0')} AS zero_current_flag,
    {flag('Latitude IS NULL OR Latitude = 0 OR Longitude IS NULL OR Longitude = 0')} AS coord_missing_flag
  FROM f0),
f2 AS (
  SELECT *, lag(Latitude) OVER w AS prev_lat, lag(Longitude) OVER w AS prev_lon
  FROM f1 WINDOW w AS (PARTITION BY Serial ORDER BY tsf, reading_id)),
f3 AS (
  SELECT *,
    {flag('(prev_lat IS NOT NULL AND Latitude IS NOT NULL AND abs(Latitude - prev_lat) > 0.001) OR '
          '(prev_lon IS NOT NULL AND Longitude IS NOT NULL AND abs(Longitude - prev_lon) > 0.001)')} AS coord_changed_flag,
    CAST(CASE WHEN {whole_days('mx', 'InstallDate')} < 0 THEN 0 ELSE {whole_days('mx', 'InstallDate')} END AS BIGINT)
      AS device_age_days,
    CAST(coalesce(greatest({whole_days(AS_OF, 'coalesce(BatteryLatestReport, Last_Heard)')}, 0), 0) AS BIGINT)
      AS comm_age_days
  FROM f2),
f4 AS (SELECT *, {np_round('device_age_days / 3650.0 * 100.0', 1)} AS pct_life_used, BatteryLevel IS NULL AS blm
       FROM f3),
lab AS (
  SELECT *, CASE
    WHEN device_type_display = 'ZM1' THEN (CASE
      WHEN reconfigure_count >= 1 AND comm_age_days > 90 THEN 'REPLACE'
      WHEN coalesce(pct_life_used, 0.0) > 90.0 THEN 'REPLACE'
      WHEN reconfigure_count >= 1 AND battery_low_flag = 1 THEN 'REPLACE'
      WHEN reconfigure_count >= 1 AND coord_missing_flag = 1 THEN 'RECONFIGURE'
      WHEN reconfigure_count = 1 AND (coord_missing_flag = 1 OR blm OR comm_age_days > 30) THEN 'RECONFIGURE'
      WHEN reconfigure_count = 0 AND (coord_missing_flag = 1 OR blm OR (comm_age_days > 14 AND comm_age_days <= 90))
        THEN 'RECONFIGURE'
      ELSE 'NO_ACTION' END)
    WHEN device_type_display = 'MM3' THEN (CASE
      WHEN (reconfigure_count >= 1 AND coord_missing_flag = 1) OR coord_changed_flag = 1
           OR (coord_missing_flag = 1 AND reconfigure_count = 0 AND comm_age_days > 14) THEN 'RECONFIGURE'
      WHEN reconfigure_count >= 1 AND (overheat_flag = 1 OR zero_current_flag = 1 OR comm_age_days > 90) THEN 'REPLACE'
      WHEN reconfigure_count = 1 AND (overheat_flag = 1 OR zero_current_flag = 1 OR comm_age_days > 30) THEN 'RECONFIGURE'
      WHEN reconfigure_count = 0 AND (overheat_flag = 1 OR zero_current_flag = 1 OR intermittent_flag = 1
           OR (comm_age_days > 7 AND comm_age_days <= 90) OR coord_missing_flag = 1) THEN 'RECONFIGURE'
      ELSE 'NO_ACTION' END)
    ELSE 'NO_ACTION' END AS action_name
  FROM f4)"""

LABEL_SQL = "WITH " + LABEL_CTES + """
SELECT reading_id, Serial, device_type_display, comm_age_days, pct_life_used,
  CAST(device_age_days AS DOUBLE) AS device_age_days, reconfigure_count,
  battery_low_flag, zero_current_flag, overheat_flag, intermittent_flag, offline_flag, coord_missing_flag,
  coord_changed_flag, timestamp_missing, action_name,
  CASE action_name WHEN 'NO_ACTION' THEN 0 WHEN 'RECONFIGURE' THEN 1 ELSE 2 END AS action_label
FROM lab"""


PREDICT_CTES = BASE + f""",
h AS (SELECT r.*, coalesce(rc.reconfigure_count, 0) AS reconfigure_count
      FROM readings r LEFT JOIN rcnt rc ON rc.Serial = r.Serial),
t AS (SELECT * EXCLUDE (Device_Type), {type_a('Device_Type')} AS device_type FROM h),
l AS (SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY Serial ORDER BY (BatteryLatestReport IS NULL) DESC,
               BatteryLatestReport DESC, reading_id DESC) AS rn
        FROM t WHERE device_type IS NOT NULL) WHERE rn = 1),
i2 AS (SELECT Serial, max(InstallDate) AS InstallDate FROM install WHERE InstallDate IS NOT NULL GROUP BY Serial),
a AS (
  SELECT l.*, i2.InstallDate AS inst_dt,
    CAST(coalesce(greatest({whole_days(AS_OF, 'i2.InstallDate')}, 0), 0) AS DOUBLE) AS device_age_days
  FROM l LEFT JOIN i2 ON i2.Serial = l.Serial WHERE device_type IN ('MM3', 'ZM1')),
b AS (
  SELECT *, coalesce({np_round('device_age_days / 3650.0 * 100.0', 1)}, 0.0) AS pct_life_used,
    CAST(coalesce(greatest({whole_days(AS_OF, 'coalesce(BatteryLatestReport, Last_Heard)')}, 0), 0) AS BIGINT)
      AS days_since_last_report,
    {flag('Latitude IS NULL OR Latitude = 0 OR Longitude IS NULL OR Longitude = 0')} AS coord_missing_flag,
    {flag('BatteryLevel < 20')} AS battery_low_flag,
    {flag("upper(trim(Status)) = 'OFFLINE'")} AS offline_flag,
    {flag("upper(trim(Status)) = 'INTERMITTENT'")} AS intermittent_flag
  FROM a),
c AS (
  SELECT *, (reconfigure_count >= 1 OR days_since_last_report > 90) AS act FROM b),
d AS (
  SELECT *, CASE
    WHEN device_type = 'MM3' AND act AND (days_since_last_report > 90 OR pct_life_used > 90.0) THEN 'REPLACE'
    WHEN device_type = 'ZM1' AND act AND (battery_low_flag = 1 OR days_since_last_report > 90) THEN 'REPLACE'
    WHEN device_type = 'MM3' AND act AND coord_missing_flag = 1 THEN 'RECONFIGURE'
    WHEN device_type = 'ZM1' AND coord_missing_flag = 1 AND days_since_last_report > 14 THEN 'RECONFIGURE'
    WHEN device_type = 'MM3' AND (intermittent_flag = 1 OR coord_missing_flag = 1
         OR (days_since_last_report > 7 AND days_since_last_report <= 90)) THEN 'RECONFIGURE'
    WHEN device_type = 'ZM1' AND (coord_missing_flag = 1 OR (days_since_last_report > 14 AND days_since_last_report <= 90))
         THEN 'RECONFIGURE'
    ELSE 'NO_ACTION' END AS rule_name
  FROM c),
p AS (
  SELECT *, CASE WHEN pct_life_used > 90.0 THEN 'REPLACE' ELSE rule_name END AS PredictedActionName,
    pct_life_used > 90.0 AS AgeOverride
  FROM d)"""

PREDICT_PREFIXED = """,
pr_rcnt AS (SELECT Serial, CAST(count(*) AS INTEGER) AS reconfigure_count FROM attempts GROUP BY Serial),""" + f"""
pr_h AS (SELECT r.*, coalesce(rc.reconfigure_count, 0) AS reconfigure_count
      FROM readings r LEFT JOIN pr_rcnt rc ON rc.Serial = r.Serial),
pr_t AS (SELECT * EXCLUDE (Device_Type), {type_a('Device_Type')} AS device_type FROM pr_h),
pr_l AS (SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY Serial ORDER BY (BatteryLatestReport IS NULL) DESC,
               BatteryLatestReport DESC, reading_id DESC) AS rn
        FROM pr_t WHERE device_type IS NOT NULL) WHERE rn = 1),
pr_i2 AS (SELECT Serial, max(InstallDate) AS InstallDate FROM install WHERE InstallDate IS NOT NULL GROUP BY Serial),
pr_a AS (
  SELECT pr_l.*, pr_i2.InstallDate AS inst_dt,
    CAST(coalesce(greatest({whole_days(AS_OF, 'pr_i2.InstallDate')}, 0), 0) AS DOUBLE) AS device_age_days
  FROM pr_l LEFT JOIN pr_i2 ON pr_i2.Serial = pr_l.Serial WHERE device_type IN ('MM3', 'ZM1')),
pr_b AS (
  SELECT *, coalesce({np_round('device_age_days / 3650.0 * 100.0', 1)}, 0.0) AS pct_life_used,
    CAST(coalesce(greatest({whole_days(AS_OF, 'coalesce(BatteryLatestReport, Last_Heard)')}, 0), 0) AS BIGINT)
      AS days_since_last_report,
    {flag('Latitude IS NULL OR Latitude = 0 OR Longitude IS NULL OR Longitude = 0')} AS coord_missing_flag,
    {flag('BatteryLevel < 20')} AS battery_low_flag,
    {flag("upper(trim(Status)) = 'OFFLINE'")} AS offline_flag,
    {flag("upper(trim(Status)) = 'INTERMITTENT'")} AS intermittent_flag
  FROM pr_a),
pr_c AS (
  SELECT *, (reconfigure_count >= 1 OR days_since_last_report > 90) AS act FROM pr_b),
pr_d AS (
  SELECT *, CASE
    WHEN device_type = 'MM3' AND act AND (days_since_last_report > 90 OR pct_life_used > 90.0) THEN 'REPLACE'
    WHEN device_type = 'ZM1' AND act AND (battery_low_flag = 1 OR days_since_last_report > 90) THEN 'REPLACE'
    WHEN device_type = 'MM3' AND act AND coord_missing_flag = 1 THEN 'RECONFIGURE'
    WHEN device_type = 'ZM1' AND coord_missing_flag = 1 AND days_since_last_report > 14 THEN 'RECONFIGURE'
    WHEN device_type = 'MM3' AND (intermittent_flag = 1 OR coord_missing_flag = 1
         OR (days_since_last_report > 7 AND days_since_last_report <= 90)) THEN 'RECONFIGURE'
    WHEN device_type = 'ZM1' AND (coord_missing_flag = 1 OR (days_since_last_report > 14 AND days_since_last_report <= 90))
         THEN 'RECONFIGURE'
    ELSE 'NO_ACTION' END AS rule_name
  FROM pr_c),
pr_p AS (
  SELECT *, CASE WHEN pct_life_used > 90.0 THEN 'REPLACE' ELSE rule_name END AS PredictedActionName,
    pct_life_used > 90.0 AS AgeOverride
  FROM pr_d)"""

PREDICT_SQL = "WITH " + PREDICT_CTES + """
SELECT Serial, device_type, days_since_last_report, pct_life_used, device_age_days, coord_missing_flag,
  battery_low_flag, offline_flag, intermittent_flag, reconfigure_count, PredictedActionName,
  CASE PredictedActionName WHEN 'NO_ACTION' THEN 0 WHEN 'RECONFIGURE' THEN 1 ELSE 2 END AS PredictedActionLabel,
  AgeOverride, true AS UsedRuleFallback
FROM p"""

CROSSTAB_SQL = "WITH " + PREDICT_CTES + """
SELECT device_type,
  CAST(count_if(PredictedActionName = 'NO_ACTION') AS BIGINT) AS NO_ACTION,
  CAST(count_if(PredictedActionName = 'RECONFIGURE') AS BIGINT) AS RECONFIGURE,
  CAST(count_if(PredictedActionName = 'REPLACE') AS BIGINT) AS REPLACE
FROM p GROUP BY device_type"""


_GATED = "WITH " + PREDICT_CTES + """,
dc AS (SELECT *, CASE reading_id % 3 WHEN 0 THEN 'NO_ACTION' WHEN 1 THEN 'RECONFIGURE' ELSE 'REPLACE' END AS declared,
    CASE WHEN reading_id % 11 <> 0 THEN (900 + reading_id * (CASE device_type WHEN 'MM3' THEN 37 ELSE 53 END) % 100) / 1000 ELSE 0.0 END AS conf FROM d),
gt AS (SELECT *, conf < 0.95 AS low, CASE WHEN pct_life_used > 90.0 THEN 'REPLACE' WHEN conf < 0.95 THEN rule_name ELSE declared END AS action FROM dc)
"""

GATED_SQL = _GATED + """
SELECT Serial, device_type, round(conf, 6) AS Confidence, days_since_last_report, pct_life_used, coord_missing_flag,
  0 AS coord_changed_flag, action AS PredictedActionName,
  CASE action WHEN 'NO_ACTION' THEN 0 WHEN 'RECONFIGURE' THEN 1 ELSE 2 END AS PredictedActionLabel,
  pct_life_used > 90.0 AS AgeOverride, low AS UsedRuleFallback
FROM gt"""

GATED_SUMMARY_SQL = _GATED + """
SELECT device_type, CAST(count(*) AS BIGINT) AS devices, CAST(count_if(action = 'NO_ACTION') AS BIGINT) AS NO_ACTION,
  CAST(count_if(action = 'RECONFIGURE') AS BIGINT) AS RECONFIGURE, CAST(count_if(action = 'REPLACE') AS BIGINT) AS REPLACE,
  CAST(count_if(conf >= 0.95) AS BIGINT) AS confident, CAST(count_if(low) AS BIGINT) AS rule_fallback,
  CAST(count_if(pct_life_used > 90.0) AS BIGINT) AS age_override
FROM gt GROUP BY ROLLUP (device_type)"""

MOVED_SQL = f"""WITH readings AS ({CTES['readings']}),
pv AS (SELECT *, lag(Latitude) OVER w AS prev_lat, lag(Longitude) OVER w AS prev_lon FROM readings
  WINDOW w AS (PARTITION BY Serial ORDER BY BatteryLatestReport IS NULL, BatteryLatestReport, reading_id))
SELECT reading_id, {r6('prev_lat')} AS prev_lat, {r6('prev_lon')} AS prev_lon,
  CASE WHEN coalesce(abs(Latitude - prev_lat) > 0.001, false) OR coalesce(abs(Longitude - prev_lon) > 0.001, false) THEN 1 ELSE 0 END AS coord_changed_flag,
  {flag('Latitude IS NULL OR Latitude = 0 OR Longitude IS NULL OR Longitude = 0')} AS coord_missing_flag,
  {flag('BatteryLevel < 20')} AS battery_low_flag,
  CAST(coalesce(greatest({whole_days(AS_OF, 'coalesce(BatteryLatestReport, Last_Heard)')}, 0), 0) AS BIGINT) AS days_since_last_report
FROM pv"""
