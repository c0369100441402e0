"""DuckDB oracles for reports, quality, failure dataset and trust-stack rules."""

from __future__ import annotations

from .adapter import CTES, cut, days_between, r6
from .health_sql import health_ctes
from .labels_sql import LABEL_CTES
from .timeseries_sql import profile_ctes, ts_ctes

FLEET = "WITH " + health_ctes(batch=False)
ZM1 = "WITH " + ts_ctes() + """,
z AS (SELECT *, months AS device_age_months, comm1 AS comm_age_days, temp AS LineTemperature_val,
        cur AS LineCurrent_val FROM tsf WHERE t = 'ZM1'),
af AS (SELECT *,
  CASE WHEN device_age_months >= 0 AND device_age_months < 12 THEN '0-12 months (New)'
       WHEN device_age_months >= 12 AND device_age_months < 36 THEN '13-36 months (Young)'
       WHEN device_age_months >= 36 AND device_age_months < 60 THEN '37-60 months (Middle-aged)'
       WHEN device_age_months >= 60 THEN '60+ months (Old)' END AS age_bucket,
  CASE WHEN risk_score > 80 OR battery_low_flag = 1 OR overheat_flag = 1 THEN 1 ELSE 0 END AS is_failure
  FROM z WHERE device_age_months IS NOT NULL AND device_age_months > 0)
"""

SQL = {}

SQL["f4_quality_gate"] = f"""WITH readings AS ({CTES['readings']}),
g AS (SELECT *, upper(trim(Device_Type)) AS u FROM readings),
v AS (SELECT *,
  CASE WHEN u LIKE '%UM3%' THEN Last_Heard IS NOT NULL
       WHEN u LIKE '%ZM1%' THEN BatteryLevel IS NOT NULL AND Last_Heard IS NOT NULL
       WHEN u LIKE '%MM3%' THEN LineCurrent IS NOT NULL AND LineTemperature IS NOT NULL AND Last_Heard IS NOT NULL
       ELSE false END AS is_valid,
  CASE WHEN u LIKE '%UM3%' THEN 'Missing Last_Heard data'
       WHEN u LIKE '%ZM1%' THEN 'Missing critical data: ' || concat_ws(', ',
            CASE WHEN BatteryLevel IS NULL THEN 'BatteryLevel' END, CASE WHEN Last_Heard IS NULL THEN 'Last_Heard' END)
       WHEN u LIKE '%MM3%' THEN 'Missing critical data: ' || concat_ws(', ',
            CASE WHEN LineCurrent IS NULL THEN 'LineCurrent' END,
            CASE WHEN LineTemperature IS NULL THEN 'LineTemperature' END,
            CASE WHEN Last_Heard IS NULL THEN 'Last_Heard' END)
       ELSE 'Unknown device type' END AS why
  FROM g)
"""
SQL["f10_quality_report"] = SQL["f4_quality_gate"] + f"""
SELECT device_type, CAST(count(*) AS BIGINT) AS total, CAST(count_if(is_valid) AS BIGINT) AS valid,
  {r6('count_if(is_valid) / count(*) * 100.0')} AS valid_pct
FROM (SELECT CASE WHEN u LIKE '%UM3%' THEN 'UM3' WHEN u LIKE '%ZM1%' THEN 'ZM1' WHEN u LIKE '%MM3%' THEN 'MM3'
                  ELSE 'UNKNOWN' END AS device_type, is_valid FROM v)
GROUP BY ROLLUP (device_type)"""
SQL["f4_quality_gate"] += """
SELECT reading_id, Serial, is_valid, CASE WHEN NOT is_valid THEN why END AS rejection_reason FROM v"""

SQL["f8_data_validity"] = FLEET + """
SELECT reading_id,
  NOT (coalesce(temp < -40, false) OR coalesce(temp > 150, false) OR coalesce(cur < 0, false)
       OR coalesce(distance_drift_m > 300, false) OR coalesce(comm1 > 30, false)) AS is_data_valid,
  CASE WHEN (coalesce(temp < -40, false) OR coalesce(temp > 150, false) OR coalesce(cur < 0, false)
       OR coalesce(distance_drift_m > 300, false) OR coalesce(comm1 > 30, false)) THEN concat_ws('; ',
    CASE WHEN temp < -40 THEN 'Temperature below -40C' END, CASE WHEN temp > 150 THEN 'Temperature above 150C' END,
    CASE WHEN cur < 0 THEN 'Negative current' END, CASE WHEN distance_drift_m > 300 THEN 'GPS jump over 300 m' END,
    CASE WHEN comm1 > 30 THEN 'No communication for over 30 days' END) ELSE 'OK' END AS data_quality_reason,
  (coalesce(temp < -40, false) OR coalesce(temp > 150, false) OR coalesce(cur < 0, false)
       OR coalesce(distance_drift_m > 300, false) OR coalesce(comm1 > 30, false)) AS should_exclude_from_ml
FROM hf"""

SQL["a11_action_value_counts"] = "WITH " + LABEL_CTES + f"""
SELECT device_type_display, action_name, CAST(count(*) AS BIGINT) AS count,
  {r6('count(*) / (SELECT count(*) FROM lab) * 100.0')} AS pct
FROM lab GROUP BY device_type_display, action_name"""

SQL["a13_risk_stats"] = FLEET + f"""
SELECT t AS Device_Type_Standardized, CAST(count(*) AS BIGINT) AS devices,
  CAST(count_if(risk_score > 0) AS BIGINT) AS risk_positive,
  {r6('avg(risk_score)')} AS risk_mean, {r6('min(risk_score)')} AS risk_min, {r6('max(risk_score)')} AS risk_max,
  {r6('count_if(risk_score > 0) / count(*) * 100.0')} AS risk_positive_pct
FROM hf GROUP BY ROLLUP (t)"""

SQL["a17_describe_age"] = ZM1 + f"""
SELECT CAST(count(device_age_months) AS BIGINT) AS count, {r6('min(device_age_months)')} AS min,
  {r6('max(device_age_months)')} AS max, {r6('avg(device_age_months)')} AS mean,
  {r6('median(device_age_months)')} AS median, {r6('stddev_samp(device_age_months)')} AS std
FROM af"""

SQL["a18_age_buckets"] = ZM1 + f"""
SELECT age_bucket, CAST(count(*) AS BIGINT) AS count, {r6('count(*) / (SELECT count(*) FROM af) * 100.0')} AS pct
FROM af GROUP BY age_bucket"""

SQL["a19_failure_by_age"] = ZM1 + f"""
SELECT age_bucket, CAST(count(*) AS BIGINT) AS total_devices, CAST(sum(is_failure) AS BIGINT) AS failed_devices,
  {r6('sum(is_failure) / count(*) * 100.0')} AS failure_rate, {r6('avg(risk_score)')} AS avg_risk_score,
  {r6('avg(battery_level)')} AS avg_battery_level, {r6('0.0')} AS comm_fail_rate
FROM af GROUP BY age_bucket"""

SQL["a20_binned_risk_by_age"] = ZM1 + f""",
rg AS (SELECT min(device_age_months) AS mn, max(device_age_months) AS mx FROM af),
bb AS (SELECT af.*, rg.mn, (rg.mx - rg.mn) / 20 AS w FROM af CROSS JOIN rg),
bi AS (SELECT *, CASE WHEN w = 0 THEN 0 ELSE greatest(0, least(19, CAST(ceil((device_age_months - mn) / w) AS INTEGER) - 1))
               END AS bin FROM bb)
SELECT CAST(bin AS INTEGER) AS bin, CAST(count(*) AS BIGINT) AS n, {r6('first(mn) + (bin + 0.5) * first(w)')} AS bin_center,
  {r6('avg(risk_score)')} AS mean_risk_score, {r6('avg(is_failure)')} AS mean_is_failure
FROM bi GROUP BY bin"""

_pairs = [("device_age_months", "risk_score"), ("device_age_months", "battery_level"),
          ("device_age_months", "comm_age_days"), ("risk_score", "battery_level"), ("risk_score", "comm_age_days"),
          ("battery_level", "comm_age_days")]
SQL["a21_correlations"] = ZM1 + "\n" + " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, {r6(f'corr({a}, {b})')} AS corr FROM z" for a, b in _pairs)

SQL["a22_risk_histogram"] = FLEET + f""",
rg AS (SELECT min(risk_score) AS mn, max(risk_score) AS mx FROM hf),
hb AS (SELECT rg.mn, (rg.mx - rg.mn) / 20 AS w,
         CASE WHEN (rg.mx - rg.mn) / 20 = 0 THEN 0
              ELSE least(19, CAST(floor((risk_score - rg.mn) / ((rg.mx - rg.mn) / 20)) AS INTEGER)) END AS bin
       FROM hf CROSS JOIN rg WHERE risk_score IS NOT NULL),
hc AS (SELECT bin, count(*) AS c, first(mn) AS mn, first(w) AS w FROM hb GROUP BY bin)
SELECT CAST(bin AS INTEGER) AS bin, CAST(c AS BIGINT) AS count, {r6('mn + bin * w')} AS bin_start,
  {r6('mn + (bin + 1) * w')} AS bin_end,
  {r6('sum(c) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(c) OVER ()')} AS ecdf
FROM hc"""

SQL["a23_risk_five_numbers"] = FLEET + f""",
q AS (SELECT t, quantile_cont(risk_score, [0.0, 0.25, 0.5, 0.75, 1.0]) AS q FROM hf WHERE risk_score IS NOT NULL
      GROUP BY t)
SELECT t AS Device_Type_Standardized, {r6('q[1]')} AS min, {r6('q[2]')} AS q1, {r6('q[3]')} AS median,
  {r6('q[4]')} AS q3, {r6('q[5]')} AS max FROM q"""

_flags = ["battery_low_flag", "battery_warning_flag", "zero_current_flag", "low_current_flag", "high_current_flag",
          "critical_current_flag", "high_offpeak_flag", "overheat_flag", "gps_jump_flag"]
SQL["a25_flag_counts"] = FLEET + "\n" + " UNION ALL ".join(
    f"SELECT '{f}' AS flag, CAST(count_if(coalesce({f}, 0) <> 0) AS BIGINT) AS nonzero FROM hf" for f in _flags)

SQL["a27_variance_frequency"] = FLEET + f"""
SELECT Serial, {r6('var_samp(cur)')} AS current_variance, {r6('var_samp(temp)')} AS temp_variance,
  {r6('avg(zero_current_flag)')} AS zero_current_frequency, {r6('avg(overheat_flag)')} AS overheat_frequency,
  {r6('avg(CASE WHEN comm1 > 1 THEN 1.0 ELSE 0.0 END)')} AS comm_fail_frequency,
  {r6('avg(gps_jump_flag)')} AS gps_jump_frequency
FROM hf GROUP BY Serial"""

_risk_cut = cut("risk_score", [0, 20, 40, 60, 80, 101],
                ["Low (0-20)", "Medium (21-40)", "High (41-60)", "Critical (61-80)", "Emergency (81-100)"])
SQL["a29_risk_category_report"] = FLEET + f""",
tot AS (SELECT count(*) AS n, count_if(risk_score > 60) AS g60, count_if(risk_score > 80) AS g80 FROM hf),
cats AS (SELECT {_risk_cut} AS risk_category, count(*) AS devices FROM hf WHERE {_risk_cut} IS NOT NULL
         GROUP BY 1)
SELECT risk_category, CAST(devices AS BIGINT) AS devices, CAST(g60 AS BIGINT) AS devices_over_60,
  CAST(g80 AS BIGINT) AS devices_over_80, {r6('devices / n * 100.0')} AS pct, {r6('g60 / n * 100.0')} AS pct_over_60,
  {r6('g80 / n * 100.0')} AS pct_over_80
FROM cats CROSS JOIN tot"""

SQL["o1_top_risk"] = FLEET + """
SELECT reading_id, Serial, risk_score, risk_reason FROM hf WHERE risk_score > 0
ORDER BY risk_score DESC, Serial, reading_id LIMIT 15"""

SQL["o5_top_risk_view"] = FLEET + """
SELECT Serial, reading_id, dev AS Device_Type, risk_score,
  CASE WHEN length(risk_reason) > 60 THEN substr(risk_reason, 1, 60) || '...' ELSE risk_reason END AS risk_reason_short
FROM hf WHERE risk_score > 0 ORDER BY risk_score DESC, Serial, reading_id LIMIT 5"""

SQL["o6_sample_devices"] = "WITH " + profile_ctes() + """
SELECT Serial, Device_Type_Standardized, total_records FROM profs
ORDER BY md5(CAST(Serial AS VARCHAR) || '-42'), Serial LIMIT 10"""

SQL["a24_processing_stats"] = "WITH " + ts_ctes() + """
SELECT strftime(batch_date, '%Y-%m-%d') AS date, t AS device_type, CAST(count(*) AS BIGINT) AS rows_processed,
  CAST(count(DISTINCT Serial) AS BIGINT) AS unique_devices
FROM hf GROUP BY batch_date, t"""

_ds = ", ".join(
    f"CAST(datediff('day', last_value(CASE WHEN {f} = 1 THEN batch_date END IGNORE NULLS) OVER "
    f"(PARTITION BY Serial ORDER BY batch_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), batch_date) AS DOUBLE)"
    f" AS days_since_{f}" for f in ("overheat_flag", "zero_current_flag", "battery_low_flag"))
SQL["w9_days_since_flags"] = "WITH " + ts_ctes() + f"""
SELECT Serial, strftime(batch_date, '%Y-%m-%d') AS date, {_ds} FROM hf"""

SQL["a10_clamped_drain"] = ZM1 + f""",
v AS (SELECT Serial, batch_date AS d, battery_level AS y FROM z WHERE battery_level IS NOT NULL),
vx AS (SELECT *, CAST(datediff('day', min(d) OVER (PARTITION BY Serial), d) AS DOUBLE) AS x FROM v),
cg AS (SELECT Serial, count(*) AS n, max(x) AS span, count(DISTINCT x) AS nx, regr_slope(y, x) AS s,
        arg_min(y, x) AS y0, arg_max(y, x) AS y1 FROM vx GROUP BY Serial)
SELECT Serial, {r6('''CASE WHEN n < 2 OR span <= 0 THEN 0.027
  ELSE greatest(0.001, least(0.5, CASE WHEN nx > 1 THEN abs(s) ELSE abs((y1 - y0) / span) END)) END''')}
  AS drain_rate_per_day FROM cg"""

_FAIL = ZM1 + """,
fl AS (SELECT *, list(struct_pack(d := batch_date,
          c := CASE WHEN upper(trim(Status)) IN ('OFFLINE', 'OFF LINE', 'OFF-LINE') THEN 'future_offline' END))
        OVER (PARTITION BY Serial ORDER BY batch_date ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING) AS nxt FROM z),
fh AS (SELECT *, list_filter(nxt, lambda s: s.c IS NOT NULL AND datediff('day', batch_date, s.d) <= 7) AS hits FROM fl),
st AS (SELECT max(device_age_months) AS max_age, quantile_cont(device_age_months, 0.75) AS old_q,
         quantile_cont(LineTemperature_val, 0.75) AS hot_q FROM fh),
fe AS (
  SELECT fh.*, CASE WHEN len(hits) > 0 THEN 1 ELSE 0 END AS failure_next_7d,
    coalesce(hits[1].c, 'none') AS failure_cause,
    (1 - battery_level / 100.0) * (0.3 + 0.7 * (CASE WHEN max_age > 0 THEN device_age_months / max_age
                                                    ELSE device_age_months END)) AS aabr2,
    CAST((CASE WHEN battery_level < 20 THEN 40 WHEN battery_level < 30 THEN 30 WHEN battery_level < 50 THEN 20
               WHEN battery_level < 70 THEN 10 ELSE 0 END)
       + (CASE WHEN LineTemperature_val > 80 THEN 30 WHEN LineTemperature_val > 70 THEN 20
               WHEN LineTemperature_val > 60 THEN 10 ELSE 0 END)
       + (CASE WHEN device_age_months > 60 THEN 20 WHEN device_age_months > 36 THEN 15
               WHEN device_age_months > 24 THEN 10 WHEN device_age_months > 12 THEN 5 ELSE 0 END)
       + (CASE WHEN comm_age_days > 7 THEN 10 WHEN comm_age_days > 3 THEN 7 WHEN comm_age_days > 1 THEN 3 ELSE 0 END)
       AS DOUBLE) AS urg2,
    CASE WHEN device_age_months > old_q AND LineTemperature_val > hot_q THEN 1 ELSE 0 END AS old_and_hot_flag
  FROM fh CROSS JOIN st),
ds AS (SELECT * FROM fe WHERE battery_level IS NOT NULL AND LineTemperature_val IS NOT NULL
       AND LineCurrent_val IS NOT NULL AND device_age_months IS NOT NULL AND comm_age_days IS NOT NULL
       AND aabr2 IS NOT NULL AND urg2 IS NOT NULL)
"""

SQL["d13_failure_dataset"] = _FAIL + f"""
SELECT Serial, strftime(batch_date, '%Y-%m-%d') AS date, failure_next_7d, failure_cause,
  {r6('battery_level')} AS battery_level, {r6('LineTemperature_val')} AS LineTemperature_val,
  {r6('LineCurrent_val')} AS LineCurrent_val, {r6('device_age_months')} AS device_age_months,
  {r6('comm_age_days')} AS comm_age_days, {r6('aabr2')} AS age_adjusted_battery_risk,
  {r6('urg2')} AS maintenance_urgency_score, old_and_hot_flag
FROM ds"""

SQL["a28_failure_causes"] = _FAIL + f"""
SELECT CAST(count(*) AS BIGINT) AS failure_rows, CAST(count_if(battery_level < 30) AS BIGINT) AS battery_failures,
  {r6('avg(CASE WHEN battery_level < 30 THEN battery_level END)')} AS battery_avg,
  CAST(count_if(LineTemperature_val > 70) AS BIGINT) AS temperature_failures,
  {r6('avg(CASE WHEN LineTemperature_val > 70 THEN LineTemperature_val END)')} AS temperature_avg,
  CAST(count_if(device_age_months > 36) AS BIGINT) AS age_failures,
  {r6('avg(CASE WHEN device_age_months > 36 THEN device_age_months END)')} AS age_avg_months
FROM ds WHERE failure_next_7d = 1"""

_TRUST = f"""WITH readings AS ({CTES['readings']}),
tr AS (SELECT *, {days_between('max(Last_Heard) OVER ()', 'Last_Heard')} AS dl FROM readings)
"""
_rules = [("BatteryLevel < 20", 35, "Battery <20%"), ("BatteryLevel < 10", 30, "Battery <10%"),
          ("BatteryLevel < 20 AND dl > 3", 25, "Battery <20% AND not heard >3d"), ("dl > 7", 25, "Not heard >7d"),
          ("LineCurrent = 0 AND BatteryLevel < 30", 25, "LineCurrent=0 with low battery"),
          ("LineCurrent = 0 AND dl > 3", 20, "LineCurrent=0 AND not heard >3d"),
          ("LineTemperature > 85", 20, "Temperature >85C"), ("LineTemperature < -20", 20, "Temperature <-20C")]
_score = " + ".join(f"(CASE WHEN coalesce({c}, false) THEN {float(p)} ELSE 0.0 END)" for c, p, _ in _rules)
_reasons = "concat_ws('; ', " + ", ".join(f"CASE WHEN {c} THEN '{t}' END" for c, _, t in _rules) + ")"
SQL["d14_trust_rule_score"] = _TRUST + f""",
sc AS (SELECT *, least(100.0, greatest(0.0, {_score})) AS s, {_reasons} AS rs FROM tr)
SELECT reading_id, {r6('dl')} AS days_since_last_heard, s AS rule_risk_score,
  CASE WHEN s >= 50.0 THEN 1 ELSE 0 END AS rule_label,
  CASE WHEN rs = '' THEN 'No rule triggered' ELSE rs END AS rule_reasons
FROM sc"""

SQL["w8_chrono_split"] = f"""WITH readings AS ({CTES['readings']})
SELECT reading_id,
  (row_number() OVER (ORDER BY Last_Heard ASC NULLS LAST, reading_id) - 1) < floor(count(*) OVER () * 0.8) AS is_train
FROM readings"""
