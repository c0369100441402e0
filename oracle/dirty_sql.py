"""DuckDB SQL for the queries over dirty variants."""

from .adapter import r6
from .export_sql import TTL_SQL
from .health_sql import health_ctes

TEXT = """t AS (SELECT event_id AS reading_id, CASE WHEN user_id % 5 <> 0 THEN user_id END AS Serial, CAST(ts AS TIMESTAMP) AS ts,
  CASE event_id % 7 WHEN 0 THEN 'NULL' WHEN 1 THEN ' ' || k || ' ' WHEN 2 THEN k || '%' WHEN 3 THEN '1,' || lpad(k, 3, '0') WHEN 4 THEN '' ELSE k END AS b,
  event_id % 12 AS days
  FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events))"""

P5 = f"WITH {TEXT} SELECT reading_id, TRY_CAST(replace(trim(b), ',', '') AS DOUBLE) AS \"BatteryLevel\" FROM t"

D14 = f"""WITH {TEXT}, n AS (SELECT reading_id, days,
    least(100.0, greatest(0.0, TRY_CAST(nullif(regexp_replace(b, '[^0-9.\\-]', '', 'g'), '') AS DOUBLE))) AS raw,
    TRY_CAST(nullif(regexp_replace(b, '[^0-9.\\-]', '', 'g'), '') AS DOUBLE) AS seen FROM t),
c AS (SELECT reading_id, days, CASE WHEN seen IS NULL THEN NULL ELSE raw END AS b FROM n),
s AS (SELECT reading_id, least(100.0, CASE WHEN b < 20 THEN 35.0 ELSE 0 END + CASE WHEN b < 10 THEN 30.0 ELSE 0 END
    + CASE WHEN b < 20 AND days > 3 THEN 25.0 ELSE 0 END + CASE WHEN days > 7 THEN 25.0 ELSE 0 END) AS score FROM c)
SELECT reading_id, CAST(score AS DOUBLE) AS rule_risk_score, CAST(score >= 50 AS INTEGER) AS rule_label FROM s"""

W1 = f"""WITH {TEXT} SELECT reading_id, coalesce(Serial, -1) AS "Serial",
  coalesce(CASE WHEN Serial IS NOT NULL THEN lag(reading_id) OVER (PARTITION BY Serial ORDER BY ts, reading_id) END, -1) AS prev_reading_id FROM t"""

J2 = """SELECT c_custkey AS "Serial", strftime(d, '%Y-%m-%d') AS install_date,
  CAST(coalesce(greatest(date_diff('day', CAST(d AS DATE), DATE '2024-01-31'), 0), 0) AS DOUBLE) AS device_age_days
FROM customer LEFT JOIN (SELECT o_custkey, arg_max(CAST(o_orderdate AS TIMESTAMP), o_orderkey) AS d FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey"""

_D = "(CASE WHEN Serial % 4 <> 0 THEN greatest((Serial % 9) * 0.05, 0.001) END)"
C9 = TTL_SQL.replace("BatteryLevel / 0.027", f"BatteryLevel / {_D}").replace("SELECT Serial, device_type,\n", "SELECT Serial,\n")

_SEEN = "CASE WHEN dayofmonth(batch_date) % 2 = 0 AND reading_id % 3 <> 0 THEN (Serial % 9) * CAST(0.02 AS DOUBLE) END"
_PER_DAY = f"""CASE WHEN bool_or(({_SEEN}) IS NOT NULL) OVER (PARTITION BY batch_date, t) THEN coalesce({_SEEN}, CAST(0.027 AS DOUBLE))
  ELSE CAST(10.0 AS DOUBLE) / 365.0 * (1.0 + pow(life, 2) * 2.0) END"""
D6 = f"""WITH {health_ctes(True, per_day=_PER_DAY)}
SELECT reading_id, {r6('rate')} AS battery_drain_rate, {r6('aabr')} AS age_adjusted_battery_risk,
  {r6('urg')} AS maintenance_urgency_score, {r6('risk_score')} AS risk_score, risk_reason FROM hf"""

SQL = {"d6_drain_by_batch": D6, "c9_ttl_observed": C9, "p5_text_numerics": P5, "d14_text_rules": D14, "w1_null_serials": W1, "j2_last_install": J2}
