"""DuckDB oracles for the relational ML evaluation tables."""

from __future__ import annotations

from .adapter import r6
from .labels_sql import LABEL_CTES
from .reports_sql import _FAIL, _TRUST, _score

RULES = """
CASE
  WHEN device_type_display = 'MM3' AND (reconfigure_count >= 1 OR comm_age_days > 90) AND (overheat_flag = 1
       OR zero_current_flag = 1 OR comm_age_days > 90 OR coalesce(pct_life_used, 0.0) > 90.0) THEN 'REPLACE'
  WHEN device_type_display = 'ZM1' AND (reconfigure_count >= 1 OR comm_age_days > 90)
       AND (battery_low_flag = 1 OR comm_age_days > 90) THEN 'REPLACE'
  WHEN device_type_display = 'MM3' AND (((reconfigure_count >= 1 OR comm_age_days > 90) AND coord_missing_flag = 1)
       OR coord_changed_flag = 1) THEN 'RECONFIGURE'
  WHEN device_type_display = 'ZM1' AND ((coord_missing_flag = 1 AND comm_age_days > 14) OR coord_changed_flag = 1)
       THEN 'RECONFIGURE'
  WHEN device_type_display = 'MM3' AND (zero_current_flag = 1 OR overheat_flag = 1 OR intermittent_flag = 1
       OR coord_missing_flag = 1 OR (comm_age_days > 7 AND comm_age_days <= 90)) THEN 'RECONFIGURE'
  WHEN device_type_display = 'ZM1' AND (coord_missing_flag = 1 OR (comm_age_days > 14 AND comm_age_days <= 90))
       THEN 'RECONFIGURE'
  ELSE 'NO_ACTION' END"""


def _label(x):
    return f"(CASE {x} WHEN 'NO_ACTION' THEN 0 WHEN 'RECONFIGURE' THEN 1 ELSE 2 END)"


REPORT = f"""cls AS (SELECT y AS c FROM yp UNION SELECT p FROM yp),
per AS (
  SELECT c, sum(CASE WHEN y = c AND p = c THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN p = c THEN 1 ELSE 0 END) AS pp,
         sum(CASE WHEN y = c THEN 1 ELSE 0 END) AS support
  FROM cls CROSS JOIN yp GROUP BY c),
pr AS (
  SELECT *, CASE WHEN pp > 0 THEN tp / pp ELSE 0.0 END AS precision,
            CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM per),
pf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
       FROM pr),
tot AS (SELECT sum(support) AS n, sum(tp) AS tp, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
          sum(precision * support) / sum(support) AS wp, sum(recall * support) / sum(support) AS wr,
          sum(f1 * support) / sum(support) AS wf FROM pf),
rep AS (
  SELECT CAST(c AS VARCHAR) AS class, precision, recall, f1, CAST(support AS BIGINT) AS support FROM pf
  UNION ALL SELECT 'accuracy', tp / n, tp / n, tp / n, CAST(n AS BIGINT) FROM tot
  UNION ALL SELECT 'macro avg', mp, mr, mf, CAST(n AS BIGINT) FROM tot
  UNION ALL SELECT 'weighted avg', wp, wr, wf, CAST(n AS BIGINT) FROM tot)
SELECT class, support, {r6('precision')} AS precision, {r6('recall')} AS recall, {r6('f1')} AS f1 FROM rep"""

M5 = "WITH " + LABEL_CTES + f""",
yp AS (SELECT {_label('action_name')} AS y, {_label(RULES)} AS p FROM lab),
{REPORT}"""

M3 = "WITH " + LABEL_CTES + """
SELECT CASE action_name WHEN 'NO_ACTION' THEN 0 WHEN 'RECONFIGURE' THEN 1 ELSE 2 END AS action_label,
  CAST(count(*) AS BIGINT) AS rows, CAST(ceil(count(*) * 0.2) AS BIGINT) AS test_rows
FROM lab GROUP BY 1"""

_SIDES = "WITH " + LABEL_CTES + """,
sp AS (SELECT reading_id, CASE action_name WHEN 'NO_ACTION' THEN 0 WHEN 'RECONFIGURE' THEN 1 ELSE 2 END AS action_label FROM lab),
ord AS (SELECT *, CAST('0x' || substr(md5(reading_id || '-42'), 1, 15) AS BIGINT) AS h FROM sp),
sides AS (SELECT reading_id, action_label, row_number() OVER (PARTITION BY action_label ORDER BY h) <=
  ceil(count(*) OVER (PARTITION BY action_label) * 0.2) AS is_test
FROM ord)"""
M3_ROWS = _SIDES + " SELECT * FROM sides"

_FILLED = ["BatteryLevel", "dl", "LineCurrent", "LineTemperature"]
M15 = _TRUST + """,
sd AS (SELECT * FROM tr WHERE Last_Heard IS NOT NULL),
si AS (SELECT *, row_number() OVER (ORDER BY Last_Heard, reading_id) <= floor(count(*) OVER () * 0.8) AS is_train FROM sd),
md AS (SELECT """ + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in _FILLED) + """ FROM si WHERE is_train)
SELECT reading_id, """ + ", ".join(
    f"{r6(f'coalesce({c}, m_{c})')} AS {'days_since_last_heard' if c == 'dl' else c}" for c in _FILLED) + """
FROM si CROSS JOIN md WHERE NOT is_train"""

M4 = _SIDES + f""",
tot AS (SELECT count(*) AS n, count(DISTINCT action_label) AS k FROM sides WHERE NOT is_test),
wt AS (SELECT action_label, any_value(n) / (any_value(k) * count(*)) AS w FROM sides CROSS JOIN tot WHERE NOT is_test GROUP BY 1)
SELECT action_label, CAST(count(*) AS BIGINT) AS rows, {r6('min(w)')} AS lowest, {r6('max(w)')} AS highest
FROM sides LEFT JOIN wt USING (action_label) GROUP BY 1"""

_SPLIT = _TRUST + f""",
sl AS (SELECT *, CASE WHEN {_score} >= 50.0 THEN 1 ELSE 0 END AS p, CAST(coalesce(Status, '') = 'OFFLINE' AS INTEGER) AS y
  FROM tr WHERE Last_Heard IS NOT NULL AND Serial % 7 <> 0),
si AS (SELECT *, row_number() OVER (ORDER BY Last_Heard, reading_id) <= floor(count(*) OVER () * 0.8) AS is_train FROM sl)"""
M20 = _SPLIT + f""",
yp AS (SELECT y, p FROM si WHERE NOT is_train),
{REPORT}"""
M16 = _SPLIT + """
SELECT reading_id, CAST(1 AS INTEGER) AS rules_met, CAST(1 AS INTEGER) AS same FROM si WHERE NOT is_train"""

_HIST = _FAIL + """,
uh0 AS (SELECT urg2 AS s, sum(failure_next_7d) AS pos, sum(1 - failure_next_7d) AS neg FROM ds GROUP BY urg2),
uh AS (SELECT *, sum(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
        sum(neg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM uh0),
ut AS (SELECT sum(failure_next_7d) AS P, sum(1 - failure_next_7d) AS N FROM ds)
"""

M21 = _HIST + f"""
SELECT {r6('s')} AS threshold, {r6('CASE WHEN N > 0 THEN cum_neg / N END')} AS fpr,
  {r6('CASE WHEN P > 0 THEN cum_pos / P END')} AS tpr FROM uh CROSS JOIN ut"""

M13 = _HIST + f""",
ub AS (SELECT count(*) AS n,
        sum(CASE WHEN failure_next_7d = 1 AND urg2 >= 50 THEN 1 ELSE 0 END) AS tp,
        sum(CASE WHEN failure_next_7d = 0 AND urg2 >= 50 THEN 1 ELSE 0 END) AS fp,
        sum(CASE WHEN failure_next_7d = 1 AND urg2 < 50 THEN 1 ELSE 0 END) AS fn,
        sum(CASE WHEN failure_next_7d = (CASE WHEN urg2 >= 50 THEN 1 ELSE 0 END) THEN 1 ELSE 0 END) AS ok,
        sum(failure_next_7d) AS P FROM ds),
ua AS (SELECT sum(neg * (cum_pos - pos + pos * 0.5)) AS num FROM uh),
um AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS prec,
        CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS rec FROM ub CROSS JOIN ua)
SELECT {r6('ok / n')} AS accuracy, {r6('prec')} AS precision, {r6('rec')} AS recall,
  {r6('CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END')} AS f1,
  {r6('CASE WHEN P > 0 AND n - P > 0 THEN num / (P * (n - P)) END')} AS roc_auc FROM um"""

SQL = {"m5_rule_agreement_report": M5, "m3_stratified_split_sizes": M3, "m21_urgency_roc_points": M21,
       "m13_urgency_binary_metrics": M13,
       "m3_stratified_split_rows": M3_ROWS, "m15_median_imputed": M15,
       "m4_class_weights": M4, "m20_rule_baseline_report": M20, "m16_tree_rules": M16}
