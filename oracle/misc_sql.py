"""DuckDB oracles for dedupe, attempt counts and type canonicalisation."""

from __future__ import annotations

from voltwatch.plans.catalog import RAW_TYPES

from .adapter import CTES
from .labels_sql import type_a

W6 = f"""WITH readings AS ({CTES['readings']}),
k AS (SELECT *, coalesce(BatteryLatestReport, Last_Heard, CAST(batch_date AS TIMESTAMP)) AS report_key FROM readings)
SELECT Serial, strftime(report_key, '%Y-%m-%d %H:%M:%S.%f') AS report_key, max(reading_id) AS reading_id
FROM k GROUP BY Serial, report_key"""

A15 = f"""WITH attempts AS ({CTES['attempts']})
SELECT Serial, CAST(count(*) AS INTEGER) AS reconfigure_count,
  strftime(max(attempt_date), '%Y-%m-%d') AS last_reconfigure_time
FROM attempts GROUP BY Serial"""

_list = "[" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in RAW_TYPES) + "]"
_u = "coalesce(upper(trim(raw_type)), 'NAN')"


def _b(other):
    fb = _u if other is None else f"'{other}'"
    return (f"CASE WHEN {_u} LIKE '%ZM1%' THEN 'ZM1' WHEN {_u} LIKE '%UM3%' THEN 'UM3' "
            f"WHEN {_u} LIKE '%MM3%' THEN 'MM3' ELSE {fb} END")


P8 = f"""WITH s AS (SELECT event_id AS reading_id, CAST({_list}[user_id % {len(RAW_TYPES)} + 1] AS VARCHAR) AS raw_type
                FROM events)
SELECT reading_id, raw_type, {type_a('raw_type')} AS type_a, {_b(None)} AS type_b, {_b('Unknown')} AS type_b_unknown
FROM s"""

SQL = {"w6_history_dedupe": W6, "a15_reconfigure_counts": A15, "p8_device_types": P8}
