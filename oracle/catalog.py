"""Oracle SQL per registered query (DuckDB dialect, driver tables as views)."""

from __future__ import annotations

from .dirty_sql import SQL as DIRTY
from .export_sql import ALERT_SQL, EXPORT_SQL, J5_SQL, SUMMARY_SQL, TTL_SQL
from .health_sql import health_sql
from .misc_sql import SQL as MISC
from .ml_sql import SQL as ML
from .reports_sql import SQL as REPORTS
from .labels_sql import CROSSTAB_SQL, GATED_SQL, GATED_SUMMARY_SQL, LABEL_SQL, MOVED_SQL, PREDICT_SQL
from .timeseries_sql import PROFILE_SQL, TREND_SQL, TS_SQL
from .whole_sql import SQL as WHOLE

SQL: dict[str, str] = {
    "d4_health_fleet": health_sql(batch=False),
    "d4_health_daily": health_sql(batch=True),
    "w4_daily_time_series": TS_SQL,
    "a3_device_profiles": PROFILE_SQL,
    "a9_battery_trend": TREND_SQL,
    "d8_label_actions": LABEL_SQL,
    "d12_rule_predictions": PREDICT_SQL,
    "a12_action_crosstab": CROSSTAB_SQL,
    "d15_gated_predictions": GATED_SQL,
    "a12_prediction_summary": GATED_SUMMARY_SQL,
    "d17_moved_devices": MOVED_SQL,
    "c1_export_categories": EXPORT_SQL,
    "a26_export_summary": SUMMARY_SQL,
    "c13_alerts": ALERT_SQL,
    "j5_export_with_predictions": J5_SQL,
    "c9_ttl": TTL_SQL,
}
SQL.update(REPORTS)
SQL.update(ML)
SQL.update(MISC)
SQL.update(DIRTY)
SQL.update(WHOLE)
