"""Queries over the whole export, the processing log and operators that have no place in the other jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import export as X_
from ..operators import failure as FL
from ..operators import frames as FR
from ..operators import labels as L
from ..operators import timeseries as T
from ..operators.common import reliable_checkpoint
from ..functions import exprs as X
from ..sources import adapter as A
from .catalog import AS_OF, daily, declared_predictions, health, history, r6, register

KPIS = ["total_devices", "global_devices_below_20", "global_devices_below_30", "global_emergency_7d", "global_critical_30d",
        "global_urgent_90d"]


def whole_export(spark, sf_dir):
    """Profiles with their latest reason, declared predictions, and all that the export adds."""
    ts = reliable_checkpoint(daily(spark, sf_dir))
    reason = ts.groupBy("Serial").agg(F.max_by("risk_reason", "date").alias("risk_reason_current"))
    profiles = reliable_checkpoint(T.device_profiles(ts).join(reason, "Serial", "left"))
    return X_.full_export(profiles, declared_predictions(spark, sf_dir), AS_OF, "voltwatch")


@register("c5_whole_export")
def c5_whole_export(spark, sf_dir):
    """The whole export, one row a device."""
    e = whole_export(spark, sf_dir)
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return e.select(
        "Serial", "Device_Type_Standardized", "battery_status", "battery_level_category", "replacement_timeline",
        "needs_replacement_30d", "risk_category", "is_high_risk", "is_critical_risk", "drain_rate_category", "is_fast_drain",
        "is_critical_device", "estimated_replacement_date", "replacement_quarter", "age_category", "ttl_category",
        "risk_reason", "PredictedAction", "PredictedActionLabel", "data_source", day("PredictionDate"), day("export_date"),
        *[r6(c).alias(c) for c in ("device_age_years", "device_age_days", "BatteryLevel", "ttl_days", "ttl_months", "ttl_years",
                                   "risk_score", "PredictionConfidence", "global_avg_battery")],
        *[F.col(c).cast("double").alias(c) for c in ("days_since_last_report", "coord_missing_flag", "battery_low_flag", "offline_flag")],
        *[F.col(c).cast("long").alias(c) for c in KPIS])


@register("a26_export_totals")
def a26_export_totals(spark, sf_dir):
    """Totals of the whole export by section, with actions and types."""
    t = X_.export_totals(reliable_checkpoint(whole_export(spark, sf_dir)))
    return t.select("section", "item", "devices", r6("value").alias("value"))


@register("j4_profiles_with_trend")
def j4_profiles_with_trend(spark, sf_dir):
    """Profiles with the battery trend's columns that they lack."""
    ts = reliable_checkpoint(daily(spark, sf_dir))
    p = T.profiles_with_trend(T.device_profiles(ts), T.battery_trend(ts.where(F.col("Device_Type_Standardized") == "ZM1")))
    return p.select("Serial", "Device_Type_Standardized", F.col("data_points").cast("double").alias("data_points"),
                    *[r6(c).alias(c) for c in ("battery_current", "battery_start", "battery_change", "trend_slope")])


def filed(spark, sf_dir):
    """The daily series with the name of the file that each day came from."""
    ts = daily(spark, sf_dir)
    return ts.withColumn("_source_file", F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("-"), F.col("Serial") % 4, F.lit(".csv")))


@register("a24_processing_log")
def a24_processing_log(spark, sf_dir):
    """Rows and distinct devices per (file, date, type)."""
    s = T.processing_stats(filed(spark, sf_dir), file_col="_source_file")
    return s.select("file", F.date_format("date", "yyyy-MM-dd").alias("date"), "device_type", "rows_processed", "unique_devices")


@register("a24_processed_by_type")
def a24_processed_by_type(spark, sf_dir):
    """Files, rows, devices, days and dates per type."""
    s = T.processed_by_type(filed(spark, sf_dir))
    return s.select("device_type", "files_processed", "rows_processed", "unique_devices", "days_processed",
                    *[F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("first_date", "last_date")])


@register("a7_comm_gaps")
def a7_comm_gaps(spark, sf_dir):
    """Latest, mean and longest hours of silence where the series has hours; some days have none."""
    ts = daily(spark, sf_dir)
    end = F.unix_micros(F.date_add("date", 1).cast("timestamp"))
    hours = F.when(F.col("reading_id") % 13 != 0, (end - F.unix_micros("Last_Heard")) / 3.6e9)
    p = T.device_profiles(ts.withColumn("hours_since_last_heard", hours))
    return p.select("Serial", *[r6(c).alias(c) for c in ("comms_gap_current_hours", "comms_gap_avg_hours", "comms_gap_max_hours")])


@register("p17_status_failure")
def p17_status_failure(spark, sf_dir):
    """Failure flag and cause of every reading's status, in several spellings."""
    spelt = F.when(F.col("reading_id") % 3 == 1, F.concat(F.lit(" "), F.regexp_replace(F.lower("Status"), "offline", "off-line"))).when(
        F.col("reading_id") % 3 == 2, F.regexp_replace("Status", "OFFLINE", "Off Line")).otherwise(F.col("Status"))
    return A.readings(spark, sf_dir).select("reading_id", *[c.alias(n) for n, c in FL.status_failure(spelt).items()])


@register("w7_three_causes")
def w7_three_causes(spark, sf_dir):
    """W7 without a status: silence over 7 days, battery below 10 or over 85 degrees in the next 7 rows and days."""
    ts = daily(spark, sf_dir).drop("Status").withColumn("hours_since_last_heard", F.pmod(F.col("reading_id"), F.lit(200)).cast("double"))
    lab = FL.label_lookahead(ts)
    return lab.select("Serial", F.date_format("date", "yyyy-MM-dd").alias("date"), "failure_next_7d", "failure_cause")


@register("d10_um3_actions")
def d10_um3_actions(spark, sf_dir):
    """Actions of all three types, with other thresholds than the defaults."""
    lf = L.label_flags(history(spark, sf_dir), as_of=AS_OF, battery_low=35.0, zero_current_threshold=50.0,
                       types=("MM3", "ZM1", "UM3+"), order_cols=["reading_id"])
    lab = L.label_actions(lf)
    return lab.select("reading_id", "Serial", "device_type_display", "battery_low_flag", "zero_current_flag", "action_name", "action_label")


@register("p26_ml_inputs")
def p26_ml_inputs(spark, sf_dir):
    """Derived months and days, infinite numbers, typed defaults of absent columns."""
    install = A.install_dates(spark, sf_dir).groupBy("Serial").agg(F.max("InstallDate").alias("InstallDate"))
    kind = F.col("reading_id") % 7
    d = A.readings(spark, sf_dir).join(install, "Serial", "left").select(
        "reading_id", X.whole_days(F.to_timestamp(F.lit(AS_OF)), F.col("InstallDate")).cast("double").alias("device_age_days"),
        ((F.unix_micros(F.to_timestamp(F.lit(AS_OF))) - F.unix_micros("Last_Heard")) / 3.6e9).alias("hours_since_last_heard"),
        F.when(kind == 0, F.lit(float("inf"))).when(kind == 1, F.lit(float("-inf"))).otherwise(F.col("LineCurrent")).alias("LineCurrent"))
    d = FR.ensure_cols(FR.derive_ml_inputs(d), {"gps_jump_flag": (0, "int"), "drift": (0.0, "double"), "note": (None, "string"),
                                                "checked": (False, "boolean"), "LineCurrent": (-1.0, "double")})
    return d.select("reading_id", r6("device_age_months").alias("device_age_months"), r6("comm_age_days").alias("comm_age_days"),
                    r6(X.finite("LineCurrent")).alias("current_finite"),
                    r6(F.coalesce(X.finite("LineCurrent"), F.lit(0.0))).alias("current_ml"), "gps_jump_flag", "drift", "note", "checked")


@register("p23_placeholders")
def p23_placeholders(spark, sf_dir):
    """Placeholder features of every scored reading."""
    names = ("current_variance", "temp_variance", "zero_current_frequency", "overheat_frequency", "comm_fail_frequency", "gps_jump_frequency")
    return health(spark, sf_dir, batch=False).select("reading_id", *[F.col(c).cast("double").alias(c) for c in names])
