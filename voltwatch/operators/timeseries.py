"""Daily time-series, device profiles and battery trends (W2-W4, W6, W9,
A3-A10, A24, C7, C10, C12, J4, O2, O3).

After the (Serial, date) dedupe a device has at most one row per day, so a
``Window.partitionBy("Serial")`` holds at most #days rows per key: bounded,
whatever the fleet size.  Profiles and trends are plain ``groupBy`` with
partial aggregation.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import exprs as X
from .common import dedupe_keep
from .health import build_health_features

TYPES = ("ZM1", "MM3", "UM3")


def daily_series(readings: DataFrame, install: DataFrame | None = None, attempts: DataFrame | None = None,
                 date_col: str = "batch_date", order_cols: Sequence[str] = ("reading_id",)) -> DataFrame:
    """Per (file/date, type) health features of one row per (Serial, date).

    Rows whose type names none of ZM1/MM3/UM3 are skipped; duplicates within
    a day keep the first row in file order (W6); each (date, type) is its own
    batch for snapshots and normalisation.
    """
    t = F.upper(F.col("Device_Type").cast("string"))
    known = F.lit(False)
    for ty in TYPES:
        known = known | t.contains(ty)
    r = readings.where(known)
    r = dedupe_keep(r, ["Serial", date_col], [F.col(c) for c in order_cols], keep="first")
    hf = build_health_features(r, install=install, attempts=attempts, batch_cols=[date_col],
                               snapshot_scope="batch_type", order_cols=list(order_cols))
    return hf.withColumnRenamed(date_col, "date") if date_col != "date" else hf


def time_features(ts: DataFrame, real_days_since: bool = False) -> DataFrame:
    """One-step changes (W3), rolling means over 3/7/14 rows (W4), days-since."""
    w = Window.partitionBy("Serial").orderBy("date")
    typ = F.col("Device_Type_Standardized")
    specs = {"ZM1": [("battery", "battery_level")],
             "MM3": [("current", "LineCurrent_val"), ("temp", "LineTemperature_val")]}
    cols = []
    for ty, pairs in specs.items():
        for short, src in pairs:
            c = F.col(src)
            cols.append(F.when(typ == ty, c - F.lag(c, 1).over(w)).alias(f"{short}_change_1d"))
            for n in (3, 7, 14):
                cols.append(F.when(typ == ty, F.avg(c).over(w.rowsBetween(-(n - 1), 0))).alias(f"{short}_avg_{n}d"))
    for fl in ("overheat_flag", "zero_current_flag", "battery_low_flag"):
        if real_days_since:
            last_hit = F.last(F.when(F.col(fl) == 1, F.col("date")), ignorenulls=True).over(
                w.rowsBetween(Window.unboundedPreceding, 0))
            cols.append(F.datediff(F.col("date"), last_hit).cast("double").alias(f"days_since_{fl}"))
        else:
            cols.append(F.lit(None).cast("double").alias(f"days_since_{fl}"))
    return ts.select("*", *cols)


# ----------------------------------------------------------------- profiles --

def _latest_valid(v: Column, date: Column) -> Column:
    return F.max_by(v, F.when(v.isNotNull(), date))


SPECS = {
    # type: (battery_type, measures_current, measures_temp, measures_battery, critical, warning)
    "ZM1": ("Non-rechargeable", False, False, True, 20, 30),
    "UM3": ("Line-powered or long-life", False, False, False, 0, 0),
    "MM3": ("Line-powered (NOT rechargeable)", False, False, False, 0, 0),
}
SPECS["MM3"] = ("Line-powered (NOT rechargeable)", True, True, False, 0, 0)


def device_profiles(ts: DataFrame) -> DataFrame:
    """One summary row per device."""
    date = F.col("date")
    bat = F.col("_bat_clean")
    cur = F.col("_cur_clean")
    tmp = F.col("_tmp_clean")
    risk = F.col("risk_score")
    raw_bat = X.to_num(F.col("BatteryLevel")) if "BatteryLevel" in ts.columns else F.lit(None).cast("double")
    raw_cur = X.to_num(F.col("LineCurrent")) if "LineCurrent" in ts.columns else F.lit(None).cast("double")
    raw_tmp = X.to_num(F.col("LineTemperature")) if "LineTemperature" in ts.columns else F.lit(None).cast("double")
    hours = (F.col("hours_since_last_heard") if "hours_since_last_heard" in ts.columns
             else F.col("comm_age_days") * 24.0)  # A7: without exact hours the gap comes from the days
    base = ts.select(
        "Serial", "date", "Device_Type", "battery_level", "risk_score",
        F.when(raw_bat.between(0, 100), raw_bat).alias("_bat_clean"),
        F.when(raw_cur.between(0, 1000), raw_cur).alias("_cur_clean"),
        F.when(raw_tmp.between(-40, 100), raw_tmp).alias("_tmp_clean"),
        hours.alias("_hours"),
    )
    g = base.groupBy("Serial").agg(
        F.max_by("Device_Type", date).alias("Device_Type"),
        F.min(date).alias("first_seen_date"),
        F.max(date).alias("last_seen_date"),
        F.count_distinct(date).cast("long").alias("total_days_observed"),
        F.count(F.lit(1)).cast("long").alias("total_records"),
        # A4 battery
        F.count(bat).alias("_n_bat"),
        _latest_valid(bat, date).alias("_battery_current"),
        F.min(bat).alias("_battery_min"), F.max(bat).alias("_battery_max"),
        F.avg(bat).alias("_battery_avg"), F.stddev_samp(bat).alias("_battery_std"),
        F.count_if(bat < 20).cast("long").alias("_battery_low_days"),
        F.count_if(bat < 30).cast("long").alias("_battery_warn_days"),
        # A8 first-to-last drain over the feature battery column
        F.min_by("battery_level", date).alias("_bl_first"),
        F.max_by("battery_level", date).alias("_bl_last"),
        F.datediff(F.max(date), F.min(date)).alias("_span"),
        # A5 line profile
        F.count(cur).alias("_n_cur"),
        _latest_valid(cur, date).alias("_current_current"),
        F.avg(cur).alias("_current_avg"), F.max(cur).alias("_current_max"), F.stddev_samp(cur).alias("_current_std"),
        F.count_if(cur == 0).cast("long").alias("_zero_days"),
        F.count_if(cur > 700).cast("long").alias("_high_days"),
        F.count_if(cur > 850).cast("long").alias("_crit_days"),
        F.count(tmp).alias("_n_tmp"),
        _latest_valid(tmp, date).alias("_temp_current"),
        F.avg(tmp).alias("_temp_avg"), F.max(tmp).alias("_temp_max"),
        F.count_if(tmp > 85).cast("long").alias("_overheat_days"),
        # A6 risk
        _latest_valid(risk, date).alias("risk_score_current"),
        F.avg(risk).alias("risk_score_avg"), F.max(risk).alias("risk_score_max"),
        F.min(risk).alias("risk_score_min"), F.stddev_samp(risk).alias("risk_score_std"),
        # A7 communication gap
        _latest_valid(F.col("_hours"), date).alias("comms_gap_current_hours"),
        F.avg("_hours").alias("comms_gap_avg_hours"), F.max("_hours").alias("comms_gap_max_hours"),
    )
    up = F.upper(F.col("Device_Type"))
    std = (F.when(up.contains("ZM1"), "ZM1").when(up.contains("UM3"), "UM3").when(up.contains("MM3"), "MM3")
           .otherwise("Unknown"))
    g = g.select("*", std.alias("Device_Type_Standardized"))
    typ = F.col("Device_Type_Standardized")
    is_zm1, is_mm3 = typ == "ZM1", typ == "MM3"
    spec = lambda i: (F.when(typ == "UM3", F.lit(SPECS["UM3"][i])).when(is_mm3, F.lit(SPECS["MM3"][i]))
                      .otherwise(F.lit(SPECS["ZM1"][i])))
    has_bat = is_zm1 & (F.col("_n_bat") > 0)
    # A8 drain from first to last reading
    span, first, last = F.col("_span"), F.col("_bl_first"), F.col("_bl_last")
    enough = F.col("total_records") >= 2
    computable = enough & (span > 0) & F.coalesce(first > 0, F.lit(False))
    per_day = F.when(computable, (first - last) / span)
    per_year = per_day * 365.0
    draining = F.coalesce(per_day > 0.001, F.lit(False))
    status = (F.when(~enough, F.lit("Insufficient data"))
              .when(computable & draining, F.concat(F.lit("Draining at "), X.py_fixed(per_year, 1), F.lit("%/year")))
              .when(computable, F.lit("Stable battery level"))
              .otherwise(F.lit("Insufficient data to calculate drain rate")))
    category = (F.when(~enough | ~computable, F.lit("Unknown"))
                .when(~draining, F.lit("Normal"))
                .when(per_year < 10, "Excellent").when(per_year < 20, "Normal")
                .when(per_year < 40, "Slightly Fast").when(per_year < 100, "Fast").otherwise("Critical"))
    g = g.select("*", per_day.alias("_per_day"), status.alias("_status"), category.alias("_category"))
    drain = F.col("_per_day")
    cur_bat = F.col("_battery_current")
    fast = F.coalesce(drain > 0.0001, F.lit(False))
    inf = F.lit(float("inf"))
    zm1_cols = {
        "battery_current": F.when(has_bat, cur_bat),
        "battery_min": F.when(has_bat, F.col("_battery_min")),
        "battery_max": F.when(has_bat, F.col("_battery_max")),
        "battery_avg": F.when(has_bat, F.col("_battery_avg")),
        "battery_std": F.when(has_bat, F.col("_battery_std")),
        "battery_data_quality_pct": F.when(has_bat, F.col("_n_bat") / F.col("total_records") * 100.0),
        "battery_drain_rate_per_day": F.when(has_bat, drain).when(is_zm1, F.lit(config.DEFAULT_DRAIN_PER_DAY)),
        "battery_drain_status": F.when(has_bat, F.col("_status")),
        "drain_rate_category": F.when(has_bat, F.col("_category")).when(is_zm1, F.lit("Insufficient Data")),
        "battery_baseline": F.when(has_bat & enough & (span > 0), first),
        "battery_observation_days": F.when(has_bat, F.when(enough, span).otherwise(F.lit(0))).cast("long"),
        "battery_drain_rate": F.when(has_bat, drain * 365.0),
        "days_until_battery_critical": F.when(has_bat, F.when(fast, F.greatest(F.lit(0.0), (cur_bat - 20) / drain))
                                              .otherwise(inf)).when(is_zm1, F.lit(0.0)),
        "expected_battery_life_days": F.when(has_bat & fast, cur_bat / drain).when(is_zm1, inf),
        "expected_battery_life_years": F.when(has_bat & fast, cur_bat / drain / 365.0).when(is_zm1, inf),
        "battery_low_days_count": F.when(has_bat, F.col("_battery_low_days")),
        "battery_warning_days_count": F.when(has_bat, F.col("_battery_warn_days")),
    }
    has_cur = is_mm3 & (F.col("_n_cur") > 0)
    has_tmp = is_mm3 & (F.col("_n_tmp") > 0)
    mm3_cols = {
        "current_current": F.when(has_cur, F.col("_current_current")),
        "current_avg": F.when(has_cur, F.col("_current_avg")),
        "current_max": F.when(has_cur, F.col("_current_max")),
        "current_std": F.when(has_cur, F.col("_current_std")),
        "zero_current_days": F.when(has_cur, F.col("_zero_days")),
        "high_current_days": F.when(has_cur, F.col("_high_days")),
        "critical_current_days": F.when(has_cur, F.col("_crit_days")),
        "temp_current": F.when(has_tmp, F.col("_temp_current")),
        "temp_avg": F.when(has_tmp, F.col("_temp_avg")),
        "temp_max": F.when(has_tmp, F.col("_temp_max")),
        "overheat_days": F.when(has_tmp, F.col("_overheat_days")),
    }
    out = g.select(
        "Serial", "Device_Type", "Device_Type_Standardized", "first_seen_date", "last_seen_date",
        "total_days_observed", "total_records",
        spec(0).alias("battery_type"), F.lit(10).alias("expected_lifetime_years"),
        spec(1).alias("measures_current"), spec(2).alias("measures_temp"), spec(3).alias("measures_battery"),
        spec(4).alias("critical_battery_level"), spec(5).alias("warning_battery_level"),
        *[c.alias(n) for n, c in zm1_cols.items()],
        *[c.alias(n) for n, c in mm3_cols.items()],
        F.when(typ == "UM3", F.lit(True)).alias("communication_only_device"),
        "risk_score_current", "risk_score_avg", "risk_score_max", "risk_score_min", "risk_score_std",
        "comms_gap_current_hours", "comms_gap_avg_hours", "comms_gap_max_hours",
    )
    return out.select("*", health_status().alias("device_health_status"))


def health_status() -> Column:
    """C12 device health status from the profile row (survey 9.5)."""
    risk = F.col("risk_score_current")
    typ = F.col("Device_Type_Standardized")
    b = F.col("battery_current")
    cur = F.coalesce(F.col("current_current"), F.lit(0.0))
    tmp = F.coalesce(F.col("temp_current"), F.lit(0.0))
    t = lambda c: F.coalesce(c, F.lit(False))
    zm1 = (F.when(t((risk > 80) | (b < 10)), "CRITICAL").when(t((risk > 60) | (b < 20)), "POOR")
           .when(t((risk > 40) | (b < 40)), "FAIR").when(t((risk > 20) | (b < 60)), "GOOD").otherwise("EXCELLENT"))
    mm3 = (F.when((risk > 80) | (cur == 0) | (tmp > 85), "CRITICAL").when((risk > 60) | (cur > 700) | (tmp > 70), "POOR")
           .when((risk > 40) | (cur > 500), "FAIR").when(risk > 20, "GOOD").otherwise("EXCELLENT"))
    other = (F.when(risk > 80, "CRITICAL").when(risk > 60, "POOR").when(risk > 40, "FAIR")
             .when(risk > 20, "GOOD").otherwise("EXCELLENT"))
    return F.when(risk.isNotNull(), F.when(typ == "ZM1", zm1).when(typ == "MM3", mm3).otherwise(other))


def battery_trend(ts_zm1: DataFrame, level_col: str = "BatteryLevel", date_col: str = "date") -> DataFrame:
    """Per device with >= 2 rows and a positive span: start/end/change,
    daily drain and OLS slope/intercept over days since the first reading.
    The fit is null when any reading is missing (T7)."""
    w = Window.partitionBy("Serial")
    d = ts_zm1.select("Serial", F.col(date_col).alias("_d"), X.to_num(F.col(level_col)).alias("_y"))
    d = d.select("*", F.datediff("_d", F.min("_d").over(w)).cast("double").alias("_x"))
    g = d.groupBy("Serial").agg(
        F.count(F.lit(1)).cast("long").alias("data_points"),
        F.count("_y").alias("_ny"),
        F.min("_d").alias("first_date"), F.max("_d").alias("last_date"),
        F.min_by("_y", "_d").alias("battery_start"), F.max_by("_y", "_d").alias("battery_end"),
        F.regr_slope("_y", "_x").alias("_slope"), F.regr_intercept("_y", "_x").alias("_icpt"),
    )
    g = g.where((F.col("data_points") >= 2) & (F.datediff("last_date", "first_date") > 0))
    span = F.datediff("last_date", "first_date")
    complete = F.col("_ny") == F.col("data_points")
    return g.select(
        "Serial", "data_points", span.cast("long").alias("date_range_days"), "battery_start", "battery_end",
        (F.col("battery_end") - F.col("battery_start")).alias("battery_change"),
        ((F.col("battery_end") - F.col("battery_start")) / span).alias("daily_drain_rate"),
        F.when(complete, F.col("_slope")).alias("trend_slope"),
        F.when(complete, F.col("_icpt")).alias("trend_intercept"),
        "first_date", "last_date")


def clamped_drain(ts_zm1: DataFrame, level_col: str = "battery_level", date_col: str = "date") -> DataFrame:
    """A10: |OLS slope| of valid readings over whole days, clamped to [0.001, 0.5];
    0.027 when fewer than two readings, no positive span; total/days when one x value."""
    w = Window.partitionBy("Serial")
    d = ts_zm1.select("Serial", F.col(date_col).alias("_d"), X.to_num(F.col(level_col)).alias("_y"))
    d = d.where(F.col("_y").isNotNull() & F.col("_d").isNotNull())
    d = d.select("*", F.datediff("_d", F.min("_d").over(w)).cast("double").alias("_x"))
    g = d.groupBy("Serial").agg(F.count(F.lit(1)).alias("_n"), F.max("_x").alias("_span"),
                                F.count_distinct("_x").alias("_nx"), F.regr_slope("_y", "_x").alias("_s"),
                                F.min_by("_y", "_x").alias("_y0"), F.max_by("_y", "_x").alias("_y1"))
    raw = F.when(F.col("_nx") > 1, F.abs(F.col("_s"))).otherwise(F.abs((F.col("_y1") - F.col("_y0")) / F.col("_span")))
    rate = F.when((F.col("_n") < 2) | (F.col("_span") <= 0), F.lit(config.DEFAULT_DRAIN_PER_DAY)).otherwise(
        F.greatest(F.lit(0.001), F.least(F.lit(0.5), raw)))
    return g.select("Serial", rate.alias("drain_rate_per_day"))


def profiles_with_trend(profiles: DataFrame, trend: DataFrame) -> DataFrame:
    """Left join trend columns that the profile does not already have."""
    new = [c for c in trend.columns if c == "Serial" or c not in profiles.columns]
    return profiles.join(trend.select(*new), "Serial", "left")


def processing_stats(ts: DataFrame, date_col: str = "date", file_col: str | None = None) -> DataFrame:
    """Rows and distinct devices per (date, type), or per (file, date, type) where ``file_col`` is given."""
    file = [F.col(file_col).alias("file")] if file_col else []
    return ts.groupBy(*file, F.col(date_col).alias("date"), F.col("Device_Type_Standardized").alias("device_type")).agg(
        F.count(F.lit(1)).cast("long").alias("rows_processed"),
        F.count_distinct("Serial").cast("long").alias("unique_devices"))


def processed_by_type(ts: DataFrame, date_col: str = "date", file_col: str = "_source_file") -> DataFrame:
    """A24 totals: per type the files processed, rows, devices, days and range of dates."""
    key = F.col("Device_Type_Standardized").alias("device_type")
    cells = ts.groupBy(key, F.col(file_col).alias("_f"), F.col(date_col).alias("_d"), "Serial").agg(F.count(F.lit(1)).alias("_n"))
    return cells.groupBy("device_type").agg(
        F.count_distinct("_f").cast("long").alias("files_processed"), F.sum("_n").cast("long").alias("rows_processed"),
        F.count_distinct("Serial").cast("long").alias("unique_devices"), F.count_distinct("_d").cast("long").alias("days_processed"),
        F.min("_d").alias("first_date"), F.max("_d").alias("last_date"))


def ordered_profiles(profiles: DataFrame) -> DataFrame:
    """O2: profiles by type, then the highest current risk first (no score last), for the sink; a range sort, not one task."""
    return profiles.orderBy(F.asc_nulls_last("Device_Type_Standardized"), F.desc_nulls_last("risk_score_current"), "Serial")


def sorted_for_sink(df: DataFrame, key: str = "Serial", order: str = "date") -> DataFrame:
    """O3: cluster by device and sort within partitions (no global sort)."""
    return df.repartition(key).sortWithinPartitions(key, order)
