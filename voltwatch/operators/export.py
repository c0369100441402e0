"""BI export: categories, KPIs, predictions and flags joined per device
(C1-C9, C11, J5-J7, A14, A26, P27, T12).

Every join is device-level (one row per Serial on both sides) and uses
Spark's size estimate: broadcast when small, otherwise a shuffle join that
AQE splits on skew.  Global KPIs are one-row aggregates (bounded) broadcast
to every row.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import categories as C
from ..functions import exprs as X
from .frames import with_profile_risk


def with_categories(df: DataFrame, as_of: str) -> DataFrame:
    """C1-C6, C8, C11 on profile-shaped rows (battery_current, days_until_battery_critical,
    risk_score_current, total_days_observed, battery_drain_rate)."""
    cols = {}
    if "battery_current" in df.columns:
        cols["battery_status"] = C.battery_status("battery_current")
        cols["battery_level_category"] = C.battery_category("battery_current")
    if "days_until_battery_critical" in df.columns:
        cols.update(C.replacement_timeline("days_until_battery_critical"))
    if "risk_score_current" in df.columns:
        cols.update(C.risk_category("risk_score_current"))
    if "total_days_observed" in df.columns:
        years = F.col("total_days_observed") / 365.0
        cols["device_age_years"] = years
        cols["age_category"] = C.age_category(years)
    if "battery_drain_rate" in df.columns:
        cols.update(C.drain_category("battery_drain_rate"))
    cols["is_critical_device"] = C.critical_flag(
        "battery_current" if "battery_current" in df.columns else None,
        "days_until_battery_critical" if "days_until_battery_critical" in df.columns else None,
        "risk_score_current" if "risk_score_current" in df.columns else None)
    if "days_until_battery_critical" in df.columns:
        cols.update(C.replacement_dates("days_until_battery_critical", as_of))
    keep = [c for c in df.columns if c not in cols]
    return df.select(*keep, *[c.alias(n) for n, c in cols.items()])


def with_install_age(df: DataFrame, days: str = "device_age_days") -> DataFrame:
    """C5 from the install date: years rounded to 0.1 and their category, in place of the observed ones.

    A device without an install age has no years and falls into the first category."""
    years = X.np_round(F.col(days) / 365.0, 1)
    keep = [c for c in df.columns if c not in ("device_age_years", "age_category")]
    return df.select(*keep, years.alias("device_age_years")).select("*", C.age_category("device_age_years").alias("age_category"))


def with_ttl(df: DataFrame, battery: str = "BatteryLevel", drain: str = "battery_drain_rate_per_day",
             type_col: str = "Device_Type_Standardized") -> DataFrame:
    """C9 over a whole export: observed drains where any ZM1 device of the frame has one, else the default rate for all."""
    zm1 = F.coalesce(F.col(type_col) == "ZM1", F.lit(False))
    rate = F.lit(config.DEFAULT_DRAIN_PER_DAY)
    if drain in df.columns:
        seen = df.agg(F.coalesce(F.max(zm1 & F.col(drain).isNotNull()), F.lit(False)).alias("_seen"))  # one row
        df = df.crossJoin(F.broadcast(seen))
        rate = F.when(F.col("_seen"), F.col(drain)).otherwise(rate)
    cols = C.ttl(zm1, battery, rate)
    return df.select(*[c for c in df.columns if c not in (*cols, "_seen")], *[c.alias(n) for n, c in cols.items()])


def full_export(profiles: DataFrame, predictions: DataFrame, as_of: str, source: str,
                flags: Sequence[str] = ("coord_missing_flag", "battery_low_flag", "offline_flag")) -> DataFrame:
    """The whole export: one row a profile with categories, fleet KPIs, the predicted action, what the prediction knew of
    the device (age, battery, ``flags``), time to live, install age, current risk and metadata (C1-C9, C11, J5-J7, A14, P27).

    ``profiles`` feeds rows, KPIs and the choice of drain: pass a written or checkpointed frame."""
    e = with_global_kpis(with_categories(profiles, as_of))
    e = with_predictions(e, predictions, as_of)
    e = join_new_columns(e, predictions.select("Serial", "device_age_days", "BatteryLevel", "days_since_last_report", *flags))
    e = with_profile_risk(with_install_age(with_ttl(e)), profiles)
    return with_metadata(e, as_of, source)


def with_global_kpis(df: DataFrame) -> DataFrame:
    """Fleet KPI columns on every row (one-row aggregate, broadcast)."""
    b, d = F.col("battery_current"), F.col("days_until_battery_critical")
    kpi = df.agg(
        F.count(F.lit(1)).alias("total_devices"),
        F.avg(b).alias("global_avg_battery"),
        F.count_if(b < 20).alias("global_devices_below_20"),
        F.count_if(b < 30).alias("global_devices_below_30"),
        F.count_if(d < 7).alias("global_emergency_7d"),
        F.count_if(d < 30).alias("global_critical_30d"),
        F.count_if(d < 90).alias("global_urgent_90d"),
    )
    return df.crossJoin(F.broadcast(kpi))


def join_new_columns(left: DataFrame, right: DataFrame, key: str = "Serial", prefer_right: Sequence[str] = ()
                     ) -> DataFrame:
    """Left join, adding only columns the left lacks; for names in
    ``prefer_right`` the right value wins where present (coalesce)."""
    common = [c for c in right.columns if c in left.columns and c != key]
    add = [c for c in right.columns if c not in left.columns]
    r = right.select(key, *add, *[F.col(c).alias(f"__r_{c}") for c in common if c in prefer_right])
    j = left.join(r, key, "left")
    out = [F.coalesce(F.col(f"__r_{c}"), F.col(c)).alias(c) if c in prefer_right and c in common else F.col(c)
           for c in left.columns]
    return j.select(*out, *add)


def with_predictions(df: DataFrame, pred: DataFrame, as_of: str) -> DataFrame:
    """Predicted action per device; missing -> NO_ACTION / 0 / as_of."""
    p = pred.select("Serial", F.col("PredictedActionName").alias("PredictedAction"),
                    F.col("PredictedActionLabel").alias("PredictedActionLabel"),
                    F.col("Confidence").alias("PredictionConfidence") if "Confidence" in pred.columns
                    else F.lit(None).cast("double").alias("PredictionConfidence"))
    j = df.join(p, "Serial", "left")
    return j.select(*[c for c in j.columns if c not in ("PredictedAction", "PredictedActionLabel", "PredictionConfidence")],
                    F.coalesce(F.col("PredictedAction"), F.lit("NO_ACTION")).alias("PredictedAction"),
                    F.coalesce(F.col("PredictedActionLabel"), F.lit(0)).alias("PredictedActionLabel"),
                    F.coalesce(F.col("PredictionConfidence"), F.lit(0.0)).alias("PredictionConfidence"),
                    F.to_date(F.lit(as_of)).alias("PredictionDate"))


def with_metadata(df: DataFrame, as_of: str, source: str) -> DataFrame:
    """Export date, timestamp and source as job parameters (never now())."""
    return df.select("*", F.to_date(F.lit(as_of)).alias("export_date"),
                     F.to_timestamp(F.lit(as_of)).alias("export_timestamp"), F.lit(source).alias("data_source"))


def export_summary(df: DataFrame) -> DataFrame:
    """One-row export summary."""
    b, d = F.col("battery_current"), F.col("days_until_battery_critical")
    return df.agg(
        F.count(F.lit(1)).cast("long").alias("devices"),
        F.avg(b).alias("battery_avg"),
        F.count_if(b < 20).cast("long").alias("battery_critical"),
        F.count_if((b >= 20) & (b < 30)).cast("long").alias("battery_low"),
        F.count_if(d < 7).cast("long").alias("emergency_7d"),
        F.count_if(d < 30).cast("long").alias("critical_30d"),
        F.count_if(d < 90).cast("long").alias("urgent_90d"),
        F.count_if(d < 365).cast("long").alias("this_year"),
        F.count_if(F.col("is_critical_device")).cast("long").alias("critical_devices"),
    )


def export_totals(df: DataFrame, type_col: str = "Device_Type_Standardized") -> DataFrame:
    """A26 in full: rows (section, item, devices, value) for battery, replacement, time to live, age, predictions, critical
    devices and types; ``value`` is a mean or a percentage of all devices, null where there is none.

    The rows are read once: counts and sums by (action, type) serve every section."""
    b, d, t, a = (F.col(c) for c in ("battery_current", "days_until_battery_critical", "ttl_days", "device_age_days"))
    counts = {
        ("battery", "critical_below_20"): b < 20, ("battery", "low_20_to_30"): (b >= 20) & (b < 30),
        ("replacement", "emergency_7d"): d < 7, ("replacement", "critical_30d"): d < 30,
        ("replacement", "urgent_90d"): d < 90, ("replacement", "this_year"): d < 365,
        ("ttl", "critical_30d"): t < 30, ("ttl", "urgent_30_to_90d"): (t >= 30) & (t < 90),
        ("age", "new_below_1y"): a < 365, ("age", "old_above_5y"): a > 1825,
        ("critical", "devices"): F.col("is_critical_device"),
    }
    means = {("battery", "average"): b, ("ttl", "average_days"): t, ("age", "average_days"): a}
    cells = df.groupBy(F.col("PredictedAction").alias("_action"), F.col(type_col).alias("_type")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(c).alias(f"_c{k}") for k, c in enumerate(counts.values())],
        *[x for k, c in enumerate(means.values()) for x in (F.sum(c).alias(f"_s{k}"), F.count(c).alias(f"_m{k}"))])

    def row(section, item, devices, value=None) -> F.Column:
        value = F.lit(None).cast("double") if value is None else value
        return F.struct(F.lit(section).alias("section"), item.alias("item"), devices.cast("long").alias("devices"), value.alias("value"))

    total = cells.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) if c[:2] in ("_n", "_c", "_m") else F.sum(c).alias(c)
                        for c in cells.columns[2:]])  # one row
    figures = [row(s, F.lit(i), F.col(f"_c{k}")) for k, (s, i) in enumerate(counts)]
    figures += [row(s, F.lit(i), F.col(f"_m{k}"), F.when(F.col(f"_m{k}") > 0, F.col(f"_s{k}") / F.col(f"_m{k}")))
                for k, (s, i) in enumerate(means)]
    out = total.select(F.inline(F.array(*figures)))
    share = F.col("_d") / F.col("_n") * 100.0
    for section, key in (("prediction", "_action"), ("type", "_type")):
        part = cells.groupBy(key).agg(F.sum("_n").alias("_d")).crossJoin(F.broadcast(total.select("_n")))
        out = out.unionByName(part.select(row(section, F.col(key), F.col("_d"), share).alias("r")).select("r.*"))
    return out
