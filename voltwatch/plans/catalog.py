"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables through the adapter and runs over the
whole tables.  Float outputs are rounded to 6 dp for the oracle compare.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import health as H
from ..sources import adapter as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def health(spark: SparkSession, sf_dir: str, batch: bool) -> DataFrame:
    return H.build_health_features(
        A.readings(spark, sf_dir), install=A.install_dates(spark, sf_dir), attempts=A.attempts(spark, sf_dir),
        batch_cols=["batch_date"] if batch else [], order_cols=["reading_id"])


def health_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "reading_id", "Serial", "Device_Type_Standardized", "comm_age_days",
        r6("battery_report_age_days").alias("battery_report_age_days"), r6("pct_life_used").alias("pct_life_used"),
        r6("device_age_months").alias("device_age_months"), r6("LineCurrent_val").alias("LineCurrent_val"),
        r6("LineTemperature_val").alias("LineTemperature_val"), "battery_low_flag", "zero_current_flag",
        "low_current_flag", "high_current_flag", "critical_current_flag", "high_offpeak_flag", "overheat_flag",
        r6("distance_drift_m").alias("distance_drift_m"), "gps_jump_flag",
        r6("age_adjusted_battery_risk").alias("age_adjusted_battery_risk"),
        r6("maintenance_urgency_score").alias("maintenance_urgency_score"),
        r6("risk_score_zm1").alias("risk_score_zm1"), r6("risk_score_um3").alias("risk_score_um3"),
        r6("risk_score_mm3").alias("risk_score_mm3"), "risk_score", "risk_reason", "reconfigure_count")


@register("d4_health_fleet")
def d4_health_fleet(spark, sf_dir):
    """Whole table scored as one batch (re-scoring a processed file)."""
    return health_columns(health(spark, sf_dir, batch=False))


@register("d4_health_daily")
def d4_health_daily(spark, sf_dir):
    """Each day is one batch (daily snapshot files)."""
    return health_columns(health(spark, sf_dir, batch=True))


# ------------------------------------------------------------ time series --

def daily(spark, sf_dir):
    from ..operators import timeseries as T
    return T.daily_series(A.readings(spark, sf_dir), install=A.install_dates(spark, sf_dir),
                          attempts=A.attempts(spark, sf_dir))


TS_FLOATS = (["battery_change_1d"] + [f"battery_avg_{n}d" for n in (3, 7, 14)]
             + ["current_change_1d"] + [f"current_avg_{n}d" for n in (3, 7, 14)]
             + ["temp_change_1d"] + [f"temp_avg_{n}d" for n in (3, 7, 14)])


@register("w4_daily_time_series")
def w4_daily_time_series(spark, sf_dir):
    """Daily series per device with changes and rolling means."""
    from ..operators import timeseries as T
    ts = T.time_features(daily(spark, sf_dir))
    return ts.select("Serial", F.date_format("date", "yyyy-MM-dd").alias("date"), "Device_Type_Standardized",
                     "comm_age_days", r6("battery_level").alias("battery_level"), "risk_score", "risk_reason",
                     *[r6(c).alias(c) for c in TS_FLOATS])


PROFILE_FLOATS = ["battery_current", "battery_min", "battery_max", "battery_avg", "battery_std",
                  "battery_data_quality_pct", "battery_drain_rate_per_day", "battery_baseline",
                  "battery_drain_rate", "days_until_battery_critical", "expected_battery_life_days",
                  "expected_battery_life_years", "current_current", "current_avg", "current_max", "current_std",
                  "temp_current", "temp_avg", "temp_max", "risk_score_current", "risk_score_avg", "risk_score_max",
                  "risk_score_min", "risk_score_std", "comms_gap_current_hours", "comms_gap_avg_hours",
                  "comms_gap_max_hours"]


# nullable integer / boolean columns are compared as double / string
PROFILE_NULLABLE_INTS = ["battery_observation_days", "battery_low_days_count", "battery_warning_days_count",
                         "zero_current_days", "high_current_days", "critical_current_days", "overheat_days"]


@register("a3_device_profiles")
def a3_device_profiles(spark, sf_dir):
    """One profile row per device from the daily series."""
    from ..operators import timeseries as T
    p = T.device_profiles(daily(spark, sf_dir))
    others = [c for c in p.columns if c not in PROFILE_FLOATS + PROFILE_NULLABLE_INTS + ["communication_only_device"]]
    return p.select(*[F.date_format(c, "yyyy-MM-dd").alias(c) if c.endswith("_seen_date") else F.col(c)
                      for c in others], *[r6(c).alias(c) for c in PROFILE_FLOATS],
                    *[F.col(c).cast("double").alias(c) for c in PROFILE_NULLABLE_INTS],
                    F.col("communication_only_device").cast("string").alias("communication_only_device"))


@register("a9_battery_trend")
def a9_battery_trend(spark, sf_dir):
    """OLS battery trend per ZM1 device over the daily series."""
    from ..operators import timeseries as T
    ts = daily(spark, sf_dir)
    tr = T.battery_trend(ts.where(F.col("Device_Type_Standardized") == "ZM1"))
    return tr.select("Serial", "data_points", "date_range_days",
                     *[r6(c).alias(c) for c in ("battery_start", "battery_end", "battery_change", "daily_drain_rate",
                                                 "trend_slope", "trend_intercept")],
                     F.date_format("first_date", "yyyy-MM-dd").alias("first_date"),
                     F.date_format("last_date", "yyyy-MM-dd").alias("last_date"))


# ------------------------------------------------------------ labels ------

AS_OF = "2024-01-31 00:00:00"


def history(spark, sf_dir, with_install: bool = True):
    """Readings with install date (J2 input) and reconfigure counts."""
    from ..operators.health import reconfigure_counts
    r = A.readings(spark, sf_dir)
    rc = reconfigure_counts(A.attempts(spark, sf_dir)).select("Serial", "reconfigure_count")
    h = r.join(rc, "Serial", "left").select(
        *[c for c in r.columns], F.coalesce(F.col("reconfigure_count"), F.lit(0)).alias("reconfigure_count"))
    if with_install:
        inst = A.install_dates(spark, sf_dir).groupBy("Serial").agg(F.max("InstallDate").alias("InstallDate"))
        h = h.join(inst, "Serial", "left")
    return h


@register("d8_label_actions")
def d8_label_actions(spark, sf_dir):
    """Label flags and last-writer-wins action rules per reading."""
    from ..operators import labels as L
    lf = L.label_flags(history(spark, sf_dir), as_of=AS_OF, order_cols=["reading_id"])
    lab = L.label_actions(lf)
    return lab.select("reading_id", "Serial", "device_type_display", "comm_age_days", "pct_life_used",
                      F.col("device_age_days").cast("double").alias("device_age_days"), "reconfigure_count",
                      "battery_low_flag", "zero_current_flag", "overheat_flag", "intermittent_flag", "offline_flag",
                      "coord_missing_flag", "coord_changed_flag", "timestamp_missing", "action_name", "action_label")


def rule_predictions(spark, sf_dir):
    from ..operators import labels as L
    h = history(spark, sf_dir, with_install=False)
    from ..operators.labels import canonical_type
    h = canonical_type(h).where(F.col("device_type").isNotNull())
    latest = L.latest_per_device(h, "BatteryLatestReport", order_cols=["reading_id"])
    latest = L.with_install_lookup(latest, A.install_dates(spark, sf_dir), AS_OF)
    latest = latest.where(F.col("device_type").isin("MM3", "ZM1"))
    feats = L.recompute_features(latest, AS_OF)
    # no model available: every row is below the confidence threshold
    pred = feats.select("*", F.lit(0.0).alias("Confidence"), F.lit(None).cast("string").alias("PredictedActionName"),
                        F.lit(False).alias("UsedRuleFallback"))
    pred = L.apply_confidence(pred)
    return L.apply_age_override(pred)


@register("d12_rule_predictions")
def d12_rule_predictions(spark, sf_dir):
    """Latest row per device -> rule action -> age override."""
    p = rule_predictions(spark, sf_dir)
    return p.select("Serial", "device_type", "days_since_last_report", "pct_life_used", "device_age_days",
                    "coord_missing_flag", "battery_low_flag", "offline_flag", "intermittent_flag", "reconfigure_count",
                    "PredictedActionName", "PredictedActionLabel", "AgeOverride", "UsedRuleFallback")


@register("a12_action_crosstab")
def a12_action_crosstab(spark, sf_dir):
    """Device type x predicted action counts."""
    from ..operators import labels as L
    ct = L.action_crosstab(rule_predictions(spark, sf_dir))
    return ct.select("device_type", *[F.col(c).cast("long").alias(c) for c in ("NO_ACTION", "RECONFIGURE", "REPLACE")])


def declared_predictions(spark, sf_dir):
    """The prediction job's last part over declared model results: a label and a confidence of each device's own."""
    from ..ml import bundles as B
    latest = B.latest_features(history(spark, sf_dir, with_install=False), A.install_dates(spark, sf_dir), AS_OF, ["reading_id"])
    label = F.pmod(F.col("reading_id"), F.lit(3)).cast("int")
    branches = [latest.where(F.col("device_type") == t).select(
        "*", label.alias("PredictedActionLabel"), F.array(*map(F.lit, ("NO_ACTION", "RECONFIGURE", "REPLACE")))[label].alias("PredictedActionName"),
        F.when(F.col("reading_id") % 11 != 0, (F.pmod(F.col("reading_id") * step, F.lit(100)) + 900) / 1000).alias("Confidence"),
        F.lit(False).alias("UsedRuleFallback")) for t, step in (("MM3", 37), ("ZM1", 53))]
    return B.decide(branches[0].unionByName(branches[1]))


@register("d15_gated_predictions")
def d15_gated_predictions(spark, sf_dir):
    """Declared predictions of two types through gate, age override and union."""
    p = declared_predictions(spark, sf_dir)
    return p.select("Serial", "device_type", r6("Confidence").alias("Confidence"), "days_since_last_report", "pct_life_used",
                    "coord_missing_flag", "coord_changed_flag", "PredictedActionName", "PredictedActionLabel",
                    "AgeOverride", "UsedRuleFallback")


@register("a12_prediction_summary")
def a12_prediction_summary(spark, sf_dir):
    """Actions, confident rows, fallbacks and overrides of the declared predictions, by type and overall."""
    from ..ml import bundles as B
    return B.summary(declared_predictions(spark, sf_dir))


@register("d17_moved_devices")
def d17_moved_devices(spark, sf_dir):
    """Previous coordinates and change flag of every reading in the order of its reports."""
    from ..operators import labels as L
    f = L.recompute_features(A.readings(spark, sf_dir), AS_OF, "BatteryLatestReport", ["reading_id"])
    return f.select("reading_id", r6("prev_lat").alias("prev_lat"), r6("prev_lon").alias("prev_lon"), "coord_changed_flag",
                    "coord_missing_flag", "battery_low_flag", "days_since_last_report")


# ------------------------------------------------------------ export ------

def export_rows(spark, sf_dir):
    from ..operators import export as X_
    from ..operators import timeseries as T
    from ..operators.common import reliable_checkpoint
    # profiles feed both the rows and the fleet KPIs: written once, read twice
    prof = reliable_checkpoint(T.device_profiles(daily(spark, sf_dir)))
    return X_.with_global_kpis(X_.with_categories(prof, AS_OF))


@register("c1_export_categories")
def c1_export_categories(spark, sf_dir):
    """Export categories, replacement dates and fleet KPIs per device."""
    e = export_rows(spark, sf_dir)
    return e.select(
        "Serial", "battery_status", "battery_level_category", "replacement_timeline", "needs_replacement_30d",
        "needs_replacement_90d", "needs_replacement_1yr", "risk_category", "is_high_risk", "is_critical_risk",
        r6("device_age_years").alias("device_age_years"), "age_category", "drain_rate_category", "is_normal_drain",
        "is_fast_drain", "is_critical_device", "estimated_replacement_date", "replacement_quarter",
        F.col("replacement_year").cast("double").alias("replacement_year"), "replacement_month",
        F.col("total_devices").cast("long").alias("total_devices"), r6("global_avg_battery").alias("global_avg_battery"),
        *[F.col(c).cast("long").alias(c) for c in ("global_devices_below_20", "global_devices_below_30",
                                                    "global_emergency_7d", "global_critical_30d", "global_urgent_90d")])


@register("a26_export_summary")
def a26_export_summary(spark, sf_dir):
    """One-row export summary."""
    from ..operators import export as X_
    s = X_.export_summary(export_rows(spark, sf_dir))
    return s.select(*[r6(c).alias(c) if c == "battery_avg" else F.col(c) for c in s.columns])


@register("c13_alerts")
def c13_alerts(spark, sf_dir):
    """Alert level, inspection flag, message and colour per scored reading."""
    from ..functions import categories as C
    hf = health(spark, sf_dir, batch=False)
    cols = C.alert_level("risk_score")
    return hf.select("reading_id", "Serial", "risk_score", *[c.alias(n) for n, c in cols.items()])


# ------------------------------------------------------------ reports -----

def fleet(spark, sf_dir):
    return health(spark, sf_dir, batch=False)


def zm1_series(spark, sf_dir):
    return daily(spark, sf_dir).where(F.col("Device_Type_Standardized") == "ZM1")


@register("f4_quality_gate")
def f4_quality_gate(spark, sf_dir):
    """per-row validity and rejection reason."""
    from ..operators import quality as Q
    g = Q.quality_gate(A.readings(spark, sf_dir))
    return g.select("reading_id", "Serial", "is_valid", "rejection_reason")


@register("f10_quality_report")
def f10_quality_report(spark, sf_dir):
    """valid / total per type and overall."""
    from ..operators import quality as Q
    rep = Q.quality_report(Q.quality_gate(A.readings(spark, sf_dir)))
    return rep.select("device_type", "total", "valid", r6("valid_pct").alias("valid_pct"))


@register("f8_data_validity")
def f8_data_validity(spark, sf_dir):
    """F8: documented validity rules on scored readings."""
    from ..operators import quality as Q
    v = Q.data_validity(fleet(spark, sf_dir))
    return v.select("reading_id", "is_data_valid", "data_quality_reason", "should_exclude_from_ml")


@register("a11_action_value_counts")
def a11_action_value_counts(spark, sf_dir):
    """Value counts with percent of the labelled actions."""
    from ..operators import reports as R
    lab = d8_label_actions(spark, sf_dir)
    vc = R.value_counts(lab, ["device_type_display", "action_name"])
    return vc.select("device_type_display", "action_name", "count", r6("pct").alias("pct"))


@register("a13_risk_stats")
def a13_risk_stats(spark, sf_dir):
    """Risk statistics per type and overall (rollup)."""
    from ..operators import reports as R
    s = R.risk_stats(fleet(spark, sf_dir))
    return s.select("Device_Type_Standardized", "devices", "risk_positive",
                    *[r6(c).alias(c) for c in ("risk_mean", "risk_min", "risk_max", "risk_positive_pct")])


@register("a17_describe_age")
def a17_describe_age(spark, sf_dir):
    """Distribution summary of device age (months) on the ZM1 series."""
    from ..operators import reports as R
    a = R.age_frame(zm1_series(spark, sf_dir))
    d = R.describe(a, "device_age_months")
    return d.select("count", *[r6(c).alias(c) for c in ("min", "max", "mean", "median", "std")])


@register("a18_age_buckets")
def a18_age_buckets(spark, sf_dir):
    """Left-closed age buckets with counts and percent."""
    from ..operators import reports as R
    vc = R.value_counts(R.age_frame(zm1_series(spark, sf_dir)), "age_bucket")
    return vc.select("age_bucket", "count", r6("pct").alias("pct"))


@register("a19_failure_by_age")
def a19_failure_by_age(spark, sf_dir):
    """Failure rate and means per age bucket."""
    from ..operators import reports as R
    f = R.failure_by_age(zm1_series(spark, sf_dir))
    return f.select("age_bucket", "total_devices", "failed_devices",
                    *[r6(c).alias(c) for c in ("failure_rate", "avg_risk_score", "avg_battery_level",
                                                "comm_fail_rate")])


@register("a20_binned_risk_by_age")
def a20_binned_risk_by_age(spark, sf_dir):
    """20 equal-width age bins, mean risk and failure rate."""
    from ..operators import reports as R
    b = R.binned_mean(R.age_frame(zm1_series(spark, sf_dir)), "device_age_months", ["risk_score", "is_failure"])
    return b.select("bin", "n", r6("bin_center").alias("bin_center"), r6("mean_risk_score").alias("mean_risk_score"),
                    r6("mean_is_failure").alias("mean_is_failure"))


@register("a21_correlations")
def a21_correlations(spark, sf_dir):
    """Pairwise Pearson correlations of age, risk, battery and comm age."""
    from ..operators import reports as R
    c = R.correlations(zm1_series(spark, sf_dir), ["device_age_months", "risk_score", "battery_level",
                                                   "comm_age_days"])
    return c.select("x", "y", r6("corr").alias("corr"))


@register("a22_risk_histogram")
def a22_risk_histogram(spark, sf_dir):
    """20-bin histogram of risk with the empirical CDF."""
    from ..operators import reports as R
    h = R.histogram(fleet(spark, sf_dir), "risk_score", 20)
    return h.select("bin", "count", *[r6(c).alias(c) for c in ("bin_start", "bin_end", "ecdf")])


@register("a23_risk_five_numbers")
def a23_risk_five_numbers(spark, sf_dir):
    """Box-plot five numbers of risk per type."""
    from ..operators import reports as R
    f = R.five_numbers(fleet(spark, sf_dir), "Device_Type_Standardized", "risk_score")
    return f.select("Device_Type_Standardized", *[r6(c).alias(c) for c in ("min", "q1", "median", "q3", "max")])


FLAGS = ["battery_low_flag", "battery_warning_flag", "zero_current_flag", "low_current_flag", "high_current_flag",
         "critical_current_flag", "high_offpeak_flag", "overheat_flag", "gps_jump_flag"]


@register("a25_flag_counts")
def a25_flag_counts(spark, sf_dir):
    """Non-zero counts per flag column."""
    from ..operators import reports as R
    return R.flag_counts(fleet(spark, sf_dir), FLAGS)


@register("a27_variance_frequency")
def a27_variance_frequency(spark, sf_dir):
    """Per-device variance and frequency features."""
    from ..operators import reports as R
    v = R.variance_frequency(fleet(spark, sf_dir))
    return v.select("Serial", *[r6(c).alias(c) for c in v.columns if c != "Serial"])


@register("a29_risk_category_report")
def a29_risk_category_report(spark, sf_dir):
    """Devices and percent per risk category, > 60 and > 80."""
    from ..operators import reports as R
    r = R.risk_category_report(fleet(spark, sf_dir))
    return r.select("risk_category", "devices", "devices_over_60", "devices_over_80",
                    *[r6(c).alias(c) for c in ("pct", "pct_over_60", "pct_over_80")])


@register("o1_top_risk")
def o1_top_risk(spark, sf_dir):
    """O1: the 15 riskiest scored readings (top-k report)."""
    top = H.get_top_risk_devices(fleet(spark, sf_dir), 15, tiebreak=["reading_id"])
    return top.select("reading_id", "Serial", "risk_score", "risk_reason")


@register("o5_top_risk_view")
def o5_top_risk_view(spark, sf_dir):
    """Top-5 view with the reason cut to 60 characters."""
    from ..operators import reports as R
    return R.top_risk_view(fleet(spark, sf_dir), 5, 60, tiebreak=["reading_id"])


@register("o6_sample_devices")
def o6_sample_devices(spark, sf_dir):
    """Reproducible sample of 10 device profiles (sampling operator)."""
    from ..operators import reports as R
    from ..operators import timeseries as T
    p = T.device_profiles(daily(spark, sf_dir))
    return R.sample_n(p.select("Serial", "Device_Type_Standardized", "total_records"), 10, 42)


@register("a24_processing_stats")
def a24_processing_stats(spark, sf_dir):
    """Rows and distinct devices per (date, type) of the daily series."""
    from ..operators import timeseries as T
    s = T.processing_stats(daily(spark, sf_dir))
    return s.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "device_type", "rows_processed",
                    "unique_devices")


@register("w9_days_since_flags")
def w9_days_since_flags(spark, sf_dir):
    """Days since the last overheat / zero-current / low-battery day per device."""
    from ..operators import timeseries as T
    ts = T.time_features(daily(spark, sf_dir), real_days_since=True)
    return ts.select("Serial", F.date_format("date", "yyyy-MM-dd").alias("date"),
                     "days_since_overheat_flag", "days_since_zero_current_flag", "days_since_battery_low_flag")


@register("a10_clamped_drain")
def a10_clamped_drain(spark, sf_dir):
    """A10: clamped OLS drain rate per ZM1 device."""
    from ..operators import timeseries as T
    d = T.clamped_drain(zm1_series(spark, sf_dir))
    return d.select("Serial", r6("drain_rate_per_day").alias("drain_rate_per_day"))


@register("d13_failure_dataset")
def d13_failure_dataset(spark, sf_dir):
    """Look-ahead labels and engineered features on the ZM1 series."""
    from ..operators import failure as FL
    ds = FL.failure_dataset(zm1_series(spark, sf_dir))
    return ds.select("Serial", F.date_format("date", "yyyy-MM-dd").alias("date"), "failure_next_7d", "failure_cause",
                     *[r6(c).alias(c) for c in FL.ML_FEATURES if c != "old_and_hot_flag"], "old_and_hot_flag")


@register("a28_failure_causes")
def a28_failure_causes(spark, sf_dir):
    """Failure-cause breakdown over look-ahead failure rows."""
    from ..operators import failure as FL
    c = FL.failure_causes(FL.failure_dataset(zm1_series(spark, sf_dir)))
    return c.select(*[r6(x).alias(x) if x.endswith("avg") or x.endswith("_months") else F.col(x) for x in c.columns])


def trust_input(spark, sf_dir):
    from ..operators import failure as FL
    return FL.days_since_last_heard(A.readings(spark, sf_dir), "Last_Heard")


@register("d14_trust_rule_score")
def d14_trust_rule_score(spark, sf_dir):
    """Trust-stack rule score, label and reasons per reading."""
    from ..operators import failure as FL
    s = FL.rule_score(trust_input(spark, sf_dir))
    return s.select("reading_id", r6("days_since_last_heard").alias("days_since_last_heard"), "rule_risk_score",
                    "rule_label", "rule_reasons")


@register("w8_chrono_split")
def w8_chrono_split(spark, sf_dir):
    """Chronological 80/20 split of the readings."""
    from ..operators import failure as FL
    return FL.chrono_split(A.readings(spark, sf_dir), "Last_Heard", 0.8, ["reading_id"]).select("reading_id",
                                                                                                 "is_train")


# ------------------------------------------------------------ ML ----------

def label_frame_with_rules(spark, sf_dir):
    """Labelled readings plus the D12 fallback action computed on the same rows."""
    from ..operators import labels as L
    lab = d8_label_actions_full(spark, sf_dir)
    lab = lab.select("*", F.col("comm_age_days").alias("days_since_last_report"))
    name, label = L.rule_actions(lab, "device_type_display")
    return lab.select("*", name.alias("rule_action"), label.alias("rule_action_label"))


def d8_label_actions_full(spark, sf_dir):
    from ..operators import labels as L
    lf = L.label_flags(history(spark, sf_dir), as_of=AS_OF, order_cols=["reading_id"])
    return L.label_actions(lf)


@register("m5_rule_agreement_report")
def m5_rule_agreement_report(spark, sf_dir):
    """M5 + M19: classification report of the fallback rules (D12) against the labels."""
    from ..ml import models as M
    rep = M.classification_report(label_frame_with_rules(spark, sf_dir), "action_label", "rule_action_label")
    return rep.select("class", "support", *[r6(c).alias(c) for c in ("precision", "recall", "f1")])


@register("m13_urgency_binary_metrics")
def m13_urgency_binary_metrics(spark, sf_dir):
    """Accuracy / precision / recall / F1 / ROC-AUC of urgency >= 50 for look-ahead failures."""
    from ..ml import models as M
    from ..operators import failure as FL
    ds = FL.failure_dataset(zm1_series(spark, sf_dir))
    ds = ds.select("*", (F.col("maintenance_urgency_score") >= 50).cast("int").alias("pred"))
    m = M.binary_metrics(ds, "failure_next_7d", "pred", "maintenance_urgency_score")
    return m.select(*[r6(c).alias(c) for c in m.columns])


@register("m21_urgency_roc_points")
def m21_urgency_roc_points(spark, sf_dir):
    """ROC curve points of the urgency score for look-ahead failures."""
    from ..ml import models as M
    from ..operators import failure as FL
    ds = FL.failure_dataset(zm1_series(spark, sf_dir))
    r = M.roc_points(ds, "failure_next_7d", "maintenance_urgency_score")
    return r.select(*[r6(c).alias(c) for c in r.columns])


@register("m3_stratified_split_sizes")
def m3_stratified_split_sizes(spark, sf_dir):
    """M3: test rows per class of a seeded stratified 80/20 split of the labels."""
    from ..ml import models as M
    lab = d8_label_actions_full(spark, sf_dir)
    s = M.stratified_split(lab, "action_label", 0.2, 42, key=["reading_id"])
    return s.groupBy("action_label").agg(F.count(F.lit(1)).cast("long").alias("rows"),
                                         F.count_if("is_test").cast("long").alias("test_rows"))


@register("m3_stratified_split_rows")
def m3_stratified_split_rows(spark, sf_dir):
    """M3: side of every labelled reading in a seeded stratified 80/20 split."""
    from ..ml import models as M
    lab = d8_label_actions_full(spark, sf_dir)
    s = M.stratified_split(lab, "action_label", 0.2, 42, key=["reading_id"])
    return s.select("reading_id", "action_label", "is_test")


@register("m15_median_imputed")
def m15_median_imputed(spark, sf_dir):
    """M15 + W8: test rows of the trust stack's split with missing values filled by the exact train medians."""
    from ..ml import models as M
    from ..operators import failure as FL
    cols = ["BatteryLevel", "days_since_last_heard", "LineCurrent", "LineTemperature"]
    d = trust_input(spark, sf_dir).where(F.col("Last_Heard").isNotNull())
    split = FL.chrono_split(d, "Last_Heard", 0.8, ["reading_id"])
    _, test = M.median_impute(split.where("is_train"), split.where("NOT is_train"), cols)
    return test.select("reading_id", *[r6(c).alias(c) for c in cols])


@register("m4_class_weights")
def m4_class_weights(spark, sf_dir):
    """M4: balanced weights of the train rows' classes; the test rows take them too."""
    from ..ml import models as M
    s = m3_stratified_split_rows(spark, sf_dir)
    w = M.with_class_weight(s, "action_label", train=~F.col("is_test"))
    return w.groupBy("action_label").agg(F.count(F.lit(1)).alias("rows"), r6(F.min("class_weight")).alias("lowest"),
                                         r6(F.max("class_weight")).alias("highest"))


def offline_label(spark, sf_dir):
    """The trust stack's input with a supplied label: whether the device is offline, unknown for some devices."""
    from ..operators import failure as FL
    known = F.when(F.col("Serial") % 7 != 0, (F.coalesce(F.col("Status"), F.lit("")) == "OFFLINE").cast("int"))
    return FL.rule_score(trust_input(spark, sf_dir)).withColumn("failure_label", known)


@register("m20_rule_baseline_report")
def m20_rule_baseline_report(spark, sf_dir):
    """The rules' report against a supplied label on the test rows; rows without a label are left out."""
    from ..ml import models as M
    _, test, _ = M.trust_split(offline_label(spark, sf_dir), "failure_label")
    rep = M.classification_report(test, "_y", "rule_label")
    return rep.select("class", "support", *[r6(c).alias(c) for c in ("precision", "recall", "f1")])


@register("m16_tree_rules")
def m16_tree_rules(spark, sf_dir):
    """The tree's rules as SQL give the model's prediction for every test row, one rule each."""
    from ..ml import models as M
    from ..ml.rules import apply_rules
    train, test, feats = M.trust_split(offline_label(spark, sf_dir), "failure_label")
    tree = M.trust_tree(train, feats)
    rules = M.tree_rules(spark, tree.stages[-1], feats).collect()  # at most 2 ** 3 leaves
    both = apply_rules(M.predict(tree, test), rules)
    return both.select("reading_id", "rules_met", (F.col("rule_prediction") == F.col("prediction")).cast("int").alias("same"))


@register("m2_action_model_report")
def m2_action_model_report(spark, sf_dir):
    """M1-M6, M9: per-type action forests and their test reports."""
    from ..ml import models as M
    lab = d8_label_actions_full(spark, sf_dir)
    feats = M.feature_cols(lab.drop("reading_id"), M.DEFAULT_DROP + ["reading_id"])
    models = M.train_action_models(lab, M.ActionParams(), feats=feats)
    out = None
    for t, m in models.items():
        rep = M.classification_report(m["test"], "action_label", "prediction").select(
            F.lit(t).alias("device_type"), "*")
        out = rep if out is None else out.unionByName(rep)
    return out


@register("m11_failure_model_importances")
def m11_failure_model_importances(spark, sf_dir):
    """Failure forest, 5-fold ROC-AUC and ranked importances with recommendations."""
    from ..ml import models as M
    from ..operators import failure as FL
    ds = FL.failure_dataset(zm1_series(spark, sf_dir))
    res = M.train_failure_model(ds, FL.ML_FEATURES, M.FailureParams())
    imp = M.importance_table(res["model"], res["features"])
    return imp.join(M.recommendations(imp).select("feature", "recommendation"), "feature", "left").select(
        "*", F.lit(res.get("cv_auc_mean")).alias("cv_auc_mean"))


@register("m24_trust_stack")
def m24_trust_stack(spark, sf_dir):
    """Trust stack (rules -> split -> impute -> tree + forest -> agreement)."""
    from ..ml import models as M
    from ..operators import failure as FL
    scored = FL.rule_score(trust_input(spark, sf_dir))
    res = M.trust_stack(scored)
    return res["test"].select("reading_id", "Serial", "rule_label", "dt_pred", "rf_pred", "dt_prob", "rf_prob",
                              "rule_vs_tree_agree", "rule_vs_forest_agree", "rf_explanation")


@register("j5_export_with_predictions")
def j5_export_with_predictions(spark, sf_dir):
    """Profiles + predicted action (NO_ACTION / 0 when absent) + prediction flags + metadata."""
    from ..operators import export as X_
    from ..operators import timeseries as T
    prof = T.device_profiles(daily(spark, sf_dir)).select("Serial", "Device_Type_Standardized", "risk_score_current",
                                                         "battery_current")
    pred = rule_predictions(spark, sf_dir)
    e = X_.with_predictions(prof, pred, AS_OF)
    flags = pred.select("Serial", "coord_missing_flag", "battery_low_flag", "offline_flag", "days_since_last_report")
    e = X_.join_new_columns(e, flags)
    e = X_.with_metadata(e, AS_OF, "voltwatch")
    return e.select("Serial", "Device_Type_Standardized", r6("risk_score_current").alias("risk_score_current"),
                    r6("battery_current").alias("battery_current"), "PredictedAction", "PredictedActionLabel",
                    F.date_format("PredictionDate", "yyyy-MM-dd").alias("PredictionDate"),
                    *[F.col(c).cast("double").alias(c) for c in ("coord_missing_flag", "battery_low_flag",
                                                                 "offline_flag", "days_since_last_report")],
                    F.date_format("export_date", "yyyy-MM-dd").alias("export_date"), "data_source")


@register("c9_ttl")
def c9_ttl(spark, sf_dir):
    """Time-to-live of the latest reading per device (ZM1 battery / drain, others Unknown)."""
    from ..functions import categories as C
    from ..operators import labels as L
    h = L.canonical_type(A.readings(spark, sf_dir))
    latest = L.latest_per_device(h, "BatteryLatestReport", order_cols=["reading_id"])
    cols = C.ttl(F.col("device_type") == "ZM1", "BatteryLevel", None)
    return latest.select("Serial", "device_type", *[r6(c).alias(n) if n != "ttl_category" else c.alias(n)
                                                    for n, c in cols.items()])


@register("w6_history_dedupe")
def w6_history_dedupe(spark, sf_dir):
    """W6/ST2/T33: one row per (Serial, report time) keeping the last ingested row;
    report time falls back to Last_Heard, then the batch date."""
    from ..operators.common import dedupe_keep
    r = A.readings(spark, sf_dir)
    key = F.coalesce(F.col("BatteryLatestReport"), F.col("Last_Heard"), F.col("batch_date").cast("timestamp"))
    d = dedupe_keep(r.select("*", key.alias("report_key")), ["Serial", "report_key"], [F.col("reading_id")], "last")
    return d.select("Serial", F.date_format("report_key", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("report_key"),
                    "reading_id")


@register("a15_reconfigure_counts")
def a15_reconfigure_counts(spark, sf_dir):
    """Reconfigure attempts and the last attempt per device."""
    c = H.reconfigure_counts(A.attempts(spark, sf_dir))
    return c.select("Serial", "reconfigure_count",
                    F.date_format("last_reconfigure_time", "yyyy-MM-dd").alias("last_reconfigure_time"))


# fixed values: raw device-type spellings used to exercise canonicalisation
RAW_TYPES = ["ZM1", " um3 ", "M3", "U-M3", "None", "", None, "mm3", "UM3+", "NULL", "nan", "zm-1", "X9"]


@register("p8_device_types")
def p8_device_types(spark, sf_dir):
    """Canonical type A and standard type B of dirty spellings, per reading."""
    from ..functions import exprs as X
    ev = A.table(spark, sf_dir, "events")
    spell = F.element_at(F.array(*[F.lit(v).cast("string") for v in RAW_TYPES]),
                         (F.col("user_id") % len(RAW_TYPES) + 1).cast("int"))
    d = ev.select(F.col("event_id").alias("reading_id"), spell.alias("raw_type"))
    return d.select("reading_id", "raw_type", X.device_type_a("raw_type").alias("type_a"),
                    X.device_type_b(X.device_type_upper(F.col("raw_type"))).alias("type_b"),
                    X.device_type_b(X.device_type_upper(F.col("raw_type")), "Unknown").alias("type_b_unknown"))


from . import dirty, whole  # noqa: E402,F401 - register their queries here
