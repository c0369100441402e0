"""Health features, per-type risk scores and risk reasons (A1, A2, P21-P24, W1,
J1, J3, D1-D7, D4 router).

Plan shape: scan -> conform (one projection) -> snapshot aggregate per
(batch, type) -> size-checked broadcast back -> install join -> derived
columns -> min/max aggregate per (batch, type) -> broadcast back -> GPS lag
on a (device, day) window -> one projection of scores and reasons.  Both
statistics tables are partial (map-side) aggregates; the only shuffle of the
readings themselves is the lag window.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import exprs as X
from .common import attach_stats, two_level_lag

TYPE_STD = "Device_Type_Standardized"


# ----------------------------------------------------------------- conform --

def _dtype(df: DataFrame, name: str) -> str:
    return dict(df.dtypes).get(name, "string")


def rename_aliases(df: DataFrame) -> DataFrame:
    """Misspelled temperature columns -> LineTemperature."""
    if "LineTemperature" in df.columns:
        return df
    for alias in config.TEMPERATURE_ALIASES:
        if alias in df.columns:
            return df.withColumnRenamed(alias, "LineTemperature")
    return df


def conform_readings(df: DataFrame) -> DataFrame:
    """One projection that types every field the scorers read.

    Raw columns are kept as they came (the contract lists ``LineCurrent`` and
    ``Last_Heard`` raw); typed twins carry a leading underscore.  Absent
    inputs become typed nulls so later code never branches on presence.
    """
    if "Device_Type" not in df.columns:
        raise ValueError("Input DataFrame must contain a 'Device_Type' column.")
    df = rename_aliases(df)
    cols = set(df.columns)

    def num(name):
        return X.to_num(F.col(name)) if name in cols else F.lit(None).cast("double")

    def ts(name):
        return X.to_ts_any(F.col(name), _dtype(df, name)) if name in cols else F.lit(None).cast("timestamp")

    def missing(name):
        return X.is_missing_raw(F.col(name), _dtype(df, name)) if name in cols else F.lit(True)

    dev = X.device_type_upper(F.col("Device_Type"))
    extra = [
        dev.alias("Device_Type"),
        X.device_type_b(dev).alias(TYPE_STD),
        ts("Last_Heard").alias("Last_Heard_dt"),
        (missing("Last_Heard") if "Last_Heard" in cols else F.lit(True)).alias("_lh_raw_missing"),
        (F.coalesce(X.to_num(F.col("Latitude")), F.lit(None).cast("double")) if "Latitude" in cols
         else F.lit(0.0)).alias("Latitude"),
        (X.to_num(F.col("Longitude")) if "Longitude" in cols else F.lit(0.0)).alias("Longitude"),
        num("BatteryLevel").alias("_battery"),
        missing("BatteryLevel").alias("_battery_missing"),
        ts("BatteryLatestReport").alias("BatteryLatestReport_dt"),
        num("LineCurrent").alias("_current"),
        missing("LineCurrent").alias("_current_missing"),
        num("LineTemperature").alias("_temperature"),
        missing("LineTemperature").alias("_temperature_missing"),
    ]
    replaced = {"Device_Type", "Latitude", "Longitude"}
    keep = [F.col(c) for c in df.columns if c not in replaced]
    return df.select(*keep, *extra)


# ------------------------------------------------------------ normalisation --

def _capped(c: Column, cap: float | None) -> Column:
    return c if cap is None else X.clip(c, hi=cap)


def _norm(c: Column, cap: float | None, mn: str, mx: str) -> Column:
    """Min-max normalise with a batch min/max; constant or all-missing -> 0 (A2)."""
    lo, hi = F.col(mn), F.col(mx)
    return F.when(lo.isNull() | hi.isNull() | (hi == lo), F.lit(0.0)).otherwise(
        (_capped(c, cap) - lo) / (hi - lo))


NORMALISED = {
    # name: (column, cap)
    "comm": ("comm_age_days", 365.0),
    "report": ("battery_report_age_days", 180.0),
    "life": ("pct_life_used", 1.0),
    "aabr": ("age_adjusted_battery_risk", 100.0),
    "urgency": ("maintenance_urgency_score", 1.0),
    "current": ("LineCurrent_val", 1000.0),
    "temp": ("LineTemperature_val", 100.0),
    "flags": ("_mm3_flag_sum", None),
}


def normalize(df: DataFrame, column: str, cap: float | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Stand-alone A2: ``<column>_norm`` over groups ``by`` (empty = whole frame)."""
    c = _capped(F.col(column), cap)
    stats = df.groupBy(*by).agg(F.min(c).alias("__mn"), F.max(c).alias("__mx"))
    out = attach_stats(df, stats, by)
    return out.select(*df.columns, _norm(F.col(column), cap, "__mn", "__mx").alias(f"{column}_norm"))


# ------------------------------------------------------------------- router --

def _install_table(install: DataFrame, dedupe: bool) -> DataFrame:
    inst = install.select(F.col("Serial"), X.to_ts_any(F.col("InstallDate"), _dtype(install, "InstallDate"))
                          .alias("InstallDate_dt"))
    if dedupe:
        inst = inst.groupBy("Serial").agg(F.max("InstallDate_dt").alias("InstallDate_dt"))
    return inst


def reconfigure_counts(attempts: DataFrame, as_of: str | None = None, days_back: int | None = None) -> DataFrame:
    """Attempts per device and the last attempt (A15); optional look-back window."""
    a = attempts.select("Serial", X.to_ts_any(F.col("attempt_date"), _dtype(attempts, "attempt_date"))
                        .alias("attempt_dt"))
    if days_back is not None and as_of is not None:
        a = a.where(F.col("attempt_dt") >= F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(days_back)} DAYS"))
    return a.groupBy("Serial").agg(F.count(F.lit(1)).cast("int").alias("reconfigure_count"),
                                   F.max("attempt_dt").alias("last_reconfigure_time"))


def with_reconfigure(df: DataFrame, attempts: DataFrame | None) -> DataFrame:
    """Left join attempt counts; missing -> 0, attempted = count > 0."""
    if attempts is None:
        return df.select("*", F.lit(0).alias("reconfigure_count"),
                         F.lit(False).alias("reconfigure_attempted"),
                         F.lit(None).cast("timestamp").alias("last_reconfigure_time"))
    j = df.join(reconfigure_counts(attempts), "Serial", "left")
    rc = F.coalesce(F.col("reconfigure_count"), F.lit(0))
    return j.select(*[c for c in j.columns if c != "reconfigure_count"], rc.alias("reconfigure_count"),
                    (rc > 0).alias("reconfigure_attempted"))


# ---------------------------------------------------- shared row formulas --
# The per-row features and the single-pass statistics use the same builders,
# so the derived extremes are bit-identical to the per-row values.

def _f_comm(snap: Column, lh: Column) -> Column:
    return X.clip(X.days_between(snap, lh), hi=365.0)


def _f_report(snap_bt: Column, blr: Column) -> Column:
    return F.coalesce(X.days_between(snap_bt, blr), F.lit(0.0))


def _f_life(snap: Column, inst: Column, lifetime: Column) -> Column:
    return X.clip(F.coalesce(X.clip(X.days_between(snap, inst) / lifetime, 0.0, 1.0), F.lit(0.0)), hi=1.0)


def _f_months(snap: Column, inst: Column) -> Column:
    return F.coalesce(X.days_between(snap, inst) / config.DAYS_PER_MONTH, F.lit(0.0))


def _f_aabr(rate: Column, months: Column) -> Column:
    return X.clip(F.coalesce(rate * (months / 24.0), F.lit(0.0)), hi=100.0)


def _f_urgency(rate: Column, months: Column) -> Column:
    age_comp = X.clip(F.coalesce(months / 120.0, F.lit(0.0)), hi=1.0)
    bat_comp = X.clip(rate / 20.0, hi=1.0)
    return X.np_round(X.clip(age_comp * 0.4 + bat_comp * 0.6, hi=1.0), 3)


def _f_cur(c: Column) -> Column:
    return X.clip(F.coalesce(c, F.lit(0.0)), hi=1000.0)


def _f_temp(c: Column) -> Column:
    return X.clip(F.coalesce(c, F.lit(0.0)), hi=100.0)


def _single_pass_stats(d: DataFrame, gkeys: Sequence[str], batch: Sequence[str], snapshot_scope: str,
                       has_install: bool) -> DataFrame:
    """Snapshots and min-max statistics of every normalised input from one
    aggregate of raw extremes per (batch, type).  Each input is a monotone
    function of one raw column (comm and report age fall with the timestamp,
    life / age terms with the install date, current and temperature rise
    with the reading), and missing raw values map to one constant, so
    min / max follow from min / max / null-count of the raw column."""
    is_mm3_row = F.col(TYPE_STD) == "MM3"
    fsum = ((_f_cur(F.col("_current")) > config.MM3_CURRENT_WARNING).cast("double")
            + (_f_cur(F.col("_current")) > config.MM3_CURRENT_CRITICAL).cast("double")
            + (_f_temp(F.col("_temperature")) > config.TEMP_LIMITS_C["MM3"]).cast("double"))
    raw = d.groupBy(*gkeys).agg(
        F.max("Last_Heard_dt").alias("_snap_bt"), F.min("Last_Heard_dt").alias("_lh_min"),
        F.count(F.lit(1)).alias("_n"),
        F.max("BatteryLatestReport_dt").alias("_blr_max"), F.min("BatteryLatestReport_dt").alias("_blr_min"),
        F.count("BatteryLatestReport_dt").alias("_n_blr"),
        F.max("InstallDate_dt").alias("_inst_max"), F.min("InstallDate_dt").alias("_inst_min"),
        F.count("InstallDate_dt").alias("_n_inst"),
        F.min("_current").alias("_cur_min"), F.max("_current").alias("_cur_max"), F.count("_current").alias("_n_cur"),
        F.min("_temperature").alias("_tmp_min"), F.max("_temperature").alias("_tmp_max"),
        F.count("_temperature").alias("_n_tmp"),
        F.min(F.when(is_mm3_row, fsum).otherwise(F.lit(0.0))).alias("_mn_flags"),
        F.max(F.when(is_mm3_row, fsum).otherwise(F.lit(0.0))).alias("_mx_flags"),
    )
    s = raw.select("*", F.max("_snap_bt").over(Window.partitionBy(*batch)).alias("_snap_b"))
    snap = F.col("_snap_b") if snapshot_scope == "batch" else F.col("_snap_bt")
    t = F.col("_stat_type")
    zero = F.lit(0.0)

    def with_null(v: Column, n_col: str) -> Column:
        return F.when(F.col("_n") > F.col(n_col), zero)

    rate = X.clip(F.lit(0.0) * 365.0, lo=0.1)  # observed model without a drain column
    if has_install:
        life_lo = F.least(_f_life(snap, F.col("_inst_max"), X.expected_lifetime(t)), with_null(zero, "_n_inst"))
        life_hi = F.greatest(_f_life(snap, F.col("_inst_min"), X.expected_lifetime(t)), with_null(zero, "_n_inst"))
        months_lo = F.least(_f_months(snap, F.col("_inst_max")), with_null(zero, "_n_inst"))
        months_hi = F.greatest(_f_months(snap, F.col("_inst_min")), with_null(zero, "_n_inst"))
    else:
        life_lo = life_hi = zero
        months_lo = months_hi = zero
    zm1, mm3 = t == "ZM1", t == "MM3"
    rep_lo = F.least(_f_report(F.col("_snap_bt"), F.col("_blr_max")), with_null(zero, "_n_blr"))
    rep_hi = F.greatest(_f_report(F.col("_snap_bt"), F.col("_blr_min")), with_null(zero, "_n_blr"))
    cols = {
        "_mn_comm": _f_comm(snap, F.col("_snap_bt")), "_mx_comm": _f_comm(snap, F.col("_lh_min")),
        "_mn_report": F.when(zm1, X.clip(rep_lo, hi=180.0)).otherwise(zero),
        "_mx_report": F.when(zm1, X.clip(rep_hi, hi=180.0)).otherwise(zero),
        "_mn_life": life_lo, "_mx_life": life_hi,
        "_mn_aabr": F.when(zm1, _f_aabr(rate, months_lo)).otherwise(zero),
        "_mx_aabr": F.when(zm1, _f_aabr(rate, months_hi)).otherwise(zero),
        "_mn_urgency": F.when(zm1, _f_urgency(rate, months_lo)).otherwise(zero),
        "_mx_urgency": F.when(zm1, _f_urgency(rate, months_hi)).otherwise(zero),
        "_mn_current": F.when(mm3, F.least(_f_cur(F.col("_cur_min")), with_null(zero, "_n_cur"))).otherwise(zero),
        "_mx_current": F.when(mm3, F.greatest(_f_cur(F.col("_cur_max")), with_null(zero, "_n_cur"))).otherwise(zero),
        "_mn_temp": F.when(mm3, F.least(_f_temp(F.col("_tmp_min")), with_null(zero, "_n_tmp"))).otherwise(zero),
        "_mx_temp": F.when(mm3, F.greatest(_f_temp(F.col("_tmp_max")), with_null(zero, "_n_tmp"))).otherwise(zero),
    }
    return s.select(*gkeys, "_snap_bt", "_snap_b", *[c.alias(n) for n, c in cols.items()], "_mn_flags", "_mx_flags")


def design_drain_per_day() -> Column:
    """Battery drain by design, from the expected lifetime and the share of it that is used."""
    safe_life = X.clip(F.coalesce(F.col("expected_lifetime_days").cast("double"),
                                  F.lit(float(config.DEFAULT_LIFETIME_DAYS))), 365.0, 36500.0)
    base_yearly = F.lit(100.0) / (safe_life / 365.0)
    aging = F.lit(1.0) + F.pow(F.coalesce(F.col("pct_life_used"), F.lit(0.0)), 2) * 2.0
    return (base_yearly / 365.0) * aging


def build_health_features(df: DataFrame, install: DataFrame | None = None, attempts: DataFrame | None = None,
                          batch_cols: Sequence[str] = ("batch_date",), snapshot_scope: str = "batch",
                          drain_model: str = "observed", install_dedupe: bool = True,
                          order_cols: Sequence[str] = (), stats_mode: str = "auto") -> DataFrame:
    """Standardise, conform, ages, GPS drift, per-type scores, risk and reason.

    ``batch_cols`` is the scope of snapshots and min-max statistics (one
    daily file = one batch); an empty list scores the frame as one batch.
    ``snapshot_scope`` is ``"batch"`` (device/comm ages vs the batch's latest
    reading) or ``"batch_type"``.  ``drain_model`` is ``"observed"`` (parity)
    or ``"design"`` (T2).  With a drain column the observed model is chosen by batch:
    where no ZM1 reading of the batch has a drain, its ZM1 devices drain by design (D6).  ``order_cols`` breaks ties in time order (file row
    order).  ``stats_mode="two_pass"`` forces the generic statistics path
    (the default picks one pass whenever the drain is constant).
    """
    raw_cols = set(df.columns)
    has_battery_col = "BatteryLevel" in raw_cols
    has_current_col = "LineCurrent" in raw_cols
    has_temp_col = "LineTemperature" in raw_cols or any(a in raw_cols for a in config.TEMPERATURE_ALIASES)
    has_drain_col = "battery_drain_rate_per_day" in raw_cols
    has_coord_missing = "coord_missing_flag" in raw_cols
    batch = [c for c in batch_cols]
    # statistics group: the three scored types, everything else as one group
    # (unknown types score 0 and never read the statistics): at most 4 rows
    # per batch, materialised once and broadcast
    gkeys = batch + ["_stat_type"]

    d = conform_readings(df)
    d = d.select("*", F.when(F.col(TYPE_STD).isin("ZM1", "UM3", "MM3"), F.col(TYPE_STD))
                 .otherwise(F.lit("OTHER")).alias("_stat_type"))
    is_zm1 = F.col(TYPE_STD) == "ZM1"
    is_um3 = F.col(TYPE_STD) == "UM3"
    is_mm3 = F.col(TYPE_STD) == "MM3"

    def with_lag(rows: DataFrame) -> DataFrame:
        # W1 GPS drift in hour buckets of a device (skew-safe lag); unparseable timestamps sort last as in pandas
        order = [F.col("Last_Heard_dt")] + [F.col(c) for c in order_cols]
        bucket = F.coalesce(F.floor(F.unix_micros(F.col("Last_Heard_dt")) / F.lit(3600 * 1_000_000)),
                            F.lit(2 ** 62)).cast("long")
        lagged = two_level_lag(rows, batch + ["Serial"], bucket, order, ["Latitude", "Longitude"], prefix="prev_",
                               skip_null=["Serial"])
        return lagged.withColumnsRenamed({"prev_Latitude": "prev_lat", "prev_Longitude": "prev_lon"})

    # The lag comes first: both of its branches read the readings alone, and only raw columns travel through its
    # shuffle. Where a device may have several install dates its readings multiply, and the lag follows the join.
    first_lag = install is None or install_dedupe
    read = d
    if first_lag:
        d = with_lag(d)

    # J1 install dates (before the statistics: their extremes feed the ages)
    if install is not None:
        # dimension join: Spark's size estimate picks broadcast, else a
        # shuffle join that AQE splits when one device is hot
        dates = _install_table(install, install_dedupe)
        read, d = read.join(dates, "Serial", "left"), d.join(dates, "Serial", "left")
    else:
        read, d = [x.select("*", F.lit(None).cast("timestamp").alias("InstallDate_dt")) for x in (read, d)]

    # With a constant drain (the parity default) every normalised input is a
    # monotone function of one raw column, so all statistics come from one
    # pass of raw extremes; other drain models take a second pass.
    single_pass = drain_model == "observed" and not has_drain_col and stats_mode != "two_pass"
    if single_pass:
        stats = _single_pass_stats(read, gkeys, batch, snapshot_scope, install is not None)
        ranges = [c for c in stats.columns if c.startswith(("_mn_", "_mx_"))]
        if first_lag:
            d, stats2 = attach_stats(d, stats.select(*gkeys, "_snap_bt", "_snap_b", *ranges), gkeys), None
        else:  # the min/max columns do not travel through the lag's shuffle
            d, stats2 = attach_stats(d, stats.select(*gkeys, "_snap_bt", "_snap_b"), gkeys), stats.select(*gkeys, *ranges)
    else:
        # A1 snapshots: latest reading per (batch, type) and per batch.
        # With them whether the batch's devices of a type report any drain at all.
        drains = X.to_num(F.col("battery_drain_rate_per_day")).isNotNull() if has_drain_col else F.lit(False)
        snaps = read.groupBy(*gkeys).agg(F.max("Last_Heard_dt").alias("_snap_bt"), F.max(drains).alias("_drain_seen"))
        # per-batch snapshot on the small table (<= 4 rows per batch), no self-join rescan
        snaps = snaps.select("*", F.max("_snap_bt").over(Window.partitionBy(*batch)).alias("_snap_b"))
        d = attach_stats(d, snaps, gkeys)
    snap = F.col("_snap_b") if snapshot_scope == "batch" else F.col("_snap_bt")

    lifetime = X.expected_lifetime(F.col(TYPE_STD))
    comm = _f_comm(snap, F.col("Last_Heard_dt"))
    if install is not None:
        age_days = X.days_between(snap, "InstallDate_dt")
        life = _f_life(snap, F.col("InstallDate_dt"), lifetime)
    else:
        age_days = F.lit(None).cast("double")
        life = F.lit(0.0)

    # ZM1 battery, drain and urgency
    battery = F.col("_battery")
    report_age = _f_report(F.col("_snap_bt"), F.col("BatteryLatestReport_dt"))
    months = F.coalesce(F.col("device_age_days") / config.DAYS_PER_MONTH, F.lit(0.0))
    if drain_model not in ("observed", "design"):
        raise ValueError(f"unknown drain_model {drain_model!r}")
    per_day = design_drain_per_day()
    if drain_model == "observed":
        if has_drain_col:
            observed = F.coalesce(X.to_num(F.col("battery_drain_rate_per_day")), F.lit(config.DEFAULT_DRAIN_PER_DAY))
            per_day = F.when(F.col("_drain_seen"), observed).otherwise(per_day)
        else:
            per_day = F.lit(0.0)
    rate = per_day * 365.0
    per_day = X.clip(per_day, lo=0.1 / 365.0)
    rate = X.clip(rate, lo=0.1)

    # MM3 line values and flags (D3)
    cur = _f_cur(F.col("_current"))
    temp = _f_temp(F.col("_temperature"))

    d = d.select(
        "*",
        comm.alias("comm_age_days"),
        age_days.alias("device_age_days"),
        lifetime.alias("expected_lifetime_days"),
    )
    d = d.select("*", life.alias("pct_life_used"))
    zero = F.lit(0)
    d = d.select(
        "*",
        F.when(is_zm1, battery).alias("battery_level"),
        F.when(is_zm1, X.flag(battery < config.ZM1_BATTERY_CRITICAL)).otherwise(zero).alias("battery_low_flag"),
        F.when(is_zm1, X.flag(battery < config.ZM1_BATTERY_WARNING)).otherwise(zero).alias("battery_warning_flag"),
        F.when(is_zm1, report_age).otherwise(F.lit(0.0)).alias("battery_report_age_days"),
        F.when(is_zm1, months).otherwise(F.lit(0.0)).alias("device_age_months"),
        F.when(is_mm3, cur).otherwise(F.lit(0.0)).alias("LineCurrent_val"),
        F.when(is_mm3, temp).otherwise(F.lit(0.0)).alias("LineTemperature_val"),
    )
    d = d.select(
        "*",
        F.when(is_zm1, per_day).otherwise(F.lit(0.0)).alias("battery_drain_rate_per_day"),
        F.when(is_zm1, rate).otherwise(F.lit(0.0)).alias("battery_drain_rate"),
        F.when(is_zm1, F.lit(1.0) + F.pow(F.col("pct_life_used"), 2) * 2.0).alias("aging_acceleration_factor"),
    ) if not has_drain_col else d.select(
        *[c for c in d.columns if c != "battery_drain_rate_per_day"],
        F.when(is_zm1, per_day).otherwise(X.to_num(F.col("battery_drain_rate_per_day"))
                                          ).alias("battery_drain_rate_per_day"),
        F.when(is_zm1, rate).otherwise(F.lit(0.0)).alias("battery_drain_rate"),
        F.when(is_zm1, F.lit(1.0) + F.pow(F.col("pct_life_used"), 2) * 2.0).alias("aging_acceleration_factor"),
    )
    mm3_flags = {
        "zero_current_flag": F.col("LineCurrent_val") == 0.0,
        "low_current_flag": (F.col("LineCurrent_val") > 0) & (F.col("LineCurrent_val") < config.MM3_CURRENT_MIN_NORMAL),
        "high_current_flag": F.col("LineCurrent_val") > config.MM3_CURRENT_WARNING,
        "critical_current_flag": F.col("LineCurrent_val") > config.MM3_CURRENT_CRITICAL,
        "high_offpeak_flag": F.col("LineCurrent_val") > config.MM3_CURRENT_OFF_PEAK_MAX,
        "overheat_flag": F.col("LineTemperature_val") > config.TEMP_LIMITS_C["MM3"],
    }
    aabr = _f_aabr(F.col("battery_drain_rate"), F.col("device_age_months"))
    urgency = _f_urgency(F.col("battery_drain_rate"), F.col("device_age_months"))
    d = d.select(
        "*",
        F.col("aging_acceleration_factor").alias("battery_degradation_factor"),
        *[F.when(is_mm3, X.flag(cond)).otherwise(zero).alias(name) for name, cond in mm3_flags.items()],
        F.when(is_zm1, aabr).otherwise(F.lit(0.0)).alias("age_adjusted_battery_risk"),
        F.when(is_zm1, urgency).otherwise(F.lit(0.0)).alias("maintenance_urgency_score"),
    )
    d = d.select("*", (F.col("high_current_flag") + F.col("critical_current_flag") + F.col("overheat_flag"))
                 .cast("double").alias("_mm3_flag_sum"))

    if not single_pass:
        # A2 min/max of every normalised input per (batch, type): one partial aggregate.
        aggs = []
        for key, (name, cap) in NORMALISED.items():
            c = _capped(F.col(name), cap)
            aggs += [F.min(c).alias(f"_mn_{key}"), F.max(c).alias(f"_mx_{key}")]
        stats2 = d.groupBy(*gkeys).agg(*aggs)

    if not first_lag:
        d = with_lag(d)
    dist = F.when(F.col("prev_lat").isNull() | F.col("prev_lon").isNull(), F.lit(0.0)).otherwise(
        X.haversine("prev_lat", "prev_lon", "Latitude", "Longitude"))
    d = d.select("*", dist.alias("distance_drift_m"))
    d = d.select("*", X.flag(F.col("distance_drift_m") > config.GPS_JUMP_THRESHOLD_M).alias("gps_jump_flag"))

    if stats2 is not None:
        d = attach_stats(d, stats2, gkeys)

    # normalised inputs once per row (each feeds up to three type scores)
    d = d.select("*", *[_norm(F.col(name), cap, f"_mn_{key}", f"_mx_{key}").alias(f"_n_{key}")
                        for key, (name, cap) in NORMALISED.items()])

    def n(key):
        return F.col(f"_n_{key}")

    lh_missing = F.col("Last_Heard_dt").isNull()
    inst_missing = F.col("InstallDate_dt").isNull()
    life_hi = F.col("pct_life_used") > 0.9
    cm = F.col("comm_age_days")

    def pts(cond: Column, v: float) -> Column:
        return F.when(F.coalesce(cond, F.lit(False)), F.lit(v)).otherwise(F.lit(0.0))

    zm1 = ((n("comm") * 0.25 + n("report") * 0.25 + n("life") * 0.20 + n("aabr") * 0.20 + n("urgency") * 0.10)
           * 100.0
           + F.col("battery_low_flag") * 30.0 + pts(life_hi, 20.0)
           + pts(F.col("battery_report_age_days") > 180, 15.0)
           + pts(lh_missing, 30.0) + pts(inst_missing, 25.0)
           + (pts(F.col("_battery_missing"), 20.0) if has_battery_col else F.lit(0.0)))
    um3 = ((n("comm") * 0.70 + n("life") * 0.30) * 100.0
           + pts(life_hi, 25.0) + pts(cm > 7, 20.0) + pts(cm > 30, 40.0)
           + pts(lh_missing, 50.0) + pts(inst_missing, 20.0))
    mm3 = ((n("comm") * 0.30 + n("current") * 0.20 + n("temp") * 0.15 + n("life") * 0.20 + n("flags") * 0.15)
           * 100.0
           + F.col("overheat_flag") * 20.0 + F.col("critical_current_flag") * 25.0
           + F.col("high_current_flag") * 15.0 + F.col("low_current_flag") * 10.0
           + F.col("high_offpeak_flag") * 12.0 + pts(life_hi, 25.0) + F.col("zero_current_flag") * 30.0
           + pts(lh_missing, 30.0) + pts(inst_missing, 20.0)
           + (pts(F.col("_current_missing"), 15.0) if has_current_col else F.lit(0.0))
           + (pts(F.col("_temperature_missing"), 10.0) if has_temp_col else F.lit(0.0)))

    d = d.select(
        "*",
        F.when(is_zm1, X.clamp_missing_high(zm1)).otherwise(F.lit(0.0)).alias("risk_score_zm1"),
        F.when(is_um3, X.clamp_missing_high(um3)).otherwise(F.lit(0.0)).alias("risk_score_um3"),
        F.when(is_mm3, X.clamp_missing_high(mm3)).otherwise(F.lit(0.0)).alias("risk_score_mm3"),
    )
    placeholders = ["current_variance", "temp_variance", "zero_current_frequency", "overheat_frequency",
                    "comm_fail_frequency", "gps_jump_frequency"]
    d = d.select(
        *[c for c in d.columns if c != "comm_age_days"],
        X.np_round(F.greatest("risk_score_zm1", "risk_score_um3", "risk_score_mm3"), 2).alias("risk_score"),
        X.np_round(F.col("comm_age_days"), 1).alias("comm_age_days"),
        F.lit(0).alias("temperature_exceedence_count"),
        F.lit(0).alias("old_and_hot_flag"),
        *[F.lit(0.0).alias(p) for p in placeholders],
    )
    d = with_reconfigure(d, attempts)
    coord_missing = F.col("coord_missing_flag") if has_coord_missing else F.lit(0)
    d = with_risk_reason(d, coord_missing)
    helpers = [c for c in d.columns if c.startswith("_")]
    return d.drop(*helpers)


# ------------------------------------------------------------------ reasons --

def _if(cond: Column, text: Column | str) -> Column:
    t = F.lit(text) if isinstance(text, str) else text
    return F.when(F.coalesce(cond, F.lit(False)), t)


def _txt(key: str, *nums: Column) -> Column:
    """Reason text from ``config.REASON_TEXT`` with formatted numbers spliced in."""
    parts = config.REASON_TEXT[key].split("{}")
    out = [F.lit(parts[0])]
    for n, tail in zip(nums, parts[1:]):
        out += [n, F.lit(tail)]
    return F.concat(*out) if len(out) > 1 else out[0]


def with_risk_reason(df: DataFrame, coord_missing_flag: Column) -> DataFrame:
    """D5 reason text (see survey 9.1): reasons joined with ', '.

    Built in a few projections so every intermediate (formatted numbers,
    reason arrays) is computed once per row instead of being re-inlined.
    """
    rc = F.col("reconfigure_count")
    cm = F.col("comm_age_days")
    drain = F.col("battery_drain_rate")
    d = df.select(
        "*",
        X.py_fixed(F.col("LineCurrent_val"), 1).alias("_cur_txt"),
        X.py_fixed(F.col("LineTemperature_val"), 1).alias("_temp_txt"),
        X.py_fixed(cm, 0).alias("_cm_txt"),
        X.py_fixed(drain, 0).alias("_drain_txt"),
        X.py_fixed(F.col("pct_life_used") * 10.0, 1).alias("_years_txt"),
        (coord_missing_flag == 1).alias("_coord"),
    )
    lh_missing = F.col("Last_Heard_dt").isNull() | F.col("_lh_raw_missing")
    gps = F.col("gps_jump_flag") == 1
    coord = F.col("_coord")
    life_hi = F.col("pct_life_used") > 0.9
    common = [
        _if(rc == 1, _txt("reconf_once")),
        _if(rc > 1, _txt("reconf_many", rc.cast("string"))),
        _if(rc >= 2, _txt("reconf_multiple")),
        _if(lh_missing, _txt("missing_last_heard")),
        _if(gps, _txt("gps_drift")),
        _if(coord, _txt("gps_missing")),
    ]
    bat_missing, bat_low = F.col("_battery_missing"), F.col("battery_low_flag") == 1
    zm1 = [
        _if(drain > 40, _txt("zm1_drain_fast", F.col("_drain_txt"))),
        _if((drain <= 40) & (drain > 20), _txt("zm1_drain_faster", F.col("_drain_txt"))),
        _if(bat_missing, _txt("zm1_battery_missing")),
        _if(~bat_missing & bat_low & (rc == 0), _txt("zm1_battery_low")),
        _if(~bat_missing & bat_low & (rc > 0), _txt("zm1_battery_low_after")),
    ]
    crit = F.col("critical_current_flag") == 1
    hot = F.col("overheat_flag") == 1
    high = F.col("high_current_flag") == 1
    low = F.col("low_current_flag") == 1
    cur_txt, temp_txt, cm_txt = F.col("_cur_txt"), F.col("_temp_txt"), F.col("_cm_txt")
    first_match = (F.when(crit, _txt("mm3_critical", cur_txt))
                   .when(hot & (rc == 0), _txt("mm3_overheat", temp_txt))
                   .when(hot, _txt("mm3_overheat_after"))
                   .when(high, _txt("mm3_high", cur_txt))
                   .when(low, _txt("mm3_low", cur_txt)))
    um3 = [
        _if((cm > 30) & (rc == 0), _txt("um3_no_comm", cm_txt)),
        _if((cm > 90) & (rc > 0), _txt("um3_no_comm_after")),
        _if((cm <= 90) & (cm > 30) & (rc > 0), _txt("um3_comm_persists")),
        _if((cm <= 30) & (cm > 7), _txt("um3_comm_delay", cm_txt)),
        _if(gps, _txt("gps_drift")),
        _if(coord, _txt("gps_missing")),
        _if(life_hi, _txt("um3_life")),
    ]
    suffix = F.concat_ws(
        " | ",
        _if(life_hi, _txt("mm3_life", F.col("_years_txt"))),
        _if(cm > 90, _txt("mm3_no_comm", cm_txt)),
        _if((cm <= 90) & (cm > 30), _txt("mm3_comm_gap", cm_txt)),
    )
    dev = F.col("Device_Type")
    notnull = lambda x: x.isNotNull()
    typed = (F.when(dev.contains("ZM1"), F.array(*zm1))
             .when(dev.contains("MM3"), F.array(first_match))
             .when(dev.contains("UM3"), F.array(*um3)))
    d = d.select("*", F.filter(F.array(*common), notnull).alias("_common"),
                 F.filter(F.coalesce(typed, F.array().cast("array<string>")), notnull).alias("_typed"),
                 suffix.alias("_suffix"))
    # MM3: zero / off-peak only when nothing else was said, then life/comm are
    # appended to the first reason with " | ".
    d = d.select("*", F.concat("_common", "_typed").alias("_base"))
    zero_or_peak = (F.when(F.col("zero_current_flag") == 1, _txt("mm3_zero"))
                    .when(F.col("high_offpeak_flag") == 1, _txt("mm3_offpeak")))
    base = F.col("_base")
    d = d.select("*", F.when((F.size(base) == 0) & zero_or_peak.isNotNull(), F.array(zero_or_peak))
                 .otherwise(base).alias("_mm3_base"))
    mb, sfx = F.col("_mm3_base"), F.col("_suffix")
    mm3_list = (F.when(sfx == "", mb)
                .when(F.size(mb) == 0, F.array(sfx))
                .otherwise(F.concat(F.array(F.concat(mb[0], F.lit(" | "), sfx)),
                                    F.slice(mb, 2, F.greatest(F.size(mb) - 1, F.lit(1))))))
    final = F.when(dev.contains("ZM1"), base).when(dev.contains("MM3"), mm3_list).otherwise(base)
    d = d.select("*", final.alias("_reasons"))
    r = F.col("_reasons")
    return d.select("*", F.when(F.size(r) == 0, _txt("normal")).otherwise(F.array_join(r, ", ")).alias("risk_reason"))


def get_top_risk_devices(df: DataFrame, n: int = 15, tiebreak: Sequence[str] = ()) -> DataFrame:
    """O1: positive risk only, highest first (Serial, then ``tiebreak`` break ties), first ``n``.
    ``orderBy + limit`` plans as TakeOrdered: a per-partition top-n, never a full sort."""
    if "risk_score" not in df.columns:
        raise ValueError("risk_score not found. Did you call build_health_features()?")
    # positive scores come first in this order, so the filter may follow the limit; before it, Spark moves it under the score
    return (df.orderBy(F.col("risk_score").desc(), F.col("Serial"), *[F.col(c) for c in tiebreak]).limit(n)
            .where(F.col("risk_score") > 0.0))
