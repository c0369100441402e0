"""Maintenance-action labels and rule predictions (D8-D12, D15-D17, W2, W5,
J2, P16, P18-P21, P24, A12).

Rules are "last writer wins" in the reference; each type's rules compile to
one ``when`` chain in reverse write order.  Global quantities (latest
timestamp) are one-row aggregates joined back by broadcast.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import exprs as X
from .common import two_level_lag

NO, RECONF, REPLACE = "NO_ACTION", "RECONFIGURE", "REPLACE"
def label_of(name: Column) -> Column:
    """Action name -> label id (fixed label map)."""
    return F.create_map(*[x for k, v in config.ACTION_LABELS.items() for x in (F.lit(v), F.lit(k))])[name]


def _first(df: DataFrame, names: Sequence[str]) -> str | None:
    return X.first_present(df.columns, names)


def _dtype(df: DataFrame, name: str) -> str:
    return dict(df.dtypes)[name]


def status_flags(status: Column) -> list[Column]:
    """Offline / online / intermittent / standby 0-1 flags."""
    s = F.upper(F.trim(status.cast("string")))
    return [X.flag(s == v).alias(f"{v.lower()}_flag") for v in ("OFFLINE", "ONLINE", "INTERMITTENT", "STANDBY")]


def coord_missing(lat: Column, lon: Column) -> Column:
    """Coordinates missing when null or exactly 0."""
    return X.flag(lat.isNull() | (lat == 0) | lon.isNull() | (lon == 0))


def comm_age_whole_days(df: DataFrame, as_of: str, names: Sequence[str] = ("BatteryLatestReport", "Last_Heard")
                        ) -> Column:
    """P21(b): whole days since the last report vs ``as_of`` midnight, >= 0,
    missing -> 0; the second timestamp fills gaps of the first."""
    cols = [X.to_ts_any(F.col(n), _dtype(df, n)) for n in names if n in df.columns]
    ts = F.coalesce(*cols) if cols else F.lit(None).cast("timestamp")
    today = F.to_timestamp(F.lit(as_of))
    return F.coalesce(F.greatest(X.whole_days(today, ts), F.lit(0)), F.lit(0)).cast("long")


def canonical_type(df: DataFrame) -> DataFrame:
    """P11 + P8: ``Device_Type`` with fallback ``device_type`` -> canonical type A
    in one ``device_type`` column (Spark names are case-insensitive, so the
    raw column is replaced rather than kept beside it)."""
    names = [f"_dt{i}" if c.lower() == "device_type" else c for i, c in enumerate(df.columns)]
    raw = [(n, c) for n, c in zip(names, df.columns) if n.startswith("_dt")]
    d = df.toDF(*names)
    ordered = [n for n, c in sorted(raw, key=lambda r: r[1] != "Device_Type")]
    src = F.coalesce(*[F.col(n) for n in ordered]) if ordered else F.lit(None)
    keep = [n for n in names if not n.startswith("_dt")]
    return d.select(*keep, X.device_type_a(src).alias("device_type"))


def label_flags(df: DataFrame, as_of: str = config.DEFAULT_AS_OF, battery_low: float = 20.0,
                zero_current_threshold: float = 1.0, types: Sequence[str] = config.ACTIVE_ML_TYPES,
                order_cols: Sequence[str] = (), inactive_days: int = 180, reconf_intermittent_days: int = 14) -> DataFrame:
    """Label-side features of a history frame.

    D11: ``inactive_days`` and ``reconf_intermittent_days`` are accepted as parameters of the job; no rule uses them."""
    d = df.select("*", X.device_type_a(F.col("Device_Type")).alias("device_type_display"))
    d = d.where(F.col("device_type_display").isin(*types))
    ts_name = _first(d, ["BatteryLatestReport", "Last_Heard", "LastHeard", "last_heard", "Date", "date"])
    if ts_name is None:
        raise KeyError("Missing timestamp column!")
    ts = X.to_ts_any(F.col(ts_name), _dtype(d, ts_name))
    d = d.select("*", ts.alias("_ts"))
    mx = d.agg(F.max("_ts").alias("_max_ts"))
    d = d.crossJoin(F.broadcast(mx))  # one row
    filled = F.coalesce(F.col("_ts"), F.col("_max_ts"))
    bat = _first(d, ["BatteryLevel", "Battery_Level", "Battery", "battery_level"])
    stat = _first(d, ["Status", "status", "DeviceStatus", "Profile_Status"])
    lc = _first(d, ["LineCurrent", "Line_Current", "line_current", "Current"])
    tc = _first(d, ["LineTemperatrue", "LineTemperature", "Line_Temperature", "Temperature"])
    lat = _first(d, ["Latitude", "lat", "LATITUDE"])
    lon = _first(d, ["Longitude", "lon", "LONGITUDE"])
    cols = [F.col("_ts").isNull().alias("timestamp_missing"), filled.alias("_ts_filled")]
    cols.append(X.flag(X.to_num(F.col(tc)) > 85).alias("overheat_flag") if tc else F.lit(0).alias("overheat_flag"))
    cols.append(X.flag(X.to_num(F.col(bat)) < battery_low).alias("battery_low_flag") if bat
                else F.lit(0).alias("battery_low_flag"))
    cols += status_flags(F.col(stat)) if stat else [F.lit(0).alias(f"{v}_flag") for v in
                                                   ("offline", "online", "intermittent", "standby")]
    cols.append(X.flag(F.abs(F.coalesce(X.to_num(F.col(lc)), F.lit(0.0))) <= zero_current_threshold)
                .alias("zero_current_flag") if lc else F.lit(0).alias("zero_current_flag"))
    if lat and lon:
        cols += [X.to_num(F.col(lat)).alias("_lat"), X.to_num(F.col(lon)).alias("_lon")]
    else:
        cols += [F.lit(None).cast("double").alias("_lat"), F.lit(None).cast("double").alias("_lon")]
    d = d.select("*", *cols)
    d = d.select("*", coord_missing(F.col("_lat"), F.col("_lon")).alias("coord_missing_flag") if lat and lon
                 else F.lit(0).alias("coord_missing_flag"))
    # W2 against the previous reading of the device in timestamp order
    order = [F.col("_ts_filled")] + [F.col(c) for c in order_cols]
    bucket = F.floor(F.unix_micros("_ts_filled") / F.lit(86400 * 1_000_000)).cast("long")
    d = two_level_lag(d, ["Serial"], bucket, order, ["_lat", "_lon"], prefix="prev", skip_null=["Serial"])
    moved = ((F.col("prev_lat").isNotNull() & F.col("_lat").isNotNull()
              & (F.abs(F.col("_lat") - F.col("prev_lat")) > config.COORD_CHANGE_DEG))
             | (F.col("prev_lon").isNotNull() & F.col("_lon").isNotNull()
                & (F.abs(F.col("_lon") - F.col("prev_lon")) > config.COORD_CHANGE_DEG)))
    d = d.select("*", X.flag(moved).alias("coord_changed_flag"))
    extra = []
    if "InstallDate" in d.columns:
        inst = X.to_ts_any(F.col("InstallDate"), _dtype(d, "InstallDate"))
        age = X.clip(X.whole_days(F.col("_max_ts"), inst), lo=0).cast("long")
        extra += [age.alias("device_age_days"), F.lit(config.DEFAULT_LIFETIME_DAYS).alias("expected_lifetime_days"),
                  X.np_round(age / float(config.DEFAULT_LIFETIME_DAYS) * 100.0, 1).alias("pct_life_used")]
    elif "pct_life_used" not in d.columns:
        extra += [F.lit(None).cast("double").alias("pct_life_used"), F.lit(None).cast("long").alias("device_age_days")]
    if "comm_age_days" not in d.columns:
        extra.append(comm_age_whole_days(d, as_of).alias("comm_age_days"))
    for fl in ("gps_jump_flag", "critical_current_flag", "high_current_flag", "low_current_flag"):
        if fl not in d.columns:
            extra.append(F.lit(0).alias(fl))
    if "reconfigure_count" not in d.columns:
        extra.append(F.lit(0).alias("reconfigure_count"))
    if "battery_level" not in d.columns:
        extra.append(F.lit(None).cast("double").alias("battery_level"))
    extra.append((X.is_missing_raw(F.col("BatteryLevel"), _dtype(d, "BatteryLevel")) if "BatteryLevel" in d.columns
                  else F.lit(True)).alias("_bl_missing"))
    d = d.select("*", *extra)
    return d.drop("_ts", "_max_ts", "_lat", "_lon").withColumnRenamed("_ts_filled", ts_name + "_filled")


def label_actions(df: DataFrame, types: Sequence[str] = config.ACTIVE_ML_TYPES, canonical: bool = True
                  ) -> DataFrame:
    """D8-D10 rules over label features; adds ``action_name`` and ``action_label``.

    ``canonical=True`` matches rules on the canonical type (T10); False
    matches the raw ``Device_Type`` exactly like the reference.
    """
    t = F.col("device_type_display") if canonical else F.trim(F.col("Device_Type").cast("string"))
    rc, c = F.col("reconfigure_count"), F.col("comm_age_days")
    life = F.coalesce(F.col("pct_life_used"), F.lit(0.0))
    f = lambda n: F.col(n) == 1
    coord, gps = f("coord_missing_flag"), f("gps_jump_flag")
    blm = F.col("_bl_missing")
    # ZM1, reverse write order
    zm1 = (F.when((F.col("battery_level") < 10) & (c < 7), REPLACE)
           .when((rc >= 1) & (c > 90), REPLACE)
           .when(life > config.REPLACE_LIFE_PCT, REPLACE)
           .when((rc >= 1) & f("battery_low_flag"), REPLACE)
           .when((rc >= 1) & coord, RECONF)
           .when((rc == 1) & (coord | gps | blm | (c > 30)), RECONF)
           .when((rc == 0) & (coord | gps | blm | ((c > 14) & (c <= 90))), RECONF))
    crit, hot, high, zero = f("critical_current_flag"), f("overheat_flag"), f("high_current_flag"), f("zero_current_flag")
    mm3 = (F.when(((rc >= 1) & coord) | f("coord_changed_flag") | (coord & (rc == 0) & (c > 14)), RECONF)
           .when((rc >= 1) & (crit | hot | zero | (c > 90)), REPLACE)
           .when((rc == 1) & (crit | hot | high | zero | (c > 30)), RECONF)
           .when((rc == 0) & (crit | hot | high | zero | f("intermittent_flag") | ((c > 7) & (c <= 90)) | coord),
                 RECONF))
    um3 = (F.when((rc >= 1) & coord, RECONF)
           .when((rc >= 1) & ((c > 90) | f("offline_flag")), REPLACE)
           .when((rc == 1) & ((c > 30) | f("intermittent_flag")), RECONF)
           .when((rc == 0) & (((c > 7) & (c <= 90)) | f("intermittent_flag") | coord | f("offline_flag")), RECONF))
    name = F.coalesce(F.when(t == "ZM1", zm1).when(t == "MM3", mm3).when(t == "UM3+", um3), F.lit(NO))
    return df.select("*", name.alias("action_name")).select("*", label_of(F.col("action_name")).alias("action_label"))


# ------------------------------------------------------------ prediction ---

def latest_per_device(df: DataFrame, ts: str = "BatteryLatestReport", order_cols: Sequence[str] = (),
                      prefer_known: bool = False) -> DataFrame:
    """One row per Serial.  pandas sorts missing timestamps last, so they
    win "latest" (T18) unless ``prefer_known``.  Partial ``max_by`` keeps a hot
    device from gathering in one task."""
    t = X.to_ts_any(F.col(ts), _dtype(df, ts)) if ts in df.columns else F.lit(None).cast("timestamp")
    missing = t.isNull().cast("int")
    key = F.struct((F.lit(0) - missing if prefer_known else missing).alias("m"),
                   F.coalesce(F.unix_micros(t), F.lit(0)).alias("t"), *[F.col(c) for c in order_cols])
    others = [c for c in df.columns if c != "Serial"]
    return (df.groupBy("Serial").agg(F.max_by(F.struct(*others), key).alias("_r")).select("Serial", "_r.*"))


def with_install_lookup(df: DataFrame, install: DataFrame | None, as_of: str, order_cols: Sequence[str] = ()
                        ) -> DataFrame:
    """J2 + P24: install date lookup (unparseable dropped, the last per device in
    ``order_cols``; without a declared order the latest date), whole-day age vs
    ``as_of`` and percent of life used (1 dp)."""
    if install is None:
        return df.select("*", F.lit(0.0).alias("pct_life_used"), F.lit(0.0).alias("device_age_days"))
    inst = install.select("Serial", *order_cols, X.to_ts_any(F.col("InstallDate"), _dtype(install, "InstallDate")).alias("_inst"))
    inst = inst.where(F.col("_inst").isNotNull()).groupBy("Serial").agg(
        F.max_by("_inst", F.struct(*order_cols, "_inst")).alias("InstallDate"))
    drop = [c for c in ("InstallDate", "pct_life_used", "device_age_days") if c in df.columns]
    d = df.drop(*drop).join(inst, "Serial", "left")
    today = F.to_timestamp(F.lit(as_of))
    age = F.coalesce(F.greatest(X.whole_days(today, F.col("InstallDate")), F.lit(0)), F.lit(0)).cast("double")
    pct = F.coalesce(X.np_round(age / float(config.DEFAULT_LIFETIME_DAYS) * 100.0, 1), F.lit(0.0))
    return d.select("*", age.alias("device_age_days"), pct.alias("pct_life_used"))


def recompute_features(df: DataFrame, as_of: str, ts: str | None = None, order_cols: Sequence[str] = ()) -> DataFrame:
    """Refresh days since report, coordinate, battery and status flags.

    With ``ts`` the frame may hold several rows a device: ``prev_lat`` and ``prev_lon`` are those of its row before (by
    ``ts``, then ``order_cols``), and ``coord_changed_flag`` tells whether either moved by more than 0.001. Without it a
    row is a device's only one: nothing before it, nothing changed.
    """
    moved = {"prev_lat": F.lit(None).cast("double"), "prev_lon": F.lit(None).cast("double"), "coord_changed_flag": F.lit(0)}
    if ts is not None and {"Latitude", "Longitude"} <= {*df.columns}:
        at = X.to_ts_any(F.col(ts), _dtype(df, ts))
        own = df.select("*", X.to_num(F.col("Latitude")).alias("_lat"), X.to_num(F.col("Longitude")).alias("_lon"), at.alias("_at"))
        order = [F.col("_at").isNull(), F.col("_at"), *[F.col(c) for c in order_cols]]
        day = F.coalesce(F.unix_date(F.to_date("_at")), F.lit(1 << 30))  # no report: after all others
        df = two_level_lag(own, "Serial", day, order, ["_lat", "_lon"], prefix="_prev", skip_null=["Serial"])
        far = lambda a, b: F.coalesce(F.abs(F.col(a) - F.col(b)) > 0.001, F.lit(False))
        moved = {"prev_lat": F.col("_prev_lat"), "prev_lon": F.col("_prev_lon"),
                 "coord_changed_flag": (far("_lat", "_prev_lat") | far("_lon", "_prev_lon")).cast("int")}
    cols = {"days_since_last_report": comm_age_whole_days(df, as_of), **moved}
    lat = X.to_num(F.col("Latitude")) if "Latitude" in df.columns else None
    lon = X.to_num(F.col("Longitude")) if "Longitude" in df.columns else None
    if lat is not None and lon is not None:
        cols["coord_missing_flag"] = coord_missing(lat, lon)
    bat = _first(df, ["BatteryLevel", "Battery_Level", "battery_level", "Battery"])
    if bat:
        cols["battery_low_flag"] = X.flag(X.to_num(F.col(bat)) < 20)
    stat = _first(df, ["Status", "status", "DeviceStatus", "Profile_Status"])
    if stat:
        s = F.upper(F.trim(F.col(stat).cast("string")))
        for v in ("OFFLINE", "ONLINE", "INTERMITTENT", "STANDBY"):
            cols[f"{v.lower()}_flag"] = X.flag(s == v)
    keep = [c for c in df.columns if c not in cols and c not in ("_lat", "_lon", "_at", "_prev_lat", "_prev_lon")]
    return df.select(*keep, *[c.alias(n) for n, c in cols.items()])


def rule_actions(df: DataFrame, type_col: str = "device_type") -> tuple[Column, Column]:
    """D12 fallback: REPLACE beats coordinate RECONFIGURE beats RECONFIGURE."""
    g = lambda n: F.coalesce(F.col(n), F.lit(0)) == 1 if n in df.columns else F.lit(False)
    ca = F.col("days_since_last_report")
    life = F.coalesce(F.col("pct_life_used"), F.lit(0.0)) if "pct_life_used" in df.columns else F.lit(0.0)
    rc = F.coalesce(F.col("reconfigure_count"), F.lit(0)) if "reconfigure_count" in df.columns else F.lit(0)
    actionable = (rc >= 1) | (ca > 90)
    past = life > config.REPLACE_LIFE_PCT
    cm, cc = g("coord_missing_flag"), g("coord_changed_flag")
    t = F.col(type_col)
    relocate = (F.when(t == "MM3", (actionable & cm) | cc).when(t == "ZM1", (cm & (ca > 14)) | cc)
                .when(t == "UM3+", (actionable & cm) | cc).otherwise(F.lit(False)))
    replace = (F.when(t == "MM3", actionable & (g("critical_current_flag") | g("overheat_flag")
                                                | g("zero_current_flag") | (ca > 90) | past))
               .when(t == "ZM1", actionable & (g("battery_low_flag") | (ca > 90)))
               .when(t == "UM3+", actionable & (g("offline_flag") | (ca > 90))).otherwise(F.lit(False)))
    reconf = (F.when(t == "MM3", g("zero_current_flag") | g("overheat_flag") | g("critical_current_flag")
                     | g("intermittent_flag") | cm | ((ca > 7) & (ca <= 90)))
              .when(t == "ZM1", cm | ((ca > 14) & (ca <= 90)))
              .when(t == "UM3+", g("offline_flag") | g("intermittent_flag") | cm | ((ca > 7) & (ca <= 90)))
              .otherwise(F.lit(False)))
    name = F.when(replace, REPLACE).when(relocate, RECONF).when(reconf, RECONF).otherwise(NO)
    return name, label_of(name)


def apply_confidence(df: DataFrame, threshold: float = config.CONFIDENCE_THRESHOLD,
                     type_col: str = "device_type") -> DataFrame:
    """Below-threshold confidence takes the D12 rule action."""
    name, _ = rule_actions(df, type_col)
    low = F.col("Confidence") < threshold
    keep = [c for c in df.columns if c not in ("PredictedActionName", "UsedRuleFallback")]
    return df.select(*keep, F.when(low, name).otherwise(F.col("PredictedActionName")).alias("PredictedActionName"),
                     (low | F.coalesce(F.col("UsedRuleFallback"), F.lit(False))).alias("UsedRuleFallback")
                     if "UsedRuleFallback" in df.columns else low.alias("UsedRuleFallback"))


def apply_age_override(df: DataFrame) -> DataFrame:
    """Past 90 % of life -> REPLACE for every row; label from the name."""
    past = F.coalesce(F.col("pct_life_used"), F.lit(0.0)) > config.REPLACE_LIFE_PCT
    keep = [c for c in df.columns if c not in ("PredictedActionName", "PredictedActionLabel", "AgeOverride")]
    name = F.when(past, F.lit(REPLACE)).otherwise(F.col("PredictedActionName"))
    return df.select(*keep, name.alias("PredictedActionName"), past.alias("AgeOverride")).select(
        "*", F.coalesce(label_of(F.col("PredictedActionName")), F.lit(0)).alias("PredictedActionLabel"))


def action_crosstab(df: DataFrame, type_col: str = "device_type", action_col: str = "PredictedActionName"
                    ) -> DataFrame:
    """Device type x action counts, 0 where absent (fixed action columns)."""
    return (df.groupBy(type_col).pivot(action_col, [NO, RECONF, REPLACE]).count().na.fill(0))
