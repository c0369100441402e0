"""Data-quality gate, rejection reasons and validity rules."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X

HELPERS = ("temp_device_type",)

REQUIRED = {
    # type: [(field, candidate names)]
    "MM3": [("LineCurrent", ["LineCurrent", "Current", "LINE_CURRENT"]),
            ("LineTemperature", ["LineTemperature", "Temperature", "TEMP", "LineTemperatrue"]),
            ("Last_Heard", ["Last_Heard", "LAST_HEARD", "LastHeard"])],
    "ZM1": [("BatteryLevel", ["BatteryLevel", "BATTERY", "Battery", "battery_level"]),
            ("Last_Heard", ["Last_Heard", "LAST_HEARD", "LastHeard"])],
    "UM3": [("Last_Heard", ["Last_Heard", "LAST_HEARD", "LastHeard"])],
}


def _present(c: str, dtype: str) -> Column:
    return ~X.is_missing_raw(F.col(c), dtype)


def quality_gate(df: DataFrame, device_col: str = "Device_Type") -> DataFrame:
    """F4 + F5: ``is_valid`` and a per-row ``rejection_reason``.

    MM3 needs current, temperature and Last_Heard; ZM1 battery and
    Last_Heard; UM3 Last_Heard; unknown types are invalid.  Required columns
    are found by case-insensitive substring, never matching helper columns
    (T14); a required column that does not exist makes the row invalid.
    """
    dtypes = dict(df.dtypes)
    t = F.upper(F.trim(F.col(device_col).cast("string")))
    valid = F.lit(False)
    reason = F.lit("Unknown device type")
    for ty in ("MM3", "ZM1", "UM3"):  # later masks win, as in the reference
        checks = []
        names = []
        for field, cands in REQUIRED[ty]:
            c = X.find_col(df.columns, cands, exclude=HELPERS)
            if c is None:
                checks.append(F.lit(False))
                names.append(F.lit(field))
            else:
                ok = _present(c, dtypes[c])
                checks.append(ok)
                names.append(F.when(~ok, F.lit(c)))
        all_ok = checks[0]
        for c in checks[1:]:
            all_ok = all_ok & c
        why = (F.lit("Missing Last_Heard data") if ty == "UM3"
               else F.concat(F.lit("Missing critical data: "), F.concat_ws(", ", *names)))
        hit = F.coalesce(t.contains(ty), F.lit(False))
        valid = F.when(hit, all_ok).otherwise(valid)
        reason = F.when(hit, F.when(all_ok, F.lit(None).cast("string")).otherwise(why)).otherwise(reason)
    return df.select("*", valid.alias("is_valid"), F.when(~valid, reason).alias("rejection_reason"))


def clean(df: DataFrame, device_col: str = "Device_Type") -> DataFrame:
    """valid rows only."""
    g = quality_gate(df, device_col)
    return g.where("is_valid").drop("is_valid", "rejection_reason")


def rejected(df: DataFrame, device_col: str = "Device_Type") -> DataFrame:
    """rejected rows with their reason (kept, not discarded)."""
    return quality_gate(df, device_col).where(~F.col("is_valid")).drop("is_valid")


def quality_report(gated: DataFrame, device_col: str = "Device_Type") -> DataFrame:
    """valid / total and % per type plus an overall row (rollup)."""
    t = F.upper(F.trim(F.col(device_col).cast("string")))
    typ = F.when(t.contains("UM3"), "UM3").when(t.contains("ZM1"), "ZM1").when(t.contains("MM3"), "MM3").otherwise(
        "UNKNOWN")
    return gated.select(typ.alias("device_type"), "is_valid").rollup("device_type").agg(
        F.count(F.lit(1)).cast("long").alias("total"), F.count_if("is_valid").cast("long").alias("valid"),
        (F.count_if("is_valid") / F.count(F.lit(1)) * 100.0).alias("valid_pct"))


def data_validity(df: DataFrame, temp: str = "LineTemperature_val", current: str = "LineCurrent_val",
                  drift: str = "distance_drift_m", comm: str = "comm_age_days") -> DataFrame:
    """F8 (documented rules): temperature < -40 or > 150, current < 0, GPS jump
    > 300 m, no communication > 30 days -> invalid, reasons joined, excluded from ML."""
    rules = [(F.col(temp) < -40, "Temperature below -40C"), (F.col(temp) > 150, "Temperature above 150C"),
             (F.col(current) < 0, "Negative current"), (F.col(drift) > 300, "GPS jump over 300 m"),
             (F.col(comm) > 30, "No communication for over 30 days")]
    bad = F.lit(False)
    for cond, _ in rules:
        bad = bad | F.coalesce(cond, F.lit(False))
    reason = F.concat_ws("; ", *[F.when(F.coalesce(c, F.lit(False)), F.lit(txt)) for c, txt in rules])
    return df.select("*", (~bad).alias("is_data_valid"), F.when(bad, reason).otherwise(F.lit("OK"))
                     .alias("data_quality_reason"), bad.alias("should_exclude_from_ml"))


def active_only(df: DataFrame, types: Sequence[str], type_col: str = "device_type") -> DataFrame:
    """keep active device types."""
    return df.where(F.col(type_col).isin(*types))


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with missing values in ``cols``."""
    return df.na.drop(subset=list(cols))


def of_type(df: DataFrame, t: str, col: str = "Device_Type") -> DataFrame:
    """case-insensitive type substring filter."""
    return df.where(F.upper(F.col(col).cast("string")).contains(t.upper()))


def valid_range(c: str, lo: float, hi: float) -> Column:
    """value inside the physical range, else null (for use inside aggregates)."""
    return F.when(F.col(c).between(lo, hi), F.col(c))
