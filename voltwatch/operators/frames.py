"""Frame-level helpers: unions, typed defaults, derived ML inputs, profile
risk join and the history bootstrap (U1, U2, P14, P26, J7, S18)."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import exprs as X
from ..functions.categories import risk_category


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; columns missing on one side become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def new_names(seen: Sequence[str], incoming: Sequence[str]) -> list[str]:
    """U2 (plan time): names in ``incoming`` not yet in ``seen``; on data use ``left_anti``."""
    s = set(seen)
    return [n for n in incoming if n not in s]


def ensure_cols(df: DataFrame, defaults: Mapping[str, tuple[object, str]]) -> DataFrame:
    """Add absent columns as typed literals in one projection."""
    extra = [F.lit(v).cast(t).alias(n) for n, (v, t) in defaults.items() if n not in df.columns]
    return df.select("*", *extra) if extra else df


def derive_ml_inputs(df: DataFrame) -> DataFrame:
    """Months from days / 30.44 and comm days from hours / 24 when absent."""
    cols = []
    if "device_age_months" not in df.columns and "device_age_days" in df.columns:
        cols.append((F.col("device_age_days") / config.DAYS_PER_MONTH).alias("device_age_months"))
    if "comm_age_days" not in df.columns and "hours_since_last_heard" in df.columns:
        cols.append((F.col("hours_since_last_heard") / 24.0).alias("comm_age_days"))
    return df.select("*", *cols) if cols else df


def with_profile_risk(df: DataFrame, profiles: DataFrame) -> DataFrame:
    """Current score and reason of a device's profile as ``risk_score`` and ``risk_reason`` with the categories of the
    score (C4), in place of columns of these names (T12).  What profiles lack is not added."""
    names = {"risk_score_current": "risk_score", "risk_reason_current": "risk_reason"}
    found = {c: n for c, n in names.items() if c in profiles.columns}
    if "risk_score_current" not in found:
        return df
    p = profiles.select("Serial", *[F.col(c).alias(f"__{n}") for c, n in found.items()])
    bins = risk_category("__risk_score")
    keep = [c for c in df.columns if c not in found.values() and c not in bins]
    return df.join(p, "Serial", "left").select(*keep, *[F.col(f"__{n}").alias(n) for n in found.values()],
                                               *[c.alias(n) for n, c in bins.items()])


def bootstrap_history(pred: DataFrame, install: DataFrame | None, attempts: DataFrame | None, as_of: str,
                      types: Sequence[str] = config.ACTIVE_ML_TYPES) -> DataFrame:
    """History rows from a predictions export: better-filled type column,
    active types, timestamps, reconfigure attempts, install age, defaults and
    whole-day comm age vs ``as_of``."""
    from .health import reconfigure_counts
    from .labels import comm_age_whole_days, with_install_lookup
    # Spark names are case-insensitive: rename type columns by position first
    names = [f"_dt{i}" if c.lower() == "device_type" else c for i, c in enumerate(pred.columns)]
    raw = [n for n in names if n.startswith("_dt")]
    p = pred.toDF(*names)
    if len(raw) > 1:  # P11 bootstrap: the better-filled of the two columns
        counts = p.agg(*[F.count(F.col(c)).alias(c) for c in raw]).first().asDict()  # one row
        best = max(raw, key=lambda c: counts[c])
        d = p.select(*[c for c in p.columns if c not in raw], F.col(best).alias("_dt"))
    elif raw:
        d = p.withColumnRenamed(raw[0], "_dt")
    else:
        d = p.select("*", F.lit(None).cast("string").alias("_dt"))
    d = d.select("*", X.device_type_a(F.col("_dt")).alias("Device_Type")).drop("_dt")
    d = d.where(F.col("Device_Type").isin(*types))
    for c in ("BatteryLatestReport", "Last_Heard"):
        if c in d.columns:
            d = d.withColumn(c, X.to_ts_any(F.col(c), dict(d.dtypes)[c]))
    if attempts is not None:
        rc = reconfigure_counts(attempts)
        d = d.drop(*[c for c in ("reconfigure_count", "last_reconfigure_time") if c in d.columns])
        d = d.join(rc, "Serial", "left").select(
            *[c for c in d.columns], F.coalesce(F.col("reconfigure_count"), F.lit(0)).alias("reconfigure_count"),
            "last_reconfigure_time")
    d = ensure_cols(d, {"reconfigure_count": (0, "int"), "last_reconfigure_time": (None, "timestamp")})
    d = d.select("*", (F.col("reconfigure_count") > 0).alias("reconfigure_attempted"))
    d = with_install_lookup(d, install, as_of)
    d = ensure_cols(d, {f: (0, "int") for f in ("gps_jump_flag", "coord_missing_flag", "coord_changed_flag",
                                                "zero_current_flag", "overheat_flag", "online_flag",
                                                "intermittent_flag", "critical_current_flag", "high_current_flag",
                                                "low_current_flag", "battery_low_flag")})
    return d.select(*[c for c in d.columns if c != "comm_age_days"], comm_age_whole_days(d, as_of).alias("comm_age_days"))


def metrics_table(df_rows: int, feats: Sequence[str], classes: Sequence[int], test: DataFrame, label: str,
                  pred: str, device_type: str) -> DataFrame:
    """M6: metrics bundle as one DataFrame (rows, features, classes, test and
    prediction counts, confusion matrix); ready for ``write.json``."""
    spark = test.sparkSession
    y = test.groupBy(F.col(label).cast("string").alias("k")).agg(F.count(F.lit(1)).alias("v"))
    p = test.groupBy(F.col(pred).cast("string").alias("k")).agg(F.count(F.lit(1)).alias("v"))
    cm = test.groupBy(F.col(label).alias("actual"), F.col(pred).alias("predicted")).agg(
        F.count(F.lit(1)).alias("count"))
    head = spark.createDataFrame([(device_type, int(df_rows), len(feats), list(feats), [int(c) for c in classes])],
                                 "device_type string, rows long, n_features int, feature_cols array<string>, "
                                 "classes array<int>")
    agg = (y.agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("y_test_counts"))
           .crossJoin(p.agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("pred_counts")))
           .crossJoin(cm.agg(F.collect_list(F.struct("actual", "predicted", "count")).alias("confusion_matrix"))))
    return head.crossJoin(agg)
