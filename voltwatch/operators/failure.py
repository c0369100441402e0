"""Failure-model dataset and trust-stack rules.

The look-ahead label is a bounded frame (next 7 rows) on the daily series,
where a device has at most one row per day; global thresholds (max age,
75 % quantiles, chronological cut-off) are one-row aggregates broadcast back.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import exprs as X
from .common import reliable_checkpoint
from .ranks import exact_quantiles, first_rows

OFFLINE_SPELLINGS = ("OFFLINE", "OFF LINE", "OFF-LINE")
ML_FEATURES = ["battery_level", "LineTemperature_val", "LineCurrent_val", "device_age_months", "comm_age_days",
               "age_adjusted_battery_risk", "maintenance_urgency_score", "old_and_hot_flag"]


def status_failure(status: Column) -> dict[str, Column]:
    """1 and 'offline_status' for a spelling of OFFLINE, else (unknown and missing too) 0 and 'active'."""
    off = F.coalesce(F.upper(F.trim(status.cast("string"))).isin(*OFFLINE_SPELLINGS), F.lit(False))
    return {"status_failure": off.cast("int"), "status_cause": F.when(off, "offline_status").otherwise("active")}


def label_lookahead(df: DataFrame, key: str = "Serial", date_col: str = "date", horizon_rows: int = 7,
                    horizon_days: int = 7) -> DataFrame:
    """``failure_next_7d`` / ``failure_cause`` from the next ``horizon_rows`` rows
    that lie within ``horizon_days``; the earliest qualifying row decides.

    With a ``Status`` column a future OFFLINE row is a failure
    ('future_offline'); otherwise causes are checked per future row in the
    order communication (> 7 days silent), battery (< 10), overheating (> 85 C).
    """
    w = Window.partitionBy(key).orderBy(date_col).rowsBetween(1, horizon_rows)
    if "Status" in df.columns:
        st = F.upper(F.trim(F.col("Status").cast("string")))
        cause = F.when(st.isin(*OFFLINE_SPELLINGS), F.lit("future_offline"))
    else:
        hours = F.col("hours_since_last_heard") if "hours_since_last_heard" in df.columns else F.lit(None)
        bat = F.col("battery_level") if "battery_level" in df.columns else F.lit(None)
        tmp = F.col("LineTemperature_val") if "LineTemperature_val" in df.columns else F.lit(None)
        cause = (F.when(hours > 24 * 7, "communication").when(bat < 10, "battery").when(tmp > 85, "overheating"))
    d = df.select("*", F.struct(F.col(date_col).alias("d"), cause.alias("c")).alias("_fut"))
    nxt = F.collect_list("_fut").over(w)
    d = d.select("*", nxt.alias("_next"))
    hits = F.filter("_next", lambda s: s["c"].isNotNull()
                    & (F.datediff(s["d"], F.col(date_col)) <= horizon_days))
    first = F.try_element_at(hits, F.lit(1))
    d = d.select(*df.columns, F.when(first.isNotNull(), 1).otherwise(0).alias("failure_next_7d"),
                 F.coalesce(first["c"], F.lit("none")).alias("failure_cause"))
    return d


def ml_features(df: DataFrame, exact: bool = True) -> DataFrame:
    """D13 + A16: engineered failure-model features over the whole frame.

    The 75 % quantiles are exact (linear, as pandas), read from the two columns alone; ``exact=False`` takes a sketch."""
    if exact:
        q = exact_quantiles(df, {"device_age_months": (0.75, 1.0), "LineTemperature_val": (0.75,)})
        stats = q.select(F.col("device_age_months")[1].alias("_max_age"), F.col("device_age_months")[0].alias("_old_q"),
                         F.col("LineTemperature_val")[0].alias("_hot_q"))
    else:
        q = lambda c: F.percentile_approx(c, 0.75, 10000)
        stats = df.agg(F.max("device_age_months").alias("_max_age"),
                       q("device_age_months").alias("_old_q"), q("LineTemperature_val").alias("_hot_q"))
    d = df.crossJoin(F.broadcast(stats))  # one row
    bat, tmp, age, comm = (F.col(c) for c in ("battery_level", "LineTemperature_val", "device_age_months",
                                               "comm_age_days"))
    age_norm = F.when(F.col("_max_age") > 0, age / F.col("_max_age")).otherwise(age)
    aabr = (1 - bat / 100.0) * (0.3 + 0.7 * age_norm)
    pts = lambda *pairs: F.coalesce(
        _chain(pairs), F.lit(0))
    urgency = (pts((bat < 20, 40), (bat < 30, 30), (bat < 50, 20), (bat < 70, 10))
               + pts((tmp > 80, 30), (tmp > 70, 20), (tmp > 60, 10))
               + pts((age > 60, 20), (age > 36, 15), (age > 24, 10), (age > 12, 5))
               + pts((comm > 7, 10), (comm > 3, 7), (comm > 1, 3))).cast("double")
    old_hot = X.flag((age > F.col("_old_q")) & (tmp > F.col("_hot_q")))
    keep = [c for c in df.columns if c not in ("age_adjusted_battery_risk", "maintenance_urgency_score",
                                                "old_and_hot_flag")]
    return d.select(*keep, aabr.alias("age_adjusted_battery_risk"), urgency.alias("maintenance_urgency_score"),
                    old_hot.alias("old_and_hot_flag"))


def _chain(pairs) -> Column:
    out = None
    for cond, v in pairs:
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    return out


def failure_dataset(ts: DataFrame, key: str = "Serial", date_col: str = "date") -> DataFrame:
    """Look-ahead labels + engineered features, complete rows only."""
    lab = label_lookahead(ts, key, date_col)
    kept = [key, date_col, "failure_next_7d", "failure_cause", *[c for c in ML_FEATURES if c in lab.columns]]
    kept += [c for c in ("battery_level", "LineTemperature_val", "device_age_months", "comm_age_days") if c not in kept]
    # read for the quantiles and again for the rows: the daily series behind it is worked out once
    feats = ml_features(reliable_checkpoint(lab.select(*kept)))
    return feats.select(key, date_col, "failure_next_7d", "failure_cause", *ML_FEATURES).na.drop(subset=ML_FEATURES)


def failure_causes(ds: DataFrame) -> DataFrame:
    """Over failure rows, counts and means of battery < 30, temp > 70, age > 36 months."""
    f = ds.where(F.col("failure_next_7d") == 1)
    b, t, a = F.col("battery_level"), F.col("LineTemperature_val"), F.col("device_age_months")
    return f.agg(
        F.count(F.lit(1)).cast("long").alias("failure_rows"),
        F.count_if(b < 30).cast("long").alias("battery_failures"), F.avg(F.when(b < 30, b)).alias("battery_avg"),
        F.count_if(t > 70).cast("long").alias("temperature_failures"), F.avg(F.when(t > 70, t)).alias("temperature_avg"),
        F.count_if(a > 36).cast("long").alias("age_failures"), F.avg(F.when(a > 36, a)).alias("age_avg_months"))


def chrono_split(df: DataFrame, ts: str, frac: float = 0.8, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The earliest ``frac`` of rows (int(n * frac)) are train; a missing timestamp comes last, equal ones go by
    ``tiebreak`` (integers by value, other types by a hash), and rows equal in all of them stay together.

    The cut-off is found on the keys alone; the rows themselves are filtered once, neither sorted nor written.
    """
    types = dict(df.dtypes)
    keys = [F.unix_micros(F.col(ts).cast("timestamp"))]
    keys += [F.col(c) if types[c] in ("bigint", "int", "smallint", "tinyint") else F.xxhash64(c) for c in tiebreak]
    return first_rows(df, F.floor(F.col("_n") * frac), keys, "is_train")


def days_since_last_heard(df: DataFrame, col: str = "Last_Heard", out: str = "days_since_last_heard") -> DataFrame:
    """P21(a) for the trust stack: fractional days vs the frame's latest timestamp."""
    mx = df.agg(F.max(col).alias("_mx"))
    return df.crossJoin(F.broadcast(mx)).select(*df.columns, X.days_between("_mx", col).alias(out))


def rule_score(df: DataFrame, battery: str = "BatteryLevel", days: str = "days_since_last_heard",
               current: str = "LineCurrent", temp: str = "LineTemperature", status: str | None = None,
               threshold: float = 50.0) -> DataFrame:
    """Nine additive rules, clipped 0-100, label = score >= threshold, '; '-joined reasons."""
    def c(name):
        if name not in df.columns:
            return F.lit(None).cast("double")
        return X.sanitize_num(name) if types[name] == "string" else X.to_num(F.col(name))  # "85%" is 85
    types = dict(df.dtypes)
    b, d, cur, t = X.clip(c(battery), 0, 100), c(days), c(current), c(temp)
    txt = config.TRUST_RULE_TEXT
    rules = [(b < 20, 35, txt[0]), (b < 10, 30, txt[1]), ((b < 20) & (d > 3), 25, txt[2]), (d > 7, 25, txt[3]),
             ((cur == 0) & (b < 30), 25, txt[4]), ((cur == 0) & (d > 3), 20, txt[5]),
             (t > 85, 20, txt[6]), (t < -20, 20, txt[7])]
    if status and status in df.columns:
        s = F.lower(F.col(status).cast("string"))
        rules.append((s.isin("installed", "active") & (cur == 0), 10, txt[8]))
    score = F.lit(0.0)
    for cond, pts, _ in rules:
        score = score + F.when(F.coalesce(cond, F.lit(False)), F.lit(float(pts))).otherwise(F.lit(0.0))
    score = F.least(F.lit(100.0), F.greatest(F.lit(0.0), score))
    reasons = F.concat_ws("; ", *[F.when(F.coalesce(cond, F.lit(False)), F.lit(txt)) for cond, _, txt in rules])
    return df.select("*", score.alias("rule_risk_score"), (score >= threshold).cast("int").alias("rule_label"),
                     F.when(reasons == "", F.lit(config.TRUST_NO_RULE)).otherwise(reasons).alias("rule_reasons"))
