"""Queries over dirty variants of the readings: text numerics, null serials, missing drains, repeated install rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import categories as C
from ..operators import failure as FL
from ..operators import labels as L
from ..operators.common import two_level_lag
from ..operators.health import build_health_features
from ..sources import adapter as A
from ..sources.files import clean_numeric
from .catalog import r6, register


def text_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with numbers as they arrive in files: thousands commas, blanks, tokens, per cent signs."""
    ev = A.table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    i = F.col("event_id")
    level = (F.when(i % 7 == 0, F.lit("NULL")).when(i % 7 == 1, F.concat(F.lit(" "), k, F.lit(" ")))
             .when(i % 7 == 2, F.concat(k, F.lit("%"))).when(i % 7 == 3, F.concat(F.lit("1,"), F.lpad(k, 3, "0")))
             .when(i % 7 == 4, F.lit("")).otherwise(k))
    return ev.select(i.alias("reading_id"), F.when(F.col("user_id") % 5 != 0, F.col("user_id")).alias("Serial"),
                     F.col("ts").cast("timestamp").alias("ts"), level.alias("BatteryLevel"),
                     F.concat((i % 12).cast("string"), F.lit(" days")).alias("days_since_last_heard"))


@register("p5_text_numerics")
def p5_text_numerics(spark, sf_dir):
    """P5: "1,234" is 1234; tokens and anything else that is no number are null."""
    return clean_numeric(text_readings(spark, sf_dir)).select("reading_id", "BatteryLevel")


@register("d14_text_rules")
def d14_text_rules(spark, sf_dir):
    """D14 + P6: rules on sanitised text numbers ("5%" is 5), battery clamped to 0..100."""
    d = FL.rule_score(text_readings(spark, sf_dir))
    return d.select("reading_id", "rule_risk_score", "rule_label")


@register("w1_null_serials")
def w1_null_serials(spark, sf_dir):
    """Previous reading per device; rows without a serial have none and are none's (-1: none)."""
    t = text_readings(spark, sf_dir)
    d = two_level_lag(t, ["Serial"], F.floor(F.unix_micros("ts") / F.lit(3600 * 1_000_000)).cast("long"),
                      [F.col("ts"), F.col("reading_id")], ["reading_id"], skip_null=["Serial"])
    return d.select("reading_id", *[F.coalesce(c, F.lit(-1)).cast("bigint").alias(c) for c in ("Serial", "prev_reading_id")])


@register("c9_ttl_observed")
def c9_ttl_observed(spark, sf_dir):
    """C9 with a drain column: no drain, no days; the category falls through to the last one."""
    h = L.canonical_type(A.readings(spark, sf_dir))
    latest = L.latest_per_device(h, "BatteryLatestReport", order_cols=["reading_id"])
    drain = F.when(F.col("Serial") % 4 != 0, (F.col("Serial") % 9) * 0.05)
    cols = C.ttl(F.col("device_type") == "ZM1", "BatteryLevel", drain)
    return latest.select("Serial", *[r6(c).alias(n) if n != "ttl_category" else c.alias(n) for n, c in cols.items()])


@register("j2_last_install")
def j2_last_install(spark, sf_dir):
    """With repeated install rows the last in the declared order wins, not the latest date."""
    o = A.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("Serial"), F.col("o_orderkey"),
                                                F.col("o_orderdate").cast("timestamp").alias("InstallDate"))
    devices = A.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("Serial"))
    d = L.with_install_lookup(devices, o, "2024-01-31", ["o_orderkey"])
    return d.select("Serial", F.date_format("InstallDate", "yyyy-MM-dd").alias("install_date"), "device_age_days")


@register("d6_drain_by_batch")
def d6_drain_by_batch(spark, sf_dir):
    """D6 over days with and without drains: the whole day's ZM1 devices drain by design where none reports a drain."""
    r = A.readings(spark, sf_dir)
    drain = F.when((F.dayofmonth("batch_date") % 2 == 0) & (F.col("reading_id") % 3 != 0), (F.col("Serial") % 9) * 0.02)
    h = build_health_features(r.withColumn("battery_drain_rate_per_day", drain), install=A.install_dates(spark, sf_dir),
                              attempts=A.attempts(spark, sf_dir), batch_cols=["batch_date"], order_cols=["reading_id"])
    return h.select("reading_id", *[r6(c).alias(c) for c in ("battery_drain_rate", "age_adjusted_battery_risk",
                                                            "maintenance_urgency_score", "risk_score")], "risk_reason")
