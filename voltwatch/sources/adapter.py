"""Test adapter: the driver's generic tables seen as device readings.

``events`` becomes one reading per event, ``orders`` yields install dates and
signup events with a large value form the reconfigure-attempt log.  The same
definitions exist as SQL in ``oracle/adapter.py`` for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-31 00:00:00"
DAY_MICROS = 86400 * 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    uid = F.col("user_id")
    kind = uid % 3
    k = F.get_json_object("props", "$.k").cast("int")
    ts = F.col("ts").cast("timestamp")
    signup = F.col("event_type") == "signup"
    odd = F.col("event_id") % 29 == 0
    dev = (F.when(kind == 0, F.when(uid % 10 == 3, F.lit("zm1 ")).otherwise(F.lit("ZM1")))
           .when(kind == 1, F.when(uid % 10 == 4, F.lit(" Mm3")).otherwise(F.lit("MM3")))
           .otherwise(F.when(uid % 10 == 5, F.lit("UM3+")).otherwise(F.lit("UM3"))))
    status = (F.when(F.col("event_type") == "error", F.lit("OFFLINE"))
              .when(F.col("event_type") == "click", F.lit("ONLINE"))
              .when(F.col("event_type") == "view", F.lit("STANDBY"))
              .when(F.col("event_type") == "purchase", F.lit("INTERMITTENT")))
    return ev.select(
        F.col("event_id").alias("reading_id"),
        uid.alias("Serial"),
        dev.alias("Device_Type"),
        status.alias("Status"),
        ts.alias("Last_Heard"),
        F.to_date(ts).alias("batch_date"),
        F.when((kind == 0) & ~signup, k.cast("double")).alias("BatteryLevel"),
        F.when(kind == 0, F.timestamp_micros(F.unix_micros(ts) - k.cast("long") * 3 * DAY_MICROS))
        .alias("BatteryLatestReport"),
        F.when(kind == 1, F.when(signup, F.lit(0.0)).otherwise(F.round(F.col("value") * 4.0, 2)))
        .alias("LineCurrent"),
        F.when(kind == 1, (k - 5).cast("double")).alias("LineTemperature"),
        F.when(odd, F.lit(0.0)).otherwise(F.lit(27.9) + (F.col("event_id") % 7) * F.lit(0.0002)).alias("Latitude"),
        F.when(odd, F.lit(0.0)).otherwise(F.lit(-82.4) - uid * F.lit(0.001)).alias("Longitude"),
    )


def install_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_custkey").alias("Serial"))
            .agg(F.add_months(F.to_date(F.min("o_orderdate")), 240).cast("timestamp").alias("InstallDate")))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return (ev.where((F.col("event_type") == "signup") & (F.col("value") > 100))
            .select(F.col("user_id").alias("Serial"),
                    F.to_date(F.col("ts").cast("timestamp")).cast("timestamp").alias("attempt_date")))
