"""Rule-level checks modelled on the reference's verification cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltwatch import build_health_features
from voltwatch.operators import labels as L
from voltwatch.operators.health import with_risk_reason

REASON_SCHEMA = T.StructType([
    T.StructField("Serial", T.StringType()), T.StructField("Device_Type", T.StringType()),
    T.StructField("pct_life_used", T.DoubleType()), T.StructField("battery_low_flag", T.IntegerType()),
    T.StructField("comm_age_days", T.DoubleType()), T.StructField("LineTemperature_val", T.DoubleType()),
    T.StructField("LineCurrent_val", T.DoubleType()), T.StructField("overheat_flag", T.IntegerType()),
    T.StructField("critical_current_flag", T.IntegerType()), T.StructField("high_current_flag", T.IntegerType()),
    T.StructField("zero_current_flag", T.IntegerType()),
])

REASON_ROWS = [
    ("TEST001", "ZM1", 0.2, 0, 2.0, None, None, 0, 0, 0, 0),
    ("TEST002", "ZM1", 0.6, 1, 5.0, None, None, 0, 0, 0, 0),
    ("TEST003", "MM3", 0.5, 0, 3.0, 90.0, 400.0, 1, 0, 0, 0),
    ("TEST004", "MM3", 0.4, 0, 2.0, 30.0, 900.0, 0, 1, 0, 0),
    ("TEST005", "UM3", 0.3, 0, 45.0, None, None, 0, 0, 0, 0),
]

EXPECTED = {
    "TEST001": "Missing Last_Heard date, Missing battery data - check telemetry",
    "TEST002": "Missing Last_Heard date, Missing battery data - check telemetry",
    "TEST003": "Missing Last_Heard date, Overheating (90.0C) - check ventilation",
    "TEST004": "Missing Last_Heard date, CRITICAL: Current 900.0A exceeds max (850A)",
    "TEST005": "Missing Last_Heard date, No communication for 45 days - reconfigure",
}


def test_reason_rows(spark):
    """Rows without Last_Heard or BatteryLevel, as in the reference's reason check."""
    df = spark.createDataFrame(REASON_ROWS, REASON_SCHEMA).select(
        "*", F.lit(0).alias("reconfigure_count"), F.lit(0.0).alias("battery_drain_rate"),
        F.lit(0).alias("gps_jump_flag"), F.lit(0).alias("low_current_flag"), F.lit(0).alias("high_offpeak_flag"),
        F.lit(None).cast("timestamp").alias("Last_Heard_dt"), F.lit(True).alias("_lh_raw_missing"),
        F.lit(True).alias("_battery_missing"))
    got = {r["Serial"]: r["risk_reason"] for r in with_risk_reason(df, F.lit(0)).collect()}
    assert got == EXPECTED


@pytest.mark.parametrize("p,yearly", [(0.0, 10.0), (0.25, 11.25), (0.5, 15.0), (0.75, 21.25), (0.9, 26.2)])
def test_design_drain_model(spark, p, yearly):
    lh = dt.datetime(2025, 1, 1)
    inst = lh - dt.timedelta(days=p * 3650)
    df = spark.createDataFrame([("D1", "ZM1", lh, 80.0, lh)],
                               "Serial string, Device_Type string, Last_Heard timestamp, BatteryLevel double, "
                               "BatteryLatestReport timestamp")
    install = spark.createDataFrame([("D1", inst)], "Serial string, InstallDate timestamp")
    row = build_health_features(df, install=install, batch_cols=[], drain_model="design").first()
    assert row["pct_life_used"] == pytest.approx(p)
    assert row["battery_drain_rate"] == pytest.approx(yearly)
    assert row["aging_acceleration_factor"] == pytest.approx(1 + 2 * p * p)


def test_observed_drain_parity_floor(spark):
    """Parity default: the router's pre-created zero drain floors at 0.1 %/year."""
    lh = dt.datetime(2025, 1, 1)
    df = spark.createDataFrame([("D1", "ZM1", lh, 80.0, lh)],
                               "Serial string, Device_Type string, Last_Heard timestamp, BatteryLevel double, "
                               "BatteryLatestReport timestamp")
    row = build_health_features(df, batch_cols=[]).first()
    assert row["battery_drain_rate"] == pytest.approx(0.1)
    assert row["battery_drain_rate_per_day"] == pytest.approx(0.1 / 365)


def _label(spark, rows):
    schema = ("Serial string, Device_Type string, BatteryLatestReport timestamp, Last_Heard timestamp, "
              "BatteryLevel double, LineCurrent double, LineTemperature double, Latitude double, Longitude double, "
              "Status string, reconfigure_count int, comm_age_days double, pct_life_used double")
    df = spark.createDataFrame(rows, schema)
    return {r["Serial"]: r["action_name"] for r in L.label_actions(L.label_flags(df)).collect()}


def test_label_rules_last_writer_wins(spark):
    t = dt.datetime(2024, 1, 30)
    rows = [
        # ZM1 first time: comm 20 days -> RECONFIGURE
        ("Z1", "ZM1", t, t, 50.0, None, None, 27.9, -82.4, "ONLINE", 0, 20.0, 10.0),
        # ZM1 retried, low battery -> REPLACE
        ("Z2", "ZM1", t, t, 10.0, None, None, 27.9, -82.4, "ONLINE", 1, 1.0, 10.0),
        # ZM1 past 90 % life -> REPLACE even with nothing else
        ("Z3", "zm1", t, t, 80.0, None, None, 27.9, -82.4, "ONLINE", 0, 1.0, 95.0),
        # MM3 zero current, never reconfigured -> RECONFIGURE
        ("M1", "MM3", None, t, None, 0.0, 40.0, 27.9, -82.4, "ONLINE", 0, 1.0, 10.0),
        # MM3 overheating after a reconfigure -> REPLACE
        ("M2", "MM3", None, t, None, 50.0, 90.0, 27.9, -82.4, "ONLINE", 1, 1.0, 10.0),
        # MM3 coordinates missing after reconfigure: coordinate rule is written last -> RECONFIGURE
        ("M3", "MM3", None, t, None, 50.0, 90.0, 0.0, -82.4, "ONLINE", 2, 1.0, 10.0),
        # healthy MM3 -> NO_ACTION
        ("M4", "MM3", None, t, None, 50.0, 40.0, 27.9, -82.4, "ONLINE", 0, 1.0, 10.0),
    ]
    assert _label(spark, rows) == {"Z1": "RECONFIGURE", "Z2": "REPLACE", "Z3": "REPLACE", "M1": "RECONFIGURE",
                                   "M2": "REPLACE", "M3": "RECONFIGURE", "M4": "NO_ACTION"}


@pytest.mark.parametrize("batch", [[], ["batch_date"]])
def test_single_pass_equals_two_pass(spark, batch):
    from voltwatch.sources import adapter as A
    sf = "/root/testdata/sf0.001"
    args = dict(install=A.install_dates(spark, sf), attempts=A.attempts(spark, sf), batch_cols=batch,
                order_cols=["reading_id"])
    cols = ["reading_id", "comm_age_days", "pct_life_used", "battery_report_age_days", "age_adjusted_battery_risk",
            "maintenance_urgency_score", "risk_score_zm1", "risk_score_um3", "risk_score_mm3", "risk_score",
            "risk_reason"]
    one = build_health_features(A.readings(spark, sf), **args).select(cols)
    two = build_health_features(A.readings(spark, sf), stats_mode="two_pass", **args).select(cols)
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_battery_trend_matches_polyfit(spark):
    """X3 cross-check: built-in regr_slope trend == numpy polyfit per device (applyInPandas, test only)."""
    import numpy as np
    import pandas as pd
    from voltwatch.plans.catalog import zm1_series
    from voltwatch.operators import timeseries as TS

    ts = zm1_series(spark, "/root/testdata/sf0.01").select("Serial", "date", "BatteryLevel")
    got = {r["Serial"]: r for r in TS.battery_trend(ts).collect()}

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date")
        x = (pd.to_datetime(pdf["date"]) - pd.to_datetime(pdf["date"].iloc[0])).dt.days.to_numpy(dtype=float)
        y = pdf["BatteryLevel"].to_numpy(dtype=float)
        if len(pdf) < 2 or x[-1] <= 0:
            return pd.DataFrame({"Serial": [], "slope": [], "icpt": []})
        slope, icpt = np.polyfit(x, y, 1) if not np.isnan(y).any() else (np.nan, np.nan)
        return pd.DataFrame({"Serial": [pdf["Serial"].iloc[0]], "slope": [slope], "icpt": [icpt]})

    ref = ts.groupBy("Serial").applyInPandas(fit, "Serial long, slope double, icpt double").collect()
    assert len(ref) == len(got) > 0
    for r in ref:
        g = got[r["Serial"]]
        if r["slope"] is None or np.isnan(r["slope"]):
            assert g["trend_slope"] is None
        else:
            assert g["trend_slope"] == pytest.approx(r["slope"], rel=1e-9, abs=1e-9)
            assert g["trend_intercept"] == pytest.approx(r["icpt"], rel=1e-9, abs=1e-9)
