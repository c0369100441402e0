"""Golden nine-device simulation (no install table): scores and reasons."""

import pytest
from pyspark.sql import types as T

from voltwatch import build_health_features

SCHEMA = T.StructType([
    T.StructField("Serial", T.StringType()), T.StructField("Device_Type", T.StringType()),
    T.StructField("Last_Heard", T.StringType()), T.StructField("LineCurrent", T.DoubleType()),
    T.StructField("LineTemperature", T.DoubleType()), T.StructField("BatteryLevel", T.DoubleType()),
    T.StructField("BatteryLatestReport", T.StringType()), T.StructField("Latitude", T.DoubleType()),
    T.StructField("Longitude", T.DoubleType()),
])

ROWS = [
    ("SIM001", "ZM1", "2025-01-01", 0.0, 75.0, 5.0, "2023-01-01", 27.90, -82.40),
    ("SIM002", "ZM1", "2025-01-10", 3.0, 45.0, 25.0, "2024-06-01", 27.91, -82.41),
    ("SIM003", "ZM1", "2025-01-15", 15.0, 20.0, 90.0, "2025-01-14", 27.92, -82.42),
    ("SIM004", "UM3", "2024-12-15", 0.0, 60.0, None, None, 27.93, -82.43),
    ("SIM005", "UM3", "2025-01-08", 10.0, 42.0, None, None, 27.94, -82.44),
    ("SIM006", "UM3", "2025-01-15", 15.0, 25.0, None, None, 27.95, -82.45),
    ("SIM007", "MM3", "2024-12-20", 0.0, 90.0, None, None, 27.96, -82.46),
    ("SIM008", "MM3", "2025-01-05", 12.0, 55.0, None, None, 27.97, -82.47),
    ("SIM009", "MM3", "2025-01-15", 20.0, 25.0, None, None, 27.98, -82.48),
]

EXPECTED = {
    "SIM001": (14.0, 100.00, "Battery critically low - reconfigure to verify"),
    "SIM002": (5.0, 73.93, "Normal operating conditions"),
    "SIM003": (0.0, 25.00, "Normal operating conditions"),
    "SIM004": (31.0, 100.00, "No communication for 31 days - reconfigure"),
    "SIM005": (7.0, 35.81, "Normal operating conditions"),
    "SIM006": (0.0, 20.00, "Normal operating conditions"),
    "SIM007": (26.0, 100.00, "Overheating (90.0C) - check ventilation"),
    "SIM008": (10.0, 50.46, "Normal operating conditions"),
    "SIM009": (0.0, 52.00, "High current during off-peak - investigate"),
}


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = build_health_features(df, batch_cols=[])
    return {r["Serial"]: r for r in out.collect()}


@pytest.mark.parametrize("serial", sorted(EXPECTED))
def test_golden(scored, serial):
    comm, risk, reason = EXPECTED[serial]
    row = scored[serial]
    assert row["comm_age_days"] == pytest.approx(comm)
    assert row["risk_score"] == pytest.approx(risk, abs=0.005)
    assert row["risk_reason"] == reason


def test_contract_columns(spark):
    from voltwatch.config import FEATURE_HEALTH_OUTPUT_COLUMNS
    out = build_health_features(spark.createDataFrame(ROWS, SCHEMA), batch_cols=[])
    missing = set(FEATURE_HEALTH_OUTPUT_COLUMNS) - set(out.columns)
    assert not missing


def test_scores_bounded(scored):
    for r in scored.values():
        for c in ("risk_score", "risk_score_zm1", "risk_score_um3", "risk_score_mm3"):
            assert 0.0 <= r[c] <= 100.0
