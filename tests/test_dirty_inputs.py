"""Dirty inputs: CSV files of other headers, text numerics, missing paths, new checkpoints, null keys, missing values."""

import pytest
from pyspark.sql import functions as F

from voltwatch.functions import categories as C
from voltwatch.operators import export as X_
from voltwatch.operators import failure as FL
from voltwatch.operators import labels as L
from voltwatch.operators.common import two_level_lag
from voltwatch.sources import files as S
from voltwatch.streaming import ingest as I


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


@pytest.fixture()
def days(tmp_path):
    src = tmp_path / "raw"
    put(src / "daily_2024-01-01.csv", "Serial,BatteryLevel,LineCurrent\n1,60,9\n2,\"1,234\",NULL\n")
    put(src / "daily_2024-01-02.csv", "Serial,LineCurrent,BatteryLevel\n1,9,60\n")
    put(src / "daily_2024-01-03.csv", "Extra,Serial,BatteryLevel\nx,3,50%\n")
    return src


def test_snapshots_by_name(spark, days):
    got = S.read_snapshots(spark, str(days))
    rows = {(r["_source_file"][6:16], r.Serial): (r.BatteryLevel, r.LineCurrent, r.Extra) for r in got.collect()}
    assert rows == {("2024-01-01", "1"): ("60", "9", None), ("2024-01-01", "2"): ("1,234", "NULL", None),
                    ("2024-01-02", "1"): ("60", "9", None), ("2024-01-03", "3"): ("50%", None, "x")}
    assert S.read_snapshots(spark, str(days), ["Serial", "Status"]).columns[:2] == ["Serial", "Status"]


def test_ingest_cleans_numbers_and_reads_new_files_only(spark, days, tmp_path):
    manifest, history = str(tmp_path / "manifest"), str(tmp_path / "history")
    rows, names = S.ingest_new(spark, str(days), manifest)
    assert {(r.Serial, r.BatteryLevel, r.LineCurrent) for r in rows.collect()} == {("1", 60.0, 9.0), ("2", 1234.0, None), ("3", None, None)}
    assert names.count() == 3
    S.mark_processed(names, manifest)
    put(days / "daily_2024-01-04.csv", "Serial,BatteryLevel\n9,1\n")
    rows, names = S.ingest_new(spark, str(days), manifest)
    assert [r.Serial for r in rows.collect()] == ["9"] and [r.file_name for r in names.collect()] == ["daily_2024-01-04.csv"]
    assert S.ingest_new(spark, str(days), manifest, history_path=history)[1].count() == 4  # no history: every file
    S.mark_processed(names, manifest)
    rows, names = S.ingest_new(spark, str(days), manifest)
    assert rows.count() == 0 and names.count() == 0


def test_attempts_by_name_and_only_a_missing_path_is_empty(spark, tmp_path):
    put(tmp_path / "a" / "x.csv", "attempt_date,Serial\n2024-01-01,7\n")
    assert [tuple(r) for r in S.read_attempts(spark, str(tmp_path / "a")).collect()] == [("7", "2024-01-01")]
    assert S.read_attempts(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception):
        S.read_attempts(spark, "nosuchscheme://x/y").count()


def test_a_new_checkpoint_adds_to_the_history(spark, tmp_path):
    cols = ["Serial", "BatteryLatestReport", "BatteryLevel", "Last_Heard"]
    src, history = tmp_path / "in", str(tmp_path / "history")
    put(src / "daily_2024-01-01.csv", ",".join(cols) + '\n1,2024-01-01 00:00:00,"1,000",\n1,2024-01-01 00:00:00,7,\n')
    I.stream_ingest(spark, str(src), history, str(tmp_path / "c1"), cols).awaitTermination()
    put(src / "daily_2024-01-02.csv", ",".join(cols) + "\n2,2024-01-02 00:00:00,5,\n")
    I.stream_ingest(spark, str(src), history, str(tmp_path / "c2"), cols).awaitTermination()
    got = {(r.Serial, r.BatteryLevel) for r in I.read_history(spark, history).collect()}
    assert got == {("1", 7.0), ("2", 5.0)}  # inside a file the last row wins; the first file's rows are still there


def test_null_serials_have_no_previous_row(spark):
    rows = [(None, 1, 10.0), (None, 2, 50.0), (5, 1, 1.0), (5, 2, 2.0)]
    df = spark.createDataFrame(rows, "Serial long, t int, v double")
    got = two_level_lag(df, ["Serial"], F.col("t").cast("long"), [F.col("t")], ["v"], skip_null=["Serial"])
    assert {(r.Serial, r.t, r.prev_v) for r in got.collect()} == {(None, 1, None), (None, 2, None), (5, 1, None), (5, 2, 1.0)}


def test_rules_read_numbers_in_text(spark):
    df = spark.createDataFrame([("5%", "8 days"), ("140", "0"), ("-5", None), ("N/A", "")], "BatteryLevel string, days_since_last_heard string")
    got = {r.BatteryLevel: (r.rule_risk_score, r.rule_label) for r in FL.rule_score(df).collect()}
    assert got["5%"] == (100.0, 1) and got["140"] == (0.0, 0) and got["-5"] == (65.0, 1) and got["N/A"] == (0.0, 0)


def test_predictions_and_ttl_of_what_is_missing(spark):
    df = spark.createDataFrame([(1,), (2,)], "Serial long")
    pred = spark.createDataFrame([(1, "REPLACE", 2, 0.97)], "Serial long, PredictedActionName string, PredictedActionLabel int, Confidence double")
    got = {r.Serial: (r.PredictedAction, r.PredictionConfidence) for r in X_.with_predictions(df, pred, "2024-01-31").collect()}
    assert got == {1: ("REPLACE", 0.97), 2: ("NO_ACTION", 0.0)}
    t = spark.createDataFrame([(50.0, 0.5), (50.0, None)], "b double, d double")
    parts = C.ttl(F.lit(True), "b", "d")
    got = [(r.ttl_days, r.ttl_category) for r in t.select(*[c.alias(n) for n, c in parts.items()]).collect()]
    assert got == [(100.0, "Soon (3-6 months)"), (None, "Future (>1 year)")]


def test_the_last_install_row_in_declared_order_wins(spark):
    df = spark.createDataFrame([(1,)], "Serial long")
    install = spark.createDataFrame([(1, "2024-01-01 00:00:00", 1), (1, "2020-01-01 00:00:00", 2)], "Serial long, InstallDate string, n int")
    assert str(L.with_install_lookup(df, install, "2024-01-31", ["n"]).first().InstallDate)[:4] == "2020"
    assert str(L.with_install_lookup(df, install.drop("n"), "2024-01-31").first().InstallDate)[:4] == "2024"
