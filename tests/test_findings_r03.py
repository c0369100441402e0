"""Findings of round 3: whole gaps in profiles, inputs of the models worked out once, even training tasks."""

from datetime import date

from pyspark.sql import functions as F

from voltwatch.ml import models as M
from voltwatch.operators import failure as FL
from voltwatch.operators import health as H
from voltwatch.operators import reports as R
from voltwatch.operators import timeseries as T


def counted(df):
    """``df`` with a column ``seen``, and the number of times its rows were worked out."""
    n = df.sparkSession.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(x):
        n.add(1)
        return float(x)

    return df.select("*", seen.asNondeterministic()("x").alias("seen")), n


def test_profiles_have_gaps_from_days_without_hours(spark):
    ts = spark.createDataFrame([(1, date(2024, 1, 1), "ZM1", 50.0, 10.0, 2.5), (1, date(2024, 1, 2), "ZM1", 49.0, 12.0, 0.5)],
                               "Serial int, date date, Device_Type string, battery_level double, risk_score double, comm_age_days double")
    r = T.device_profiles(ts).first()
    assert (r.comms_gap_current_hours, r.comms_gap_avg_hours, r.comms_gap_max_hours) == (12.0, 36.0, 60.0)


def test_action_models_work_their_input_out_once(spark):
    rows = [(k, "MM3" if k % 2 else "ZM1", k // 2 % 2, float(k // 2 % 2)) for k in range(80)]
    df, n = counted(spark.createDataFrame(rows, "reading_id int, device_type_display string, action_label int, x double"))
    got = M.train_action_models(df, M.ActionParams(num_trees=2, max_depth=2), types=["ZM1", "MM3", "UM3"], feats=["seen"])
    assert list(got) == ["ZM1", "MM3"]
    for m in got.values():
        assert m["test"].where("prediction = action_label").count() == m["test"].count() == 8
    assert n.value == 80


def test_failure_dataset_works_its_series_out_once(spark):
    rows = [(k % 9, date(2024, 1, 1 + k // 9), float(k), 20.0, 1.0, float(k % 50), 0.5) for k in range(180)]
    df, n = counted(spark.createDataFrame(rows, "Serial int, date date, x double, LineTemperature_val double, LineCurrent_val double, "
                                                "device_age_months double, comm_age_days double"))
    assert FL.failure_dataset(df.withColumnRenamed("seen", "battery_level")).count() == 180 and n.value == 180


def test_training_rows_of_a_task_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(M, "ROWS_TREES", 1000)
    rows = [(k, k, float(k), k % 2) for k in range(400)]
    df = spark.createDataFrame(rows, "reading_id int, at int, BatteryLevel double, rule_label int").coalesce(1)
    df = df.select("reading_id", F.timestamp_seconds("at").alias("Last_Heard"), "BatteryLevel", "rule_label")
    train, test, _ = M.trust_split(df, trees=25)
    assert (train.count(), test.count()) == (320, 80)
    sizes = [n for n in train.rdd.glom().map(len).collect() if n]
    assert len(sizes) >= 8 and max(sizes) <= 60


def test_risk_category_report_scores_its_rows_once(spark):
    rows = [(0.0,), (10.0,), (20.0,), (20.5,), (61.0,), (81.0,), (100.0,), (100.0,)]
    df, n = counted(spark.createDataFrame(rows, "x double"))
    got = R.risk_category_report(df.withColumnRenamed("seen", "risk_score")).collect()
    assert n.value == 8
    assert {r.risk_category: r.devices for r in got} == {"Low (0-20)": 2, "Medium (21-40)": 1, "Critical (61-80)": 1, "Emergency (81-100)": 3}
    assert {(r.devices_over_60, r.devices_over_80, r.pct_over_60, r.pct_over_80) for r in got} == {(4, 3, 50.0, 37.5)}
    assert sum(r.pct for r in got) == 87.5  # the row without risk is in no category, but in the total


def test_risk_category_report_filters_above_the_score(spark):
    df = spark.range(100).select(F.sqrt(F.col("id") * 9.0).alias("risk_score"))
    plan = R.risk_category_report(df)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "SQRT" in line]
    assert plan.count("Range (0, 100") == 1 and "transform(" not in plan


def test_histogram_and_top_risk_score_their_rows_once(spark):
    rows = [(None,), (0.0,), (5.0,), (10.0,)]
    df, n = counted(spark.createDataFrame([(k, float(k % 5)) for k in range(40)], "Serial int, x double").coalesce(1))
    h = {r.bin: r["count"] for r in R.histogram(df, "seen", 4).collect()}
    assert h == {0: 8, 1: 8, 2: 8, 3: 16} and n.value == 40
    some = spark.createDataFrame(rows, "x double")
    assert [(r["count"], r.ecdf) for r in R.histogram(some, "x", 2).orderBy("bin").collect()] == [(1, 1 / 3), (2, 1.0)]
    scored = spark.range(5).select(F.col("id").alias("Serial"), F.when(F.col("id") != 4, F.sqrt(F.col("id") * 9.0)).alias("risk_score"))
    top = H.get_top_risk_devices(scored, 4)
    assert [r.Serial for r in top.collect()] == [3, 2, 1]
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("SQRT")
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
