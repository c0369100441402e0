"""The prediction job over saved bundles: folders in order, both sides of the confidence gate, override, union, labels."""

import pytest
from pyspark.sql import functions as F

from voltwatch.ml import bundles as B
from voltwatch.ml import models as M

AS_OF = "2024-01-31 00:00:00"
SCHEMA = "Serial string, Device_Type string, Status string, BatteryLatestReport string, Last_Heard string, BatteryLevel string, Latitude double, Longitude double, reading_id bigint"


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """MM3: sure of its answers; ZM1: answers between 0.5 and 0.95, in the fallback folder alone."""
    top = tmp_path_factory.mktemp("models")
    sure = spark.createDataFrame([(float(k % 2), 0.0, 2 * (k % 2)) for k in range(200)], "coord_missing_flag double, absent double, y int")
    torn = spark.createDataFrame([(float(k % 5), int(k // 5 % 3 > 0)) for k in range(200)], "BatteryLevel double, y int")
    for name, df, feats in (("MM3/new", sure, ["coord_missing_flag", "absent"]), ("ZM1/old", torn, ["BatteryLevel"])):
        res = M.train_action_models(df.withColumn("t", F.lit(name[:3])), M.ActionParams(num_trees=3, max_depth=3, min_instances_per_node=40 if "ZM1" in name else 1), "t", "y", [name[:3]], feats)
        M.save_bundle(res[name[:3]]["model"], feats, f"{top}/{name}")
    B.write_manifest(spark, {"MM3": [f"{top}/MM3/new", f"{top}/MM3/old"], "ZM1": [f"{top}/ZM1/new", f"{top}/ZM1/old"], "UM3+": [f"{top}/UM3"]}, f"{top}/manifest")
    return top


@pytest.fixture(scope="module")
def history(spark):
    rows = [
        ("m1", "MM3", "ONLINE", "2024-01-30", "2024-01-30", "90", 1.0, 1.0, 1), ("m1", "MM3", "ONLINE", "2023-01-01", None, "1", 0.0, 0.0, 2),
        ("m2", "mm3", "ONLINE", "2024-01-30", None, "x", 0.0, None, 3), ("m3", "MM3", "ONLINE", "2024-01-30", None, None, 1.0, 1.0, 4),
        ("z1", "ZM1", "ONLINE", "2024-01-30", None, "3", 1.0, 1.0, 5), ("z2", " zm1", "ONLINE", "2023-06-01", None, "80%", 1.0, 1.0, 6),
        ("z3", "ZM1", "ONLINE", "2024-01-10", None, "2", 1.0, 1.0, 7), ("u1", "UM3", "ONLINE", "2024-01-30", None, "50", 1.0, 1.0, 8), ("n1", None, None, None, None, None, None, None, 9),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_folders_in_order_and_broken_bundles(spark, folders):
    named = B.read_manifest(spark, f"{folders}/manifest")
    found = B.find_bundles(spark, named)
    assert {k: b.folder for k, b in found.items()} == {"MM3": f"{folders}/MM3/new", "ZM1": f"{folders}/ZM1/old"}
    assert found["MM3"].features == ("coord_missing_flag", "absent")
    found["ZM1"].model.write().save(f"{folders}/ZM1/new/model")  # a newer model without features
    with pytest.raises(ValueError, match="without a feature list"):
        B.find_bundles(spark, named)
    assert M.load_bundle([f"{folders}/none"]) == (None, None)
    with pytest.raises(ValueError):
        M.load_bundle([f"{folders}/ZM1/new", f"{folders}/ZM1/old"])


def test_job(spark, folders, history):
    install = spark.createDataFrame([("m3", "2014-06-01"), ("m1", "2020-01-01")], "Serial string, InstallDate string")
    bundles = B.find_bundles(spark, {"MM3": [f"{folders}/MM3/new"], "ZM1": [f"{folders}/ZM1/old"]})
    got = {r.Serial: r for r in B.predict_daily_actions(history, install, bundles, AS_OF, ["reading_id"]).collect()}
    assert set(got) == {"m1", "m2", "m3", "z1", "z2", "z3"}
    assert got["m2"].BatteryLevel == "x" and got["z2"].BatteryLevel == "80%"  # rows as they came
    # the model is sure: its answers stand, but for the device past 90 % of its life
    assert [(got[s].PredictedActionName, got[s].PredictedActionLabel, got[s].UsedRuleFallback, got[s].AgeOverride) for s in ("m1", "m2", "m3")] == [
        ("NO_ACTION", 0, False, False), ("REPLACE", 2, False, False), ("REPLACE", 2, False, True)]
    assert all(got[s].Confidence >= 0.95 for s in ("m1", "m2", "m3"))
    # the model is not sure: the rules decide (silent for over 90 days; for 21 days)
    assert all(0.5 <= got[s].Confidence < 0.95 and got[s].UsedRuleFallback for s in ("z1", "z2", "z3"))
    assert [got[s].PredictedActionName for s in ("z1", "z2", "z3")] == ["NO_ACTION", "REPLACE", "RECONFIGURE"]
    assert (got["m1"].prev_lat, got["m1"].coord_changed_flag) == (None, 0)
    low = B.predict_daily_actions(history, install, bundles, AS_OF, ["reading_id"], threshold=0.1)
    assert low.where("UsedRuleFallback").count() == 0
    whole = {r.device_type: r for r in B.summary(B.predict_daily_actions(history, install, bundles, AS_OF, ["reading_id"])).collect()}
    assert (whole[None].devices, whole[None].rule_fallback, whole[None].age_override, whole[None].confident, whole["ZM1"].REPLACE) == (6, 3, 1, 3, 1)


def test_types_without_a_bundle(spark, folders, history):
    one = B.find_bundles(spark, {"MM3": [f"{folders}/MM3/new"]})
    assert {r.device_type for r in B.predict_daily_actions(history, None, one, AS_OF).collect()} == {"MM3"}
    rules = B.predict_daily_actions(history, None, one, AS_OF, missing="rules")
    assert {(r.Serial, r.UsedRuleFallback) for r in rules.collect() if r.device_type == "ZM1"} == {("z1", True), ("z2", True), ("z3", True)}
    assert B.predict_daily_actions(history, None, {}, AS_OF).count() == 0


def test_latest_rows_are_shuffled_once(spark, folders, history):
    bundles = B.find_bundles(spark, {"MM3": [f"{folders}/MM3/new"], "ZM1": [f"{folders}/ZM1/old"]})
    df = B.predict_daily_actions(history, None, bundles, AS_OF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan or plan.count("Exchange hashpartitioning") <= 1
