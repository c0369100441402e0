"""Parts of several schemas, and the whole export's helpers."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltwatch.operators import export as X
from voltwatch.operators import frames as FR
from voltwatch.operators import failure as FL
from voltwatch.operators import timeseries as TS
from voltwatch.sources import schemas
from voltwatch.sources.files import SNAPSHOT_COLUMNS
from voltwatch.streaming import ingest as ST


def jobs_of(spark, group, run):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    run()
    sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def day(folder, date, rows, columns=SNAPSHOT_COLUMNS):
    folder.mkdir(exist_ok=True)
    lines = [",".join(str(r.get(c, "")) for c in columns) for r in rows]
    (folder / f"snapshot {date}.csv").write_text("\n".join([",".join(columns), *lines]) + "\n")


def reading(serial, battery, report, **more):
    return {"Serial": serial, "Device_Type": "ZM1", "BatteryLevel": battery, "BatteryLatestReport": f"{report} 08:00:00", **more}


def test_history_of_two_schemas(spark, tmp_path):
    old, new, hist = tmp_path / "old", tmp_path / "new", str(tmp_path / "hist")
    wide = [*SNAPSHOT_COLUMNS, "Firmware"]
    day(old, "2025-01-14", [reading("A1", 70, "2025-01-14"), reading("B1", 60, "2025-01-14")])
    day(new, "2025-01-15", [reading("A1", 71, "2025-01-14", Firmware="v2"), reading("C1", 50, "2025-01-15", Firmware="v2")], wide)
    ST.stream_ingest(spark, str(old), hist, str(tmp_path / "c1")).awaitTermination()
    ST.stream_ingest(spark, str(new), hist, str(tmp_path / "c2"), wide).awaitTermination()
    assert len(set(schemas.registered(spark, hist).values())) == 2

    def got():
        return {r.Serial: (r.BatteryLevel, r.Firmware) for r in ST.read_history(spark, hist).collect()}

    want = {"A1": (71.0, "v2"), "B1": (60.0, None), "C1": (50.0, "v2")}
    assert got() == want
    assert jobs_of(spark, "plan history", lambda: ST.read_history(spark, hist)) == 0  # no footer is read to plan it
    ST.compact_history(spark, hist)
    assert got() == want
    day(tmp_path / "third", "2025-01-16", [reading("B1", 59, "2025-01-14")])
    ST.stream_ingest(spark, str(tmp_path / "third"), hist, str(tmp_path / "c3")).awaitTermination()
    assert got() == {**want, "B1": (59.0, None)}


def test_parts_of_other_types_and_unnoted_parts(spark, tmp_path):
    root = str(tmp_path / "t")
    parts = {"p=1": "a int, b string", "p=2": "a double, c date", "p=3": "a bigint, b int"}
    rows = {"p=1": [(1, "x")], "p=2": [(2.5, __import__("datetime").date(2025, 1, 1))], "p=3": [(3, 7)]}
    for p, s in parts.items():
        df = spark.createDataFrame(rows[p], s)
        if p != "p=3":
            schemas.register(spark, root, df.schema, p)
        df.write.parquet(f"{root}/{p}")
    df = schemas.read_parts(spark, root, sorted(parts))
    assert dict(df.dtypes) == {"a": "double", "b": "string", "c": "date", "p": "int"}
    assert sorted((r.p, r.a, r.b) for r in df.collect()) == [(1, 1.0, "x"), (2, 2.5, None), (3, 3.0, "7")]
    assert schemas.common_type([T.LongType(), T.FloatType()]) == T.DoubleType()
    assert schemas.common_type([T.DateType(), T.TimestampType()]) == T.TimestampType()
    assert schemas.common_type([T.BooleanType(), T.LongType()]) == T.StringType()


def test_profile_risk_and_order(spark):
    prof = spark.createDataFrame([(1, "ZM1", 85.0, "hot"), (2, "MM3", 10.0, "ok"), (3, "ZM1", None, None), (4, "ZM1", 90.0, "old")],
                                 "Serial int, Device_Type_Standardized string, risk_score_current double, risk_reason_current string")
    base = spark.createDataFrame([(1, "before"), (2, "before"), (9, "before")], "Serial int, risk_reason string")
    got = {r.Serial: (r.risk_score, r.risk_reason, r.is_critical_risk) for r in FR.with_profile_risk(base, prof).collect()}
    assert got == {1: (85.0, "hot", True), 2: (10.0, "ok", False), 9: (None, None, False)}
    assert FR.with_profile_risk(base, base) is base
    assert [r.Serial for r in TS.ordered_profiles(prof).collect()] == [2, 4, 1, 3]


def test_ttl_choice_of_drain_and_install_age(spark):
    rows = [(1, "ZM1", 54.0, 0.5, 400.0), (2, "ZM1", 54.0, None, None), (3, "MM3", 54.0, 0.5, 36500.0)]
    df = spark.createDataFrame(rows, "Serial int, t string, b double, d double, device_age_days double")
    seen = {r.Serial: (r.ttl_days, r.ttl_category) for r in X.with_ttl(df, "b", "d", "t").collect()}
    assert seen == {1: (108.0, "Soon (3-6 months)"), 2: (None, "Future (>1 year)"), 3: (None, "Unknown")}
    none = {r.Serial: r.ttl_days for r in X.with_ttl(df.where("Serial > 1"), "b", "d", "t").collect()}
    assert none == {2: 54.0 / 0.027, 3: None}
    assert X.with_ttl(df.drop("d"), "b", "d", "t").where("Serial = 1").first().ttl_days == 54.0 / 0.027
    ages = {r.Serial: (r.device_age_years, r.age_category) for r in X.with_install_age(df).collect()}
    assert ages == {1: (1.1, "1-2 years"), 2: (None, "<6 months"), 3: (100.0, "10+ years")}


def test_totals_of_an_empty_export(spark):
    df = spark.createDataFrame([], "battery_current double, days_until_battery_critical double, ttl_days double, device_age_days double, "
                                   "is_critical_device boolean, PredictedAction string, Device_Type_Standardized string")
    got = X.export_totals(df).collect()
    assert len(got) == 14 and all(r.devices == 0 and r.value is None for r in got)


def test_status_spellings(spark):
    df = spark.createDataFrame([("offline ",), ("Off Line",), ("OFF-LINE",), ("off  line",), ("Active",), (None,)], "s string")
    assert [r[0] for r in df.select(FL.status_failure(F.col("s"))["status_failure"]).collect()] == [1, 1, 1, 0, 0, 0]
