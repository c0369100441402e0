"""CSV / ZIP sources, incremental ingest, and batch == streaming."""

import io
import os
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F

from voltwatch import build_health_features
from voltwatch.operators import quality as Q
from voltwatch.sources import files as S
from voltwatch.streaming import ingest as ST

HEADER = ",".join(S.SNAPSHOT_COLUMNS)


def _row(serial, typ, lh, batt="", blr="", cur="", temp="", lat="27.9", lon="-82.4", status="ONLINE"):
    vals = {c: "" for c in S.SNAPSHOT_COLUMNS}
    vals.update(Serial=serial, Device_Type=typ, Last_Heard=lh, BatteryLevel=batt, BatteryLatestReport=blr,
                LineCurrent=cur, LineTemperature=temp, Latitude=lat, Longitude=lon, Status=status)
    return ",".join(vals[c] for c in S.SNAPSHOT_COLUMNS)


DAYS = {
    "2025-01-14": [_row("A1", "ZM1", "2025-01-14 08:00:00", "60", "2025-01-10"),
                   _row("B1", " um3 ", "2025-01-13 09:00:00"),
                   _row("C1", "MM3", "2025-01-14 07:00:00", cur="\"1,234\"", temp="85%"),
                   _row("D1", "M3", "N/A", cur="--", temp="NULL")],
    "2025-01-15": [_row("A1", "ZM1", "2025-01-15 08:00:00", "58", "2025-01-14"),
                   _row("B1", "UM3", "2025-01-15 10:00:00"),
                   _row("C1", "MM3", "2025-01-15 07:30:00", cur="720", temp="60"),
                   _row("E1", "None", "2025-01-15 01:00:00")],
}


def _write_day(folder, day, rows):
    with open(os.path.join(folder, f"snapshot_{day}.csv"), "w") as fh:
        fh.write(HEADER + "\n" + "\n".join(rows) + "\n")


@pytest.fixture()
def raw_dir():
    d = tempfile.mkdtemp(prefix="vw-src-")
    for day, rows in DAYS.items():
        _write_day(d, day, rows)
    return d


def test_read_snapshots_lineage(spark, raw_dir):
    df = S.read_snapshots(spark, raw_dir, S.SNAPSHOT_COLUMNS)
    got = {(r["_source_file"], str(r["batch_date"])) for r in df.select("_source_file", "batch_date").collect()}
    assert got == {("snapshot_2025-01-14.csv", "2025-01-14"), ("snapshot_2025-01-15.csv", "2025-01-15")}
    assert dict(df.dtypes)["BatteryLevel"] == "string"


def test_quality_gate_on_raw(spark, raw_dir):
    g = Q.quality_gate(S.read_snapshots(spark, raw_dir, S.SNAPSHOT_COLUMNS))
    res = {(r["Serial"], r["date"]): (r["is_valid"], r["rejection_reason"]) for r in g.collect()}
    assert res[("A1", "2025-01-14")] == (True, None)
    assert res[("E1", "2025-01-15")] == (False, "Unknown device type")
    assert res[("D1", "2025-01-14")] == (False, "Unknown device type")  # 'M3' names no known type
    assert res[("B1", "2025-01-14")] == (True, None)


def test_health_on_raw_strings_per_file(spark, raw_dir):
    df = S.read_snapshots(spark, raw_dir, S.SNAPSHOT_COLUMNS)
    hf = build_health_features(df, batch_cols=["_source_file"])
    rows = {(r["Serial"], r["date"]): r for r in hf.collect()}
    c1 = rows[("C1", "2025-01-14")]
    assert c1["LineCurrent_val"] == 0.0  # '1,234' is not a number for the scorer
    assert rows[("C1", "2025-01-15")]["high_current_flag"] == 1
    assert all(0 <= r["risk_score"] <= 100 for r in rows.values())


def test_batch_equals_streaming(spark, raw_dir):
    out = tempfile.mkdtemp(prefix="vw-out-")
    q = ST.stream_score(spark, raw_dir, out + "/scored", out + "/ckpt")
    q.awaitTermination()
    streamed = spark.read.parquet(out + "/scored").drop("ingest_batch")
    batch = build_health_features(S.read_snapshots(spark, raw_dir, S.SNAPSHOT_COLUMNS), batch_cols=["_source_file"])
    cols = ["Serial", "date", "risk_score", "risk_reason", "comm_age_days"]
    assert sorted(map(tuple, streamed.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))


def test_stream_ingest_exactly_once(spark, raw_dir):
    out = tempfile.mkdtemp(prefix="vw-hist-")
    ST.stream_ingest(spark, raw_dir, out + "/history", out + "/ckpt").awaitTermination()
    _write_day(raw_dir, "2025-01-16", [_row("A1", "ZM1", "2025-01-16 08:00:00", "57", "2025-01-15")])
    ST.stream_ingest(spark, raw_dir, out + "/history", out + "/ckpt").awaitTermination()
    # rerun with nothing new: no duplicates
    ST.stream_ingest(spark, raw_dir, out + "/history", out + "/ckpt").awaitTermination()
    h = spark.read.parquet(out + "/history")
    assert h.count() == 9
    assert h.select("_source_file").distinct().count() == 3
    assert ST.read_history(spark, out + "/history").count() == 9


def test_ingest_new_manifest(spark, raw_dir):
    man = tempfile.mkdtemp(prefix="vw-man-") + "/manifest"
    new, names = S.ingest_new(spark, raw_dir, man, S.SNAPSHOT_COLUMNS)
    assert new.count() == 8
    S.mark_processed(names, man)
    new2, _ = S.ingest_new(spark, raw_dir, man, S.SNAPSHOT_COLUMNS)
    assert new2.count() == 0


def test_zip_source(spark):
    d = tempfile.mkdtemp(prefix="vw-zip-")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for day, rows in DAYS.items():
            zf.writestr(f"inner/snapshot_{day}.csv", HEADER + "\n" + "\n".join(rows) + "\n")
    with open(os.path.join(d, "bundle.zip"), "wb") as fh:
        fh.write(buf.getvalue())
    z = S.read_zipped_snapshots(spark, d)
    assert z.count() == 8
    assert {r[0] for r in z.select("batch_date").distinct().collect()} == {
        __import__("datetime").date(2025, 1, 14), __import__("datetime").date(2025, 1, 15)}


def test_zip_members_of_one_archive_go_to_several_tasks(spark, tmp_path):
    extra = HEADER + ",Firmware\n" + _row("Z9", "ZM1", "2025-01-16 08:00:00") + ",v2\n"
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as zf:
        for day, rows in DAYS.items():
            zf.writestr(f"inner/snapshot_{day}.csv", HEADER + "\n" + "\n".join(rows) + "\n")
        zf.writestr("snapshot_2025-01-16.csv", extra)
        zf.writestr("empty.csv", "")
        zf.writestr("notes.txt", "no rows")
    with zipfile.ZipFile(tmp_path / "b.zip", "w", zipfile.ZIP_STORED) as zf:
        zf.writestr("snapshot_2025-01-17.csv", "Serial,Plan\nQ1,x\n")
    index = S.zip_members(spark, str(tmp_path), tasks=4)
    by_task = index.where("path LIKE '%a.zip'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert index.count() == 5 and len(by_task) >= 2
    z = S.read_zipped_snapshots(spark, str(tmp_path), tasks=4)
    assert z.columns == ["_source_file", *S.SNAPSHOT_COLUMNS, "Firmware", "Plan", "date", "batch_date"]
    got = {(r["_source_file"], r.Serial): (r.Firmware, r.Plan, r.Device_Type) for r in z.collect()}
    assert len(got) == 10
    assert got[("a__snapshot_2025-01-16.csv", "Z9")] == ("v2", None, "ZM1")
    assert got[("b__snapshot_2025-01-17.csv", "Q1")] == (None, "x", None)


def test_a_damaged_zip_member_raises(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_STORED) as zf:
        zf.writestr("snapshot_2025-01-17.csv", "Serial,Plan\nQ1,x\n")
    content = (tmp_path / "a.zip").read_bytes().replace(b"Q1,x", b"Q1,y")
    (tmp_path / "a.zip").write_bytes(content)
    with pytest.raises(Exception, match="CRC"):
        S.read_zipped_snapshots(spark, str(tmp_path)).collect()


def test_zip_archives_that_tasks_cannot_open_are_read_whole(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as zf:
        for day, rows in DAYS.items():
            zf.writestr(f"inner/snapshot_{day}.csv", HEADER + "\n" + "\n".join(rows) + "\n")
    whole = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "content").toPandas()
    names = [n for n, _ in S._contents(whole)]
    assert names == ["a__inner_snapshot_2025-01-14.csv", "a__inner_snapshot_2025-01-15.csv"]
    rows = [c for part in S._unzip_csv(S.SNAPSHOT_COLUMNS)(iter([whole])) for c in part.Serial]
    assert rows == ["A1", "B1", "C1", "D1", "A1", "B1", "C1", "E1"]


def jobs_of(spark, group, run):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    run()
    sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def test_header_jobs_do_not_grow_with_files(spark, tmp_path):
    for n in (3, 24):
        (tmp_path / str(n)).mkdir()
        for k in range(n):
            (tmp_path / str(n) / f"d 2025-01-{k + 1:02d}.csv").write_text(("\n" if k % 2 else "") + f"Serial,{'A' if k % 3 else 'B'}\n{k},x\n")
    (tmp_path / "24" / "none.csv").write_text("")
    few = jobs_of(spark, "few", lambda: S.read_snapshots(spark, str(tmp_path / "3")))
    many = jobs_of(spark, "many", lambda: S.read_snapshots(spark, str(tmp_path / "24")))
    assert 0 < many <= few
    got = {r.Serial: (r.A, r.B) for r in S.read_snapshots(spark, str(tmp_path / "24")).collect()}
    assert got == {str(k): ("x", None) if k % 3 else (None, "x") for k in range(24)}


def test_headers_of_packed_files_and_of_files_that_only_spark_opens(spark, tmp_path):
    lines = spark.createDataFrame([("Serial,A",), ("1,x",)], "value string").coalesce(1)
    for codec in ("gzip", "bzip2", "deflate"):
        lines.write.option("compression", codec).text(str(tmp_path / codec))
        assert [(r.Serial, r.A) for r in S.read_snapshots(spark, str(tmp_path / codec)).collect()] == [("1", "x")]


def test_written_partitions_from_folder_names(spark, tmp_path):
    out = str(tmp_path / "out")
    day = __import__("datetime").date
    df = spark.createDataFrame([("ZM1", day(2025, 1, 1), 1), ("a/b=c", day(2025, 1, 1), 2), (None, day(2025, 1, 2), 3)],
                               "device_type string, batch_date date, v int")
    assert S.skip_existing(df, out) is df
    S.write_features(df, out)
    assert S.written_partitions(spark, out, ("device_type", "batch_date")) == [("ZM1", "2025-01-01"), ("a/b=c", "2025-01-01")]
    more = df.unionByName(spark.createDataFrame([("ZM1", day(2025, 1, 2), 4)], df.schema))
    assert jobs_of(spark, "skip", lambda: S.skip_existing(more, out)) == 0
    assert sorted(r.v for r in S.skip_existing(more, out).collect()) == [3, 4]  # a null key is no existing group
    for f in (tmp_path / "out" / "device_type=ZM1" / "batch_date=2025-01-01").glob("*.parquet"):
        f.write_bytes(b"not read")
    assert sorted(r.v for r in S.skip_existing(more, out).collect()) == [3, 4]


def test_stream_daily_one_row_per_day(spark, raw_dir):
    s = ST.snapshot_stream(spark, raw_dir)
    daily = ST.stream_daily(s)
    out = tempfile.mkdtemp(prefix="vw-daily-")
    q = (daily.writeStream.outputMode("append").format("parquet").option("path", out + "/d")
         .option("checkpointLocation", out + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    # rows still inside the watermark are not emitted in append mode; what is emitted is unique
    got = spark.read.parquet(out + "/d")
    assert got.groupBy("Serial", "day_start").count().where("count > 1").count() == 0
