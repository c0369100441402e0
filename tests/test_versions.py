"""Versioned sinks, history compaction and scores of streams with new checkpoints."""

import pytest
from pyspark.sql import functions as F
from test_sources_streaming import _row, _write_day

from voltwatch.sources import files as S
from voltwatch.sources import versions as V
from voltwatch.streaming import ingest as ST


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    where = f"{tmp_path}/history"
    df = spark.range(10).withColumn("v", F.lit("a"))
    first = S.write_history(df, where)
    # the next version is made from the one before
    second = S.write_history(S.read_written_history(spark, where).withColumn("v", F.lit("b")), where)
    bad = S.read_written_history(spark, where).withColumn("v", F.when(F.col("id") == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="TASK_WRITE_FAILED|broken"):
        S.write_history(bad, where)
    assert {r.v for r in S.read_written_history(spark, where).collect()} == {"b"}
    assert spark.read.parquet(first).count() == 10  # readers of the older version go on
    assert len(V.versions(spark, where)) == 3
    S.write_history(df, where)
    gone = V.forget(spark, where, keep=2)  # the failed one and the oldest
    assert len(gone) == 2 and first in gone and second not in gone
    assert S.read_written_history(spark, where).count() == 10
    with pytest.raises(FileNotFoundError):
        V.read_current(spark, f"{tmp_path}/none")


def test_export_is_evaluated_once_and_backed_up(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.createDataFrame([("A1", 1.5, None), ("B,2", None, "x \"y\""), ("C3", 2.0, "")], "Serial string, v double, s string").mapInArrow(counted, "Serial string, v double, s string")
    S.write_export(df, f"{tmp_path}/export", f"{tmp_path}/backup", "run-1")
    assert seen.value == 3
    rows = lambda d: sorted(map(str, d.collect()))
    export, backup = S.read_export(spark, f"{tmp_path}/export"), spark.read.csv(f"{tmp_path}/backup/run-1", header=True)
    assert rows(export) == rows(backup) and export.count() == 3
    with pytest.raises(Exception, match="run-1|already exists"):
        S.write_export(spark.createDataFrame([("Z", 1.0, "n")], df.schema), f"{tmp_path}/export", f"{tmp_path}/backup", "run-1")
    assert [r.Serial for r in S.read_export(spark, f"{tmp_path}/export").collect()] == ["Z"]
    assert rows(spark.read.csv(f"{tmp_path}/backup/run-1", header=True)) == rows(backup)


def ingested(spark, src, out, n):
    ST.stream_ingest(spark, src, f"{out}/history", f"{out}/ckpt{n}").awaitTermination()
    return f"{out}/history"


def test_compaction_changes_nothing_for_readers(spark, tmp_path):
    src, out = f"{tmp_path}/src", f"{tmp_path}/out"
    (tmp_path / "src").mkdir()
    rows = lambda: sorted(map(str, ST.read_history(spark, history).select(*kept).collect()))
    kept = ["Serial", "BatteryLatestReport", "Last_Heard", "BatteryLevel", "_source_file"]
    _write_day(src, "2025-01-14", [_row("A1", "ZM1", "2025-01-14 08:00:00", "60", "2025-01-13"), _row("A1", "ZM1", "2025-01-14 08:00:00", "61", "2025-01-13"), _row("B1", "MM3", "2025-01-14 08:00:00", "", "")])
    history = ingested(spark, src, out, 1)
    before = rows()
    assert len(before) == 2 and ST.compact_history(spark, history, files=2) != []
    assert rows() == before and ST.compact_history(spark, history) == []
    _write_day(src, "2025-01-15", [_row("A1", "ZM1", "2025-01-15 08:00:00", "57", "2025-01-13"), _row("C1", "ZM1", "2025-01-15 08:00:00", "9", "2025-01-15")])
    ingested(spark, src, out, 1)
    after = rows()
    assert len(after) == 3 and any("57" in r for r in after) and not any("'61'" in r for r in after)
    plan = ST.read_history(spark, history)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan  # old rows without a new report are passed on
    ST.compact_history(spark, history)
    assert rows() == after
    ingested(spark, src, out, 2)  # a new checkpoint delivers all files again: nothing changes but the batch
    assert rows() == after
    assert ST.compact_history(spark, history) != [] and rows() == after
    assert len(V.versions(spark, f"{history}/_compacted")) == 3


def test_scores_of_an_older_checkpoint_stay(spark, tmp_path):
    src, out = f"{tmp_path}/src", f"{tmp_path}/out"
    (tmp_path / "src").mkdir()
    _write_day(src, "2025-01-14", [_row("A1", "ZM1", "2025-01-14 08:00:00", "60", "2025-01-13")])
    ST.stream_score(spark, src, f"{out}/scored", f"{out}/ckpt1").awaitTermination()
    _write_day(src, "2025-01-15", [_row("A1", "ZM1", "2025-01-15 08:00:00", "57", "2025-01-15")])
    ST.stream_score(spark, src, f"{out}/scored", f"{out}/ckpt2").awaitTermination()
    got = spark.read.parquet(f"{out}/scored")
    assert got.count() == 3 and got.select("ingest_stream").distinct().count() == 2
