"""Structured Streaming ingest of daily snapshot files (ST1-ST4).

The reference's "processed files" manifest becomes the streaming
checkpoint: ``trigger(availableNow=True)`` processes every file not yet
seen, exactly once, and stops.  Each micro-batch is a batch DataFrame in
``foreachBatch``, so batch-scoped statistics (snapshot, min-max) work.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import exprs as X
from ..operators.common import dedupe_keep
from ..operators.health import build_health_features
from ..sources import schemas, versions
from ..sources.files import SNAPSHOT_COLUMNS, all_string_schema, clean_numeric, with_batch_date, with_source_file


def snapshot_stream(spark: SparkSession, src: str, columns: Sequence[str] = SNAPSHOT_COLUMNS,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming twin of ``read_snapshots``: text columns + ``_source_file`` + ``batch_date``."""
    r = (spark.readStream.schema(all_string_schema(columns)).option("header", True)
         .option("enforceSchema", False))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_batch_date(with_source_file(r.csv(src)))


def _batch_folder(spark: SparkSession, path: str, checkpoint: str, batch_id: int) -> str:
    """A batch's own folder: the stream's id keeps a new checkpoint's batch 0 apart from an older one's; a retried batch
    overwrites itself (idempotent)."""
    stream = spark.read.json(f"{checkpoint}/metadata").first()["id"]
    return f"{path}/ingest_stream={stream}/ingest_batch={batch_id}"


def _append_batch(path: str, checkpoint: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        placed = clean_numeric(batch).select("*", F.monotonically_increasing_id().alias("_row"),
                                             F.current_timestamp().alias("_ingested_at"))
        folder = _batch_folder(batch.sparkSession, path, checkpoint, batch_id)
        schemas.register(batch.sparkSession, path, placed.schema, folder[len(path) + 1:])
        placed.write.mode("overwrite").parquet(folder)
    return write


def stream_ingest(spark: SparkSession, src: str, history: str, checkpoint: str,
                  columns: Sequence[str] = SNAPSHOT_COLUMNS) -> StreamingQuery:
    """ST1 + P5: new daily files -> history (append, exactly once per file), numeric columns cleaned.

    The history keeps every delivery with its ``ingest_stream`` and
    ``ingest_batch``; ST2's one row per (Serial, report) is applied on read by
    :func:`read_history`.  A stream with a new checkpoint adds, never replaces.
    """
    s = snapshot_stream(spark, src, columns).select("*", F.col("_metadata.file_block_start").alias("_block"))
    return (s.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
            .foreachBatch(_append_batch(history, checkpoint)).start())


ORDER = ["_ingested_at", "ingest_batch", "_source_file", "_block", "_row"]


def _keyed(h: DataFrame) -> DataFrame:
    key = F.coalesce(X.to_ts("BatteryLatestReport"), X.to_ts("Last_Heard"), F.col("batch_date").cast("timestamp"))
    return h.select("*", key.alias("_report_key"))


def _latest(keyed: DataFrame) -> DataFrame:
    return dedupe_keep(keyed, ["Serial", "_report_key"], [F.col(c) for c in ORDER], keep="last")


def _batches(spark: SparkSession, history: str) -> list[str]:
    """Folders of all delivered batches (``ingest_stream=.../ingest_batch=...``), from a listing."""
    top = spark._jvm.org.apache.hadoop.fs.Path(history)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{history}/ingest_stream=*/ingest_batch=*"))
    return sorted("/".join(str(s.getPath().toString()).split("/")[-2:]) for s in found or [])


def _parts(spark: SparkSession, history: str) -> tuple[DataFrame | None, DataFrame | None, list[str]]:
    """The compacted rows, the rows of batches that came since, and the names of those batches."""
    folder = versions.current(spark, f"{history}/_compacted")
    done, old = set(), None
    if folder is not None:
        done = {r[0] for r in spark.read.json(f"{folder}/batches").collect()}  # a row a batch
        old = spark.read.parquet(f"{folder}/rows")
    names = [b for b in _batches(spark, history) if b not in done]
    new = _keyed(schemas.read_parts(spark, history, names)) if names else None
    return old, new, names


def _merged(old: DataFrame | None, new: DataFrame | None) -> DataFrame:
    if new is None:
        return old
    if old is None:
        return _latest(new)
    # compacted rows have one row a key: only those that a fresh row may replace are compared again
    keys = new.select(F.col("Serial").alias("_s"), F.col("_report_key").alias("_k")).distinct()
    same = F.col("Serial").eqNullSafe(F.col("_s")) & F.col("_report_key").eqNullSafe(F.col("_k"))
    fresh = _latest(schemas.unite([new, old.join(keys, same, "left_semi")]))
    return schemas.unite([old.join(keys, same, "left_anti"), fresh])


def read_history(spark: SparkSession, history: str) -> DataFrame:
    """ST2: exactly one row per (Serial, report time) across runs; the latest
    ingest wins, inside a file the last row (the reference keeps the last after
    appending new files).  Missing report times fall back to Last_Heard, then
    the batch date (T33).  A column that some deliveries lack is null there.

    After :func:`compact_history` only batches that came since are compared by key.
    """
    old, new, _ = _parts(spark, history)
    if old is None and new is None:
        raise FileNotFoundError(f"no history at {history}")
    return _merged(old, new).drop("_report_key")


def compact_history(spark: SparkSession, history: str, files: int | None = None) -> list[str]:
    """Merges all delivered batches into one version of files sorted by device and report; returns the batches that it
    took in.  Readers see the older version and all batches until the new one is whole.  Batches stay where they are."""
    old, new, names = _parts(spark, history)
    if not names:
        return []
    taken = [(b,) for b in _batches(spark, history) if b in set(names)]
    before = versions.current(spark, f"{history}/_compacted")
    if before is not None:
        taken += [tuple(r) for r in spark.read.json(f"{before}/batches").collect()]
    merged = _merged(old, new)
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = merged.repartitionByRange(n, "Serial", "_report_key").sortWithinPartitions("Serial", "_report_key")

    def write(folder: str) -> None:
        placed.write.parquet(f"{folder}/rows")
        spark.createDataFrame(taken, "batch string").coalesce(1).write.json(f"{folder}/batches")

    versions.write_folder(spark, f"{history}/_compacted", write)
    return names


def stream_daily(stream: DataFrame, watermark: str = "2 days") -> DataFrame:
    """ST3: one row per (Serial, day) in event time; the first reading of the
    day is kept.  Late rows inside the watermark still count."""
    ts = X.to_ts("Last_Heard")
    s = stream.select("*", ts.alias("_event_ts")).where(F.col("_event_ts").isNotNull())
    s = s.withWatermark("_event_ts", watermark)
    cols = list(stream.columns)
    agg = (s.groupBy("Serial", F.window("_event_ts", "1 day").alias("day"))
           .agg(F.min_by(F.struct(*cols), "_event_ts").alias("_r")))
    return agg.select(F.col("day.start").alias("day_start"), "_r.*")


def stream_score(spark: SparkSession, src: str, out: str, checkpoint: str, install: DataFrame | None = None,
                 attempts: DataFrame | None = None, columns: Sequence[str] = SNAPSHOT_COLUMNS) -> StreamingQuery:
    """ST4: score every arriving batch of files with the health router.

    Each file is its own scoring batch (``batch_cols=["_source_file"]``), so
    the result equals scoring the files one by one in batch mode; rows of one
    time keep the order of their file.  A new checkpoint adds scores, never
    replaces those of an older one.
    """
    s = snapshot_stream(spark, src, columns).select("*", F.col("_metadata.file_block_start").alias("_block"))

    def score(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("*", F.monotonically_increasing_id().alias("_row"))
        hf = build_health_features(rows, install=install, attempts=attempts, batch_cols=["_source_file"], order_cols=["_block", "_row"])
        hf.write.mode("overwrite").parquet(_batch_folder(batch.sparkSession, out, checkpoint, batch_id))

    return (s.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
            .foreachBatch(score).start())
