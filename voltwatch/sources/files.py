"""File sources and sinks.

CSV snapshots are read as text (no inference) and typed once by
``conform``-style projections downstream.  File lineage comes from the
``_metadata`` column.  Columns are taken by name: tasks read one header line per
(new) file and Spark reads the files of each header together.
"""

from __future__ import annotations

import io
from typing import BinaryIO, Iterable, Iterator, Sequence
from urllib.parse import unquote

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X
from . import versions
from .ranges import csv_members, first_line, member, opened

# Canonical raw snapshot columns (all read as text).
SNAPSHOT_COLUMNS = ["Serial", "Device_Type", "Status", "Last_Heard", "BatteryLatestReport", "BatteryLevel",
                    "LineCurrent", "LineTemperature", "Latitude", "Longitude", "DNP_Addr", "ParentId", "Region",
                    "Substation", "Feeder", "Site", "Phase", "IP_Address", "NetworkGroup", "Profile_Name",
                    "SensorGateway"]
#: Columns that arrive as text and are numbers.
NUMERIC_COLUMNS = ("LineCurrent", "LineTemp", "LineTemperature", "BatteryLevel", "BatteryLev")
DATE_IN_NAME = r"(\d{4}-\d{2}-\d{2})"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def all_string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def _listed(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path))


def _paths(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return _listed(spark, path).select("path", F.col("_metadata.file_path").alias("_uri"))


def _file_name() -> Column:
    return F.element_at(F.split("path", "/"), -1)


def list_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``path`` and ``file_name`` of every file below ``path``; contents are not read."""
    return _listed(spark, path).select("path", _file_name().alias("file_name"))


def path_missing(e: AnalysisException) -> bool:
    return e.getCondition() == "PATH_NOT_FOUND"


HEADER_ROW = "path string, header binary"


def _headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"path": b["path"], "header": [first_line(p) for p in b["path"]]})


def _by_header(files: DataFrame) -> list[list[str]]:
    """Paths of the files that hold a line, grouped by their first line, in the order of each group's first path.

    Tasks read a first line each; one or two jobs, however many files there are.  Paths go to the driver because a
    reader takes them from there.  Files that only Spark can open (its own codecs, other stores) are read as text, and
    the first line of the block that starts at 0 counts.
    """
    found = files.select("path").mapInPandas(_headers, HEADER_ROW)  # in the scan's own tasks
    groups = found.groupBy("header").agg(F.collect_set("path").alias("paths")).collect()  # a row a header
    unread = [p for g in groups if g.header is None for p in g.paths]
    if unread:
        spark = files.sparkSession
        lines = (spark.read.text(unread).where((F.col("_metadata.file_block_start") == 0) & (F.trim("value") != ""))
                 .select(F.col("_metadata.file_path").alias("_uri"), "value", F.monotonically_increasing_id().alias("_n")))
        first = lines.groupBy("_uri").agg(F.min_by("value", "_n").cast("binary").alias("header"))
        groups += (files.select("path", "_uri").join(first, "_uri").groupBy("header")
                   .agg(F.collect_set("path").alias("paths")).collect())
    by_header: dict[bytes, list[str]] = {}
    for g in groups:
        if g.header:
            by_header.setdefault(bytes(g.header), []).extend(g.paths)
    return sorted(sorted(paths) for paths in by_header.values())


def _read_files(files: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    spark = files.sparkSession
    df = None
    for paths in _by_header(files):
        header = spark.read.option("header", True).csv(paths[0]).columns  # Spark's own reading of the group's header
        part = with_source_file(spark.read.option("header", True).option("mode", "PERMISSIVE")
                                .schema(all_string_schema(header)).option("enforceSchema", False).csv(paths))
        df = part if df is None else df.unionByName(part, allowMissingColumns=True)
    if df is None:
        df = spark.createDataFrame([], all_string_schema([*(columns or []), "_source_file"]))
    if columns is not None:
        df = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns],
                       *[c for c in df.columns if c not in columns])
    return with_batch_date(df)


def read_snapshots(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None
                   ) -> DataFrame:
    """S1 + S6 + S7: daily CSV snapshots as text with ``_source_file`` and ``batch_date``.

    Columns are taken by name: files are grouped by their own header (tasks
    read one line per file), each group is read with it, and the groups are
    united by name.  A column that a file lacks is null.  ``columns`` come
    first and always exist; further ones are kept.
    """
    return _read_files(_paths(spark, path), columns)


def with_source_file(df: DataFrame, name: str = "_source_file") -> DataFrame:
    """Lineage column from the file metadata."""
    return df.select("*", F.col("_metadata.file_name").alias(name))


def with_batch_date(df: DataFrame, file_col: str = "_source_file") -> DataFrame:
    """Date from the file name (``YYYY-MM-DD``), else the file stem as text."""
    found = F.regexp_extract(F.col(file_col), DATE_IN_NAME, 1)
    stem = F.regexp_replace(F.col(file_col), r"\.[^.]*$", "")
    return df.select("*", F.when(found != "", found).otherwise(stem).alias("date"),
                     F.to_date(F.when(found != "", found)).alias("batch_date"))


def read_install_dates(spark: SparkSession, path: str) -> DataFrame:
    """S3: install-date dimension; unparseable dates dropped."""
    df = spark.read.option("header", True).csv(path)
    return (df.select(F.col("Serial").cast("string").alias("Serial"), X.to_ts("InstallDate").alias("InstallDate"))
            .where(F.col("InstallDate").isNotNull()))


ATTEMPT_SCHEMA = T.StructType([T.StructField("Serial", T.StringType()), T.StructField("attempt_date", T.StringType())])


def read_attempts(spark: SparkSession, path: str) -> DataFrame:
    """Reconfigure-attempt log by column name; an empty frame with the schema when the path does not exist.
    Any other error is raised."""
    try:
        df = read_snapshots(spark, path, ATTEMPT_SCHEMA.names)
    except AnalysisException as e:
        if not path_missing(e):
            raise
        return spark.createDataFrame([], ATTEMPT_SCHEMA)
    return df.select(*ATTEMPT_SCHEMA.names)


def record_attempts(serials: DataFrame, as_of: str, path: str) -> None:
    """Append one attempt (Serial, as_of) per serial in ``serials``."""
    (serials.select(F.col("Serial").cast("string"), F.lit(as_of[:10]).alias("attempt_date")).distinct()
     .write.mode("append").option("header", True).csv(path))


def clean_numeric(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """P5: the numeric columns as numbers; "1,234" is 1234, tokens such as NULL and anything else are null."""
    return df.select(*[X.to_num_tokens(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def ingest_new(spark: SparkSession, src: str, manifest_path: str, columns: Sequence[str] | None = None,
               history_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """S8 (batch twin of the streaming ingest) + J8 + P5: rows of files not yet in
    the manifest, and the manifest rows to append after the batch succeeds.

    File names are compared first, so only new files are read.  Without a
    manifest, or where ``history_path`` is given and does not exist, every file is new.
    """
    files = _paths(spark, src)
    try:
        if history_path is not None:
            spark.read.format("binaryFile").load(history_path)  # resolves the path
        known = spark.read.parquet(manifest_path).select("file_name").distinct()
        new = files.join(known, _file_name() == F.col("file_name"), "left_anti")
    except AnalysisException as e:
        if not path_missing(e):
            raise
        new = files
    return clean_numeric(_read_files(new, columns)), new.select(_file_name().alias("file_name")).distinct()


def mark_processed(names: DataFrame, manifest_path: str) -> None:
    names.write.mode("append").parquet(manifest_path)


def written_partitions(spark: SparkSession, out_path: str, keys: Sequence[str]) -> list[tuple[str, ...]]:
    """Values of ``keys`` of all partition folders (``key=value``, nested in this order) that hold a file, as text, from
    folder listings alone: no data file is opened.  The partition of nulls is left out."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(out_path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop.Path(root, "/".join(f"{k}=*" for k in keys) + "/[!_.]*"))
    done = set()
    for status in found or []:
        folders = str(status.getPath().getParent().toString()).split("/")[-len(keys):]
        values = tuple(unquote(f.split("=", 1)[1]) for f in folders)
        if NULL_PARTITION not in values:
            done.add(values)
    return sorted(done)


def skip_existing(df: DataFrame, out_path: str, keys: Sequence[str] = ("device_type", "batch_date")) -> DataFrame:
    """Drop (date, type) groups whose output partition already exists; ``keys`` are the columns that the output is
    partitioned by, in their order.  Existing ones come from folder names (:func:`written_partitions`).  Rows with a
    null key stay."""
    spark = df.sparkSession
    done = written_partitions(spark, out_path, keys)
    if not done:
        return df  # nothing written yet
    types = dict(df.dtypes)
    there = spark.createDataFrame(done, all_string_schema(keys))
    return df.join(there.select(*[F.col(k).cast(types[k]).alias(k) for k in keys]), list(keys), "left_anti")


def ensure_features(df: DataFrame, build, **kw) -> DataFrame:
    """Skip the feature build when the input is already scored (plan-time check)."""
    return df if "risk_score" in df.columns else build(df, **kw)


def write_features(df: DataFrame, path: str, partition_cols: Sequence[str] = ("device_type", "batch_date")) -> None:
    """Per-type, per-day outputs; only the partitions present are replaced."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))


def write_history(df: DataFrame, path: str) -> str:
    """History / labelled Parquet as a new version, read by :func:`read_written_history`. ``df`` may come from the
    version before; a failed write leaves that one in place."""
    return versions.write_version(df, path)


def read_written_history(spark: SparkSession, path: str) -> DataFrame:
    return versions.read_current(spark, path)


def write_timeseries(df: DataFrame, path: str) -> None:
    """Gzip CSV, +-inf -> null, missing text -> ''."""
    cols = []
    for name, dtype in df.dtypes:
        if dtype in ("double", "float"):
            cols.append(X.finite(F.col(name)).alias(name))
        elif dtype == "string":
            cols.append(F.coalesce(F.col(name), F.lit("")).alias(name))
        else:
            cols.append(F.col(name))
    (df.select(*cols).write.mode("overwrite").option("header", True).option("compression", "gzip")
     .option("emptyValue", "").csv(path))


def write_export(df: DataFrame, path: str, backup_root: str, run_id: str) -> str:
    """Export CSV as a new version of ``path`` plus a backup copy keyed by ``run_id``.

    The backup copies the files that were written, so the export is evaluated once and both hold the same rows. A
    second run with the same ``run_id`` is an error; the export is the current version either way.
    """
    folder = versions.write_version(df, path, "csv", header=True)
    text = df.sparkSession.read.schema(all_string_schema(df.columns)).option("header", True).csv(folder)
    text.write.mode("errorifexists").option("header", True).csv(f"{backup_root}/{run_id}")
    return folder


def read_export(spark: SparkSession, path: str) -> DataFrame:
    return versions.read_current(spark, path, "csv", header=True)


def write_predictions(df: DataFrame, path: str) -> None:
    """Predictions CSV (the committer makes the write atomic; no lock fallback)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """One report table per folder."""
    df.write.mode("overwrite").format(fmt).option("header", True).save(path)


def assert_contract(df: DataFrame, cols: Iterable[str]) -> None:
    """Raise when contract columns are missing."""
    missing = sorted(set(cols) - set(df.columns))
    if missing:
        raise ValueError(f"missing contract columns: {missing}")


def list_columns(df: DataFrame) -> list[str]:
    return sorted(df.columns)


# ------------------------------------------------------------------ zips ---

MEMBER_ROW = "path string, name string, offset long, packed long, size long, method int, checksum long"
MEMBER = ["name", "offset", "packed", "size", "method", "checksum"]
CHUNK_ROWS = 50_000


def _member_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for path in b["path"]:
            try:
                with opened(path) as f:
                    rows = [(path, *m) for m in csv_members(f)]
            except (OSError, pa.ArrowException):
                rows = [(path, None, 0, 0, 0, 0, 0)]  # a store that only Spark reads
            yield pd.DataFrame(rows, columns=["path", *MEMBER])


def zip_members(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """The index of S17: path, name, offset, sizes, method and checksum of every CSV member, dealt evenly to ``tasks``.

    Tasks read the directories at the archives' ends alone; a member is then read by its offset, so members of one
    archive go to several tasks.  An archive that tasks cannot open has one row without a name.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path")
    return files.mapInPandas(_member_rows, MEMBER_ROW).repartition(
        tasks or int(spark.conf.get("spark.sql.shuffle.partitions")))


def _contents(rows: pd.DataFrame) -> Iterator[tuple[str, BinaryIO]]:
    """``archive__member`` and the open member for each row of the index, or of whole archives (path, content)."""
    for r in rows.itertuples(index=False):
        stem = r.path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
        if "content" in rows.columns:
            archive = io.BytesIO(r.content)
            for m in csv_members(io.BytesIO(r.content)):
                yield f"{stem}__{m[0].replace('/', '_')}", member(archive, *m)
        else:
            with opened(r.path) as f:
                yield f"{stem}__{r.name.replace('/', '_')}", member(f, *(getattr(r, c) for c in MEMBER))


def _member_columns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for _, content in _contents(b):
            try:
                header = list(pd.read_csv(content, dtype=str, nrows=0).columns)
            except pd.errors.EmptyDataError:
                continue
            yield pd.DataFrame({"header": [header]})


def _unzip_csv(columns: Sequence[str]):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in _contents(b):
                try:
                    chunks = pd.read_csv(content, dtype=str, keep_default_na=False, index_col=False, chunksize=CHUNK_ROWS)
                except pd.errors.EmptyDataError:
                    continue
                for chunk in chunks:
                    out = {"_source_file": name} | {c: chunk[c] if c in chunk.columns else None for c in columns}
                    yield pd.DataFrame(out, index=chunk.index)
    return read


def read_zipped_snapshots(spark: SparkSession, path: str, columns: Sequence[str] = SNAPSHOT_COLUMNS,
                          tasks: int | None = None) -> DataFrame:
    """CSV members of ZIP archives as text, each with a unique member name.

    Members are spread over tasks by :func:`zip_members` and streamed in
    chunks.  ``columns`` come first and always exist; further ones, of any
    member, follow by name.  Columns that a member lacks are null, members
    without a line give no rows.  Archives that tasks cannot open are read
    whole by Spark, an archive a task.
    """
    index = zip_members(spark, path, tasks)
    parts = [index.where(F.col("name").isNotNull())]
    shut = [r.path for r in index.where(F.col("name").isNull()).select("path").collect()]  # none where Arrow opens the store
    if shut:
        parts.append(_listed(spark, shut).select("path", "content"))
    heads = [p.mapInPandas(_member_columns, "header array<string>").distinct() for p in parts]
    found = {c for h in heads for r in h.collect() for c in r.header}  # a row a distinct header
    names = [*columns, *sorted(found - {*columns, "_source_file"})]
    rows = [p.mapInPandas(_unzip_csv(names), all_string_schema(["_source_file", *names])) for p in parts]
    return with_batch_date(rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1]))
