"""Token counts of documents in flat token files, by a scan for end-of-document ids.

A flat token file is a row of little-endian integers; every document ends with the end id, nothing tells where. A file is
looked at in blocks, each read by itself in any task: numpy finds the end ids of a block at once and gives the tokens before the first, between them and
after the last. A prefix scan over the blocks of a file (window sums in Spark) stitches documents that go over block
ends and numbers them.

``write_tokens`` makes such files from texts on any file system that Spark writes to: a row is a document's tokens, and
the end id's bytes are the line separator. ``token_counts`` reads files of any origin.

Cases: an empty document (null or empty text) is an end id alone and counts 0; tokens after a file's last end id are one
more document; an empty file has none; repeated rows each give a row; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.fs  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltwatch.llm.common import shuffle_partitions, with_checkpoint_dir

#: Tokens in a block.
BLOCK = 1 << 20
#: Texts that are encoded at once.
AT_ONCE = 200


def write_tokens(df: DataFrame, path: str, model_path: str, end: int, text_col: str = "text") -> None:
    """Writes the texts' ids by a sentencepiece model as flat files of 16-bit integers, one a partition.

    ``end`` is a free id whose two bytes are ASCII, as Spark writes separators as text.
    """
    mark = int(end).to_bytes(2, "little")
    if max(mark) > 127:
        raise ValueError("the end id's bytes must be ASCII")
    with open(model_path, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
        if model.vocab_size() > end:
            raise ValueError("the end id is not free")
        for batch in batches:
            for at in range(0, len(batch), AT_ONCE):
                texts = [t or "" for t in batch.column(0).slice(at, AT_ONCE).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([np.array(x, "<u2").tobytes() for x in model.encode(texts, num_threads=1)], pa.binary())], ["tokens"])

    df.select(text_col).mapInArrow(run, "tokens binary").select(F.col("tokens").cast("string")).write.option("lineSep", mark.decode("ascii")).text(path)


def _local(path: str) -> str | None:
    """The local path that a path of Spark's names, or none."""
    if path.startswith("file:"):
        return "/" + path[len("file:") :].lstrip("/")
    return path if path.startswith("/") else None


def opened(path: str) -> BinaryIO:
    """The file under a path as Spark lists it, for reading from any place."""
    if (local := _local(path)) is not None:
        return open(local, "rb")
    system, inner = pa.fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def can_open(path: str) -> bool:
    try:
        opened(path).close()
    except (OSError, pa.ArrowException):
        return False
    return True


def token_counts(spark: SparkSession, path: str, end: int, width: int = 2, block: int = BLOCK) -> DataFrame:
    """path, nth (document of the file, from 0), n_tokens, for flat files of ``width``-byte integers.

    Spark lists the files and spreads their blocks over tasks, each of which reads its bytes alone. Files of a file system
    that neither Python nor Arrow opens are read whole by Spark, a file a task.
    """

    def counted(name: str, number: int, tokens: np.ndarray) -> pa.RecordBatch:
        ends = np.flatnonzero(tokens == end)
        row = (len(ends), int(ends[0]), len(tokens) - 1 - int(ends[-1]), (np.diff(ends) - 1).tolist()) if len(ends) else (0, 0, len(tokens), [])
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((name, number, *row), types, strict=True)], ["path", "block", "ends", "head", "tail", "inner"])

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, number, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = number * block * width
                size = min(block * width, length - length % width - at)
                with opened(name) as f:
                    f.seek(at)
                    content = f.read(size)
                if len(content) != size:
                    raise OSError(f"{name} is shorter than listed")
                yield counted(name, number, np.frombuffer(content, f"<u{width}"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                content = batch.column(1)[k].as_buffer()
                tokens = np.frombuffer(content, f"<u{width}", len(content) // width)
                for at in range(0, len(tokens), block):
                    yield counted(batch.column(0)[k].as_py(), at // block, tokens[at : at + block])

    schema = "path string, block bigint, ends bigint, head bigint, tail bigint, inner array<bigint>"
    files = spark.read.format("binaryFile").load(path)
    scheme = F.regexp_extract("path", "^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    one_each = files.groupBy(scheme.alias("scheme")).agg(F.min("path").alias("path")).collect()  # a row a kind of file system
    shut = [r.scheme for r in one_each if not can_open(r.path)]
    spread = files.where(~scheme.isin(shut)).select("path", "length") if shut else files.select("path", "length")
    count = F.ceil(F.floor(F.col("length") / width) / block).cast("bigint")
    spread = spread.where(count > 0).select("path", F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1)).alias("block"), "length")
    blocks = spread.repartition(shuffle_partitions(spark), "path", "block").mapInArrow(ranges, schema)
    if shut:
        blocks = blocks.union(files.where(scheme.isin(shut)).select("path", "content").mapInArrow(whole, schema))
    order = Window.partitionBy("path").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumns({"first": F.coalesce(F.sum("ends").over(before), F.lit(0)), "sum": F.coalesce(F.sum("tail").over(before), F.lit(0)), "final": F.lead("block").over(order).isNull()})
    start = F.last(F.when(F.col("ends") > 0, F.col("sum")), ignorenulls=True).over(before)  # of the tokens still open
    blocks = blocks.withColumn("open", F.col("sum") - F.coalesce(start, F.lit(0)))
    closed = F.when(F.col("ends") > 0, F.concat(F.array(F.col("open") + F.col("head")), F.col("inner"))).otherwise(F.array().cast("array<bigint>"))
    left = F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("open") + F.col("tail"))
    counts = F.concat(closed, F.when(F.col("final") & (left > 0), F.array(left)).otherwise(F.array().cast("array<bigint>")))
    return blocks.select("path", "first", F.posexplode(counts).alias("k", "n_tokens")).select("path", (F.col("first") + F.col("k")).alias("nth"), "n_tokens")


def document_counts(docs: DataFrame, model_path: str, end: int) -> DataFrame:
    """doc_id and n_tokens of every document: its texts written as flat token files, then counted there.

    ``docs`` reads a table: its partitions are then the same in both passes, so the part and the place in it tell which
    document is which. A document without a count, or a count without a document, is an error.
    """
    spark = docs.sparkSession
    path = f"{with_checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, model_path, end)
    counted = token_counts(spark, path, end).select(F.regexp_extract("path", r"part-(\d+)-", 1).cast("int").alias("part"), "nth", "n_tokens")
    place = F.monotonically_increasing_id()
    named = docs.select("doc_id", F.shiftright(place, 33).cast("int").alias("part"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("nth"), F.lit(True).alias("named"))
    both = named.join(counted, ["part", "nth"], "full")
    wrong = F.col("named").isNull() | F.col("n_tokens").isNull()
    return both.select("doc_id", F.when(wrong, F.raise_error(F.lit("token files and documents differ")).cast("bigint")).otherwise(F.col("n_tokens")).alias("n_tokens"))
