"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step looks at; a longer text is a step of its own.
STEP_BYTES = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: A random number for each of the first ``_PLACES`` places of a word and each byte; later places mix these again.
_PLACES = 64
_BYTE = np.random.default_rng(20240229).integers(0, 2**64, _PLACES * 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: ASCII upper case to lower case, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    value = spark.conf.get(key, None)
    return int(value) if value and str(value).isdigit() else default


def shuffle_partitions(spark: SparkSession) -> int:
    return conf_int(spark, "spark.sql.shuffle.partitions", 200)


def with_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; only where that is unset (tests) a folder of the warehouse."""
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not where:
        where = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_llm_checkpoints"
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(where)
    return where


def frozen(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared checkpoint folder, so that lost executors cost no recomputation."""
    with_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drawn(share: float, *on) -> Column:
    """Whether a row belongs to the ``share`` of rows that the hash of ``on`` chooses. All 64 bits decide, so a share
    may be as small as a table is large."""
    return F.xxhash64(*on) < F.lit(-(2**63) + int(share * 2**64)) if share < 1 else F.lit(True)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished phases whose results are written: it does so when the driver
    collects the plans that hold them. Python's references reach the JVM's count with a delay of about a second."""
    gc.collect()
    time.sleep(2)
    spark.sparkContext._jvm.System.gc()


def _trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # another C library keeps its memory as it likes
        return None


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, but at a task's end the worker gives freed memory back to the system: Spark keeps idle workers, and what
    their allocators hold counts beside the executor's heap in later stages."""

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        if trim := _trim():
            trim(0)

    return inner


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over the 64 bits (wraps around)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, STEP_BYTES + 4096)
        inverse = np.uint64(pow(int(_ODD), -1, 2**64))
        _powers["up"] = np.concatenate([[np.uint64(1)], np.full(size - 1, _ODD)]).cumprod(dtype=np.uint64)
        _powers["down"] = np.concatenate([[np.uint64(1)], np.full(size - 1, inverse)]).cumprod(dtype=np.uint64)
    return _powers["up"][:n], _powers["down"]


def string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its texts (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def steps(offsets: np.ndarray, limit: int = STEP_BYTES, most: int = 1 << 30):
    """Ranges (first, past) of texts that together have about ``limit`` bytes, one text at least and ``most`` at most."""
    first, n = 0, len(offsets) - 1
    while first < n:
        past = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        past = min(past, n, first + most)
        yield first, past
        first = past


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of some texts: byte ranges, 64-bit hashes, and where each text's words begin.

    ``gaps`` marks the bytes between words. A word's hash sums a random number for each byte and its place, mixed with
    the word's length, so no arrangement of bytes cancels out.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int, past: int, lower: bool = False, gaps: np.ndarray = _SPACE):
        base = int(offsets[first])
        self.bytes = data[base : int(offsets[past])]
        if lower:
            self.bytes = LOWER[self.bytes]
        bounds = offsets[first : past + 1] - base
        n = len(self.bytes)
        space = gaps[self.bytes]
        before = np.empty(n, bool)
        if n:
            before[0] = True
            before[1:] = space[:-1]
            inner = bounds[(bounds > 0) & (bounds < n)]
            before[inner] = True
            after = np.empty(n, bool)
            after[-1] = True
            after[:-1] = space[1:]
            after[inner - 1] = True
            self.starts = np.flatnonzero(~space & before)
            self.ends = np.flatnonzero(~space & after) + 1
        else:
            self.starts = self.ends = np.zeros(0, np.int64)
        self.of = np.searchsorted(self.starts, bounds)
        if len(self.starts):
            size = self.ends - self.starts
            spans = np.diff(self.starts, prepend=0, append=n)  # from one word's start to the next one's
            place = np.arange(n, dtype=np.int32) - np.repeat(np.append(0, self.starts).astype(np.int32), spans)
            term = _BYTE[(place & (_PLACES - 1)) << 8 | self.bytes]
            if size.max() > _PLACES:
                late = np.flatnonzero(place >= _PLACES)
                term[late] = mix(term[late] + (place[late] // _PLACES).astype(np.uint64) * _ODD)
            total = term.cumsum(dtype=np.uint64)
            self.hashes = mix(total[self.ends - 1] - total[self.starts] + term[self.starts] + size.astype(np.uint64) * _ODD)
        else:
            self.hashes = np.zeros(0, np.uint64)

    def __len__(self) -> int:
        return len(self.of) - 1


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Order-sensitive hashes of the ``n`` consecutive words from each place (``len - n + 1`` of them)."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total *= _ODD
        total += hashes[k : k + count]
    return mix(total)


def hex_sha(column):
    return F.sha2(F.encode(column, "UTF-8"), 256)
