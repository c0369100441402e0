"""MinHash near-duplicates with sequential Bayesian verification.

A document is the set of its distinct word shingles (words ``[^\\x20\\x09-\\x0D]+``, A-Z lowered, ``SHINGLE`` words; a
shorter text is one shingle; no words, no shingles). Documents with equal sets are one class. Classes that share a band
of their signatures are candidates: batches of the signatures are compared, a pair is dropped as soon as the posterior
probability (uniform prior) of a similarity of at least the threshold is under ``MISS``, and survivors are verified on
the full sets. Documents are linked from ``threshold`` percent on; components follow the links.

A bucket of a band is worked on whole, whatever its size: its members are dealt to chunks, and every pair of chunks is
a group of its own, of at most about twice ``CHUNK`` members. Within a group a pair that is already connected needs no
comparison, so a group gives back at most one link a member. Buckets with equal members count once.

Cases: a null text, or one without words, has no shingles and is linked with nothing; a document without an id is
never linked, has a null component and is kept; repeated rows are copies and share their component; equal ids with
different texts are separate documents that share the id, each linked by its own text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltwatch.llm.common import Words, grams, mix, release, shuffle_partitions, steps, string_parts, tidied, with_checkpoint_dir
from voltwatch.llm.graph import components

BANDS, ROWS = 28, 5
HASHES = BANDS * ROWS
#: Probability with which a pair at the threshold may be dropped by its signatures alone; hashes compared at a time.
MISS, BATCH = 1e-6, 32
CHUNK, CHUNK_BYTES = 512, 16 << 20
_rng = np.random.default_rng(20240301)
_MULTIPLY = _rng.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, first: int, past: int, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    words = Words(data, offsets, first, past, lower=True)
    whole = grams(words.hashes, size)
    for a, b in zip(words.of[:-1].tolist(), words.of[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(whole[a : b - size + 1])
        elif b > a:
            yield grams(words.hashes[a:b], b - a) + np.uint64(b - a)
        else:
            yield np.zeros(0, np.uint64)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function over the set."""
    h = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 2**32 - 1, np.uint32)
    for k in range(0, len(h), 2048):
        np.minimum(out, (_MULTIPLY[:, None] * h[None, k : k + 2048] + _ADD[:, None]).min(axis=1), out=out)
    return out


def least_matches(n: int, threshold: float, miss: float = MISS) -> int:
    """The least number of equal hashes among ``n`` with which a similarity of ``threshold`` stays likely enough.

    With a uniform prior, P(similarity >= t | m of n equal) = P(Binomial(n + 1, t) <= m).
    """
    total = 0.0
    for m in range(n + 1):
        total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if total >= miss:
            return m
    return n


def link_group(ids: np.ndarray, sides: np.ndarray, signatures: np.ndarray, sets: list[np.ndarray], threshold: int) -> list[tuple[int, int]]:
    """Links (id, least id of its part) that connect what is similar; sides 1 and 2 are compared with each other only.

    ``threshold`` is in percent: 100 * intersection >= threshold * union.
    """
    n = len(ids)
    part = np.arange(n)
    sizes = np.array([len(s) for s in sets])
    need = [(k, min(k + BATCH, HASHES), least_matches(min(k + BATCH, HASHES), threshold / 100)) for k in range(0, HASHES, BATCH)]
    index = None
    for p in range(n):
        there = np.flatnonzero(part != part[p])
        there = there[(there > p) & (sides[there] != sides[p])] if sides[p] else there[there > p]
        same = np.zeros(len(there), np.int64)
        for a, b, least in need:
            if not len(there):
                break
            same += (signatures[there, a:b] == signatures[p, a:b]).sum(axis=1)
            there, same = there[same >= least], same[same >= least]
        if not len(there):
            continue
        if len(there) > 8 and index is None:
            every = np.concatenate(sets)
            _, term = np.unique(every, return_inverse=True)
            order = np.argsort(term, kind="stable")
            index = term, np.repeat(np.arange(n), sizes)[order], np.concatenate([[0], np.bincount(term).cumsum()]), np.concatenate([[0], sizes.cumsum()])
        if len(there) > 8:
            term, owner, begin, at = index
            own = term[at[p] : at[p + 1]]
            count = begin[own + 1] - begin[own]
            end = count.cumsum()
            both = np.bincount(owner[np.arange(end[-1]) + np.repeat(begin[own] - (end - count), count)], minlength=n)[there]
        else:
            both = np.array([len(np.intersect1d(sets[p], sets[q], assume_unique=True)) for q in there])
        for q in there[100 * both >= threshold * (sizes[p] + sizes[there] - both)]:
            if part[q] != part[p]:
                part[part == part[q]] = part[p]
    links = []
    order = np.argsort(part, kind="stable")
    for some in np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if n else []:
        least = ids[some].min()
        links += [(int(x), int(least)) for x in ids[some] if x != least]
    return links


def _signed(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, the set's 128-bit key and signature (16 bits a hash) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = np.uint64(0x94D049BB133111EB)
        for batch in batches:
            data, offsets = string_parts(batch.column(2))
            for first, past in steps(offsets):
                count, key1, key2, signature = [], [], [], []
                for s in shingle_sets(data, offsets, first, past, size):
                    count.append(len(s))
                    key1.append(mix(s).sum(dtype=np.uint64))
                    key2.append(mix(s ^ salt).sum(dtype=np.uint64))
                    low = minima(s)
                    signature.append(((low * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, past - first),
                        batch.column(1).slice(first, past - first),
                        pa.array(count, pa.int64()),
                        pa.array(np.array(key1, np.uint64).view(np.int64)),
                        pa.array(np.array(key2, np.uint64).view(np.int64)),
                        pa.array(signature, pa.binary()),
                    ],
                    ["doc_id", "text_hash", "n_shingles", "key1", "key2", "signature"],
                )

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        tidied(run), "doc_id bigint, text_hash bigint, n_shingles bigint, key1 bigint, key2 bigint, signature binary"
    )


def _links(docs: DataFrame, classes: DataFrame, size: int, threshold: int) -> DataFrame:
    """Links (a, b) between the nodes of classes, verified on the full sets of their representatives' texts."""
    spark = docs.sparkSession
    bands = [F.xxhash64(F.lit(k), F.substring("signature", 2 * ROWS * k + 1, 2 * ROWS)) for k in range(BANDS)]
    member = classes.select("node", "n_shingles", F.explode(F.array(*bands)).alias("bucket"))
    shared = member.groupBy("bucket").agg(
        F.count("*").alias("n"), F.sum("n_shingles").alias("shingles"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")
    ).where("n > 1")
    once = shared.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket"), F.max("shingles").alias("shingles"))
    chunks = F.ceil(F.greatest(F.col("n") / CHUNK, F.col("shingles") * 8 / CHUNK_BYTES)).cast("int")
    dealt = member.select("node", "bucket").join(once.select("bucket", chunks.alias("chunks")), "bucket")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node", F.lit(2)), F.col("chunks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.select(
        "node",
        F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("grp"),
        F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"),
    )
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").join(classes.select("doc_id", "text_hash", "node", "signature"), ["doc_id", "text_hash"])
    rows = dealt.join(texts, "node").select("grp", "side", "node", "signature", "text")
    rows = rows.repartition(shuffle_partitions(spark), "grp").sortWithinPartitions("grp", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def worked(table: pa.Table) -> pa.RecordBatch:
            data, offsets = string_parts(table.column("text"))
            sets = [s for f, p in steps(offsets) for s in shingle_sets(data, offsets, f, p, size)]
            ids, sides = table.column("node").to_numpy(), table.column("side").to_numpy()
            group = table.column("grp").to_numpy()
            raw, _ = string_parts_binary(table.column("signature"))
            signatures = raw.view(np.uint16).reshape(-1, HASHES)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
            links = []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                links += link_group(ids[a:b], sides[a:b], signatures[a:b], sets[a:b], threshold)
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])

        for batch in batches:  # a group goes on from one batch to the next
            group = batch.column(0).to_numpy()
            if not len(group):
                continue
            cut = int(np.searchsorted(group, group[-1]))
            if held and (cut or held[-1].column(0)[-1].as_py() != group[-1]):
                yield worked(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            elif cut:
                yield worked(pa.Table.from_batches([batch.slice(0, cut)]))
            held.append(batch.slice(cut))
        if held:
            yield worked(pa.Table.from_batches(held))

    return rows.mapInArrow(tidied(run), "a bigint, b bigint")


def string_parts_binary(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without nulls, and its offsets."""
    whole = column.combine_chunks().cast(pa.large_binary())
    whole = pa.concat_arrays(whole.chunks) if isinstance(whole, pa.ChunkedArray) else whole
    offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    return np.frombuffer(whole.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets


def near_duplicates(docs: DataFrame, size: int = 4, threshold: int = 80) -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles, component_id (least id reachable), kept."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    where = f"{with_checkpoint_dir(spark).rstrip('/')}/minhash-{uuid.uuid4().hex}"
    _signed(docs, size).write.parquet(f"{where}/signed")
    signed = spark.read.parquet(f"{where}/signed")
    some = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    least = F.min(F.struct("doc_id", "text_hash", "signature", "n_shingles"))
    # ids may be shared by documents with different texts, so links go between numbers of classes, fixed by writing them
    some.groupBy("key1", "key2").agg(least.alias("r")).select("key1", "key2", "r.*", F.monotonically_increasing_id().alias("node")).write.parquet(f"{where}/classes")
    classes = spark.read.parquet(f"{where}/classes")
    release(spark)
    found = components(_links(docs, classes, size, threshold))
    release(spark)
    tops = found.join(classes.select(F.col("node").alias("id"), "doc_id"), "id").groupBy("component").agg(F.min("doc_id").alias("top"))
    found = found.join(tops, "component").select(F.col("id").alias("node"), "top")
    label = classes.select("key1", "key2", "node", "doc_id").join(found, "node", "left").select("key1", "key2", F.coalesce("top", "doc_id").alias("component"))
    light = signed.select("doc_id", "text_hash", "n_shingles", "key1", "key2")
    linked = light.where("n_shingles > 0 AND doc_id IS NOT NULL").join(label, ["key1", "key2"]).select("doc_id", "text_hash", "n_shingles", F.col("component").alias("component_id"))
    alone = light.where("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, size: int = 5, threshold: int = 80) -> DataFrame:
    """One document of each component, the one with the least id, with all columns of ``docs``. Repeated rows become one."""
    kept = near_duplicates(docs, size, threshold).where("kept")
    none = F.lit(-(2**63))  # stands for a missing id
    keys = kept.select(F.coalesce("doc_id", none).alias("__id"), F.col("text_hash").alias("__hash"))
    held = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("bigint"), none), "__hash": F.xxhash64("text")})
    return held.join(keys, ["__id", "__hash"], "left_semi").dropDuplicates(["__id", "__hash"]).select(*docs.columns)


def near_digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")
