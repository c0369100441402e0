"""Document fingerprints by randomised edit embedding.

A walk reads a text with a pointer: at step j it puts out the character under the pointer and moves on if the random
bit of (j, character) is 1. The bits are the same for all texts, so texts with few edits between them come back into
step, and edit distance becomes Hamming distance of the outputs. The bits of a character repeat after ``PERIOD`` steps;
characters share ``CLASSES`` rows of bits.

A fingerprint holds ``SAMPLES`` outputs from each octave of steps [2^o, 2^(o+1)) up to the walk's end, at fixed random
steps, one hex digit of a hash each; so it is short for texts of any length, and the same for equal texts. ``likeness``
weighs octaves by their length and takes off what unlike texts agree in by chance. ``near_pairs`` cuts the longest
octaves into bands of sampled digits; texts that share a band are candidates, each pair verified by likeness.

Cases: a null text counts as empty; an empty text has the fingerprint ``0``, like another empty text to 1 and any other
to 0; ties of ids are ordered by text; rows without an id come last; repeated rows each give a row; an empty table gives
no rows; other columns are ignored. One document is its own next one.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltwatch.llm.common import mix, shuffle_partitions

CLASSES, PERIOD = 256, 8192
SAMPLES, OCTAVES = 64, 40
#: Octaves from this one on are sampled; shorter ones are put out whole by the first.
FIRST = 5
#: Characters that one vectorised step walks, about; a longer text is a step of its own.
STEP_CHARS = 1 << 20
#: What outputs of unlike texts agree in by chance: equal digits, and equal frequent characters.
CHANCE = 0.13
_rng = np.random.default_rng(20240315)


def _waits() -> np.ndarray:
    """Steps that a walk stays on a character, by class and step: up to and with the first step whose bit is 1."""
    bits = _rng.random((CLASSES, PERIOD)) < 0.5
    twice = np.concatenate([bits, bits], axis=1)
    wait = np.zeros((CLASSES, 2 * PERIOD), np.uint8)
    ahead = np.full(CLASSES, 200, np.int64)
    for j in range(2 * PERIOD - 1, -1, -1):
        ahead = np.where(twice[:, j], 1, np.minimum(ahead + 1, 200))
        wait[:, j] = ahead
    return np.ascontiguousarray(wait[:, :PERIOD]).reshape(-1)


_WAIT = _waits()


def _sampled_steps() -> np.ndarray:
    """Sorted steps whose outputs a fingerprint holds, octave by octave; the first has all of [0, 2^FIRST)."""
    draw = np.random.default_rng(20240316)
    return np.concatenate([np.arange(1 << FIRST), *(np.sort(draw.integers(1 << o, 1 << (o + 1), SAMPLES)) for o in range(FIRST, OCTAVES))])


_STEPS = _sampled_steps()
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def _class(points: np.ndarray) -> np.ndarray:
    return (points ^ (points >> 8) * 31 & 0xFF) & 0xFF


def fingerprints(texts: list[str]) -> list[str]:
    """The fingerprint of each text: a hex digit a sample, ``g`` from where the walk had ended within the last octave."""
    lengths = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-lengths, kind="stable")
    out: list = [""] * len(texts)
    at = 0
    while at < len(order):
        longest = max(1, int(lengths[order[at]]))
        some = order[at : at + max(1, STEP_CHARS // longest)]
        # texts much shorter than the longest wait for a step of their own
        some = some[: max(1, int(np.searchsorted(-lengths[some], -longest // 2, "right")))]
        at += len(some)
        for k, f in zip(some.tolist(), _walk([np.frombuffer(texts[k].encode("utf-32-le", "surrogatepass"), np.uint32) for k in some]), strict=True):
            out[k] = f
    return out


def _walk(points: list[np.ndarray]) -> list[str]:
    """Fingerprints of texts in falling order of length, walked side by side."""
    n, longest = len(points), len(points[0])
    if not longest:
        return ["0"] * n
    classes = np.zeros((longest, n), np.int32)
    for k, p in enumerate(points):
        classes[: len(p), k] = _class(p).astype(np.int32) * PERIOD
    lengths = np.array([len(p) for p in points])
    live = np.searchsorted(-lengths, -np.arange(longest), "left")  # texts longer than each place
    after = np.empty((longest, n), np.int32)  # the step on which each character is left
    step = np.zeros(n, np.int32)
    place = np.empty(n, np.int32)
    for i in range(longest):
        k = live[i]
        np.bitwise_and(step[:k], PERIOD - 1, out=place[:k])
        place[:k] += classes[i, :k]
        step[:k] += _WAIT[place[:k]]
        after[i, :k] = step[:k]
    after = np.ascontiguousarray(after.T)
    found = []
    for k, p in enumerate(points):
        left = after[k, : len(p)]
        end = int(left[-1])
        octave = max(FIRST, (end - 1).bit_length())
        count = (1 << FIRST) + SAMPLES * (octave - FIRST)
        where = np.searchsorted(left, _STEPS[:count], "right")
        inside = where < len(p)
        hashed = mix(p[np.minimum(where, len(p) - 1)].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.arange(count).astype(np.uint64)) >> np.uint64(60)
        found.append(np.where(inside, _HEX[hashed.astype(np.int64)], ord("g")).astype(np.uint8).tobytes().decode())
    return found


def likeness(one: str, two: str) -> float:
    """Likeness (0 to 1) of two texts by their fingerprints: 1 for equal ones."""
    if one == two:
        return 1.0
    if one == "0" or two == "0":
        return 0.0
    size = max(len(one), len(two))
    a = np.frombuffer(one.ljust(size, "h").encode(), np.uint8)
    b = np.frombuffer(two.ljust(size, "h").encode(), np.uint8)
    counts = (a < ord("g")) | (b < ord("g"))
    equal = (a == b) & counts
    head, tail = 1 << FIRST, (size - (1 << FIRST)) // SAMPLES
    weight = np.concatenate([np.full(head, 1.0), np.repeat(2.0 ** np.arange(FIRST, FIRST + tail) / SAMPLES, SAMPLES)])[:size]
    share = float((weight * equal).sum() / max((weight * counts).sum(), 1e-9))
    return max(0.0, (share - CHANCE) / (1 - CHANCE))


#: Digits in a band, and bands from each of the last ``LONG`` octaves (15/16 of the walk or more).
BAND, BANDS, LONG = 8, 8, 4
#: Classes in a chunk of a bucket, about; two chunks make a group.
CHUNK = 512


@functools.cache
def _band_places(at: int, size: int) -> list[list[int]]:
    draw = np.random.default_rng(at)
    return [draw.choice(size, min(BAND, size), replace=False).tolist() for _ in range(BANDS)]


def bands(fingerprint: str) -> list[str]:
    """Band keys: digits sampled from each of the last ``LONG`` octaves, the first steps being one too. So near texts share
    some wherever their edits are, also where one of them just reaches the next octave. A band that lies behind the end
    of the walk tells nothing and is left out."""
    head = 1 << FIRST
    parts = [(0, fingerprint[:head]), *((at, fingerprint[at : at + SAMPLES]) for at in range(head, len(fingerprint), SAMPLES))]
    keys = [f"{at}:{k}:" + "".join(part[i] for i in places) for at, part in parts[-LONG:] for k, places in enumerate(_band_places(at, len(part)))]
    return [k for k in keys if k.rsplit(":", 1)[1].strip("g")] or keys


def with_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``fingerprint`` and ``bands`` of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = fingerprints([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string()), pa.array([bands(f) for f in found], pa.list_(pa.string()))], [id_col, "fingerprint", "bands"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {dict(df.dtypes)[id_col]}, fingerprint string, bands array<string>")


def near_pairs(prints: DataFrame, least: float, id_col: str = "doc_id") -> DataFrame:
    """Pairs (a, b, likeness) of ids that are alike by ``least``, from columns ``id_col``, fingerprint, bands.

    Equal fingerprints are one class, named by its least id, whose members are paired with it; of classes, every pair that
    is alike is given. A band's bucket is compared whole: its classes are dealt to chunks, and every pair of chunks is a
    group of its own. Buckets with equal members count once.
    """
    rows = prints.where(F.col(id_col).isNotNull())
    classes = rows.groupBy("fingerprint").agg(F.min(id_col).alias("id"), F.first("bands").alias("bands"))
    member = classes.select("id", "fingerprint", F.explode(F.array_distinct("bands")).alias("band"))
    marks = (F.bit_xor(F.xxhash64("fingerprint")).alias("x"), F.bit_xor(F.xxhash64("fingerprint", F.lit(1))).alias("y"))
    shared = member.groupBy("band").agg(F.count("*").alias("n"), *marks).where("n > 1")
    once = shared.groupBy("n", "x", "y").agg(F.min("band").alias("band"))
    dealt = member.join(once.select("band", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")), "band")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("fingerprint", F.lit(2)), F.col("chunks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side")
    dealt = dealt.select(F.xxhash64("band", F.least("own", "other"), F.greatest("own", "other")).alias("grp"), side, "id", "fingerprint")
    dealt = dealt.repartition(shuffle_partitions(prints.sparkSession), "grp").sortWithinPartitions("grp")

    def found(ids: pa.Array, sides: np.ndarray, texts: list[str]) -> Iterator[pa.RecordBatch]:
        for some in _alike(sides, texts, least):
            one, two = ids.take(pa.array([p for p, _, _ in some], pa.int64())), ids.take(pa.array([q for _, q, _ in some], pa.int64()))
            yield pa.RecordBatch.from_arrays([one, two, pa.array([v for _, _, v in some], pa.float64())], ["a", "b", "likeness"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of one group, which goes on from one batch to the next

        def worked() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            yield from found(table.column(2).combine_chunks(), table.column(1).to_numpy(), table.column(3).to_pylist())

        for batch in batches:
            group = batch.column(0).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]]).tolist()
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b > a:
                    if held and held[-1].column(0)[-1].as_py() != group[a]:
                        yield from worked()
                        held.clear()
                    held.append(batch.slice(a, b - a))
        if held:
            yield from worked()

    kind = dict(prints.dtypes)[id_col]
    pairs = dealt.mapInArrow(run, f"a {kind}, b {kind}, likeness double").where("a <> b")
    pairs = pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("likeness").alias("likeness"))
    copies = rows.join(classes.select("fingerprint", F.col("id").alias("a")), "fingerprint").where(F.col(id_col) != F.col("a"))
    return pairs.union(copies.select("a", F.col(id_col).alias("b"), F.lit(1.0).alias("likeness")))


def _alike(sides: np.ndarray, texts: list[str], least: float) -> Iterator[list[tuple[int, int, float]]]:
    """For each fingerprint of a group, the pairs (place, later place, likeness) with those alike by ``least``; sides 1 and
    2 are compared with each other only."""
    size = max(map(len, texts))
    digits = np.frombuffer("".join(t.ljust(size, "h") for t in texts).encode(), np.uint8).reshape(len(texts), size)
    inside = digits < ord("g")
    octaves = np.arange(FIRST, FIRST + -(-size // SAMPLES))
    weight = np.concatenate([np.full(1 << FIRST, 1.0), np.repeat(2.0**octaves / SAMPLES, SAMPLES)])[:size]
    for p in range(len(texts) - 1):
        there = np.arange(p + 1, len(texts))
        there = there[sides[there] != sides[p]] if sides[p] else there
        if not len(there):
            continue
        counts = inside[there] | inside[p]
        share = ((digits[there] == digits[p]) & counts) @ weight / np.maximum(counts @ weight, 1e-9)
        near = there[(share - CHANCE) / (1 - CHANCE) >= least - 1e-6] if least > 0 else there  # the sums' order differs
        some = [(p, q, v) for q in near.tolist() if (v := likeness(texts[p], texts[q])) >= least]
        if some:
            yield some


def edited_text(text: str, other: str) -> str:
    """The text with its last third (rounded down) replaced by as much of the other's beginning, or all of it."""
    third = len(text) // 3
    return text[: len(text) - third] + other[:third]


#: Ranges of ids at most; their bounds go out with the task, 8 bytes each.
RANGES = 65_536
#: Texts worked on at once.
AT_ONCE = 2500


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, bands_shared (by the text
    and its edited text) of every document. The next document is by descending id; after the last comes the first.

    Ids are cut into ranges of like numbers of rows, and a range also gets a copy of the row that follows its last one.
    So every range is worked on by itself, in order; texts are shuffled once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = min(RANGES, 8 * shuffle_partitions(spark))
    found = rows.select(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)], 20 * parts).alias("b")).first().b
    bounds = np.unique(np.array(found or [], np.int64))
    number = F.pandas_udf(lambda ids: pd.Series(np.searchsorted(bounds, ids.to_numpy(), "right").astype(np.int32)), "int")
    placed = rows.select("doc_id", "text", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(number(F.coalesce("doc_id", F.lit(0)))).alias("part"))
    tops = placed.groupBy("part").agg(F.max("doc_id").alias("top")).orderBy(F.desc("part")).collect()  # a row a range
    before = [(r.part, r.top, tops[k - 1].part) for k, r in enumerate(tops)] or [(0, 0, 0)]
    table = F.broadcast(spark.createDataFrame(before, "part int, top bigint, to int"))
    copies = placed.join(table, "part").where(F.col("doc_id").eqNullSafe(F.col("top"))).groupBy("to", "doc_id").agg(F.min("text").alias("text"))
    dealt = placed.select("part", F.lit(False).alias("copy"), "doc_id", "text").union(copies.select("to", F.lit(True), "doc_id", "text"))
    dealt = dealt.repartition(shuffle_partitions(spark), "part").sortWithinPartitions("part", "copy", F.desc_nulls_last("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # the row before, whose next one comes first in what follows
        for batch in batches:
            for at in range(0, len(batch), AT_ONCE):
                some = batch.slice(at, AT_ONCE)
                copy, ids, texts = ([last[k], *some.column(k + 1).to_pylist()] if last else some.column(k + 1).to_pylist() for k in range(3))
                last = (copy[-1], ids[-1], texts[-1])
                of = [k for k in range(len(ids) - 1) if not copy[k]]
                edited = [edited_text(texts[k], texts[k + 1]) for k in of]
                prints = fingerprints(texts + edited)
                own, new = prints[: len(texts)], prints[len(texts) :]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[k] for k in of], pa.int64()),
                        pa.array([len(texts[k]) for k in of], pa.int64()),
                        pa.array([hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited], pa.string()),
                        pa.array([own[k] for k in of], pa.string()),
                        pa.array(new, pa.string()),
                        pa.array([likeness(own[k], f) for k, f in zip(of, new, strict=True)], pa.float64()),
                        pa.array([likeness(own[k], own[k + 1]) for k in of], pa.float64()),
                        pa.array([len({*bands(own[k])} & {*bands(f)}) for k, f in zip(of, new, strict=True)], pa.int32()),
                    ],
                    ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "bands_shared"],
                )

    return dealt.mapInArrow(run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, bands_shared int")
