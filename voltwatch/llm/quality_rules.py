"""Quality rules and a hashed n-gram log-likelihood ratio between trusted and raw text.

Rules count, for every whole text: words ``[^\\x20\\x09-\\x0D]+``, the code points in them, symbols, repeated lines and
words in repeated windows. A text of fewer than ``LEAST_WORDS`` words, or with more than half of its words in repeated
windows, fails.

What is left is judged by importance: words and pairs of neighbouring words are hashed to ``DIMS`` buckets. The raw
multinomial counts them over all documents, the target multinomial over all trusted ones (those that ``labels`` mark as
good by majority). A bucket's weight is ``ln((t + SMOOTH) / (T * r / R + SMOOTH))`` in millionths, rounded down to an
integer, for t of T target n-grams and r of R raw ones: 0 where the target holds its share. A text's sum of weights, an
exact integer, is held against ``FLOOR`` millionths a n-gram, so that equal texts get equal verdicts in any order of rows.

All counts cover all rows. Each task sums buckets in an array; ``2 * DIMS`` sums come to the driver, and ``DIMS`` weights
go to every task, whatever the size of the corpus. Trusted texts are found by a semi-join on the id; before it, documents go whose id has
a hash that no trusted id has, so that where few are trusted few texts are shuffled. The join is a merge join at every
size of the labels.

Cases: a null text counts as empty; an empty text, or one without words, fails; a document without an id is judged, but
never trusted; labels of one id are taken by majority, ties are not trusted; repeated rows count each and are each
judged; without any trusted document no text is dropped by the ratio; an empty table gives no rows; other columns are
ignored by ``judged`` and kept by ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltwatch.llm.common import Words, grams, mix, steps, string_parts, tidied

DIMS = 1 << 16
LEAST_WORDS, MOST_REPEATED, WINDOW = 50, 50, 3
#: n-grams that both multinomials get in every bucket; least mean weight of a kept text, in millionths of a nat.
SMOOTH, FLOOR = 8.0, -100_000
#: Values of a hash of the id that are sent to every executor at most: documents with none of them need no join.
SLOTS = 1 << 20
#: Fixed values of the n-gram hash: prime modulus, powers of 131 by place, factors of a pair.
PRIME, CYCLE, FIRST, SECOND = 2**31 - 1, 64, 69069, 40503
POWERS = [pow(131, k + 1, PRIME) for k in range(CYCLE)]
_POWERS = np.array(POWERS, np.int64)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LINE = np.zeros(256, bool)
_LINE[10] = True


def buckets(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every word and every pair of neighbours in a text.

    A word's number sums its bytes times ``POWERS`` by place (modulo 64), modulo ``PRIME``; a pair's is
    ``FIRST * one + SECOND * other``; the bucket is the number modulo ``PRIME``, then ``DIMS``.
    """
    size = w.ends - w.starts
    cut = np.concatenate([[0], size.cumsum()])
    place = np.arange(cut[-1]) - np.repeat(cut[:-1], size)
    value = w.bytes[np.repeat(w.starts, size) + place] * _POWERS[place % CYCLE]
    number = (np.add.reduceat(value, cut[:-1]) if len(size) else np.zeros(0, np.int64)) % PRIME
    row = np.repeat(np.arange(len(w)), np.diff(w.of))
    inside = row[:-1] == row[1:]
    pair = (FIRST * number[:-1] + SECOND * number[1:])[inside] % PRIME
    return np.concatenate([row, row[:-1][inside]]), np.concatenate([number, pair]) % DIMS


def _counts(texts: DataFrame) -> np.ndarray:
    """Occurrences of each bucket over the whole column ``text``: summed by each task, then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMS, np.int64)
        for batch in batches:
            data, offsets = string_parts(batch.column(0))
            for first, past in steps(offsets):
                total += np.bincount(buckets(Words(data, offsets, first, past))[1], minlength=DIMS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    out = np.zeros(DIMS, np.int64)
    for r in texts.mapInArrow(tidied(run), "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def weights(target: np.ndarray, raw: np.ndarray) -> np.ndarray | None:
    """Integer weight of each bucket; None without any target."""
    if not target.sum() or not raw.sum():
        return None
    expected = float(target.sum()) * raw.astype(float) / float(raw.sum())
    return np.floor(1e6 * np.log((target.astype(float) + SMOOTH) / (expected + SMOOTH))).astype(np.int64)


def trusted(labels: DataFrame, label_col: str = "quality") -> DataFrame:
    """Ids that most of their labels mark as good."""
    marked = labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull())
    return marked.groupBy("doc_id").agg(F.avg(label_col).alias("good")).where("good > 0.5").select("doc_id")


def learned(docs: DataFrame, labels: DataFrame) -> np.ndarray | None:
    """Weights of the buckets from all documents and all trusted ones."""
    good = trusted(labels).select(F.col("doc_id").cast(dict(docs.dtypes)["doc_id"]).alias("doc_id"))
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS))
    near = good.select(slot.alias("slot")).distinct()  # at most SLOTS numbers, so that other texts are not shuffled
    some = docs.select("doc_id", "text").withColumn("slot", slot).join(F.broadcast(near), "slot", "left_semi").join(good.hint("merge"), "doc_id", "left_semi").select("text")
    return weights(_counts(some), _counts(docs.select("text")))


def _repeats(w: Words, n: np.ndarray) -> np.ndarray:
    """Words of each text that stand in a window of ``WINDOW`` words found twice or more in the text."""
    row = np.repeat(np.arange(len(n)), n)
    count = max(0, len(row) - WINDOW + 1)
    at = np.flatnonzero(row[:count] == row[len(row) - count :])
    key = mix(grams(w.hashes, WINDOW)[at] + row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, index, times = np.unique(key, return_inverse=True, return_counts=True)
    edge = np.zeros(len(row) + 1, np.int64)
    twice = at[times[index] > 1]
    edge[twice] += 1
    edge[twice + WINDOW] -= 1
    return np.bincount(row[edge.cumsum()[:-1] > 0], minlength=len(n))


def _same_lines(data: np.ndarray, offsets: np.ndarray, first: int, past: int, w: Words) -> np.ndarray:
    """Lines of each text that hold a word and equal an earlier one."""
    lines = Words(data, offsets, first, past, gaps=_LINE)
    row = np.repeat(np.arange(past - first), np.diff(lines.of))
    worded = np.searchsorted(w.starts, lines.ends) > np.searchsorted(w.starts, lines.starts)
    key = mix(lines.hashes[worded] + row[worded].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, once = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[once] = False
    return np.bincount(row[worded][again], minlength=past - first)


def judged(docs: DataFrame, weight: np.ndarray | None, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns of ``keep``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, weight (sum over
    the text's n-grams, in millionths), kept."""
    shared = docs.sparkSession.sparkContext.broadcast(weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket = shared.value
        for batch in batches:
            data, offsets = string_parts(batch.column(at))
            for first, past in steps(offsets):
                w = Words(data, offsets, first, past)
                many, bounds = past - first, offsets[first : past + 1] - offsets[first]
                n = np.diff(w.of)
                worded = np.zeros(len(w.bytes) + 1, np.int64)
                worded[w.starts] += 1
                worded[w.ends] -= 1
                inside = worded.cumsum()[:-1] > 0

                def summed(marks: np.ndarray, bounds: np.ndarray = bounds) -> np.ndarray:
                    return np.diff(np.concatenate([[0], marks.cumsum()])[bounds])

                repeated = _repeats(w, n)
                failed = (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n)
                total, kept = np.zeros(many, np.int64), ~failed
                if by_bucket is not None:
                    row, bucket = buckets(w)
                    np.add.at(total, row, by_bucket[bucket])
                    kept &= total >= FLOOR * np.bincount(row, minlength=many)
                columns = [n, summed(inside & (w.bytes & 0xC0 != 0x80)), summed(_SYMBOL[w.bytes]), _same_lines(data, offsets, first, past, w), repeated, failed, total, kept]
                yield pa.RecordBatch.from_arrays([*(c.slice(first, many) for c in batch.columns[: len(keep)]), *(pa.array(c) for c in columns)], names)

    read = [*keep] if text_col in keep else [*keep, text_col]
    at = read.index(text_col)
    types = dict(docs.dtypes)
    names = [*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "weight", "kept"]
    schema = ", ".join(f"`{c}` {types[c]}" for c in keep) + ", n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, weight bigint, kept boolean"
    return docs.select(*read).mapInArrow(tidied(run), schema)


def rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document with its counts and verdict."""
    return judged(docs, learned(docs, labels))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns."""
    names = [f"__own{k}" for k in range(len(docs.columns))]
    own = dict(zip(docs.columns, names, strict=True))
    found = judged(docs.withColumnsRenamed(own), learned(docs, labels), tuple(names), own["text"]).where("kept")
    return found.select(*(F.col(new).alias(old) for old, new in own.items()))
