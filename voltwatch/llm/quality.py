"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader.

A text's features are its words and word pairs (words ``[^\\x20\\x09-\\x0D]+``, A-Z lowered), the same with every run
of letters or digits as one sign, and a mark for a word that stands twice in a row. All are hashed to ``DIMS`` places,
weighted by 1 + log count and scaled to length one; a constant is added. Scores are sparse dot products over whole texts.

The fit uses at most about ``FIT_ROWS`` labelled rows (a share chosen by a hash of the id), which one task learns from
in a fixed order. Every text of the table is scored.

Cases: a null text counts as empty and gets the constant's score; a document with several labels has their majority,
ties count as good; without any learning row every score is 0.5; repeated rows each give a row; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltwatch.llm.common import Words, drawn, grams, mix, steps, string_parts

DIMS = 1 << 18
#: Labelled rows in the fit at most, about.
FIT_ROWS = 16_000
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 1e-4, 1e-4, 3
LEAST = 0.3


_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[48:58] = 48
_SHAPE[65:91] = _SHAPE[97:123] = _SHAPE[128:] = 97


def _shapes(words: Words, bounds: np.ndarray) -> Words:
    """The words with each run of letters, and of digits, as one sign."""
    b = _SHAPE[words.bytes]
    keep = np.ones(len(b), bool)
    keep[1:] = (b[1:] != b[:-1]) | ((b[1:] != 97) & (b[1:] != 48))
    keep[bounds[(bounds > 0) & (bounds < len(b))]] = True
    at = np.concatenate([[0], keep.cumsum()])
    return Words(b[keep], at[bounds], 0, len(bounds) - 1)


def features(data: np.ndarray, offsets: np.ndarray, first: int, past: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, value) of a step's texts, sorted by text; the values of each text have length one."""
    words = Words(data, offsets, first, past, lower=True)
    keys = []
    for salt, w in ((0, words), (1, _shapes(words, offsets[first : past + 1] - offsets[first]))):
        row = np.repeat(np.arange(len(w)), np.diff(w.of))
        inside = row[:-1] == row[1:]
        for n, h, r in ((1, w.hashes, row), (2, grams(w.hashes, 2)[inside], row[:-1][inside])):
            keys.append(r * DIMS + (mix(h + np.uint64(2 * salt + n)) & np.uint64(DIMS - 1)).astype(np.int64))
        if not salt:
            twice = row[:-1][inside & (w.hashes[:-1] == w.hashes[1:])]
            keys.append(twice * DIMS + DIMS // 3)
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    row, value = key // DIMS, 1 + np.log(count)
    size = np.sqrt(np.bincount(row, value * value, past - first))
    return row, key % DIMS, (value / size[row]).astype(np.float32)


class Ftrl:
    """FTRL-proximal for one example at a time; place ``DIMS`` is the constant."""

    def __init__(self):
        self.z, self.n = np.zeros(DIMS + 1), np.zeros(DIMS + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip((w * value).sum(), -35, 35)))
        g = (p - label) * value
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "quality") -> np.ndarray:
    """Weights (``DIMS + 1``) learned from the labelled rows where ``learn`` (over doc_id) holds."""
    marked = labels.where(learn & F.col("doc_id").isNotNull() & F.col(label_col).isNotNull()).groupBy("doc_id").agg((F.avg(label_col) >= 0.5).cast("int").alias("__label"))
    chosen = marked.where(drawn(FIT_ROWS / max(1, marked.count()), F.lit("quality"), "doc_id"))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # about FIT_ROWS pairs of numbers

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_parts(batch.column(2))
            for first, past in steps(offsets):
                row, place, value = features(data, offsets, first, past)
                cut = np.searchsorted(row, np.arange(past - first + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, past - first),
                        batch.column(1).slice(first, past - first),
                        pa.ListArray.from_arrays(cut, place.astype(np.int32)),
                        pa.ListArray.from_arrays(cut, value),
                    ],
                    ["doc_id", "label", "places", "vals"],
                )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in batches:
            for y, p, v in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                examples.append((y, np.append(p.values.to_numpy(), DIMS), np.append(v.values.to_numpy(), np.float32(1))))
        model, order = Ftrl(), np.random.default_rng(7)
        for _ in range(EPOCHS if examples else 0):
            for k in order.permutation(len(examples)):
                y, at, value = examples[k]
                model.learn(at, value, y)
        w = model.weights(np.arange(DIMS + 1)).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary())], ["w"])

    kind = dict(docs.dtypes)["doc_id"]
    found = rows.select("doc_id", "__label", "text").mapInArrow(places, f"doc_id {kind}, label int, places array<int>, vals array<float>")
    ordered = found.repartition(1).sortWithinPartitions("doc_id")  # a bounded sample, learned from in one order
    got = ordered.mapInArrow(train, "w binary").collect()
    return np.frombuffer(got[0].w, np.float32) if got else np.zeros(DIMS + 1, np.float32)


def score(df: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``score`` (0 to 1) of every whole text."""
    shared = df.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            data, offsets = string_parts(batch.column(1))
            out = []
            for first, past in steps(offsets):
                row, place, value = features(data, offsets, first, past)
                total = np.bincount(row, w[place] * value, past - first)
                out.append(1 / (1 + np.exp(-np.clip(total + w[DIMS], -35, 35))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(out) if out else np.zeros(0))], [id_col, "score"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {dict(df.dtypes)[id_col]}, score double")


def held_out() -> Column:
    """Rows whose labels no one learns from: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: held_out, score, predicted (1 from ``LEAST`` on)."""
    weights = fit(docs, labels, ~F.coalesce(held_out(), F.lit(True)))
    return score(docs, weights).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= LEAST).cast("int").alias("predicted"))
