"""Language identification by nearest centroid.

A text is a vector of hashed letter trigrams (UTF-8 bytes, A-Z lowered, everything in ASCII that is no letter a space),
weighted by (1 + log count) * idf and scaled to length one. Each language has several centroids from spherical k-means;
the language of the nearest centroid by cosine is predicted. A text farther from every centroid than ``REACH`` of what
learning texts of like length keep is rejected; short texts, which keep little, only at a cosine near nothing.

Document frequencies cover every learning row. The centroids are fitted on at most about ``SAMPLE_ROWS`` learning rows
(a share of each language chosen by a hash of the id).

Cases: a text that is null or has no letter is ``und`` with score 0 and not rejected as far; ties between languages go
to the first in order; repeated rows each give a row; an empty table gives no rows; without any learning row every text
is ``und``; other columns are ignored by ``predict`` and kept by the caller's join on its own rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltwatch.llm.common import LOWER, STEP_BYTES, drawn, mix, steps, string_parts, tidied

DIMS = 4096
#: Learning rows that the centroids are fitted on, about; and centroids a language.
SAMPLE_ROWS, CENTROIDS = 4000, 4
#: Texts of a step at most: each has a row of ``DIMS`` counts.
STEP_ROWS = 256
#: A text is rejected below this share of the first percentile of learning texts of like length; a text of fewer
#: trigrams than ``JUDGED`` only where it has next to nothing in common with any centroid.
REACH, JUDGED, NOTHING = 0.35, 64, 0.02
#: Softmax temperature that turns cosines into a score.
SHARP = 0.05
_LETTER = regex.compile(r"\p{L}")
_CLASS = LOWER.copy()
_CLASS[:65] = _CLASS[91:97] = _CLASS[123:128] = 32
_LENGTHS = 32


def trigram_counts(data: np.ndarray, offsets: np.ndarray, first: int, past: int) -> np.ndarray:
    """Counts of hashed trigrams for each text, ``past - first`` rows of ``DIMS``; spaces alone count for nothing."""
    base, n = int(offsets[first]), past - first
    b = _CLASS[data[base : int(offsets[past])]]
    counts = np.zeros((n, DIMS), np.float32)
    if len(b) < 3:
        return counts
    bounds = offsets[first : past + 1] - base
    code = b[:-2].astype(np.uint32) << 16 | b[1:-1].astype(np.uint32) << 8 | b[2:]
    keep = (code != 0x202020) & ~((b[:-2] == 32) & (b[1:-1] == 32)) & ~((b[1:-1] == 32) & (b[2:] == 32))
    ends = bounds[1:-1]
    for shift in (1, 2):  # no trigram goes over the end of a text
        cut = ends - shift
        keep[cut[(cut >= 0) & (cut < len(keep))]] = False
    place = np.flatnonzero(keep)
    dim = ((code[place] * np.uint32(0x9E3779B1)) >> np.uint32(20)).astype(np.int64)
    row = np.repeat(np.arange(n), np.diff(bounds))[place]
    return np.bincount(row * DIMS + dim, minlength=n * DIMS).reshape(n, DIMS).astype(np.float32)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    size = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(size > 0, size, 1)


@dataclass
class Centroids:
    langs: list[str]
    idf: np.ndarray
    of: np.ndarray  # language of each centroid
    points: np.ndarray
    floor: np.ndarray  # least cosine that is not rejected, by log2 of the number of trigrams

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, score and whether it is rejected, for each row of counts."""
        cosine = weighted(counts, self.idf) @ self.points.T
        best = np.stack([cosine[:, self.of == k].max(axis=1) for k in range(len(self.langs))], axis=1)
        choice = best.argmax(axis=1)
        top = best[np.arange(len(best)), choice]
        score = 1 / np.exp((best - top[:, None]) / SHARP).sum(axis=1)
        size = np.minimum(np.log2(1 + counts.sum(axis=1)).astype(int), _LENGTHS - 1)
        return choice, score, top < self.floor[size]


def k_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means: unit vectors, farthest-first start, rows of the result of length one."""
    centre = [x.mean(axis=0)]
    for _ in range(min(k, len(x)) - 1):
        centre.append(x[(x @ np.stack(centre).T).max(axis=1).argmin()])
    c = np.stack(centre)
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        c = np.stack([x[near == j].sum(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.sqrt((c * c).sum(axis=1, keepdims=True)), 1e-9)
    return c.astype(np.float32)


def _document_frequency(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Learning rows that hold each trigram, over all of them: summed in each task, then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            data, offsets = string_parts(batch.column(0))
            n += len(batch)
            for first, past in steps(offsets, STEP_BYTES // 4, STEP_ROWS):
                total += (trigram_counts(data, offsets, first, past) > 0).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([*range(DIMS), DIMS], pa.int32()), pa.array([*total.tolist(), n], pa.int64())], ["dim", "n"])

    got = rows.select("text").mapInArrow(tidied(run), "dim int, n bigint").groupBy("dim").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(DIMS + 1, np.int64)
    for r in got:
        df[r.dim] = r.n
    return df[:DIMS], int(df[DIMS])


def fit(df: DataFrame, learn: Column) -> Centroids:
    """Centroids from the rows where ``learn`` holds and text and lang are not null."""
    rows = df.select(F.col("doc_id"), F.col("text"), F.col("lang")).where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    frequency, n = _document_frequency(rows)
    idf = np.log((1 + n) / (1 + frequency)).astype(np.float32) + 1
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    each = max(1, SAMPLE_ROWS // max(1, len(sizes)))
    chosen = F.coalesce(*(F.when(F.col("lang") == k, drawn(each / v, F.lit("langid"), "doc_id")) for k, v in sizes.items()), F.lit(False))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_parts(batch.column(1))
            for first, past in steps(offsets, STEP_BYTES // 4, STEP_ROWS):
                counts = trigram_counts(data, offsets, first, past)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, past - first), pa.array([c.astype(np.uint16 if c.max(initial=0) < 65536 else np.float32).tobytes() for c in counts], pa.binary())], ["lang", "counts"])

    sample = rows.where(chosen).select("lang", "text").mapInArrow(tidied(vectors), "lang string, counts binary").collect()
    langs = sorted({r.lang for r in sample})
    if not langs:
        return Centroids([], idf, np.zeros(0, int), np.zeros((0, DIMS), np.float32), np.zeros(_LENGTHS))
    sample.sort(key=lambda r: (r.lang, bytes(r.counts)))  # rows come in any order
    counts = np.stack([np.frombuffer(r.counts, np.uint16 if len(r.counts) == 2 * DIMS else np.float32) for r in sample]).astype(np.float32)
    label = np.array([langs.index(r.lang) for r in sample])
    x = weighted(counts, idf)
    points = [k_means(x[label == k], CENTROIDS) for k in range(len(langs))]
    of = np.concatenate([np.full(len(p), k) for k, p in enumerate(points)])
    every = np.concatenate(points)
    top = (x @ every.T).max(axis=1)
    size = np.minimum(np.log2(1 + counts.sum(axis=1)).astype(int), _LENGTHS - 1)
    floor = np.full(_LENGTHS, NOTHING)
    for k in range(int(np.log2(JUDGED)), _LENGTHS):
        near = top[size == k]
        floor[k] = max(NOTHING, REACH * np.quantile(near, 0.01)) if len(near) >= 5 else floor[k - 1]
    return Centroids(langs, idf, of, every, floor)


def predict(df: DataFrame, model: Centroids, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, the columns of ``keep``, ``lang_pred`` (``und`` without a letter), ``score`` and ``rejected``."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Centroids = shared.value
        for batch in batches:
            texts = batch.column(at)
            data, offsets = string_parts(texts)
            lang, score, rejected = [], [], []
            for first, past in steps(offsets, STEP_BYTES // 4, STEP_ROWS):
                letter = [t is not None and _LETTER.search(t) is not None for t in texts.slice(first, past - first).to_pylist()]
                if not m.langs:
                    letter = [False] * (past - first)
                    choice, s, r = np.zeros(past - first, int), np.zeros(past - first), np.zeros(past - first, bool)
                else:
                    choice, s, r = m.predict(trigram_counts(data, offsets, first, past))
                lang += [m.langs[c] if ok else "und" for c, ok in zip(choice.tolist(), letter, strict=True)]
                score += np.where(letter, s, 0.0).tolist()
                rejected += (r | ~np.array(letter, bool)).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], names)

    columns = [id_col, *(c for c in keep if c != id_col)]
    read = columns if text_col in columns else [*columns, text_col]
    at = read.index(text_col)
    types = dict(df.dtypes)
    names = [*columns, "lang_pred", "score", "rejected"]
    schema = ", ".join(f"`{c}` {types[c]}" for c in columns) + ", lang_pred string, score double, rejected boolean"
    return df.select(*read).mapInArrow(tidied(run), schema)


def held_out() -> Column:
    """Rows that no one learns from: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def recognised(df: DataFrame) -> DataFrame:
    """The rows whose language is recognised, with the columns of ``df``: neither ``und`` nor rejected as far."""
    taken = {"lang_pred", "score", "rejected"} & {*df.columns}
    held = df.withColumnsRenamed({c: f"__own_{c}" for c in taken})
    found = predict(held, fit(df, ~F.coalesce(held_out(), F.lit(True))), keep=tuple(held.columns)).where(~F.col("rejected"))
    return found.select(*(F.col(f"__own_{c}" if c in taken else c).alias(c) for c in df.columns))


def identify(df: DataFrame) -> DataFrame:
    """One row per document: held_out, lang_pred, score, rejected."""
    model = fit(df, ~F.coalesce(held_out(), F.lit(True)))
    return predict(df, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
