"""Ranked lexical search: exact inner products found through sparse ball trees.

Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z lowered. A document is a sparse vector of integer
impacts, ``w * ((10**9 * tf) div (1000 * tf + 8 * m))`` for each of its terms, an item a vector of ones, and a score their
inner product (``w`` and ``m``: see ``weights`` and ``sparse``). Only coordinates of terms that some item holds can count.

1. ``sparse`` reads every text once and writes each document's terms of interest with their counts.
2. Each task builds ball trees over ``LEAF``-sized leaves of up to ``TREE`` of its documents: a node knows the centroid and
   the radius of its vectors, so that ``q . centroid + |q| * radius`` is no less than any score below it. All floating
   sums are widened by a bound of their rounding error, so that a subtree is only passed over if it holds nothing.
3. For each item the leaves are taken best-first, by the least bound on their path, until the bound is below the item's
   tenth score so far; scores at leaves are sums of integers below 2**53, hence exact. The tenth score goes on from tree
   to tree of a task.
4. Each task gives at most ``k`` rows an item; a window ranks those of all tasks.

Items are worked on in blocks of ``ITEMS``, all documents against each block.

Cases: a null text has no terms; a document without terms does not count as one and is never found; an item that is null
or has no terms finds nothing; repeated rows of documents or items are each ranked, equal items alike; a document without
an id comes after equal scores with one; ties go by ascending id; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltwatch.llm.common import Words, steps, string_parts, tidied, with_checkpoint_dir

#: Documents of a tree and of a leaf; items of a block.
TREE, LEAF, ITEMS = 4096, 32, 512
BEST = 10
_GAP = np.ones(256, bool)
_GAP[48:58] = _GAP[65:91] = _GAP[97:123] = _GAP[128:] = False
_ROUND = np.finfo(np.float64).eps


def terms(data: np.ndarray, offsets: np.ndarray, first: int, past: int) -> Words:
    return Words(data, offsets, first, past, lower=True, gaps=_GAP)


@dataclass
class Items:
    """A block of items: for each (row) the places of its distinct terms in ``words`` (sorted hashes)."""

    words: np.ndarray
    row: np.ndarray
    term: np.ndarray

    def __init__(self, texts: list[str | None]):
        self.n = len(texts)
        data, offsets = string_parts(pa.array(texts, pa.string()))
        w = terms(data, offsets, 0, len(texts))
        self.words, place = np.unique(w.hashes, return_inverse=True)
        pairs = np.unique(np.repeat(np.arange(self.n), np.diff(w.of)) * max(1, len(self.words)) + place)
        self.row, self.term = np.divmod(pairs, max(1, len(self.words)))

    def matrix(self) -> np.ndarray:
        q = np.zeros((self.n, len(self.words)))
        q[self.row, self.term] = 1
        return q


def sparse(docs: DataFrame, words: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n (terms of the whole text), places and counts of its distinct terms among ``words`` (sorted hashes), of
    every document with a term."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            data, offsets = string_parts(batch.column(1))
            for first, past in steps(offsets):
                w = terms(data, offsets, first, past)
                n = np.diff(w.of)
                at = np.minimum(np.searchsorted(known, w.hashes), max(0, len(known) - 1))
                hit = known[at] == w.hashes if len(known) else np.zeros(len(at), bool)
                key, tf = np.unique(np.repeat(np.arange(past - first), n)[hit] * max(1, len(known)) + at[hit], return_counts=True)
                row, place = np.divmod(key, max(1, len(known)))
                cut = np.searchsorted(row, np.arange(past - first + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, past - first),
                        pa.array(n, pa.int64()),
                        pa.ListArray.from_arrays(cut, place.astype(np.int32)),
                        pa.ListArray.from_arrays(cut, tf.astype(np.int32)),
                    ],
                    ["id", "n", "places", "tfs"],
                )

    found = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return found.mapInArrow(tidied(run), "id bigint, n bigint, places array<int>, tfs array<int>").where("n > 0")


def weights(n: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((2n + 2) / (2df + 1)))"""
    return np.floor(1000 * np.log((2.0 * n + 2.0) / (2.0 * df + 1.0))).astype(np.int64)


def impacts(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


@dataclass
class Rows:
    """Some documents: row ``k`` has the entries ``cut[k]`` to ``cut[k + 1]`` of ``term`` and ``value``."""

    ids: np.ndarray
    cut: np.ndarray
    term: np.ndarray
    value: np.ndarray

    def take(self, rows: np.ndarray) -> Rows:
        size = np.diff(self.cut)[rows]
        cut = np.concatenate([[0], size.cumsum()])
        at = np.arange(cut[-1]) + np.repeat(self.cut[rows] - cut[:-1], size)
        return Rows(self.ids[rows], cut, self.term[at], self.value[at])

    def times(self, dense: np.ndarray) -> np.ndarray:
        """The inner product of each row with a dense vector."""
        return _sums(self.value * dense[self.term], self.cut)


def _sums(values: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (last axis) between the cuts."""
    out = np.zeros((*values.shape[:-1], len(cut) - 1))
    full = np.flatnonzero(np.diff(cut))
    if len(full):
        out[..., full] = np.add.reduceat(values, cut[full], axis=-1)
    return out


def centre(rows: Rows, width: int) -> np.ndarray:
    return np.bincount(rows.term, rows.value, width) / max(1, len(rows.ids))


def radius(rows: Rows, c: np.ndarray) -> float:
    """No less than the distance of any row from ``c``: |x|^2 - 2 x.c + |c|^2, each with its rounding error."""
    sizes = _sums(rows.value**2, rows.cut)
    whole = float(c @ c)
    error = 8 * _ROUND * (len(c) + 8) * (np.sqrt(sizes) + np.sqrt(whole)) ** 2
    return float(np.sqrt(np.maximum(0, sizes - 2 * rows.times(c) + whole + error)).max() * (1 + 8 * _ROUND))


def bounds(q: np.ndarray, c: np.ndarray, r: float) -> np.ndarray:
    """No less than the inner product of each row of ``q`` (zeros and ones) with any vector of the ball."""
    n = q.sum(axis=1)
    centred = q @ c
    return (centred + np.sqrt(n) * r) * (1 + 8 * _ROUND * (q.shape[1] + 8)) + 1


def halves(rows: Rows, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of the rows, split by which of two far rows they point to."""

    def far(from_: np.ndarray) -> np.ndarray:
        k = int((_sums(rows.value**2, rows.cut) - 2 * rows.times(from_)).argmax())
        out = np.zeros(width)
        out[rows.term[rows.cut[k] : rows.cut[k + 1]]] = rows.value[rows.cut[k] : rows.cut[k + 1]]
        return out

    one = far(centre(rows, width))
    order = np.argsort(rows.times(far(one) - one), kind="stable")
    return np.sort(order[: len(order) // 2]), np.sort(order[len(order) // 2 :])


def leaves(rows: Rows, q: np.ndarray) -> list[tuple[Rows, np.ndarray]]:
    """The leaves of a ball tree over the rows, each with the least bound of the nodes above it for each item."""
    out = []
    todo = [(rows, np.full(len(q), np.inf))]
    while todo:
        some, above = todo.pop()
        c = centre(some, q.shape[1])
        above = np.minimum(above, bounds(q, c, radius(some, c)))
        if len(some.ids) <= LEAF:
            out.append((some, above))
        else:
            todo += [(some.take(half), above) for half in halves(some, q.shape[1])]
    return out


class Search:
    """The best documents of each item so far, over one tree after another."""

    def __init__(self, items: Items, k: int):
        self.items, self.k, self.q = items, k, items.matrix()
        self.score = [np.zeros(0)] * items.n
        self.ids = [np.zeros(0, np.int64)] * items.n
        self.least = np.zeros(items.n)  # a score below this is of no use; none below 1 is
        self.seen = 0

    def add(self, rows: Rows) -> None:
        if float(np.max(rows.value, initial=0)) * self.q.sum(axis=1).max(initial=0) >= 2**53:
            raise OverflowError("scores of 2**53 and more are not exact in doubles")
        tree = leaves(rows, self.q)
        bound = np.stack([b for _, b in tree])
        order = np.argsort(-bound, axis=0)
        mark = self.q.astype(bool)
        for step in range(len(tree)):  # each item's next best leaf; items at the same leaf are scored together
            alive = np.flatnonzero(bound[order[step], np.arange(self.items.n)] >= np.maximum(self.least, 1))
            if not len(alive):
                break
            at = order[step, alive]
            for leaf in np.unique(at).tolist():
                asked = alive[at == leaf]
                some = tree[leaf][0]
                self.seen += len(asked)
                scores = _sums(mark[np.ix_(asked, some.term)] * some.value, some.cut)
                for item, s in zip(asked.tolist(), scores, strict=True):
                    new = np.flatnonzero(s >= max(self.least[item], 1))
                    if len(new):
                        self.keep(item, s[new], some.ids[new])

    def keep(self, item: int, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score[item], score]), np.concatenate([self.ids[item], ids])
        best = np.lexsort((ids, -score))[: self.k]
        self.score[item], self.ids[item] = score[best], ids[best]
        if len(best) == self.k:
            self.least[item] = score[best[-1]]


#: Stands for a missing id, after all others.
_NONE = 2**63 - 1


def _best(rows: DataFrame, items: Items, weight: np.ndarray, n: int, length: int, k: int) -> DataFrame:
    """item (row of the block), id, score: the best ``k`` of each task; columns id, n, places, tfs (places of the block)."""
    shared = rows.sparkSession.sparkContext.broadcast((items, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, w = shared.value
        search = Search(block, k)
        held: list[pa.RecordBatch] = []

        def work(table: pa.Table) -> None:
            table = table.combine_chunks()
            places, tfs = table.column("places").combine_chunks(), table.column("tfs").combine_chunks()
            cut = places.offsets.to_numpy().astype(np.int64) - places.offsets[0].as_py() if len(places) else np.zeros(1, np.int64)
            term, tf = places.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy().astype(np.int64)
            m = 100 - 90 + (90 * table.column("n").to_numpy() * n) // length
            value = impacts(w[term], tf, np.repeat(m, np.diff(cut))).astype(np.float64)
            search.add(Rows(table.column("id").to_numpy(), cut, term, value))

        for batch in batches:
            for first in range(0, len(batch), TREE):
                held.append(batch.slice(first, TREE))
                if sum(map(len, held)) >= TREE:
                    work(pa.Table.from_batches(held))
                    held = []
        if held:
            work(pa.Table.from_batches(held))
        size = [len(x) for x in search.ids]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(block.n, dtype=np.int32), size)),
                pa.array(np.concatenate([np.zeros(0, np.int64), *search.ids])),
                pa.array(np.concatenate([np.zeros(0), *search.score]).astype(np.int64)),
            ],
            ["item", "id", "score"],
        )

    return rows.mapInArrow(tidied(run), "item int, id bigint, score bigint")


def search(docs: DataFrame, items: DataFrame, k: int = BEST, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_col``, rank (from 1), ``id_col``, score of the ``k`` best documents of each row of ``items``.

    ``items`` is the stated query set: its texts come to the driver and go to every task.
    """
    spark = docs.sparkSession
    where = f"{with_checkpoint_dir(spark).rstrip('/')}/lexical-{uuid.uuid4().hex}"
    asked = items.select(F.col(item_col).alias("item_id"), F.col(text_col).cast("string").alias("text")).collect()
    kind = dict(items.dtypes)[item_col]
    words = Items([r.text for r in asked]).words
    sparse(docs, words, id_col, text_col).write.parquet(f"{where}/sparse")
    rows = spark.read.parquet(f"{where}/sparse")
    n, length = rows.agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(len(words), np.int64)
    for r in rows.select(F.explode("places").alias("place")).groupBy("place").agg(F.count("*").alias("df")).collect():  # a row a term
        df[r.place] = r.df
    weight = weights(n, df)
    ranked = None
    for first in range(0, max(1, len(asked)), ITEMS):
        some = asked[first : first + ITEMS]
        block = Items([r.text for r in some])
        held = rows.select(F.coalesce("id", F.lit(_NONE)).alias("id"), "n", "places", "tfs")
        if len(asked) > ITEMS:  # only the block's terms
            held = _renumbered(held, np.searchsorted(words, block.words))
        else:
            held = held.where(F.size("places") > 0)
        best = _best(held, block, weight[np.searchsorted(words, block.words)], n, length or 1, k)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(some)], f"item int, item_id {kind}")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("id"))
        top = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).join(names, "item")
        top = top.select(F.col("item_id").alias(item_col), "rank", F.when(F.col("id") != _NONE, F.col("id")).alias(id_col), "score")
        ranked = top if ranked is None else ranked.unionAll(top)
    return ranked


def _renumbered(rows: DataFrame, kept: np.ndarray) -> DataFrame:
    """The rows with the entries of the places ``kept`` (sorted) only, numbered from 0; rows without any go."""
    shared = rows.sparkSession.sparkContext.broadcast(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            places = batch.column(2)
            at = places.flatten().to_numpy()
            to = np.minimum(np.searchsorted(known, at), len(known) - 1) if len(known) else np.zeros(len(at), np.int64)
            hit = known[to] == at if len(known) else np.zeros(len(at), bool)
            cut = np.concatenate([[0], hit.cumsum()])[places.offsets.to_numpy() - places.offsets[0].as_py()].astype(np.int32)
            lists = [pa.ListArray.from_arrays(cut, pa.array(x.astype(np.int32))) for x in (to[hit], batch.column(3).flatten().to_numpy()[hit])]
            full = pa.array(np.diff(cut) > 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], ["id", "n", "places", "tfs"]).filter(full)

    return rows.mapInArrow(run, "id bigint, n bigint, places array<int>, tfs array<int>")
