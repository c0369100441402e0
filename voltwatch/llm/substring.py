"""Substring dedup by super-k-mers.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A window is ``window`` consecutive words of one document; a word is removed
if a window that covers it has a word sequence that starts anywhere else too (same document included), judged on the
input.

The least hash among a window's ``MINIMISER``-word runs, the first of equals, is its minimiser; consecutive windows with
the minimiser at one place form a super-k-mer. Equal windows have equal minimisers at equal distances, so they are never
in one super-k-mer, and:

1. every super-k-mer gives a short row (minimiser, hash of its words, place), counted by minimiser with partial sums;
2. a minimiser seen once has no repeat; one whose super-k-mers are all the same repeats whole;
3. of the rest each distinct super-k-mer travels once, as one packed string, to its minimiser's bucket, where windows
   are sorted and counted. A minimiser of more than ``HOT`` distinct super-k-mers (a passage of very many documents, with
   other words around it) would be one hot bucket: its super-k-mers are cut into chunks of a few windows, which are
   told apart by 128-bit hashes of their words with partial sums, which spreads them. Only where distinct chunks share
   the words that all their windows have are windows counted one by one, those of each distinct chunk once;
4. the repeated windows come back by document.

Cases: a null text has no words; a text shorter than a window keeps all words; repeated rows are repeats of each other;
documents are told apart by id and text together, so null and repeated ids are fine; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltwatch.llm.common import Words, _power, grams, hex_sha, mix, shuffle_partitions, steps, string_parts, with_checkpoint_dir

WINDOW, MINIMISER, HOT = 35, 6, 1000
#: Windows of a chunk of a hot super-k-mer.
CHUNK = 6
#: Bytes of packed strings whose windows are sorted at once (whole buckets only).
SORT_BYTES = 4 << 20
_OTHER = np.uint64(0xD6E8FEB86659FD93)
#: Low bits that hold the place in the order of minimisers.
_PLACE = np.uint64((1 << 28) - 1)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    if len(x) < width:
        return x[:0]
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if span < width else x


def super_kmers(words: Words, window: int) -> tuple[np.ndarray, ...]:
    """(text, first word within the text, windows, minimiser, hash) of each super-k-mer of a step's texts."""
    h = words.hashes
    n = len(h)
    empty = np.zeros(0, np.int64)
    if n < window:
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    row = np.repeat(np.arange(len(words)), np.diff(words.of))
    m = min(MINIMISER, window)
    value = grams(h, m)
    place = sliding_min((value & ~_PLACE) | np.arange(len(value), dtype=np.uint64), window - m + 1) & _PLACE
    at = np.flatnonzero(row[: n - window + 1] == row[window - 1 :])
    if not len(at):
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    place = place[at]
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (row[at[1:]] != row[at[:-1]])]))
    count = np.diff(np.append(first, len(at)))
    begin = at[first]
    up, down = _power(n)
    term = h * up
    total = term.cumsum(dtype=np.uint64)
    last = begin + count + window - 2
    whole = mix((total[last] - total[begin] + term[begin]) * down[begin] + count.astype(np.uint64))
    return row[begin], begin - words.of[row[begin]], count, value[place[first].astype(np.int64)], whole


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id, the text, and two hashes that tell documents apart."""
    t = F.col(text_col)
    return docs.select(F.col(id_col).alias("id"), t.alias("text"), F.xxhash64(F.col(id_col), t).alias("k1"), F.xxhash64(F.lit(1), t, F.col(id_col)).alias("k2"))


def _short_rows(keyed: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_parts(batch.column(2))
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for first, past in steps(offsets):
                row, start, count, value, whole = super_kmers(Words(data, offsets, first, past), window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (k1[first + row], k2[first + row], start.astype(np.int32), count.astype(np.int32), value.view(np.int64), whole.view(np.int64))],
                    ["k1", "k2", "start", "count", "mini", "whole"],
                )

    return keyed.select("k1", "k2", "text").mapInArrow(run, "k1 bigint, k2 bigint, start int, count int, mini bigint, whole bigint")


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], dict]]:
    """(words, super-k-mer) of each super-k-mer asked for; columns text, asked."""
    for text, asked in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True):
        words = text.split()
        for k in asked:
            yield words, k


def _packed(asked: DataFrame, window: int) -> DataFrame:
    """(mini, whole, often, packed): the words of each super-k-mer asked for, as one string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                found = [(k["mini"], k["whole"], k["often"], b" ".join(words[k["start"] : k["start"] + k["count"] + window - 1])) for words, k in _pieces(batch.slice(at, 500))]
                mini, whole, often, packed = zip(*found, strict=True) if found else ((), (), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(mini, pa.int64()), pa.array(whole, pa.int64()), pa.array(often, pa.bool_()), pa.array(packed, pa.binary()).cast(pa.string())], ["mini", "whole", "often", "packed"])

    return asked.select("text", "asked").mapInArrow(run, "mini bigint, whole bigint, often boolean, packed string")


def _window_hashes(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and two hashes of every window of a step's texts."""
    row = np.repeat(np.arange(len(words)), np.diff(words.of))
    inside = row[: max(0, len(row) - window + 1)] == row[window - 1 :]
    return row[: len(inside)][inside], grams(words.hashes, window)[inside], grams(words.hashes ^ _OTHER, window)[inside]


def _counted(rows: DataFrame, window: int) -> DataFrame:
    """(mini, whole, bits): for each super-k-mer with a repeated window, a bit a window. Rows come bucket by bucket."""

    def worked(table: pa.Table) -> pa.RecordBatch:
        data, offsets = string_parts(table.column("packed"))
        words = Words(data, offsets, 0, len(table))
        row, one, two = _window_hashes(words, window)
        order = np.lexsort((two, one))
        same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
        repeated = np.zeros(len(row), bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        repeated |= table.column("often").to_numpy()[row]
        cut = np.searchsorted(row, np.arange(len(table) + 1))
        some = [k for k in np.unique(row[repeated]).tolist()]
        return pa.RecordBatch.from_arrays(
            [table.column("mini").combine_chunks().take(pa.array(some, pa.int64())), table.column("whole").combine_chunks().take(pa.array(some, pa.int64())), pa.array([np.packbits(repeated[cut[k] : cut[k + 1]]).tobytes() for k in some], pa.binary())],
            ["mini", "whole", "bits"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not len(batch):
                continue
            minis = batch.column(0).to_numpy()
            sizes = np.array([len(x) for x in batch.column(3).to_pylist()])
            at = 0
            for end in [*(np.flatnonzero(np.diff(minis)) + 1).tolist(), len(batch)]:  # the ends of buckets
                if size >= SORT_BYTES and (at or held[-1].column(0)[-1].as_py() != minis[0]):
                    yield worked(pa.Table.from_batches(held))
                    held, size = [], 0
                held.append(batch.slice(at, end - at))
                size += int(sizes[at:end].sum())
                at = end
        if held:
            yield worked(pa.Table.from_batches(held))

    return rows.mapInArrow(run, "mini bigint, whole bigint, bits binary")


def _range_hashes(h: np.ndarray, begin: np.ndarray, past: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """A hash of the words ``begin`` to ``past`` of each range, and of a number."""
    up, down = _power(len(h))
    total = np.concatenate([np.zeros(1, np.uint64), (h * up).cumsum(dtype=np.uint64)])
    return mix((total[past] - total[begin]) * down[begin] + salt.astype(np.uint64))


def _hot_chunks(asked: DataFrame, window: int) -> DataFrame:
    """A row a chunk of each super-k-mer asked for: up to ``CHUNK`` windows in a row, cut by the minimiser's place in them,
    so that equal windows lie in chunks of one number. (c1, c2): hashes of the number and of the words that every window
    of such a chunk has; (s1, s2): of the chunk's own words; ``at``: its first window; ``hashes``: two of each window."""
    m = min(MINIMISER, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                found = [(k, b" ".join(words[k["start"] : k["start"] + k["count"] + window - 1])) for words, k in _pieces(batch.slice(at, 500))]
                if not found:
                    continue
                data, offsets = string_parts(pa.array([p for _, p in found], pa.binary()).cast(pa.string()))
                words = Words(data, offsets, 0, len(found))
                h, begin = words.hashes, words.of[:-1]
                value = grams(h, m)
                place = (sliding_min((value & ~_PLACE) | np.arange(len(value), dtype=np.uint64), window - m + 1) & _PLACE).astype(np.int64)[begin]
                row, one, two = _window_hashes(words, window)
                nth = np.arange(len(row)) - np.searchsorted(row, row)
                number = ((place - begin)[row] - nth) // CHUNK
                first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (number[1:] != number[:-1])]))
                n = np.diff(np.append(first, len(row)))
                row, number, start = row[first], number[first], nth[first]
                low, high = number * CHUNK, np.minimum(number * CHUNK + CHUNK - 1, window - m)
                core = place[row] - low, place[row] - high + window
                own = begin[row] + start, begin[row] + start + n + window - 1
                keys = [_range_hashes(x, *r, salt) for r, salt in ((core, number), (own, n)) for x in (h, h ^ _OTHER)]
                both = np.stack([one, two], axis=1)
                columns = [np.array([k[c] for k, _ in found], np.int64)[row] for c in ("mini", "whole", "count")]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x.view(np.int64)) for x in keys), *(pa.array(x) for x in columns[:2]), *(pa.array(x.astype(np.int32)) for x in (columns[2], start, n)), pa.array([both[f : f + k].tobytes() for f, k in zip(first.tolist(), n.tolist(), strict=True)], pa.binary())],
                    ["c1", "c2", "s1", "s2", "mini", "whole", "count", "at", "n", "hashes"],
                )

    return asked.select("text", "asked").mapInArrow(run, "c1 bigint, c2 bigint, s1 bigint, s2 bigint, mini bigint, whole bigint, count int, at int, n int, hashes binary")


def _hot_windows(spans: DataFrame) -> DataFrame:
    """(one, two, c1, c2, s1, s2, k): a row a window of each distinct chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            n = batch.column(4).to_numpy()
            both = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.int64).reshape(-1, 2)
            row = np.repeat(np.arange(len(batch)), n)
            k = (np.arange(len(row)) - np.repeat(n.cumsum() - n, n)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), *(pa.array(batch.column(c).to_numpy()[row]) for c in range(4)), pa.array(k)], ["one", "two", "c1", "c2", "s1", "s2", "k"])

    return spans.select("c1", "c2", "s1", "s2", "n", "hashes").mapInArrow(run, "one bigint, two bigint, c1 bigint, c2 bigint, s1 bigint, s2 bigint, k int")


def _hot_places(asked: DataFrame, window: int, where: str) -> DataFrame:
    """(mini, whole, count, at): the repeated windows of the super-k-mers asked for, an array each.

    Chunks with other common words have no equal windows, and equal chunks have all of theirs: only distinct chunks with
    the same common words are counted window by window."""
    spark = asked.sparkSession
    _hot_chunks(asked, window).write.parquet(f"{where}/hot")
    hot, core, span = spark.read.parquet(f"{where}/hot"), ["c1", "c2"], ["c1", "c2", "s1", "s2"]
    hot.groupBy(*span).agg(F.count("*").alias("times"), F.min("n").alias("n"), F.min("hashes").alias("hashes")).write.parquet(f"{where}/spans")
    spans = spark.read.parquet(f"{where}/spans")  # written, as are the others, so that Spark can split the joins
    spans.groupBy(*core).agg(F.count("*").alias("distinct")).where(F.col("distinct") > 1).select(*core).write.parquet(f"{where}/cores")
    _hot_windows(spans.join(spark.read.parquet(f"{where}/cores"), core)).write.parquet(f"{where}/windows")
    windows = spark.read.parquet(f"{where}/windows")
    twice = windows.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1").select("one", "two")
    some = windows.join(twice, ["one", "two"]).groupBy(*span).agg(F.collect_set("k").alias("ks"))
    all_of = spans.where("times > 1").select(*span, F.sequence(F.lit(0), F.col("n") - 1).alias("ks"))
    some.join(all_of.select(*span), span, "left_anti").select(*span, "ks").union(all_of).write.parquet(f"{where}/repeats")
    back = hot.join(spark.read.parquet(f"{where}/repeats"), span)
    return back.groupBy("mini", "whole", "count").agg(F.flatten(F.collect_list(F.transform("ks", lambda k: k + F.col("at")))).alias("at"))


def _kept(marked: DataFrame, window: int, kind: str) -> DataFrame:
    """(id, n_words, n_removed, kept_text); columns id, text, marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                some = batch.slice(at, 500)
                n, removed, kept = [], [], []
                for text, marks in zip(some.column(1).cast(pa.binary()).to_pylist(), some.column(2).to_pylist(), strict=True):
                    words = text.split() if text else []
                    n.append(len(words))
                    if marks:
                        edge = np.zeros(len(words) + 1, np.int64)
                        for m in marks:
                            bits = np.unpackbits(np.frombuffer(m["bits"], np.uint8), count=m["count"]) if m["bits"] is not None else np.ones(m["count"], np.uint8)
                            places = m["start"] + np.flatnonzero(bits)
                            np.add.at(edge, places, 1)
                            np.add.at(edge, places + window, -1)
                        covered = edge.cumsum()[:-1] > 0
                        removed.append(int(covered.sum()))
                        words = [words[k] for k in np.flatnonzero(~covered).tolist()]
                    else:
                        removed.append(0)
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["id", "n_words", "n_removed", "kept_text"])

    return marked.select("id", "text", "marks").mapInArrow(run, f"id {kind}, n_words bigint, n_removed bigint, kept_text string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``id_col``, n_words, n_removed, kept_text of every document."""
    spark = docs.sparkSession
    where = f"{with_checkpoint_dir(spark).rstrip('/')}/substring-{uuid.uuid4().hex}"
    keyed = _keyed(docs, id_col, text_col)
    _short_rows(keyed, window).write.parquet(f"{where}/short")
    short = spark.read.parquet(f"{where}/short")
    minis = short.groupBy("mini").agg(F.count("*").alias("n"), F.min("whole").alias("low"), F.max("whole").alias("high")).where("n > 1")
    # written, so that the join has plain shuffles on both sides and Spark can split a minimiser of very many rows
    minis.select("mini", (F.col("low") != F.col("high")).alias("contested")).write.parquet(f"{where}/minis")
    seen = short.join(spark.read.parquet(f"{where}/minis"), "mini")
    seen.write.parquet(f"{where}/seen")
    seen = spark.read.parquet(f"{where}/seen")

    contested = seen.where("contested").groupBy("mini", "whole", "count").agg((F.count("*") > 1).alias("often"), F.min(F.struct("k1", "k2", "start")).alias("r"))
    contested.select("r.*", "mini", "whole", "count", "often").write.parquet(f"{where}/contested")
    contested = spark.read.parquet(f"{where}/contested")
    contested.groupBy("mini").agg(F.count("*").alias("distinct")).where(F.col("distinct") > HOT).select("mini", F.lit(True).alias("hot")).write.parquet(f"{where}/crowds")
    first = contested.join(spark.read.parquet(f"{where}/crowds"), "mini", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))

    def asked(rows: DataFrame) -> DataFrame:
        by_doc = rows.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "count", "mini", "whole", "often")).alias("asked"))
        return keyed.join(by_doc, ["k1", "k2"])

    buckets = _packed(asked(first.where("NOT hot")), window).repartition(shuffle_partitions(spark), "mini").sortWithinPartitions("mini")
    places = _hot_places(asked(first.where("hot")), window, where)
    often = first.where("hot AND often").select("mini", "whole", F.lit(None).cast("binary").alias("bits"))
    bit = F.array_join(F.transform(F.sequence(F.lit(0), F.ceil(F.col("count") / 8).cast("int") * 8 - 1), lambda k: F.when(F.array_contains("at", k), "1").otherwise("0")), "")
    bits = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.ceil(F.col("count") / 8).cast("int") - 1), lambda k: F.lpad(F.conv(F.substring(bit, k * 8 + 1, F.lit(8)), 2, 16), 2, "0")), ""))
    few = places.select("mini", "whole", bits.alias("bits")).join(often.select("mini", "whole"), ["mini", "whole"], "left_anti")
    # equal rows (id and text) give equal marks: one of each, before they meet the rows again
    _counted(buckets, window).union(few).union(often).groupBy("mini", "whole").agg(F.max("bits").alias("bits")).write.parquet(f"{where}/repeated")
    repeated = spark.read.parquet(f"{where}/repeated")  # written, so that Spark can split a super-k-mer of very many rows

    marks = seen.where("NOT contested").select("k1", "k2", "start", "count", F.lit(None).cast("binary").alias("bits")).union(
        seen.where("contested").join(repeated, ["mini", "whole"]).select("k1", "k2", "start", "count", "bits")
    )
    by_doc = marks.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "count", "bits")).alias("marks"))
    kind = dict(docs.dtypes)[id_col]
    return _kept(keyed.join(by_doc, ["k1", "k2"], "left"), window, kind).withColumnRenamed("id", id_col)


def substring_digest(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", hex_sha("kept_text").alias("kept_sha256"))
