"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted verification.

DataFrame functions only. Words are runs of letters and digits, lower case; a shingle is ``SHINGLE`` consecutive words,
weighted by its letters (a quarter of their number, 1 to 15). A text of fewer words is one shingle of another kind, its
whole sequence. A document leaks an item if some window of it, as long as the item, holds shingles of at least
``LEAST`` of the item's weight (distinct shingles on both sides).

1. A window without any shingle of the item has no share of its weight, so windows are taken around shingles that occur
   in the benchmark: every window of an item's length that covers one.
2. Each window and each item gets a SimHash of ``BITS`` weighted bits over its distinct shingles. The shingles of texts
   that have such windows are written once; from here on only fingerprints travel.
3. The bits are cut into ``BLOCKS`` blocks. Each item is entered under every value within ``NEAR`` bits of its own, block
   by block; two fingerprints within ``RADIUS`` bits differ by at most ``NEAR`` bits in some block, so one look-up a
   block finds all of them.
4. Candidates are verified exactly, on the written shingles.

Cases: a null or empty text, or one without words, leaks nothing; an item without words, or null, is leaked by nothing;
an item of fewer than five words is leaked only by a text of the same words; repeated rows count once, equal ids with
different texts are separate; equal items are each reported; ties of windows go to the first; empty tables give no rows;
other columns are ignored by ``leaks`` and kept by ``decontaminate``.
"""

from __future__ import annotations

import uuid
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltwatch.llm.common import with_checkpoint_dir

SHINGLE, LEAST = 5, 0.8
BLOCKS, WIDTH, NEAR = 7, 9, 3
BITS, RADIUS = BLOCKS * WIDTH, BLOCKS * (NEAR + 1) - 1
_LANES = 21
_THREE = 1 | 1 << _LANES | 1 << 2 * _LANES


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _short(w: Column) -> Column:
    return F.array(F.xxhash64(F.size(w), F.array_join(w, " ")))


def _hashes(w: Column) -> Column:
    """Shingle hashes of an array of words, in order; no words: none."""
    many = F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(SHINGLE))))
    return F.when(F.size(w) >= SHINGLE, many).when(F.size(w) > 0, _short(w)).otherwise(F.array().cast("array<bigint>"))


def _weighted(w: Column) -> Column:
    """Shingle hashes whose last four bits are replaced by the weight."""

    def packed(h: Column, letters: Column) -> Column:
        weight = F.least(F.lit(15), F.greatest(F.lit(1), F.floor(letters / 4))).cast("bigint")
        return h.bitwiseAND(F.lit(-16)).bitwiseOR(weight)

    many = F.transform(
        F.sequence(F.lit(0), F.size(w) - SHINGLE),
        lambda i: packed(F.xxhash64(*(F.get(w, i + k) for k in range(SHINGLE))), sum((F.length(F.get(w, i + k)) for k in range(1, SHINGLE)), F.length(F.get(w, i)))),
    )
    one = F.transform(_short(w), lambda h: packed(h, F.length(F.array_join(w, ""))))
    return F.when(F.size(w) >= SHINGLE, many).when(F.size(w) > 0, one).otherwise(F.array().cast("array<bigint>"))


def _weight(shingles: Column) -> Column:
    return F.aggregate(shingles, F.lit(0).cast("bigint"), lambda acc, x: acc + x.bitwiseAND(F.lit(15)))


def _simhash(shingles: Column) -> Column:
    """``BITS`` majority bits of the hashed shingles by weight; each of 21 sums holds three bits' weights."""
    start = F.struct(*(F.lit(0).cast("bigint").alias(f"s{k}") for k in range(_LANES)), F.lit(0).cast("bigint").alias("all"))

    def step(acc: Column, x: Column) -> Column:
        h, w = F.xxhash64(x), x.bitwiseAND(F.lit(15))
        return F.struct(*((acc[f"s{k}"] + w * F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_THREE))).alias(f"s{k}") for k in range(_LANES)), (acc["all"] + w).alias("all"))

    def bits(acc: Column) -> Column:
        out = F.lit(0).cast("bigint")
        for j in range(BITS):
            lane = F.shiftrightunsigned(acc[f"s{j % _LANES}"], j // _LANES * _LANES).bitwiseAND(F.lit((1 << _LANES) - 1))
            out = out.bitwiseOR(F.when(lane * 2 > acc["all"], F.lit(1 << j)).otherwise(F.lit(0)).cast("bigint"))
        return out

    return F.aggregate(shingles, start, step, bits)


def _block(fingerprint: Column, k: int) -> Column:
    return F.shiftrightunsigned(fingerprint, k * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1)).cast("int")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, text and two hashes that tell documents apart."""
    t = F.col(text_col)
    return docs.select(F.col(id_col).alias("id"), t.alias("text"), F.xxhash64(F.col(id_col), t).alias("k1"), F.xxhash64(F.lit(1), t, F.col(id_col)).alias("k2"))


def _leaks(keyed: DataFrame, benchmark: DataFrame) -> DataFrame:
    """k1, k2, id, item_id, first_word, similarity of every leak."""
    items = benchmark.where("item_id IS NOT NULL").select("item_id", words(F.col("text")).alias("w"))
    items = items.select("item_id", "w", _weighted(F.col("w")).alias("shingles")).where(F.size("shingles") > 0)
    items = items.select("item_id", F.size("shingles").alias("long"), F.array_distinct("shingles").alias("own"), _weight(F.array_distinct("shingles")).alias("full"), _simhash(F.array_distinct("shingles")).alias("item_print"), "w")
    wanted = items.select("long", F.explode(_hashes(F.col("w"))).alias("shingle")).distinct()
    split = keyed.select("k1", "k2", words(F.col("text")).alias("w"))  # a column, so that no lambda splits the text again
    placed = split.select("k1", "k2", F.posexplode(_hashes(F.col("w"))).alias("at", "shingle"))
    met = placed.join(wanted, "shingle").groupBy("k1", "k2", "long").agg(F.collect_set("at").alias("at"))

    held = met.join(keyed, ["k1", "k2"]).dropDuplicates(["k1", "k2", "long"])
    held = held.select("k1", "k2", "id", "long", "at", words(F.col("text")).alias("w")).select("k1", "k2", "id", "long", "at", _weighted(F.col("w")).alias("shingles"))
    last = F.greatest(F.lit(0), F.size("shingles") - F.col("long"))
    starts = F.array_distinct(F.flatten(F.transform("at", lambda p: F.sequence(F.least(F.greatest(F.lit(0), p - F.col("long") + 1), last), F.least(p, last)))))
    where = f"{with_checkpoint_dir(keyed.sparkSession).rstrip('/')}/leaks-{uuid.uuid4().hex}"
    held.select("k1", "k2", "id", "long", "shingles", starts.alias("starts")).write.parquet(where)
    held = keyed.sparkSession.read.parquet(where)
    window = F.array_distinct(F.slice("shingles", F.col("first_word") + 1, F.col("long")))
    windows = held.withColumn("first_word", F.explode("starts")).select("k1", "k2", "long", "first_word", _simhash(window).alias("print"))

    flips = [sum(1 << b for b in some) for n in range(NEAR + 1) for some in combinations(range(WIDTH), n)]
    entries = items.select("item_id", "long", "item_print", F.posexplode(F.array(*(_block(F.col("item_print"), k) for k in range(BLOCKS)))).alias("block", "value"))
    entries = entries.withColumn("flip", F.explode(F.array(*map(F.lit, flips)))).select("item_id", "long", "item_print", "block", F.col("value").bitwiseXOR(F.col("flip")).alias("value"))
    index = entries.groupBy("long", "block", "value").agg(F.collect_list(F.struct("item_id", "item_print")).alias("items"))
    asked = windows.select("*", F.posexplode(F.array(*(_block(F.col("print"), k) for k in range(BLOCKS)))).alias("block", "value"))
    near = asked.join(index, ["long", "block", "value"]).select("k1", "k2", "long", "first_word", "print", F.explode("items").alias("item"))
    near = near.where(F.bit_count(F.col("print").bitwiseXOR(F.col("item.item_print"))) <= RADIUS)
    # a window and an item meet in several blocks; one row for each text and item, with the places to look at
    near = near.groupBy("k1", "k2", "long", F.col("item.item_id").alias("item_id")).agg(F.collect_set("first_word").alias("places"))
    both = near.join(held.select("k1", "k2", "id", "long", "shingles"), ["k1", "k2", "long"]).join(items.select("item_id", "long", "own", "full"), ["item_id", "long"])
    both = both.select("k1", "k2", "id", "item_id", "shingles", "long", "own", "full", F.explode("places").alias("first_word"))
    share = _weight(F.array_intersect(F.slice("shingles", F.col("first_word") + 1, F.col("long")), F.col("own"))) / F.col("full")
    found = both.select("k1", "k2", "id", "item_id", "first_word", share.alias("similarity")).where(F.col("similarity") >= LEAST)
    return found.groupBy("k1", "k2", "id", "item_id").agg(F.max(F.struct("similarity", (-F.col("first_word")).alias("back"))).alias("best")).select(
        "k1", "k2", "id", "item_id", (-F.col("best.back")).cast("bigint").alias("first_word"), F.col("best.similarity").alias("similarity")
    )


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, item_id, first_word (of the best window, from 0), similarity for every document and item it leaks."""
    return _leaks(_keyed(docs, id_col, text_col), benchmark).select(F.col("id").alias(id_col), "item_id", "first_word", "similarity")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that leak no item, with all their columns."""
    t = F.col(text_col)
    held = docs.withColumns({"__k1": F.xxhash64(F.col(id_col), t), "__k2": F.xxhash64(F.lit(1), t, F.col(id_col))})
    bad = _leaks(_keyed(docs, id_col, text_col), benchmark).select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2")).distinct()
    return held.join(bad, ["__k1", "__k2"], "left_anti").select(*docs.columns)
