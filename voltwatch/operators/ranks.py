"""Global ranks without a global sort: prefix sums, exact quantiles, exact cut-offs.

No operator here puts all values of a column, or of a group, into one task.

* ``cumulative``: running sums over a histogram. Its rows are placed in range partitions (frozen, they are narrow); the
  sums of earlier partitions are added to the running sum inside each one.
* ``exact_quantiles``: a sketch brackets every wanted rank, then values below the bracket are counted and only those
  inside it make a histogram, from whose running counts the exact order statistics are read.
* ``first_rows``: the first k rows of each group in the order of integer keys. The k-th key comes from radix histograms
  (four rounds of 16 bits over the keys alone), and a filter does the rest: wide rows are neither sorted nor written.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import null_safe_join, reliable_checkpoint

#: Rank error of the sketch is n / ACCURACY; brackets are three such errors wide on each side.
ACCURACY = 10_000
_MIN = -(2**63)


def cumulative(df: DataFrame, order: Column, sums: dict[str, str], by: Sequence[str] = ()) -> DataFrame:
    """Adds, for each ``column: name`` of ``sums``, the running sum of the column in ``order`` (which has to be total
    within a group) over each group of ``by``; null groups are groups."""
    by = list(by)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = reliable_checkpoint(df.repartitionByRange(parts, *[F.col(c).asc_nulls_first() for c in by], order)
                                 .select("*", F.spark_partition_id().alias("_range")))
    whole = placed.groupBy("_range", *by).agg(*[F.sum(c).alias(f"_sum{i}") for i, c in enumerate(sums)])
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    before = whole.select("_range", *by, *[F.coalesce(F.sum(f"_sum{i}").over(earlier), F.lit(0)).alias(f"_sum{i}")
                                          for i in range(len(sums))])
    inside = Window.partitionBy("_range", *by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    own = placed.select("*", *[F.sum(c).over(inside).alias(f"_own{i}") for i, c in enumerate(sums)])
    joined = null_safe_join(own, before, ["_range", *by])
    return joined.select(*df.columns, *[(F.col(f"_own{i}") + F.col(f"_sum{i}")).alias(n) for i, n in enumerate(sums.values())])


def narrow(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One frozen row for each value: the group, ``_c`` (the column's place in ``cols``) and ``_x``."""
    pairs = F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("x")) for i, c in enumerate(cols)])
    rows = df.select(*by, F.explode(pairs).alias("_s"))
    return reliable_checkpoint(rows.select(*by, F.col("_s.c").alias("_c"), F.col("_s.x").alias("_x")))


def quantiles_of(rows: DataFrame, wanted: Sequence[Sequence[float]], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles (linear interpolation) of ``narrow`` rows: the group, ``_c`` and ``_q``, an array in the order of
    ``wanted[_c]``. A group without values has no row."""
    by, rows = list(by), rows.where(F.col("_x").isNotNull())
    margin = 3.0 / ACCURACY
    ps = sorted({p for some in wanted for p in some})
    grid = [min(1.0, max(0.0, p + d)) for p in ps for d in (-margin, margin)]
    stats = rows.groupBy(*by, "_c").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_low"), F.max("_x").alias("_high"),
        F.percentile_approx("_x", F.array(*map(F.lit, grid)), ACCURACY).alias("_grid"))

    def bracket(j: int, p: float) -> Column:
        at = 2 * ps.index(p)
        few = F.col("_n") <= ACCURACY  # the sketch may be a rank off: all values are looked at
        low = F.when(few | F.lit(p <= margin), F.col("_low")).otherwise(F.col("_grid")[at])
        high = F.when(few | F.lit(p >= 1 - margin), F.col("_high")).otherwise(F.col("_grid")[at + 1])
        rank = (F.col("_n") - 1) * F.lit(p)
        return F.struct(F.lit(j).alias("j"), low.alias("low"), high.alias("high"), F.floor(rank).alias("k0"),
                        F.ceil(rank).alias("k1"), (rank - F.floor(rank)).alias("frac"))

    choice = None
    for i, some in enumerate(wanted):
        each = F.array(*[bracket(j, p) for j, p in enumerate(some)])
        choice = F.when(F.col("_c") == i, each) if choice is None else choice.when(F.col("_c") == i, each)
    targets = stats.select(*by, "_c", F.explode(choice).alias("_t"))
    targets = targets.select(*by, "_c", F.col("_t.j").alias("_j"), *[F.col(f"_t.{c}").alias(f"_{c}") for c in ("low", "high", "k0", "k1", "frac")])
    if not by:
        targets = F.broadcast(targets)  # a row for each column and quantile
    near = null_safe_join(rows, targets, [*by, "_c"], "inner").where(F.col("_x") <= F.col("_high"))
    value = F.when(F.col("_x") >= F.col("_low"), F.col("_x"))  # null: below the bracket, first in the order
    counted = near.groupBy(*by, "_c", "_j", "_k0", "_k1", "_frac", value.alias("_v")).agg(F.count(F.lit(1)).alias("_m"))
    ranked = cumulative(counted, F.col("_v").asc_nulls_first(), {"_m": "_to"}, [*by, "_c", "_j"])
    at = lambda k: F.max(F.when((F.col("_to") > F.col(k)) & (F.col("_to") - F.col("_m") <= F.col(k)), F.col("_v")))
    picked = ranked.groupBy(*by, "_c", "_j", "_frac").agg(at("_k0").alias("_a"), at("_k1").alias("_b"))
    lost = F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")
    q = F.when(F.col("_a").isNull() | F.col("_b").isNull(), lost).otherwise(F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_frac"))
    return picked.groupBy(*by, "_c").agg(F.transform(F.array_sort(F.collect_list(F.struct("_j", q.alias("q")))), lambda s: s["q"]).alias("_q"))


def exact_quantiles(df: DataFrame, wanted: dict[str, Sequence[float]], by: Sequence[str] = ()) -> DataFrame:
    """A row for each group (one row without ``by``, also over no rows): an array of exact quantiles for each column."""
    by = list(by)
    found = quantiles_of(narrow(df, list(wanted), by), list(wanted.values()), by)
    return found.groupBy(*by).agg(*[F.max(F.when(F.col("_c") == i, F.col("_q"))).alias(c) for i, c in enumerate(wanted)])


def _kth(keys: DataFrame, target: DataFrame, by: list[str], key: str, cut: str) -> DataFrame:
    """The ``_k``-th smallest ``key`` of each group of ``target`` as ``cut``; ``_k`` becomes its rank among the rows with
    that key, ``_ties`` their number. ``keys`` are the rows in question: those that agree with all earlier cuts."""
    level = target.select("*", F.lit(0).cast("bigint").alias("_prefix"))
    carried = [c for c in target.columns if c != "_k" and c != "_ties"]
    own = [c for c in carried if c not in by]
    for shift in (48, 32, 16, 0):
        rows = null_safe_join(keys, F.broadcast(level) if not by else level, by, "inner")
        for c in own:  # earlier cuts
            rows = rows.where(F.col(c.replace("_cut", "_key")) == F.col(c))
        u = F.col(key).bitwiseXOR(F.lit(_MIN))  # unsigned order
        if shift < 48:
            rows = rows.where(F.shiftrightunsigned(u, shift + 16) == F.col("_prefix"))
        digit = F.shiftrightunsigned(u, shift).bitwiseAND(F.lit(0xFFFF))
        counted = rows.groupBy(*carried, "_k", "_prefix", digit.alias("_digit")).agg(F.count(F.lit(1)).alias("_ties"))
        up = Window.partitionBy(*by).orderBy("_digit").rowsBetween(Window.unboundedPreceding, 0)  # 65,536 rows at most
        summed = counted.select("*", F.sum("_ties").over(up).alias("_to"))
        here = summed.where((F.col("_to") >= F.col("_k")) & (F.col("_to") - F.col("_ties") < F.col("_k")))
        level = here.select(*carried, (F.col("_k") - F.col("_to") + F.col("_ties")).alias("_k"), "_ties",
                            F.shiftleft("_prefix", 16).bitwiseOR(F.col("_digit")).alias("_prefix"))
        level = level.select(*carried, "_k", "_prefix", *(["_ties"] if shift == 0 else []))
    return level.select(*carried, F.col("_prefix").bitwiseXOR(F.lit(_MIN)).alias(cut), "_k", "_ties")


def first_rows(df: DataFrame, take: Column, order: Sequence[Column], out: str, by: Sequence[str] = ()) -> DataFrame:
    """Adds ``out``: whether a row is one of the first ``take`` rows (a Column over ``_n``, the group's rows) of its group
    in the order of the bigint columns ``order``. Rows that agree in all of them stay together, on the far side if not
    all of them fit. Null groups are groups; a null in ``order`` comes last."""
    by, last = list(by), F.lit(2**63 - 1)
    held = df.select("*", *[F.coalesce(o.cast("bigint"), last).alias(f"_key{i}") for i, o in enumerate(order)])
    names = [f"_key{i}" for i in range(len(order))]
    keys = reliable_checkpoint(held.select(*by, *names))
    cuts = keys.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).select(*by, take.cast("bigint").alias("_k")).where("_k > 0")
    for i, name in enumerate(names):
        cuts = reliable_checkpoint(_kth(keys, cuts.drop("_ties"), by, name, f"_cut{i}"))  # a row a group
    before, equal = F.lit(False), F.lit(True)
    for i, name in enumerate(names):
        before = before | (equal & (F.col(name) < F.col(f"_cut{i}")))
        equal = equal & (F.col(name) == F.col(f"_cut{i}"))
    inside = F.coalesce(before | (equal & (F.col("_k") == F.col("_ties"))), F.lit(False))
    if by:
        joined = null_safe_join(held, cuts, by, "left")
    else:
        joined = held.join(F.broadcast(cuts), F.lit(True), "left")  # one row
    return joined.select(*df.columns, inside.alias(out))
