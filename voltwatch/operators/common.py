"""Shared relational building blocks: null-safe joins, skew-safe lag, dedupe."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Eager checkpoint into the session's ``spark.checkpoint.dir`` (a shared
    folder on a cluster); a scratch folder is only chosen in local mode when
    nothing is configured.  Never ``localCheckpoint``: executors may be lost."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` with null == null (batch keys may be null), keeping one copy of each key."""
    keys = list(keys)
    if not keys:
        return left.crossJoin(right)
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"__r_{k}"])
        cond = c if cond is None else cond & c
    out = left.join(renamed, cond, how)
    return out.drop(*[f"__r_{k}" for k in keys])


def attach_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join a per-group statistics table back to rows, lazily.

    Group keys may be null (a file without a date is still one batch), so the
    join is null-safe.  Spark picks the join from the size of the aggregate.
    """
    return null_safe_join(df, stats, keys, "left")


def two_level_lag(df: DataFrame, key: str | Sequence[str], bucket: Column, order: Sequence[Column],
                  cols: Sequence[str], prefix: str = "prev_", skip_null: Sequence[str] = ()) -> DataFrame:
    """``lag(c, 1)`` per ``key`` in ``order`` without putting one key in one task.

    Rows are windowed by (key, bucket) -- e.g. (device, hour) -- so a hot key
    is spread over many tasks.  The first row of each bucket takes the last
    row of the key's previous non-empty bucket, found on a pre-aggregated
    table of one row per (key, bucket).  Keys are replaced by non-null
    surrogates (value + is-null flag) before the window, so the window's hash
    partitioning already satisfies the join and the rows are shuffled once.

    A row with a null in ``skip_null`` belongs to no key: it has no previous
    row and is nobody's previous row, and such rows are spread by a hash.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if skip_null:
        lost = F.greatest(*[F.col(k).isNull() for k in skip_null], F.lit(False))
        bucket = F.when(lost, F.pmod(F.xxhash64(*order), F.lit(1 << 20))).otherwise(bucket)
    dtypes = dict(df.dtypes)
    sur = []
    for i, k in enumerate(keys):
        t = dtypes[k]
        zero = (F.lit("") if t == "string" else F.lit(False) if t == "boolean"
                else F.to_date(F.lit("1970-01-01")) if t == "date"
                else F.lit("1970-01-01 00:00:00").cast(t) if t.startswith("timestamp") else F.lit(0).cast(t))
        sur += [F.coalesce(F.col(k), zero).alias(f"__kv{i}"), F.col(k).isNull().alias(f"__kn{i}")]
    knames = [f"__kv{i}" for i in range(len(keys))] + [f"__kn{i}" for i in range(len(keys))]
    b = "__bucket"
    rn = "__rn"
    d = df.select("*", *sur, bucket.alias(b))
    w = Window.partitionBy(*knames, b).orderBy(*order)
    lagged = d.select("*", *[F.lag(c, 1).over(w).alias(f"{prefix}{c}") for c in cols],
                      F.row_number().over(w).alias(rn))
    # last row of every (key, bucket): partial aggregation, no full group in one task
    ord_struct = F.struct(*order)
    last = (d.groupBy(*knames, b)
            .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), ord_struct).alias("__last")))
    wb = Window.partitionBy(*knames).orderBy(b)
    prev_bucket = last.select(*knames, b, F.lag("__last", 1).over(wb).alias("__pb"))
    out = lagged.join(prev_bucket, knames + [b], "left")
    fixed = [F.when(F.col(rn) == 1, F.col("__pb")[c]).otherwise(F.col(f"{prefix}{c}")).alias(f"{prefix}{c}")
             for c in cols]
    if skip_null:
        fixed = [F.when(~lost, c).alias(f"{prefix}{name}") for c, name in zip(fixed, cols)]
    keep = [c for c in df.columns if c not in {f"{prefix}{c}" for c in cols}]
    return out.select(*keep, *fixed)


def dedupe_keep(df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: str = "last") -> DataFrame:
    """Keep the first/last row per key by an explicit total order.

    Implemented as ``max_by/min_by`` of the whole row, which Spark aggregates
    partially on the map side, so a hot key never gathers in one task.
    """
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in others])
    ord_struct = F.struct(*order)
    agg = F.max_by(row, ord_struct) if keep == "last" else F.min_by(row, ord_struct)
    return df.groupBy(*keys).agg(agg.alias("__row")).select(*keys, "__row.*")
