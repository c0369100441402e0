"""Report tables.

Every report is a grouped aggregate (partial aggregation before the
shuffle) or a one-row aggregate broadcast back; nothing is collected.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from .common import null_safe_join, reliable_checkpoint
from .ranks import narrow, quantiles_of

AGE_BUCKETS = ["0-12 months (New)", "13-36 months (Young)", "37-60 months (Middle-aged)", "60+ months (Old)"]
LOAD_RISK_BINS = [0, 20, 40, 60, 80, 101]
LOAD_RISK_LABELS = ["Low (0-20)", "Medium (21-40)", "High (41-60)", "Critical (61-80)", "Emergency (81-100)"]


def value_counts(df: DataFrame, by: str | Sequence[str]) -> DataFrame:
    """Counts per value and percent of all rows (total is a one-row aggregate)."""
    by = [by] if isinstance(by, str) else list(by)
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("count"))
    # the total is aggregated from the grouped table (its shuffle is reused),
    # not from a second pass over the data nor from a one-partition window
    total = counts.agg(F.sum("count").alias("_total"))
    return counts.crossJoin(F.broadcast(total)).select(
        *by, F.col("count").cast("long").alias("count"), (F.col("count") / F.col("_total") * 100.0).alias("pct"))


def risk_stats(df: DataFrame, type_col: str = "Device_Type_Standardized") -> DataFrame:
    """Per type and overall (``rollup``) count, mean, min, max, count and % with risk > 0."""
    r = F.col("risk_score")
    return df.rollup(type_col).agg(
        F.count(F.lit(1)).cast("long").alias("devices"), F.avg(r).alias("risk_mean"),
        F.min(r).alias("risk_min"), F.max(r).alias("risk_max"),
        F.count_if(r > 0).cast("long").alias("risk_positive"),
        (F.count_if(r > 0) / F.count(F.lit(1)) * 100.0).alias("risk_positive_pct"))


def describe(df: DataFrame, c: str, by: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """Count, min, max, mean, median, sample std. The median is exact, or from a sketch."""
    by, x = list(by), F.col("_x")
    rows = narrow(df, [c], by) if exact else df.select(*by, F.col(c).alias("_x"))
    stats = [F.count(x).cast("long").alias("count"), F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"),
             F.stddev_samp(x).alias("std")]
    if not exact:
        return rows.groupBy(*by).agg(*stats[:4], F.percentile_approx(x, 0.5, 10000).alias("median"), stats[4])
    median = quantiles_of(rows, [[0.5]], by).groupBy(*by).agg(F.max(F.col("_q")[0]).alias("median"))
    return null_safe_join(rows.groupBy(*by).agg(*stats), median, by).select(*by, "count", "min", "max", "mean", "median", "std")


def age_bucket(months: Column) -> Column:
    """Left-closed buckets 0/12/36/60/inf months."""
    return (F.when((months >= 0) & (months < 12), AGE_BUCKETS[0]).when((months >= 12) & (months < 36), AGE_BUCKETS[1])
            .when((months >= 36) & (months < 60), AGE_BUCKETS[2]).when(months >= 60, AGE_BUCKETS[3]))


def failure_flag(df: DataFrame) -> Column:
    """Failure criterion of the age analysis: risk > 80, battery low, overheat or comm failures."""
    cff = F.col("comm_fail_frequency") if "comm_fail_frequency" in df.columns else F.lit(0.0)
    return X.flag((F.col("risk_score") > 80) | (F.col("battery_low_flag") == 1) | (F.col("overheat_flag") == 1)
                  | (cff > 0.5))


def age_frame(df: DataFrame) -> DataFrame:
    """Rows with a positive age, their bucket and failure flag (A18/A19 input)."""
    m = F.col("device_age_months")
    cff = F.col("comm_fail_frequency") if "comm_fail_frequency" in df.columns else F.lit(0.0)
    return df.where(m.isNotNull() & (m > 0)).select("*", age_bucket(m).alias("age_bucket"),
                                                       failure_flag(df).alias("is_failure"), cff.alias("_cff"))


def failure_by_age(df: DataFrame) -> DataFrame:
    """Devices, failures, failure %, mean risk, mean battery, comm-fail % per bucket."""
    a = age_frame(df)
    return a.groupBy("age_bucket").agg(
        F.count(F.lit(1)).cast("long").alias("total_devices"), F.sum("is_failure").cast("long").alias("failed_devices"),
        (F.sum("is_failure") / F.count(F.lit(1)) * 100.0).alias("failure_rate"),
        F.avg("risk_score").alias("avg_risk_score"), F.avg("battery_level").alias("avg_battery_level"),
        (F.avg((F.col("_cff") > 0).cast("double")) * 100.0).alias("comm_fail_rate"))


def binned_mean(df: DataFrame, x: str, ys: Sequence[str], n: int = 20) -> DataFrame:
    """Equal-width bins of ``x`` (right-closed, first bin closed) and mean of ``ys`` per bin."""
    rng = df.agg(F.min(x).alias("_mn"), F.max(x).alias("_mx"))
    d = df.where(F.col(x).isNotNull()).crossJoin(F.broadcast(rng))
    w = (F.col("_mx") - F.col("_mn")) / n
    idx = F.when(w == 0, F.lit(0)).otherwise(
        F.greatest(F.lit(0), F.least(F.lit(n - 1), (F.ceil((F.col(x) - F.col("_mn")) / w) - 1).cast("int"))))
    d = d.select("*", idx.alias("bin"), w.alias("_w"))
    return d.groupBy("bin").agg(
        (F.first("_mn") + (F.col("bin") + 0.5) * F.first("_w")).alias("bin_center"),
        F.count(F.lit(1)).cast("long").alias("n"), *[F.avg(y).alias(f"mean_{y}") for y in ys])


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair in one aggregate (long format)."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    stack = F.explode(F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"{a}__{b}").alias("corr"))
                                for a, b in pairs]))
    return row.select(stack.alias("p")).select("p.*")


def histogram(df: DataFrame, c: str, n: int = 20) -> DataFrame:
    """Equal-width histogram (last bin closed) with cumulative share (ECDF at bin edges)."""
    # frozen (one narrow column): the range and the bins read it, and the null filter is not moved under the column's sources
    x = F.col("_x")
    rows = reliable_checkpoint(df.select(F.col(c).alias("_x")))
    rng = rows.agg(F.min(x).alias("_mn"), F.max(x).alias("_mx"))
    d = rows.where(x.isNotNull()).crossJoin(F.broadcast(rng))
    w = (F.col("_mx") - F.col("_mn")) / n
    idx = F.when(w == 0, F.lit(0)).otherwise(
        F.least(F.lit(n - 1), F.floor((x - F.col("_mn")) / w).cast("int")))
    h = d.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"), F.first("_mn").alias("_mn"),
                                        F.first(w).alias("_w"))
    tot = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)  # <= n rows
    allw = Window.partitionBy(F.lit(1))
    return h.select("bin", (F.col("_mn") + F.col("bin") * F.col("_w")).alias("bin_start"),
                    (F.col("_mn") + (F.col("bin") + 1) * F.col("_w")).alias("bin_end"),
                    F.col("count").cast("long").alias("count"),
                    (F.sum("count").over(tot) / F.sum("count").over(allw)).alias("ecdf"))


def five_numbers(df: DataFrame, by: str, c: str, exact: bool = True) -> DataFrame:
    """Min, q1, median, q3, max per group (exact linear interpolation, or a sketch)."""
    ps = (0.0, 0.25, 0.5, 0.75, 1.0)
    if exact:
        g = quantiles_of(narrow(df, [c], [by]), [ps], [by])
    else:
        g = df.where(F.col(c).isNotNull()).groupBy(by).agg(F.percentile_approx(c, F.array(*map(F.lit, ps)), 10000).alias("_q"))
    return g.select(by, *[F.col("_q")[i].alias(n) for i, n in enumerate(("min", "q1", "median", "q3", "max"))])


def flag_counts(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows with a non-zero value per flag column (one aggregate, long format)."""
    present = [f for f in flags if f in df.columns]
    row = df.agg(*[F.count_if(F.coalesce(F.col(f), F.lit(0)) != 0).cast("long").alias(f) for f in present])
    stack = F.explode(F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f).alias("nonzero")) for f in present]))
    return row.select(stack.alias("p")).select("p.*")


def variance_frequency(df: DataFrame, key: str = "Serial") -> DataFrame:
    """Real per-device variance and frequency features (reference ships zeros)."""
    return df.groupBy(key).agg(
        F.var_samp("LineCurrent_val").alias("current_variance"),
        F.var_samp("LineTemperature_val").alias("temp_variance"),
        F.avg("zero_current_flag").alias("zero_current_frequency"),
        F.avg("overheat_flag").alias("overheat_frequency"),
        F.avg((F.col("comm_age_days") > 1).cast("double")).alias("comm_fail_frequency"),
        F.avg("gps_jump_flag").alias("gps_jump_frequency"))


def risk_category_report(df: DataFrame) -> DataFrame:
    """Devices and % per load-test risk bin (bins start at 0, so 0 drops), plus > 60 and > 80."""
    r = F.col("risk_score")
    # plain columns above the score's own projection: it is worked out once a row, in compiled code
    c = df.select(X.cut(r, LOAD_RISK_BINS, LOAD_RISK_LABELS).alias("risk_category"), (r > 60).cast("int").alias("_gt"),
                  (r > 80).cast("int").alias("_gt2"))
    # one pass: group by category (null = outside the bins) and total over the <= 6 groups. The null group is dropped
    # above the totals: below them Spark moves the filter under the score, and the rows are read and scored twice
    g = c.groupBy("risk_category").agg(F.count(F.lit(1)).alias("devices"), F.sum("_gt").alias("gt60"),
                                       F.sum("_gt2").alias("gt80"))
    every = Window.partitionBy(F.lit(1))
    g = g.select("risk_category", "devices", F.sum("devices").over(every).alias("_n"),
                 F.sum("gt60").over(every).alias("_gt60"), F.sum("gt80").over(every).alias("_gt80"))
    g = g.where(F.col("risk_category").isNotNull())
    return g.select(
        "risk_category", F.col("devices").cast("long").alias("devices"),
        (F.col("devices") / F.col("_n") * 100.0).alias("pct"),
        F.col("_gt60").cast("long").alias("devices_over_60"), F.col("_gt80").cast("long").alias("devices_over_80"),
        (F.col("_gt60") / F.col("_n") * 100.0).alias("pct_over_60"),
        (F.col("_gt80") / F.col("_n") * 100.0).alias("pct_over_80"))


def top_risk_view(df: DataFrame, n: int = 5, width: int = 60, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Top-n risky rows with the reason cut to ``width`` characters."""
    from .health import get_top_risk_devices
    top = get_top_risk_devices(df, n, tiebreak)
    reason = F.col("risk_reason")
    short = F.when(F.length(reason) > width, F.concat(F.substring(reason, 1, width), F.lit("..."))).otherwise(reason)
    return top.select("Serial", *tiebreak, "Device_Type", "risk_score", short.alias("risk_reason_short"))


def sample_n(df: DataFrame, n: int, seed: int, key: str = "Serial") -> DataFrame:
    """Reproducible sample of n rows: order by a seeded hash of the key (TakeOrdered)."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")))
    return df.orderBy(h, F.col(key)).limit(n)
