"""Column helpers: coercion, clipping, rounding, formatting, geometry.

Everything returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config

ColumnOrName = Column | str

# Timestamp layouts tried in order by ``to_ts`` (ISO first).
TS_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy H:mm",
    "M/d/yyyy",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd",
)

MICROS_PER_DAY = 86400.0 * 1e6


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_double(v) -> Column:
    return F.lit(v).cast("double")


# ---------------------------------------------------------------- coercion --

def nan_to_null(c: ColumnOrName) -> Column:
    c = col(c)
    return F.when(~F.isnan(c), c)


def to_num(c: ColumnOrName) -> Column:
    """Numeric coercion, bad values become null and NaN never survives."""
    out = _try_double(F.trim(col(c).cast("string")))
    return F.when(~F.isnan(out), out)


def _try_double(c: Column) -> Column:
    return c.try_cast("double")


def to_num_tokens(c: ColumnOrName) -> Column:
    """Numeric coercion that strips thousands commas (P5); tokens fail the cast."""
    s = F.regexp_replace(F.trim(col(c).cast("string")), ",", "")
    out = _try_double(s)
    return F.when(~F.isnan(out), out)


def sanitize_num(c: ColumnOrName) -> Column:
    """Keep digits, dot and minus only, then cast ("85%" -> 85, "N/A" -> null)."""
    s = F.regexp_replace(col(c).cast("string"), r"[^0-9.\-]", "")
    out = _try_double(F.when(s != "", s))
    return F.when(~F.isnan(out), out)


def to_ts(c: ColumnOrName, formats: Sequence[str] = TS_FORMATS) -> Column:
    """Timestamp coercion over several layouts, bad values become null."""
    s = F.trim(col(c).cast("string"))
    parsed = [F.try_to_timestamp(s, F.lit(f)) for f in formats]
    return F.coalesce(*parsed).cast("timestamp")


def to_ts_any(c: Column, dtype: str) -> Column:
    """Pass timestamps through, parse strings, promote dates."""
    if dtype in ("timestamp", "timestamp_ntz", "date"):
        return c.cast("timestamp")
    return to_ts(c)


def is_missing_raw(c: ColumnOrName, dtype: str = "string") -> Column:
    """True when a raw value would be read as missing by a pandas CSV reader."""
    c = col(c)
    if dtype != "string":
        if dtype in ("double", "float"):
            return c.isNull() | F.isnan(c)
        return c.isNull()
    return c.isNull() | F.trim(c).isin(*config.MISSING_TOKENS)


# -------------------------------------------------------- clip / clamp / cut --

def clip(c: ColumnOrName, lo: float | None = None, hi: float | None = None) -> Column:
    """pandas ``clip``: bounds apply, null stays null."""
    c = col(c)
    out = c
    if hi is not None:
        out = F.when(out > hi, F.lit(hi).cast("double")).otherwise(out)
    if lo is not None:
        out = F.when(out < lo, F.lit(lo).cast("double")).otherwise(out)
    return out


def clamp_missing_high(c: ColumnOrName, lo: float = 0.0, hi: float = 100.0) -> Column:
    """``max(lo, min(hi, x))`` with Python float semantics: NaN/missing -> hi."""
    c = col(c)
    return F.when(c.isNull(), F.lit(hi).cast("double")).otherwise(
        F.when(c > hi, F.lit(hi).cast("double")).when(c < lo, F.lit(lo).cast("double")).otherwise(c))


def cut(c: ColumnOrName, edges: Sequence[float], labels: Sequence[str], right: bool = True) -> Column:
    """``pd.cut``: right-closed bins by default; outside -> null."""
    c = col(c)
    assert len(labels) == len(edges) - 1
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c > lo) & (c <= hi) if right else (c >= lo) & (c < hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def finite(c: ColumnOrName) -> Column:
    """Turn +-inf (and NaN) into null."""
    c = col(c)
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 int where unknown counts as 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


# ------------------------------------------------------------------ rounding --

def np_round(c: ColumnOrName, n: int = 0) -> Column:
    """numpy/pandas ``round``: scale, round half to even, unscale (P25)."""
    scale = float(10 ** n)
    c = col(c)
    if n == 0:
        return F.rint(c)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def _exact_half_even(c: Column, n: int) -> Column:
    """Integer q = round-half-even(exact(c) * 10**n) using an exact product.

    Python formats the exact binary value.  p = c*m may be rounded; Dekker's
    split gives the exact error e with c*m = p + e, and only when p is exactly
    a half-integer can e change the result.
    """
    m = float(10 ** n)
    p = c * F.lit(m)
    split = F.lit(134217729.0)  # 2**27 + 1, Veltkamp split constant
    t = c * split
    hi = t - (t - c)
    lo = c - hi
    err = (hi * F.lit(m) - p) + lo * F.lit(m)
    fl = F.floor(p).cast("double")
    is_half = (p - fl) == F.lit(0.5)
    return (F.when(is_half & (err > 0), fl + 1.0)
            .when(is_half & (err < 0), fl)
            .otherwise(F.rint(p)))


def py_fixed(c: ColumnOrName, n: int = 0) -> Column:
    """Python ``format(x, f".{n}f")`` for finite doubles; null stays null."""
    c = col(c).cast("double")
    q = F.abs(_exact_half_even(c, n))
    txt = F.format_string(f"%.{n}f", q if n == 0 else q / F.lit(float(10 ** n)))
    return F.when(c.isNull(), F.lit(None).cast("string")).when(c < 0, F.concat(F.lit("-"), txt)).otherwise(txt)


# --------------------------------------------------------------- time / geo --

def days_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Fractional days ``(later - earlier).total_seconds() / 86400``."""
    return (F.unix_micros(col(later)) - F.unix_micros(col(earlier))).cast("double") / F.lit(MICROS_PER_DAY)


def whole_days(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Timedelta ``.days``: floor of elapsed days, not calendar boundaries (T5)."""
    return F.floor(days_between(later, earlier)).cast("long")


def haversine(lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName,
              radius: float = config.EARTH_RADIUS_M) -> Column:
    """Great-circle distance in metres."""
    p1, l1, p2, l2 = (F.radians(col(x)) for x in (lat1, lon1, lat2, lon2))
    a = F.pow(F.sin((p2 - p1) / 2.0), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin((l2 - l1) / 2.0), 2)
    return F.lit(2.0 * radius) * F.asin(F.sqrt(a))


# ----------------------------------------------------------- device types ---

def device_type_a(c: ColumnOrName) -> Column:
    """Canonical type A (P8): null tokens -> null, M3 -> MM3, UM3 -> UM3+, else contains."""
    s = F.upper(F.trim(col(c).cast("string")))
    compact = F.translate(s, " -_/", "")
    return (F.when(s.isNull() | s.isin("", "NONE", "NAN", "NULL"), F.lit(None).cast("string"))
            .when(s == "M3", F.lit("MM3"))
            .when(s == "UM3", F.lit("UM3+"))
            .when(compact.contains("ZM1"), F.lit("ZM1"))
            .when(compact.contains("MM3") | (compact == "M3"), F.lit("MM3"))
            .when(compact.contains("UM3"), F.lit("UM3+"))
            .otherwise(s))


def device_type_upper(c: ColumnOrName) -> Column:
    """``astype(str).str.strip().str.upper()`` where missing reads as 'NAN'."""
    return F.coalesce(F.upper(F.trim(col(c).cast("string"))), F.lit("NAN"))


def device_type_b(c: ColumnOrName, other: str | None = None) -> Column:
    """Standard type B (P9): contains ZM1 / UM3 / MM3, else raw (or ``other``)."""
    s = F.upper(col(c).cast("string"))
    fallback = s if other is None else F.lit(other)
    return (F.when(s.contains("ZM1"), F.lit("ZM1"))
            .when(s.contains("UM3"), F.lit("UM3"))
            .when(s.contains("MM3"), F.lit("MM3"))
            .otherwise(fallback))


def expected_lifetime(c: ColumnOrName) -> Column:
    """Design lifetime in days by (standardised) type (P10)."""
    s = F.upper(col(c).cast("string"))
    lt = config.DEVICE_LIFETIME_DAYS
    return (F.when(s.contains("ZM1"), F.lit(lt["ZM1"]))
            .when(s.contains("UM3") | s.contains("U-M3") | s.contains("U M3"), F.lit(lt["UM3"]))
            .when(s.contains("MM3") | s.contains("M-M3") | s.contains("M M3"), F.lit(lt["MM3"]))
            .otherwise(F.lit(config.DEFAULT_LIFETIME_DAYS))).cast("long")


def first_present(columns: Iterable[str], names: Sequence[str]) -> str | None:
    """First existing column from candidates (P1); plan-time."""
    cols = list(columns)
    for n in names:
        if n in cols:
            return n
    return None


def find_col(columns: Iterable[str], names: Sequence[str], exclude: Sequence[str] = ()) -> str | None:
    """Case-insensitive substring lookup, candidate order then column order."""
    cols = [c for c in columns if c not in exclude]
    for n in names:
        for c in cols:
            if n.lower() in c.lower():
                return c
    return None
