"""Categorical and scalar business functions.

``np.where`` chains send missing values to the last branch; ``pd.cut`` bins
are right-closed and values outside the edges become null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exprs import col, cut, py_fixed

ColumnOrName = Column | str


def _t(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def battery_status(c: ColumnOrName) -> Column:
    """<10 CRITICAL, <20 Warning, <30 Low, <50 Moderate, else Good (missing -> Good)."""
    c = col(c)
    return (F.when(_t(c < 10), "CRITICAL").when(_t(c < 20), "Warning").when(_t(c < 30), "Low")
            .when(_t(c < 50), "Moderate").otherwise("Good"))


# fixed values: bin edges and labels of the export categories
BATTERY_BINS = [-1, 0, 10, 20, 30, 50, 80, 101]
BATTERY_LABELS = ["Dead (0%)", "Critical (1-10%)", "Very Low (11-20%)", "Low (21-30%)", "Moderate (31-50%)",
                  "Good (51-80%)", "Excellent (81-100%)"]
RISK_BINS = [-1, 20, 40, 60, 80, 101]
RISK_LABELS = ["Low (0-20)", "Medium (21-40)", "High (41-60)", "Critical (61-80)", "Emergency (81-100)"]
AGE_BINS = [-1, 0.5, 1, 2, 3, 5, 10, 100]
AGE_LABELS = ["<6 months", "6-12 months", "1-2 years", "2-3 years", "3-5 years", "5-10 years", "10+ years"]
DRAIN_BINS = [-1, 0.1, 5.0, 10.0, 20.0, 50.0, 100]
DRAIN_LABELS = ["No Drain", "Very Slow", "Normal", "Slightly Fast", "Fast", "Very Fast"]


def battery_category(c: ColumnOrName) -> Column:
    """Battery level category, missing -> 0 -> Dead."""
    return cut(F.coalesce(col(c), F.lit(0.0)), BATTERY_BINS, BATTERY_LABELS)


def replacement_timeline(days: ColumnOrName) -> dict[str, Column]:
    """Timeline text and 30 d / 90 d / 1 yr flags."""
    d = col(days)
    txt = (F.when(_t(d < 7), "EMERGENCY (<1 week)").when(_t(d < 30), "Critical (<1 month)")
           .when(_t(d < 90), "Urgent (1-3 months)").when(_t(d < 180), "Soon (3-6 months)")
           .when(_t(d < 365), "Near (6-12 months)").otherwise("Future (>1 year)"))
    return {"replacement_timeline": txt, "needs_replacement_30d": _t(d < 30), "needs_replacement_90d": _t(d < 90),
            "needs_replacement_1yr": _t(d < 365)}


def risk_category(risk: ColumnOrName) -> dict[str, Column]:
    """C4: risk bins, high > 60, critical > 80."""
    r = col(risk)
    return {"risk_category": cut(F.coalesce(r, F.lit(0.0)), RISK_BINS, RISK_LABELS),
            "is_high_risk": _t(r > 60), "is_critical_risk": _t(r > 80)}


def age_category(years: ColumnOrName) -> Column:
    """Age category of (observed or install) years."""
    return cut(F.coalesce(col(years), F.lit(0.0)), AGE_BINS, AGE_LABELS)


def drain_category(rate_per_year: ColumnOrName) -> dict[str, Column]:
    """Yearly drain bins; normal <= 15 %/yr, fast > 15 %/yr."""
    r = col(rate_per_year)
    return {"drain_rate_category": cut(F.coalesce(r, F.lit(0.0)), DRAIN_BINS, DRAIN_LABELS),
            "is_normal_drain": _t(r <= 15.0), "is_fast_drain": _t(r > 15.0)}


def critical_flag(battery: ColumnOrName | None, days: ColumnOrName | None, risk: ColumnOrName | None) -> Column:
    """Any available of battery < 20, due < 30 days, risk > 80."""
    conds = []
    if battery is not None:
        conds.append(_t(col(battery) < 20))
    if days is not None:
        conds.append(_t(col(days) < 30))
    if risk is not None:
        conds.append(_t(col(risk) > 80))
    out = F.lit(False)
    for c in conds:
        out = out | c
    return out


def ttl(is_zm1: Column, battery: ColumnOrName, drain_per_day: ColumnOrName | None) -> dict[str, Column]:
    """Battery / max(drain, 0.001) for ZM1 with a reading; months, years, category.

    With a drain column, a device without a drain has no days, and its category
    is the last one, as no limit is below; callers of a frame without any drain
    pass None for the default rate."""
    b = col(battery)
    d = F.lit(0.027) if drain_per_day is None else col(drain_per_day)
    d = F.when(d < 0.001, F.lit(0.001)).otherwise(d)
    ok = is_zm1 & b.isNotNull()
    days = F.when(ok, b / d)
    cat = (F.when(~ok, "Unknown").when(days < 30, "Critical (<1 month)").when(days < 90, "Urgent (1-3 months)")
           .when(days < 180, "Soon (3-6 months)").when(days < 365, "Near (6-12 months)").otherwise("Future (>1 year)"))
    return {"ttl_days": days, "ttl_months": days / 30.44, "ttl_years": days / 365.0, "ttl_category": cat}


def replacement_dates(days: ColumnOrName, as_of: str) -> dict[str, Column]:
    """C11: as_of + min(days, 3650) for positive days; date, quarter, year, month."""
    d = col(days)
    ok = d.isNotNull() & (d > 0)
    micros = F.unix_micros(F.to_timestamp(F.lit(as_of))) + (F.least(d, F.lit(3650.0)) * 86400e6).cast("long")
    ts = F.when(ok, F.timestamp_micros(micros))
    return {"estimated_replacement_date": F.date_format(ts, "yyyy-MM-dd"),
            "replacement_quarter": F.when(ok, F.format_string("Q%d-%d", F.quarter(ts), F.year(ts))),
            "replacement_year": F.year(ts),
            "replacement_month": F.date_format(ts, "yyyy-MM")}


def alert_level(risk: ColumnOrName, serial: ColumnOrName = "Serial", reason: ColumnOrName = "risk_reason"
                ) -> dict[str, Column]:
    """C13 (documented alert tree): [80,100] Critical, [50,80) High, [20,50) Medium,
    (0,20) Low, 0 OK; message "Device S: Level Risk (x.y) — reason"."""
    r = col(risk)
    level = (F.when(r >= 80, "Critical").when(r >= 50, "High").when(r >= 20, "Medium").when(r > 0, "Low")
             .when(r == 0, "OK"))
    description = (F.when(r >= 80, "Immediate field inspection").when(r >= 50, "Investigate soon")
                   .when(r >= 20, "Monitoring needed").when(r > 0, "Normal").when(r == 0, "Healthy"))
    colour = (F.when(r >= 80, "red").when(r >= 50, "orange").when(r >= 20, "yellow").when(r >= 0, "green"))
    message = F.concat(F.lit("Device "), col(serial).cast("string"), F.lit(": "), level, F.lit(" Risk ("),
                       py_fixed(r, 1), F.lit(") \u2014 "), col(reason))
    return {"alert_level": level, "alert_description": description, "needs_inspection": _t(r >= 50),
            "alert_message": message, "powerbi_severity_color": colour}


def throughput_rating(rps: ColumnOrName) -> Column:
    """C14: > 5000 excellent, > 2000 good, > 1000 acceptable, else needs work."""
    r = col(rps)
    return (F.when(r > 5000, "EXCELLENT").when(r > 2000, "GOOD").when(r > 1000, "ACCEPTABLE")
            .otherwise("NEEDS IMPROVEMENT"))
