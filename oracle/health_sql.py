"""DuckDB oracle for the health-feature router."""

from __future__ import annotations

from .adapter import CTES, clip, days_between, flag, np_round, py_fixed, r6

RAD = "0.017453292519943295"


def _hav(lat1, lon1, lat2, lon2):
    p1, l1, p2, l2 = (f"({x} * {RAD})" for x in (lat1, lon1, lat2, lon2))
    a = f"(pow(sin(({p2} - {p1}) / 2.0), 2) + cos({p1}) * cos({p2}) * pow(sin(({l2} - {l1}) / 2.0), 2))"
    return f"(CAST(12742000.0 AS DOUBLE) * asin(sqrt({a})))"


def _norm(x, cap, key):
    c = x if cap is None else clip(x, hi=cap)
    return (f"(CASE WHEN mn_{key} IS NULL OR mx_{key} IS NULL OR mx_{key} = mn_{key} THEN 0.0 "
            f"ELSE ({c} - mn_{key}) / (mx_{key} - mn_{key}) END)")


NORM = {"comm": ("comm", 365.0), "report": ("report", 180.0), "life": ("life", 1.0), "aabr": ("aabr", 100.0),
        "urgency": ("urg", 1.0), "current": ("cur", 1000.0), "temp": ("temp", 100.0), "flags": ("fsum", None)}


def health_ctes(batch: bool, scope: str = "batch", source: str = "readings", pre: str = "",
                per_day: str = "0.0") -> str:
    """CTE chain ending in ``hf`` (one row per reading, all features).

    ``source`` names the CTE with reading rows; ``pre`` adds CTEs defined
    between the adapter and the scorer (e.g. a deduped source); ``per_day`` is
    the battery drain of a ZM1 row.
    """
    bk = "batch_date, " if batch else ""
    bjoin_st = "st.batch_date = r.batch_date AND " if batch else ""
    bjoin_sb = "ON sb.batch_date = r.batch_date" if batch else "ON TRUE"
    bjoin_s2 = "s2.batch_date = g.batch_date AND " if batch else ""
    stats = ", ".join(
        f"min({clip(c, hi=cap) if cap else c}) AS mn_{k}, max({clip(c, hi=cap) if cap else c}) AS mx_{k}"
        for k, (c, cap) in NORM.items())
    comm_txt = py_fixed("comm1", 0)
    snap = "sb.snap_b" if scope == "batch" else "st.snap_bt"
    never = "consider replacement after 48 hours if no improvement"
    return f"""
readings AS ({CTES['readings']}),
install AS ({CTES['install']}),
attempts AS ({CTES['attempts']}),{pre}
r AS (
  SELECT *, upper(trim(Device_Type)) AS dev,
         CASE WHEN upper(trim(Device_Type)) LIKE '%ZM1%' THEN 'ZM1'
              WHEN upper(trim(Device_Type)) LIKE '%UM3%' THEN 'UM3'
              WHEN upper(trim(Device_Type)) LIKE '%MM3%' THEN 'MM3'
              ELSE upper(trim(Device_Type)) END AS t,
         Last_Heard AS lh
  FROM {source}),
snap_bt AS (SELECT {bk}t, max(lh) AS snap_bt FROM r GROUP BY ALL),
snap_b AS (SELECT {bk}max(snap_bt) AS snap_b FROM snap_bt {'GROUP BY batch_date' if batch else ''}),
inst AS (SELECT Serial, max(InstallDate) AS inst FROM install GROUP BY Serial),
rcount AS (SELECT Serial, CAST(count(*) AS INTEGER) AS rc FROM attempts GROUP BY Serial),
a AS (
  SELECT r.*, sb.snap_b, st.snap_bt, i.inst,
         {clip(days_between(snap, 'r.lh'), hi=365.0)} AS comm,
         {days_between(snap, 'i.inst')} AS age_days
  FROM r JOIN snap_bt st ON {bjoin_st}st.t = r.t
         JOIN snap_b sb {bjoin_sb}
         LEFT JOIN inst i ON i.Serial = r.Serial),
b AS (
  SELECT *,
    {clip(f"coalesce({clip('age_days / 3650.0', 0.0, 1.0)}, 0.0)", hi=1.0)} AS life,
    CASE WHEN t = 'ZM1' THEN BatteryLevel END AS battery_level,
    CASE WHEN t = 'ZM1' THEN {flag('BatteryLevel < 20')} ELSE 0 END AS battery_low_flag,
    CASE WHEN t = 'ZM1' THEN {flag('BatteryLevel < 30')} ELSE 0 END AS battery_warning_flag,
    CASE WHEN t = 'ZM1' THEN coalesce({days_between('snap_bt', 'BatteryLatestReport')}, 0.0) ELSE 0.0 END AS report,
    CASE WHEN t = 'ZM1' THEN coalesce(age_days / 30.44, 0.0) ELSE 0.0 END AS months,
    CASE WHEN t = 'ZM1' THEN {clip(f'({per_day}) * 365.0', lo=0.1)} ELSE 0.0 END AS rate,
    CASE WHEN t = 'MM3' THEN {clip('coalesce(LineCurrent, 0.0)', hi=1000.0)} ELSE 0.0 END AS cur,
    CASE WHEN t = 'MM3' THEN {clip('coalesce(LineTemperature, 0.0)', hi=100.0)} ELSE 0.0 END AS temp
  FROM a),
c AS (
  SELECT *,
    CASE WHEN t = 'MM3' THEN {flag('cur = 0.0')} ELSE 0 END AS zero_current_flag,
    CASE WHEN t = 'MM3' THEN {flag('cur > 0 AND cur < 1.0')} ELSE 0 END AS low_current_flag,
    CASE WHEN t = 'MM3' THEN {flag('cur > 700.0')} ELSE 0 END AS high_current_flag,
    CASE WHEN t = 'MM3' THEN {flag('cur > 850.0')} ELSE 0 END AS critical_current_flag,
    CASE WHEN t = 'MM3' THEN {flag('cur > 12.0')} ELSE 0 END AS high_offpeak_flag,
    CASE WHEN t = 'MM3' THEN {flag('temp > 85.0')} ELSE 0 END AS overheat_flag,
    CASE WHEN t = 'ZM1' THEN {clip('coalesce(rate * (months / 24.0), 0.0)', hi=100.0)} ELSE 0.0 END AS aabr,
    CASE WHEN t = 'ZM1' THEN {np_round(clip(f"{clip('coalesce(months / 120.0, 0.0)', hi=1.0)} * 0.4 + {clip('rate / 20.0', hi=1.0)} * 0.6", hi=1.0), 3)}
         ELSE 0.0 END AS urg
  FROM b),
g AS (
  SELECT *, CAST(high_current_flag + critical_current_flag + overheat_flag AS DOUBLE) AS fsum,
    lag(Latitude) OVER (PARTITION BY {bk}Serial ORDER BY lh ASC NULLS LAST, reading_id) AS prev_lat,
    lag(Longitude) OVER (PARTITION BY {bk}Serial ORDER BY lh ASC NULLS LAST, reading_id) AS prev_lon
  FROM c),
s2 AS (SELECT {bk}t, {stats} FROM g GROUP BY ALL),
h AS (
  SELECT g.*, {', '.join(f's2.mn_{k}, s2.mx_{k}' for k in NORM)},
    CASE WHEN prev_lat IS NULL OR prev_lon IS NULL THEN 0.0
         ELSE {_hav('prev_lat', 'prev_lon', 'Latitude', 'Longitude')} END AS distance_drift_m,
    coalesce(rc.rc, 0) AS reconfigure_count
  FROM g JOIN s2 ON {bjoin_s2}s2.t = g.t LEFT JOIN rcount rc ON rc.Serial = g.Serial),
sc AS (
  SELECT *, {flag('distance_drift_m > 30.0')} AS gps_jump_flag,
    (({_norm('comm', 365.0, 'comm')} * 0.25 + {_norm('report', 180.0, 'report')} * 0.25
      + {_norm('life', 1.0, 'life')} * 0.20 + {_norm('aabr', 100.0, 'aabr')} * 0.20
      + {_norm('urg', 1.0, 'urgency')} * 0.10) * 100.0
      + battery_low_flag * 30.0 + (CASE WHEN life > 0.9 THEN 20.0 ELSE 0.0 END)
      + (CASE WHEN report > 180 THEN 15.0 ELSE 0.0 END)
      + (CASE WHEN lh IS NULL THEN 30.0 ELSE 0.0 END) + (CASE WHEN inst IS NULL THEN 25.0 ELSE 0.0 END)
      + (CASE WHEN BatteryLevel IS NULL THEN 20.0 ELSE 0.0 END)) AS z_raw,
    (({_norm('comm', 365.0, 'comm')} * 0.70 + {_norm('life', 1.0, 'life')} * 0.30) * 100.0
      + (CASE WHEN life > 0.9 THEN 25.0 ELSE 0.0 END) + (CASE WHEN comm > 7 THEN 20.0 ELSE 0.0 END)
      + (CASE WHEN comm > 30 THEN 40.0 ELSE 0.0 END)
      + (CASE WHEN lh IS NULL THEN 50.0 ELSE 0.0 END) + (CASE WHEN inst IS NULL THEN 20.0 ELSE 0.0 END)) AS u_raw,
    (({_norm('comm', 365.0, 'comm')} * 0.30 + {_norm('cur', 1000.0, 'current')} * 0.20
      + {_norm('temp', 100.0, 'temp')} * 0.15 + {_norm('life', 1.0, 'life')} * 0.20
      + {_norm('fsum', None, 'flags')} * 0.15) * 100.0
      + overheat_flag * 20.0 + critical_current_flag * 25.0 + high_current_flag * 15.0 + low_current_flag * 10.0
      + high_offpeak_flag * 12.0 + (CASE WHEN life > 0.9 THEN 25.0 ELSE 0.0 END) + zero_current_flag * 30.0
      + (CASE WHEN lh IS NULL THEN 30.0 ELSE 0.0 END) + (CASE WHEN inst IS NULL THEN 20.0 ELSE 0.0 END)
      + (CASE WHEN LineCurrent IS NULL THEN 15.0 ELSE 0.0 END)
      + (CASE WHEN LineTemperature IS NULL THEN 10.0 ELSE 0.0 END)) AS m_raw
  FROM h),
sd AS (
  SELECT *,
    CASE WHEN t = 'ZM1' THEN (CASE WHEN z_raw IS NULL THEN 100.0 WHEN z_raw > 100 THEN 100.0 WHEN z_raw < 0 THEN 0.0 ELSE z_raw END) ELSE 0.0 END AS risk_score_zm1,
    CASE WHEN t = 'UM3' THEN (CASE WHEN u_raw IS NULL THEN 100.0 WHEN u_raw > 100 THEN 100.0 WHEN u_raw < 0 THEN 0.0 ELSE u_raw END) ELSE 0.0 END AS risk_score_um3,
    CASE WHEN t = 'MM3' THEN (CASE WHEN m_raw IS NULL THEN 100.0 WHEN m_raw > 100 THEN 100.0 WHEN m_raw < 0 THEN 0.0 ELSE m_raw END) ELSE 0.0 END AS risk_score_mm3,
    {np_round('comm', 1)} AS comm1
  FROM sc),
rs AS (
  SELECT *,
    list_filter([
      CASE WHEN reconfigure_count = 1 THEN 'Reconfigure attempted 1 time' END,
      CASE WHEN reconfigure_count > 1 THEN 'Reconfigure attempted ' || reconfigure_count || ' times' END,
      CASE WHEN reconfigure_count >= 2 THEN 'Multiple reconfigure attempts - {never}' END,
      CASE WHEN lh IS NULL THEN 'Missing Last_Heard date' END,
      CASE WHEN gps_jump_flag = 1 THEN 'GPS drift detected - reconfigure recommended' END
    ], lambda x: x IS NOT NULL) AS common,
    CASE
      WHEN dev LIKE '%ZM1%' THEN list_filter([
        CASE WHEN rate > 40 THEN 'Battery draining fast (' || {py_fixed('rate', 0)} || '%/year)'
             WHEN rate > 20 THEN 'Battery draining faster than expected (' || {py_fixed('rate', 0)} || '%/year)' END,
        CASE WHEN BatteryLevel IS NULL THEN 'Missing battery data - check telemetry'
             WHEN battery_low_flag = 1 AND reconfigure_count = 0 THEN 'Battery critically low - reconfigure to verify'
             WHEN battery_low_flag = 1 THEN 'Battery still low after reconfigure - {never}' END
      ], lambda x: x IS NOT NULL)
      WHEN dev LIKE '%MM3%' THEN list_filter([
        CASE WHEN critical_current_flag = 1 THEN 'CRITICAL: Current ' || {py_fixed('cur', 1)} || 'A exceeds max (850A)'
             WHEN overheat_flag = 1 AND reconfigure_count = 0 THEN 'Overheating (' || {py_fixed('temp', 1)} || 'C) - check ventilation'
             WHEN overheat_flag = 1 THEN 'Still overheating after reconfigure - {never}'
             WHEN high_current_flag = 1 THEN 'High current (' || {py_fixed('cur', 1)} || 'A) - investigate'
             WHEN low_current_flag = 1 THEN 'Low current (' || {py_fixed('cur', 1)} || 'A) - check connection' END
      ], lambda x: x IS NOT NULL)
      WHEN dev LIKE '%UM3%' THEN list_filter([
        CASE WHEN comm1 > 30 AND reconfigure_count = 0 THEN 'No communication for ' || {comm_txt} || ' days - reconfigure'
             WHEN comm1 > 90 THEN 'Still no communication after reconfigure - {never}'
             WHEN comm1 > 30 THEN 'Communication issue persists after reconfigure'
             WHEN comm1 > 7 THEN 'Communication delay (' || {comm_txt} || ' days)' END,
        CASE WHEN gps_jump_flag = 1 THEN 'GPS drift detected - reconfigure recommended' END,
        CASE WHEN life > 0.9 THEN 'Device past 90% expected life - plan replacement' END
      ], lambda x: x IS NOT NULL)
      ELSE [] END AS typed,
    concat_ws(' | ',
      CASE WHEN life > 0.9 THEN 'Device past 90% expected life (' || {py_fixed('life * 10.0', 1)} || ' years) - plan replacement' END,
      CASE WHEN comm1 > 90 THEN 'No communication for ' || {comm_txt} || ' days'
           WHEN comm1 > 30 THEN 'Long communication gap (' || {comm_txt} || ' days)' END) AS sfx
  FROM sd),
rb AS (
  SELECT *, list_concat(common, typed) AS base FROM rs),
rm AS (
  SELECT *,
    CASE WHEN len(base) = 0 AND zero_current_flag = 1 THEN ['Zero current detected - reconfigure sensor']
         WHEN len(base) = 0 AND high_offpeak_flag = 1 THEN ['High current during off-peak - investigate']
         ELSE base END AS mbase
  FROM rb),
rr AS (
  SELECT *,
    CASE WHEN dev LIKE '%ZM1%' THEN base
         WHEN dev LIKE '%MM3%' THEN
           (CASE WHEN sfx = '' THEN mbase
                 WHEN len(mbase) = 0 THEN [sfx]
                 ELSE list_concat([mbase[1] || ' | ' || sfx], mbase[2:]) END)
         ELSE base END AS reasons
  FROM rm),
hf AS (
  SELECT *, CASE WHEN len(reasons) = 0 THEN 'Normal operating conditions' ELSE array_to_string(reasons, ', ') END
              AS risk_reason,
         {np_round('greatest(risk_score_zm1, risk_score_um3, risk_score_mm3)', 2)} AS risk_score
  FROM rr)
"""


HEALTH_COLUMNS_SQL = f"""
  reading_id, Serial, t AS Device_Type_Standardized, comm1 AS comm_age_days,
  {r6('report')} AS battery_report_age_days, {r6('life')} AS pct_life_used, {r6('months')} AS device_age_months,
  {r6('cur')} AS LineCurrent_val, {r6('temp')} AS LineTemperature_val, battery_low_flag, zero_current_flag,
  low_current_flag, high_current_flag, critical_current_flag, high_offpeak_flag, overheat_flag,
  {r6('distance_drift_m')} AS distance_drift_m, gps_jump_flag, {r6('aabr')} AS age_adjusted_battery_risk,
  {r6('urg')} AS maintenance_urgency_score, {r6('risk_score_zm1')} AS risk_score_zm1,
  {r6('risk_score_um3')} AS risk_score_um3, {r6('risk_score_mm3')} AS risk_score_mm3,
  risk_score, risk_reason, reconfigure_count
"""


def health_sql(batch: bool) -> str:
    return "WITH " + health_ctes(batch) + f"SELECT {HEALTH_COLUMNS_SQL} FROM hf"
