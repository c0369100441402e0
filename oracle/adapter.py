"""DuckDB twins of the Spark test adapter (``voltwatch/sources/adapter.py``).

Each constant is a CTE body; ``with_ctes`` prefixes a query with the CTEs it
names.  Helpers emit SQL for rounding and formatting with the same semantics
as the Spark Column helpers.
"""

from __future__ import annotations

READINGS = """
SELECT event_id AS reading_id,
       user_id AS Serial,
       CASE user_id % 3
         WHEN 0 THEN CASE WHEN user_id % 10 = 3 THEN 'zm1 ' ELSE 'ZM1' END
         WHEN 1 THEN CASE WHEN user_id % 10 = 4 THEN ' Mm3' ELSE 'MM3' END
         ELSE CASE WHEN user_id % 10 = 5 THEN 'UM3+' ELSE 'UM3' END END AS Device_Type,
       CASE event_type WHEN 'error' THEN 'OFFLINE' WHEN 'click' THEN 'ONLINE'
         WHEN 'view' THEN 'STANDBY' WHEN 'purchase' THEN 'INTERMITTENT' END AS Status,
       CAST(ts AS TIMESTAMP) AS Last_Heard,
       CAST(ts AS DATE) AS batch_date,
       CASE WHEN user_id % 3 = 0 AND event_type <> 'signup' THEN CAST(k AS DOUBLE) END AS BatteryLevel,
       CASE WHEN user_id % 3 = 0 THEN make_timestamp(epoch_us(CAST(ts AS TIMESTAMP)) - CAST(k AS BIGINT) * 3 * 86400000000) END
         AS BatteryLatestReport,
       CASE WHEN user_id % 3 = 1 THEN CASE WHEN event_type = 'signup' THEN CAST(0 AS DOUBLE)
                                      ELSE round(value * CAST(4 AS DOUBLE), 2) END END AS LineCurrent,
       CASE WHEN user_id % 3 = 1 THEN CAST(k - 5 AS DOUBLE) END AS LineTemperature,
       CASE WHEN event_id % 29 = 0 THEN CAST(0 AS DOUBLE)
            ELSE CAST(27.9 AS DOUBLE) + (event_id % 7) * CAST(0.0002 AS DOUBLE) END AS Latitude,
       CASE WHEN event_id % 29 = 0 THEN CAST(0 AS DOUBLE)
            ELSE CAST(-82.4 AS DOUBLE) - user_id * CAST(0.001 AS DOUBLE) END AS Longitude
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) ev
"""

INSTALL = """
SELECT o_custkey AS Serial, CAST(CAST(min(o_orderdate) AS DATE) + INTERVAL 20 YEAR AS TIMESTAMP) AS InstallDate
FROM orders GROUP BY o_custkey
"""

ATTEMPTS = """
SELECT user_id AS Serial, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS attempt_date
FROM events WHERE event_type = 'signup' AND value > 100
"""

CTES = {"readings": READINGS, "install": INSTALL, "attempts": ATTEMPTS}


def with_ctes(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    parts = [f"{n} AS ({CTES[n]})" for n in names]
    for n, q in (extra or {}).items():
        parts.append(f"{n} AS ({q})")
    return "WITH " + ",\n".join(parts) + "\n" + body


# ----------------------------------------------------------- SQL helpers --

def np_round(x: str, n: int) -> str:
    """numpy round: scale, half-even, unscale (matches ``exprs.np_round``)."""
    if n == 0:
        return f"round_even(CAST({x} AS DOUBLE), 0)"
    m = float(10 ** n)
    return f"(round_even(CAST({x} AS DOUBLE) * CAST({m} AS DOUBLE), 0) / CAST({m} AS DOUBLE))"


def py_fixed(x: str, n: int) -> str:
    """Python ``format(x, '.nf')``; DuckDB printf formats the exact binary value too."""
    return f"printf('%.{n}f', CAST({x} AS DOUBLE))"


def days_between(later: str, earlier: str) -> str:
    return f"(CAST(epoch_us({later}) - epoch_us({earlier}) AS DOUBLE) / CAST(86400000000 AS DOUBLE))"


def clip(x: str, lo: float | None = None, hi: float | None = None) -> str:
    out = x
    if hi is not None:
        out = f"(CASE WHEN {out} > {hi} THEN CAST({hi} AS DOUBLE) ELSE {out} END)"
    if lo is not None:
        out = f"(CASE WHEN {out} < {lo} THEN CAST({lo} AS DOUBLE) ELSE {out} END)"
    return out


def flag(cond: str) -> str:
    return f"(CASE WHEN {cond} THEN 1 ELSE 0 END)"


def r6(x: str) -> str:
    """Comparison rounding of float outputs (both engines round to 6 dp)."""
    return f"round(CAST({x} AS DOUBLE), 6)"


def cut(x: str, edges, labels) -> str:
    """pd.cut, right-closed, outside -> NULL."""
    parts = [f"WHEN {x} > {lo} AND {x} <= {hi} THEN '{lab}'" for lo, hi, lab in zip(edges[:-1], edges[1:], labels)]
    return "(CASE " + " ".join(parts) + " END)"
