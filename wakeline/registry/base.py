"""Registry of named queries and the SQL that states the same result independently."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
NUDGE = 3.1e-8


def query(name: str, sql: str | None = None):
    """Register a query; without SQL only its rows can be checked."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def r6(column: str | Column) -> Column:
    """Six digits, nudged off ties, which engines round differently; no -0.0."""
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c + F.lit(NUDGE), 6) + F.lit(0.0)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r6(n) for n in names})


def s6(expression: str, name: str) -> str:
    return f"round({expression} + 3.1e-8, 6) + 0e0 AS {name}"


# --- SQL fragments -----------------------------------------------------------------------

TEL = """tel AS (
  SELECT event_id, ts AS time, 'dev-' || (user_id % 16) AS node_id, 'boat-' || (user_id % 8) AS node_name,
         CASE event_type WHEN 'click' THEN 'RPM' WHEN 'view' THEN 'SOG' WHEN 'purchase' THEN 'FUELRATE'
                         WHEN 'error' THEN 'ENGTEMP' WHEN 'signup' THEN 'COG' END AS signal_name_alias,
         value,
         CASE WHEN event_type NOT IN ('view', 'signup') THEN CAST(event_id % 2 AS VARCHAR) END AS signal_instance
  FROM events)"""

POS = r"""pos AS (
  SELECT event_id, ts AS time, 'dev-' || (user_id % 16) AS node_id, 'boat-' || (user_id % 8) AS node_name,
         55e0 + 0.15e0 * (k % 100) AS lat, 10e0 + 0.15e0 * ((k * 7) % 100) AS lon
  FROM (SELECT *, CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) AS k FROM events))"""

GPS_LONG = (
    POS
    + """, gps_long AS (
  SELECT event_id, time, node_id, node_name, 'A_LAT' AS signal_name_alias, lat AS value FROM pos
  UNION ALL SELECT event_id, time, node_id, node_name, 'A_LON', lon FROM pos
  UNION ALL SELECT event_id, ts, 'dev-' || (user_id % 16), 'boat-' || (user_id % 8),
    CASE event_type WHEN 'view' THEN 'A_SOG' WHEN 'signup' THEN 'X_Y_COG' WHEN 'click' THEN 'E_RPM' ELSE 'CELL' END,
    value FROM events WHERE event_type IN ('view', 'signup', 'click', 'purchase'))"""
)

WX_ONLY = """wx AS (
  SELECT node_name, h AS date, CAST((epoch_us(h) // 3600000000) % 13 AS DOUBLE) AS wind_speed_10m,
         CAST(((epoch_us(h) // 3600000000) * 37) % 360 AS DOUBLE) AS wind_direction_10m
  FROM (SELECT node_name, unnest(generate_series(date_trunc('hour', min(time)), date_trunc('hour', max(time)),
               INTERVAL 1 HOUR)) AS h FROM tel GROUP BY node_name))"""
WX = TEL + ", " + WX_ONLY

NOT_SENTINEL = "value <> 80.00861904e0 AND value <> 8191.875e0"


def half_even(us: str, seconds: int) -> str:
    n = seconds * 1_000_000
    return (
        f"((({us}) // {n}) + CASE WHEN 2 * (({us}) % {n}) > {n} OR (2 * (({us}) % {n}) = {n}"
        f" AND (({us}) // {n}) % 2 = 1) THEN 1 ELSE 0 END) * {n}"
    )


def bucket(ts: str, seconds: int) -> str:
    return f"make_timestamp({half_even(f'epoch_us({ts})', seconds)})"


def number_trips(
    source: str,
    gap_seconds: int,
    *,
    ts: str = "time",
    tie: str = "event_id",
    by: str = "node_name",
    inclusive: bool = False,
    midnight: bool = False,
    out: str = "trip_id",
) -> str:
    """Direct numbering: lag and one running sum per vessel."""
    op = ">=" if inclusive else ">"
    order = f"{ts}, {tie}" if tie else ts
    day = f" OR CAST({ts} AS DATE) <> CAST(lag({ts}) OVER w AS DATE)" if midnight else ""
    return f"""SELECT * EXCLUDE (brk), CAST(sum(brk) OVER (PARTITION BY {by} ORDER BY {order}
        ROWS UNBOUNDED PRECEDING) AS BIGINT) AS {out}
      FROM (SELECT *, CASE WHEN lag({ts}) OVER w IS NULL
              OR epoch_us({ts}) - epoch_us(lag({ts}) OVER w) {op} {gap_seconds * 1_000_000}{day} THEN 1 ELSE 0 END AS brk
            FROM {source} WINDOW w AS (PARTITION BY {by} ORDER BY {order}))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


HOURS2 = 2 * 3600
ENGINE = ("RPM", "FUELRATE", "ENGTEMP")
SIDE = "CASE signal_instance WHEN '0' THEN 'P' WHEN '1' THEN 'SB' ELSE signal_instance END"


def _first(name: str) -> str:
    return f"arg_min(value, event_id) FILTER (signal_name_alias = '{name}') AS {name}"


# Engine rows per vessel and side, hourly means, trips (new day or two hours), filled forward.
ENGINE_CHAIN = (
    TEL
    + f""", eng_wide AS (
  SELECT node_name, {SIDE} AS signal_instance, time, {', '.join(_first(s) for s in ENGINE)}
  FROM tel WHERE signal_instance IS NOT NULL GROUP BY ALL),
even AS (
  SELECT node_name, signal_instance, {bucket('time', 3600)} AS ts,
         {', '.join(f'avg({s}) AS {s}' for s in ENGINE)} FROM eng_wide GROUP BY ALL),
even_trips AS ({number_trips('even', HOURS2, ts='ts', tie='signal_instance', inclusive=True, midnight=True, out='TRIP_ID')}),
filled AS (
  SELECT node_name, signal_instance, ts, TRIP_ID,
         {', '.join(f'last_value({s} IGNORE NULLS) OVER w AS {s}' for s in ENGINE)}
  FROM even_trips
  WINDOW w AS (PARTITION BY node_name, TRIP_ID, signal_instance ORDER BY ts ROWS UNBOUNDED PRECEDING))"""
)

# Positions per vessel and second, trips (two hours), filled, deltas, running flag.
GPS_SIGNALS = ("LAT", "LON", "SOG", "COG", "RPM", "CELL")


def gps_chain(before: str = GPS_LONG, source: str = "gps_long") -> str:
    mean = ", ".join(f"avg(value) FILTER (sig = '{s}') AS {s}" for s in GPS_SIGNALS)
    fill = ", ".join(
        f"coalesce(first_value({s} IGNORE NULLS) OVER nxt, last_value({s} IGNORE NULLS) OVER prv, 0e0) AS {s}"
        for s in GPS_SIGNALS
    )
    delta = ", ".join(
        f"coalesce({s} - lag({s}) OVER w, 0e0) AS {s}_Delta" for s in ("LAT", "LON", "SOG")
    )
    return (
        before
        + f""", gps_wide AS (
  SELECT node_name, {bucket('time', 1)} AS ts, {mean}
  FROM (SELECT *, regexp_replace(regexp_replace(signal_name_alias, '^[^_]*_', ''), '^[^_]*_', '') AS sig
        FROM {source} WHERE {NOT_SENTINEL}) GROUP BY ALL),
gps_trips AS ({number_trips('gps_wide', HOURS2, ts='ts', tie='', out='tripID')}),
gps_filled AS (
  SELECT node_name, ts, tripID, {fill} FROM gps_trips
  WINDOW prv AS (PARTITION BY node_name, tripID ORDER BY ts ROWS UNBOUNDED PRECEDING),
         nxt AS (PARTITION BY node_name, tripID ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
gps AS (
  SELECT * EXCLUDE (RPM), CASE WHEN RPM > 0 THEN 1 ELSE 0 END AS RPM, {delta} FROM gps_filled
  WINDOW w AS (PARTITION BY node_name, tripID ORDER BY ts))"""
    )


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - {lon1}) / 2), 2)"
    )
    return f"(6880.13e0 * asin(sqrt({a})))"


def hex_sql(lat: str, lon: str, source: str, columns: str = "*", size: float = 0.6) -> str:
    """``source`` plus the column ``cell``: axial coordinates rounded in cube space."""
    return f"""SELECT {columns}, CASE WHEN q0 IS NULL OR r0 IS NULL THEN NULL ELSE
        CAST(CAST(CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END AS BIGINT) AS VARCHAR) || ':' ||
        CAST(CAST(CASE WHEN dq > dr AND dq > ds THEN rr WHEN dr > ds THEN -rq - rs ELSE rr END AS BIGINT) AS VARCHAR) END AS cell
      FROM (SELECT *, abs(rq - q0) AS dq, abs(rr - r0) AS dr, abs(rs - (-q0 - r0)) AS ds
        FROM (SELECT *, round(q0) AS rq, round(r0) AS rr, round(-q0 - r0) AS rs
          FROM (SELECT *, (sqrt(3e0) / 3 * (({lon}) * cos(radians(60e0))) - ({lat}) / 3) / {size}e0 AS q0,
                       (2e0 / 3) * ({lat}) / {size}e0 AS r0 FROM {source})))"""


def ellipsoid(name: str, lat1: str, lon1: str, lat2: str, lon2: str, source: str, steps: int = 8) -> str:
    """CTEs up to ``name``: ``source`` plus ``enm``, the WGS-84 distance in nautical miles by Vincenty's iteration, written out; for
    points not nearly antipodal. Each step is stored, as merged ones would grow with every step.
    """
    a, f = "6378137e0", "(1e0 / 298.257223563e0)"
    b = f"({a} * (1 - {f}))"
    start = f"""SELECT *, radians({lon2} - {lon1}) AS v_l, radians({lon2} - {lon1}) AS v_m, sin(u1) AS s1, cos(u1) AS c1, sin(u2) AS s2, cos(u2) AS c2
      FROM (SELECT *, atan((1 - {f}) * tan(radians({lat1}))) AS u1, atan((1 - {f}) * tan(radians({lat2}))) AS u2 FROM {source})"""
    drop = "ss, cs, sg, sa, ca, cm"
    found = [f"{name}_0 AS MATERIALIZED ({start})"]

    def sphere(inner: str) -> str:
        sql = f"SELECT *, sqrt(pow(c2 * sin(v_m), 2) + pow(c1 * s2 - s1 * c2 * cos(v_m), 2)) AS ss, s1 * s2 + c1 * c2 * cos(v_m) AS cs FROM {inner}"
        found.append(f"{inner}a AS MATERIALIZED ({sql})")
        sql = f"SELECT *, atan2(ss, cs) AS sg, CASE WHEN ss > 0 THEN c1 * c2 * sin(v_m) / ss ELSE 0e0 END AS sa FROM {inner}a"
        found.append(f"{inner}b AS MATERIALIZED ({sql})")
        sql = f"SELECT *, 1 - sa * sa AS ca, CASE WHEN 1 - sa * sa > 0 THEN cs - 2 * s1 * s2 / (1 - sa * sa) ELSE 0e0 END AS cm FROM {inner}b"
        found.append(f"{inner}c AS MATERIALIZED ({sql})")
        return f"{inner}c"

    for i in range(steps):
        k = f"({f} / 16 * ca * (4 + {f} * (4 - 3 * ca)))"
        new = f"v_l + (1 - {k}) * {f} * sa * (sg + {k} * ss * (cm + {k} * cs * (2 * cm * cm - 1)))"
        found.append(f"{name}_{i + 1} AS MATERIALIZED (SELECT * EXCLUDE (v_m, {drop}), {new} AS v_m FROM {sphere(f'{name}_{i}')})")
    last = sphere(f"{name}_{steps}")
    found.append(f"{name}_w AS MATERIALIZED (SELECT *, ca * (pow({a}, 2) - pow({b}, 2)) / pow({b}, 2) AS w FROM {last})")
    series = "1 + w / 16384 * (4096 + w * (-768 + w * (320 - 175 * w))) AS p, w / 1024 * (256 + w * (-128 + w * (74 - 47 * w))) AS r"
    found.append(f"{name}_p AS MATERIALIZED (SELECT *, {series} FROM {name}_w)")
    fix = "r * ss * (cm + r / 4 * (cs * (2 * cm * cm - 1) - r / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))"
    found.append(f"{name} AS (SELECT *, CASE WHEN ss = 0 THEN 0e0 ELSE {b} * p * (sg - {fix}) / 1852e0 END AS enm FROM {name}_p)")
    return ",\n".join(found)
