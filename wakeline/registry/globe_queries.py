"""Cells of the globe. The SQL follows the geometry step by step, with the solid's numbers as tables."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from wakeline.functions import globe
from wakeline.operators import cells, scoring
from wakeline.registry import frames
from wakeline.registry.base import POS, query, rounded, with_
from wakeline.registry.join_queries import _FLAG, GPS, flagged
from wakeline.sources import events

LEVEL = 5
_BITS = (1 << 54, 1 << 27)


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(repr(v.item() if isinstance(v, np.generic) else v) for v in r) + ")" for r in rows)


def _tables(level: int) -> str:
    """Faces, what lies over their edges, and the home of each corner."""
    _, faces, centres, first, second = globe._solid()
    beyond, place, turn = globe._gluing()
    corner = globe._corner_points(globe._edge(level))
    glue = [
        (f, e, int(beyond[f, e]), *corner[e].tolist(), *corner[place[f, e]].tolist(), *globe._UNITS[turn[f, e]])
        for f in range(20)
        for e in range(3)
    ]
    homes = globe._homes()
    tips = [(f, i, int(homes[faces[f, i], 0]), *corner[homes[faces[f, i], 1]].tolist()) for f in range(20) for i in range(3)]
    axes = [(f, *(f"{v:.17e}" for v in (*centres[f], *first[f], *second[f]))) for f in range(20)]
    numbers = ", ".join("(" + ", ".join(map(str, r)) + ")" for r in axes)
    return f"""faces AS (SELECT * FROM (VALUES {numbers}) AS t(f, c1, c2, c3, a1, a2, a3, b1, b2, b3)),
glue{level} AS (SELECT * FROM (VALUES {_values(glue)}) AS t(gf, ge, n, ca, cb, qa, qb, ua, ub)),
tips{level} AS (SELECT * FROM (VALUES {_values(tips)}) AS t(tf, ti, hf, ha, hb))"""


def _settled(source: str, level: int) -> str:
    """``source`` with whole numbers (face, a, b) on the face they lie on, the first where several share them, and ``cell``."""
    z0, z1 = globe._edge(level)
    n = z0 * z0 + z0 * z1 + z1 * z1
    shares = f"SELECT *, a * {z0 + z1} + b * {z1} AS sx, b * {z0} - a * {z1} AS sy FROM"
    moved = "qa + (a - ca) * ua - (b - cb) * ub AS a2, qb + (a - ca) * ub + (b - cb) * ua + (b - cb) * ub AS b2"
    drop = "face, a, b, sx, sy"
    for _ in range(4):
        edge = f"""SELECT *, CASE WHEN greatest(-sy, sx + sy - {n}, -sx) <= 0 THEN NULL
            WHEN -sy >= sx + sy - {n} AND -sy >= -sx THEN 0 WHEN sx + sy - {n} >= -sx THEN 1 ELSE 2 END AS e FROM ({shares} ({source}))"""
        crossed = f"SELECT *, {moved} FROM ({edge}) LEFT JOIN glue{level} ON gf = face AND ge = e"
        source = f"""SELECT * EXCLUDE ({drop}, e, gf, ge, n, ca, cb, qa, qb, ua, ub, a2, b2), CASE WHEN e IS NULL THEN face ELSE n END AS face,
          CASE WHEN e IS NULL THEN a ELSE a2 END AS a, CASE WHEN e IS NULL THEN b ELSE b2 END AS b FROM ({crossed})"""
    tip = f"SELECT *, CASE WHEN sx = 0 AND sy = 0 THEN 0 WHEN sx = {n} THEN 1 WHEN sy = {n} THEN 2 END AS i FROM ({shares} ({source}))"
    on = f"SELECT *, CASE WHEN i IS NULL THEN CASE WHEN sy = 0 THEN 0 WHEN sx + sy = {n} THEN 1 WHEN sx = 0 THEN 2 END END AS e FROM ({tip})"
    both = f"""SELECT *, {moved} FROM ({on}) LEFT JOIN glue{level} ON gf = face AND ge = e LEFT JOIN tips{level} ON tf = face AND ti = i"""
    source = f"""SELECT * EXCLUDE ({drop}, i, e, gf, ge, n, ca, cb, qa, qb, ua, ub, a2, b2, tf, ti, hf, ha, hb),
      CASE WHEN i IS NOT NULL THEN hf WHEN n < face THEN n ELSE face END AS face,
      CASE WHEN i IS NOT NULL THEN ha WHEN n < face THEN a2 ELSE a END AS a,
      CASE WHEN i IS NOT NULL THEN hb WHEN n < face THEN b2 ELSE b END AS b FROM ({both})"""
    return f"""SELECT *, CAST({level << 59} AS BIGINT) + face * CAST({_BITS[0]} AS BIGINT) + (a + {globe._HALF}) * CAST({_BITS[1]} AS BIGINT)
      + (b + {globe._HALF}) AS cell FROM ({source})"""


_ROUNDED = """CAST(CASE WHEN dx > dy AND dx > ds THEN -ry - rs ELSE rx END AS BIGINT) AS a,
  CAST(CASE WHEN dx > dy AND dx > ds THEN ry WHEN dy > ds THEN -rx - rs ELSE ry END AS BIGINT) AS b"""


def _nearest(source: str) -> str:
    """``source`` with (x, y) rounded to the nearest lattice point (a, b)."""
    return f"""SELECT * EXCLUDE (x, y, rx, ry, rs, dx, dy, ds), {_ROUNDED} FROM (
      SELECT *, abs(rx - x) AS dx, abs(ry - y) AS dy, abs(rs - (-x - y)) AS ds FROM (
        SELECT *, round(x) AS rx, round(y) AS ry, round(-x - y) AS rs FROM ({source})))"""


def cell_sql(source: str, key: str, lat: str, lon: str, level: int) -> str:
    """(key, cell) of the positions in ``source``."""
    g, d = globe._sizes()
    third, cot, half = globe._THIRD, globe._COT, globe._CORNER
    t = np.exp(1j * math.pi / 3)
    z0, z1 = globe._edge(level)
    k = (z0 + z1 * t) / (d * (np.exp(1j * third) - 1))
    point = f"""SELECT {key}, cos(radians({lat})) * cos(radians({lon})) AS px, cos(radians({lat})) * sin(radians({lon})) AS py,
      sin(radians({lat})) AS pz FROM {source} WHERE {lat} IS NOT NULL AND {lon} IS NOT NULL"""
    faced = f"""SELECT {key}, f AS face, px * c1 + py * c2 + pz * c3 AS up, px * a1 + py * a2 + pz * a3 AS u, px * b1 + py * b2 + pz * b3 AS v
      FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY px * c1 + py * c2 + pz * c3 DESC) AS best FROM ({point}), faces) WHERE best = 1"""
    polar = f"""SELECT {key}, face, atan2(sqrt(u * u + v * v), up) AS z, whole - floor(whole / {third!r}) * {third!r} AS az,
      floor(whole / {third!r}) AS sector FROM (SELECT *, CASE WHEN atan2(v, u) < 0 THEN atan2(v, u) + {2 * math.pi!r} ELSE atan2(v, u) END AS whole FROM ({faced}))"""
    area = f"""SELECT *, az + {half!r} + acos(sin(az) * {math.sin(half) * math.cos(g)!r} - cos(az) * {math.cos(half)!r}) - {math.pi!r} AS area,
      atan2({math.tan(g)!r}, cos(az) + sin(az) * {cot!r}) AS q FROM ({polar})"""
    flat = f"SELECT *, atan2(2 * area, {d * d!r} - 2 * area * {cot!r}) AS flat FROM ({area})"
    plane = f"""SELECT {key}, face, rho * cos(flat + sector * {third!r}) - {d!r} AS re, rho * sin(flat + sector * {third!r}) AS im FROM (
      SELECT *, {d!r} / (cos(flat) + sin(flat) * {cot!r}) * sin(z / 2) / sin(q / 2) AS rho FROM ({flat}))"""
    lattice = f"""SELECT {key}, face, (re * {float(k.real)!r} - im * {float(k.imag)!r}) - (re * {float(k.imag)!r} + im * {float(k.real)!r}) / {math.sqrt(3)!r} AS x,
      (re * {float(k.imag)!r} + im * {float(k.real)!r}) / {math.sqrt(3) / 2!r} AS y FROM ({plane})"""
    return _settled(_nearest(lattice), level)


def parent_sql(source: str, level: int) -> str:
    """``source`` (face, a, b of ``level``) with its cells replaced by their parents."""
    c, d = globe._factor(level)
    divided = f"SELECT * EXCLUDE (a, b, cell), (a * {c + d} + b * {d}) / 7e0 AS x, (b * {c} - a * {d}) / 7e0 AS y FROM ({source})"
    return _settled(_nearest(divided), level - 1)


def _positions(spark, folder):
    return events.positions(spark, folder).select("event_id", "value_latitude", "value_longitude")


@query("f18_global_cell", with_(_tables(LEVEL), POS, f"c AS ({cell_sql('pos', 'event_id', 'lat', 'lon', LEVEL)})") + "SELECT event_id, cell FROM c")
def f18_global(spark, folder):
    """Positions to the ids of the globe's cells."""
    p = _positions(spark, folder)
    return p.select("event_id", globe.global_cell("value_latitude", "value_longitude", LEVEL).alias("cell"))


@query(
    "f18_global_parents",
    with_(
        _tables(LEVEL),
        *(t for k in (LEVEL - 1, LEVEL - 2) for t in [_tables(k).split(",\n", 1)[1]]),
        POS,
        f"c AS ({cell_sql('pos', 'event_id', 'lat', 'lon', LEVEL)})",
        f"p AS ({parent_sql('SELECT * FROM c', LEVEL)})",
        f"pp AS ({parent_sql('SELECT * FROM p', LEVEL - 1)})",
    )
    + "SELECT cell, count(*) AS n FROM pp GROUP BY cell",
)
def f18_parents(spark, folder):
    """Rows per cell two levels up, worked out from counts per cell."""
    counts = f18_global(spark, folder).groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(globe.cell_parent("cell", LEVEL - 2).alias("cell")).agg(F.sum("n").alias("n"))


@query("f19_global_ring")
def f19_global(spark, folder):
    """Corners of every cell with a position."""
    found = f18_global(spark, folder).groupBy("cell").agg(F.count(F.lit(1)).alias("n_rows"))
    corners = found.select("cell", "n_rows", F.posexplode(globe.cell_ring("cell")).alias("corner", "p"))
    return rounded(corners.select("cell", "n_rows", "corner", F.col("p")[0].alias("lat"), F.col("p")[1].alias("lon")), "lat", "lon")


@query(
    "a13_global_cells",
    with_(
        GPS,
        _FLAG,
        _tables(LEVEL),
        "g AS (SELECT row_number() OVER () AS k, node_name, tripID, LAT, LON FROM gps)",
        f"c AS ({cell_sql('g', 'k', 'LAT', 'LON', LEVEL)})",
    )
    + """SELECT cell, count(DISTINCT CASE WHEN f.tripID IS NOT NULL THEN (g.node_name, g.tripID) END) AS trips
    FROM g JOIN c USING (k) LEFT JOIN flag f ON f.node_name = g.node_name AND f.tripID = g.tripID GROUP BY cell""",
)
def a13_global(spark, folder):
    """Distinct anomalous trips per cell of the globe."""
    rows = frames.gps_stored(spark, folder)
    return cells.cell_counts(scoring.mark_flagged(rows, flagged(rows)), level=LEVEL)


@query("a14_global_cover")
def a14_global(spark, folder):
    """All cells of the globe that meet the box of the positions, with the rows in each."""
    p = _positions(spark, folder)
    box = p.agg(
        *(getattr(F, f)(f"value_{c}").alias(f"{c[:3]}_{f}") for c in ("latitude", "longitude") for f in ("min", "max"))
    )
    covered = globe.cover(box, LEVEL).select("cell")
    counts = f18_global(spark, folder).groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    return covered.join(counts, "cell", "left").select("cell", F.coalesce("n", F.lit(0)).alias("n"))
