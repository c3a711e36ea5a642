"""Hexagonal cells of the whole globe: 64-bit ids, equal areas, seven children to a cell.

The sphere is an icosahedron's twenty faces, each mapped to a plane triangle with equal areas (Snyder's projection). A face
carries a lattice of whole numbers a + b t with t a sixth of a turn, scaled so that the edge from corner to corner is the product
Z of one factor of norm 7 per level. Cells are the nearest-point regions of the lattice: hexagons of one area, and
pentagons (five sixths of it) at the twelve corners. The factors 2 + t and 3 - t take turns, so every second level
has the same orientation again.

The faces' lattices are one lattice: over an edge, a neighbour's numbers follow by a rotation by sixths of a turn and a
shift, all in whole numbers. A point that belongs to several faces has the numbers of the first. So parents
(division by the level's factor, rounded), children (the seven points that round to a parent) and neighbours are
exact, and there are 10 * 7^level + 2 cells at a level.

An id has, from the top: a zero bit, 4 bits of level, 5 of face, and 27 each of a and b. Latitudes are taken as those of a sphere.
"""

from __future__ import annotations

import functools
import math
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.functions.timeops import col

FINEST = 15
_HALF = 1 << 26
_MASK = (1 << 27) - 1
#: A turn of the solid that keeps its corners off the poles and the zero meridian, as rotations about z, y and x in radians.
TILT = (0.45, 0.35, 0.2)
#: An angle within which all descendants of a cell lie, in units of the root of its area; hexagons reach 0.62, and
#: children's centres 0.65 beyond, each times at most 1.25 for what the projection stretches.
REACH = 1.6


# --- the solid ---------------------------------------------------------------------------


@functools.cache
def _solid():
    """Corners, faces (three corners each, counter-clockwise from outside), face centres and axes."""
    golden = (1 + math.sqrt(5)) / 2
    corners = [np.roll((0.0, s, u * golden), k) for k in range(3) for s in (-1, 1) for u in (-1, 1)]
    corners = np.array(corners) / math.hypot(1, golden)
    for angle, (i, j) in zip(TILT, ((0, 1), (0, 2), (1, 2))):
        turn = np.eye(3)
        turn[i, i] = turn[j, j] = math.cos(angle)
        turn[i, j], turn[j, i] = -math.sin(angle), math.sin(angle)
        corners = corners @ turn.T
    near = corners @ corners.T > 0.4  # neighbours have cosine 1 / sqrt(5)
    faces = []
    for a, b, c in combinations(range(12), 3):
        if near[a, b] and near[b, c] and near[a, c]:
            out = np.dot(np.cross(corners[a], corners[b]), corners[c]) > 0
            faces.append((a, b, c) if out else (a, c, b))
    faces = np.array(faces)
    centres = corners[faces].sum(1)
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    first = corners[faces[:, 0]]
    first = first - (first * centres).sum(1, keepdims=True) * centres
    first /= np.linalg.norm(first, axis=1, keepdims=True)
    return corners, faces, centres, first, np.cross(centres, first)


def _times(p, q):
    """Product of a + b t and c + d t, as t^2 = t - 1."""
    (a, b), (c, d) = p, q
    return a * c - b * d, a * d + b * c + b * d


_UNITS = [(1, 0), (0, 1), (-1, 1), (-1, 0), (0, -1), (1, -1)]  # powers of t


def _factor(level: int) -> tuple[int, int]:
    return (2, 1) if level % 2 else (3, -1)


@functools.cache
def _edge(level: int) -> tuple[int, int]:
    """Z, the edge from a face's first corner to its second."""
    z = (1, 0)
    for k in range(1, level + 1):
        z = _times(z, _factor(k))
    return z


@functools.cache
def _gluing():
    """Over edge e (corners e and e + 1) of each face: the neighbour, the place of corner e there, and the turn in sixths."""
    _, faces, *_ = _solid()
    beyond, place, turn = np.zeros((20, 3), int), np.zeros((20, 3), int), np.zeros((20, 3), int)
    for f, face in enumerate(faces.tolist()):
        for e in range(3):
            a, b = face[e], face[(e + 1) % 3]
            (n,) = [g for g, other in enumerate(faces.tolist()) if g != f and a in other and b in other]
            other = faces[n].tolist()
            i, j = other.index(a), other.index(b)
            # Edges of a face lie at 0, 2 and 4 sixths; there this one runs backwards.
            assert (j + 1) % 3 == i
            beyond[f, e], place[f, e], turn[f, e] = n, i, (2 * j + 3 - 2 * e) % 6
    return beyond, place, turn


@functools.cache
def _homes():
    """Of each corner of the solid: the first face that has it, and its place there."""
    _, faces, *_ = _solid()
    found = [(f, face.index(c)) for c in range(12) for f, face in [next((f, x) for f, x in enumerate(faces.tolist()) if c in x)]]
    return np.array(found)


def _corner_points(z):
    """The corners' whole numbers: 0, Z, Z t."""
    a, b = z
    return np.array([(0, 0), (a, b), (-b, a + b)], np.int64)


def _cross(face, a, b, edge, z):
    """The same point in the numbers of the face beyond an edge."""
    beyond, place, turn = _gluing()
    corners = _corner_points(z)
    units = np.array(_UNITS, np.int64)
    n, at, u = beyond[face, edge], place[face, edge], units[turn[face, edge]]
    da, db = a - corners[edge, 0], b - corners[edge, 1]
    x, y = _times((da, db), (u[..., 0], u[..., 1]))
    return n, corners[at, 0] + x, corners[at, 1] + y


def _shares(a, b, z):
    """Barycentric numbers x, y with p = Z (x + y t) / N."""
    c, d = z
    return a * (c + d) + b * d, b * c - a * d


def _settle(face, a, b, z):
    """Points on the face they lie on, and on the first one where several share them."""
    face, a, b = (np.array(v, np.int64).copy() for v in np.broadcast_arrays(face, a, b))
    n = z[0] * z[0] + z[0] * z[1] + z[1] * z[1]
    for _ in range(12):
        x, y = _shares(a, b, z)
        over = np.stack((-y, x + y - n, -x))
        edge = over.argmax(0)
        out = over.max(0) > 0
        if not out.any():
            break
        face[out], a[out], b[out] = _cross(face[out], a[out], b[out], edge[out], z)
    _, faces, *_ = _solid()
    homes, corners = _homes(), _corner_points(z)
    x, y = _shares(a, b, z)
    tips = ((x == 0) & (y == 0), x == n, y == n)
    for i, on in enumerate(tips):
        at = np.flatnonzero(on)
        home = homes[faces[face[at], i]]
        face[at], a[at], b[at] = home[:, 0], corners[home[:, 1], 0], corners[home[:, 1], 1]
    for e, on in enumerate((y == 0, x + y == n, x == 0)):
        at = np.flatnonzero(on & ~np.any(tips, axis=0))
        f, c, d = _cross(face[at], a[at], b[at], np.full(len(at), e), z)
        less = f < face[at]
        face[at[less]], a[at[less]], b[at[less]] = f[less], c[less], d[less]
    return face, a, b


# --- the projection ----------------------------------------------------------------------

_THIRD = 2 * math.pi / 3
_COT = math.sqrt(3.0)  # of half a triangle's corner
_CORNER = math.pi / 5  # half the angle between edges of the solid


@functools.cache
def _sizes():
    """Angle from a face's centre to its corner, and the length of that way in the plane, for equal areas."""
    corners, faces, centres, *_ = _solid()
    return math.acos(float(corners[faces[0, 0]] @ centres[0])), math.sqrt(4 * math.pi / (15 * math.sqrt(3)))


def _excess(az):
    """Area of the spherical triangle between the way to a corner and one at azimuth ``az``, and its slope."""
    g, _ = _sizes()
    u = np.sin(az) * math.sin(_CORNER) * math.cos(g) - np.cos(az) * math.cos(_CORNER)
    h = np.arccos(np.clip(u, -1, 1))
    slope = np.cos(az) * math.sin(_CORNER) * math.cos(g) + np.sin(az) * math.cos(_CORNER)
    return az + _CORNER + h - math.pi, 1 - slope / np.sin(h)


def _project(lat, lon):
    """Face and place in its plane, as a complex number with the first corner on the real axis."""
    _, _, centres, first, second = _solid()
    g, d = _sizes()
    phi, lam = np.radians(lat), np.radians(lon)
    p = np.stack((np.cos(phi) * np.cos(lam), np.cos(phi) * np.sin(lam), np.sin(phi)), axis=-1)
    face = (p @ centres.T).argmax(-1)
    up = (p * centres[face]).sum(-1)
    x, y = (p * first[face]).sum(-1), (p * second[face]).sum(-1)
    z = np.arctan2(np.hypot(x, y), up)
    whole = np.arctan2(y, x) % (2 * math.pi)
    sector = np.floor(whole / _THIRD)
    az = whole - sector * _THIRD
    area, _ = _excess(az)
    flat = np.arctan2(2 * area, d * d - 2 * area * _COT)
    q = np.arctan2(math.tan(g), np.cos(az) + np.sin(az) * _COT)
    rho = d / (np.cos(flat) + np.sin(flat) * _COT) * np.sin(z / 2) / np.sin(q / 2)
    return face, rho * np.exp(1j * (flat + sector * _THIRD))


def _unproject(face, place):
    """Latitude and longitude of a place in a face's plane."""
    _, _, centres, first, second = _solid()
    g, d = _sizes()
    whole = np.angle(place) % (2 * math.pi)
    sector = np.floor(whole / _THIRD)
    flat = whole - sector * _THIRD
    area = d * d * np.sin(flat) / (2 * (np.cos(flat) + np.sin(flat) * _COT))
    az = flat.copy()
    for _ in range(10):
        have, slope = _excess(az)
        az = np.clip(az - (have - area) / slope, 0, _THIRD)
    q = np.arctan2(math.tan(g), np.cos(az) + np.sin(az) * _COT)
    edge = d / (np.cos(flat) + np.sin(flat) * _COT)
    z = 2 * np.arcsin(np.clip(np.abs(place) / edge * np.sin(q / 2), -1, 1))
    az = az + sector * _THIRD
    p = (
        np.cos(z)[..., None] * centres[face]
        + (np.sin(z) * np.cos(az))[..., None] * first[face]
        + (np.sin(z) * np.sin(az))[..., None] * second[face]
    )
    return np.degrees(np.arctan2(p[..., 2], np.hypot(p[..., 0], p[..., 1]))), np.degrees(np.arctan2(p[..., 1], p[..., 0]))


def _plane(a, b, z):
    """Place in the plane of whole numbers, by the edge Z."""
    _, d = _sizes()
    t = np.exp(1j * math.pi / 3)
    share = (a + b * t) / (z[0] + z[1] * t)
    return d + share * d * (np.exp(1j * _THIRD) - 1)


def _nearest(x, y):
    """The lattice point nearest to x + y t."""
    s = -x - y
    rx, ry, rs = np.rint(x), np.rint(y), np.rint(s)
    dx, dy, ds = np.abs(rx - x), np.abs(ry - y), np.abs(rs - s)
    fix_x = (dx > dy) & (dx > ds)
    fix_y = ~fix_x & (dy > ds)
    return np.where(fix_x, -ry - rs, rx).astype(np.int64), np.where(fix_y, -rx - rs, ry).astype(np.int64)


# --- cells in numpy ----------------------------------------------------------------------


def pack(level, face, a, b):
    return (np.int64(level) << 59) | (face.astype(np.int64) << 54) | ((a + _HALF) << 27) | (b + _HALF)


def unpack(cells):
    cells = np.asarray(cells, np.int64)
    return cells >> 59, (cells >> 54) & 31, ((cells >> 27) & _MASK) - _HALF, (cells & _MASK) - _HALF


def cells_at(lat, lon, level: int) -> np.ndarray:
    """Ids of the cells that hold the positions."""
    lat, lon = np.asarray(lat, np.float64), np.asarray(lon, np.float64)
    _, d = _sizes()
    z = _edge(level)
    face, place = _project(lat, lon)
    t = np.exp(1j * math.pi / 3)
    value = (place - d) / (d * (np.exp(1j * _THIRD) - 1)) * (z[0] + z[1] * t)
    y = value.imag / (math.sqrt(3) / 2)
    a, b = _nearest(value.real - y / 2, y)
    return pack(level, *_settle(face, a, b, z))


def _by_level(cells, work):
    """``work(level, face, a, b)`` for each level among the cells; its rows put in the cells' order."""
    level, face, a, b = unpack(cells)
    out = [None] * len(level)
    for k in np.unique(level).tolist():
        at = np.flatnonzero(level == k)
        for i, row in zip(at.tolist(), work(int(k), face[at], a[at], b[at])):
            out[i] = row
    return out


def centres_of(cells) -> np.ndarray:
    """(lat, lon) of the cells' centres."""
    return np.array(_by_level(cells, lambda k, f, a, b: np.stack(_unproject(f, _plane(a, b, _edge(k))), 1))).reshape(-1, 2)


def _around(level, face, a, b, steps):
    """Ids of the points some steps away: (cell, step); steps that meet at a pentagon come out alike."""
    steps = np.array(steps, np.int64)
    shape = (len(a), len(steps))
    p = (np.repeat(face, len(steps)), (a[:, None] + steps[None, :, 0]).ravel(), (b[:, None] + steps[None, :, 1]).ravel())
    return pack(level, *_settle(*p, _edge(level))).reshape(shape)


def neighbours_of(cells) -> list[list[int]]:
    """Six neighbours, or five of a pentagon, ascending."""
    return _by_level(cells, lambda k, f, a, b: [sorted(set(row)) for row in _around(k, f, a, b, _UNITS).tolist()])


def children_of(cells) -> list[list[int]]:
    """The cells of the next level that have this parent, ascending."""

    def work(k, f, a, b):
        c, d = _times((a, b), _factor(k + 1))
        return [sorted(set(row)) for row in _around(k + 1, f, c, d, [(0, 0), *_UNITS]).tolist()]

    return _by_level(cells, work)


def parents_of(cells, level: int | None = None) -> np.ndarray:
    """The cell a level up, or of the level given; a cell of that level is its own."""
    cells = np.asarray(cells, np.int64).copy()
    while True:
        k, face, a, b = unpack(cells)
        at = np.flatnonzero(k > (level if level is not None else k.max(initial=0) - 1))
        if not len(at) or (level is None and not k.max(initial=0)):
            return cells
        for n in np.unique(k[at]).tolist():
            some = at[k[at] == n]
            c, d = _factor(n)
            # Division by the factor: times its conjugate, over 7.
            x, y = _times((a[some], b[some]), (c + d, -d))
            p, q = _nearest(x / 7.0, y / 7.0)
            cells[some] = pack(n - 1, *_settle(face[some], p, q, _edge(n - 1)))
        if level is None:
            return cells


def rings_of(cells, between: int = 1) -> list[np.ndarray]:
    """Outline (lat, lon) of each cell, counter-clockwise, with ``between`` points to an edge, the corners among them."""
    corner = [(_UNITS[i][0] + _UNITS[(i + 1) % 6][0], _UNITS[i][1] + _UNITS[(i + 1) % 6][1]) for i in range(6)]
    corner = np.array([*corner, corner[0]], np.int64)
    share = np.arange(between)[None, :, None]
    steps = (between * corner[:6, None] + share * (corner[1:] - corner[:6])[:, None]).reshape(-1, 2)

    def work(k, f, a, b):
        z = _edge(k)
        fine = 3 * between  # corners are at thirds
        size, many = (fine * z[0], fine * z[1]), len(steps)
        x, y = ((fine * v[:, None] + steps[None, :, i]).ravel() for i, v in enumerate((a, b)))
        g, c, d = _settle(np.repeat(f, many), x, y, size)
        outline = np.stack(_unproject(g, _plane(c, d, size)), 1).reshape(len(a), many, 2)
        same = np.stack((g, c, d), 1).reshape(len(a), many, 3)
        middle = np.stack(_unproject(f, _plane(a, b, z)), 1)
        # Around a pentagon one sixth of the points are met twice.
        return [_ordered(o[np.unique(n, axis=0, return_index=True)[1]], m) for o, n, m in zip(outline, same, middle)]

    return _by_level(cells, work)


def _vectors(points):
    phi, lam = np.radians(points[..., 0]), np.radians(points[..., 1])
    return np.stack((np.cos(phi) * np.cos(lam), np.cos(phi) * np.sin(lam), np.sin(phi)), axis=-1)


def _degrees(v):
    return np.stack((np.degrees(np.arctan2(v[..., 2], np.hypot(v[..., 0], v[..., 1]))), np.degrees(np.arctan2(v[..., 1], v[..., 0]))), -1)


def _ordered(ring, centre):
    """Counter-clockwise round the centre, the corner furthest east of north first."""
    c, v = _vectors(centre), _vectors(ring)
    axis = np.eye(3)[np.abs(c).argmin()]
    e = np.cross(axis, c)
    e /= np.linalg.norm(e)
    angle = np.arctan2(v @ np.cross(c, e), v @ e)
    return ring[np.argsort(angle, kind="stable")]


def area_of_level(level: int) -> float:
    """Area of a hexagon on the unit sphere."""
    return 4 * math.pi / (10 * 7**level)


def touches(cells, box, sure: bool) -> np.ndarray:
    """Which cells meet a box (lat_min, lat_max, lon_min, lon_max; across the antimeridian where lon_min > lon_max).

    ``sure=False`` asks whether a cell or a descendant of it can: by the distance of its centre.
    """
    south, north, west, east = box
    if not (south <= north) or any(math.isnan(x) for x in box):
        return np.zeros(len(cells), bool)
    width = 360.0 if east - west >= 360 else (east - west) % 360.0
    if not sure:
        level = unpack(cells)[0]
        centre = centres_of(cells)
        reach = REACH * np.sqrt(4 * math.pi / (10 * 7.0**level))
        off = (centre[:, 1] - west) % 360.0
        inside = off <= width
        beside = np.radians(np.minimum(off - width, 360.0 - off))  # to the nearer meridian
        phi = np.radians(centre[:, 0])
        # The nearest point of that meridian, held within the box.
        foot = np.arctan2(np.sin(phi), np.cos(phi) * np.cos(beside))
        foot = np.clip(np.where(inside, phi, foot), math.radians(south), math.radians(north))
        turn = np.where(inside, 0.0, beside)
        cosine = np.sin(phi) * np.sin(foot) + np.cos(phi) * np.cos(foot) * np.cos(turn)
        return np.arccos(np.clip(cosine, -1, 1)) <= reach + 1e-9
    level = unpack(cells)[0]
    own = np.zeros(len(cells), bool)
    for k in np.unique(level).tolist():
        here = cells_at([south, south, north, north], [west, west + width, west, west + width], int(k))
        own |= np.isin(cells, here)
    for i in np.flatnonzero(~own).tolist():
        (ring,) = rings_of(cells[i : i + 1], between=8)
        lat = np.append(ring[:, 0], ring[0, 0])
        step = (np.diff(np.append(ring[:, 1], ring[0, 1])) + 180.0) % 360.0 - 180.0
        lon = (ring[0, 1] - west) % 360.0 + np.concatenate(([0.0], np.cumsum(step)))
        own[i] = any(_meets(lat, lon + shift, south, north, width) for shift in (-360.0, 0.0, 360.0))
    return own


def _meets(lat, lon, south, north, width) -> bool:
    """Does a path meet the rectangle [south, north] x [0, width]? Each leg is clipped to it."""
    y, x, dy, dx = lat[:-1], lon[:-1], np.diff(lat), np.diff(lon)
    low, high = np.zeros(len(x)), np.ones(len(x))
    ok = np.ones(len(x), bool)
    for start, way, least, most in ((x, dx, 0.0, width), (y, dy, south, north)):
        still = way == 0
        ok &= ~still | ((start >= least) & (start <= most))
        safe = np.where(still, 1.0, way)
        a, b = (least - start) / safe, (most - start) / safe
        low = np.where(still, low, np.maximum(low, np.minimum(a, b)))
        high = np.where(still, high, np.minimum(high, np.maximum(a, b)))
    return bool((ok & (low <= high)).any())


# --- columns -----------------------------------------------------------------------------


def global_cell(lat: str | Column, lon: str | Column, level: int) -> Column:
    """64-bit id of the cell that holds a position; null where that is null or no position."""

    @F.pandas_udf("long")
    def at(a: pd.Series, b: pd.Series) -> pd.Series:
        y, x = a.to_numpy(dtype="float64", na_value=np.nan), b.to_numpy(dtype="float64", na_value=np.nan)
        good = np.isfinite(y) & np.isfinite(x) & (np.abs(y) <= 90)
        out = pd.array(np.zeros(len(y), np.int64), dtype="Int64")
        out[good] = cells_at(y[good], x[good], level)
        out[~good] = pd.NA
        return pd.Series(out)

    return at(col(lat).cast("double"), col(lon).cast("double"))


def _mapped(kind: str, work):
    """A column function over ids; null stays null."""

    @F.pandas_udf(kind)
    def run(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        out = pd.Series([None] * len(ids), dtype=object)
        if known.any():
            found = work(ids[known].to_numpy(np.int64))
            out.iloc[np.flatnonzero(known)] = pd.Series(list(found), dtype=object, index=np.flatnonzero(known))
        return out

    return lambda cell: run(col(cell))


def cell_centre(cell: str | Column) -> Column:
    """[lat, lon]."""
    return _mapped("array<double>", lambda ids: [c.tolist() for c in centres_of(ids)])(cell)


def cell_ring(cell: str | Column) -> Column:
    """Corners as an array of [lat, lon]."""
    return _mapped("array<array<double>>", lambda ids: [r.tolist() for r in rings_of(ids)])(cell)


def cell_parent(cell: str | Column, level: int | None = None) -> Column:
    return _mapped("long", lambda ids: parents_of(ids, level).tolist())(cell)


def cell_children(cell: str | Column) -> Column:
    return _mapped("array<long>", children_of)(cell)


def cell_neighbours(cell: str | Column) -> Column:
    return _mapped("array<long>", neighbours_of)(cell)


def cover(boxes: DataFrame, level: int, *, lat_min="lat_min", lat_max="lat_max", lon_min="lon_min", lon_max="lon_max") -> DataFrame:
    """(columns of ``boxes``, cell): all cells of a level that meet each box, found from above without probing points.

    From the twelve cells of level 0 down, cells that can reach the box are replaced by their children; at the end those whose
    outline or inside meets the box stay. The work grows with the cells in the box and round its rim.
    """
    spark = boxes.sparkSession
    names = (lat_min, lat_max, lon_min, lon_max)
    columns = [c for c in boxes.columns]
    first = sorted({int(c) for c in cells_at(*_degrees(_solid()[0]).T, 0)})
    start = F.array(*(F.lit(c).cast("long") for c in first))
    rows = boxes.withColumn("cell", F.explode(start))

    def meets(sure: bool):
        @F.pandas_udf("boolean")
        def run(cell: pd.Series, a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
            boxes_ = pd.DataFrame({"a": a, "b": b, "c": c, "d": d}).astype("float64")
            out = np.zeros(len(cell), bool)
            for box, at in boxes_.groupby(["a", "b", "c", "d"], sort=False).indices.items():
                out[at] = touches(cell.to_numpy(np.int64)[at], box, sure)
            return pd.Series(out)

        return run("cell", *(F.col(n).cast("double") for n in names))

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for k in range(1, level + 1):
        rows = rows.where(meets(False)).select(*columns, F.explode(cell_children("cell")).alias("cell"))
        if k % 3 == 0:  # a few cells have become hundreds
            rows = rows.repartition(partitions, "cell")
    return rows.where(meets(True))
