"""Cells of the globe: exact counts, equal areas, round trips, parents, neighbours and covers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline.functions import globe


def points(n, seed=0):
    v = np.random.default_rng(seed).normal(size=(n, 3))
    return globe._degrees(v / np.linalg.norm(v, axis=1, keepdims=True))


def every_cell(level):
    found = np.unique(globe.cells_at(*globe._degrees(globe._solid()[0]).T, 0))
    for _ in range(level):
        found = np.array(sorted({c for row in globe.children_of(found) for c in row}))
    return found


def area(ring):
    """Area of a polygon on the unit sphere, as triangles from its middle."""
    v = globe._vectors(ring)
    c = v.mean(0) / np.linalg.norm(v.mean(0))
    w = np.roll(v, -1, axis=0)
    top = np.cross(v, w) @ c
    return float(2 * np.arctan2(top, 1 + (v * w).sum(1) + v @ c + w @ c).sum())


def test_projection_round_trip_and_equal_area():
    p = points(20000)
    face, place = globe._project(p[:, 0], p[:, 1])
    back = np.stack(globe._unproject(face, place), 1)
    assert np.abs(globe._vectors(p) - globe._vectors(back)).max() < 1e-13
    # Small circles anywhere have the area they have on the sphere, to first order.
    for lat, lon in p[:40]:
        ring = np.array([(lat + 0.01 * math.sin(a), lon + 0.01 * math.cos(a) / math.cos(math.radians(lat))) for a in np.linspace(0, 2 * math.pi, 60)[:-1]])
        f, z = globe._project(np.append(ring[:, 0], lat), np.append(ring[:, 1], lon))
        if (f == f[-1]).all():
            z = z[:-1]
            flat = abs(0.5 * (z.real * np.roll(z.imag, -1) - np.roll(z.real, -1) * z.imag).sum())
            assert flat / area(ring) == pytest.approx(1, rel=1e-3)


@pytest.mark.parametrize("level", [0, 1, 2, 3, 4])
def test_levels_tile_the_globe(level):
    cells = every_cell(level)
    assert len(cells) == 10 * 7**level + 2
    centre = globe.centres_of(cells)
    assert (globe.cells_at(centre[:, 0], centre[:, 1], level) == cells).all()
    assert set(globe.cells_at(*points(30000).T, level)) <= set(cells.tolist())
    near = dict(zip(cells.tolist(), globe.neighbours_of(cells)))
    assert sum(len(n) == 5 for n in near.values()) == 12 and {len(n) for n in near.values()} <= {5, 6}
    assert all(c in near[n] for c, ns in near.items() for n in ns)
    if level:
        kids = globe.children_of(np.unique(globe.parents_of(cells)))
        assert sorted(c for row in kids for c in row) == sorted(cells.tolist())
        assert (globe.parents_of(cells, 0) == [c if level == 1 else globe.parents_of([c], 0)[0] for c in globe.parents_of(cells)]).all()


def test_areas_are_equal_at_all_latitudes():
    cells = every_cell(4)[::7]
    rings = globe.rings_of(cells, between=16)
    ratio = np.array([area(r) for r in rings]) / globe.area_of_level(4)
    corners = np.array([len(r) for r in globe.rings_of(cells)])
    assert np.allclose(ratio[corners == 6], 1, atol=1e-4)
    assert np.allclose(ratio[corners == 5], 5 / 6, atol=1e-4)
    lat = np.abs(globe.centres_of(cells)[:, 0])
    assert (ratio[(corners == 6) & (lat > 80)].size > 3) and (ratio[(corners == 6) & (lat < 10)].size > 3)


def test_points_lie_within_their_ring_and_reach():
    p = points(400, 3)
    for level in (2, 5, 9):
        cells = globe.cells_at(p[:, 0], p[:, 1], level)
        for (ring, c, x) in zip(globe.rings_of(cells, between=24), globe._vectors(globe.centres_of(cells)), globe._vectors(p)):
            # The outline turns once round the point.
            v = globe._vectors(ring)
            e = np.cross(np.eye(3)[np.abs(x).argmin()], x)
            turn = np.arctan2(v @ np.cross(x, e), v @ e)
            assert abs(((np.diff(turn, append=turn[0]) + math.pi) % (2 * math.pi) - math.pi).sum() - 2 * math.pi) < 1e-6
            assert math.acos(min(1.0, float(c @ x))) < globe.REACH * math.sqrt(globe.area_of_level(level))


def test_descendants_lie_within_reach():
    for c in every_cell(1)[::5]:
        below = np.array([c])
        for _ in range(3):
            below = np.array(sorted({x for row in globe.children_of(below) for x in row}))
        edge = np.concatenate(globe.rings_of(below))
        far = np.arccos(np.clip(globe._vectors(edge) @ globe._vectors(globe.centres_of([c]))[0], -1, 1)).max()
        assert far < globe.REACH * math.sqrt(globe.area_of_level(1))
        assert (globe.parents_of(below, 1) == c).all()


BOXES = [(54.0, 56.0, 9.0, 12.0), (-5.0, 5.0, 175.0, -175.0), (80.0, 90.0, -180.0, 180.0), (-90.0, -85.0, 10.0, 60.0), (10.0, 10.0, 20.0, 20.0), (5.0, 1.0, 0.0, 1.0)]


@pytest.mark.parametrize("level", [2, 4])
def test_cover_of_boxes(spark, level):
    """Every cell that a dense grid of the box meets is in the cover, and every cell of the cover meets the box."""
    boxes = spark.createDataFrame([(i, *b) for i, b in enumerate(BOXES)], "box int, lat_min double, lat_max double, lon_min double, lon_max double")
    found = {}
    for r in globe.cover(boxes, level).collect():
        found.setdefault(r.box, []).append(r.cell)
    for i, (south, north, west, east) in enumerate(BOXES):
        got = set(found.get(i, []))
        assert len(got) == len(found.get(i, []))
        if south > north:
            assert not got
            continue
        width = 360.0 if east - west >= 360 else (east - west) % 360
        lat, lon = (g.ravel() for g in np.meshgrid(np.linspace(south, north, 400), west + np.linspace(0, width, 400)))
        probed = set(globe.cells_at(lat, lon, level).tolist())
        assert probed <= got
        # What the grid missed is touched at its outline only.
        for c in got - probed:
            (ring,) = globe.rings_of([c], between=200)
            off = np.maximum(np.maximum(south - ring[:, 0], ring[:, 0] - north), 0)
            turn = (ring[:, 1] - west) % 360
            beside = np.where(turn <= width, 0, np.minimum(turn - width, 360 - turn)) * np.cos(np.radians(ring[:, 0]))
            assert np.hypot(off, beside).min() < 0.02 * math.degrees(math.sqrt(globe.area_of_level(level)))


def test_columns(spark):
    rows = [(1, 55.0, 10.0), (2, None, 10.0), (3, float("nan"), 1.0), (4, 95.0, 1.0), (5, -90.0, 0.0), (6, 55.0, 370.0)]
    df = spark.createDataFrame(rows, "id int, lat double, lon double").withColumn("cell", globe.global_cell("lat", "lon", 6))
    got = {r.id: r for r in df.select("*", globe.cell_parent("cell").alias("up"), globe.cell_ring("cell").alias("ring"), globe.cell_centre("cell").alias("c"),
                                     globe.cell_neighbours("cell").alias("near"), globe.cell_children("cell").alias("down")).collect()}
    assert [got[i].cell is None for i in range(1, 7)] == [False, True, True, True, False, False]
    assert got[1].cell == got[6].cell and got[2].ring is None and got[2].up is None and got[2].near is None
    assert len(got[1].ring) == 6 and len(got[1].near) == 6 and len(got[1].down) == 7
    assert globe.parents_of(got[1].down).tolist() == [got[1].cell] * 7
    again = df.where("cell is not null").select("cell", globe.cell_centre("cell").alias("c")).select("cell", globe.global_cell(F.col("c")[0], F.col("c")[1], 6).alias("same"))
    assert all(r.cell == r.same for r in again.collect())


def test_every_level_round_trips():
    p = points(300, 9)
    for level in range(globe.FINEST + 1):
        cells = globe.cells_at(p[:, 0], p[:, 1], level)
        assert (cells > 0).all() if level else (cells >= 0).all()
        centre = globe.centres_of(cells)
        assert (globe.cells_at(centre[:, 0], centre[:, 1], level) == cells).all()
        assert (np.unique(globe.unpack(cells)[0]) == [level]).all()
