"""Geodesics against published distances, against each other, and against the sphere."""

import math

import numpy as np
import pytest

from wakeline.functions import geo, geodesic

# Published test distances in metres (Rapp, Vincenty, Karney), WGS-84.
KNOWN = [
    (40.6, -73.8, 51.6, -0.5, 5551759.400319),
    (0.0, 0.0, 0.5, 179.5, 19936288.579),
    (0.0, 0.0, 0.5, 179.7, 19944127.421),
    (-30.0, 0.0, 29.9, 179.8, 19989832.82761),
    (90.0, 0.0, -90.0, 0.0, 20003931.4586),
    (0.0, 0.0, 0.0, 90.0, 10018754.1714),
    (0.0, 0.0, 90.0, 0.0, 10001965.7293),
    (0.0, 0.0, 1.0, 0.0, 110574.3886),
]


@pytest.mark.parametrize("known", KNOWN)
def test_known_distances_to_a_millimetre(known):
    for sign in (1, -1):
        for shift in (0.0, 77.0, -190.0):
            a, b, c, d, metres = known
            points = (sign * a, b + shift, sign * c, d + shift)
            assert geodesic.metres(*points)[0] == pytest.approx(metres, abs=1e-3)
            assert geodesic.metres(*points[2:], *points[:2])[0] == pytest.approx(metres, abs=1e-3)


def vincenty(lat1, lon1, lat2, lon2):
    """The usual iteration, for points that are not nearly antipodal."""
    a, f = 6378137.0, 1 / 298.257223563
    b = a * (1 - f)
    u1, u2 = (math.atan((1 - f) * math.tan(math.radians(v))) for v in (lat1, lat2))
    span = lam = math.radians(lon2 - lon1)
    for _ in range(200):
        ss = math.hypot(math.cos(u2) * math.sin(lam), math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam))
        if ss == 0:
            return 0.0
        cs = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        sg = math.atan2(ss, cs)
        sa = math.cos(u1) * math.cos(u2) * math.sin(lam) / ss
        c2 = 1 - sa * sa
        mid = cs - 2 * math.sin(u1) * math.sin(u2) / c2 if c2 else 0.0
        k = f / 16 * c2 * (4 + f * (4 - 3 * c2))
        new = span + (1 - k) * f * sa * (sg + k * ss * (mid + k * cs * (2 * mid * mid - 1)))
        if abs(new - lam) < 1e-13:
            break
        lam = new
    w = c2 * (a * a - b * b) / (b * b)
    p = 1 + w / 16384 * (4096 + w * (-768 + w * (320 - 175 * w)))
    r = w / 1024 * (256 + w * (-128 + w * (74 - 47 * w)))
    return b * p * (sg - r * ss * (mid + r / 4 * (cs * (2 * mid * mid - 1) - r / 6 * mid * (4 * ss * ss - 3) * (4 * mid * mid - 3))))


def test_as_the_usual_iteration_where_that_settles():
    rng = np.random.default_rng(2)
    p = np.stack((rng.uniform(-89, 89, 600), rng.uniform(-180, 180, 600), rng.uniform(-89, 89, 600), rng.uniform(-180, 180, 600)))
    p[2:, :200] = p[:2, :200] + rng.normal(size=(2, 200)) * 1e-3  # a few hundred metres
    p = p[:, np.abs(p[2]) < 89]
    away = np.abs((p[3] - p[1] + 180) % 360 - 180) < 160
    got = geodesic.metres(*p[:, away])
    # The iteration cuts its series after the third order: a tenth of a millimetre.
    assert np.allclose(got, [vincenty(*v) for v in p[:, away].T], atol=5e-4, rtol=0)


def test_antipodes_and_triangles():
    rng = np.random.default_rng(8)
    lat, lon = rng.uniform(-90, 90, 400), rng.uniform(-180, 180, 400)
    half = 20003931.458625447
    opposite = geodesic.metres(lat, lon, -lat, lon + 180)
    assert np.allclose(opposite, half, atol=1e-4)  # any point's antipode is half a meridian away
    near = geodesic.metres(lat, lon, -lat + rng.normal(size=400) * 0.3, lon + 180 + rng.normal(size=400) * 0.3)
    assert (near[np.isfinite(near)] <= half + 1e-3).all() and (near[np.isfinite(near)] > half - 150_000).all()
    # No way over a third point is shorter.
    a, b = rng.uniform(-80, 80, 400), rng.uniform(-180, 180, 400)
    whole = geodesic.metres(lat, lon, -lat * 0.99, lon + 179.6)
    assert (whole <= geodesic.metres(lat, lon, a, b) + geodesic.metres(a, b, -lat * 0.99, lon + 179.6) + 1e-3).all()


def test_equator_same_point_and_missing():
    assert geodesic.metres(0, 0, 0, 179.3)[0] == pytest.approx(6378137.0 * math.radians(179.3), abs=1e-6)
    assert geodesic.metres(0, 0, 0, 179.9)[0] < 6378137.0 * math.radians(179.9) - 1000  # shorter over higher latitudes
    assert geodesic.metres([10.0, -90.0, 0.0], [20.0, 5.0, 0.0], [10.0, -90.0, 0.0], [20.0, 77.0, 360.0]) == pytest.approx([0, 0, 0], abs=1e-6)
    assert np.isnan(geodesic.metres([np.nan, 91.0, 0.0], [0, 0, 0], [0, 0, 0], [0.0, 0.0, np.inf])).all()
    assert len(geodesic.metres([], [], [], [])) == 0


def test_column(spark):
    rows = [(0.0, 0.0, 0.5, 179.7), (None, 1.0, 2.0, 3.0), (55.0, 10.0, 55.0, 10.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(geo.ellipsoidal_nm("a", "b", "c", "d")).collect()]
    assert got[0] == pytest.approx(19944127.421 / 1852, abs=1e-6) and got[1] is None and got[2] == 0
