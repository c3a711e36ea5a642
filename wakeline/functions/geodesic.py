"""Shortest way on the WGS-84 ellipsoid between any two points, nearly antipodal ones included.

With the points put in order (the first south of the equator and no nearer to it than the second), the longitude that a geodesic
from the first has gained where it meets the second's latitude rises with its azimuth, from 0 due north to half a turn due
south. So the azimuth that meets the second point is bracketed, whatever the points: Newton's steps on it, held inside the
bracket, always converge. Way and longitude are integrals of smooth functions along the great circle on the auxiliary sphere
(Bessel's), taken by Gauss's quadrature; no series is cut off.
"""

from __future__ import annotations

import numpy as np

# WGS-84 axis in metres, flattening.
MAJOR = 6378137.0
FLAT = 1.0 / 298.257223563

#: Points of the quadrature over at most half a turn; the integrands differ from a constant by less than 0.4 %.
NODES = 20
STEPS = 60
_AT, _WEIGHT = np.polynomial.legendre.leggauss(NODES)
#: Stands for the equator, so that a way due east on it is told from one that leaves it.
_TINY = 1e-150


def _ways(alpha, sin_b1, cos_b1, sin_b2, cos_b2, wanted_length=False):
    """Longitude gained (and way, in metres) up to the second latitude by the geodesic of azimuth ``alpha``."""
    sin_a, cos_a = np.sin(alpha), np.cos(alpha)
    sin_0 = sin_a * cos_b1
    cos_0 = np.hypot(cos_a, sin_a * sin_b1)
    # The azimuth at the second latitude, on the way north.
    far = np.maximum((cos_a * cos_b1) ** 2 + np.where(cos_b1 < -sin_b1, (cos_b2 - cos_b1) * (cos_b1 + cos_b2), (sin_b1 - sin_b2) * (sin_b1 + sin_b2)), 0.0)
    north = np.sqrt(far)
    start, stop = np.arctan2(sin_b1, cos_a * cos_b1), np.arctan2(sin_b2, north)
    turn_1, turn_2 = np.arctan2(sin_0 * sin_b1, cos_a * cos_b1), np.arctan2(sin_0 * sin_b2, north)
    k2 = FLAT * (2 - FLAT) / (1 - FLAT) ** 2 * cos_0**2
    half = (stop - start) / 2
    sigma = (start + stop)[:, None] / 2 + half[:, None] * _AT
    root = np.sqrt(1 + k2[:, None] * np.sin(sigma) ** 2)
    gained = (turn_2 - turn_1) - FLAT * sin_0 * half * (((2 - FLAT) / (1 + (1 - FLAT) * root)) @ _WEIGHT)
    return (gained, MAJOR * (1 - FLAT) * half * (root @ _WEIGHT)) if wanted_length else gained


def metres(lat1, lon1, lat2, lon2) -> np.ndarray:
    """Length of the shortest geodesic; NaN where a number is missing or no latitude."""
    lat1, lon1, lat2, lon2 = (np.asarray(v, np.float64).ravel() for v in np.broadcast_arrays(lat1, lon1, lat2, lon2))
    out = np.full(len(lat1), np.nan)
    good = np.isfinite(lat1) & np.isfinite(lon1) & np.isfinite(lat2) & np.isfinite(lon2) & (np.abs(lat1) <= 90) & (np.abs(lat2) <= 90)
    if not good.any():
        return out
    p, q = lat1[good], lat2[good]
    span = np.radians(np.abs((lon2[good] - lon1[good] + 180.0) % 360.0 - 180.0))
    swap = np.abs(p) < np.abs(q)
    p, q = np.where(swap, q, p), np.where(swap, p, q)
    up = p > 0
    p, q = np.where(up, -p, p), np.where(up, -q, q)
    b1, b2 = (np.arctan2((1 - FLAT) * np.sin(np.radians(v)), np.cos(np.radians(v))) for v in (p, q))
    sin_b1, cos_b1 = np.minimum(np.sin(b1), -_TINY), np.maximum(np.cos(b1), _TINY)
    sin_b2, cos_b2 = np.sin(b2), np.maximum(np.cos(b2), _TINY)
    equator = p == 0
    sin_b2 = np.where(equator, _TINY, sin_b2)
    low, high = np.zeros(len(p)), np.full(len(p), np.pi)
    # The great circle's azimuth is the first guess.
    guess = np.arctan2(cos_b2 * np.sin(span), cos_b1 * sin_b2 - sin_b1 * cos_b2 * np.cos(span))
    alpha = np.clip(guess, 1e-12, np.pi - 1e-12)
    todo = np.arange(len(p))
    for _ in range(STEPS):
        args = (sin_b1[todo], cos_b1[todo], sin_b2[todo], cos_b2[todo])
        miss = _ways(alpha[todo], *args) - span[todo]
        low[todo] = np.where(miss < 0, alpha[todo], low[todo])
        high[todo] = np.where(miss >= 0, alpha[todo], high[todo])
        # The slope by a small step inside the bracket.
        step = np.minimum(1e-6, (high[todo] - low[todo]) / 4)
        back = np.where(alpha[todo] + step <= high[todo], step, -step)
        slope = (_ways(alpha[todo] + back, *args) - span[todo] - miss) / np.where(back == 0, 1.0, back)
        new = alpha[todo] - miss / np.where(slope > 0, slope, np.inf)
        middle = (low[todo] + high[todo]) / 2
        new = np.where((new > low[todo]) & (new < high[todo]) & (slope > 0), new, middle)
        moved = np.abs(new - alpha[todo])
        alpha[todo] = new
        todo = todo[(moved > 1e-14) & (high[todo] - low[todo] > 1e-15)]
        if not len(todo):
            break
    _, length = _ways(alpha, sin_b1, cos_b1, sin_b2, cos_b2, True)
    # Along the equator, as far as no way round is shorter; along a meridian there is nothing to look for.
    length = np.where(equator & (span <= (1 - FLAT) * np.pi), MAJOR * span, length)
    along = span == 0
    if along.any():
        length[along] = _meridian(b1[along], b2[along])
    out[good] = length
    return out


def _meridian(b1, b2):
    """Way along a meridian between reduced latitudes."""
    e2 = FLAT * (2 - FLAT) / (1 - FLAT) ** 2
    half = (b2 - b1) / 2
    sigma = (b1 + b2)[:, None] / 2 + half[:, None] * _AT
    return MAJOR * (1 - FLAT) * np.abs(half) * (np.sqrt(1 + e2 * np.sin(sigma) ** 2) @ _WEIGHT)
