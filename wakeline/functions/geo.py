"""Angles, distances and hexagonal cells as expressions."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline.functions import geodesic
from wakeline.functions.timeops import col

# Earth radius in nautical miles, metres per mile.
EARTH_RADIUS_NM = 3440.065
METRES_PER_NM = 1852.0

# Reference latitude and cell size of the hexagonal grid, in degrees.
GRID_LATITUDE = 60.0
CELL_SIZE = 0.6


def alignment_factor(heading: str | Column, wind: str | Column) -> Column:
    """Signed angle from heading to wind as a fraction of a half turn, in [-1, 1]."""
    diff = F.pmod(col(wind), F.lit(360.0)) - F.pmod(col(heading), F.lit(360.0))
    wrapped = F.when(diff > 180, diff - 360).when(diff < -180, diff + 360).otherwise(diff)
    return wrapped / 180


def cos_degrees(angle: str | Column) -> Column:
    return F.cos(F.radians(col(angle)))


def haversine_nm(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in nautical miles."""
    a = F.pow(F.sin(F.radians(col(lat2) - col(lat1)) / 2), 2) + F.cos(F.radians(col(lat1))) * F.cos(
        F.radians(col(lat2))
    ) * F.pow(F.sin(F.radians(col(lon2) - col(lon1)) / 2), 2)
    # Not least(): that skips nulls, and an unknown position would be far away.
    return F.lit(2 * EARTH_RADIUS_NM) * F.asin(F.sqrt(F.when(a > 1, 1.0).otherwise(a)))


def ellipsoidal_nm(lat1, lon1, lat2, lon2) -> Column:
    """WGS-84 distance in nautical miles, for any two points (:mod:`wakeline.functions.geodesic`), Arrow-batched."""

    @F.pandas_udf("double")
    def distance(a1: pd.Series, o1: pd.Series, a2: pd.Series, o2: pd.Series) -> pd.Series:
        columns = (s.to_numpy(dtype="float64", na_value=float("nan")) for s in (a1, o1, a2, o2))
        out = pd.Series(geodesic.metres(*columns) / METRES_PER_NM)
        return out.where(out.notna(), None).astype("float64")

    return distance(col(lat1), col(lon1), col(lat2), col(lon2))


def _cube_round(q: Column, r: Column) -> tuple[Column, Column]:
    s = -q - r
    rq, rr, rs = F.round(q), F.round(r), F.round(s)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    fixed_q = F.when((dq > dr) & (dq > ds), -rr - rs).otherwise(rq)
    fixed_r = F.when((dq > dr) & (dq > ds), rr).when(dr > ds, -rq - rs).otherwise(rr)
    return fixed_q.cast("bigint"), fixed_r.cast("bigint")


def hex_axial(lat, lon, size: float = CELL_SIZE, grid_latitude: float = GRID_LATITUDE):
    """Axial (q, r) of the pointy-top hexagon holding a position.

    A flat grid scaled at one latitude; ids are not those of any global grid.
    """
    x = col(lon) * F.lit(math.cos(math.radians(grid_latitude)))
    q = (F.lit(math.sqrt(3.0) / 3) * x - col(lat) / F.lit(3.0)) / F.lit(size)
    r = F.lit(2.0 / 3) * col(lat) / F.lit(size)
    return _cube_round(q, r)


def hex_cell(lat, lon, size: float = CELL_SIZE, grid_latitude: float = GRID_LATITUDE) -> Column:
    """Cell id ``q:r``; null where the position is null."""
    q, r = hex_axial(lat, lon, size, grid_latitude)
    return F.concat(q.cast("string"), F.lit(":"), r.cast("string"))


def hex_boundary(cell, size: float = CELL_SIZE, grid_latitude: float = GRID_LATITUDE) -> Column:
    """The six corners of a cell as an array of (lat, lon)."""
    parts = F.split(col(cell), ":")
    q, r = parts[0].cast("double"), parts[1].cast("double")
    stretch = math.cos(math.radians(grid_latitude))
    x = F.lit(size * math.sqrt(3.0)) * (q + r / 2)
    y = F.lit(size * 1.5) * r

    def corner(i: Column) -> Column:
        angle = F.radians(F.lit(60.0) * i - F.lit(30.0))
        return F.struct(
            (y + F.lit(size) * F.sin(angle)).alias("lat"),
            ((x + F.lit(size) * F.cos(angle)) / F.lit(stretch)).alias("lon"),
        )

    return F.transform(F.sequence(F.lit(0), F.lit(5)), corner)
