"""Exact inverse geodesic on an ellipsoid: the distance of two places in degrees, for any range.

Longitude differences are mapped to the auxiliary sphere by iteration (all rows
at once).  Where that does not settle - nearly antipodal places - the first
azimuth is found by bisection: the longitude that a geodesic reaches grows with
its azimuth there, and the longitude and the length are integrals that
Gauss-Legendre nodes give to full precision.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from geoqa.functions.crs import WGS84_A, WGS84_F

_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(48)


def inverse(lon1, lat1, lon2, lat2, a: float = WGS84_A, f: float = WGS84_F) -> np.ndarray:
    """Geodesic distances in the unit of ``a``; NaN for places that are none."""
    lon1, lat1, lon2, lat2 = (np.atleast_1d(np.asarray(v, float)) for v in (lon1, lat1, lon2, lat2))
    with np.errstate(all="ignore"):
        ok = np.isfinite(lon1) & np.isfinite(lon2) & (np.abs(lat1) <= 90) & (np.abs(lat2) <= 90)
        L = np.radians(np.abs(np.remainder(lon2 - lon1 + 180.0, 360.0) - 180.0))
        b1, b2 = (np.arctan((1 - f) * np.tan(np.radians(np.where(ok, v, 0.0)))) for v in (lat1, lat2))
        out, settled = _iterated(b1, b2, L, a, f)
    for i in np.flatnonzero(ok & ~settled):
        out[i] = _bisected(float(b1[i]), float(b2[i]), float(L[i]), a, f)
    return np.where(ok, out, np.nan)


def _iterated(b1, b2, L, a, f):
    """(distance, settled) by fixed-point iteration of the longitude on the auxiliary sphere."""
    s1, c1, s2, c2 = np.sin(b1), np.cos(b1), np.sin(b2), np.cos(b2)
    lam = L.copy()
    settled = np.zeros(L.shape, bool)
    for _ in range(60):
        sl, cl = np.sin(lam), np.cos(lam)
        ss = np.hypot(c2 * sl, c1 * s2 - s1 * c2 * cl)
        cs = s1 * s2 + c1 * c2 * cl
        sigma = np.arctan2(ss, cs)
        sa = np.where(ss > 0, c1 * c2 * sl / np.where(ss > 0, ss, 1), 0.0)
        ca2 = 1 - sa * sa
        c2m = np.where(ca2 > 1e-15, cs - 2 * s1 * s2 / np.where(ca2 > 1e-15, ca2, 1), 0.0)
        C = f / 16 * ca2 * (4 + f * (4 - 3 * ca2))
        new = L + (1 - C) * f * sa * (sigma + C * ss * (c2m + C * cs * (2 * c2m * c2m - 1)))
        settled = (np.abs(new - lam) < 1e-14) & (new < np.pi)
        lam = np.where(settled, lam, new)
        if settled.all():
            break
    k2 = ca2 * f * (2 - f) / (1 - f) ** 2
    return _length(sigma, sa, s1, c1, k2, a, f, s2, c2, ss, cs, c2m), settled


def _length(sigma, sa, s1, c1, k2, a, f, s2, c2, ss, cs, c2m):
    A = 1 + k2 / 16384 * (4096 + k2 * (-768 + k2 * (320 - 175 * k2)))
    B = k2 / 1024 * (256 + k2 * (-128 + k2 * (74 - 47 * k2)))
    ds = B * ss * (c2m + B / 4 * (cs * (2 * c2m * c2m - 1) - B / 6 * c2m * (4 * ss * ss - 3) * (4 * c2m * c2m - 3)))
    return a * (1 - f) * A * (sigma - ds)


def _bisected(b1: float, b2: float, L: float, a: float, f: float) -> float:
    """Distance by bisection of the first azimuth."""
    if abs(b1) < abs(b2):
        b1, b2 = b2, b1
    if b1 > 0:
        b1, b2 = -b1, -b2
    b1 = min(b1, -1e-16)
    s1, c1, s2, c2 = np.sin(b1), np.cos(b1), np.sin(b2), np.cos(b2)
    e2 = f * (2 - f) / (1 - f) ** 2

    def path(azimuth: float) -> tuple[float, float]:
        """(longitude reached, length) of the geodesic that leaves at ``azimuth`` and arrives at b2 going north."""
        sa, ca = np.sin(azimuth), np.cos(azimuth)
        s0 = sa * c1
        c0 = np.hypot(ca, sa * s1)
        ca2 = np.sqrt(max(0.0, (ca * c1) ** 2 + (c2 * c2 - c1 * c1))) / c2
        sg1, sg2 = np.arctan2(s1, ca * c1), np.arctan2(s2, ca2 * c2)
        w1, w2 = np.arctan2(s0 * np.sin(sg1), np.cos(sg1)), np.arctan2(s0 * np.sin(sg2), np.cos(sg2))
        k2 = e2 * c0 * c0
        half, mid = (sg2 - sg1) / 2, (sg2 + sg1) / 2
        root = np.sqrt(1 + k2 * np.sin(mid + half * _NODES) ** 2)
        lon = (w2 - w1) - f * s0 * half * float((_WEIGHTS * (2 - f) / (1 + (1 - f) * root)).sum())
        return lon, a * (1 - f) * half * float((_WEIGHTS * root).sum())

    lo, hi = 0.0, np.pi
    for _ in range(200):
        mid = (lo + hi) / 2
        if mid in (lo, hi):
            break
        if path(mid)[0] < L:
            lo = mid
        else:
            hi = mid
    return path((lo + hi) / 2)[1]


@F.pandas_udf(DoubleType())
def geodesic_distance(lon1: pd.Series, lat1: pd.Series, lon2: pd.Series, lat2: pd.Series) -> pd.Series:
    """Exact WGS84 distance in metres; null where a coordinate is null or no place."""
    d = pd.Series(inverse(lon1, lat1, lon2, lat2))
    return d.where(d.notna(), None)
