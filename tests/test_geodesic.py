"""The exact inverse against published lines, and the local metric of the checks against the exact inverse."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoqa.functions import crs
from geoqa.functions.geodesic import inverse


def dms(d, m, s):
    return (abs(d) + m / 60 + s / 3600) * (-1 if d < 0 or str(d) == "-0" else 1)


INTL = (6378388.0, 1 / 297.0)
BESSEL = (6377397.155, 1 / 299.1528128)
# latitude, latitude, longitude difference, distance: long lines published for other ellipsoids, two of them nearly antipodal
LINES = [
    (BESSEL, dms(55, 45, 0), -dms(33, 26, 0), dms(108, 13, 0), 14110526.170),
    (INTL, dms(37, 19, 54.95367), dms(26, 7, 42.83946), dms(41, 28, 35.50729), 4085966.703),
    (INTL, dms(35, 16, 11.24862), dms(67, 22, 14.77638), dms(137, 47, 28.31435), 8084823.839),
    (INTL, 1.0, -dms(0, 59, 53.83076), dms(179, 17, 48.02997), 19960000.000),
    (INTL, 1.0, dms(1, 1, 15.18952), dms(179, 46, 17.84244), 19780006.558),
]


@pytest.mark.parametrize("ellipsoid, lat1, lat2, lon, metres", LINES)
def test_published_lines(ellipsoid, lat1, lat2, lon, metres):
    assert abs(inverse(0, lat1, lon, lat2, *ellipsoid)[0] - metres) < 1.5e-3
    assert abs(inverse(lon, lat2, 0, lat1, *ellipsoid)[0] - metres) < 1.5e-3


def test_wgs84_lines():
    got = inverse([-73.8, 0, 0, 3, 7, 0], [40.6, 0, 0, 0, 45, 0], [-0.5, 1, 0, 3, 7, 180], [51.6, 0, 90, 1, 45, 0])
    want = [5551759.400, 111319.4908, 10001965.7293, 110574.3886, 0.0, 20003931.4586]
    assert np.abs(got - want).max() < 1e-3
    assert np.isnan(inverse(0, 91, 0, 0)[0]) and np.isnan(inverse(np.nan, 0, 0, 0)[0])


def test_short_lines_against_the_arc_of_the_meridian():
    """At 0, 45 and 84 degrees: metres along the meridian by numerical integration."""
    nodes, weights = np.polynomial.legendre.leggauss(40)
    for lat in (0.0, 45.0, 84.0):
        for step in (1e-5, 0.01, 1.0):
            phi = np.radians(lat + step * (nodes + 1) / 2)
            m = crs.WGS84_A * (1 - crs.WGS84_E2) / (1 - crs.WGS84_E2 * np.sin(phi) ** 2) ** 1.5
            assert abs(inverse(5, lat, 5, lat + step)[0] - (weights * m).sum() * np.radians(step) / 2) < 1e-6


def test_bisection_agrees_with_iteration():
    from geoqa.functions import geodesic as D
    r = np.random.default_rng(1)
    lat1, lat2, lon = r.uniform(-89, 89, 200), r.uniform(-89, 89, 200), r.uniform(0, 170, 200)
    b = [np.arctan((1 - crs.WGS84_F) * np.tan(np.radians(v))) for v in (lat1, lat2)]
    slow = [D._bisected(x, y, z, crs.WGS84_A, crs.WGS84_F) for x, y, z in zip(*b, np.radians(lon))]
    assert np.abs(np.array(slow) - inverse(0, lat1, lon, lat2)).max() < 1e-3


def test_error_of_the_local_metric(spark):
    """The formula of the checks: less than 1 mm up to 1 km, less than 1 m in 10 km, up to 85 degrees."""
    r = np.random.default_rng(2)
    n = 3000
    lat, lon = r.uniform(-85, 85, n), r.uniform(-180, 180, n)
    for reach, most in ((1000.0, 1e-3), (10_000.0, 1.0)):
        angle, d = r.uniform(0, 2 * np.pi, n), r.uniform(0, reach, n)
        lat2 = lat + np.degrees(d * np.sin(angle) / 6.4e6)
        lon2 = lon + np.degrees(d * np.cos(angle) / (6.4e6 * np.cos(np.radians(lat))))
        df = spark.createDataFrame([tuple(map(float, v)) for v in zip(lon, lat, lon2, lat2)], "a double, b double, c double, d double")
        local = np.array([x[0] for x in df.select(F.expr(crs.geo_distance("a", "b", "c", "d"))).collect()])
        assert np.abs(local - inverse(lon, lat, lon2, lat2)).max() < most
