"""Coordinate systems and geodesic measures as SQL expression text.

Only the two systems the checks use exist here: WGS84 degrees (EPSG:4326)
and web Mercator metres (EPSG:3857, also known as 900913).
"""

from __future__ import annotations

# Fixed values (WGS84 ellipsoid, web Mercator sphere radius, geohash alphabet).
R_MERCATOR = 6378137.0
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
WGS84_E2 = WGS84_F * (2 - WGS84_F)
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def lon_of(x: str) -> str:
    """Mercator x -> longitude (degrees)."""
    return f"degrees(cast({x} AS double) / {R_MERCATOR})"


def lat_of(y: str) -> str:
    """Mercator y -> latitude (degrees)."""
    return f"degrees(2 * atan(exp(cast({y} AS double) / {R_MERCATOR})) - pi() / 2)"


def merc_x(lon: str) -> str:
    return f"({R_MERCATOR} * radians(cast({lon} AS double)))"


def merc_y(lat: str) -> str:
    return f"({R_MERCATOR} * ln(tan(pi() / 4 + radians(cast({lat} AS double)) / 2)))"


def _w(phi_rad: str) -> str:
    return f"(1 - {WGS84_E2} * sin({phi_rad}) * sin({phi_rad}))"


def meridional_radius(phi_rad: str) -> str:
    """M(phi): metres per radian of latitude."""
    return f"({WGS84_A * (1 - WGS84_E2)} / power({_w(phi_rad)}, 1.5))"


def normal_radius(phi_rad: str) -> str:
    """N(phi): metres per radian of longitude at the equator of phi's parallel."""
    return f"({WGS84_A} / sqrt({_w(phi_rad)}))"


def geo_distance(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """Geodesic distance in metres, local tangent metric on the WGS84 ellipsoid.

    For the short ranges the checks test (metres to a few km): against the exact inverse
    (``functions.geodesic``) it is off by less than 1 mm up to 1 km at any latitude below 85 degrees.
    """
    phi = f"radians((cast({lat1} AS double) + cast({lat2} AS double)) / 2)"
    dn = f"({meridional_radius(phi)} * radians(cast({lat2} AS double) - cast({lat1} AS double)))"
    de = f"({normal_radius(phi)} * cos({phi}) * radians(cast({lon2} AS double) - cast({lon1} AS double)))"
    return f"sqrt({dn} * {dn} + {de} * {de})"


def scale_e(y: str) -> str:
    """Ground metres per Mercator unit along x at Mercator ordinate y."""
    phi = f"radians({lat_of(y)})"
    return f"({normal_radius(phi)} * cos({phi}) / {R_MERCATOR})"


def scale_n(y: str) -> str:
    """Ground metres per Mercator unit along y at Mercator ordinate y."""
    phi = f"radians({lat_of(y)})"
    return f"({meridional_radius(phi)} * cos({phi}) / {R_MERCATOR})"


def _geohash_codes(lon: str, lat: str, lon_bits: int, lat_bits: int) -> tuple[str, str]:
    """Longitude and latitude as whole numbers of so many bits, by ``floor``."""
    return (f"least(cast(floor((cast({lon} AS double) + 180.0) / 360.0 * {float(2 ** lon_bits)}) AS bigint), {2 ** lon_bits - 1})",
            f"least(cast(floor((cast({lat} AS double) + 90.0) / 180.0 * {float(2 ** lat_bits)}) AS bigint), {2 ** lat_bits - 1})")


def _geohash_text(code, precision: int, lon_bits: int, lat_bits: int) -> str:
    """The letters: bits interleaved (longitude first), five at a time; ``code(k, at)`` is the bit at a place from the top."""
    def bit(k: int) -> str:
        return code("lon", lon_bits - 1 - k // 2) if k % 2 == 0 else code("lat", lat_bits - 1 - k // 2)

    chars = []
    for i in range(precision):
        v = " + ".join(f"{bit(5 * i + j)} * {2 ** (4 - j)}" for j in range(5))
        chars.append(f"substr('{GEOHASH_ALPHABET}', cast({v} AS int) + 1, 1)")
    return "concat(" + ", ".join(chars) + ")"


def geohash(lon: str, lat: str, precision: int = 20) -> str:
    """Geohash text of a WGS84 point (``precision`` characters, <= 20), as Spark SQL.

    The two numbers are computed once and bound; each letter takes its bits from them by shifts.
    """
    lon_bits, lat_bits = (5 * precision + 1) // 2, 5 * precision // 2
    a, b = _geohash_codes(lon, lat, lon_bits, lat_bits)
    text = _geohash_text(lambda k, at: f"(shiftright(g_.{k}, {at}) & 1)", precision, lon_bits, lat_bits)
    return f"element_at(transform(array(named_struct('lon', {a}, 'lat', {b})), g_ -> {text}), 1)"


def geohash_ansi(lon: str, lat: str, precision: int = 20) -> str:
    """The same in plain SQL, bit by bit with divisions (for oracles)."""
    lon_bits, lat_bits = (5 * precision + 1) // 2, 5 * precision // 2
    codes = dict(zip(("lon", "lat"), _geohash_codes(lon, lat, lon_bits, lat_bits)))
    return _geohash_text(lambda k, at: f"(cast(floor(cast({codes[k]} AS double) / {float(2 ** at)}) AS bigint) % 2)", precision, lon_bits, lat_bits)
