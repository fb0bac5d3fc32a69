"""Sky geometry in column expressions; angles in degrees, vectors as three columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

OBLIQUITY_DEG = 23.4392911
#: Rotation from ICRS to galactic axes (J2000).
GALACTIC = (
    (-0.0548755604, -0.8734370902, -0.4838350155),
    (0.4941094279, -0.4448296300, 0.7469822445),
    (-0.8676661490, -0.1980763734, 0.4559837762),
)
_c, _s = math.cos(math.radians(OBLIQUITY_DEG)), math.sin(math.radians(OBLIQUITY_DEG))
ECLIPTIC = ((1.0, 0.0, 0.0), (0.0, _c, _s), (0.0, -_s, _c))
AU_KM = 149597870.7
DAY_S = 86400.0

Vector = tuple[Column, Column, Column]


def dot(a: Vector, b: Vector) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def norm(a: Vector) -> Column:
    return F.sqrt(dot(a, a))


def minus(a: Vector, b: Vector) -> Vector:
    return a[0] - b[0], a[1] - b[1], a[2] - b[2]


def clip(c: Column, low: float = -1.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def range_rate(x: Vector, v: Vector) -> Column:
    """Velocity along the line of sight; NULL at distance 0."""
    r = norm(x)
    return F.when(r > 0, dot(x, v) / r)


def wrap(degrees: Column) -> Column:
    """Into [0, 360)."""
    return F.pmod(degrees, F.lit(360.0))


def wrap_difference(degrees: Column) -> Column:
    """Into [-180, 180); a turn is added whatever the sign, as in SQL: pmod adds it to negative angles only, which rounds otherwise in the last bits."""
    return ((degrees + 180.0) % 360.0 + 360.0) % 360.0 - 180.0


def separation(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle distance, exact at all distances."""
    d, p, q = F.radians(ra2 - ra1), F.radians(dec1), F.radians(dec2)
    y = F.sqrt(F.pow(F.cos(q) * F.sin(d), F.lit(2)) + F.pow(F.cos(p) * F.sin(q) - F.sin(p) * F.cos(q) * F.cos(d), F.lit(2)))
    return F.degrees(F.atan2(y, F.sin(p) * F.sin(q) + F.cos(p) * F.cos(q) * F.cos(d)))


def unit_vector(lon: Column, lat: Column) -> Vector:
    a, b = F.radians(lon), F.radians(lat)
    return F.cos(b) * F.cos(a), F.cos(b) * F.sin(a), F.sin(b)


def rotate(v: Vector, matrix) -> Vector:
    return tuple(v[0] * float(m[0]) + v[1] * float(m[1]) + v[2] * float(m[2]) for m in matrix)


def lon_lat(v: Vector) -> tuple[Column, Column]:
    return wrap(F.degrees(F.atan2(v[1], v[0]))), F.degrees(F.asin(clip(v[2])))


def ecliptic(ra: Column, dec: Column) -> tuple[Column, Column]:
    return lon_lat(rotate(unit_vector(ra, dec), ECLIPTIC))


def galactic(ra: Column, dec: Column) -> tuple[Column, Column]:
    return lon_lat(rotate(unit_vector(ra, dec), GALACTIC))


def tangent_offsets(ra: Column, dec: Column, ra0: Column, dec0: Column) -> tuple[Column, Column]:
    """Offsets of (ra, dec) on the plane that touches the sphere at (ra0, dec0); NULL beyond 90 degrees."""
    d, p, p0 = F.radians(ra - ra0), F.radians(dec), F.radians(dec0)
    c = F.sin(p0) * F.sin(p) + F.cos(p0) * F.cos(p) * F.cos(d)
    x, y = F.cos(p) * F.sin(d), F.cos(p0) * F.sin(p) - F.sin(p0) * F.cos(p) * F.cos(d)
    return F.when(c > 0, F.degrees(x / c)), F.when(c > 0, F.degrees(y / c))


def oc_offsets(ra: Column, dec: Column, eph_ra: Column, eph_dec: Column) -> tuple[Column, Column, Column]:
    """Observed minus predicted in arcseconds: along right ascension (with the cosine), declination, and in all."""
    return wrap_difference(ra - eph_ra) * F.cos(F.radians(eph_dec)) * 3600, (dec - eph_dec) * 3600, separation(ra, dec, eph_ra, eph_dec) * 3600


def track_offsets(d_ra: Column, d_dec: Column, rate_ra: Column, rate_dec: Column) -> tuple[Column, Column]:
    """Offsets along and across the direction of motion; NULL without motion."""
    rate = F.sqrt(rate_ra * rate_ra + rate_dec * rate_dec)
    return F.when(rate > 0, (d_ra * rate_ra + d_dec * rate_dec) / rate), F.when(rate > 0, (d_dec * rate_ra - d_ra * rate_dec) / rate)


def phase_angle(obj: Vector, observer: Vector) -> Column:
    """Angle at the object between the Sun and the observer; both vectors from the Sun."""
    to_observer = minus(observer, obj)
    scale = norm(obj) * norm(to_observer)
    return F.when(scale > 0, F.degrees(F.acos(clip(-dot(obj, to_observer) / scale))))


def sun_position(mjd: Column) -> tuple[Column, Column]:
    """The Sun's apparent right ascension and declination seen from Earth, to about 0.01 degrees."""
    n = mjd - 51544.5
    g = F.radians(357.528 + 0.9856003 * n)
    lon = 280.460 + 0.9856474 * n + 1.915 * F.sin(g) + 0.020 * F.sin(2 * g)
    e = F.radians(23.439 - 0.0000004 * n)
    lon = F.radians(lon)
    return wrap(F.degrees(F.atan2(F.cos(e) * F.sin(lon), F.cos(lon)))), F.degrees(F.asin(F.sin(e) * F.sin(lon)))


def elongation(ra: Column, dec: Column, mjd: Column) -> Column:
    """Angle between a direction and the Sun, seen from Earth."""
    return separation(ra, dec, *sun_position(mjd))
