"""Orbit functions: Tisserand's parameter and elements as columns, positions and velocities for NumPy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from skylattice.functions.sky import AU_KM, DAY_S, ECLIPTIC

#: Fixed values.
A_JUPITER = 5.2044
GM_SUN_KM3_S2 = 1.32712440018e11
#: Earth's orbit for distances between orbits: a (AU), e, inclination, node, argument of perihelion (degrees).
EARTH_J2000 = (1.00000011, 0.01671022, 0.00005, -11.26064, 102.94719)
#: The same with 102.94719 as the longitude of perihelion, which it is for the planet; positions of Earth use this one.
EARTH_MEAN = (1.00000011, 0.01671022, 0.00005, -11.26064, 102.94719 + 11.26064)
GAUSS_K = 0.01720209895
LIGHT_AU_DAY = 173.1446326846693


def semi_major_axis(q: Column, e: Column) -> Column:
    """q / (1 - e); NULL for parabolas."""
    return F.when(e != 1, q / (1 - e))


def tisserand_jupiter(a: Column, e: Column, inc_deg: Column) -> Column:
    """NULL where the orbit is not an ellipse."""
    inside = a / A_JUPITER * (1 - e * e)
    return F.when((a > 0) & (inside >= 0), A_JUPITER / a + 2 * F.cos(F.radians(inc_deg)) * F.sqrt(inside))


def axes(inc: np.ndarray, node: np.ndarray, peri: np.ndarray) -> np.ndarray:
    """Unit vectors to the perihelion and 90 degrees on, shape (..., 2, 3); angles in degrees."""
    i, o, w = (np.radians(np.asarray(x, float)) for x in (inc, node, peri))
    p = [np.cos(o) * np.cos(w) - np.sin(o) * np.sin(w) * np.cos(i), np.sin(o) * np.cos(w) + np.cos(o) * np.sin(w) * np.cos(i), np.sin(w) * np.sin(i)]
    q = [-np.cos(o) * np.sin(w) - np.sin(o) * np.cos(w) * np.cos(i), -np.sin(o) * np.sin(w) + np.cos(o) * np.cos(w) * np.cos(i), np.cos(w) * np.sin(i)]
    return np.stack([np.stack(p, -1), np.stack(q, -1)], -2)


def position(a, e, frame: np.ndarray, anomaly: np.ndarray) -> np.ndarray:
    """Positions (AU) at true anomalies (radians)."""
    r = a * (1 - e * e) / (1 + e * np.cos(anomaly))
    return (r * np.cos(anomaly))[..., None] * frame[..., 0, :] + (r * np.sin(anomaly))[..., None] * frame[..., 1, :]


def velocity(a, e, frame: np.ndarray, anomaly: np.ndarray) -> np.ndarray:
    """Velocities (km/s) at true anomalies (radians)."""
    speed = np.sqrt(GM_SUN_KM3_S2 / (a * (1 - e * e) * AU_KM))
    return (-speed * np.sin(anomaly))[..., None] * frame[..., 0, :] + (speed * (e + np.cos(anomaly)))[..., None] * frame[..., 1, :]


def eccentric_anomaly(mean: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Kepler's equation for ellipses, by Newton steps held to the turn."""
    mean = np.mod(mean + np.pi, 2 * np.pi) - np.pi
    x = mean + e * np.sin(mean)
    for _ in range(50):
        step = (x - e * np.sin(x) - mean) / (1 - e * np.cos(x))
        x = x - np.clip(step, -0.5, 0.5)
        if np.max(np.abs(step), initial=0) < 1e-13:
            break
    return x


def two_body(a, e, inc, node, peri, mean_anomaly_deg, epoch, t) -> tuple[np.ndarray, np.ndarray]:
    """Heliocentric equatorial position (AU) and velocity (AU/day) of ellipses at times t (MJD); NaN for other orbits."""
    a, e = np.asarray(a, float), np.asarray(e, float)
    bad = ~((a > 0) & (e >= 0) & (e < 1))
    a, e = np.where(bad, 1.0, a), np.where(bad, 0.0, e)
    n = GAUSS_K / a**1.5
    x = eccentric_anomaly(np.radians(mean_anomaly_deg) + n * (np.asarray(t, float) - epoch), e)
    f = axes(inc, node, peri)
    b = a * np.sqrt(1 - e * e)
    rate = n / (1 - e * np.cos(x))
    r = (a * (np.cos(x) - e))[..., None] * f[..., 0, :] + (b * np.sin(x))[..., None] * f[..., 1, :]
    v = (-a * np.sin(x) * rate)[..., None] * f[..., 0, :] + (b * np.cos(x) * rate)[..., None] * f[..., 1, :]
    turn = np.array(ECLIPTIC)  # rows are ecliptic axes in equatorial ones, so right multiplication turns back
    r, v = r @ turn, v @ turn
    r[bad], v[bad] = np.nan, np.nan
    return r, v


def earth(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Earth's heliocentric equatorial position (AU) and velocity (AU/day) from its mean orbit."""
    a, e, i, o, w = EARTH_MEAN
    t = np.asarray(t, float)
    one = np.ones_like(t)
    return two_body(a * one, e * one, i * one, o * one, w * one, 357.51716 * one, 51544.5, t)


def kms(v: np.ndarray) -> np.ndarray:
    return v * (AU_KM / DAY_S)
