"""Magnitudes and phase curves as column expressions, and the same curves for NumPy."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Zero point of nJy magnitudes and the factor of their errors.
NJY_ZERO_POINT = 31.4
MAG_ERR_FACTOR = 1.085736

# The two-term phase function (HG) with its small-angle blend.
HG_A = (3.332, 1.862)
HG_B = (0.631, 1.218)
HG_C = (0.986, 0.238)

# Knots (degrees), values and end slopes (per radian) of the three basis functions.
PHI12_DEG = (7.5, 30.0, 60.0, 90.0, 120.0, 150.0)
PHI1 = (7.5e-1, 3.3486016e-1, 1.3410560e-1, 5.1104756e-2, 2.1465687e-2, 3.6396989e-3)
PHI1_SLOPES = (-1.9098593, -9.1328612e-2)
PHI2 = (9.25e-1, 6.2884169e-1, 3.1755495e-1, 1.2716367e-1, 2.2373903e-2, 1.6505689e-4)
PHI2_SLOPES = (-5.7295780e-1, -8.6573138e-8)
PHI3_DEG = (0.0, 0.3, 1.0, 2.0, 4.0, 8.0, 12.0, 20.0, 30.0)
PHI3 = (1.0, 8.3381185e-1, 5.7735424e-1, 4.2144772e-1, 2.3174230e-1, 1.0348178e-1, 6.1733473e-2, 1.6107006e-2, 0.0)
PHI3_SLOPES = (-1.0630097, 0.0)

# Fixed values: (slope, intercept) of G1 and G2 in G12 from 0.2 on and below it, and of the starred form.
G12_HIGH = ((0.9529, 0.02162), (-0.6125, 0.5572))
G12_LOW = ((0.7527, 0.06164), (-0.9612, 0.6270))
G12_STAR = ((0.84293649, 0.0), (-0.53513350, 0.53513350))


def clamped_spline(knots: np.ndarray, values: np.ndarray, slopes: tuple[float, float]) -> np.ndarray:
    """Coefficients, highest power first, of each interval's cubic in (x - left knot); first derivatives are given at the ends."""
    h, dy = np.diff(knots), np.diff(values) / np.diff(knots)
    n = len(knots)
    system, right = np.zeros((n, n)), np.zeros(n)
    system[0, 0] = system[-1, -1] = 1
    right[0], right[-1] = slopes
    for k in range(1, n - 1):  # continuous second derivatives
        system[k, k - 1 : k + 2] = h[k], 2 * (h[k - 1] + h[k]), h[k - 1]
        right[k] = 3 * (h[k] * dy[k - 1] + h[k - 1] * dy[k])
    d = np.linalg.solve(system, right)
    return np.stack([(d[:-1] + d[1:] - 2 * dy) / h**2, (3 * dy - 2 * d[:-1] - d[1:]) / h, d[:-1], values[:-1]], 1)


_X12, _X3 = np.radians(PHI12_DEG), np.radians(PHI3_DEG)
SPLINES = {
    1: (_X12, clamped_spline(_X12, np.array(PHI1), PHI1_SLOPES)),
    2: (_X12, clamped_spline(_X12, np.array(PHI2), PHI2_SLOPES)),
    3: (_X3, clamped_spline(_X3, np.array(PHI3), PHI3_SLOPES)),
}


def _piecewise(x: Column, knots: np.ndarray, coefficients: np.ndarray) -> Column:
    """The spline at x; beyond the last knot its last cubic goes on."""
    out, following = None, None
    for left, c in reversed(list(zip(knots, coefficients.tolist(), strict=False))):
        t = x - float(left)
        value = ((F.lit(c[0]) * t + c[1]) * t + c[2]) * t + c[3]
        out = value if out is None else F.when(x >= following, out).otherwise(value)
        following = float(left)
    return out


def phi(n: int, phase: Column) -> Column:
    """The n-th basis function of the three-term phase function; phase in radians."""
    spline = _piecewise(phase, *SPLINES[n])
    if n == 3:
        return F.when(phase > math.pi / 6, F.lit(0.0)).otherwise(spline)
    near = 1 - phase * (6 / math.pi if n == 1 else 9 / (5 * math.pi))
    return F.when(phase < float(_X12[0]), near).otherwise(spline)


def phi_array(n: int, phase: np.ndarray) -> np.ndarray:
    knots, c = SPLINES[n]
    k = np.clip(np.searchsorted(knots, phase, "right") - 1, 0, len(c) - 1)
    t = phase - knots[k]
    spline = ((c[k, 0] * t + c[k, 1]) * t + c[k, 2]) * t + c[k, 3]
    if n == 3:
        return np.where(phase > math.pi / 6, 0.0, spline)
    return np.where(phase < _X12[0], 1 - phase * (6 / math.pi if n == 1 else 9 / (5 * math.pi)), spline)


def njy_to_mag(flux: Column) -> Column:
    """AB magnitude of a flux in nJy; NULL where the flux is not positive."""
    return F.when(flux > 0, NJY_ZERO_POINT - 2.5 * F.log10(flux))


def njy_err_to_mag_err(flux: Column, err: Column) -> Column:
    return F.when(flux != 0, MAG_ERR_FACTOR * err / flux)


def hg1g2(phase: Column, h: Column, g1: Column, g2: Column) -> Column:
    """Three-term phase curve; phase in radians; NULL where the brightness is not positive."""
    light = g1 * phi(1, phase) + g2 * phi(2, phase) + (1 - g1 - g2) * phi(3, phase)
    return F.when(light > 0, h - 2.5 * F.log10(light))


def _linear(g: Column, line: tuple[float, float]) -> Column:
    return g * line[0] + line[1]


def hg12(phase: Column, h: Column, g12: Column) -> Column:
    g1, g2 = (F.when(g12 >= 0.2, _linear(g12, G12_HIGH[k])).otherwise(_linear(g12, G12_LOW[k])) for k in (0, 1))
    return hg1g2(phase, h, g1, g2)


def hg12_star(phase: Column, h: Column, g: Column) -> Column:
    return hg1g2(phase, h, _linear(g, G12_STAR[0]), _linear(g, G12_STAR[1]))


def hg12_array(phi1: np.ndarray, phi2: np.ndarray, phi3: np.ndarray, h: np.ndarray, g12: np.ndarray) -> np.ndarray:
    """hg12 with the basis functions worked out; not finite where the brightness is not positive."""
    high = g12 >= 0.2
    g1 = np.where(high, g12 * G12_HIGH[0][0] + G12_HIGH[0][1], g12 * G12_LOW[0][0] + G12_LOW[0][1])
    g2 = np.where(high, g12 * G12_HIGH[1][0] + G12_HIGH[1][1], g12 * G12_LOW[1][0] + G12_LOW[1][1])
    with np.errstate(all="ignore"):
        return h - 2.5 * np.log10(g1 * phi1 + g2 * phi2 + (1 - g1 - g2) * phi3)


def hg_basis_array(phase: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two basis functions of hg_bowell; phase in radians."""
    s, t = np.sin(phase), np.tan(phase / 2)
    w = np.exp(-90.56 * t * t)
    scaled = s / (0.119 + 1.341 * s - 0.754 * s * s)
    one, two = (w * (1 - c * scaled) + (1 - w) * np.exp(-a * t**b) for a, b, c in zip(HG_A, HG_B, HG_C, strict=True))
    return one, two


def hg_bowell(phase: Column, h: Column, g: Column) -> Column:
    """Two-term phase curve with the blend for small angles; phase in radians."""
    s, t = F.sin(phase), F.tan(phase / 2)
    w = F.exp(-90.56 * t * t)
    scaled = s / (0.119 + 1.341 * s - 0.754 * s * s)
    p1, p2 = (w * (1 - c * scaled) + (1 - w) * F.exp(-a * F.pow(t, F.lit(b))) for a, b, c in zip(HG_A, HG_B, HG_C, strict=True))
    return h - 2.5 * F.log10((1 - g) * p1 + g * p2)


def hg_v_mag(h: Column, g: Column, r: Column, delta: Column, phase_deg: Column) -> Column:
    """Predicted V magnitude at distances r (Sun) and delta (observer) in AU."""
    t = F.tan(F.radians(phase_deg) / 2)
    light = (1 - g) * F.exp(-3.33 * F.pow(t, F.lit(0.63))) + g * F.exp(-1.87 * F.pow(t, F.lit(1.22)))
    return h + 5 * F.log10(r * delta) - 2.5 * F.log10(light)
