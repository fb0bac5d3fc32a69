"""Minimum orbit intersection distances, blocks of orbits at a time."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from skylattice.functions import orbits

SCHEMA = "moid double, delta_v double, ecliptic_longitude double, true_anomaly_earth double, true_anomaly_object double"


@dataclass(frozen=True)
class MoidSolver:
    """Grid search with zoom. multistart follows every minimum of the coarse grid; greedy only the lowest cell."""

    samples: int = 128
    zoom: float = 5.0
    tolerance_abs: float = 1e-7
    tolerance_rel: float = 1e-6
    max_zooms: int = 10
    mode: str = "multistart"

    def solve(self, first: tuple[float, ...], second: tuple[float, ...]) -> tuple[float, ...]:
        """(distance AU, relative speed km/s, longitude, anomaly on the first, on the second); orbits are (a, e, i, node, peri).

        NaN unless both are ellipses.
        """
        return tuple(self.solve_all(first, np.array([second], float))[0].tolist())

    def solve_all(self, first: tuple[float, ...], others: np.ndarray) -> np.ndarray:
        """solve() for the first orbit and each of the others, in blocks that share every NumPy step."""
        out = np.full((len(others), 5), np.nan)
        if not (first[0] > 0 and 0 <= first[1] < 1):
            return out
        with np.errstate(invalid="ignore"):
            good = np.flatnonzero((others[:, 0] > 0) & (others[:, 1] >= 0) & (others[:, 1] < 1) & np.isfinite(others).all(axis=1))
        size = max(1, (1 << 19) // self.samples**2)
        for at in range(0, len(good), size):
            out[good[at : at + size]] = self._block(first, others[good[at : at + size]])
        return out

    def _block(self, first: tuple[float, ...], others: np.ndarray) -> np.ndarray:
        one = (first[0], first[1], orbits.axes(*first[2:]))
        a, e, frames = others[:, 0], others[:, 1], orbits.axes(*others[:, 2:].T)
        coarse = ((np.arange(self.samples) + 0.5) / self.samples) * 2 * np.pi
        r1 = orbits.position(*one, coarse)
        r2 = orbits.position(a[:, None], e[:, None], frames[:, None], coarse)
        d = _squared(np.broadcast_to(r1, (len(others), *r1.shape)), r2)
        if self.mode == "greedy":
            orbit, k = np.arange(len(d)), d.reshape(len(d), -1).argmin(1)
            f1, f2 = k // self.samples, k % self.samples
        else:
            low = np.ones(d.shape, bool)
            for i in (-1, 0, 1):
                for j in (-1, 0, 1):
                    if i or j:
                        low &= d <= np.roll(d, (i, j), (1, 2))
            orbit, f1, f2 = np.nonzero(low)
        best, found = np.stack([coarse[f1], coarse[f2]], 1), d[orbit, f1, f2]
        n = self.samples if self.mode == "greedy" else 24
        width = 2 * np.pi / self.zoom if self.mode == "greedy" else 3 * 2 * np.pi / self.samples
        starts = np.flatnonzero(np.diff(orbit, prepend=-1))
        before, centre, going = np.sqrt(np.minimum.reduceat(found, starts)), best.copy(), np.ones(len(others), bool)
        steps = (np.arange(n) + 0.5) / n - 0.5
        for _ in range(self.max_zooms):
            on = np.flatnonzero(going[orbit])
            if not len(on):
                break
            g = np.mod(centre[on][:, :, None] + width * steps, 2 * np.pi)
            o = orbit[on]
            flat = _squared(orbits.position(*one, g[:, 0]), orbits.position(a[o][:, None], e[o][:, None], frames[o][:, None], g[:, 1])).reshape(len(on), -1)
            k, rows = flat.argmin(1), np.arange(len(on))
            centre[on] = np.stack([g[rows, 0, k // n], g[rows, 1, k % n]], 1)
            better = flat[rows, k] < found[on]
            best[on[better]], found[on[better]] = centre[on[better]], flat[rows, k][better]
            now = np.sqrt(np.minimum.reduceat(found, starts))
            going &= np.abs(before - now) > self.tolerance_abs + self.tolerance_rel * np.maximum(np.maximum(now, before), 1.0)
            before, width = now, width / self.zoom
        order = np.lexsort((np.arange(len(found)), found, orbit))
        f = best[order[np.searchsorted(orbit, np.arange(len(others)))]]
        p1, p2 = orbits.position(*one, f[:, 0]), orbits.position(a, e, frames, f[:, 1])
        dv = orbits.velocity(*one, f[:, 0]) - orbits.velocity(a, e, frames, f[:, 1])
        return np.stack([np.linalg.norm(p1 - p2, axis=1), np.linalg.norm(dv, axis=1), np.degrees(np.arctan2(p1[:, 1], p1[:, 0])) % 360, np.degrees(f[:, 0]), np.degrees(f[:, 1])], 1)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances between all points of a and of b, (..., n, 3) and (..., m, 3)."""
    return np.maximum((a * a).sum(-1)[..., :, None] + (b * b).sum(-1)[..., None, :] - 2 * (a @ np.swapaxes(b, -1, -2)), 0.0)


def with_moid(rows: DataFrame, solver: MoidSolver = MoidSolver(), partitions: int | None = None, earth: tuple[float, ...] = orbits.EARTH_J2000) -> DataFrame:
    """`rows` (with q, e, i, node, argperi) and the distance to Earth's orbit. An orbit table is small beside its cost, so it is dealt out first."""
    names = rows.columns
    dealt = rows.repartition(partitions) if partitions else rows.repartition(*[c for c in names if c in ("designation", "object_id")][:1] or names[:1])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            elements = part[["q", "e", "i", "node", "argperi"]].to_numpy(float, na_value=np.nan)
            with np.errstate(all="ignore"):
                elements[:, 0] /= 1 - elements[:, 1]
            found = solver.solve_all(earth, elements)
            out = pd.DataFrame(found, columns=[c.split()[0] for c in SCHEMA.split(", ")], index=part.index, dtype=float)
            yield pd.concat([part, out], axis=1)

    return dealt.mapInPandas(run, T.StructType([*rows.schema.fields, *[T.StructField(c.split()[0], T.DoubleType()) for c in SCHEMA.split(", ")]]))
