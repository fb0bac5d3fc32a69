"""Phase-curve fits per group: Levenberg-Marquardt over many groups at once.

Observations are gathered per group by one aggregation and fitted in Arrow batches, all groups of a batch in the same
NumPy steps, so the cost is that of the observations and not of a Python call per group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylattice.functions import photometry as P

#: A model gets the phases (radians) of all observations and gives their magnitudes for parameters (H, G) of each observation.
Model = Callable[[np.ndarray], Callable[[np.ndarray, np.ndarray], np.ndarray]]


def hg12_model(phase: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    basis = [P.phi_array(k, phase) for k in (1, 2, 3)]
    return lambda h, g: P.hg12_array(*basis, h, g)


def hg_model(phase: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """The two-term curve."""
    p1, p2 = P.hg_basis_array(phase)
    return lambda h, g: h - 2.5 * np.log10((1 - g) * p1 + g * p2)


def linear_model(phase: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Magnitudes that fall off by G a degree."""
    return lambda h, g: h + g * np.degrees(phase)


MODELS: dict[str, Model] = {"HG12": hg12_model, "HG": hg_model, "linear": linear_model}

FIT = "H double, G12 double, HErr double, G12Err double, H_G12_Cov double, chi2 double, chi2dof double, n_used int"
TOLERANCE = 1.49012e-8


def fit_groups(mag: np.ndarray, sigma: np.ndarray, phase_deg: np.ndarray, sizes: np.ndarray, start_g12: float = 0.1, max_steps: int = 200, model: str | Model = "HG12"):
    """(H, G12 or the model's second parameter, errors, covariance, chi2) per group of consecutive observations; failed fits are NaN."""
    n = len(sizes)
    out = np.full((n, 6), np.nan)
    if not n:
        return out
    group = np.repeat(np.arange(n), sizes)
    first = np.cumsum(sizes) - sizes
    magnitude = (MODELS[model] if isinstance(model, str) else model)(np.radians(phase_deg))

    def curve(h, g):
        return magnitude(h[group], g[group])

    def total(x):
        return np.add.reduceat(x, first)

    with np.errstate(all="ignore"):
        h, g = mag[first].astype(float), np.full(n, start_g12)
        damp, active, done = np.full(n, 1e-3), np.ones(n, bool), np.zeros(n, bool)
        residual = (mag - curve(h, g)) / sigma
        chi2 = total(residual**2)
        for _ in range(max_steps):
            step = 1e-7 * np.maximum(np.abs(g), 1e-2)
            slope = (curve(h, g + step) - curve(h, g - step)) / (2 * step)[group] / sigma
            one = 1 / sigma
            hh, hg, gg = total(one * one), total(one * slope), total(slope * slope)
            bh, bg = total(one * residual), total(slope * residual)
            a, d = hh * (1 + damp), gg * (1 + damp)
            det = a * d - hg * hg
            dh, dg = (d * bh - hg * bg) / det, (a * bg - hg * bh) / det
            h2, g2 = h + dh, g + dg
            new = (mag - curve(h2, g2)) / sigma
            chi2_new = total(new**2)
            better = active & np.isfinite(chi2_new) & (chi2_new <= chi2)
            gain = chi2 - chi2_new
            small = (gain <= TOLERANCE * chi2) | (np.hypot(dh, dg) <= TOLERANCE * np.hypot(h, g))
            h, g = np.where(better, h2, h), np.where(better, g2, g)
            chi2 = np.where(better, chi2_new, chi2)
            residual = np.where(better[group], new, residual)
            done |= better & small
            damp = np.where(better, np.maximum(damp / 10, 1e-12), damp * 10)
            done |= active & ~better & (damp > 1e10) & np.isfinite(chi2)
            active &= ~done & (damp < 1e12)
            if not active.any():
                break
        det = hh * gg - hg * hg
        good = done & np.isfinite(chi2) & np.isfinite(det) & (det > 1e-12 * hh * gg)
        found = np.stack([h, g, np.sqrt(gg / det), np.sqrt(hh / det), -hg / det, chi2], 1)
        out[good] = found[good]
    return out


def gather(rows: DataFrame, keys: list[str], order: Column, mag: Column, sigma: Column, phase: Column) -> DataFrame:
    """keys and `obs`, the group's usable observations in order. Rows are judged once gathered, so that the expressions of
    magnitudes stand in the plan once."""
    each = F.struct(order.alias("o"), mag.cast("double").alias("mag"), sigma.cast("double").alias("sigma"), phase.cast("double").alias("phase"))
    gathered = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(each)).alias("obs"))
    return gathered.withColumn("obs", F.filter("obs", lambda o: (o["sigma"] > 0) & o["phase"].isNotNull() & ~F.isnan(o["phase"]) & (o["mag"] < float("inf"))))


def fit_hg12(rows: DataFrame, keys: list[str], order: Column, mag: Column, sigma: Column, phase: Column, min_obs: int = 2, min_span: float = 0.0, model: str | Model = "HG12") -> DataFrame:
    """keys and FIT of each group with `min_obs` usable observations over more than `min_span` degrees (none: any span).

    A failed fit has NULL parameters and n_used 0; chi2dof is NULL for two observations.
    """
    gathered = gather(rows, keys, order, mag, sigma, phase).where(F.size("obs") >= min_obs)
    if min_span > 0:
        gathered = gathered.where(F.array_max(F.transform("obs", lambda o: o["phase"])) - F.array_min(F.transform("obs", lambda o: o["phase"])) > min_span)
    flat = gathered.select(*keys, *[_field(name) for name in ("mag", "sigma", "phase")])
    fields = [T.StructField(c.split()[0], T.IntegerType() if c.endswith("int") else T.DoubleType()) for c in FIT.split(", ")]
    schema = T.StructType([*gathered.select(*keys).schema.fields, *fields])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            sizes = part["mag"].map(len).to_numpy() if len(part) else np.zeros(0, int)
            columns = [np.concatenate([np.zeros(0), *part[c]]) for c in ("mag", "sigma", "phase")]
            found = fit_groups(*columns, sizes, model=model)
            out = part[keys].copy()
            for k, name in enumerate(("H", "G12", "HErr", "G12Err", "H_G12_Cov", "chi2")):
                out[name] = found[:, k]
            out["chi2dof"] = np.where(sizes > 2, found[:, 5] / np.maximum(sizes - 2, 1), np.nan)
            out["n_used"] = np.where(np.isnan(found[:, 1]), 0, sizes).astype("int32")
            yield out

    fitted = flat.mapInPandas(run, schema)
    return fitted.select(*keys, *[F.nanvl(c.split()[0], F.lit(None).cast("double")).alias(c.split()[0]) if "double" in c else F.col("n_used") for c in FIT.split(", ")])


#: What fit_bands gives for each band b, as b_name.
BAND_FIT = ("H", "HErr", "G12", "G12Err", "H_G12_Cov", "Chi2", "nObsUsed")


def observation(band: Column, order: Column, mag: Column, sigma: Column, phase: Column) -> Column:
    """What fit_bands expects to be collected per object."""
    return F.struct(order.alias("o"), band.alias("band"), mag.cast("double").alias("mag"), sigma.cast("double").alias("sigma"), phase.cast("double").alias("phase"))


def fit_bands(grouped: DataFrame, bands: str, obs: str = "obs", min_obs: int = 2, min_span: float = 0.0, chi2_per_dof: bool = False, model: str | Model = "HG12") -> DataFrame:
    """`grouped` without its array of observations, with BAND_FIT of every band; NULL where a band has too few.

    The array comes from the same grouping as an object's other aggregates, so fits need no shuffle and no join.
    """
    usable = F.filter(F.array_sort(obs), lambda o: (o["sigma"] > 0) & o["phase"].isNotNull() & ~F.isnan(o["phase"]) & (o["mag"] < float("inf")))
    rest = [c for c in grouped.columns if c != obs]
    split = grouped.select(*rest, usable.alias(obs)).select(*rest, *[F.filter(obs, _of_band(b)).alias(f"{obs}_{b}") for b in bands])
    flat = split.select(*rest, *[F.col(f"{obs}_{b}.{name}").alias(f"{b}_{name}") for b in bands for name in ("mag", "sigma", "phase")])
    fields = [T.StructField(f"{b}_{name}", T.IntegerType() if name == "nObsUsed" else T.DoubleType()) for b in bands for name in BAND_FIT]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = {c: part[c] for c in rest}
            for b in bands:
                columns = [part[f"{b}_{name}"] for name in ("mag", "sigma", "phase")]
                sizes = columns[0].map(len).to_numpy(int)
                span = np.array([np.ptp(x) if len(x) else 0.0 for x in columns[2]])
                tried = (sizes >= min_obs) & ((span > min_span) if min_span > 0 else True)
                found = np.full((len(part), 6), np.nan)
                found[tried] = fit_groups(*[np.concatenate([np.zeros(0), *c[tried]]) for c in columns], sizes[tried], model=model)
                chi2 = np.where(sizes > 2, 2 * found[:, 5] / np.maximum(sizes - 2, 1), np.nan) if chi2_per_dof else found[:, 5]
                for name, values in zip(BAND_FIT, (found[:, 0], found[:, 2], found[:, 1], found[:, 3], found[:, 4], chi2), strict=False):
                    out[f"{b}_{name}"] = values
                used = pd.array(np.where(np.isnan(found[:, 1]), 0, sizes), "Int32")
                used[~tried] = pd.NA
                out[f"{b}_nObsUsed"] = used
            yield pd.DataFrame(out)

    kept = [grouped.schema[c] for c in rest]
    return flat.mapInPandas(run, T.StructType([*[T.StructField(f.name, f.dataType) for f in kept], *fields]))


def _of_band(band: str):
    return lambda o: o["band"] == band


def _field(name: str) -> Column:
    return F.col(f"obs.{name}").alias(name)
