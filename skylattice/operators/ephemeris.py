"""Predicted positions per source. The propagator is a parameter; the default solves the two-body problem."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylattice.functions import orbits, photometry, sky

#: Times that go into one request to a remote service.
EPOCHS_PER_REQUEST = 60
EARTH_RADIUS_AU = 6378.137 / sky.AU_KM
ELEMENTS = ("a", "e", "i", "node", "argperi", "mean_anomaly", "epoch_mjd")
OUT = (
    "ephRa ephDec ephRateRa ephRateDec ephRate topo_x topo_y topo_z topo_vx topo_vy topo_vz helio_x helio_y helio_z helio_vx helio_vy helio_vz obs_x obs_y obs_z"
).split()


def observer(mjd: np.ndarray, longitude: float, rho_cos: float, rho_sin: float) -> tuple[np.ndarray, np.ndarray]:
    """Heliocentric equatorial position (AU) and velocity (AU/day) of a place on Earth."""
    r, v = orbits.earth(mjd)
    turn = 2 * np.pi * 1.00273781191135448
    angle = np.radians(longitude) + 2 * np.pi * 0.7790572732640 + turn * (mjd - 51544.5)
    rho = rho_cos * EARTH_RADIUS_AU
    place = np.stack([rho * np.cos(angle), rho * np.sin(angle), np.full_like(angle, rho_sin * EARTH_RADIUS_AU)], -1)
    move = np.stack([-rho * turn * np.sin(angle), rho * turn * np.cos(angle), np.zeros_like(angle)], -1)
    return r + place, v + move


def two_body_ephemeris(part: pd.DataFrame, mjd: np.ndarray, place: tuple[float, float, float]) -> dict[str, np.ndarray]:
    """Predictions for rows with ELEMENTS at times mjd, light time taken off."""
    a, e, i, node, peri, m, epoch = (part[c].to_numpy(float) for c in ELEMENTS)
    ro, vo = observer(mjd, *place)
    delay = np.zeros(len(mjd))
    for _ in range(3):
        r, v = orbits.two_body(a, e, i, node, peri, m, epoch, mjd - delay)
        delay = np.linalg.norm(r - ro, axis=-1) / orbits.LIGHT_AU_DAY
    x, dv = r - ro, v - vo
    rho2 = x[:, 0] ** 2 + x[:, 1] ** 2
    dist = np.sqrt(rho2 + x[:, 2] ** 2)
    with np.errstate(all="ignore"):
        ra, dec = np.degrees(np.arctan2(x[:, 1], x[:, 0])) % 360, np.degrees(np.arcsin(x[:, 2] / dist))
        rate_ra = np.degrees((x[:, 0] * dv[:, 1] - x[:, 1] * dv[:, 0]) / (np.sqrt(rho2) * dist))
        rate_dec = np.degrees((dv[:, 2] * rho2 - x[:, 2] * (x[:, 0] * dv[:, 0] + x[:, 1] * dv[:, 1])) / (np.sqrt(rho2) * dist**2))
    columns = [ra, dec, rate_ra, rate_dec, np.hypot(rate_ra, rate_dec), *x.T, *orbits.kms(dv).T, *r.T, *orbits.kms(v).T, *ro.T]
    return dict(zip(OUT, columns, strict=True))


def with_ephemeris(rows: DataFrame, mjd: str, place: tuple[float, float, float], provider: Callable = two_body_ephemeris) -> DataFrame:
    """`rows` (with ELEMENTS) and the predictions. Rows are independent, so nothing is grouped or shuffled."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield part.assign(**provider(part, part[mjd].to_numpy(float), place))

    return rows.mapInPandas(run, T.StructType([*rows.schema.fields, *[T.StructField(name, T.DoubleType()) for name in OUT]]))


def remote_ephemeris(rows: DataFrame, fetch: Callable[[str, list[float]], pd.DataFrame], schema: T.StructType, name: str = "designation", mjd: str = "mjd", chunk: int = EPOCHS_PER_REQUEST, attempts: int = 3) -> DataFrame:
    """What a remote service tells of each object at its different times, asked for at most `chunk` times in one request.

    `fetch` gets an object's name and times and gives a row per time, with the columns of `schema`. An object's times are
    numbered by one window, so its requests spread over tasks; a request that fails is made again up to `attempts` times.
    """
    place = F.row_number().over(Window.partitionBy(name).orderBy(mjd)) - 1
    asked = rows.select(name, mjd).distinct().withColumn("request", F.floor(place / F.lit(chunk)).cast("int"))
    asked = asked.groupBy(name, "request").agg(F.array_sort(F.collect_list(mjd)).alias("times"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for who, times in zip(part[name], part["times"], strict=True):
                for left in range(attempts - 1, -1, -1):
                    try:
                        yield fetch(who, list(times))[[f.name for f in schema.fields]]
                        break
                    except OSError:
                        if not left:
                            raise

    return asked.mapInPandas(run, schema)


def with_geometry(df: DataFrame, ra: str, dec: str, mjd: str, h: str = "h", g: str = "g") -> DataFrame:
    """Distances, rates, offsets, phase angle, brightness and sky coordinates, as native columns."""
    helio, helio_v, topo, topo_v, place = (tuple(F.col(f"{p}{k}") for k in "xyz") for p in ("helio_", "helio_v", "topo_", "topo_v", "obs_"))
    d_ra, d_dec, total = sky.oc_offsets(F.col(ra), F.col(dec), F.col("ephRa"), F.col("ephDec"))
    lon, lat = sky.ecliptic(F.col(ra), F.col(dec))
    gal_lon, gal_lat = sky.galactic(F.col(ra), F.col(dec))
    df = df.withColumns(
        {
            "helioRange": sky.norm(helio),
            "helioRangeRate": sky.range_rate(helio, helio_v),
            "helio_vtot": sky.norm(helio_v),
            "topoRange": sky.norm(topo),
            "topoRangeRate": sky.range_rate(topo, topo_v),
            "topo_vtot": sky.norm(topo_v),
            "phaseAngle": sky.phase_angle(helio, place),
            "ephOffsetRa": d_ra,
            "ephOffsetDec": d_dec,
            "ephOffset": total,
            "eclLambda": lon,
            "eclBeta": lat,
            "galLon": gal_lon,
            "galLat": gal_lat,
            "elongation": sky.elongation(F.col(ra), F.col(dec), F.col(mjd)),
        }
    )
    along, across = sky.track_offsets(F.col("ephOffsetRa"), F.col("ephOffsetDec"), F.col("ephRateRa"), F.col("ephRateDec"))
    return df.withColumns(
        {"ephOffsetAlongTrack": along, "ephOffsetCrossTrack": across, "ephVmag": photometry.hg_v_mag(F.col(h), F.col(g), F.col("helioRange"), F.col("topoRange"), F.col("phaseAngle"))}
    )
