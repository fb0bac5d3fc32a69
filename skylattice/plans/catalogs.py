"""The pipelines: per-source catalogue, per-object catalogue, extraction by id."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice import schemas
from skylattice.functions import orbits, photometry, sky, times
from skylattice.functions.ids import packed_to_long
from skylattice.operators import aggregates, linkage
from skylattice.operators import ephemeris as eph
from skylattice.operators import relational as R
from skylattice.operators.moid import MoidSolver, with_moid
from skylattice.operators.phase_fit import fit_bands, observation
from skylattice.sources import readers

ORBIT_COLUMNS = ("unpacked_primary_provisional_designation", "q", "e", "i", "node", "argperi")


def typed(df: DataFrame, schema) -> DataFrame:
    """The schema's columns in its types; a column that is missing is NULL."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def association_check(rows: DataFrame, max_arcsec: float = 0.005, max_seconds: float = 0.51) -> DataFrame:
    """One row: pairs of source and detection that are too far apart in place or time, and the largest values."""
    apart = sky.separation(F.col("ra"), F.col("dec"), F.col("mpc_ra"), F.col("mpc_dec")) * 3600
    late = (F.unix_micros(F.col("mpc_obstime").cast("timestamp")) - times.mjd_tai_to_utc_micros(F.col("midpointMjdTai"))) / 1e6
    return rows.agg(
        F.count(F.lit(1)).alias("pairs"), F.max(apart).alias("max_arcsec"), F.max(F.abs(late)).alias("max_seconds"), F.count_if((apart > max_arcsec) | (F.abs(late) > max_seconds)).alias("violations")
    )


def associate(dia: DataFrame, obs: DataFrame, numbered: DataFrame, current: DataFrame) -> DataFrame:
    """Sources with detections and their primary designation; NULL where there is none."""
    return R.resolve_primary(R.resolve_permanent(R.associate(dia, obs), numbered), current)


def build_sssource(dia: DataFrame, obs: DataFrame, numbered: DataFrame, current: DataFrame, orbit_table: DataFrame, place=(289.25058, 0.864981, -0.500958), provider=eph.two_body_ephemeris, check: bool = True) -> DataFrame:
    """The per-source catalogue. With `check`, pairs that disagree or lack a designation raise before the work starts."""
    rows = associate(dia, obs, numbered, current)
    if check:
        R.require(association_check(rows), "violations")
        R.require(rows.agg(F.count_if(F.col("designation").isNull()).alias("without_designation")), "without_designation")
    elements = orbit_table.select(
        F.col("unpacked_primary_provisional_designation").alias("designation"), F.coalesce("a", orbits.semi_major_axis(F.col("q"), F.col("e"))).alias("a"), *[c for c in eph.ELEMENTS if c != "a"], "h", "g"
    )
    rows = rows.select("diaSourceId", "midpointMjdTai", "ra", "dec", "designation", packed_to_long(F.col("packed_designation")).alias("ssObjectId"))
    predicted = eph.with_geometry(eph.with_ephemeris(rows.join(elements, "designation"), "midpointMjdTai", place), "ra", "dec", "midpointMjdTai")
    ranked = linkage.closeness_rank(predicted.withColumn("_night", times.night(F.col("midpointMjdTai"))), ["ssObjectId", "_night"], "ephOffset")
    return typed(ranked, schemas.SS_SOURCE)


def observations(sss: DataFrame, dia: DataFrame) -> DataFrame:
    """Per-source rows with their fluxes as magnitudes."""
    wanted = dia.select("diaSourceId", "midpointMjdTai", "extendedness", "band", "psfFlux", "psfFluxErr")
    rows = sss.select("diaSourceId", "ssObjectId", "designation", "phaseAngle", "topoRange", "helioRange").join(wanted, "diaSourceId")
    return rows.withColumns({"mag": photometry.njy_to_mag(F.col("psfFlux")), "magErr": photometry.njy_err_to_mag_err(F.col("psfFlux"), F.col("psfFluxErr"))})


def object_aggregates(rows: DataFrame) -> DataFrame:
    """All per-object and per-band aggregates, and the observations to fit, in one grouping."""
    ext, phase = aggregates.no_nan(F.col("extendedness")), aggregates.no_nan(F.col("phaseAngle"))
    reduced = F.col("mag") - 5 * F.log10(F.col("topoRange").cast("double") * F.col("helioRange"))
    bands = []
    for b in schemas.BANDS:
        here = F.col("band") == b
        bands += [F.count_if(here).cast("int").alias(f"{b}_nObs"), F.min(F.when(here, phase)).alias(f"{b}_phaseAngleMin"), F.max(F.when(here, phase)).alias(f"{b}_phaseAngleMax")]
    return rows.groupBy("ssObjectId").agg(
        F.min("designation").alias("designation"),
        F.count(F.lit(1)).cast("int").alias("nObs"),
        F.min("midpointMjdTai").alias("firstObservationMjdTai"),
        (F.max("midpointMjdTai") - F.min("midpointMjdTai")).alias("arc"),
        F.min(ext).alias("extendednessMin"),
        F.max(ext).alias("extendednessMax"),
        F.median(ext).alias("extendednessMedian"),
        *bands,
        F.collect_list(observation(F.col("band"), F.col("diaSourceId"), reduced, F.col("magErr"), F.col("phaseAngle"))).alias("obs"),
    )


def build_ssobject(sss: DataFrame, dia: DataFrame, orbit_table: DataFrame, solver: MoidSolver = MoidSolver(), sentinels: bool = False, **fit) -> DataFrame:
    """The per-object catalogue. Values that can't be had are NULL, or with `sentinels` what zero-filled records hold."""
    rows = observations(R.nonnegative(sss, "ssObjectId", "diaSourceId"), R.nonnegative(dia, "diaSourceId"))
    # distances are costly: only the orbits of objects that are there get one
    asked = rows.select("designation").distinct()
    orbit = with_moid(orbit_table.select(*ORBIT_COLUMNS).withColumnRenamed("unpacked_primary_provisional_designation", "designation").join(asked, "designation", "left_semi").dropDuplicates(["designation"]), solver)
    orbit = orbit.select(
        "designation",
        orbits.tisserand_jupiter(orbits.semi_major_axis(F.col("q"), F.col("e")), F.col("e"), F.col("i")).alias("tisserand_J"),
        *[F.nanvl(c, F.lit(None).cast("double")).alias(n) for c, n in (("moid", "MOIDEarth"), ("delta_v", "MOIDEarthDeltaV"), ("ecliptic_longitude", "MOIDEarthEclipticLongitude"), ("true_anomaly_earth", "MOIDEarthTrueAnomaly"), ("true_anomaly_object", "MOIDEarthTrueAnomalyObject"))],
    )
    objects = fit_bands(object_aggregates(rows), schemas.BANDS, **fit).join(orbit, "designation", "left")
    failed = {f"{b}_slope_fit_failed": F.coalesce(F.col(f"{b}_nObsUsed") == 0, F.lit(False)) for b in schemas.BANDS}
    objects = objects.withColumnsRenamed({f"{b}_H_G12_Cov": f"{b}_H_{b}_G12_Cov" for b in schemas.BANDS}).withColumns(failed)
    return typed(with_sentinels(objects) if sentinels else objects, schemas.SS_OBJECT)


def with_sentinels(objects: DataFrame) -> DataFrame:
    """NULLs as zero-filled records have them: -1 for what was not fitted, NaN for parameters, 0 for phases and orbits."""
    nan, out = F.lit(float("nan")), {}
    for b in schemas.BANDS:
        fitted = F.col(f"{b}_nObsUsed").isNotNull()
        out |= {f"{b}_{k}": F.coalesce(F.col(f"{b}_{k}"), nan) for k in ("H", "HErr", "G12", "G12Err", f"H_{b}_G12_Cov")}
        out[f"{b}_Chi2"] = F.when(fitted, F.coalesce(F.col(f"{b}_Chi2"), nan)).otherwise(F.lit(-1.0))
        out[f"{b}_nObsUsed"] = F.coalesce(F.col(f"{b}_nObsUsed"), F.lit(-1))
        out |= {f"{b}_phaseAngle{k}": F.coalesce(F.col(f"{b}_phaseAngle{k}"), F.lit(0.0)) for k in ("Min", "Max")}
    orbit = ("MOIDEarth", "MOIDEarthDeltaV", "MOIDEarthEclipticLongitude", "MOIDEarthTrueAnomaly", "MOIDEarthTrueAnomalyObject", "tisserand_J")
    return objects.withColumns(out | {c: F.coalesce(F.col(c), F.lit(0.0)) for c in orbit})


def extract_catalog(spark: SparkSession, folder: str, ids: str | None = None, column: str = "diaSourceId", id_column: str | None = None, dataset: str = "visit") -> DataFrame:
    """The rows of all datasets, or those whose `column` is in the id list."""
    rows = readers.datasets(spark, folder, dataset)
    return R.semi(rows, readers.id_list(spark, ids, id_column), column) if ids else rows


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
