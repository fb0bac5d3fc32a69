"""Tracklets, nightly linking and ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylattice.functions import sky, times

#: Largest gap (days) and least distance (arcsec) within a tracklet, nights and their window, the flag of what is not linked.
MAX_GAP_DAYS = 1.5 / 24
MIN_ARCSEC = 1.0
NIGHTS = 3
WINDOW_NIGHTS = 15
NOT_LINKED = 2048


def tracklets(rows: DataFrame, key: str = "object_id", source: str = "source_id", mjd: str = "mjd", max_gap: float = MAX_GAP_DAYS, min_arcsec: float | None = MIN_ARCSEC) -> DataFrame:
    """(key, night, n_pairs): nights with two observations close in time and apart on the sky, and how many such pairs they have.

    Every pair of a night counts, neighbours or not; an observation meets the earlier ones within `max_gap`, so a task holds that
    much of one object's night. `min_arcsec` None leaves the distance out, for rows without positions.
    """
    place = [F.col("ra"), F.col("dec")] if min_arcsec is not None else []
    rows = rows.withColumn("night", times.night(F.col(mjd))).withColumn("_at", F.struct(F.col(mjd).alias("t"), F.col(source).alias("s"), *place))
    # a range of fractions of a day can be told in SQL alone
    before = F.expr(f"collect_list(_at) OVER (PARTITION BY `{key}`, night ORDER BY `{mjd}` RANGE BETWEEN CAST({max_gap!r} AS DOUBLE) PRECEDING AND CURRENT ROW)")
    here = F.col("_at")

    def paired(x):
        earlier = (x["t"] < here["t"]) | ((x["t"] == here["t"]) & (x["s"] < here["s"]))
        if min_arcsec is None:
            return earlier
        return earlier & (sky.separation(x["ra"], x["dec"], here["ra"], here["dec"]) * 3600 >= min_arcsec)

    pairs = F.size(F.filter("_before", paired))
    return rows.withColumn("_before", before).groupBy(key, "night").agg(F.sum(pairs).alias("n_pairs")).where("n_pairs > 0")


def discoveries(nights: DataFrame, key: str = "object_id", least: int = NIGHTS, window: int = WINDOW_NIGHTS) -> DataFrame:
    """(key, discovery_night): the first night that ends a window with enough nights; one row per (key, night) goes in."""
    w = Window.partitionBy(key).orderBy("night").rangeBetween(-(window - 1), 0)
    return nights.withColumn("k", F.count(F.lit(1)).over(w)).where(F.col("k") >= least).groupBy(key).agg(F.min("night").alias("discovery_night"))


def flag_unlinked(objects: DataFrame, found: DataFrame, key: str = "object_id", flags: str = "flags") -> DataFrame:
    marked = objects.join(found.select(key, F.lit(True).alias("_linked")), key, "left")
    return marked.withColumn(flags, F.when(F.col("_linked").isNull(), F.col(flags).bitwiseOR(F.lit(NOT_LINKED))).otherwise(F.col(flags))).drop("_linked")


def closeness_rank(rows: DataFrame, keys: list[str], distance: str, name: str = "diaDistanceRank") -> DataFrame:
    """Rank by distance from the prediction within the keys."""
    return rows.withColumn(name, F.rank().over(Window.partitionBy(*keys).orderBy(distance)))
