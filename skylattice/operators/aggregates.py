"""Aggregates: per object, per band, histograms, flags, binned statistics."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylattice.schemas import BANDS


def no_nan(c: Column) -> Column:
    """NaN as NULL, so that aggregates skip it."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def band_counts(rows: DataFrame, key: str, band: str = "band", bands: str = BANDS) -> DataFrame:
    """One row per key; a band without rows counts 0. Conditional aggregates, so one pass and one exchange for all bands."""
    return rows.groupBy(key).agg(*[F.count_if(F.col(band) == b).alias(f"{b}_nObs") for b in bands])


def band_range(rows: DataFrame, key: str, value: str, band: str = "band", bands: str = BANDS) -> DataFrame:
    """Least and largest value per band; NULL for a band without rows."""
    clean = no_nan(F.col(value))
    return rows.groupBy(key).agg(*[f(F.when(F.col(band) == b, clean)).alias(f"{b}_{value}{name}") for b in bands for name, f in (("Min", F.min), ("Max", F.max))])


def object_statistics(rows: DataFrame, key: str, time: str, value: str) -> DataFrame:
    """Count, first and last time, span, least, largest and exact median value."""
    v = no_nan(F.col(value))
    return rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("nObs"),
        F.min(time).alias("first_time"),
        (F.max(time) - F.min(time)).alias("arc"),
        F.min(v).alias(f"{value}Min"),
        F.max(v).alias(f"{value}Max"),
        F.median(v).alias(f"{value}Median"),
    )


def group_map(rows: DataFrame, key: str, func: Callable, schema: str) -> DataFrame:
    """An arbitrary pandas function per group, for what expressions can't say; a group is held in memory."""
    return rows.groupBy(key).applyInPandas(func, schema)


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def modal(rows: DataFrame, key: str, column: str) -> DataFrame:
    """Each key's most frequent value; of equally frequent ones the smallest."""
    counts = rows.groupBy(key, column).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("m"), F.col(column).alias("v"))).alias("best")).select(key, F.col("best.v").alias(column), (-F.col("best.m")).alias("n"))


def cooccurrence(rows: DataFrame, flags: str, bits: Sequence[int]) -> DataFrame:
    """How many rows have both of two bits, for all pairs a <= b; one aggregation."""
    pairs = [(a, b) for k, a in enumerate(bits) for b in bits[k:]]
    counts = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.count_if(F.col(flags).bitwiseAND(F.lit(a | b)) == (a | b)).alias("n")) for a, b in pairs]
    return rows.agg(F.array(*counts).alias("c")).select(F.inline("c"))


def binned_mean(rows: DataFrame, x: str, y: str, bins: int) -> DataFrame:
    """Means of y in equal bins over x's range, the last one closed. The range is a one-row table."""
    ends = rows.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.when(width > 0, F.least(F.floor((F.col(x) - F.col("lo")) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    return rows.crossJoin(F.broadcast(ends)).where(F.col(x).isNotNull()).groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(y).alias("mean"))


def histogram(rows: DataFrame, x: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts in equal bins of [low, high]; values outside are left out, the right edge belongs to the last bin."""
    place = F.least(F.floor((F.col(x) - low) / ((high - low) / bins)), F.lit(bins - 1)).cast("int")
    return rows.where(F.col(x).between(low, high)).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def checksum(rows: DataFrame, *columns: str) -> DataFrame:
    """Row count and an order-free sum of the columns' hashes; equal for equal tables."""
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*(columns or rows.columns)).cast("decimal(38,0)")).alias("checksum"))


def text_sizes(rows: DataFrame) -> DataFrame:
    """Per string column: bytes in all and the longest value's length."""
    names = [c for c, kind in rows.dtypes if kind == "string"]
    counted = [F.struct(F.lit(c).alias("column"), F.coalesce(F.sum(F.octet_length(c)), F.lit(0)).cast("long").alias("bytes"), F.coalesce(F.max(F.char_length(c)), F.lit(0)).alias("longest")) for c in names]
    return rows.agg(F.array(*counted).alias("c")).select(F.inline("c"))
