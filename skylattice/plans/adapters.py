"""The survey's logical tables as views of the driver's tables, in DataFrames and, word for word, in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.functions import photometry, times


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as detections of objects: one band per type, brightness from the value, phase from props.k."""
    band = F.when(F.col("event_type") == "click", "g").when(F.col("event_type") == "view", "r").when(F.col("event_type") == "signup", "i").when(F.col("event_type") == "purchase", "z").otherwise("u")
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("source_id"),
        F.col("user_id").alias("object_id"),
        times.mjd_of(F.col("ts")).alias("mjd"),
        band.alias("band"),
        F.col("value").alias("flux"),
        (F.col("value") * (0.01 + k / F.lit(5000.0))).alias("flux_err"),
        (k / F.lit(2.0)).alias("phase"),
        k.alias("k"),
    )


SOURCES = """sources AS (SELECT event_id AS source_id, user_id AS object_id, epoch_us(ts)::DOUBLE / 86400e6::DOUBLE + 40587::DOUBLE AS mjd,
  CASE event_type WHEN 'click' THEN 'g' WHEN 'view' THEN 'r' WHEN 'signup' THEN 'i' WHEN 'purchase' THEN 'z' ELSE 'u' END AS band,
  value AS flux, value * (0.01::DOUBLE + k / 5000::DOUBLE) AS flux_err, k / 2::DOUBLE AS phase, k
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events))"""


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported detections: those of all bands but u; every third one is without a provisional designation."""
    s = sources(spark, sf_dir).where("band <> 'u'")
    return s.select(F.col("source_id").alias("obssubid"), F.when(F.col("source_id") % 3 != 0, F.concat(F.lit("P"), F.col("object_id").cast("string"))).alias("provid"), F.col("object_id").cast("string").alias("permid"))


DETECTIONS = """detections AS (SELECT source_id AS obssubid, CASE WHEN source_id % 3 <> 0 THEN 'P' || object_id::VARCHAR END AS provid,
  object_id::VARCHAR AS permid FROM sources WHERE band <> 'u')"""


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    return c.select(F.col("c_custkey").cast("string").alias("permid"), F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("unpacked_primary_provisional_designation"))


NUMBERED = "numbered AS (SELECT c_custkey::VARCHAR AS permid, 'P' || c_custkey::VARCHAR AS unpacked_primary FROM customer WHERE c_acctbal >= 0)"


def current(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("unpacked_secondary_provisional_designation"),
        F.concat(F.lit("P"), F.col("c_nationkey").cast("string")).alias("unpacked_primary_provisional_designation"),
        F.concat(F.lit("K"), F.col("c_nationkey").cast("string")).alias("packed_primary_provisional_designation"),
    )


CURRENT = "current_ids AS (SELECT 'P' || c_custkey::VARCHAR AS secondary, 'P' || c_nationkey::VARCHAR AS prim, 'K' || c_nationkey::VARCHAR AS packed FROM customer)"


def orbit_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as orbits; some objects have none."""
    p = F.col("p_partkey")
    return table(spark, sf_dir, "part").where("p_size <> 11").select(
        p.alias("object_id"),
        (F.lit(0.3) + F.col("p_size") / F.lit(40.0)).alias("q"),
        ((p % 80) / F.lit(100.0)).alias("e"),
        (p * 7 % 40).cast("double").alias("i"),
        (p * 37 % 360).cast("double").alias("node"),
        (p * 53 % 360).cast("double").alias("argperi"),
    )


ORBITS = """orbits AS (SELECT p_partkey AS object_id, 0.3::DOUBLE + p_size / 40::DOUBLE AS q, (p_partkey % 80) / 100::DOUBLE AS e, (p_partkey * 7 % 40)::DOUBLE AS i,
  (p_partkey * 37 % 360)::DOUBLE AS node, (p_partkey * 53 % 360)::DOUBLE AS argperi FROM part WHERE p_size <> 11)"""


def sky_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sources with made-up directions."""
    s = sources(spark, sf_dir)
    n = F.col("source_id")
    return s.withColumns({"ra": (n * 7919 % 360000) / F.lit(1000.0), "dec": (n * 104729 % 170000) / F.lit(1000.0) - F.lit(85.0)})


SKY = "sky AS (SELECT *, (source_id * 7919 % 360000) / 1000::DOUBLE AS ra, (source_id * 104729 % 170000) / 1000::DOUBLE - 85::DOUBLE AS dec FROM sources)"


def phase_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sources with magnitudes that follow a phase curve of their object, and small deterministic noise."""
    s = sources(spark, sf_dir)
    h, g = F.lit(15.0) + F.col("object_id") % 5, F.lit(0.1) + (F.col("object_id") % 7) / F.lit(10.0)
    noise = 0.02 * ((F.col("source_id") * 7919 % 1000) / F.lit(1000.0) - 0.5)
    return s.withColumn("mag", photometry.hg12(F.radians("phase"), h, g) + noise).withColumn("mag_err", F.lit(0.02))


def micro(column: Column) -> Column:
    """A double as whole millionths: the last bits of logarithms and angles differ between engines."""
    return F.floor(column * 1e6 + 0.5).cast("long")
