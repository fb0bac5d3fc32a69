"""Joins, set operations, checks and row operations with the survey's invariants."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[prefix + c for c in df.columns])


def nonnegative(df: DataFrame, *columns: str) -> DataFrame:
    """The columns as bigint; a row with a negative value fails the query."""
    return df.withColumns({c: F.when(F.assert_true(F.col(c).cast("bigint") >= 0, F.lit(f"{c} is negative")).isNull(), F.col(c).cast("bigint")) for c in columns})


def associate(sources: DataFrame, detections: DataFrame, source_id: str = "diaSourceId", detection_id: str = "obssubid") -> DataFrame:
    """Sources with their detections, whose columns get the prefix mpc_; either side may have more."""
    return sources.join(prefixed(detections, "mpc_"), F.col(source_id) == F.col(f"mpc_{detection_id}"))


def resolve_permanent(rows: DataFrame, numbered: DataFrame) -> DataFrame:
    """mpc_provid, filled from the numbered identifications by mpc_permid where it is null."""
    known = numbered.groupBy(F.col("permid").alias("n_permid")).agg(F.min("unpacked_primary_provisional_designation").alias("n_primary"))
    joined = rows.join(known, F.col("mpc_permid") == F.col("n_permid"), "left")
    return joined.withColumn("mpc_provid", F.coalesce("mpc_provid", "n_primary")).drop("n_permid", "n_primary")


def resolve_primary(rows: DataFrame, current: DataFrame) -> DataFrame:
    """`designation`: the primary of each row's mpc_provid. A row without one keeps its place with a NULL for checks to find."""
    known = current.groupBy(F.col("unpacked_secondary_provisional_designation").alias("c_secondary")).agg(
        F.min("unpacked_primary_provisional_designation").alias("designation"), F.min("packed_primary_provisional_designation").alias("packed_designation")
    )
    return rows.join(known, F.col("mpc_provid") == F.col("c_secondary"), "left").drop("c_secondary")


def semi(rows: DataFrame, ids: DataFrame, column: str, id_column: str = "id") -> DataFrame:
    """The rows whose column is among the ids, each once. The optimizer broadcasts the ids when their size allows it."""
    return rows.join(ids.select(F.col(id_column).alias("_wanted")), F.col(column) == F.col("_wanted"), "left_semi")


def anti(rows: DataFrame, ids: DataFrame, column: str, id_column: str = "id") -> DataFrame:
    return rows.join(ids.select(F.col(id_column).alias("_wanted")), F.col(column) == F.col("_wanted"), "left_anti")


def first_match(left: DataFrame, right: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """For each row of `right` the one match in `left` that comes first by `order`; no match, no row. Partial aggregates take
    the first one in the map tasks, so a key's duplicates do not meet in one."""
    rest = [c for c in left.columns if c != key and c not in order]
    first = left.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("_first")).select(key, *[F.col("_first")[c].alias(c) for c in left.columns if c != key])
    return right.join(first, key)


def check_unique(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that several rows have, with how many."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def check_cardinality(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows on either side and whether they agree."""
    return before.agg(F.count(F.lit(1)).alias("rows_before")).crossJoin(after.agg(F.count(F.lit(1)).alias("rows_after"))).withColumn("ok", F.col("rows_before") == F.col("rows_after"))


def check_ranges(df: DataFrame, **ranges: tuple[float, float]) -> DataFrame:
    """One row: for each column the number of values outside [low, high]."""
    return df.agg(*[F.count_if(~F.col(c).between(low, high)).alias(f"{c}_outside") for c, (low, high) in ranges.items()])


def require(check: DataFrame, *zero: str) -> None:
    """Raises unless the one-row check has 0 in the columns."""
    row = check.first()
    if bad := {c: row[c] for c in zero if row[c]}:
        raise AssertionError(f"check failed: {bad}")


def contiguity(df: DataFrame, key: str, order: str, ranges: int = 64) -> DataFrame:
    """Per key, how many runs of it the order (numbers or times) has; a grouped input has 1 for all. Runs are found within
    ranges of the order, whose edges are compared afterwards, so no task sees the whole order. The ranges' bounds are asked
    for once, so both steps see the same ranges whenever they are run."""
    rows = df.select(F.col(key).alias("k"), F.col(order).alias("o"))
    bounds = rows.select(F.percentile_approx("o", [n / ranges for n in range(1, ranges)])).first()[0] or []
    dealt = rows.withColumn("part", reduce(lambda total, b: total + F.coalesce((F.col("o") >= F.lit(b)).cast("int"), F.lit(0)), sorted(set(bounds)), F.lit(0)))
    within = Window.partitionBy("part").orderBy("o")
    starts = dealt.withColumn("new", F.coalesce(~F.lag("k").over(within).eqNullSafe(F.col("k")) | (F.row_number().over(within) == 1), F.lit(True)))
    edges = dealt.groupBy("part").agg(F.min_by("k", "o").alias("first"), F.max_by("k", "o").alias("last"))
    before = F.row_number().over(Window.orderBy("part")) > 1  # ranges are few, whatever the rows
    bridged = edges.withColumn("same", before & F.lag("last").over(Window.orderBy("part")).eqNullSafe(F.col("first"))).where("same").groupBy(F.col("first").alias("b")).agg(F.count(F.lit(1)).alias("bridged"))
    runs = starts.where("new").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return runs.join(bridged, F.col("k").eqNullSafe(F.col("b")), "left").select(F.col("k").alias(key), (F.col("n") - F.coalesce("bridged", F.lit(0))).alias("runs"))


def exact_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """n rows, the same ones every time: those with the smallest hashes of the key."""
    return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)


def set_flag(flags: Column, bit: int, when: Column) -> Column:
    return F.when(when, flags.bitwiseOR(F.lit(bit))).otherwise(flags)


def has_flag(flags: Column, bit: int) -> Column:
    return flags.bitwiseAND(F.lit(bit)) != 0
