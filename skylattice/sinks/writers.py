"""Sinks: Parquet with bounded row groups, per-dataset folders, batch export, CSV, PSV reports, tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylattice.functions import times
from skylattice.sources.readers import ExportSpec

ROW_GROUP_ROWS = 1_000_000


def write_parquet(df: DataFrame, out: str, row_group_rows: int | None = ROW_GROUP_ROWS, file_rows: int | None = None, files: int | None = None, partition_by: Iterable[str] = (), compression: str = "zstd", mode: str = "errorifexists") -> str:
    """Row groups of at most `row_group_rows`, files of at most `file_rows`; an empty frame writes its schema."""
    writer = (df.coalesce(files) if files else df).write.mode(mode).option("compression", compression).option("parquet.enable.dictionary", "false")
    if row_group_rows:
        writer = writer.option("parquet.block.row.count.limit", row_group_rows)
    if file_rows:
        writer = writer.option("maxRecordsPerFile", file_rows)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(out)
    return out


def write_per_dataset(df: DataFrame, out: str, dataset: str = "visit", on_written: Callable[[int], None] | None = None, **options) -> int:
    """One folder per dataset; gives the number of rows, counted as they are written. A failing callback is ignored."""
    from pyspark.sql import Observation

    seen = Observation()
    counted = df.repartition(dataset).observe(seen, F.count(F.lit(1)).alias("rows"))
    write_parquet(counted, out, partition_by=(dataset,), **options)
    rows = int(seen.get["rows"])
    if on_written:
        try:
            on_written(rows)
        except Exception:  # noqa: BLE001  progress must not break an export
            pass
    return rows


def export(read: Callable[[str], DataFrame], specs: Iterable[ExportSpec], row_group_rows: int = ROW_GROUP_ROWS, mode: str = "errorifexists") -> list[str]:
    """Each spec's query into its file. `read` turns SQL into rows: spark.sql over views, or a JDBC reader that shares a snapshot."""
    return [write_parquet(read(s.sql), s.out, s.row_group_size or row_group_rows, mode=mode) for s in specs]


def write_csv(df: DataFrame, out: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).option("header", True).csv(out)
    return out


def nan_to_null(df: DataFrame) -> DataFrame:
    """For loading into databases: NaN becomes NULL."""
    return df.select(*[F.nanvl(c, F.lit(None)).alias(c) if kind in ("double", "float") else F.col(c) for c, kind in df.dtypes])


def write_jdbc(df: DataFrame, options: dict[str, str], table: str, mode: str = "append") -> None:
    nan_to_null(df).write.format("jdbc").options(**options, dbtable=table).mode(mode).save()


def load_control(table: str, schema: T.StructType, source: str, limit: int | None = None) -> str:
    """A bulk loader's control file for a CSV that nan_to_null() and write_csv() made: empty fields are NULL."""
    lines = [f"OUTPUT = {table}", f"INPUT = {source}", "TYPE = CSV", "SKIP = 1", 'NULL = ""', 'DELIMITER = ","', f"LIMIT = {'INFINITE' if limit is None else limit}"]
    return "\n".join([*lines, "# columns: " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)]) + "\n"


def index_statements(table: str, unique: tuple[str, ...] = (), secondary: tuple[str, ...] = ()) -> list[str]:
    """CREATE INDEX statements for a loaded table: one unique index over the key columns, one for each column that is looked up."""
    made = [f'CREATE UNIQUE INDEX "{table}_key" ON "{table}" ({", ".join(f"{chr(34)}{c}{chr(34)}" for c in unique)});'] if unique else []
    return made + [f'CREATE INDEX "{table}_{c}" ON "{table}" ("{c}");' for c in secondary]


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, unique: tuple[str, ...] = ()) -> None:
    """A table whose joins and groupings by `key` need no shuffle."""
    df.write.bucketBy(buckets, key).sortBy(key, *unique).mode("overwrite").saveAsTable(table)


#: The report's header and columns.
REPORT_HEADER = ("# version=2017", "! mpcCode I11", "# submitter", "! name D. iRAC", "# telescope", "! aperture 8.4", "! design Reflector", "! detector CCD", "# observers", "! name D. iRAC", "# measurers", "! name D. iRAC")
REPORT_COLUMNS = ("trkSub", "obsTime", "ra", "dec", "rmsRA", "rmsDec", "mag", "rmsMag", "band", "stn", "mode", "astCat")


def iso_utc(mjd_tai: Column) -> Column:
    """ISO time with milliseconds and Z; independent of the session's zone."""
    micros = times.mjd_tai_to_utc_micros(mjd_tai)
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(micros / 86_400_000_000).cast("int"))
    rest = F.pmod(micros, F.lit(86_400_000_000))

    def two(c: Column, digits: int = 2) -> Column:
        return F.lpad(F.floor(c).cast("long").cast("string"), digits, "0")

    seconds = F.floor(rest / 1_000_000)
    return F.concat(day.cast("string"), F.lit("T"), two(seconds / 3600), F.lit(":"), two(seconds % 3600 / 60), F.lit(":"), two(seconds % 60), F.lit("."), two(rest % 1_000_000 / 1000, 3), F.lit("Z"))


def report_rows(df: DataFrame, station: str = "I11", catalog: str = "Gaia2") -> DataFrame:
    """From object_id, mjd_tai, ra, dec, ra_sigma, dec_sigma, mag, mag_sigma, band: the report's columns."""
    return df.select(
        F.col("object_id").cast("string").alias("trkSub"),
        iso_utc(F.col("mjd_tai")).alias("obsTime"),
        "ra",
        "dec",
        F.col("ra_sigma").alias("rmsRA"),
        F.col("dec_sigma").alias("rmsDec"),
        "mag",
        F.col("mag_sigma").alias("rmsMag"),
        "band",
        F.lit(station).alias("stn"),
        F.lit("CCD").alias("mode"),
        F.lit(catalog).alias("astCat"),
    )


def report_lines(rows: DataFrame) -> DataFrame:
    """One text column: the columns joined by pipes, nulls empty."""
    return rows.select(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in REPORT_COLUMNS]).alias("value"))


def write_report(spark: SparkSession, rows: DataFrame, out: str, mode: str = "errorifexists") -> str:
    """Header and lines in object order. The lines are range-partitioned; the header goes before the first of them."""
    lines = rows.orderBy("trkSub", "obsTime").transform(report_lines)
    head = spark.createDataFrame([("\n".join([*REPORT_HEADER, "|".join(REPORT_COLUMNS)]),)], "value string").coalesce(1)
    head.unionByName(lines).write.mode(mode).text(out)
    return out
