"""Scans: Parquet with projection, typed CSV with null and boolean tokens, JDBC queries, dataset folders, id lists."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from pathlib import Path
from urllib.parse import parse_qsl, unquote, urlsplit

import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Postgres type numbers. Any other is a string.
PG_TYPES = {
    16: T.BooleanType(),
    20: T.LongType(),
    21: T.ShortType(),
    23: T.IntegerType(),
    700: T.FloatType(),
    701: T.DoubleType(),
    1700: T.DoubleType(),
    25: T.StringType(),
    1043: T.StringType(),
    1042: T.StringType(),
    114: T.StringType(),
    3802: T.StringType(),
    1082: T.DateType(),
    1114: T.TimestampNTZType(),
    1184: T.TimestampType(),
    1186: T.DayTimeIntervalType(),
}


def type_for_oid(oid: int, exact_numeric: bool = False) -> T.DataType:
    if oid == 1700 and exact_numeric:
        return T.DecimalType(38, 18)
    return PG_TYPES.get(oid, T.StringType())


def parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def assert_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """`df` cut to the expected columns; raises where one is missing or has another type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f"{f.name}: {have.get(f.name, 'missing')} instead of {f.dataType}" for f in expected.fields if have.get(f.name) != f.dataType]
    if wrong:
        raise TypeError("; ".join(wrong))
    return df.select(*expected.names)


def null_tokens(c: Column) -> Column:
    """NULL for an empty string and for the text NULL."""
    return F.when(~c.isin("", "NULL"), c)


def typed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header-less CSV; empty and NULL are null, t/f and true/false are booleans, the rest is cast strictly."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = spark.read.schema(text).options(header=False, multiLine=True, escape='"', nullValue="", emptyValue="").csv(path)
    columns = []
    for f in schema.fields:
        c = null_tokens(F.col(f.name))
        if isinstance(f.dataType, T.BooleanType):
            c = F.when(F.lower(c).isin("t", "true"), True).when(F.lower(c).isin("f", "false"), False)
        elif not isinstance(f.dataType, T.StringType):
            c = c.cast(f.dataType)
        columns.append(c.alias(f.name))
    return raw.select(*columns)


def whitespace_table(spark: SparkSession, path: str, names: Sequence[str], types: Sequence[str], skip: int = 0) -> DataFrame:
    """Columns parted by whitespace; further ones are ignored. `skip` drops a file's first lines."""
    lines = spark.read.text(path)
    if skip:
        # the first lines of each file are its smallest offsets
        lines = lines.select("value", "_metadata.file_path", "_metadata.file_block_start").withColumn("n", F.monotonically_increasing_id())
        head = lines.groupBy("file_path").agg(F.min("n").alias("first"))
        lines = lines.join(head, "file_path").where(F.col("n") - F.col("first") >= skip)
    parts = F.split(F.trim("value"), r"\s+")
    rows = lines.where(F.trim("value") != "").select(parts.alias("p"))
    return rows.select(*[F.get("p", F.lit(k)).cast(kind).alias(name) for k, (name, kind) in enumerate(zip(names, types, strict=True))])


def hdf_files(spark: SparkSession, path: str, key: str, schema: T.StructType) -> DataFrame:
    """Tables in HDF files, one file per task; needs PyTables on the executors."""

    def run(parts):
        import io
        import tempfile

        import pandas as pd

        for part in parts:
            for content in part["content"]:
                with tempfile.NamedTemporaryFile(suffix=".h5") as file:
                    file.write(io.BytesIO(content).getbuffer())
                    file.flush()
                    yield pd.read_hdf(file.name, key)[list(schema.names)]

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, schema)


def parse_dsn(dsn: str) -> dict[str, str]:
    """Settings of a connection string: a postgresql:// address, or key = value pairs whose values may be quoted."""
    if re.match(r"postgres(?:ql)?://", dsn):
        parts = urlsplit(dsn)
        found = {"host": parts.hostname, "port": parts.port, "dbname": parts.path.lstrip("/"), "user": parts.username, "password": parts.password}
        return {k: unquote(str(v)) for k, v in found.items() if v} | dict(parse_qsl(parts.query))
    pair = re.compile(r"\s*(\w+)\s*=\s*(?:'((?:[^'\\]|\\.)*)'|((?:[^\s'\\]|\\.)*))(?:\s+|$)")
    found, at = {}, 0
    while at < len(dsn.rstrip()):
        m = pair.match(dsn, at)
        if not m:
            raise ValueError("connection string is not made of key = value pairs")
        found[m[1]] = re.sub(r"\\(.)", r"\1", m[2] if m[2] is not None else m[3])
        at = m.end()
    return found


@dataclass(frozen=True)
class Connection:
    """How to reach Postgres. A DSN comes before a service, a service before flags, flags before the environment."""

    dsn: str | None = None
    service: str | None = None
    host: str | None = None
    port: int | None = None
    dbname: str | None = None
    user: str | None = None
    password: str | None = None

    def settings(self, env: dict[str, str] | None = None) -> dict[str, str]:
        env = dict(os.environ if env is None else env)
        if self.dsn:
            return parse_dsn(self.dsn)
        service = self.service or (env.get("PGSERVICE") if not (self.host or self.dbname) else None)
        if service:
            return self._service(service, env)
        found = {k: str(v) for k, v in (("host", self.host or env.get("PGHOST")), ("port", self.port or env.get("PGPORT") or 5432), ("dbname", self.dbname or env.get("PGDATABASE")), ("user", self.user or env.get("PGUSER")), ("password", self.password or env.get("PGPASSWORD"))) if v}
        if missing := [k for k in ("host", "dbname", "user") if k not in found]:
            raise ValueError(f"connection needs {', '.join(missing)}")
        return found

    @staticmethod
    def _service(name: str, env: dict[str, str]) -> dict[str, str]:
        import configparser

        parser = configparser.ConfigParser()
        parser.read(env.get("PGSERVICEFILE", str(Path.home() / ".pg_service.conf")))
        if name not in parser:
            raise ValueError(f"no service {name}")
        return dict(parser[name])

    def options(self, env: dict[str, str] | None = None) -> dict[str, str]:
        s = self.settings(env)
        url = f"jdbc:postgresql://{s.get('host', 'localhost')}:{s.get('port', '5432')}/{s['dbname']}"
        return {"url": url, "driver": "org.postgresql.Driver"} | {k: s[k] for k in ("user", "password") if k in s}


@dataclass(frozen=True)
class Split:
    """A read in `parts` ranges of a numeric column, each its own task; values beyond the bounds fall into the outer ranges."""

    column: str
    low: int
    high: int
    parts: int


def jdbc_options(connection: Connection, sql: str, fetch_size: int = 10_000, snapshot: str | None = None, split: Split | None = None, env: dict[str, str] | None = None) -> dict[str, str]:
    """What Spark's reader needs to know: through one cursor, or with `split` through one for each range."""
    options = connection.options(env) | {"fetchsize": str(fetch_size)}
    if split:
        options |= {"dbtable": f"({sql.strip().rstrip(';')}) AS q", "partitionColumn": split.column, "lowerBound": str(split.low), "upperBound": str(split.high), "numPartitions": str(split.parts)}
    else:
        options["query"] = sql.strip().rstrip(";")
    if snapshot:
        if not re.fullmatch(r"[0-9A-Fa-f-]+", snapshot):
            raise ValueError("not a snapshot's name")
        options["sessionInitStatement"] = f"BEGIN ISOLATION LEVEL REPEATABLE READ; SET TRANSACTION SNAPSHOT '{snapshot}'"
    return options


def jdbc_query(spark: SparkSession, connection: Connection, sql: str, fetch_size: int = 10_000, snapshot: str | None = None, split: Split | None = None) -> DataFrame:
    """A query's rows; `snapshot` is an exported snapshot that several reads share."""
    return spark.read.format("jdbc").options(**jdbc_options(connection, sql, fetch_size, snapshot, split)).load()


class JdbcSession:
    """One database session on the driver, for the few statements that frame an export."""

    def __init__(self, spark: SparkSession, connection: Connection) -> None:
        o = connection.options()
        jvm = spark.sparkContext._jvm
        jvm.java.lang.Class.forName(o["driver"])
        self.jdbc = jvm.java.sql.DriverManager.getConnection(o["url"], o.get("user"), o.get("password"))
        self.jdbc.setAutoCommit(True)

    def run(self, sql: str) -> str | None:
        """The first value that a statement gives, if any."""
        statement = self.jdbc.createStatement()
        if not statement.execute(sql):
            return None
        found = statement.getResultSet()
        return found.getString(1) if found.next() else None

    def close(self) -> None:
        self.jdbc.close()


@contextmanager
def shared_snapshot(open_session: Callable[[], JdbcSession]) -> Iterator[str]:
    """The name of a snapshot that all reads within the block can share: its transaction stays open until the block ends."""
    session = open_session()
    try:
        session.run("BEGIN ISOLATION LEVEL REPEATABLE READ READ ONLY")
        yield session.run("SELECT pg_export_snapshot()")
        session.run("COMMIT")
    except BaseException:
        session.run("ROLLBACK")
        raise
    finally:
        session.close()


def probe(spark: SparkSession, sql: str) -> T.StructType:
    """A query's columns and types, without its rows."""
    return spark.sql(sql).schema


def datasets(spark: SparkSession, folder: str, partition: str = "visit") -> DataFrame:
    """A folder of datasets, `partition`=value folders of Parquet files; values prune folders."""
    return spark.read.option("basePath", folder).parquet(folder).withColumn(partition, F.col(partition).cast("long"))


def id_list(spark: SparkSession, path: str, column: str | None = None) -> DataFrame:
    """The distinct ids of a Parquet file's column, the first one unless named; raises if they are not integers."""
    df = spark.read.parquet(path)
    if not df.columns:
        raise ValueError(f"{path} has no columns")
    column = column or df.columns[0]
    if column not in df.columns:
        raise ValueError(f"{path} has no column {column}")
    kind = df.schema[column].dataType
    if not isinstance(kind, (T.IntegralType, T.StringType, T.DecimalType, T.FractionalType)):
        raise ValueError(f"{column} is {kind.simpleString()}, not convertible to integers")
    return df.select(F.col(column).cast("bigint").alias("id")).where("id IS NOT NULL").distinct()


@dataclass(frozen=True)
class ExportSpec:
    sql: str
    out: str
    row_group_size: int | None = None


def load_specs(path: str | Path) -> list[ExportSpec]:
    """JSON by the file's ending, else YAML: a list of mappings with sql and out."""
    text = Path(path).read_text()
    found = json.loads(text) if str(path).endswith(".json") else yaml.safe_load(text)
    if not isinstance(found, list):
        raise ValueError("export specs must be a list")
    for k, item in enumerate(found):
        if not isinstance(item, dict):
            raise ValueError(f"spec {k} is not a mapping")
        if missing := [x for x in ("sql", "out") if not item.get(x)]:
            raise ValueError(f"spec {k} lacks {', '.join(missing)}")
    return [ExportSpec(item["sql"], item["out"], item.get("row_group_size")) for item in found]


#: Code, longitude east (degrees), rho cos phi', rho sin phi' (Earth radii), name.
OBSERVATORIES = (
    ("500", 0.0, 0.0, 0.0, "Geocentric"),
    ("I11", 289.26345, 0.865020, -0.500901, "Gemini South Observatory, Cerro Pachon"),
    ("X05", 289.25058, 0.864981, -0.500958, "Simonyi Survey Telescope, Rubin Observatory"),
    ("247", None, None, None, "Roving Observer"),
)


def observatories(spark: SparkSession, rows: Sequence[tuple] = OBSERVATORIES) -> DataFrame:
    return spark.createDataFrame(list(rows), "code string, longitude double, rho_cos double, rho_sin double, name string")


def observatory_codes(spark: SparkSession, path: str) -> DataFrame:
    """The public table of observatory codes, a text of fixed columns; a place that is not given is NULL."""
    line = F.col("value")

    def number(start: int, size: int) -> Column:
        return F.expr(f"try_cast(nullif(trim(substring(value, {start}, {size})), '') AS double)")

    rows = spark.read.text(path).where(line.rlike("^[0-9A-Z][0-9]{2} "))
    return rows.select(F.substring(line, 1, 3).alias("code"), number(5, 9).alias("longitude"), number(14, 8).alias("rho_cos"), number(22, 9).alias("rho_sin"), F.trim(F.substring(line, 31, 200)).alias("name"))


def observatory(spark: SparkSession, code: str, table: DataFrame | None = None) -> tuple[float, float, float]:
    """(longitude, rho cos, rho sin) of exactly one observatory with a fixed place."""
    found = (observatories(spark) if table is None else table).where(F.col("code") == code).limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"{len(found)} observatories have the code {code}")
    if any(found[0][k] is None for k in ("longitude", "rho_cos", "rho_sin")):
        raise ValueError(f"{code} has no fixed place")
    return found[0].longitude, found[0].rho_cos, found[0].rho_sin
