"""Command lines: export, extract, objects, schema."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from contextlib import nullcontext

from skylattice.session import session
from skylattice.sinks import writers
from skylattice.sources import readers, schema_yaml


def export(argv: Sequence[str] | None = None) -> int:
    """Query results to Parquet: one by --sql and --out, or all of --config; from Postgres, or over Parquet views with --views."""
    p = argparse.ArgumentParser(prog="skylattice-export")
    for name in ("service", "dsn", "host", "dbname", "user", "password", "sql", "out", "config"):
        p.add_argument(f"--{name}")
    p.add_argument("--port", type=int)
    p.add_argument("--snapshot", help="exported snapshot that all reads share")
    p.add_argument("--views", help="folder whose *.parquet become views; then no database is used")
    p.add_argument("--row-group-size", type=int, default=writers.ROW_GROUP_ROWS)
    p.add_argument("--overwrite", action="store_true")
    a = p.parse_args(argv)
    if a.config and (a.sql or a.out):
        p.error("--config excludes --sql and --out")
    if not a.config and not (a.sql and a.out):
        p.error("give --config, or --sql and --out")
    specs = readers.load_specs(a.config) if a.config else [readers.ExportSpec(a.sql, a.out)]
    spark = session("skylattice-export")
    if a.views:
        for view, path in view_paths(spark, a.views).items():
            spark.read.parquet(path).createOrReplaceTempView(view)
    else:
        connection = readers.Connection(a.dsn, a.service, a.host, a.port, a.dbname, a.user, a.password)
        # several queries see one state of the database
        own = readers.shared_snapshot(lambda: readers.JdbcSession(spark, connection)) if len(specs) > 1 and not a.snapshot else nullcontext(a.snapshot)
        with own as snapshot:
            written = writers.export(lambda sql: readers.jdbc_query(spark, connection, sql, snapshot=snapshot), specs, a.row_group_size, "overwrite" if a.overwrite else "errorifexists")
        print(*written, sep="\n")
        return 0
    for out in writers.export(spark.sql, specs, a.row_group_size, "overwrite" if a.overwrite else "errorifexists"):
        print(out)
    return 0


def view_paths(spark, folder: str) -> dict[str, str]:
    """The *.parquet entries of a folder in any file system that Spark reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = [f.getPath().toString() for f in found]
    return {n.rstrip("/").rsplit("/", 1)[-1].removesuffix(".parquet"): n for n in names if n.rstrip("/").endswith(".parquet")}


def extract(argv: Sequence[str] | None = None) -> int:
    """Datasets of a folder, or their rows whose ids are listed, into one partitioned table."""
    from skylattice.plans.catalogs import extract_catalog

    p = argparse.ArgumentParser(prog="skylattice-extract")
    p.add_argument("folder")
    p.add_argument("output")
    p.add_argument("--ids")
    p.add_argument("--id-column")
    p.add_argument("--column", default="diaSourceId")
    p.add_argument("--dataset", default="visit")
    p.add_argument("--compression", default="zstd")
    a = p.parse_args(argv)
    spark = session("skylattice-extract")
    rows = extract_catalog(spark, a.folder, a.ids, a.column, a.id_column, a.dataset)
    print(writers.write_per_dataset(rows, a.output, a.dataset, compression=a.compression))
    return 0


def objects(argv: Sequence[str] | None = None) -> int:
    """The per-object catalogue from the per-source one, sources and orbits."""
    from skylattice.plans.catalogs import build_ssobject

    p = argparse.ArgumentParser(prog="skylattice-objects")
    for name in ("sssource", "diasource", "mpcorb"):
        p.add_argument(name)
    p.add_argument("--output", required=True)
    p.add_argument("--sentinels", action="store_true")
    p.add_argument("--reraise", action="store_true")
    a = p.parse_args(argv)
    try:
        spark = session("skylattice-objects")
        sss, dia, orb = (spark.read.parquet(x) for x in (a.sssource, a.diasource, a.mpcorb))
        writers.write_parquet(build_ssobject(sss, dia, orb, sentinels=a.sentinels), a.output)
    except Exception as e:
        if a.reraise:
            raise
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


def schema(argv: Sequence[str] | None = None) -> int:
    """Python source or DDL of the tables that a YAML file defines."""
    p = argparse.ArgumentParser(prog="skylattice-schema")
    p.add_argument("yaml")
    p.add_argument("tables", nargs="*")
    p.add_argument("--ddl", action="store_true")
    a = p.parse_args(argv)
    found = schema_yaml.load_tables(a.yaml)
    names = a.tables or [n for n in schema_yaml.DEFAULT_TABLES if n in found] or list(found)
    print(f"# Generated from {a.yaml}; do not edit.\n" + ("" if a.ddl else "from pyspark.sql.types import *  # noqa: F403\n"))
    for name in names:
        compiled = schema_yaml.compile_table(found[name])
        print((schema_yaml.ddl(name, compiled) + ";" if a.ddl else schema_yaml.render(name, compiled, found[name].get("description"))) + "\n")
    return 0
