"""Inputs, shared folders and intermediate tables of the operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Whether Spark deletes a query's shuffle files when the query has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster shares: spark.checkpoint.dir. On one machine (tests) it may be unset; we set one of our own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="skylattice-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Within it, queries that write leave no shuffle files behind: what they wrote is in the shared folder."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: lineage ends in the shared folder, so a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    with tidy(df.sparkSession):
        return df.checkpoint(eager=True)


class Scratch:
    """Written tables of one run of an operator; they are deleted when it leaves the `with` block, or before by drop()."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.name = spark, name
        self.folders: dict[int, tuple[DataFrame, str]] = {}

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.drop(*[df for df, _ in self.folders.values()])

    def table(self, df: DataFrame) -> DataFrame:
        """`df` written to the shared folder and read again: its lineage ends there."""
        folder = new_folder(self.spark, self.name)
        with tidy(self.spark):
            df.write.option("compression", "zstd").parquet(folder)
        table = self.spark.read.schema(df.schema).parquet(folder)
        self.folders[id(table)] = table, folder
        return table

    def drop(self, *tables: DataFrame | None) -> None:
        for table in tables:
            if table is not None and id(table) in self.folders:
                delete(self.spark, self.folders.pop(id(table))[1])
