"""Session settings shared by the CLI, the bench and the tests."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(app: str = "skylattice", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine is written for: UTC, ANSI, adaptive execution. Cluster settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    return builder.config(map=settings | conf).getOrCreate()


def local_session(cores: int | None = None, **conf: str) -> SparkSession:
    cores = cores or os.cpu_count() or 4
    small = {"spark.sql.shuffle.partitions": str(cores), "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    return session(master=f"local[{cores}]", **(small | conf))
