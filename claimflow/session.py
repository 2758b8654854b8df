"""Spark session defaults for local runs and tests; a cluster brings its own session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


# Methods above this size are not compiled by the JVM. Below the limit Spark splits a long projection
# into small methods instead of generating one that is only interpreted.
COMPILED = {"spark.sql.codegen.hugeMethodLimit": "8000"}
SETTINGS = {
    **COMPILED,
    # A heavy key is split in a join even where what follows has to shuffle once more for it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def compiled(spark: SparkSession) -> None:
    """Have the session compile wide projections, unless it came with a limit of its own. Results do not depend on it."""
    own = spark.conf.getAll
    for key, value in COMPILED.items():
        if key not in own:
            spark.conf.set(key, value)


def local_session(cores: int | str = 8, app: str = "claimflow") -> SparkSession:
    spark = (
        SparkSession.builder.config(map=SETTINGS)
        .master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", os.environ.get("CLAIMFLOW_SHUFFLE_PARTITIONS", "8"))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CLAIMFLOW_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
