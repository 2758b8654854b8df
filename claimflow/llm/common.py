"""Intermediate tables, shipping of the package, and small column helpers."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow.sources.tables import new_path
from claimflow.sources.tables import stage as save

__all__ = ["ascii_lower", "new_path", "save", "ship", "tables_of"]


@functools.cache
def _package() -> str:
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="claimflow-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, str(source.relative_to(root.parent)))
    return str(archive)


def ship(spark: SparkSession) -> None:
    """Have Spark send this package from the driver to the executors, where it may not be installed."""
    spark.sparkContext.addPyFile(_package())


def tables_of(spark: SparkSession, folder: str, name: str, columns: list[str]) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def lower_ascii(texts: pa.Array) -> pa.Array:
    """A-Z to a-z and nothing else; null as empty."""
    return pc.ascii_lower(pc.fill_null(texts, ""))


ascii_lower = F.arrow_udf(lower_ascii, T.StringType())
