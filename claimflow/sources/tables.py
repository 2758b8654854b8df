"""Reading base tables, saving stages, temporary results and views."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow.functions.expressions import is_missing
from claimflow.operators.shaping import Field

SCAN_PARTITIONS = "claimflow.scan.partitions"


def load(spark: SparkSession, folder: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A base table by name: one Parquet file or folder `<name>.parquet`.

    How a table is split is up to its row groups and `spark.sql.files.*`. For a table that came as one large row
    group a user can set `claimflow.scan.partitions`, and it is dealt out evenly before cleaning; unset by default.
    """
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    df = df.select(*columns) if columns else df
    parts = spark.conf.get(SCAN_PARTITIONS, "")
    return df.repartition(int(parts)) if parts else df


def load_text(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """A delimited export. All columns arrive as text under a declared schema; nothing is inferred."""
    return spark.read.schema(schema).csv(path, header=header, quote='"', escape='"')


def load_text_checked(
    spark: SparkSession, path: str, schema: str, contract: Sequence[Field] = (), header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """A delimited export in two parts: the rows that can be read, and those that cannot (record, reasons).

    A row is rejected where its number of columns is not that of the schema (`columns`), or where an entered value of a
    money, date or int column of the contract cannot be read (`unreadable` and the column). The record is the line as it
    stands for the former, and the row written again for the latter. Every line of the files but headers and empty
    lines is in one of the two parts.
    """
    columns = T.StructType.fromDDL(schema)
    whole = T.StructType([*columns.fields, T.StructField("__corrupt", T.StringType())])
    # a parser that reads only the columns asked for does not see that a line has too few or too many
    options = {"header": header, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnPruning": "false", "columnNameOfCorruptRecord": "__corrupt"}
    broken = F.col("__corrupt").isNotNull()
    unreadable = [
        F.when(~broken & ~is_missing(f.source) & f.parsed().isNull(), F.lit(f"unreadable {f.source}")) for f in contract if f.kind != "text"
    ]
    reasons = F.array_compact(F.array(F.when(broken, F.lit("columns")), *unreadable))
    read = spark.read.schema(whole).options(**options).csv(path).withColumn("reasons", reasons)
    good = F.size("reasons") == 0
    record = F.coalesce("__corrupt", F.to_csv(F.struct(*columns.names)))
    return read.where(good).select(*columns.names), read.where(~good).select(record.alias("record"), "reasons")


def load_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A database table; pass partitionColumn, lowerBound, upperBound and numPartitions to read in parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def save_stage(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Materialise a stage as Parquet and continue from the written files, which also cuts the lineage."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


CHECKPOINT_CONF = "spark.checkpoint.dir"


@functools.cache
def _local_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="claimflow-")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate tables; a session on this machine alone gets one of its own."""
    folder = spark.conf.get(CHECKPOINT_CONF, "")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
    return _local_folder()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """`save_stage` into the shared folder, under a path of its own."""
    return save_stage(df, new_path(df.sparkSession, name))


def save_bucketed(
    df: DataFrame, table: str, keys: Sequence[str], buckets: int, sort: Sequence[str] = (), path: str | None = None
) -> DataFrame:
    """Materialise a stage as a table bucketed by `keys` and sorted within its buckets by `sort` (the keys by default).

    Two tables of the same buckets join on the keys without a shuffle, and a filter on the keys reads their buckets
    alone. `path` names a place outside the warehouse.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite")
    writer = writer.option("path", path) if path else writer
    writer.bucketBy(buckets, *keys).sortBy(*(sort or keys)).saveAsTable(table)
    return df.sparkSession.table(table)


def append_stage(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def register_views(spark: SparkSession, views: dict[str, Callable[[], DataFrame]]) -> None:
    """Named temporary views over lazily built results."""
    for name, build in views.items():
        build().createOrReplaceTempView(name)
