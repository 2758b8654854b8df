"""Stages that are checked while they are written, worked on slice by slice, changed partition by partition, and removed."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from claimflow.operators.relational import update_from
from claimflow.sources.tables import new_path, save_stage, shared_folder, stage

CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SLICE = "__slice"
ROWS_A_CORE = 4_000_000  # rows that a slice holds for every core, about
MOST_PARTITIONS = 10_000  # partitions that one change may touch; their values come to the driver


def save_checked(df: DataFrame, path: str, rules: Mapping[str, Column], partition_by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Write a stage, and count its rows and the violations of every rule in the same job.

    Gives back the stage and a table (rule, violations, checked) with a row for each rule. A rule that is unknown for a
    row is not broken by it.
    """
    seen = Observation()
    counts = [F.count_if(F.coalesce(broken, F.lit(False))).alias(f"r{k}") for k, broken in enumerate(rules.values())]
    written = save_stage(df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), path, partition_by)
    found = seen.get  # one row of numbers
    rows = [(rule, found[f"r{k}"], found["rows"]) for k, rule in enumerate(rules)]
    return written, df.sparkSession.createDataFrame(rows, "rule string, violations long, checked long")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Tables written within leave no shuffle files behind; otherwise these stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP_CONF, "false")
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_CONF, before)


def slices_for(spark: SparkSession, rows: int) -> int:
    """Slices of about ROWS_A_CORE rows for every core of the session, so that what a slice takes on a disk does not grow."""
    return max(1, -(-rows // (ROWS_A_CORE * spark.sparkContext.defaultParallelism)))


def by_slices(rows: DataFrame, keys: Sequence[str], work: Callable[[DataFrame], DataFrame], slices: int, name: str) -> DataFrame:
    """`work(rows)`, for work that looks at every key's rows apart, done for one slice of the keys after the other.

    Rows are written once, parted by the hash of their keys (NULL is a key), and every slice's result is written; the
    shuffles of a slice go before the next begins. So disks hold the rows, the results and the shuffles of one slice. A
    single slice is written alone and not worked on before its result is asked for.
    """
    spark = rows.sparkSession
    with shuffles_dropped(spark):
        if slices == 1:
            return work(stage(rows, name))
        placed = rows.withColumn(SLICE, F.pmod(F.xxhash64(*keys), F.lit(slices)))
        parted = save_stage(placed, new_path(spark, name), [SLICE])
        parts = [stage(work(parted.where(F.col(SLICE) == k).drop(SLICE)), f"{name}-slice") for k in range(slices)]
    return reduce(DataFrame.unionByName, parts)


def rewrite_partitions(
    path: str, changes: DataFrame, partition: str, keys: Sequence[str], columns: Sequence[str], guard: Column | None = None
) -> list:
    """Take `columns` from `changes` (one row per key, with the partition its key lies in) into a partitioned stage.

    Only the partitions named in `changes` are read and replaced. Their new rows are written aside first, then take the
    places of the old ones when the job commits; a rerun, also of a run that died in its commit, gives the same rows, as
    values are set and not added. Gives back the partitions that were rewritten, in order.
    """
    spark = changes.sparkSession
    touched = changes.select(partition).distinct().limit(MOST_PARTITIONS + 1).collect()
    if len(touched) > MOST_PARTITIONS:
        raise ValueError(f"a change may touch {MOST_PARTITIONS} partitions")
    values = sorted(r[0] for r in touched)
    if not values:
        return []
    whole = spark.read.parquet(path)
    rows = whole.where(F.col(partition).isin(values))
    aside = new_path(spark, "rewritten")
    new = save_stage(update_from(rows, changes.drop(partition), keys, columns, guard).select(*whole.columns), aside)
    writer = new.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition).parquet(path)
    drop_stage(spark, aside)
    return values


def drop_stage(spark: SparkSession, path: str) -> bool:
    """Remove a stage from the shared folder for intermediate tables; paths outside it are refused."""
    folder = shared_folder(spark)
    if not path.startswith(folder + "/") or "/.." in path:
        raise ValueError(f"{path} does not lie in {folder}")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
