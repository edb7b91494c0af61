"""Materialised result tables as Parquet folders."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Sequence
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spinledger.functions.joins import join_dimension


def scratch_folder(spark: SparkSession) -> str:
    """A new folder inside the one the cluster names; a local one only on a local master."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if shared:
        return f"{shared}/spinledger/{context.applicationId}/{uuid4().hex}"
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    return tempfile.mkdtemp(prefix="spinledger-run-")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, in any store that Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, in any store that Spark writes."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A table written earlier, None where there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def materialise(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()
) -> DataFrame:
    """Replace the table at ``path`` and return it read back.

    ``sort_by`` sorts inside the files, so that their min-max statistics can skip row groups.
    """
    out = df.hint("rebalance", *partition_by) if partition_by else df
    out = out.sortWithinPartitions(*partition_by, *sort_by) if sort_by else out
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite only the partitions that occur in ``df``; large partitions get several tasks."""
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def backup(spark: SparkSession, path: str, copy: str) -> None:
    spark.read.parquet(path).write.mode("errorifexists").parquet(copy)


#: Column of merged tables: number of the batch that last changed a partition.
MARK = "batch"


def merge_partitions(
    delta: DataFrame,
    path: str,
    part: str,
    number: int,
    merge: Callable[[DataFrame | None, DataFrame], DataFrame],
    folder: str | None = None,
) -> DataFrame:
    """Fold batch ``number`` into a partitioned table, rewriting only the partitions it touches.

    ``merge(old, new)`` gets the rows of the touched partitions (None for a new table) and those
    of the batch, and returns what the partitions hold afterwards; both have the column ``part``,
    which must not change. Every partition carries the number of its last batch. A repeated batch
    leaves the partitions alone that it has already reached, so that it changes nothing, even if
    it broke off between two partitions. Returns the touched values of ``part``, read from
    ``folder``, where the batch is kept meanwhile.
    """
    spark = delta.sparkSession
    folder = folder or scratch_folder(spark)
    delta = materialise(delta, folder + "/delta")
    touched = delta.select(part).distinct()
    table = stored(spark, path)
    if table is None:
        merged = merge(None, delta)
    else:
        old = join_dimension(table, touched, part, "left_semi")
        done = old.filter(F.col(MARK) >= number).select(part).distinct()
        old, delta = (join_dimension(rows, done, part, "left_anti") for rows in (old, delta))
        merged = merge(old.drop(MARK), delta)
    # written aside first: the partitions replaced are also the ones read
    rows = materialise(merged.withColumn(MARK, F.lit(number).cast("long")), folder + "/merged")
    replace_partitions(rows, path, [part])
    return touched
