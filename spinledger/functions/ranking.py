"""Ranking helpers: top-k per group, global top-k, percentile rank, exact row numbers."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spinledger.functions.rounding import half_up


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """First ``k`` rows of every group, numbered from 1.

    Catalyst trims each map task to its own first ``k`` rows before the shuffle
    (WindowGroupLimit), so a hot group reaches its task already reduced.
    """
    return df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(
        F.col(rank) <= k
    )


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_per_group(df, keys, order, 1, "_first").drop("_first")


def top_n(df: DataFrame, order: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """Global first ``n`` rows, optionally numbered; only those ``n`` rows meet in one task."""
    out = df.orderBy(*order).limit(n)
    if rank is None:
        return out
    return out.withColumn(rank, F.row_number().over(W.orderBy(*order)))


def most_frequent(
    df: DataFrame, keys: Sequence[str], value: str, count: str = "plays"
) -> DataFrame:
    """Most frequent value per group with its count; ties go to the smaller value."""
    counted = df.groupBy(*keys, value).agg(F.count("*").alias(count))
    return first_per_group(counted, keys, [F.desc(count), F.col(value).asc_nulls_last()])


def average_percent_rank(df: DataFrame, value: str, out: str) -> DataFrame:
    """Percentile rank in (0, 1], ties sharing their average rank.

    Ranks are worked out on the distinct values with their counts and looked up from each
    row. Meant for play counts: the values of a count column that sums to N plays number at
    most sqrt(2N), which bounds both the one-task window and the broadcast.
    """
    up_to = W.orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    everything = W.partitionBy()
    ranks = (
        df.groupBy(value)
        .agg(F.count("*").alias("_ties"))
        .withColumn("_upto", F.sum("_ties").over(up_to))
        .withColumn("_all", F.sum("_ties").over(everything))
        .select(
            F.col(value).alias("_value"),
            ((F.col("_upto") - (F.col("_ties") - 1) / 2) / F.col("_all")).alias(out),
        )
    )
    return df.join(F.broadcast(ranks), F.col(value).eqNullSafe(F.col("_value"))).drop("_value")


def ensure_checkpoint_dir(df: DataFrame) -> None:
    """Use the folder the cluster names; set a local one only where none is named."""
    spark = df.sparkSession
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
    elif context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spinledger-checkpoint-"))


def exact_row_number(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Gap-free row number over a total order without a one-task window.

    Rows are range-partitioned and sorted by ``order`` (which should end in a unique key, so
    that no range is hot), frozen by a checkpoint so that every later read sees the same
    partitions, and numbered as position in the partition plus the rows before it.
    """
    ensure_checkpoint_dir(df)
    frozen = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumns(
            {
                "_part": F.shiftright("_id", 33),
                "_pos": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)),
            }
        )
        .checkpoint()
    )
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        frozen.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select("_part", "_before")
    )
    # one row per partition of the frozen table: bounded by the shuffle-partition setting
    return (
        frozen.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_before") + F.col("_pos") + 1)
        .drop("_id", "_part", "_pos", "_before")
    )


def rank_in_group(df: DataFrame, key: str, order: Sequence[Column], out: str) -> DataFrame:
    """Row number within every value of ``key`` without gathering a group in one task.

    Rows are range-partitioned and sorted by key and order (total within a key), and frozen by a
    checkpoint. A row's number is its place among the rows of its key in its range, plus the
    rows of the key in the ranges before.
    """
    ensure_checkpoint_dir(df)
    frozen = (
        df.repartitionByRange(F.col(key), *order)
        .sortWithinPartitions(F.col(key), *order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", 33))
        .checkpoint()
    )
    before = W.partitionBy("_key").orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    # a row per key and range: a key that spans ranges has at most one per range
    firsts = (
        frozen.groupBy(F.col(key).alias("_key"), F.col("_part").alias("_p"))
        .agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    match = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_p"))
    number = F.col("_id") - F.col("_first") + F.col("_before") + 1
    return (
        frozen.join(firsts, match)
        .withColumn(out, number.cast("int"))
        .drop("_id", "_part", "_key", "_p", "_first", "_before")
    )


def share(part: Column, total: Column, digits: int = 2) -> Column:
    """Percentage, NULL for an empty total."""
    return half_up(F.try_divide(part * F.lit(100.0), total), digits)


def count_if_pct(condition: Column, digits: int = 1) -> Column:
    """Percentage of the group's rows that satisfy ``condition``."""
    return half_up(F.lit(100.0) * F.count_if(condition) / F.count("*"), digits)
