"""Joins that stay safe when a side is large or one key is hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_SETTING = "spinledger.broadcast.maxBytes"
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
SALTS = 16
#: Of a row besides its values: header, key, pointer and slots of a hash table.
ROW_BYTES = 64


def planned_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan, or None where the session does not expose it.

    It takes files for as large as they are on disk; see ``packing``.
    """
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def packing(df: DataFrame) -> float:
    """How many times larger than its files the most compressed table of a plan is as rows, at least 1.

    Encoded columns may take a few bits of a file and fill memory once read. Rows are counted from
    the files, which for Parquet reads the footers alone, and take the width of the table's schema.
    """
    session = df.sparkSession
    frames = session._jvm.org.apache.spark.sql.classic.Dataset
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    most = 1.0
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        if leaf.getClass().getSimpleName() == "LogicalRelation" and not leaf.isStreaming():
            size = int(str(leaf.relation().sizeInBytes()))
            rows = frames.ofRows(session._jsparkSession, leaf).count()
            most = max(most, rows * (ROW_BYTES + leaf.schema().defaultSize()) / max(size, 1))
    return most


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether a plan's rows, not only the files behind them, are surely below the limit."""
    if max_bytes is None:
        max_bytes = int(df.sparkSession.conf.get(BROADCAST_SETTING, str(BROADCAST_MAX_BYTES)))
    size = planned_bytes(df)
    if size is None or size > max_bytes:  # files are counted only where it may change the answer
        return False
    return size * packing(df) <= max_bytes


def join_dimension(
    facts: DataFrame,
    dim: DataFrame,
    on: Column | str | Sequence[str],
    how: str = "left",
    max_bytes: int | None = None,
) -> DataFrame:
    """Join facts to a dimension; broadcast only below the size limit.

    Beyond the limit the join is left to Catalyst, whose adaptive execution measures both
    sides at run time and splits hot partitions.
    """
    return facts.join(F.broadcast(dim) if fits_broadcast(dim, max_bytes) else dim, on, how)


def hot_keys(facts: DataFrame, key: str, pieces: int) -> DataFrame:
    """Keys (_hot, _salts) that hold more than ``1 / pieces`` of the facts, from counted rows.

    ``_salts`` is the number of pieces of that size. At most ``pieces`` keys qualify, whatever
    the data, so the result may be broadcast. NULL meets nothing in a join and is left out.
    """
    counts = facts.groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("_rows"))
    piece = F.greatest(F.ceil(facts.agg(F.count("*")).scalar() / pieces), F.lit(1))
    return counts.filter((F.col("_rows") > piece) & F.col("_hot").isNotNull()).select(
        "_hot", F.ceil(F.col("_rows") / piece).cast("int").alias("_salts")
    )


def salted_dimension_join(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    spread_by: Sequence[str],
    how: str = "left",
    salts: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Left or inner join where one key may hold a large share of the facts.

    A small dimension is broadcast. For a large one the facts per key are counted first, by map
    tasks that read the key alone, and every hot key gets salts by its count: ``SALTS`` pieces
    per shuffle partition share all facts, and a key goes to as many as it fills. Only the hot
    keys' dimension rows are copied, once per salt; cold keys meet their one row. A fact's salt
    is a hash of its own columns (``spread_by``), not random, so a re-run task repeats it. NULL
    keys, which match nothing, are spread over all pieces. ``salts`` fixes the number of pieces.
    """
    if how not in ("left", "inner"):
        raise ValueError("only left and inner joins can be salted on the right side")
    if fits_broadcast(dim, max_bytes):
        return facts.join(F.broadcast(dim), F.col(fact_key) == F.col(dim_key), how)
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = salts or SALTS * partitions
    hot = F.broadcast(hot_keys(facts, fact_key, pieces))
    own = F.when(F.col(fact_key).isNull(), F.lit(pieces)).otherwise(F.coalesce("_salts", F.lit(1)))
    salted_facts = (
        facts.join(hot, F.col(fact_key) == F.col("_hot"), "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*spread_by), own).cast("int"))
        .drop("_hot", "_salts")
    )
    copied = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    copies = (
        dim.join(hot, F.col(dim_key) == F.col("_hot"), "left")
        .withColumn("_copy", F.explode(copied))
        .drop("_hot", "_salts")
    )
    match = (F.col(fact_key) == F.col(dim_key)) & (F.col("_salt") == F.col("_copy"))
    return salted_facts.join(copies, match, how).drop("_salt", "_copy")
