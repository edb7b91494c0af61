"""Shared helpers: tables written between steps, text columns, batches of text."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Fixed by the contracts: ASCII white space, and the separators of letter-and-digit words.
SPACES = r"[\x20\x09-\x0D]+"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder inside the one the cluster names; a local one only on a local master."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if not shared:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        shared = tempfile.gettempdir() + "/spinledger-llm"
    return f"{shared}/{context.applicationId}/{uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write a table to the shared folder and read it back."""
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Fewer rows per Arrow batch in the jobs run meanwhile, to bound a worker's memory."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(rows))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Only A-Z, unlike lower(), which folds every script."""
    return F.translate(text, UPPER, UPPER.lower())


def crc_remainder(column: str, modulus: int) -> Column:
    """crc32 of an id as text, modulo; null ids count as empty text."""
    as_text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(as_text.cast("binary")), F.lit(modulus))


def runs(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Cut a batch into consecutive runs of about ``limit`` in total, one item at least."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
