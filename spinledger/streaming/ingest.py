"""Structured Streaming twins: file ingest, dedupe, enrichment, upserts, incremental marts.

The listening cycle is a file stream whose batch step parses the new files once, sets files with
a bad line aside, appends new plays to silver and folds them into the states of the marts. Every
table knows which batch wrote what, so a batch that failed is repeated without adding anything
twice.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spinledger import schema
from spinledger.functions.joins import join_dimension
from spinledger.functions.timeparts import add_local_time
from spinledger.operators import gold, marts
from spinledger.operators.feeds import reduce_ml_source, upsert_ml_discoveries
from spinledger.operators.flatten import flatten_plays
from spinledger.operators.silver import enrich_plays, play_key
from spinledger.sources.landing import bad_files, good_files, not_processed, staged
from spinledger.sources.tables import (
    exists,
    materialise,
    merge_partitions,
    remove,
    replace_partitions,
    scratch_folder,
    stored,
)

Step = Callable[[DataFrame, int], None]


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines (value, file_name) of the new files of a folder; each file is read once."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path).select("value", F.col("_metadata.file_path").alias("file_name"))


def with_play_key(plays: DataFrame) -> DataFrame:
    return plays.withColumn("unique_play", play_key(F.col("played_at"), F.col("track_id")))


def start(
    stream: DataFrame, checkpoint: str, batch: Step, name: str, target: str | None = None
) -> StreamingQuery:
    """Run ``batch`` over all available data, then stop.

    A ``target`` that holds batches of another checkpoint is refused: its batches would be
    numbered from 0 again and replace them.
    """
    spark = stream.sparkSession
    if target is not None and not exists(spark, checkpoint) and stored(spark, target) is not None:
        raise ValueError(f"{target} holds batches that checkpoint {checkpoint} does not know")
    return (
        stream.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(batch)
        .start()
    )


def run_cycle(
    stream: DataFrame, checkpoint: str, batch: Step, name: str, attempts: int = 3, target: str | None = None
) -> int:
    """Run all available batches; a failed one is repeated, ``attempts`` times in all.

    Returns the number of failures. The last error is raised when no attempt is left.
    """
    failures = 0
    while True:
        try:
            start(stream, checkpoint, batch, name, target if failures == 0 else None).awaitTermination()
            return failures
        except StreamingQueryException:
            failures += 1
            if failures >= attempts:
                raise


# ---------------------------------------------------------------------------
# silver


def live_plays(spark: SparkSession, path: str) -> DataFrame | None:
    """The silver plays of all batches, compacted or not; None before the first.

    Batch n owns the partitions ``batch=n``. A compaction of a date up to batch n owns
    ``batch=-n-1``; it counts, and batches up to n don't, once it is in the log.
    """
    rows = stored(spark, path)
    log = stored(spark, path + "_compactions")
    if rows is None or log is None:
        return None if rows is None else rows.filter(F.col("batch") >= 0)
    upto = log.groupBy("local_date").agg(F.max("upto").alias("_upto"))
    compacted = F.coalesce(F.col("_upto"), F.lit(-1))
    shown = (F.col("batch") > compacted) | (F.col("batch") == -compacted - 1) & (compacted >= 0)
    return join_dimension(rows, upto, "local_date").filter(shown).drop("_upto")


def append_by_date(path: str) -> Step:
    """Batch writer of silver plays.

    Every batch owns the folder of its number and replaces it when a failed batch is repeated,
    so that a retry adds nothing twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        replace_partitions(batch.withColumn("batch", F.lit(number)), path, ["batch", "local_date"])

    return write


def append_plays(path: str, artists: DataFrame, quarantine: str | None = None) -> Step:
    """Batch step from landed lines to silver: parse once, one row per play, enrich, append.

    A file with a bad line is skipped whole, as in a batch read; ``quarantine`` names a table that
    remembers it (see ``with_retries``). A play is new if no earlier batch wrote it, however late
    it comes: the play key fixes the local date, so only the dates of the batch are read for
    that. The batch's own number is left out, so that a repeated batch repeats itself. Known plays
    go where the keys of the batch meet, before the others are enriched and written.
    """
    append = append_by_date(path)

    def step(batch: DataFrame, number: int) -> None:
        spark, folder = batch.sparkSession, scratch_folder(batch.sparkSession)
        lines = batch if quarantine is None else with_retries(batch, quarantine, number)
        rows = staged(lines, schema.RAW_PLAY, folder + "/staged")
        if quarantine is not None:
            remember_files(rows, quarantine, number)
        landed = with_play_key(flatten_plays(good_files(rows).drop("file_name")))
        plays = landed.dropDuplicates(["unique_play"])
        written = live_plays(spark, path)
        if written is not None:
            dates = add_local_time(landed.select("played_at")).select("local_date").distinct()
            keys = written.filter(F.col("batch") < number).select("unique_play", "local_date")
            keys = join_dimension(keys, dates, "local_date", "left_semi")
            plays = plays.join(keys, "unique_play", "left_anti")
        append(enrich_plays(plays, artists), number)
        remove(spark, folder)

    return step


def compact(spark: SparkSession, path: str, least: int = 2) -> None:
    """Merge the batch folders of every date that has ``least`` of them, but for the last batch.

    The merged rows are written aside as partitions of their own and shown by one append to the
    log; a compaction that breaks off before shows nothing. The last batch may still be repeated
    by its stream and stays as it is.
    """
    rows = live_plays(spark, path)
    if rows is None:
        return
    last = rows.agg(F.max("batch")).first()[0]
    folders = rows.filter(F.col("batch") < last).groupBy("local_date").agg(
        F.count_distinct("batch").alias("folders")
    )
    folder = scratch_folder(spark)
    dates = materialise(
        folders.filter(F.col("folders") >= least).select("local_date", F.lit(last - 1).alias("upto")),
        folder + "/dates",
    )
    due = join_dimension(rows.filter(F.col("batch") < last), dates, "local_date", "inner")
    merged = due.withColumn("batch", -F.col("upto") - 1).drop("upto")
    replace_partitions(materialise(merged, folder + "/merged"), path, ["batch", "local_date"])
    dates.coalesce(1).write.mode("append").parquet(path + "_compactions")
    remove(spark, folder)


def vacuum(spark: SparkSession, path: str) -> None:
    """Delete the partitions that a logged compaction has replaced."""
    rows, shown = stored(spark, path), live_plays(spark, path)
    if rows is None or stored(spark, path + "_compactions") is None:
        return
    # a row per folder: bounded by dates times the batches since the last vacuum
    keys = ["batch", "local_date"]
    hidden = rows.select(*keys).distinct().join(shown.select(*keys).distinct(), keys, "left_anti")
    for row in hidden.toLocalIterator():
        remove(spark, f"{path}/batch={row.batch}/local_date={row.local_date}")


# ---------------------------------------------------------------------------
# files that could not be read


MAX_ATTEMPTS = 3


def quarantined(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """Files that failed: file_name, reason, attempts, last_batch, and whether a later attempt
    was good; only attempts of batches before ``before``."""
    rows = stored(spark, path)
    if rows is None:
        return None
    if before is not None:
        rows = rows.filter(F.col("batch") < before)
    return rows.groupBy("file_name").agg(
        F.max_by("reason", F.when(F.col("reason").isNotNull(), F.col("batch"))).alias("reason"),
        F.count("*").alias("attempts"),
        F.max("batch").alias("last_batch"),
        F.bool_or(F.col("reason").isNull()).alias("recovered"),
    )


def with_retries(batch: DataFrame, quarantine: str, number: int) -> DataFrame:
    """The lines of a batch and of the files that failed before and have an attempt left."""
    spark = batch.sparkSession
    failed = quarantined(spark, quarantine, number)
    if failed is None:
        return batch
    due = failed.filter(~F.col("recovered") & (F.col("attempts") < MAX_ATTEMPTS))
    files = [row.file_name for row in due.select("file_name").toLocalIterator()]  # failed files only
    if not files:
        return batch
    again = spark.read.text(files).select("value", F.col("_metadata.file_path").alias("file_name"))
    return batch.unionByName(again)


def remember_files(rows: DataFrame, quarantine: str, number: int) -> None:
    """Record the files of a staged batch that failed, and those that failed before but not now."""
    spark = rows.sparkSession
    bad = bad_files(rows)
    failed = quarantined(spark, quarantine, number)
    if failed is not None:
        tried = rows.select("file_name").distinct().join(failed.select("file_name"), "file_name")
        good = tried.join(bad.select("file_name"), "file_name", "left_anti")
        bad = bad.unionByName(
            good.select("file_name", F.lit(None).cast("string").alias("reason"), F.lit(0).cast("long").alias("bad_lines"))
        )
    attempts = materialise(bad.withColumn("batch", F.lit(number)), scratch_folder(spark) + "/attempts")
    if not attempts.isEmpty():
        replace_partitions(attempts, quarantine, ["batch"])


# ---------------------------------------------------------------------------
# marts


#: Partitions of a mart's states and rows: the day, the month, or one of so many genre buckets.
GENRE_PARTS = 32


def part_of(mart: str) -> Column:
    if mart == "day":
        return F.col("local_date")
    if mart == "month":
        return F.col("local_year") * 100 + F.col("local_month")
    return F.pmod(F.xxhash64("primary_genre"), F.lit(GENRE_PARTS)).cast("int")


MARTS = {
    "day": (marts.DAY, gold.day_rows),
    "genre": (marts.GENRE, gold.genre_rows),
    "month": (marts.MONTH, gold.month_rows),
}


def refresh_marts(state_path: str, gold_path: str) -> Step:
    """Batch step that folds new silver plays into the daily, genre and monthly marts.

    The states of the batch are merged into the stored states of the partitions it touches, and
    only the mart rows of these are finished again, from the states. No play is read twice, and
    distinct counts stay exact. ``open_marts`` reads the tables.
    """

    def step(plays: DataFrame, number: int) -> None:
        folder = scratch_folder(plays.sparkSession)

        def refreshed(name: str) -> None:
            mart, finish = MARTS[name]

            def merge(old: DataFrame | None, new: DataFrame) -> DataFrame:
                both = new if old is None else old.unionByName(new)
                return mart.merge(both.drop("part")).withColumn("part", part_of(name))

            delta = mart.states(plays).withColumn("part", part_of(name))
            states = f"{state_path}/{name}"
            touched = merge_partitions(delta, states, "part", number, merge, f"{folder}/{name}")
            rows = join_dimension(plays.sparkSession.read.parquet(states), touched, "part", "left_semi")
            done = finish(rows.drop("part", "batch")).withColumn("part", part_of(name))
            replace_partitions(done, f"{gold_path}/{name}", ["part"])

        # side by side: most of their jobs are too short to fill a cluster
        with ThreadPoolExecutor(len(MARTS)) as pool:
            list(pool.map(inheritable_thread_target(plays.sparkSession)(refreshed), MARTS))
        remove(plays.sparkSession, folder)

    return step


def open_marts(spark: SparkSession, gold_path: str) -> dict[str, DataFrame]:
    """Daily summary, genre analysis and monthly insights as the last batch left them."""
    rows = {name: spark.read.parquet(f"{gold_path}/{name}").drop("part") for name in MARTS}
    return {
        "daily_summary": rows["day"],
        "genre_analysis": gold.ranked_genres(rows["genre"]),
        "monthly_insights": gold.grown_months(rows["month"]),
    }


def silver_and_gold(
    silver_path: str, gold_path: str, artists: DataFrame, quarantine: str | None = None
) -> Step:
    """The listening cycle: silver append, then the marts of what the batch added."""
    append = append_plays(silver_path, artists, quarantine)
    refresh = refresh_marts(gold_path + "_states", gold_path)

    def step(batch: DataFrame, number: int) -> None:
        append(batch, number)
        written = stored(batch.sparkSession, silver_path)
        if written is not None:
            added = written.filter(F.col("batch") == number).drop("batch")
            if not added.isEmpty():  # else no mart changes
                refresh(added, number)

    return step


# ---------------------------------------------------------------------------
# upserts


#: Partitions of an upserted table; a batch of few keys touches few of them.
UPSERT_PARTS = 64


def upsert_ml(path: str, now: Column | None = None, parts: int = UPSERT_PARTS) -> Step:
    """Batch upsert into a table partitioned by a hash of the track.

    Only partitions that hold a track of the batch are read and rewritten, and a repeated batch
    raises no counter twice (see ``merge_partitions``).
    """
    part = F.pmod(F.xxhash64("track_id"), F.lit(parts)).cast("int")

    def step(batch: DataFrame, number: int) -> None:
        at = F.current_timestamp().cast("timestamp_ntz") if now is None else now
        rows = batch.withColumn("ingested_at", F.col("discovered_at")).drop("batch_timestamp")

        def merge(old: DataFrame | None, new: DataFrame) -> DataFrame:
            new = new.drop("part")
            target = empty_ml_table(new) if old is None else old.drop("part")
            return upsert_ml_discoveries(target, new, at).withColumn("part", part)

        folder = scratch_folder(batch.sparkSession)
        merge_partitions(rows.withColumn("part", part), path, "part", number, merge, folder)
        remove(batch.sparkSession, folder)

    return step


def empty_ml_table(rows: DataFrame) -> DataFrame:
    never = F.lit(None).cast("timestamp_ntz")
    return reduce_ml_source(rows).withColumns({"created_at": never, "updated_at": never}).limit(0)


def process_new_artists(
    processed_path: str, handle: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """Hand only artists unseen by earlier batches to ``handle``, then record them."""

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        ids = batch.dropDuplicates(["artist_id"])
        if number > 0:
            # a repeated batch must not see its own record
            seen = spark.read.parquet(processed_path).filter(F.col("batch") < number)
            ids = not_processed(ids, seen)
        handle(ids, number)
        replace_partitions(
            ids.select("artist_id").withColumn("batch", F.lit(number)), processed_path, ["batch"]
        )

    return step
