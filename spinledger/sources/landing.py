"""Readers and writers of landed JSON files, file inventory, cursor and dictionary scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spinledger import schema
from spinledger.functions.joins import join_dimension
from spinledger.functions.timeparts import release_date
from spinledger.sources.tables import materialise, scratch_folder

CORRUPT = "_corrupt_record"
MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_json(spark: SparkSession, path: str, fields: T.StructType) -> DataFrame:
    """JSON lines with a fixed schema and file lineage; a file with a bad line is left out.

    Lines are parsed once, from text, so that every field of every line is checked whatever
    columns are read later. The parsed rows are kept as a columnar table, in which a bad file is
    known by its marked rows.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file_name"))
    return good_files(staged(lines, fields, scratch_folder(spark) + "/staged"))


def staged(lines: DataFrame, fields: T.StructType, path: str) -> DataFrame:
    """Text lines (value, file_name), parsed once into a table; bad lines keep their text in
    ``_corrupt_record``."""
    checked = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType(), True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rows = lines.filter(F.trim("value") != "").select(
        F.from_json("value", checked, options).alias("_row"), "file_name"
    )
    return materialise(rows.select("_row.*", "file_name"), path)


def bad_files(rows: DataFrame) -> DataFrame:
    """Files (file_name, reason, bad_lines) of a staged table that hold a bad line."""
    bad = rows.filter(F.col(CORRUPT).isNotNull())
    return bad.groupBy("file_name").agg(
        F.min(F.concat(F.lit("not a row: "), F.substring(CORRUPT, 1, 80))).alias("reason"),
        F.count("*").alias("bad_lines"),
    )


def good_files(rows: DataFrame) -> DataFrame:
    """The rows of a staged table without the files that hold a bad line."""
    bad = rows.filter(F.col(CORRUPT).isNotNull()).select("file_name").distinct()
    return join_dimension(rows, bad, "file_name", "left_anti").drop(CORRUPT)


def read_plays(spark: SparkSession, path: str) -> DataFrame:
    """Landed flat plays."""
    return read_json(spark, path, schema.PLAY)


def read_artists(spark: SparkSession, path: str) -> DataFrame:
    """Landed flat artists."""
    return read_json(spark, path, schema.ARTIST)


def read_raw_plays(spark: SparkSession, path: str) -> DataFrame:
    """Landed nested plays."""
    return read_json(spark, path, schema.RAW_PLAY)


FEED_CASTS = {
    "track_popularity": "int",
    "track_duration_ms": "int",
    "preference_score": "double",
    "ml_recommendation_score": "double",
    "ml_weighted_score": "double",
    "genre_novelty_score": "double",
    "artist_novelty_score": "double",
}


def cast_feed(rows: DataFrame) -> DataFrame:
    """Text fields of a feed to their types; values that do not parse become NULL."""
    typed = {
        name: F.col(name).try_cast(kind)
        for name, kind in FEED_CASTS.items()
        if name in rows.columns
    }
    typed["album_release_date"] = release_date(F.col("album_release_date"))
    typed["discovered_at"] = F.try_to_timestamp("discovered_at").cast("timestamp_ntz")
    return rows.withColumns(typed)


def read_discoveries(spark: SparkSession, path: str) -> DataFrame:
    """Landed rows of the search feed."""
    return cast_feed(read_json(spark, path, schema.DISCOVERY_TEXT))


def read_ml_discoveries(spark: SparkSession, path: str) -> DataFrame:
    """Landed rows of the ML feed."""
    return cast_feed(read_json(spark, path, schema.ML_DISCOVERY_TEXT))


# ---------------------------------------------------------------------------
# writers


def write_dated(df: DataFrame, path: str, at: str, mode: str = "append") -> None:
    """Gzipped JSON lines under year=/month=/day= of a timestamp column.

    Rows are rebalanced by day: a large day is written by several tasks, small ones share.
    """
    day = F.to_date(at)
    dated = df.withColumns({"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)})
    (
        dated.hint("rebalance", "year", "month", "day")
        .write.mode(mode)
        .partitionBy("year", "month", "day")
        .option("compression", "gzip")
        .option("timestampNTZFormat", MICROSECONDS)
        .json(path)
    )


def write_plays(plays: DataFrame, path: str, mode: str = "append") -> None:
    write_dated(plays, path, "played_at", mode)


def write_artists(artists: DataFrame, path: str, mode: str = "append") -> None:
    write_dated(artists, path, "ingested_at", mode)


def write_feed(feed: DataFrame, path: str, batch: str, mode: str = "append") -> None:
    """One folder of JSON lines per batch."""
    tagged = feed.withColumn("batch_ts", F.lit(batch))
    writer = tagged.write.mode(mode).partitionBy("batch_ts")
    writer.option("timestampNTZFormat", MICROSECONDS).json(path)


# ---------------------------------------------------------------------------
# inventory, cursor, dictionary


def recent_files(spark: SparkSession, path: str, as_of: Column, days: int = 7) -> DataFrame:
    """Path, bytes and time of the landed files changed in the last days; contents unread."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    ).select("path", "length", "modificationTime")
    return files.filter(F.to_date("modificationTime") >= F.date_sub(as_of, days))


def file_totals(files: DataFrame) -> DataFrame:
    return files.agg(
        F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )


def after_cursor(plays: DataFrame, cursor: DataFrame, now: Column) -> DataFrame:
    """Plays later than the cursor; without a cursor those of the last 24 hours.

    ``cursor`` has at most one row with ``last_played_at``.
    """
    last = cursor.agg(F.max("last_played_at")).scalar()
    start = F.coalesce(last, now - F.expr("INTERVAL 24 HOURS"))
    return plays.filter(F.col("played_at") > start)


def next_cursor(plays: DataFrame, cursor: DataFrame) -> DataFrame:
    """Cursor after the plays; it never moves back."""
    seen = plays.agg(F.max("played_at").alias("last_played_at"))
    both = seen.unionByName(cursor.select("last_played_at"))
    return both.agg(F.max("last_played_at").alias("last_played_at"))


def backfill_window(plays: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """Plays of the last days."""
    return plays.filter(F.col("played_at") > now - F.expr(f"INTERVAL {days} DAYS"))


def read_genre_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Artist-genre CSV with trimmed values; the last line of an artist counts.

    Lines are ordered by file name, then by block of the file, then by place in the block,
    however the files are dealt to tasks.
    """
    rows = spark.read.csv(path, header=True)
    names = rows.columns
    at = F.struct(
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id().alias("line"),
    )
    trimmed = rows.select(*[F.trim(c).alias(c) for c in names], at.alias("_at"))
    last = F.max_by(F.struct(*names[1:]), F.col("_at"))
    return trimmed.groupBy(names[0]).agg(last.alias("_row")).select(names[0], "_row.*")


def not_processed(artists: DataFrame, processed: DataFrame, key: str = "artist_id") -> DataFrame:
    """Artists of a batch that no earlier run has handled."""
    return artists.join(processed.select(key).dropna().distinct(), key, "left_anti")
