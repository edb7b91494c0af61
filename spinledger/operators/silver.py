"""Bronze dedupe, silver enrichment, and row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinledger.functions import tiers
from spinledger.functions.joins import join_dimension, salted_dimension_join
from spinledger.functions.ranking import exact_row_number, first_per_group
from spinledger.functions.timeparts import add_local_time, release_date, release_year, since
from spinledger.params import LOCAL_TZ

ARTIST_ATTRIBUTES = {
    "artist_popularity": "popularity",
    "artist_followers": "followers_total",
    "primary_genre": "primary_genre",
    "all_genres": "genres_list",
    "genre_count": "genre_count",
}


def latest_artists(landed: DataFrame) -> DataFrame:
    """Latest landed row of every artist."""
    order = [F.desc_nulls_last("ingested_at"), F.col("artist_name"), F.col("data_source")]
    return first_per_group(landed, ["artist_id"], order)


def play_key(played_at: Column, track_id: Column) -> Column:
    """Key of a play: second of the play and the track."""
    return F.concat(F.date_format(played_at, "yyyyMMdd_HHmmss"), F.lit("_"), track_id)


def dedupe_plays(
    plays: DataFrame, key: str = "unique_play", order: Sequence[Column] | None = None
) -> DataFrame:
    """One row per play key, by default the latest landed one."""
    return first_per_group(plays, [key], order or [F.desc("ingested_at"), F.col("played_at")])


def with_artist(plays: DataFrame, artists: DataFrame, how: str = "left") -> DataFrame:
    """Plays joined to their artist's attributes; a hot or missing artist id is spread."""
    dim = artists.select(
        F.col("artist_id").alias("_artist"),
        *[F.col(source).alias(name) for name, source in ARTIST_ATTRIBUTES.items()],
    )
    return salted_dimension_join(
        plays, dim, "primary_artist_id", "_artist", spread_by=["unique_play"], how=how
    ).drop("_artist")


def enrich_plays(
    plays: DataFrame,
    artists: DataFrame,
    tz: str = LOCAL_TZ,
    exact_event_number: bool = False,
) -> DataFrame:
    """Silver row of every deduplicated play.

    ``listening_event_id`` is a hash of the play key. With ``exact_event_number`` it is the
    position in local-time order instead, which costs a range shuffle and a checkpoint.
    """
    local = add_local_time(with_artist(plays, artists), "played_at", tz)
    released = release_date(F.col("album_release_date"))
    out = local.select(
        "unique_play",
        F.xxhash64("unique_play").alias("listening_event_id"),
        "local_timestamp",
        "local_date",
        "local_hour",
        "local_day_of_week",
        "local_month",
        "local_year",
        "local_quarter",
        "is_weekend",
        "time_of_day_category",
        F.col("played_at").alias("utc_played_at"),
        F.col("played_at_timestamp").alias("utc_timestamp"),
        "track_id",
        "track_name",
        "track_duration_ms",
        F.round(F.col("track_duration_ms") / 60000.0, 2).alias("track_duration_minutes"),
        "track_popularity",
        "track_explicit",
        "track_preview_url",
        "track_uri",
        "primary_artist_id",
        "primary_artist_name",
        *ARTIST_ATTRIBUTES,
        (F.coalesce(F.col("genre_count"), F.lit(0)) > 1).alias("is_multi_genre_artist"),
        "album_id",
        "album_name",
        "album_type",
        "album_release_date",
        release_year(F.col("album_release_date"), None).alias("album_release_year"),
        "album_total_tracks",
        (F.year("local_timestamp") - F.year(released)).alias("album_age_years"),
        F.coalesce(F.col("album_type") == "single", F.lit(False)).alias("is_single"),
        F.coalesce(F.col("album_type") == "compilation", F.lit(False)).alias("is_compilation"),
        "context_type",
        "context_uri",
        F.coalesce(F.col("context_type"), F.lit("unknown")).alias("listening_source"),
        "ingested_at",
        "data_source",
    )
    if exact_event_number:
        order = ["local_timestamp", "unique_play"]
        out = exact_row_number(out.drop("listening_event_id"), order, "listening_event_id")
    return out


RECENT_LISTEN_COLUMNS = [
    "unique_play", "local_timestamp", "played_at", "played_at_timestamp", "played_at_date",
    "played_at_hour", "track_id", "track_name", "track_duration_ms", "track_popularity",
    "track_explicit", "track_preview_url", "track_external_urls", "track_uri",
    "primary_artist_id", "primary_artist_name", "primary_genre", "genres_list", "genre_count",
    "artist_popularity", "artist_followers", "album_id", "album_name", "album_type",
    "album_release_date", "album_total_tracks", "context_type", "context_uri",
    "context_external_urls", "ingested_at", "data_source",
]


def recent_listens(plays: DataFrame, artists: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """Plays with artist attributes, the input of the preference features."""
    joined = add_local_time(with_artist(plays, artists), "played_at", tz)
    return joined.withColumnRenamed("all_genres", "genres_list").select(*RECENT_LISTEN_COLUMNS)


def with_tiers(tracks: DataFrame) -> DataFrame:
    """Append release year, era, popularity tier and duration bucket."""
    return tracks.withColumn("release_year", release_year(F.col("album_release_date"))).withColumns(
        {
            "era_category": tiers.era(F.col("release_year")),
            "popularity_tier": tiers.popularity_tier(F.col("track_popularity")),
            "duration_category": tiers.duration_bucket(F.col("track_duration_ms")),
        }
    )


# ---------------------------------------------------------------------------
# filters


def in_window(df: DataFrame, as_of: Column, days: int, date: str = "local_date") -> DataFrame:
    return df.filter(since(F.col(date), as_of, days))


def date_range(silver: DataFrame, start: str, end: str) -> DataFrame:
    """Detail rows between two local dates, both included."""
    return silver.filter(F.col("local_date").between(F.lit(start), F.lit(end))).select(
        "local_date",
        "local_timestamp",
        "local_hour",
        "time_of_day_category",
        "is_weekend",
        "track_name",
        "primary_artist_name",
        "primary_genre",
        "album_name",
        "track_duration_minutes",
        "track_popularity",
        "artist_popularity",
        "listening_source",
    )


def sidebar_filter(
    df: DataFrame,
    genres: Sequence[str] = (),
    day_parts: Sequence[str] = (),
    weekend: str | None = None,
) -> DataFrame:
    """Optional filters of the dashboard; ``weekend`` is ``weekends``, ``weekdays`` or None."""
    if genres and "primary_genre" in df.columns:
        df = df.filter(F.col("primary_genre").isin(*genres))
    if day_parts and "time_of_day_category" in df.columns:
        df = df.filter(F.col("time_of_day_category").isin(*day_parts))
    if weekend in ("weekends", "weekdays") and "is_weekend" in df.columns:
        df = df.filter(F.col("is_weekend") == F.lit(weekend == "weekends"))
    return df


def popularity_band(
    df: DataFrame, band: Sequence[int] | None, column: str = "track_popularity"
) -> DataFrame:
    """Rows inside an optional [low, high] band."""
    return df if band is None else df.filter(F.col(column).between(band[0], band[1]))


def multi_genre_artists(artists: DataFrame) -> DataFrame:
    return (
        artists.filter("genre_count > 1")
        .select(
            "artist_id", "artist_name", "genres_list", "genre_count", "popularity",
            "followers_total",
        )
        .orderBy(F.desc("genre_count"), F.desc_nulls_last("popularity"), "artist_id")
    )


def has_no_genre() -> Column:
    """Predicate on flat artist rows: genre list missing or empty."""
    return (
        F.col("genres_list").isNull() | (F.size("genres_list") == 0) | (F.col("genre_count") == 0)
    )


def empty_genre_rows(artists: DataFrame) -> DataFrame:
    return artists.filter(has_no_genre())


def remove_empty_genres(artists: DataFrame) -> DataFrame:
    """The artists left after deleting those without genres."""
    return artists.filter(~F.coalesce(has_no_genre(), F.lit(False)))


def stale_artists(artists: DataFrame, as_of: Column, days: int = 30, limit: int = 50) -> DataFrame:
    """Artists due for a refresh: landed too long ago or without genre, oldest first."""
    due = artists.filter(
        F.col("artist_id").isNotNull()
        & (
            (F.to_date("ingested_at") < F.date_sub(as_of, days))
            | (F.col("genre_count") == 0)
            | F.col("primary_genre").isNull()
        )
    )
    return due.orderBy("ingested_at", "artist_id").limit(limit)


def enhanced_artists(artists: DataFrame) -> DataFrame:
    source = F.col("data_source")
    return artists.filter(
        source.contains("enhanced")
        | source.contains("popularity_analysis")
        | source.contains("name_pattern")
    )


def not_listened(candidates: DataFrame, listened: DataFrame, key: str = "track_id") -> DataFrame:
    """Candidates that were never played; NULL keys on the played side exclude nothing."""
    known = listened.select(key).filter(F.col(key).isNotNull()).distinct()
    return candidates.join(known, key, "left_anti")


def valid_feed_rows(feed: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Recent feed rows with an id, a name and an artist."""
    named = feed.dropna(subset=["track_id", "track_name", "primary_artist_name"])
    return named.filter(since(F.to_date("ingested_at"), as_of, days))


def lower_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "left"
) -> DataFrame:
    """Equi-join that ignores case."""
    return join_dimension(left, right, F.lower(left[left_key]) == F.lower(right[right_key]), how)
