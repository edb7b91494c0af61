"""Nested API objects to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinledger.functions.timeparts import epoch_seconds
from spinledger.operators.genres import inferred_genres, inference_methods

PLAY_SOURCE = "recently_played_api"
ARTIST_SOURCE = "artist_api"


def parse_utc(text: Column) -> Column:
    """ISO text with ``Z`` or an offset to a zone-less UTC timestamp."""
    return F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), F.try_to_timestamp(text).cast("timestamp_ntz")
    )


def flatten_plays(
    raw: DataFrame, ingested_at: Column | None = None, data_source: str = PLAY_SOURCE
) -> DataFrame:
    """One flat row per nested play: time parts, first artist, album, context, lineage."""
    track, first_artist = F.col("track"), F.get(F.col("track.artists"), F.lit(0))
    context = F.col("context")
    if ingested_at is None:
        ingested_at = F.convert_timezone(
            F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz")
        )
    no_artists = F.from_json(F.lit("[]"), raw.schema["track"].dataType["artists"].dataType)
    timed = raw.withColumn("_at", parse_utc(F.col("played_at")))
    return timed.select(
        F.col("_at").alias("played_at"),
        epoch_seconds(F.col("_at")).alias("played_at_timestamp"),
        F.to_date("_at").alias("played_at_date"),
        F.hour("_at").alias("played_at_hour"),
        track["id"].alias("track_id"),
        track["name"].alias("track_name"),
        track["duration_ms"].alias("track_duration_ms"),
        track["popularity"].alias("track_popularity"),
        track["explicit"].alias("track_explicit"),
        track["preview_url"].alias("track_preview_url"),
        json_or(track["external_urls"], "{}").alias("track_external_urls"),
        F.to_json(F.coalesce(track["artists"], no_artists)).alias("artists"),
        first_artist["id"].alias("primary_artist_id"),
        first_artist["name"].alias("primary_artist_name"),
        track["album"]["id"].alias("album_id"),
        track["album"]["name"].alias("album_name"),
        track["album"]["album_type"].alias("album_type"),
        track["album"]["release_date"].alias("album_release_date"),
        track["album"]["total_tracks"].alias("album_total_tracks"),
        json_or(track["album"]["images"], "[]").alias("album_images"),
        context["type"].alias("context_type"),
        context["uri"].alias("context_uri"),
        F.when(context.isNotNull(), json_or(context["external_urls"], "{}")).alias(
            "context_external_urls"
        ),
        track["uri"].alias("track_uri"),
        ingested_at.alias("ingested_at"),
        F.lit(data_source).alias("data_source"),
    )


def json_or(value: Column, empty: str) -> Column:
    return F.coalesce(F.to_json(value), F.lit(empty))


def flatten_artists(
    raw: DataFrame,
    enhance: bool = True,
    ingested_at: Column | None = None,
    data_source: str = ARTIST_SOURCE,
) -> DataFrame:
    """One flat row per nested artist; empty genre lists are inferred when ``enhance``."""
    if ingested_at is None:
        ingested_at = F.convert_timezone(
            F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz")
        )
    given = F.coalesce(F.col("genres"), F.array().cast("array<string>"))
    empty = F.size(given) == 0
    genres, source = given, F.lit(data_source)
    if enhance:
        name, popularity = F.col("name"), F.col("popularity")
        genres = F.when(empty, inferred_genres(name, popularity)).otherwise(given)
        source = F.when(
            empty,
            F.concat(
                F.lit(f"{data_source}_enhanced_"),
                F.array_join(inference_methods(name, popularity), "+"),
            ),
        ).otherwise(F.lit(data_source))
    return raw.withColumn("_genres", genres).select(
        F.col("id").alias("artist_id"),
        F.col("name").alias("artist_name"),
        F.col("uri").alias("artist_uri"),
        F.to_json("_genres").alias("genres"),
        F.col("_genres").alias("genres_list"),
        F.get("_genres", F.lit(0)).alias("primary_genre"),
        F.size("_genres").alias("genre_count"),
        F.col("popularity"),
        F.col("followers.total").alias("followers_total"),
        json_or(F.col("external_urls"), "{}").alias("external_urls"),
        json_or(F.col("images"), "[]").alias("images"),
        ingested_at.alias("ingested_at"),
        source.alias("data_source"),
    )


def flatten_candidates(
    tracks: DataFrame, source: str | Column, seed_value: str | Column, fetched_at: Column
) -> DataFrame:
    """Nested search results to candidate rows tagged with their source and seed.

    Source and seed are texts for the results of one search, or columns for those of many.
    """
    source, seed_value = (x if isinstance(x, Column) else F.lit(x) for x in (source, seed_value))
    first_artist = F.get(F.col("artists"), F.lit(0))
    return tracks.select(
        F.col("id").alias("track_id"),
        F.col("name").alias("track_name"),
        first_artist["id"].alias("primary_artist_id"),
        first_artist["name"].alias("primary_artist_name"),
        source.alias("source"),
        seed_value.alias("seed_value"),
        F.col("popularity").alias("track_popularity"),
        F.col("album.release_date").alias("album_release_date"),
        fetched_at.alias("fetched_at"),
        F.to_json(F.struct("*")).alias("raw_payload"),
    )


def unique_artists(raw: DataFrame) -> DataFrame:
    """Distinct artists of the raw plays, each with the attributes of its earliest play."""
    listed = raw.select(
        parse_utc(F.col("played_at")).alias("_at"), F.posexplode("track.artists")
    ).filter(F.col("col.id").isNotNull())
    first = F.min_by(F.col("col"), F.struct("_at", "pos"))
    return (
        listed.groupBy(F.col("col.id").alias("_id"))
        .agg(first.alias("artist"))
        .select("artist.id", "artist.name", "artist.uri", "artist.external_urls")
    )
