"""Preference, genre, track and temporal features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spinledger.functions import tiers
from spinledger.functions.joins import join_dimension
from spinledger.functions.ranking import top_per_group
from spinledger.functions.timeparts import since
from spinledger.operators.silver import with_tiers
from spinledger.params import (
    DECAY_DAYS,
    GENRE_WINDOW,
    RECENT_DAYS,
    TRACK_WINDOW,
    TRACKS_PER_GENRE,
    VERY_RECENT_DAYS,
)

SINGLE_USER = "user_1"


def genre_preferences(listens: DataFrame) -> DataFrame:
    return (
        listens.filter(F.col("primary_genre").isNotNull())
        .groupBy("primary_genre")
        .agg(
            F.count("*").alias("play_count"),
            F.countDistinct("track_id").alias("unique_tracks"),
            F.countDistinct("primary_artist_id").alias("unique_artists"),
            F.avg("track_popularity").alias("avg_track_popularity"),
            F.avg("track_duration_ms").alias("avg_track_duration_ms"),
            F.min("local_timestamp").alias("first_listened_at"),
            F.max("local_timestamp").alias("last_listened_at"),
        )
    )


def artist_preferences(listens: DataFrame) -> DataFrame:
    return (
        listens.filter(F.col("primary_artist_id").isNotNull())
        .groupBy("primary_artist_id", "primary_artist_name")
        .agg(
            F.count("*").alias("play_count"),
            F.countDistinct("track_id").alias("unique_tracks"),
            F.avg("track_popularity").alias("avg_track_popularity"),
            F.min("local_timestamp").alias("first_listened_at"),
            F.max("local_timestamp").alias("last_listened_at"),
        )
    )


def track_preferences(listens: DataFrame) -> DataFrame:
    return (
        listens.filter(F.col("track_id").isNotNull())
        .groupBy(
            "track_id", "track_name", "primary_artist_id", "primary_artist_name", "primary_genre"
        )
        .agg(
            F.count("*").alias("play_count"),
            F.avg("track_popularity").alias("avg_track_popularity"),
            F.min("local_timestamp").alias("first_listened_at"),
            F.max("local_timestamp").alias("last_listened_at"),
        )
    )


def genre_interactions(
    silver: DataFrame,
    as_of: Column,
    window: int = GENRE_WINDOW,
    min_plays: int = 3,
    user: str | None = None,
) -> DataFrame:
    """Genre preference with exponential recency decay, per user or for everybody as one.

    ``user`` names a user column to group by; without it all plays count as one user.
    """
    date = F.col("local_date")
    recent = F.count_if(since(date, as_of, RECENT_DAYS))
    very_recent = F.count_if(since(date, as_of, VERY_RECENT_DAYS))
    who = F.lit(SINGLE_USER) if user is None else F.col(user)
    totals = (
        silver.filter(since(date, as_of, window))
        .groupBy(who.alias("user_id"), "primary_genre")
        .agg(
            F.count("*").alias("play_count"),
            F.avg("track_popularity").alias("avg_popularity"),
            recent.alias("recent_plays"),
            very_recent.alias("very_recent_plays"),
            F.exp(-F.avg(F.datediff(as_of, date)) / DECAY_DAYS).alias("recency_weight"),
            F.avg("local_hour").alias("avg_listening_hour"),
            F.avg(F.col("is_weekend").cast("int")).alias("weekend_preference"),
            F.countDistinct("primary_artist_id").alias("artist_diversity_in_genre"),
            (F.avg("track_duration_ms") / 1000.0 / 60.0).alias("avg_duration_minutes"),
            F.stddev("track_popularity").alias("popularity_variance"),
        )
    )
    return totals.filter(F.col("play_count") >= min_plays).withColumns(
        {
            "weighted_preference": F.col("play_count") * F.col("recency_weight"),
            "is_current_preference": (F.col("recent_plays") > 0).cast("int"),
            "is_very_recent_preference": (F.col("very_recent_plays") > 0).cast("int"),
            "log_play_count": F.ln(F.col("play_count") + 1),
            "preference_strength": tiers.preference_strength(F.col("play_count")),
        }
    )


def genre_training_rows(
    silver: DataFrame, as_of: Column, window: int = GENRE_WINDOW, user: str | None = None
) -> DataFrame:
    """Genre interactions joined to the genre's own statistics."""
    statistics = (
        silver.filter(since(F.col("local_date"), as_of, window))
        .groupBy("primary_genre")
        .agg(
            F.countDistinct("primary_artist_id").alias("total_artists_in_genre"),
            F.avg("track_popularity").alias("genre_avg_popularity"),
            F.stddev("track_popularity").alias("genre_popularity_variance"),
            F.countDistinct("album_release_year").alias("era_diversity"),
            (F.avg("track_duration_ms") / 1000.0 / 60.0).alias("genre_avg_duration"),
        )
    )
    return genre_interactions(silver, as_of, window, user=user).join(statistics, "primary_genre")


TRACK_ATTRIBUTES = [
    "track_name", "primary_artist_id", "primary_artist_name", "primary_genre",
    "track_popularity", "track_duration_ms", "album_release_date", "album_name", "album_type",
]


def track_base(silver: DataFrame, as_of: Column, window: int = TRACK_WINDOW) -> DataFrame:
    """Plays per track spelling, in all and within the window, in one pass.

    Popularity and duration belong to the key, so that every later average is a sum over these
    rows. The table is as small as the library and worth writing before ``track_features``,
    which reads it several times.
    """
    recent = since(F.col("local_date"), as_of, window)
    return (
        silver.filter(F.col("track_id").isNotNull())
        .groupBy("track_id", *TRACK_ATTRIBUTES, "album_release_year")
        .agg(
            F.count("*").alias("plays"),
            F.count_if(recent).alias("recent_plays"),
            F.max(F.when(recent, F.col("local_date"))).alias("last_played_date"),
            F.max(F.when(recent, F.col("local_timestamp"))).alias("last_played_at"),
        )
    )


def weighted_average(value: Column, weight: Column) -> Column:
    """Average of ``value`` over ``weight`` plays; rows without a value do not count."""
    known = F.when(value.isNotNull(), weight)
    return F.try_divide(F.sum(value.cast("long") * weight), F.sum(known))


def track_engagement(recent: DataFrame) -> DataFrame:
    """Recent plays, last day and latest attributes of every recently played track."""
    track = W.partitionBy("track_id")
    order = [F.desc("last_played_at"), *[F.col(c) for c in TRACK_ATTRIBUTES]]
    return (
        recent.withColumns(
            {
                "user_play_count": F.sum("recent_plays").over(track),
                "_day": F.max("last_played_date").over(track),
                "_latest": F.row_number().over(track.orderBy(*order)),
            }
        )
        .filter("_latest = 1")
        .select(
            "track_id",
            "user_play_count",
            F.col("_day").alias("last_played_date"),
            F.struct(*TRACK_ATTRIBUTES).alias("_latest"),
        )
    )


def artist_statistics(recent: DataFrame) -> DataFrame:
    plays = F.col("recent_plays")
    return recent.groupBy("primary_artist_id").agg(
        F.countDistinct("primary_genre").alias("artist_genre_diversity"),
        weighted_average(F.col("track_popularity"), plays).alias("artist_avg_popularity"),
        F.countDistinct("track_id").alias("artist_track_count"),
        weighted_average(F.col("track_duration_ms"), plays).alias("artist_avg_duration"),
        F.sum(plays).alias("artist_total_plays"),
    )


def genre_statistics(base: DataFrame, recent: DataFrame) -> DataFrame:
    """Genre averages over all plays of the tracks heard in the window."""
    popularity, plays = F.col("track_popularity").cast("long"), F.col("plays")
    heard = recent.select("track_id").distinct()
    count = F.sum(F.when(popularity.isNotNull(), plays))
    total, squares = F.sum(popularity * plays), F.sum(popularity * popularity * plays)
    variance = F.try_divide(squares - F.try_divide(total * total, count), count - 1)
    year = F.coalesce("album_release_year", F.lit(2000))
    return (
        base.filter(F.col("primary_genre").isNotNull())
        .join(heard, "track_id", "left_semi")
        .groupBy("primary_genre")
        .agg(
            F.try_divide(total, count).alias("genre_avg_popularity"),
            weighted_average(F.col("track_duration_ms"), plays).alias("genre_avg_duration"),
            F.countDistinct("primary_artist_id").alias("genre_artist_count"),
            F.countDistinct("track_id").alias("genre_track_count"),
            F.sqrt(F.greatest(variance, F.lit(0.0))).alias("genre_popularity_variance"),
            weighted_average(year, plays).alias("genre_avg_release_year"),
        )
    )


def track_features(
    base: DataFrame,
    catalog: DataFrame,
    as_of: Column,
    per_genre: int | None = TRACKS_PER_GENRE,
) -> DataFrame:
    """Content features, one row per track of the catalog or of the recent plays.

    ``base`` is the output of ``track_base``. ``user_play_count`` counts the plays in its
    window and is 0 for a track not played in it, whose freshness is 0. Only the ``per_genre``
    best-ranked tracks of each genre are kept; None keeps all.
    """
    recent = base.filter("recent_plays > 0")
    tracks = (
        catalog.select("track_id", F.struct(*TRACK_ATTRIBUTES).alias("_known"))
        .join(track_engagement(recent), "track_id", "full")
        .withColumn("_track", F.coalesce("_known", "_latest"))
        .select(
            "track_id",
            "_track.*",
            F.coalesce("user_play_count", F.lit(0)).alias("user_play_count"),
            "last_played_date",
        )
        .filter(F.col("primary_genre").isNotNull())
    )
    order = [F.desc_nulls_last("track_popularity"), F.desc("user_play_count"), F.col("track_id")]
    tracks = with_tiers(tracks)
    if per_genre is not None:
        tracks = top_per_group(tracks, ["primary_genre"], order, per_genre, "genre_rank")
    else:
        rank = F.row_number().over(W.partitionBy("primary_genre").orderBy(*order))
        tracks = tracks.withColumn("genre_rank", rank)
    out = join_dimension(tracks, genre_statistics(base, recent), "primary_genre", "left")
    out = join_dimension(out, artist_statistics(recent), "primary_artist_id", "left")
    most_played = recent.groupBy("track_id").agg(F.sum("recent_plays").alias("n"))
    if per_genre is not None:
        most_played = tracks.select(F.col("user_play_count").alias("n"))
    most_played = most_played.agg(F.greatest(F.max("n"), F.lit(1))).scalar()
    days = F.datediff(as_of, F.col("last_played_date"))
    return out.withColumns(
        {
            "popularity_vs_genre_avg": F.col("track_popularity") - F.col("genre_avg_popularity"),
            "duration_vs_genre_avg": F.col("track_duration_ms") - F.col("genre_avg_duration"),
            "artist_vs_genre_popularity": F.col("artist_avg_popularity")
            - F.col("genre_avg_popularity"),
            "days_since_last_played": days,
            "freshness_score": F.coalesce(F.exp(-days / DECAY_DAYS), F.lit(0.0)),
            "popularity_normalized": F.col("track_popularity") / 100.0,
            "play_count_normalized": F.col("user_play_count") / most_played,
            "duration_normalized": (F.col("track_duration_ms") - 60000) / 540000.0,
        }
    )


def temporal_patterns(
    silver: DataFrame, as_of: Column, window: int = TRACK_WINDOW, min_plays: int = 2
) -> DataFrame:
    """Plays of a genre by hour and weekend, with its probability in that hour."""
    cell = ["primary_genre", "local_hour", "is_weekend"]
    cells = (
        silver.filter(since(F.col("local_date"), as_of, window))
        .groupBy(*cell)
        .agg(
            F.count("*").alias("play_count"),
            F.avg("track_popularity").alias("avg_popularity"),
            F.countDistinct("primary_artist_id").alias("unique_artists"),
            (F.avg("track_duration_ms") / 1000.0 / 60.0).alias("avg_duration_minutes"),
        )
        .filter(F.col("play_count") >= min_plays)
    )
    by_time = W.partitionBy("local_hour", "is_weekend")
    by_genre = W.partitionBy("primary_genre")
    hour = F.col("local_hour")
    plays = F.col("play_count")
    probability = F.col("hour_genre_probability")
    return (
        cells.withColumns(
            {
                "hour_genre_probability": plays / F.sum("play_count").over(by_time),
                "genre_time_preference": plays / F.sum("play_count").over(by_genre),
                "avg_listening_hour": F.avg(hour).over(by_genre),
                "hour_variance": F.stddev(hour).over(by_genre),
                "weekend_preference": F.avg(F.col("is_weekend").cast("int")).over(by_genre),
                "hour_diversity": F.size(F.collect_set(hour).over(by_genre)).cast("long"),
                "total_genre_plays": F.sum("play_count").over(by_genre),
            }
        )
        .filter(F.col("primary_genre").isNotNull())
        .withColumns(
            {
                "temporal_strength": F.when(probability > 0.3, "strong")
                .when(probability > 0.1, "moderate")
                .otherwise("weak"),
                "temporal_recommendation_score": probability * plays,
            }
        )
    )
