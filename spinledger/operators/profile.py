"""User profile and taste profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinledger.functions.ranking import most_frequent, top_n
from spinledger.functions.timeparts import since
from spinledger.params import TRACK_WINDOW


def top_shares(liked: DataFrame, value: str, n: int) -> Column:
    """The ``n`` most frequent values with their share, as an array in a scalar subquery."""
    counted = liked.groupBy(value).agg(F.count("*").alias("_n"))
    total = liked.agg(F.count("*")).scalar()
    best = top_n(counted.withColumn("score", F.col("_n") / total), [F.desc("_n"), F.col(value).asc_nulls_last()], n)
    item = F.struct((-F.col("_n")).alias("o"), F.col(value).alias("name"), "score")
    listed = F.sort_array(F.collect_list(item))
    return best.agg(
        F.transform(listed, lambda x: F.struct(x["name"].alias("name"), x["score"].alias("score")))
    ).scalar()


def quartiles(liked: DataFrame, value: str) -> Column:
    """Exact interpolated quartiles from the counts of the distinct values."""
    counts = liked.groupBy(value).agg(F.count("*").alias("_n"))
    return counts.agg(F.percentile(value, F.array(F.lit(0.25), F.lit(0.75)), F.col("_n"))).scalar()


def user_profile(features: DataFrame, n: int = 10) -> DataFrame:
    """One row describing the user's library: favourites, ranges, era, openness, totals."""
    liked = features.filter(F.col("user_play_count") >= 1)
    era = most_frequent(liked.withColumn("_all", F.lit(1)), ["_all"], "era_category")
    genres = F.countDistinct("primary_genre")
    return liked.agg(
        F.struct(
            genres.alias("total_genres"),
            F.countDistinct("primary_artist_name").alias("total_artists"),
            F.countDistinct("track_id").alias("total_tracks"),
            F.avg("track_popularity").alias("avg_popularity"),
            (F.avg("track_duration_ms") / 60000.0).alias("avg_duration_min"),
        ).alias("stats")
    ).select(
        top_shares(liked, "primary_genre", n).alias("top_genres"),
        top_shares(liked, "primary_artist_name", n).alias("top_artists"),
        quartiles(liked, "track_popularity").alias("preferred_popularity_range"),
        F.array(era.select("era_category").scalar()).alias("preferred_eras"),
        quartiles(liked, "track_duration_ms").alias("preferred_duration_range"),
        (F.col("stats.total_genres") / 50).alias("discovery_openness"),
        "stats",
    )


def taste_profile(
    interactions: DataFrame, silver: DataFrame, patterns: DataFrame, as_of: Column
) -> DataFrame:
    """Top genres, artists and hours of the user; each part is limited before the union."""

    def arm(kind: str, rows: DataFrame, info: Column) -> DataFrame:
        return rows.select(
            F.lit(kind).alias("profile_type"),
            "item_name",
            F.col("score").cast("double").alias("preference_score"),
            "preference_rank",
            F.to_json(info).alias("additional_info"),
        )

    genres = interactions.withColumns(
        {"item_name": F.col("primary_genre"), "score": F.col("weighted_preference")}
    )
    genres = top_n(genres, [F.desc("score"), F.col("item_name")], 10, "preference_rank")
    genre_info = F.struct("play_count", "avg_popularity", "preference_strength", "is_current_preference")
    recent = silver.filter(since(F.col("local_date"), as_of, TRACK_WINDOW))
    artists = recent.groupBy(F.col("primary_artist_name").alias("item_name")).agg(
        F.count("*").alias("score"),
        F.countDistinct("track_id").alias("unique_tracks"),
        F.avg("track_popularity").alias("avg_popularity"),
        F.sort_array(F.collect_set("primary_genre")).alias("genres"),
    )
    artists = top_n(artists, [F.desc("score"), F.col("item_name")], 10, "preference_rank")
    artist_info = F.struct(
        F.col("score").alias("total_plays"), "unique_tracks", "avg_popularity", "genres"
    )
    kind = F.when(F.col("is_weekend"), " (Weekend)").otherwise(" (Weekday)")
    hours = patterns.filter(F.col("temporal_strength").isin("strong", "moderate")).withColumns(
        {
            "item_name": F.concat(F.lit("Hour "), F.col("local_hour").cast("string"), kind),
            "score": F.col("temporal_recommendation_score"),
        }
    )
    order = [F.desc("score"), F.col("primary_genre"), F.col("local_hour"), F.col("is_weekend")]
    hours = top_n(hours, order, 5, "preference_rank")
    hour_info = F.struct(
        F.col("local_hour").alias("hour"),
        "is_weekend",
        F.col("hour_genre_probability").alias("probability"),
        F.col("temporal_strength").alias("strength"),
    )
    return (
        arm("genre", genres, genre_info)
        .unionByName(arm("artist", artists, artist_info))
        .unionByName(arm("temporal", hours, hour_info))
    )
