"""Parameterised recommendation functions over the feature and strategy tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinledger.functions import tiers
from spinledger.functions.joins import join_dimension
from spinledger.functions.ranking import top_n, top_per_group
from spinledger.functions.timeparts import since
from spinledger.operators.genres import contains_any
from spinledger.operators.silver import popularity_band
from spinledger.operators.strategies import (
    by_score,
    hidden_gem,
    hour_relevance,
    unplayed,
    with_novelty,
)
from spinledger.params import TRACK_LINK_PREFIX

SHORT = {
    "track_id": "track_id", "track_name": "track_name", "primary_artist_name": "artist_name",
    "primary_genre": "genre",
}


def short_columns() -> list[Column]:
    return [F.col(source).alias(name) for source, name in SHORT.items()]


def get_recommendations(
    playlist: DataFrame,
    n: int = 30,
    hour: int | None = None,
    min_score: float = 0.3,
    link_prefix: str = TRACK_LINK_PREFIX,
) -> DataFrame:
    """The playlist re-ranked; with an hour, temporal tracks gain a fifth."""
    score = F.col("final_recommendation_score")
    if hour is not None:
        temporal = F.col("recommendation_strategies").contains("temporal")
        score = F.when(temporal, score * 1.2).otherwise(score)
    scored = playlist.filter(F.col("final_recommendation_score") >= min_score).withColumn(
        "recommendation_score", F.round(score, 12)
    )
    return top_n(scored.drop("playlist_position"), by_score(), n, "playlist_position").select(
        *short_columns(),
        "album_name",
        "track_popularity",
        "recommendation_score",
        "recommendation_strategies",
        "playlist_position",
        tiers.track_link(F.col("track_id"), link_prefix).alias("track_url"),
        F.col("recommendation_metadata.recommendation_reason").alias("recommendation_reason"),
    )


def by_strategy(strategies: Mapping[str, DataFrame], strategy: str, n: int = 20) -> DataFrame:
    """Best rows of one named strategy."""
    rows = strategies[strategy].filter(F.col("track_id").isNotNull())
    rows = rows.withColumn("recommendation_score", F.round("recommendation_score", 12))
    return top_n(rows, by_score(), n, "strategy_rank").select(
        *short_columns(), "recommendation_score", "strategy_rank"
    )


def genre_recommendations(
    features: DataFrame,
    interactions: DataFrame,
    genre: str | None = None,
    n: int = 15,
    band: Sequence[int] | None = None,
) -> DataFrame:
    """Unplayed tracks of one genre, or an even share from each of the five favourites."""
    if genre is not None:
        interactions = interactions.filter(F.col("primary_genre") == genre)
    top = 5 if genre is None else 1
    order = [F.desc("weighted_preference"), F.col("primary_genre")]
    favourites = top_n(interactions, order, top).select(
        F.col("primary_genre").alias("_genre"),
        F.col("weighted_preference").alias("genre_relevance_score"),
    )
    slots = favourites.agg(F.lit(n) / F.greatest(F.count("*"), F.lit(1))).scalar()
    tracks = popularity_band(unplayed(features), band)
    # the favourites are at most five rows
    joined = tracks.join(F.broadcast(favourites), F.col("primary_genre") == F.col("_genre"))
    best = [F.desc_nulls_last("track_popularity"), F.desc("freshness_score"), F.col("track_id")]
    ranked = top_per_group(joined, ["primary_genre"], best, n, "track_rank_in_genre").filter(
        F.col("track_rank_in_genre") <= slots
    )
    out = [F.desc("genre_relevance_score"), F.col("genre"), F.col("track_rank_in_genre")]
    return top_n(
        ranked.select(
            *short_columns(), "track_popularity", "genre_relevance_score", "track_rank_in_genre"
        ),
        out,
        n,
    )


def time_based_recommendations(
    features: DataFrame,
    patterns: DataFrame,
    hour: int,
    weekend: bool,
    n: int = 20,
    flexibility: int = 2,
) -> DataFrame:
    """Unplayed tracks of genres usual around an hour; a track may appear once per hour.

    Only a genre's best ``n`` tracks and best ``n`` hours can reach the result, so both sides
    are cut to that before they meet.
    """
    apart = F.abs(F.col("local_hour") - hour)
    label = (
        F.when(apart == 0, "Perfect match")
        .when(apart <= 1, "Close match")
        .when(apart <= flexibility, "Similar time")
        .otherwise("General preference")
    )
    relevance = hour_relevance(hour, weekend, flexibility, flexibility)
    score = F.col("temporal_recommendation_score") * F.col("time_relevance")
    hours = (
        patterns.filter(F.col("temporal_strength").isin("strong", "moderate"))
        .withColumns({"time_relevance": relevance, "hour_relevance": label})
        .filter(F.col("time_relevance") >= 0.4)
        .withColumn("temporal_score", F.round(score, 12))
    )
    best_hours = [F.desc("temporal_score"), F.col("local_hour"), F.col("is_weekend")]
    hours = top_per_group(hours, ["primary_genre"], best_hours, n, "_h").select(
        "primary_genre", "local_hour", "is_weekend", "hour_relevance", "temporal_score"
    )
    best_tracks = [F.desc_nulls_last("track_popularity"), F.col("track_id")]
    tracks = top_per_group(unplayed(features), ["primary_genre"], best_tracks, n, "_t")
    order = [
        F.desc("temporal_score"),
        F.desc_nulls_last("track_popularity"),
        F.col("track_id"),
        F.col("local_hour"),
        F.col("is_weekend"),
    ]
    joined = tracks.join(hours, "primary_genre")
    return top_n(joined, order, n, "recommendation_rank").select(
        *short_columns(), "temporal_score", "hour_relevance", "recommendation_rank"
    )


# Genre words, their score, and words that rule a match out; then the score of
# every other genre.
MOODS = {
    "energetic": (
        [
            (["electronic", "dance", "pop", "rock"], [], 0.9),
            (["hip hop", "rap"], [], 0.8),
        ],
        0.3,
        "High energy genre",
    ),
    "relaxed": (
        [
            (["ambient", "classical", "jazz", "folk"], [], 0.9),
            (["indie", "alternative"], [], 0.7),
        ],
        0.4,
        "Calming genre",
    ),
    "focused": (
        [
            (["instrumental", "classical", "ambient"], [], 0.9),
            (["electronic"], ["dance"], 0.7),
        ],
        0.3,
        "Focus-friendly genre",
    ),
    "nostalgic": (
        [(["classic", "oldies"], [], 0.9), (["rock", "pop"], [], 0.6)],
        0.4,
        "Classic genre",
    ),
}


def mood_score(genre: Column, mood: str) -> Column:
    if mood not in MOODS:
        return F.lit(0.5)
    lower, out = F.lower(genre), None
    for words, without, score in MOODS[mood][0]:
        hit = contains_any(lower, words)
        if without:
            hit = hit & ~contains_any(lower, without)
        out = F.when(hit, score) if out is None else out.when(hit, score)
    return out.otherwise(MOODS[mood][1])


def mood_recommendations(
    features: DataFrame, mood: str, n: int = 15, genre: str = "primary_genre"
) -> DataFrame:
    """Unplayed tracks of genres that fit a mood; ``genre`` names the column to match."""
    fit = mood_score(F.col(genre), mood)
    reason = MOODS[mood][2] if mood in MOODS else "Mood-appropriate genre"
    scored = (
        unplayed(features)
        .withColumn("_fit", fit)
        .filter(F.col("_fit") > 0.5)
        .withColumn(
            "mood_relevance_score",
            F.round(F.col("_fit") * 0.7 + F.col("popularity_normalized") * 0.3, 12),
        )
    )
    return top_n(scored, by_score("mood_relevance_score"), n).select(
        *short_columns(), "mood_relevance_score", F.lit(reason).alias("mood_reason")
    )


# Weights of genre novelty, artist novelty, hidden gem and era novelty.
DISCOVERY_WEIGHTS = {
    "genre_exploration": (0.6, 0.0, 0.3, 0.1),
    "artist_discovery": (0.2, 0.6, 0.2, 0.0),
    "hidden_gems": (0.3, 0.2, 0.5, 0.0),
    "time_travel": (0.2, 0.0, 0.3, 0.5),
    "balanced": (0.25, 0.25, 0.25, 0.25),
}


def discovery_recommendations(
    features: DataFrame,
    genres: DataFrame,
    artists: DataFrame,
    kind: str = "balanced",
    n: int = 20,
    max_popularity: int = 70,
) -> DataFrame:
    """Novel unplayed tracks, scored by the weighting of a discovery kind."""
    fresh = unplayed(features).filter(F.col("track_popularity").between(15, max_popularity))
    era = F.col("era_category")
    gem = hidden_gem(20, max_popularity, 45, float(max_popularity))
    scored = with_novelty(fresh, genres, artists).withColumns(
        {
            "_gem": gem,
            "_era": F.when(era.isin("2000s", "90s", "80s", "classic"), 1.2)
            .when(era == "2010s", 1.0)
            .otherwise(0.8),
        }
    )
    parts = ["genre_novelty_score", "artist_novelty_score", "_gem", "_era"]
    score = F.lit(0.0)
    for part, weight in zip(parts, DISCOVERY_WEIGHTS.get(kind, DISCOVERY_WEIGHTS["balanced"])):
        score = score + F.col(part) * weight
    genre, artist = F.col("genre_novelty_score"), F.col("artist_novelty_score")
    reason = (
        F.when((genre == 1.0) & (artist == 1.0), "Completely new artist and genre")
        .when(artist == 1.0, "New artist in familiar genre")
        .when(genre == 1.0, "New genre exploration")
        .when(F.col("_gem") > 0.7, "Hidden gem discovery")
        .when(F.col("_era") > 1.0, "Vintage music discovery")
        .otherwise("Musical exploration")
    )
    level = (
        F.when(genre + artist >= 1.5, "High").when(genre + artist >= 0.8, "Medium").otherwise("Low")
    )
    kept = scored.withColumn("discovery_score", F.round(score, 12)).filter(
        (F.col("discovery_score") > 0.4) & ((genre > 0.5) | (artist > 0.5))
    )
    return top_n(kept, by_score("discovery_score"), n).select(
        *short_columns(),
        "discovery_score",
        reason.alias("discovery_reason"),
        level.alias("novelty_level"),
    )


def favourite_genres(interactions: DataFrame, n: int) -> DataFrame:
    order = [F.desc("weighted_preference"), F.col("primary_genre")]
    named = interactions.filter(F.col("primary_genre").isNotNull())
    return top_n(named, order, n).select("primary_genre")


def explore_from_preferences(
    features: DataFrame,
    interactions: DataFrame,
    similarity: DataFrame,
    artist_pairs: DataFrame | None = None,
    genres: Sequence[str] | None = None,
    radius: float = 0.7,
    n: int = 25,
) -> DataFrame:
    """Unplayed tracks reached from seed genres, and from seed artists, through similarity.

    ``genres`` defaults to the five favourites. ``artist_pairs`` is the output of
    ``similar_to_artists`` for the seed artists.
    """
    spark = features.sparkSession
    if genres is None:
        seeds = favourite_genres(interactions, 5)
    else:
        seeds = spark.createDataFrame([(g,) for g in genres], "primary_genre string")
    seeds = F.broadcast(seeds.select(F.col("primary_genre").alias("_seed")))
    near = F.round("similarity_score", 12)
    reached = (
        similarity.filter(near >= radius)
        .join(seeds, F.col("from_genre") == F.col("_seed"), "left_semi")
        .join(seeds, F.col("to_genre") == F.col("_seed"), "left_anti")
        .select(
            F.col("to_genre").alias("_key"),
            near.alias("exploration_score"),
            F.concat(F.lit("Genre similarity to "), "from_genre").alias("connection_path"),
            F.lit("genre_expansion").alias("exploration_type"),
        )
    )
    fresh = unplayed(features)
    # only a genre's n most favoured tracks (by id) can reach the result
    per_genre = top_per_group(fresh, ["primary_genre"], [F.col("track_id")], n, "_t")
    found = per_genre.join(reached, F.col("primary_genre") == F.col("_key"))
    if artist_pairs is not None:
        score = F.round("artist_similarity_score", 12)
        artists = artist_pairs.filter(score >= radius).select(
            F.col("artist_2_name").alias("_key"),
            score.alias("exploration_score"),
            F.concat(F.lit("Artist similarity to "), "artist_1_name").alias("connection_path"),
            F.lit("artist_expansion").alias("exploration_type"),
        )
        per_artist = top_per_group(fresh, ["primary_artist_name"], [F.col("track_id")], n, "_t")
        found = found.unionByName(
            per_artist.join(artists, F.col("primary_artist_name") == F.col("_key"))
        )
    order = [F.desc("exploration_score"), F.col("track_id"), F.col("connection_path")]
    return top_n(found, order, n).select(
        *short_columns(), "exploration_score", "connection_path", "exploration_type"
    )


def validate_quality(
    track_ids: DataFrame,
    features: DataFrame,
    interactions: DataFrame,
    similarity: DataFrame,
    threshold: float = 0.5,
) -> DataFrame:
    """Quality score and reasons of recommended track ids (one ``track_id`` column)."""
    liked = (
        interactions.filter(F.col("weighted_preference") > 1.0)
        .select(F.col("primary_genre").alias("_liked"))
        .dropna()
        .distinct()
    )
    reached = (
        similarity.filter(F.col("similarity_score") > 0.5)
        .select(F.col("to_genre").alias("_reached"))
        .distinct()
    )
    rows = track_ids.filter(F.col("track_id").isNotNull()).join(
        features.select("track_id", "primary_genre", "track_popularity", "user_play_count"),
        "track_id",
        "left",
    )
    rows = join_dimension(rows, liked, F.col("primary_genre") == F.col("_liked"))
    rows = join_dimension(rows, reached, F.col("primary_genre") == F.col("_reached"))
    popularity = F.col("track_popularity")
    novelty = (
        F.when(F.col("user_play_count") > 0, 0.0)
        .when(popularity < 10, 0.2)
        .when(popularity > 95, 0.6)
        .otherwise(1.0)
    )
    relevance = (
        F.when(F.col("_liked").isNotNull(), 0.8)
        .when(F.col("_reached").isNotNull(), 0.6)
        .otherwise(0.3)
    )
    part = (
        F.when(popularity.between(30, 80), 1.0)
        .when(popularity.between(20, 90), 0.8)
        .otherwise(0.5)
    )
    scored = rows.withColumns({"_novelty": novelty, "_relevance": relevance, "_part": part})
    new, fit = F.col("_novelty"), F.col("_relevance")
    score = F.round(new * 0.4 + fit * 0.4 + F.col("_part") * 0.2, 12)
    reasons = F.array_compact(
        F.array(
            F.when(new == 0.0, "Already played"),
            F.when(new == 0.2, "Very obscure"),
            F.when(new == 0.6, "Very mainstream"),
            F.when(fit >= 0.8, "Highly relevant to taste"),
            F.when(fit >= 0.6, "Somewhat relevant to taste"),
            F.when(fit == 0.3, "New genre exploration"),
        )
    )
    return scored.select(
        "track_id",
        score.alias("quality_score"),
        reasons.alias("quality_reasons"),
        (score >= threshold).alias("passes_threshold"),
    )


def trending(
    features: DataFrame,
    interactions: DataFrame,
    n: int = 5,
    top_genres: int = 3,
    band: Sequence[int] = (60, 85),
    link_prefix: str = TRACK_LINK_PREFIX,
) -> DataFrame:
    """Popular unplayed tracks of the user's favourite genres."""
    favourites = F.broadcast(favourite_genres(interactions, top_genres))
    tracks = popularity_band(unplayed(features), band).join(favourites, "primary_genre", "left_semi")
    return top_n(tracks, [F.desc("track_popularity"), F.col("track_id")], n).select(
        *short_columns(),
        "track_popularity",
        tiers.track_link(F.col("track_id"), link_prefix).alias("track_url"),
    )


def rediscovery_candidates(features: DataFrame, low: int = 1, high: int = 3) -> DataFrame:
    """Tracks of the library that were played rarely."""
    return features.filter(F.col("user_play_count").between(low, high))


def rediscovery(features: DataFrame, interactions: DataFrame, n: int = 50) -> DataFrame:
    """Rarely played tracks by genre preference, rarity, time since the last play."""
    rare = rediscovery_candidates(features).filter(F.col("track_popularity") > 20)
    liked = interactions.select("primary_genre", "weighted_preference")
    joined = join_dimension(rare, liked, "primary_genre")
    score = (
        F.coalesce("weighted_preference", F.lit(0.1))
        * (1.0 / F.col("user_play_count"))
        * F.when(F.col("days_since_last_played") > 30, 1.5).otherwise(1.0)
        * (F.col("track_popularity") / 100.0)
    )
    scored = joined.withColumn("rediscovery_score", F.round(score, 9))
    return top_n(scored, by_score("rediscovery_score"), n, "rank").select(
        "track_id",
        "track_name",
        "primary_artist_name",
        "primary_genre",
        "album_name",
        "track_popularity",
        "rediscovery_score",
        F.lit("rediscovery_collaborative").alias("recommendation_strategy"),
        "user_play_count",
        "days_since_last_played",
        "rank",
    )


def temporal_lookup(
    patterns: DataFrame,
    silver: DataFrame,
    as_of: Column,
    hour: int,
    weekend: bool,
    n: int = 10,
    reach: int = 2,
    window: int = 30,
) -> DataFrame:
    """Best recent track of each genre usual at an hour, else at the earliest hour within reach.

    Patterns and tracks are cut to one row per genre before they meet.
    """
    kind = patterns.filter(F.col("is_weekend") == F.lit(weekend))
    near = kind.filter(F.col("local_hour").between(hour - reach, hour + reach))
    chosen = near.agg(
        F.coalesce(
            F.max(F.when(F.col("local_hour") == hour, F.col("local_hour"))), F.min("local_hour")
        )
    ).scalar()
    genres = near.filter(F.col("local_hour") == chosen)
    order = [F.desc("hour_genre_probability"), F.col("primary_genre")]
    genres = top_n(genres, order, n).select("primary_genre", "hour_genre_probability")
    recent = silver.filter(since(F.col("local_date"), as_of, window))
    best = top_per_group(
        recent,
        ["primary_genre"],
        [F.desc_nulls_last("track_popularity"), F.col("track_id"), F.col("unique_play")],
        1,
        "_t",
    )
    return best.join(F.broadcast(genres), "primary_genre").select(
        *short_columns(),
        "album_name",
        F.col("track_popularity").alias("popularity"),
        F.col("hour_genre_probability").alias("score"),
    )
