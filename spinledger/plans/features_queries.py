"""Queries of the preference features, similarity matrices and user profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from spinledger.operators import features, profile, silver, similarity
from spinledger.plans.catalogue import joined_text, query, rounded
from spinledger.plans.oracle import define, half_up, sql


def listens(t):
    return silver.recent_listens(t.plays_events, t.artists)


# The layer tables that the recommendation queries share, written once per run.


def interactions(t):
    return t.written(
        "interactions", lambda: features.genre_interactions(t.silver_table, t.as_of)
    )


def track_features(t):
    return t.written(
        "features", lambda: features.track_features(track_base(t), t.catalog, t.as_of)
    )


def track_base(t):
    return t.written("track_base", lambda: features.track_base(t.silver_table, t.as_of))


def patterns(t):
    return t.written("patterns", lambda: features.temporal_patterns(t.silver_table, t.as_of))


def genre_matrix(t):
    return t.written(
        "matrix",
        lambda: similarity.genre_similarity(similarity.genre_sessions(t.silver_table, t.as_of)),
    )


def r6(expr: str) -> str:
    return half_up(expr, 6)


PREFERENCES = f"""count(*) AS play_count, count(DISTINCT track_id) AS unique_tracks,
  {r6("avg(track_popularity)")} AS avg_track_popularity,
  min(local_timestamp) AS first_listened_at, max(local_timestamp) AS last_listened_at"""


@query(
    "a13_genre_preferences",
    sql(
        f"""SELECT primary_genre, {PREFERENCES},
  count(DISTINCT primary_artist_id) AS unique_artists,
  {r6("avg(track_duration_ms)")} AS avg_track_duration_ms
FROM silver WHERE primary_genre IS NOT NULL GROUP BY primary_genre""",
        "silver",
    ),
)
def genre_preferences(t):
    return rounded(features.genre_preferences(listens(t)))


@query(
    "a13_artist_preferences",
    sql(
        f"""SELECT primary_artist_id, primary_artist_name, {PREFERENCES}
FROM silver_star GROUP BY primary_artist_id, primary_artist_name""",
        "silver_star",
    ),
)
def artist_preferences(t):
    return rounded(features.artist_preferences(silver.recent_listens(t.plays_star, t.artists)))


@query(
    "a13_track_preferences",
    sql(
        f"""SELECT * EXCLUDE (unique_tracks) FROM (SELECT track_id, track_name,
  primary_artist_id, primary_artist_name, primary_genre, {PREFERENCES}
FROM silver_star GROUP BY ALL)""".replace("GROUP BY ALL", "GROUP BY 1, 2, 3, 4, 5"),
        "silver_star",
    ),
)
def track_preferences(t):
    return rounded(features.track_preferences(silver.recent_listens(t.plays_star, t.artists)))


# -- genre interactions, track features, temporal patterns ---------------------------


def interactions_sql(source: str, last: str, user: str) -> str:
    return f"""
SELECT *, play_count * recency_weight AS weighted_preference,
  CAST(recent_plays > 0 AS INTEGER) AS is_current_preference,
  CAST(very_recent_plays > 0 AS INTEGER) AS is_very_recent_preference,
  ln(play_count + 1) AS log_play_count,
  CASE WHEN play_count >= 50 THEN 'high' WHEN play_count >= 20 THEN 'medium'
    WHEN play_count >= 10 THEN 'low' ELSE 'minimal' END AS preference_strength
FROM (SELECT {user} AS user_id, primary_genre, count(*) AS play_count,
    avg(track_popularity) AS avg_popularity,
    count(*) FILTER (WHERE local_date >= as_of - 30) AS recent_plays,
    count(*) FILTER (WHERE local_date >= as_of - 7) AS very_recent_plays,
    exp(-avg(as_of - local_date) / 30) AS recency_weight,
    avg(local_hour) AS avg_listening_hour,
    avg(CAST(is_weekend AS INTEGER)) AS weekend_preference,
    count(DISTINCT primary_artist_id) AS artist_diversity_in_genre,
    avg(track_duration_ms) / 60000 AS avg_duration_minutes,
    stddev_samp(track_popularity) AS popularity_variance
  FROM {source} CROSS JOIN {last} WHERE local_date >= as_of - 180
  GROUP BY ALL HAVING count(*) >= 3)"""


define("interactions", interactions_sql("silver", "last_day", "'user_1'"), "silver", "last_day")

INTERACTION_DOUBLES = [
    "avg_popularity", "recency_weight", "avg_listening_hour", "weekend_preference",
    "avg_duration_minutes", "popularity_variance", "weighted_preference", "log_play_count",
]


def replaced(columns: list[str], digits: int = 6) -> str:
    return "* REPLACE (" + ", ".join(f"{half_up(c, digits)} AS {c}" for c in columns) + ")"


@query(
    "a14_genre_interactions",
    sql(f"SELECT {replaced(INTERACTION_DOUBLES)} FROM interactions", "interactions"),
)
def genre_interactions(t):
    return rounded(features.genre_interactions(t.silver, t.as_of))


@query(
    "a14_genre_interactions_per_user",
    sql(
        f"""WITH with_user AS (SELECT s.*, p.user_id AS who FROM silver_star s
  JOIN plays_star p USING (unique_play)),
x AS ({interactions_sql("with_user", "last_day_star", "who")})
SELECT {replaced(INTERACTION_DOUBLES)} FROM x""",
        "silver_star",
        "last_day_star",
    ),
)
def genre_interactions_per_user(t):
    from spinledger.functions.timeparts import add_local_time

    plays = add_local_time(silver.with_artist(t.plays_star, t.artists))
    per_user = features.genre_interactions(plays, t.as_of_star, user="user_id")
    return rounded(per_user)


@query(
    "a15_genre_training_rows",
    sql(
        f"""WITH g AS (SELECT primary_genre,
  count(DISTINCT primary_artist_id) AS total_artists_in_genre,
  {r6("avg(track_popularity)")} AS genre_avg_popularity,
  {r6("stddev_samp(track_popularity)")} AS genre_popularity_variance,
  count(DISTINCT album_release_year) AS era_diversity,
  {r6("avg(track_duration_ms) / 60000")} AS genre_avg_duration
  FROM silver CROSS JOIN last_day WHERE local_date >= as_of - 180 GROUP BY primary_genre)
SELECT {replaced(INTERACTION_DOUBLES)} FROM interactions JOIN g USING (primary_genre)""",
        "interactions",
    ),
)
def genre_training_rows(t):
    return rounded(features.genre_training_rows(t.silver, t.as_of))


define("recent", "SELECT silver.* FROM silver CROSS JOIN last_day WHERE local_date >= as_of - 90", "silver", "last_day")
define(
    "tiered",
    """
SELECT *, CASE WHEN release_year >= 2020 THEN 'current' WHEN release_year >= 2015 THEN 'recent'
    WHEN release_year >= 2010 THEN '2010s' WHEN release_year >= 2000 THEN '2000s'
    WHEN release_year >= 1990 THEN '90s' ELSE 'classic' END AS era_category,
  CAST(least(track_popularity // 20, 4) AS INTEGER) AS popularity_tier,
  CAST(CASE WHEN track_duration_ms < 120000 THEN 0 WHEN track_duration_ms < 180000 THEN 1
    WHEN track_duration_ms < 240000 THEN 2 WHEN track_duration_ms < 300000 THEN 3
    WHEN track_duration_ms < 420000 THEN 4 ELSE 5 END AS INTEGER) AS duration_category
FROM (SELECT *, CAST(left(album_release_date, 4) AS INTEGER) AS release_year FROM catalog)""",
    "catalog",
)
define(
    "features",
    """
SELECT t.*, artist_genre_diversity, artist_avg_popularity, artist_track_count,
  artist_avg_duration, artist_total_plays, genre_avg_popularity, genre_avg_duration,
  genre_artist_count, genre_track_count, genre_popularity_variance, genre_avg_release_year,
  track_popularity - genre_avg_popularity AS popularity_vs_genre_avg,
  track_duration_ms - genre_avg_duration AS duration_vs_genre_avg,
  artist_avg_popularity - genre_avg_popularity AS artist_vs_genre_popularity,
  CAST(as_of - last_played_date AS INTEGER) AS days_since_last_played,
  coalesce(exp(-(as_of - last_played_date) / 30), 0) AS freshness_score,
  track_popularity / 100 AS popularity_normalized,
  user_play_count / greatest(max(user_play_count) OVER (), 1) AS play_count_normalized,
  (track_duration_ms - 60000) / 540000 AS duration_normalized
FROM (SELECT track_id, track_name, primary_artist_id, primary_artist_name, primary_genre,
    track_popularity, track_duration_ms, album_release_date, album_name, album_type,
    coalesce(n, 0) AS user_play_count, last_played_date, release_year, era_category,
    popularity_tier, duration_category,
    CAST(row_number() OVER (PARTITION BY primary_genre ORDER BY track_popularity DESC,
      coalesce(n, 0) DESC, track_id) AS INTEGER) AS genre_rank
  FROM tiered LEFT JOIN (SELECT track_id, count(*) AS n, max(local_date) AS last_played_date
    FROM recent GROUP BY track_id) USING (track_id)
  WHERE primary_genre IS NOT NULL QUALIFY genre_rank <= 50) t
CROSS JOIN last_day
LEFT JOIN (SELECT primary_artist_id, count(DISTINCT primary_genre) AS artist_genre_diversity,
    avg(track_popularity) AS artist_avg_popularity, count(DISTINCT track_id) AS artist_track_count,
    avg(track_duration_ms) AS artist_avg_duration, count(*) AS artist_total_plays
  FROM recent GROUP BY primary_artist_id) USING (primary_artist_id)
LEFT JOIN (SELECT primary_genre, avg(track_popularity) AS genre_avg_popularity,
    avg(track_duration_ms) AS genre_avg_duration,
    count(DISTINCT primary_artist_id) AS genre_artist_count,
    count(DISTINCT track_id) AS genre_track_count,
    stddev_samp(track_popularity) AS genre_popularity_variance,
    avg(album_release_year) AS genre_avg_release_year
  FROM silver WHERE track_id IN (SELECT track_id FROM recent) GROUP BY primary_genre)
  USING (primary_genre)""",
    "tiered",
    "recent",
    "last_day",
)

FEATURE_DOUBLES = [
    "artist_avg_popularity", "artist_avg_duration", "genre_avg_popularity",
    "genre_avg_duration", "genre_popularity_variance", "genre_avg_release_year",
    "popularity_vs_genre_avg", "duration_vs_genre_avg", "artist_vs_genre_popularity",
    "freshness_score", "popularity_normalized", "play_count_normalized", "duration_normalized",
]


@query("a16_track_features", sql(f"SELECT {replaced(FEATURE_DOUBLES)} FROM features", "features"))
def track_features_query(t):
    base = t.written("track_base", lambda: features.track_base(t.silver, t.as_of))
    return rounded(features.track_features(base, t.catalog, t.as_of))


define(
    "cells",
    """
SELECT primary_genre, local_hour, is_weekend, count(*) AS play_count,
  avg(track_popularity) AS avg_popularity, count(DISTINCT primary_artist_id) AS unique_artists,
  avg(track_duration_ms) / 60000 AS avg_duration_minutes
FROM recent GROUP BY primary_genre, local_hour, is_weekend HAVING count(*) >= 2""",
    "recent",
)
# a NULL genre counts in the hour's total and is dropped afterwards
define(
    "patterns",
    """
SELECT *, CASE WHEN hour_genre_probability > 0.3 THEN 'strong'
    WHEN hour_genre_probability > 0.1 THEN 'moderate' ELSE 'weak' END AS temporal_strength,
  hour_genre_probability * play_count AS temporal_recommendation_score
FROM (SELECT cells.*,
    play_count / sum(play_count) OVER (PARTITION BY local_hour, is_weekend)
      AS hour_genre_probability,
    play_count / sum(play_count) OVER (PARTITION BY primary_genre) AS genre_time_preference
  FROM cells)
JOIN (SELECT primary_genre, avg(local_hour) AS avg_listening_hour,
    stddev_samp(local_hour) AS hour_variance,
    avg(CAST(is_weekend AS INTEGER)) AS weekend_preference,
    count(DISTINCT local_hour) AS hour_diversity,
    CAST(sum(play_count) AS BIGINT) AS total_genre_plays
  FROM cells GROUP BY primary_genre) USING (primary_genre)""",
    "cells",
)

PATTERN_DOUBLES = [
    "avg_popularity", "avg_duration_minutes", "hour_genre_probability", "genre_time_preference",
    "avg_listening_hour", "hour_variance", "weekend_preference", "temporal_recommendation_score",
]


@query("a17_temporal_patterns", sql(f"SELECT {replaced(PATTERN_DOUBLES)} FROM patterns", "patterns"))
def temporal_patterns(t):
    return rounded(features.temporal_patterns(t.silver, t.as_of))


# -- similarity -----------------------------------------------------------------------

define(
    "sessions",
    """
SELECT epoch(date_trunc('hour', local_timestamp)) // 3600 AS session_id, primary_genre,
  count(*) AS tracks_in_session
FROM recent WHERE primary_genre IS NOT NULL GROUP BY ALL""",
    "recent",
)
define(
    "genre_totals",
    """
SELECT primary_genre, count(*) AS s, CAST(sum(tracks_in_session) AS BIGINT) AS n
FROM sessions GROUP BY primary_genre""",
    "sessions",
)
define(
    "matrix",
    """
SELECT a.primary_genre AS genre_1, b.primary_genre AS genre_2, count(*) AS sessions_together,
  avg(a.tracks_in_session + b.tracks_in_session) AS avg_session_intensity,
  any_value(x.s) AS genre_1_sessions, any_value(x.n) AS genre_1_total_tracks,
  any_value(y.s) AS genre_2_sessions, any_value(y.n) AS genre_2_total_tracks,
  count(*) / (any_value(x.s) + any_value(y.s) - count(*)) AS jaccard_similarity,
  count(*) / least(any_value(x.s), any_value(y.s)) AS overlap_ratio,
  jaccard_similarity * 0.6 + overlap_ratio * 0.4 AS combined_similarity_score,
  a.primary_genre AS from_genre, b.primary_genre AS to_genre,
  jaccard_similarity * 0.6 + overlap_ratio * 0.4 AS similarity_score
FROM sessions a JOIN sessions b
  ON a.session_id = b.session_id AND a.primary_genre <> b.primary_genre
JOIN genre_totals x ON x.primary_genre = a.primary_genre
JOIN genre_totals y ON y.primary_genre = b.primary_genre
GROUP BY a.primary_genre, b.primary_genre HAVING count(*) >= 3""",
    "sessions",
    "genre_totals",
)

MATRIX_DOUBLES = [
    "avg_session_intensity", "jaccard_similarity", "overlap_ratio",
    "combined_similarity_score", "similarity_score",
]


@query("a18_genre_similarity", sql(f"SELECT {replaced(MATRIX_DOUBLES)} FROM matrix", "matrix"))
def genre_similarity(t):
    sessions = similarity.genre_sessions(t.silver, t.as_of)
    return rounded(similarity.genre_similarity(sessions))


@query(
    "a18_genre_similarity_as_written",
    sql(
        f"""SELECT genre_1, genre_2, CAST(1 AS DOUBLE) AS jaccard_similarity,
  {r6("0.6 + overlap_ratio * 0.4")} AS similarity_score FROM matrix""",
        "matrix",
    ),
)
def genre_similarity_as_written(t):
    sessions = similarity.genre_sessions(t.silver, t.as_of)
    return rounded(similarity.genre_similarity(sessions, jaccard="reference")).select(
        "genre_1", "genre_2", "jaccard_similarity", "similarity_score"
    )


define(
    "recent_star",
    """
SELECT s.* FROM silver_star s CROSS JOIN last_day_star WHERE local_date >= as_of - 90""",
    "silver_star",
    "last_day_star",
)
define(
    "artist_profile",
    """
SELECT DISTINCT primary_artist_id, primary_artist_name, primary_genre, x.genre_count,
  avg_popularity
FROM recent_star JOIN (SELECT primary_artist_id, count(DISTINCT primary_genre) AS genre_count,
    avg(track_popularity) AS avg_popularity FROM recent_star GROUP BY primary_artist_id) x
  USING (primary_artist_id) WHERE primary_genre IS NOT NULL""",
    "recent_star",
)

ARTIST_PAIRS = f"""
SELECT a.primary_artist_id AS artist_1_id, a.primary_artist_name AS artist_1_name,
  b.primary_artist_id AS artist_2_id, b.primary_artist_name AS artist_2_name,
  a.primary_genre AS shared_genres, CAST(1 AS INTEGER) AS shared_genre_count,
  a.genre_count AS artist_1_genre_count, b.genre_count AS artist_2_genre_count,
  {r6("1 / (a.genre_count + b.genre_count - 1)")} AS genre_jaccard_similarity,
  {r6("1 - abs(a.avg_popularity - b.avg_popularity) / 100")} AS popularity_similarity,
  0.7 / (a.genre_count + b.genre_count - 1)
    + 0.3 * (1 - abs(a.avg_popularity - b.avg_popularity) / 100) AS score
FROM artist_profile a JOIN artist_profile b USING (primary_genre)
WHERE a.primary_artist_id < b.primary_artist_id"""


def artist_pairs_sql(condition: str) -> str:
    return sql(
        f"""WITH pairs AS ({ARTIST_PAIRS}) SELECT * EXCLUDE (score),
  {r6("score")} AS artist_similarity_score FROM pairs WHERE {condition}""",
        "artist_profile",
    )


def artist_profile(t):
    return similarity.artist_genre_profile(t.silver_star, t.as_of_star)


NEIGHBOURS = 3


@query(
    "a19_artist_similarity",
    sql(
        f"""WITH one_way AS ({ARTIST_PAIRS}),
pairs AS (SELECT * FROM one_way UNION ALL SELECT artist_2_id, artist_2_name, artist_1_id,
  artist_1_name, shared_genres, shared_genre_count, artist_2_genre_count, artist_1_genre_count,
  genre_jaccard_similarity, popularity_similarity, score FROM one_way),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY artist_1_id, shared_genres
  ORDER BY round(score, 9) DESC, artist_2_id) AS INTEGER) AS similarity_rank
  FROM pairs WHERE score IS NOT NULL)
SELECT * EXCLUDE (score), {r6("score")} AS artist_similarity_score
FROM ranked WHERE similarity_rank <= {NEIGHBOURS}""",
        "artist_profile",
    ),
)
def artist_similarity(t):
    pairs = similarity.artist_neighbours(artist_profile(t), NEIGHBOURS)
    return rounded(joined_text(pairs, "shared_genres"))


@query("a19_similar_to_artists", artist_pairs_sql("artist_1_name IN ('Supplier#000000001', 'Supplier#000000002', 'Supplier#000000003')"))
def similar_to_artists(t):
    names = ["Supplier#000000001", "Supplier#000000002", "Supplier#000000003"]
    return rounded(joined_text(similarity.similar_to_artists(artist_profile(t), names), "shared_genres"))


@query(
    "st6_gap_sessions",
    sql(
        """WITH marked AS (SELECT user_id, date_trunc('second', played_at) AS sec,
  coalesce(date_trunc('second', played_at) - lag(date_trunc('second', played_at))
    OVER (PARTITION BY user_id ORDER BY played_at) >= INTERVAL 60 MINUTE, true) AS fresh
  FROM plays),
numbered AS (SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY user_id ORDER BY sec) AS session FROM marked)
SELECT user_id, min(sec) AS session_start, max(sec) AS last_play, count(*) AS plays
FROM numbered GROUP BY user_id, session""",
        "plays",
    ),
)
def gap_sessions(t):
    return similarity.gap_sessions(t.plays_events)


@query(
    "st6_hour_sessions",
    sql("SELECT CAST(session_id AS BIGINT) AS session_id, primary_genre, tracks_in_session FROM sessions", "sessions"),
)
def hour_sessions(t):
    return similarity.genre_sessions(t.silver, t.as_of)


# -- profiles -------------------------------------------------------------------------


def best_list(value: str, n: int = 10) -> str:
    return f"""SELECT string_agg({value} || '=' || printf('%.4f', share), '|' ORDER BY share DESC, {value})
  FROM (SELECT {value}, count(*) / sum(count(*)) OVER () AS share FROM liked GROUP BY {value}
    ORDER BY count(*) DESC, {value} LIMIT {n})"""


@query(
    "a29_user_profile",
    sql(
        f"""WITH liked AS (SELECT * FROM features WHERE user_play_count >= 1)
SELECT ({best_list("primary_genre")}) AS top_genres,
  ({best_list("primary_artist_name")}) AS top_artists,
  quantile_cont(track_popularity, 0.25) AS popularity_low,
  quantile_cont(track_popularity, 0.75) AS popularity_high,
  (SELECT era_category FROM liked GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS preferred_era,
  quantile_cont(track_duration_ms, 0.25) AS duration_low,
  quantile_cont(track_duration_ms, 0.75) AS duration_high,
  count(DISTINCT primary_genre) / 50 AS discovery_openness,
  count(DISTINCT primary_genre) AS total_genres,
  count(DISTINCT primary_artist_name) AS total_artists, count(*) AS total_tracks,
  {r6("avg(track_popularity)")} AS avg_popularity,
  {r6("avg(track_duration_ms) / 60000")} AS avg_duration_min FROM liked""",
        "features",
    ),
)
def user_profile(t):
    built = profile.user_profile(track_features(t))

    def text(column):
        item = F.transform(
            column, lambda x: F.concat(x["name"], F.lit("="), F.format_string("%.4f", x["score"]))
        )
        return F.array_join(item, "|")

    flat = built.select(
        text(F.col("top_genres")).alias("top_genres"),
        text(F.col("top_artists")).alias("top_artists"),
        F.get("preferred_popularity_range", F.lit(0)).alias("popularity_low"),
        F.get("preferred_popularity_range", F.lit(1)).alias("popularity_high"),
        F.get("preferred_eras", F.lit(0)).alias("preferred_era"),
        F.get("preferred_duration_range", F.lit(0)).alias("duration_low"),
        F.get("preferred_duration_range", F.lit(1)).alias("duration_high"),
        "discovery_openness",
        "stats.*",
    )
    return rounded(flat)


@query(
    "a30_taste_profile",
    sql(
        f"""WITH g AS (SELECT 'genre' AS profile_type, primary_genre AS item_name,
  {r6("weighted_preference")} AS preference_score, CAST(row_number() OVER (
    ORDER BY weighted_preference DESC, primary_genre) AS INTEGER) AS preference_rank
  FROM interactions QUALIFY preference_rank <= 10),
a AS (SELECT 'artist' AS profile_type, primary_artist_name AS item_name,
  CAST(count(*) AS DOUBLE) AS preference_score, CAST(row_number() OVER (
    ORDER BY count(*) DESC, primary_artist_name) AS INTEGER) AS preference_rank
  FROM recent GROUP BY primary_artist_name QUALIFY preference_rank <= 10),
h AS (SELECT 'temporal' AS profile_type, 'Hour ' || local_hour ||
    CASE WHEN is_weekend THEN ' (Weekend)' ELSE ' (Weekday)' END AS item_name,
  {r6("temporal_recommendation_score")} AS preference_score, CAST(row_number() OVER (
    ORDER BY temporal_recommendation_score DESC, primary_genre, local_hour, is_weekend) AS INTEGER)
    AS preference_rank
  FROM patterns WHERE temporal_strength <> 'weak' QUALIFY preference_rank <= 5)
SELECT * FROM g UNION ALL SELECT * FROM a UNION ALL SELECT * FROM h""",
        "interactions",
        "patterns",
    ),
)
def taste_profile(t):
    built = profile.taste_profile(interactions(t), t.silver, patterns(t), t.as_of)
    return rounded(built.drop("additional_info"))
