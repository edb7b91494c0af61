"""Queries of the discovery feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from spinledger.operators import feeds, flatten
from spinledger.plans.catalogue import query, rounded
from spinledger.plans.features_queries import interactions, r6, track_features
from spinledger.plans.oracle import define, half_up, sql

# Rows discovered before this moment form the target table, later rows the new batch.
SPLIT, NOW = "2024-01-26 00:00:00", "2024-02-01 00:00:00"


def moment(text):
    return F.lit(text).cast("timestamp_ntz")


def halves(df):
    old = F.col("discovered_at") < moment(SPLIT)
    return df.filter(old), df.filter(~old)


OLD = f"discovered_at < TIMESTAMP '{SPLIT}'"
ML_OUT = """track_id, track_name, primary_artist_name, primary_artist_id, album_name,
  album_release_date, track_popularity, track_duration_ms, discovery_strategy,
  ml_recommendation_score, ml_strategies_used, ml_weighted_score, seed_track, seed_genre,
  genre_novelty_score, artist_novelty_score, discovery_count, first_discovered_at, created_at,
  updated_at"""
define(
    "ml_table",
    f"""
SELECT track_id, any_value(track_name) AS track_name,
  any_value(primary_artist_name) AS primary_artist_name,
  any_value(primary_artist_id) AS primary_artist_id, any_value(album_name) AS album_name,
  any_value(album_release_date) AS album_release_date,
  any_value(track_popularity) AS track_popularity,
  any_value(track_duration_ms) AS track_duration_ms,
  any_value(discovery_strategy) AS discovery_strategy,
  max(ml_recommendation_score) AS ml_recommendation_score,
  any_value(ml_strategies_used) AS ml_strategies_used,
  max(ml_weighted_score) AS ml_weighted_score, any_value(seed_track) AS seed_track,
  any_value(seed_genre) AS seed_genre, any_value(genre_novelty_score) AS genre_novelty_score,
  any_value(artist_novelty_score) AS artist_novelty_score, count(*) AS discovery_count,
  min(discovered_at) AS first_discovered_at,
  CASE WHEN min(discovered_at) < TIMESTAMP '{SPLIT}' THEN TIMESTAMP '{SPLIT}'
    ELSE TIMESTAMP '{NOW}' END AS created_at,
  CASE WHEN max(discovered_at) < TIMESTAMP '{SPLIT}' THEN TIMESTAMP '{SPLIT}'
    ELSE TIMESTAMP '{NOW}' END AS updated_at
FROM ml_feed GROUP BY track_id""",
    "ml_feed",
)


def ml_table(t):
    """The ML feed as two batches: the first makes the table, the second is merged in."""
    before, after = halves(t.ml_feed)
    empty = feeds.reduce_ml_source(before).limit(0).withColumns(
        {"created_at": moment(SPLIT), "updated_at": moment(SPLIT)}
    )
    table = feeds.upsert_ml_discoveries(empty, before, moment(SPLIT))
    return feeds.upsert_ml_discoveries(table, after, moment(NOW))


@query(
    "j18_upsert_counter",
    sql(
        f"SELECT * REPLACE ({r6('ml_weighted_score')} AS ml_weighted_score) "
        f"FROM (SELECT {ML_OUT} FROM ml_table)",
        "ml_table",
    ),
)
def upsert_counter(t):
    return rounded(ml_table(t).drop("preview_url"))


FEED_OUT = """track_id, track_name, primary_artist_name, primary_artist_id, album_name,
  album_release_date, track_popularity, track_duration_ms, discovery_strategy, seed_artist,
  seed_genre, preference_score, discovered_at"""
define(
    "feed_table",
    f"""
SELECT {FEED_OUT}, CAST(0 AS DOUBLE) AS recommendation_score,
  CASE WHEN {OLD} THEN TIMESTAMP '{SPLIT}' ELSE TIMESTAMP '{NOW}' END AS created_at,
  TIMESTAMP '{NOW}' AS updated_at FROM feed""",
    "feed",
)


def feed_table(t):
    """Early rows make the table, then all rows arrive again with the late ones."""
    before, _ = halves(t.feed)
    table = before.select(
        *feeds.FEED_COLUMNS,
        F.lit(0.0).alias("recommendation_score"),
        moment(SPLIT).alias("created_at"),
        moment(SPLIT).alias("updated_at"),
    )
    return feeds.upsert_discoveries(table, t.feed, moment(NOW))


@query("j19_upsert_insert_only", sql("SELECT * FROM feed_table", "feed_table"))
def upsert_insert_only(t):
    return feed_table(t).drop("preview_url")


@query(
    "j17_upsert_latest",
    sql(
        f"""SELECT track_id, source, seed_value, CASE WHEN {OLD.replace("discovered_at", "fetched_at")}
  THEN track_popularity ELSE 99 END AS track_popularity, fetched_at FROM candidates""",
        "candidates",
    ),
)
def upsert_latest(t):
    rows = t.candidates.select("track_id", "source", "seed_value", "track_popularity", "fetched_at")
    late = rows.filter(F.col("fetched_at") >= moment(SPLIT))
    changed = late.withColumn("track_popularity", F.lit(99))
    return feeds.upsert_latest(rows, changed, order=[F.desc("fetched_at")])


@query(
    "u4_first_arrival",
    sql(
        """SELECT track_id, ml_recommendation_score, discovered_at FROM ml_feed
QUALIFY row_number() OVER (PARTITION BY track_id ORDER BY discovered_at) = 1""",
        "ml_feed",
    ),
)
def first_arrival(t):
    kept = feeds.first_arrival(t.ml_feed, [F.col("discovered_at")])
    return kept.select("track_id", "ml_recommendation_score", "discovered_at")


@query(
    "p3_candidates",
    sql(
        """SELECT track_id, track_name, primary_artist_id, source, seed_value, track_popularity,
  album_release_date, fetched_at FROM candidates""",
        "candidates",
    ),
)
def candidates(t):
    """Search results in their nested form, flattened."""
    nested = t.candidates.selectExpr(
        "track_id AS id",
        "track_name AS name",
        "array(struct(primary_artist_id AS id, primary_artist_name AS name)) AS artists",
        "track_popularity AS popularity",
        "struct(album_release_date AS release_date) AS album",
        "source AS found_by",
        "seed_value AS found_for",
        "fetched_at AS at",
    )
    rows = flatten.flatten_candidates(nested, F.col("found_by"), F.col("found_for"), F.col("at"))
    return rows.drop("primary_artist_name", "raw_payload")


define(
    "smart",
    """
WITH shares AS (SELECT primary_artist_name AS an, count(*) / sum(count(*)) OVER () AS share
  FROM features GROUP BY 1),
scored AS (SELECT f.*, CASE discovery_strategy WHEN 'artist_based'
    THEN coalesce(share, 0.1) * 0.5 + f.track_popularity / 100 * 0.3 + preference_score * 0.2
    ELSE coalesce(weighted_preference, 0.1) * 0.4 + f.track_popularity / 100 * 0.3
      + preference_score * 0.2 + 1 / (as_of - CAST(discovered_at AS DATE) + 1) * 0.1 END AS raw,
  row_number() OVER (PARTITION BY primary_artist_name ORDER BY f.track_popularity DESC, track_id)
    AS ar,
  row_number() OVER (PARTITION BY coalesce(seed_genre, 'unknown')
    ORDER BY f.track_popularity DESC, track_id) AS gr
  FROM feed f CROSS JOIN last_day
  LEFT JOIN (SELECT * FROM interactions WHERE weighted_preference > 0.1)
    ON lower(seed_genre) = lower(primary_genre)
  LEFT JOIN shares ON primary_artist_name = an
  WHERE CAST(discovered_at AS DATE) >= as_of - 7)
SELECT *, CAST(ar AS INTEGER) AS artist_diversity_rank,
  CAST(gr AS INTEGER) AS genre_diversity_rank, preference_score AS seed_preference_score,
  raw * CASE ar WHEN 1 THEN 1 WHEN 2 THEN 0.7 WHEN 3 THEN 0.4 ELSE 0.2 END
    * CASE WHEN gr <= 3 THEN 1 WHEN gr <= 5 THEN 0.8 ELSE 0.5 END AS final_recommendation_score
FROM scored WHERE round(raw, 9) > 0.2""",
    "feed",
    "features",
    "interactions",
    "last_day",
)


def smart(t):
    return feeds.smart_discoveries(t.feed, interactions(t), track_features(t), t.as_of)


@query(
    "r20_smart_discoveries",
    sql(
        f"""SELECT track_id, track_name, primary_artist_name, discovery_strategy, seed_genre,
  seed_preference_score, {r6("final_recommendation_score")} AS final_recommendation_score,
  artist_diversity_rank, genre_diversity_rank, discovered_at FROM smart""",
        "smart",
    ),
)
def smart_query(t):
    return rounded(
        smart(t).drop(
            "primary_artist_id", "album_name", "album_release_date", "track_popularity",
            "track_duration_ms", "preview_url", "seed_artist",
        )
    )


@query(
    "r20_top_discoveries",
    sql(
        f"""SELECT CAST(row_number() OVER (ORDER BY round(final_recommendation_score, 9) DESC,
    track_id) AS INTEGER) AS recommendation_rank, track_name, primary_artist_name,
  coalesce(seed_genre, seed_artist) AS discovery_seed, discovery_strategy, track_popularity,
  {half_up("final_recommendation_score", 3)} AS score, CAST(NULL AS VARCHAR) AS preview_url,
  'track/' || track_id AS track_url FROM smart QUALIFY recommendation_rank <= 10""",
        "smart",
    ),
)
def top_discoveries(t):
    return feeds.top_discoveries(smart(t))


@query(
    "a21_discovery_analytics",
    sql(
        f"""SELECT count(*) AS total_discoveries,
  count(DISTINCT primary_artist_name) AS unique_artists_discovered,
  count(DISTINCT seed_genre) AS genres_explored,
  count(DISTINCT discovery_strategy) AS strategies_used,
  {r6("avg(track_popularity)")} AS avg_discovery_popularity,
  count(*) FILTER (WHERE discovery_strategy = 'artist_based') AS artist_based_discoveries,
  count(*) FILTER (WHERE discovery_strategy = 'genre_based') AS genre_based_discoveries,
  count(*) FILTER (WHERE round(final_recommendation_score, 9) > 0.7) AS high_quality_discoveries,
  count(*) FILTER (WHERE round(final_recommendation_score, 9) BETWEEN 0.4 AND 0.7)
    AS medium_quality_discoveries,
  count(*) FILTER (WHERE round(final_recommendation_score, 9) < 0.4) AS low_quality_discoveries,
  max(discovered_at) AS latest_discovery, min(discovered_at) AS earliest_discovery,
  (SELECT string_agg(x, '; ' ORDER BY rn) FROM (SELECT track_name || ' by ' ||
    primary_artist_name AS x, row_number() OVER (ORDER BY round(final_recommendation_score, 9) DESC,
    track_id) AS rn FROM smart) WHERE rn <= 5) AS top_5_recommendations FROM smart""",
        "smart",
    ),
)
def discovery_analytics(t):
    return rounded(feeds.discovery_analytics(smart(t)))


@query(
    "a21_quick_test",
    sql(
        """SELECT 'Total Discovered Tracks' AS metric, count(*) AS value, '' AS details FROM feed
UNION ALL SELECT 'Recent High-Quality Recommendations', count(*),
  'Score > 0.6, Discovered in last 7 days' FROM smart
  WHERE round(final_recommendation_score, 9) > 0.6
UNION ALL (SELECT 'Top Discovery Strategy', 0, discovery_strategy FROM feed GROUP BY 3
  ORDER BY count(*) DESC, 3 LIMIT 1)
UNION ALL (SELECT 'Most Discovered Artist', count(*), primary_artist_name FROM feed GROUP BY 3
  ORDER BY count(*) DESC, 3 LIMIT 1)""",
        "smart",
    ),
)
def quick_test(t):
    return feeds.quick_test(t.feed, smart(t))


define(
    "feeds",
    """
SELECT 'Smart Search' AS pipeline, track_id, track_name, primary_artist_name, seed_genre,
  track_popularity, discovery_strategy, coalesce(preference_score, 0.5) AS score,
  discovered_at AS created_at FROM feed
UNION ALL SELECT 'ML Hybrid', track_id, track_name, primary_artist_name, seed_genre,
  track_popularity, discovery_strategy, ml_recommendation_score, first_discovered_at FROM ml_table""",
    "feed",
    "ml_table",
)


def both(t):
    table = ml_table(t).withColumn("discovered_at", F.col("first_discovered_at"))
    return feeds.tagged_feeds(t.feed, table, "discovered_at")


@query(
    "a22_feed_totals",
    sql(
        f"""SELECT pipeline, count(*) AS total_discoveries,
  {r6("avg(track_popularity)")} AS avg_popularity,
  count(DISTINCT primary_artist_name) AS unique_artists,
  count(DISTINCT seed_genre) AS unique_genres, max(created_at) AS latest_discovery
FROM feeds GROUP BY pipeline""",
        "feeds",
    ),
)
def feed_totals(t):
    return rounded(feeds.feed_totals(both(t)))


@query(
    "a22_feed_quality",
    sql(
        f"""SELECT pipeline, count(*) AS total_tracks,
  {half_up("avg(track_popularity)", 2)} AS avg_popularity,
  count(DISTINCT discovery_strategy) AS strategies_used, {half_up("avg(score)", 3)} AS avg_score,
  count(DISTINCT seed_genre) AS genre_diversity, min(created_at) AS first_discovery,
  max(created_at) AS latest_discovery
FROM feeds CROSS JOIN last_day WHERE CAST(created_at AS DATE) >= as_of - 7 GROUP BY pipeline""",
        "feeds",
        "last_day",
    ),
)
def feed_quality(t):
    return feeds.feed_quality(both(t), t.as_of)


@query(
    "a22_feed_diversity",
    sql(
        f"""SELECT pipeline, count(DISTINCT seed_genre) AS genre_diversity,
  count(DISTINCT primary_artist_name) AS artist_diversity,
  {half_up("avg(track_popularity)", 2)} AS avg_popularity,
  count(*) FILTER (WHERE track_popularity < 30) AS underground_tracks,
  count(*) FILTER (WHERE track_popularity > 70) AS mainstream_tracks
FROM feeds GROUP BY pipeline""",
        "feeds",
    ),
)
def feed_diversity(t):
    return feeds.feed_diversity(both(t))


@query(
    "a22_feed_top",
    sql(
        f"""SELECT track_id, track_name, primary_artist_name, seed_genre, track_popularity,
  discovery_strategy, {half_up("score", 3)} AS score, created_at FROM feeds
WHERE pipeline = 'ML Hybrid' ORDER BY feeds.score DESC, track_id LIMIT 10""",
        "feeds",
    ),
)
def feed_top(t):
    return feeds.feed_top(both(t), feeds.ML)


@query(
    "a22_feed_strategies",
    sql(
        f"""SELECT pipeline, discovery_strategy, count(*) AS track_count,
  {half_up("avg(track_popularity)", 2)} AS avg_popularity, {half_up("avg(score)", 3)} AS avg_score,
  count(DISTINCT primary_artist_name) AS unique_artists FROM feeds GROUP BY 1, 2""",
        "feeds",
    ),
)
def feed_strategies(t):
    return feeds.feed_strategies(both(t))


@query(
    "j13_feed_genres",
    sql(
        f"""WITH s AS (SELECT seed_genre, count(*) AS n, {half_up("avg(track_popularity)", 2)} AS p
  FROM feed WHERE seed_genre IS NOT NULL GROUP BY 1),
m AS (SELECT seed_genre, count(*) AS n, {half_up("avg(track_popularity)", 2)} AS p
  FROM ml_feed GROUP BY 1)
SELECT coalesce(s.seed_genre, m.seed_genre) AS genre, coalesce(s.n, 0) AS smart_search_tracks,
  coalesce(m.n, 0) AS ml_hybrid_tracks, coalesce(s.p, 0) AS smart_avg_popularity,
  coalesce(m.p, 0) AS ml_avg_popularity FROM s FULL JOIN m ON s.seed_genre = m.seed_genre
ORDER BY smart_search_tracks + ml_hybrid_tracks DESC, genre LIMIT 15""",
        "feed",
        "ml_feed",
    ),
)
def feed_genres(t):
    return feeds.feed_genres(t.feed, t.ml_feed)


@query(
    "a22_feed_timeline",
    sql(
        """SELECT date_trunc('hour', created_at) AS discovery_hour,
  count(*) FILTER (WHERE pipeline = 'Smart Search') AS smart_discoveries,
  count(*) FILTER (WHERE pipeline = 'ML Hybrid') AS ml_discoveries
FROM feeds CROSS JOIN last_day WHERE CAST(created_at AS DATE) >= as_of - 2
GROUP BY 1 ORDER BY 1 DESC LIMIT 24""",
        "feeds",
        "last_day",
    ),
)
def feed_timeline(t):
    return feeds.feed_timeline(both(t), t.as_of)


@query(
    "a22_feed_score_bands",
    sql(
        f"""SELECT CASE WHEN ml_recommendation_score >= 0.8 THEN 'Excellent (0.8+)'
  WHEN ml_recommendation_score >= 0.6 THEN 'Good (0.6-0.8)'
  WHEN ml_recommendation_score >= 0.4 THEN 'Fair (0.4-0.6)' ELSE 'Low (<0.4)' END AS score_range,
  count(*) AS track_count, {half_up("avg(track_popularity)", 2)} AS avg_popularity
FROM ml_feed GROUP BY 1""",
        "ml_feed",
    ),
)
def feed_score_bands(t):
    return feeds.feed_score_bands(t.ml_feed)
