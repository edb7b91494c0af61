"""Queries of coverage, quality, drift, the semantic model and the model logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from spinledger.functions.ranking import top_n
from spinledger.operators import gold, modellog, quality, semantic, silver, strategies
from spinledger.plans.catalogue import joined_text, query, rounded
from spinledger.plans.features_queries import genre_matrix, interactions, r6, track_features
from spinledger.plans.gold_queries import GENRE_SQL, MONTHLY_SQL, daily_sql
from spinledger.plans.oracle import define, half_up, sql

define("kept_artists", "SELECT * FROM artists WHERE genre_count > 0", "artists")


def kept_artists(t):
    """The dimension after the deletion of artists without genres: its gaps are the missing."""
    return silver.remove_empty_genres(t.artists)


define(
    "missing",
    """
SELECT primary_artist_id, primary_artist_name, count(DISTINCT unique_play) AS play_count,
  count(DISTINCT local_date) AS days_active, min(local_timestamp) AS first_played,
  max(local_timestamp) AS last_played, count(DISTINCT track_id) AS unique_tracks
FROM silver_star WHERE primary_artist_id NOT IN (SELECT artist_id FROM kept_artists) GROUP BY 1, 2""",
    "silver_star",
    "kept_artists",
)


def missing(t):
    return quality.missing_artists(t.silver_star, kept_artists(t))


@query("a23_missing_artists", sql("SELECT * FROM missing", "missing"))
def missing_artists(t):
    return missing(t)


@query(
    "a23_missing_summary",
    sql(
        f"""SELECT count(*) AS total_missing_artists,
  CAST(sum(play_count) AS BIGINT) AS total_missing_plays,
  max(play_count) AS most_plays_by_missing_artist,
  {r6("avg(play_count)")} AS avg_plays_per_missing_artist,
  {half_up("100.0 * sum(play_count) / (SELECT count(*) FROM silver_star)", 2)}
    AS percentage_of_total_plays FROM missing""",
        "missing",
    ),
)
def missing_summary(t):
    return rounded(quality.missing_summary(missing(t), t.silver_star))


@query(
    "a23_missing_csv",
    sql(
        """SELECT string_agg(primary_artist_id, ',' ORDER BY play_count DESC, primary_artist_id)
  AS artist_ids_csv FROM (FROM missing ORDER BY play_count DESC, primary_artist_id LIMIT 50)""",
        "missing",
    ),
)
def missing_csv(t):
    return quality.top_id_list(missing(t), "primary_artist_id", "play_count")


@query(
    "a23_missing_json",
    sql(
        """SELECT '[' || string_agg('{"primary_artist_id":"' || primary_artist_id
  || '","primary_artist_name":"' || primary_artist_name || '","play_count":' || play_count || '}',
  ',' ORDER BY play_count DESC, primary_artist_id) || ']' AS json_output
FROM (FROM missing ORDER BY play_count DESC, primary_artist_id LIMIT 50)""",
        "missing",
    ),
)
def missing_json(t):
    return quality.top_id_list(missing(t), "primary_artist_id", "play_count", fmt="json")


@query(
    "a24_genre_coverage",
    sql(
        f"""WITH c AS (SELECT count(DISTINCT primary_artist_id) AS ta,
  count(DISTINCT primary_artist_id) FILTER (WHERE artist_id IS NOT NULL) AS ka,
  count(*) AS tp, count(*) FILTER (WHERE artist_id IS NOT NULL) AS kp
  FROM silver_star s LEFT JOIN kept_artists ON primary_artist_id = artist_id)
SELECT ta AS total_artists, ka AS artists_with_genres, ta - ka AS missing_artists,
  {half_up("100.0 * ka / ta", 2)} AS artist_coverage_percentage, tp AS total_plays,
  kp AS plays_with_genres, tp - kp AS plays_missing_genres,
  {half_up("100.0 * kp / tp", 2)} AS play_coverage_percentage FROM c""",
        "silver_star",
        "kept_artists",
    ),
)
def genre_coverage(t):
    return quality.genre_coverage(t.silver_star, kept_artists(t))


@query(
    "a24_genre_status",
    sql(
        f"""SELECT count(*) AS total_artists, CAST(0 AS BIGINT) AS null_genres,
  count(*) FILTER (WHERE len(genres_list) = 0) AS empty_array_genres,
  count(*) FILTER (WHERE genre_count = 0) AS zero_genre_count,
  count(*) FILTER (WHERE genre_count > 0) AS artists_with_genres,
  {half_up("100.0 * count(*) FILTER (WHERE genre_count > 0) / count(*)", 2)}
    AS current_coverage_percentage FROM artists""",
        "artists",
    ),
)
def genre_status(t):
    return quality.genre_status(t.artists)


@query(
    "a24_removal_counts",
    sql(
        """SELECT count(*) AS artists_to_remove,
  count(DISTINCT artist_id) AS unique_artist_ids_to_remove FROM artists WHERE genre_count = 0""",
        "artists",
    ),
)
def removal_counts(t):
    return quality.removal_counts(t.artists)


@query(
    "a25_data_sources",
    sql(
        f"""SELECT data_source, count(*) AS artist_count,
  {half_up("100.0 * count(*) / sum(count(*)) OVER ()", 2)} AS percentage
FROM artists GROUP BY data_source""",
        "artists",
    ),
)
def data_sources(t):
    return quality.data_sources(t.artists)


define(
    "empty_artists",
    """
SELECT artist_id, artist_name, popularity, followers_total, a.genre_count, a.data_source,
  count(unique_play) AS total_plays, count(DISTINCT local_date) AS days_active,
  min(local_timestamp) AS first_played, max(local_timestamp) AS last_played
FROM artists a LEFT JOIN silver ON artist_id = primary_artist_id
WHERE a.genre_count = 0 GROUP BY ALL""",
    "artists",
    "silver",
)


@query("a26_empty_genre_artists", sql("SELECT * FROM empty_artists", "empty_artists"))
def empty_genre_artists(t):
    return quality.empty_genre_artists(t.artists, t.silver)


@query(
    "a26_empty_genre_summary",
    sql(
        f"""SELECT count(*) AS total_empty_genre_artists,
  CAST(sum(total_plays) AS BIGINT) AS total_plays_affected,
  {r6("avg(popularity)")} AS avg_popularity, {r6("avg(followers_total)")} AS avg_followers,
  max(total_plays) AS most_plays_by_empty_genre_artist,
  {half_up("100.0 * sum(total_plays) / (SELECT count(*) FROM silver)", 2)}
    AS percentage_of_total_plays FROM empty_artists""",
        "empty_artists",
    ),
)
def empty_genre_summary(t):
    empty = quality.empty_genre_artists(t.artists, t.silver)
    return rounded(quality.empty_genre_summary(empty, t.silver))


@query(
    "a27_health_metrics",
    sql(
        f"""WITH n AS (SELECT TIMESTAMP '2024-01-31 12:00:00' AS now)
SELECT 'total_tracks_ingested' AS metric_name, CAST(count(*) AS DOUBLE) AS metric_value FROM plays
UNION ALL SELECT 'data_freshness_hours', date_diff('hour', max(played_at), any_value(now))
  FROM plays, n
UNION ALL SELECT 'tracks_last_24h', count(*) FROM plays, n WHERE ingested_at >= now - INTERVAL 24 HOUR
UNION ALL SELECT 'total_artists_processed', count(*) FROM artists
UNION ALL SELECT 'artists_with_genres', count(*) FROM artists WHERE genre_count > 0
UNION ALL SELECT 'avg_genres_per_artist', {r6("avg(genre_count)")} FROM artists
  WHERE genre_count > 0""",
        "plays",
        "artists",
    ),
)
def pipeline_metrics(t):
    now = F.lit("2024-01-31 12:00:00").cast("timestamp_ntz")
    rows = quality.pipeline_metrics(t.plays_events, t.artists, now)
    return rounded(rows.drop("metric_description"))


@query(
    "a28_freshness",
    sql(
        """SELECT count(*) AS total_plays, count(DISTINCT unique_play) AS unique_plays,
  count(DISTINCT primary_artist_id) AS unique_artists, count(DISTINCT track_id) AS unique_tracks,
  min(local_timestamp) AS earliest_play, max(local_timestamp) AS latest_play,
  max(ingested_at) AS latest_ingestion,
  CAST(date_diff('day', min(local_timestamp), max(local_timestamp)) AS INTEGER) AS days_of_data
FROM silver_star""",
        "silver_star",
    ),
)
def freshness(t):
    return quality.freshness(t.silver_star)


DUPLICATES = """SELECT count(*) AS total_rows, count(DISTINCT unique_play) AS unique_rows,
  count(*) - count(DISTINCT unique_play) AS duplicate_count,
  CASE WHEN count(*) = count(DISTINCT unique_play) THEN 'No duplicates' ELSE 'Duplicates found' END
    AS duplicate_status FROM {}"""


@query("a28_duplicate_check", sql(DUPLICATES.format("landed_star"), "landed_star"))
def duplicate_check(t):
    return quality.duplicate_check(t.landed_star)


@query("a28_duplicate_check_deduped", sql(DUPLICATES.format("plays_star"), "plays_star"))
def duplicate_check_deduped(t):
    return quality.duplicate_check(t.plays_star)


@query(
    "a28_recent_days",
    sql(
        """SELECT local_date AS play_date, count(*) AS plays_count,
  count(DISTINCT primary_artist_id) AS unique_artists, count(DISTINCT track_id) AS unique_tracks,
  min(local_timestamp) AS first_play, max(local_timestamp) AS last_play
FROM silver WHERE local_timestamp >= TIMESTAMP '2024-01-29 18:00:00' GROUP BY 1""",
        "silver",
    ),
)
def recent_days(t):
    now = F.lit("2024-01-30 18:00:00").cast("timestamp_ntz")
    return quality.recent_days(t.silver, now)


@query(
    "a28_ingest_timeline",
    sql(
        """SELECT CAST(ingested_at AS DATE) AS ingestion_date, count(*) AS plays_ingested,
  count(DISTINCT primary_artist_id) AS artists_ingested, min(ingested_at) AS first_ingestion,
  max(ingested_at) AS last_ingestion
FROM silver CROSS JOIN last_day WHERE CAST(ingested_at AS DATE) >= as_of - 7 GROUP BY 1""",
        "silver",
        "last_day",
    ),
)
def ingest_timeline(t):
    return quality.ingest_timeline(t.silver, t.as_of)


QUALITY_DOUBLES = [
    "avg_track_popularity", "weekend_preference", "discovery_rate", "replay_rate",
    "niche_genre_rate", "diversity_score", "engagement_score", "overall_score",
]
define(
    "listening_quality",
    """
WITH r AS (SELECT s.*, count(*) OVER (PARTITION BY track_id) AS tn,
    count(*) OVER (PARTITION BY primary_genre) AS gn
  FROM silver_star s CROSS JOIN last_day_star WHERE local_date >= as_of - 60)
SELECT count(DISTINCT track_id) AS unique_tracks, count(DISTINCT primary_genre) AS unique_genres,
  count(DISTINCT primary_artist_name) AS unique_artists, count(*) AS total_plays,
  avg(track_popularity) AS avg_track_popularity,
  count(DISTINCT local_hour) AS listening_hour_diversity,
  avg(CAST(is_weekend AS INTEGER)) AS weekend_preference,
  count(*) FILTER (WHERE tn = 1) / count(*) AS discovery_rate,
  count(*) FILTER (WHERE tn > 3) / count(*) AS replay_rate,
  count(*) FILTER (WHERE gn <= 5) / count(*) AS niche_genre_rate,
  discovery_rate * 0.4 + listening_hour_diversity / 24 * 0.3 + niche_genre_rate * 0.3
    AS diversity_score,
  replay_rate * 0.6 + (1 - abs(avg_track_popularity - 50) / 50) * 0.4 AS engagement_score,
  (diversity_score + engagement_score) / 2 AS overall_score FROM r""",
    "silver_star",
    "last_day_star",
)


def replace_doubles(names, source: str) -> str:
    changes = ", ".join(f"{r6(n)} AS {n}" for n in names)
    return f"SELECT * REPLACE ({changes}) FROM {source}"


@query(
    "a33_listening_quality",
    sql(replace_doubles(QUALITY_DOUBLES, "listening_quality"), "listening_quality"),
)
def listening_quality(t):
    return rounded(quality.listening_quality(t.silver_star, t.as_of_star, 60))


def drift_sql(days: int, weights, source: str) -> str:
    parts = []
    for name, condition in (
        ("recent", f"local_date >= as_of - {days}"),
        ("older", f"local_date < as_of - {days}"),
    ):
        parts.append(
            f"""count(DISTINCT primary_genre) FILTER (WHERE {condition}) AS {name}_genres,
  avg(track_popularity) FILTER (WHERE {condition}) AS {name}_popularity,
  avg(local_hour) FILTER (WHERE {condition}) AS {name}_hour,
  avg(CAST(is_weekend AS INTEGER)) FILTER (WHERE {condition}) AS {name}_weekend"""
        )
    score = " + ".join(
        f"{n} * {w}"
        for n, w in zip(
            ("genre_drift", "popularity_drift", "temporal_drift", "weekend_drift"), weights
        )
    )
    return f"""SELECT {", ".join(parts)},
  abs(recent_genres - older_genres) / greatest(older_genres, 1) AS genre_drift,
  abs(recent_popularity - older_popularity) / 100 AS popularity_drift,
  abs(recent_hour - older_hour) / 24 AS temporal_drift,
  abs(recent_weekend - older_weekend) AS weekend_drift, {score} AS drift_score FROM {source}"""


DRIFT_DOUBLES = [
    "recent_popularity", "older_popularity", "recent_hour", "older_hour", "recent_weekend",
    "older_weekend", "genre_drift", "popularity_drift", "temporal_drift", "weekend_drift",
    "drift_score",
]


@query(
    "a34_drift",
    sql(
        f"""WITH w AS (SELECT * FROM silver CROSS JOIN last_day WHERE local_date >= as_of - 14),
d AS ({drift_sql(7, quality.DRIFT_WEIGHTS_3, "w")}) {replace_doubles(DRIFT_DOUBLES, "d")}""",
        "silver",
        "last_day",
    ),
)
def drift(t):
    return rounded(quality.drift(t.silver, t.as_of))


@query(
    "a34_drift_four_parts",
    sql(
        f"""WITH w AS (SELECT DISTINCT local_date >= as_of - 15 AS late, primary_genre,
    track_popularity, local_hour, is_weekend, as_of,
    CASE WHEN local_date >= as_of - 15 THEN as_of ELSE as_of - 20 END AS local_date
  FROM silver CROSS JOIN last_day WHERE local_date >= as_of - 30),
d AS ({drift_sql(15, quality.DRIFT_WEIGHTS_4, "w")}) {replace_doubles(DRIFT_DOUBLES, "d")}""",
        "silver",
        "last_day",
    ),
)
def drift_four_parts(t):
    return rounded(quality.drift(t.silver, t.as_of, 15, quality.DRIFT_WEIGHTS_4, True))


@query(
    "a35_data_sufficiency",
    sql(
        """WITH s AS (SELECT count(*) AS total_tracks, count(DISTINCT primary_genre) AS unique_genres,
  count(DISTINCT primary_artist_id) AS unique_artists, count(DISTINCT local_date) AS unique_days,
  min(local_date) AS earliest_date, max(local_date) AS latest_date
  FROM silver CROSS JOIN last_day WHERE local_date >= as_of - 180)
SELECT *, total_tracks >= 50 AS listening_history, unique_genres >= 5 AS genre_diversity,
  unique_artists >= 20 AS artist_diversity, unique_days >= 7 AS temporal_data,
  total_tracks >= 50 AND unique_genres >= 5 AND unique_artists >= 20 AND unique_days >= 7
    AS sufficient_for_ml FROM s""",
        "silver",
        "last_day",
    ),
)
def data_sufficiency(t):
    return quality.data_sufficiency(t.silver, t.as_of)


@query(
    "a35_root_cause",
    sql(
        """SELECT (SELECT count(*) FROM plays) AS plays, count(*) AS silver_plays,
  count(*) FILTER (WHERE local_date >= (SELECT as_of - 90 FROM last_day)) AS recent_plays,
  count(DISTINCT primary_genre) AS genres, (SELECT count(*) FROM features) AS feature_tracks,
  (SELECT count(*) FROM interactions) AS liked_genres,
  (SELECT count(*) FROM matrix WHERE jaccard_similarity > 0) AS similar_pairs,
  CAST(0 AS BIGINT) AS collaborative,
  'Recommendation filters too restrictive' AS root_cause,
  'Relax the thresholds' AS recommended_fix FROM silver""",
        "features",
        "interactions",
        "matrix",
    ),
)
def root_cause(t):
    features, likes, matrix = track_features(t), interactions(t), genre_matrix(t)
    # every genre is liked here, so that no genre is left to recommend
    found = strategies.collaborative(likes, matrix, features, min_preference=0.0)
    return quality.root_cause(t.plays_events, t.silver, features, likes, matrix, found, t.as_of)


@query(
    "a35_table_summary",
    sql(
        """SELECT count(DISTINCT track_id) AS track_count,
  count(DISTINCT primary_genre) AS genre_count FROM silver_star""",
        "silver_star",
    ),
)
def table_summary(t):
    return quality.table_summary(t.silver_star)


# -- semantic model ----------------------------------------------------------------------

ALL_MEASURES = list(semantic.MODEL["silver_plays"].measures)


@query(
    "a36_silver_measures",
    sql(
        f"""SELECT left(dayname(local_timestamp), 3) AS day_of_week, listening_source,
  count(unique_play) AS total_plays, {r6("sum(track_duration_minutes)")} AS total_listening_minutes,
  {r6("avg(track_duration_minutes)")} AS average_track_length,
  {r6("avg(track_popularity)")} AS average_track_popularity,
  {r6("avg(artist_popularity)")} AS average_artist_popularity,
  {r6("avg((track_popularity + artist_popularity) / 2)")} AS mainstream_score,
  count(DISTINCT primary_artist_id) AS unique_artists, count(DISTINCT track_id) AS unique_tracks,
  count(DISTINCT primary_genre) AS unique_genres, count(DISTINCT album_id) AS unique_albums,
  {r6("avg(artist_followers)")} AS average_artist_followers FROM silver_star GROUP BY 1, 2""",
        "silver_star",
    ),
)
def silver_measures(t):
    tables = {"silver_plays": t.silver_star}
    by = ["day_of_week", "listening_source"]
    return rounded(semantic.measure(tables, "silver_plays", by, ALL_MEASURES))


@query(
    "a36_daily_measures",
    sql(
        f"""WITH d AS ({daily_sql("silver")})
SELECT month_name, is_weekend, CAST(sum(total_plays) AS BIGINT) AS daily_total_plays,
  CAST(sum(unique_artists) AS BIGINT) AS daily_unique_artists,
  {r6("sum(total_listening_minutes)")} AS daily_listening_minutes,
  {r6("avg(mainstream_score)")} AS daily_mainstream_score FROM d GROUP BY 1, 2""",
        "silver",
    ),
)
def daily_measures(t):
    tables = {"daily_summary": gold.daily_summary(t.silver)}
    names = [
        "daily_total_plays", "daily_unique_artists", "daily_listening_minutes",
        "daily_mainstream_score",
    ]
    by = ["month_name", "is_weekend"]
    return rounded(semantic.measure(tables, "daily_summary", by, names))


@query(
    "a36_artist_measures",
    sql(
        f"""WITH a AS (SELECT artist_id, a.primary_genre, popularity, count(*) AS n,
  {half_up("sum(track_duration_minutes)", 2)} AS m, count(DISTINCT track_id) AS tr
  FROM artists a LEFT JOIN silver ON artist_id = primary_artist_id GROUP BY ALL)
SELECT primary_genre, CAST(sum(n) AS BIGINT) AS artist_total_plays,
  {r6("sum(m)")} AS artist_listening_minutes, CAST(sum(tr) AS BIGINT) AS artist_unique_tracks,
  {r6("avg(popularity)")} AS artist_popularity FROM a GROUP BY 1""",
        "artists",
        "silver",
    ),
)
def artist_measures(t):
    tables = {"artist_summary": gold.artist_summary(t.silver, t.artists)}
    names = list(semantic.MODEL["artist_summary"].measures)
    return rounded(semantic.measure(tables, "artist_summary", ["primary_genre"], names))


@query(
    "a36_plays_with_their_day",
    sql(
        f"""WITH d AS ({daily_sql("silver")})
SELECT unique_play, d.total_plays AS daily_total_plays, d.top_genre AS daily_top_genre,
  (SELECT count(*) FROM silver x WHERE x.primary_artist_id = s.primary_artist_id)
    AS artist_total_plays
FROM silver s JOIN d USING (local_date)""",
        "silver",
    ),
)
def plays_with_their_day(t):
    days = semantic.with_daily_summary(
        t.silver, gold.daily_summary(t.silver), "total_plays", "top_genre"
    )
    artists = gold.artist_summary(t.silver, t.artists)
    rows = semantic.with_artist_summary(days, artists, "total_plays")
    return rows.select("unique_play", "daily_total_plays", "daily_top_genre", "artist_total_plays")


@query(
    "a36_metrics",
    sql(
        """SELECT time_of_day_category, count(DISTINCT primary_artist_id) AS musical_diversity
FROM silver_star GROUP BY 1""",
        "silver_star",
    ),
)
def metrics(t):
    by = ["time_of_day_category"]
    return semantic.metric({"silver_plays": t.silver_star}, "musical_diversity", by)


@query(
    "a37_plays_yesterday",
    sql(
        """SELECT CAST(count(*) AS BIGINT) AS daily_total_plays FROM silver CROSS JOIN last_day
WHERE local_date = as_of - 1""",
        "silver",
        "last_day",
    ),
)
def plays_yesterday(t):
    return semantic.plays_yesterday(gold.daily_summary(t.silver), t.as_of)


@query(
    "a37_most_played_genre",
    sql(
        f"""WITH g AS ({GENRE_SQL}) SELECT primary_genre, total_plays AS genre_total_plays
FROM g ORDER BY total_plays DESC, primary_genre LIMIT 1""",
        "silver",
    ),
)
def most_played_genre(t):
    return semantic.most_played_genre(gold.genre_analysis(t.silver))


@query(
    "a37_top_artist_in_genre",
    sql(
        f"""WITH g AS ({GENRE_SQL}) SELECT top_artist, top_artist_plays FROM g
WHERE primary_genre = 'NATION_7'""",
        "silver",
    ),
)
def top_artist_in_genre(t):
    return semantic.top_artist_in_genre(gold.genre_analysis(t.silver), "NATION_7")


@query(
    "a37_last_months",
    sql(
        f"""WITH m AS ({MONTHLY_SQL}) SELECT month_name, total_plays AS monthly_total_plays,
  plays_growth_rate FROM m WHERE year = 2001 ORDER BY month DESC LIMIT 3""",
        "silver_star",
    ),
)
def last_months(t):
    return semantic.last_months(gold.monthly_insights(t.silver_star), t.as_of_star)


# -- model logs: orders stand for log rows, one model per customer ---------------------------

define(
    "deployments",
    """SELECT 'model_' || o_custkey AS model_name, 'v' || o_orderkey AS version,
  'production' AS deployment_environment, o_orderdate AS deployment_timestamp,
  CASE WHEN o_orderkey % 5 = 0 THEN 'active_rollback' ELSE 'active' END AS deployment_status,
  'v' || (o_orderkey - 1) AS previous_version FROM orders""",
)


def deployments(t):
    return t.read("orders").selectExpr(
        "'model_' || o_custkey AS model_name",
        "'v' || o_orderkey AS version",
        "'production' AS deployment_environment",
        "o_orderdate AS deployment_timestamp",
        "CASE WHEN o_orderkey % 5 = 0 THEN 'active_rollback' ELSE 'active' END "
        "AS deployment_status",
        "'v' || (o_orderkey - 1) AS previous_version",
        "true AS rollback_available",
    )


CURRENT = """(SELECT * FROM deployments QUALIFY row_number() OVER (PARTITION BY model_name
  ORDER BY deployment_timestamp DESC, version DESC) = 1)"""
LATER = "timestamp_ntz'2030-01-01 00:00:00' AS deployment_timestamp"


@query(
    "l1_deploy",
    sql(
        f"""SELECT model_name, 'next' AS version, 'production' AS deployment_environment,
  TIMESTAMP '2030-01-01' AS deployment_timestamp, 'active' AS deployment_status,
  version AS previous_version FROM {CURRENT}""",
        "deployments",
    ),
)
def deploy(t):
    log = deployments(t)
    requests = log.select("model_name", "deployment_environment").distinct()
    requests = requests.selectExpr("*", "'next' AS version", LATER)
    return modellog.deploy(log, requests).drop("rollback_available")


@query(
    "l1_rollback",
    sql(
        f"""SELECT model_name, previous_version AS version, 'production' AS deployment_environment,
  TIMESTAMP '2030-01-01' AS deployment_timestamp, 'active_rollback' AS deployment_status,
  version AS previous_version FROM {CURRENT}""",
        "deployments",
    ),
)
def rollback(t):
    log = deployments(t)
    requests = log.select("model_name", "deployment_environment").distinct()
    return modellog.rollback(log, requests.selectExpr("*", LATER)).drop("rollback_available")


@query(
    "l1_deployment_history",
    sql(
        """SELECT model_name, version, deployment_timestamp, coalesce(CASE lead(deployment_status)
    OVER (PARTITION BY model_name ORDER BY deployment_timestamp, version)
  WHEN 'active_rollback' THEN 'rolled_back' WHEN 'active' THEN 'replaced' END, deployment_status)
    AS current_status FROM deployments""",
        "deployments",
    ),
)
def deployment_history(t):
    history = modellog.deployment_history(deployments(t))
    return history.select("model_name", "version", "deployment_timestamp", "current_status")


define(
    "trainings",
    """SELECT 'model_' || o_custkey AS model_name, 'v' || o_orderkey AS version,
  o_orderdate AS training_timestamp, o_totalprice / 500000 AS overall_performance,
  o_orderstatus <> 'F' AS training_completed FROM orders""",
)


def trainings(t):
    return t.read("orders").selectExpr(
        "'model_' || o_custkey AS model_name",
        "'v' || o_orderkey AS version",
        "o_orderdate AS training_timestamp",
        "o_totalprice / 500000 AS overall_performance",
        "o_orderstatus <> 'F' AS training_completed",
    )


@query(
    "l2_training_history",
    sql(
        f"""SELECT model_name, version, training_timestamp,
  {r6("overall_performance")} AS overall_performance,
  {r6("lag(overall_performance) OVER m")} AS previous_performance,
  {r6("overall_performance - lag(overall_performance) OVER m")} AS performance_change,
  CAST(date_diff('day', lag(training_timestamp) OVER m, training_timestamp) AS INTEGER)
    AS days_since_last_training FROM trainings WHERE training_completed
WINDOW m AS (PARTITION BY model_name ORDER BY training_timestamp, version)""",
        "trainings",
    ),
)
def training_history(t):
    return rounded(modellog.training_history(trainings(t)).drop("training_completed"))


@query(
    "l3_alerts",
    sql(
        """SELECT model_name, version, CASE WHEN overall_performance / 0.6 < 0.5 THEN 'CRITICAL'
  WHEN overall_performance / 0.6 < 0.7 THEN 'HIGH' ELSE 'MEDIUM' END AS severity
FROM trainings WHERE overall_performance < 0.6""",
        "trainings",
    ),
)
def alerts(t):
    low = trainings(t).filter("overall_performance < 0.6").selectExpr(
        "model_name || '/' || version AS model_name",
        "overall_performance AS performance_score",
        "0.6D AS threshold",
    )
    rows = modellog.alerts(low, F.lit("2030-01-01").cast("timestamp_ntz"))
    return rows.selectExpr(
        "split(model_name, '/')[0] AS model_name", "split(model_name, '/')[1] AS version", "severity"
    )


@query(
    "l4_retrain_decision",
    sql(
        """SELECT version, concat_ws('|',
  CASE WHEN overall_performance < 0.7 THEN 'retrain_model|analyze_user_feedback' END,
  CASE WHEN o_orderkey % 10 > 2 THEN 'concept_drift_detected|incremental_update' END,
  CASE WHEN overall_performance > 0.8 AND o_orderkey % 10 < 1 THEN 'performance_excellent' END,
  CASE WHEN o_custkey % 30 > 14 THEN 'model_aging' END) AS recommendations
FROM trainings JOIN orders ON version = 'v' || o_orderkey""",
        "trainings",
    ),
)
def retrain_decision(t):
    scores = t.read("orders").selectExpr(
        "'v' || o_orderkey AS version",
        "o_totalprice / 500000 AS overall_score",
        "(o_orderkey % 10) / 10 AS drift_score",
        "int(o_custkey % 30) AS model_age_days",
    )
    decided = modellog.retrain_decision(scores)
    return joined_text(decided, "recommendations").select("version", "recommendations")


@query(
    "r27_model_scores",
    sql(
        f"""WITH p AS (SELECT avg(track_popularity) AS p FROM silver CROSS JOIN last_day
  WHERE local_date >= as_of - 7)
SELECT 'v' || o_orderkey AS version, {r6("least((o_orderkey % 360) / 180, 1.0)")} AS coverage_score,
  {r6("least((o_orderkey % 45) / 30, 1.0)")} AS diversity_score,
  {r6("greatest(0, 1 - (DATE '2001-11-30' - CAST(o_orderdate AS DATE)) / 30)")} AS freshness_score,
  {r6("CASE o_orderstatus WHEN 'F' THEN 1 - abs(p - 50) / 50 WHEN 'O' THEN 0.8 ELSE 0.6 END")}
    AS popularity_alignment,
  {r6('''least((o_orderkey % 360) / 180, 1.0) * 0.3 + least((o_orderkey % 45) / 30, 1.0) * 0.25
    + greatest(0, 1 - (DATE '2001-11-30' - CAST(o_orderdate AS DATE)) / 30) * 0.25
    + CASE o_orderstatus WHEN 'F' THEN 1 - abs(p - 50) / 50 WHEN 'O' THEN 0.8 ELSE 0.6 END * 0.2''')}
    AS overall_score
FROM orders CROSS JOIN p""",
        "silver",
        "last_day",
    ),
)
def model_scores(t):
    scored = scored_models(t).drop("model_name")
    return rounded(scored.drop("model_type", "training_data_days", "n_components", "training_timestamp"))


def scored_models(t):
    models = t.read("orders").selectExpr(
        "'ranker' AS model_name",
        "'v' || o_orderkey AS version",
        "CASE o_orderstatus WHEN 'F' THEN 'collaborative' WHEN 'O' THEN 'content_based' "
        "ELSE 'other' END AS model_type",
        "o_orderkey % 360 AS training_data_days",
        "o_orderkey % 45 AS n_components",
        "o_orderdate AS training_timestamp",
    )
    recent = silver.in_window(t.silver, t.as_of, 7)
    popularity = recent.agg(F.avg("track_popularity")).scalar()
    return modellog.model_scores(models, popularity, F.lit("2001-11-30").cast("date"))


@query(
    "r27_compare_models",
    sql(
        f"""WITH p AS (SELECT avg(track_popularity) AS p FROM silver CROSS JOIN last_day
  WHERE local_date >= as_of - 7),
s AS (SELECT o_orderkey, least((o_orderkey % 360) / 180, 1.0) * 0.3
    + least((o_orderkey % 45) / 30, 1.0) * 0.25
    + greatest(0, 1 - (DATE '2001-11-30' - CAST(o_orderdate AS DATE)) / 30) * 0.25
    + CASE o_orderstatus WHEN 'F' THEN 1 - abs(p - 50) / 50 WHEN 'O' THEN 0.8 ELSE 0.6 END * 0.2
    AS score FROM orders CROSS JOIN p)
SELECT 'ranker' AS model_a_name, 'v44' AS model_a_version, 'ranker' AS model_b_name,
  'v170' AS model_b_version, {r6("a.score")} AS model_a_score, {r6("b.score")} AS model_b_score,
  CASE WHEN a.score > b.score THEN 'model_a' ELSE 'model_b' END AS winner,
  {r6("abs(a.score - b.score)")} AS confidence, abs(a.score - b.score) > 0.05 AS significant,
  CASE WHEN abs(a.score - b.score) > 0.05 THEN 'deploy_winner' ELSE 'continue_testing' END
    AS recommendation
FROM s a, s b WHERE a.o_orderkey = 44 AND b.o_orderkey = 170""",
        "silver",
        "last_day",
    ),
)
def compare_models(t):
    return rounded(
        modellog.compare_models(scored_models(t), ("ranker", "v44"), ("ranker", "v170"))
    )


@query(
    "w12_best_list_position",
    sql(
        """SELECT primary_artist_id, n AS plays, CAST(row_number() OVER (ORDER BY n DESC,
  primary_artist_id) AS INTEGER) AS position FROM (SELECT primary_artist_id, count(*) AS n
  FROM silver GROUP BY 1) QUALIFY position <= 30""",
        "silver",
    ),
)
def best_list_position(t):
    counted = gold.plays_by(t.silver, "primary_artist_id")
    return top_n(counted, [F.desc("plays"), F.col("primary_artist_id")], 30, "position")


@query(
    "w10_percent_rank",
    sql(
        f"""WITH a AS (SELECT primary_artist_id, count(*) AS plays FROM silver_star GROUP BY 1)
SELECT primary_artist_id, plays, {r6('''(rank() OVER (ORDER BY plays) +
  (count(*) OVER (PARTITION BY plays) - 1) / 2) / count(*) OVER ()''')} AS plays_rank FROM a""",
        "silver_star",
    ),
)
def percent_rank(t):
    from spinledger.functions.ranking import average_percent_rank

    counted = gold.plays_by(t.silver_star, "primary_artist_id")
    return rounded(average_percent_rank(counted, "plays", "plays_rank"))


@query(
    "j16_period_pivot",
    sql(
        """SELECT primary_genre, count(*) FILTER (WHERE local_date >= as_of - 7) AS recent_plays,
  count(*) FILTER (WHERE local_date < as_of - 7) AS older_plays
FROM silver CROSS JOIN last_day WHERE local_date >= as_of - 14 GROUP BY 1""",
        "silver",
        "last_day",
    ),
)
def period_pivot(t):
    recent = F.col("local_date") >= F.date_sub(t.as_of, 7)
    rows = silver.in_window(t.silver, t.as_of, 14).groupBy("primary_genre")
    return rows.agg(
        F.count_if(recent).alias("recent_plays"), F.count_if(~recent).alias("older_plays")
    )
