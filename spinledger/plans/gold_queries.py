"""Queries of the silver and gold layers, the raw summaries and the dashboard group-bys."""

from __future__ import annotations

from pyspark.sql import functions as F

from spinledger.functions import tiers
from spinledger.functions.ranking import most_frequent, top_n
from spinledger.operators import gold, silver
from spinledger.plans.catalogue import joined_text, query, rounded
from spinledger.plans.oracle import half_up, local, pct, sql

SILVER_COLUMNS = """unique_play, local_timestamp, local_date, local_hour, local_day_of_week,
  local_month, local_year, local_quarter, is_weekend, time_of_day_category,
  played_at AS utc_played_at, played_at_timestamp AS utc_timestamp, track_id, track_name,
  track_duration_ms, track_duration_minutes, track_popularity, track_explicit,
  CAST(NULL AS VARCHAR) AS track_preview_url, 'track:' || track_id AS track_uri,
  primary_artist_id, primary_artist_name, artist_popularity, artist_followers, primary_genre,
  array_to_string(all_genres, '|') AS all_genres, genre_count, is_multi_genre_artist, album_id,
  album_name, album_type, album_release_date, album_release_year, album_total_tracks,
  album_age_years, is_single, is_compilation, context_type,
  context_type || ':' || track_id AS context_uri, listening_source, ingested_at, data_source"""


@query("p5_silver_plays", sql(f"SELECT {SILVER_COLUMNS} FROM silver", "silver"))
def silver_plays(t):
    return joined_text(t.silver.drop("listening_event_id"), "all_genres")


@query("p5_silver_star", sql(f"SELECT {SILVER_COLUMNS} FROM silver_star", "silver_star"))
def silver_star(t):
    return joined_text(t.silver_star.drop("listening_event_id"), "all_genres")


@query(
    "p5_exact_event_number",
    sql(
        """SELECT unique_play, local_timestamp,
  row_number() OVER (ORDER BY local_timestamp, unique_play) AS listening_event_id FROM silver""",
        "silver",
    ),
)
def exact_event_number(t):
    numbered = silver.enrich_plays(t.plays_events, t.artists, exact_event_number=True)
    return numbered.select("unique_play", "local_timestamp", "listening_event_id")


@query(
    "p4_local_time",
    sql(
        """SELECT local_date, local_hour, local_day_of_week, is_weekend, time_of_day_category,
  local_quarter, count(*) AS plays FROM silver GROUP BY ALL""",
        "silver",
    ),
)
def local_time(t):
    keys = ["local_date", "local_hour", "local_day_of_week", "is_weekend"]
    return gold.plays_by(t.silver, *keys, "time_of_day_category", "local_quarter")


@query(
    "p6_recent_listens",
    sql(
        """SELECT unique_play, local_timestamp, played_at, played_at_timestamp,
  CAST(played_at AS DATE) AS played_at_date, CAST(hour(played_at) AS INTEGER) AS played_at_hour,
  track_id, track_name, track_duration_ms, track_popularity, track_explicit,
  CAST(NULL AS VARCHAR) AS track_preview_url, CAST(NULL AS VARCHAR) AS track_external_urls,
  'track:' || track_id AS track_uri, primary_artist_id, primary_artist_name, primary_genre,
  array_to_string(all_genres, '|') AS genres_list, genre_count, artist_popularity,
  artist_followers, album_id, album_name, album_type, album_release_date, album_total_tracks,
  context_type, context_type || ':' || track_id AS context_uri,
  CAST(NULL AS VARCHAR) AS context_external_urls, ingested_at, data_source FROM silver""",
        "silver",
    ),
)
def recent_listens(t):
    return joined_text(silver.recent_listens(t.plays_events, t.artists), "genres_list")


TIERS_SQL = """
  CASE WHEN release_year >= 2020 THEN 'current' WHEN release_year >= 2015 THEN 'recent'
    WHEN release_year >= 2010 THEN '2010s' WHEN release_year >= 2000 THEN '2000s'
    WHEN release_year >= 1990 THEN '90s' ELSE 'classic' END AS era_category,
  CAST(least(track_popularity // 20, 4) AS INTEGER) AS popularity_tier,
  CAST(CASE WHEN track_duration_ms < 120000 THEN 0 WHEN track_duration_ms < 180000 THEN 1
    WHEN track_duration_ms < 240000 THEN 2 WHEN track_duration_ms < 300000 THEN 3
    WHEN track_duration_ms < 420000 THEN 4 ELSE 5 END AS INTEGER) AS duration_category"""


@query(
    "p7_tiers",
    sql(
        f"""SELECT track_id, release_year, {TIERS_SQL} FROM
  (SELECT *, CAST(left(album_release_date, 4) AS INTEGER) AS release_year FROM catalog)""",
        "catalog",
    ),
)
def tier_columns(t):
    return silver.with_tiers(t.catalog).select(
        "track_id", "release_year", "era_category", "popularity_tier", "duration_category"
    )


def label_case(top: str, mid: str, low: str, deep: str) -> str:
    return f"""CASE WHEN track_popularity >= 80 THEN 'Mainstream Hit' WHEN track_popularity >= 60
  THEN '{top}' WHEN track_popularity >= 40 THEN '{mid}' WHEN track_popularity >= 20
  THEN '{low}' ELSE '{deep}' END"""


SHORT_LABEL = label_case("Popular", "Rising", "Hidden Gem", "Deep Cut")
LONG_LABEL = label_case("Popular Track", "Rising Track", "Hidden Gem", "Deep Cut Discovery")


@query(
    "p8_popularity_labels",
    sql(
        f"""SELECT track_id, {SHORT_LABEL} AS short_label, {LONG_LABEL} AS long_label,
  'track/' || track_id AS link FROM catalog""",
        "catalog",
    ),
)
def popularity_labels(t):
    popularity = F.col("track_popularity")
    return t.catalog.select(
        "track_id",
        tiers.popularity_label(popularity).alias("short_label"),
        tiers.popularity_label(popularity, "long").alias("long_label"),
        tiers.track_link(F.col("track_id")).alias("link"),
    )


# -- filters -----------------------------------------------------------------


@query(
    "f1_lookback_window",
    sql(
        """SELECT w AS days, count(*) AS plays FROM silver CROSS JOIN last_day
  CROSS JOIN (SELECT CAST(unnest([7, 14, 30, 60, 90, 180]) AS INTEGER) AS w)
  WHERE local_date >= as_of - w GROUP BY w""",
        "silver",
        "last_day",
    ),
)
def lookback_window(t):
    days = [7, 14, 30, 60, 90, 180]
    age = F.datediff(t.as_of, F.col("local_date"))
    counts = silver.in_window(t.silver, t.as_of, max(days)).agg(
        *[F.count_if(age <= n).alias(str(n)) for n in days]
    )
    stacked = ", ".join(f"{n}, `{n}`" for n in days)
    return counts.selectExpr(f"stack({len(days)}, {stacked}) AS (days, plays)").filter("plays > 0")


@query(
    "f2_sidebar_filter",
    sql(
        """SELECT unique_play, primary_genre, time_of_day_category FROM silver
  WHERE primary_genre IN ('NATION_1', 'NATION_7', 'NATION_14')
    AND time_of_day_category IN ('Morning', 'Night') AND is_weekend""",
        "silver",
    ),
)
def sidebar_filter(t):
    genres, parts = ["NATION_1", "NATION_7", "NATION_14"], ["Morning", "Night"]
    kept = silver.sidebar_filter(t.silver, genres, parts, "weekends")
    return kept.select("unique_play", "primary_genre", "time_of_day_category")


ARTIST_SQL = """artist_id, artist_name, array_to_string(genres_list, '|') AS genres_list,
  genre_count, popularity, followers_total"""
ARTIST_COLUMNS = [
    "artist_id", "artist_name", "genres_list", "genre_count", "popularity", "followers_total",
]


@query(
    "f3_multi_genre_artists",
    sql(f"SELECT {ARTIST_SQL} FROM artists WHERE genre_count > 1", "artists"),
)
def multi_genre_artists(t):
    return joined_text(silver.multi_genre_artists(t.artists), "genres_list")


@query(
    "f4_empty_genre_rows",
    sql(f"SELECT {ARTIST_SQL} FROM artists WHERE genre_count = 0", "artists"),
)
def empty_genre_rows(t):
    rows = silver.empty_genre_rows(t.artists).select(*ARTIST_COLUMNS)
    return joined_text(rows, "genres_list")


@query(
    "f5_stale_artists",
    sql(
        """SELECT artist_id, artist_name, ingested_at FROM artists CROSS JOIN last_day
  WHERE CAST(ingested_at AS DATE) < as_of - 30 OR genre_count = 0
  ORDER BY ingested_at, artist_id LIMIT 50""",
        "artists",
        "last_day",
    ),
)
def stale_artists(t):
    due = silver.stale_artists(t.artists, t.as_of, limit=50)
    return due.select("artist_id", "artist_name", "ingested_at")


@query(
    "f6_enhanced_artists",
    sql(
        "SELECT artist_id, data_source FROM artists WHERE data_source LIKE '%enhanced%'",
        "artists",
    ),
)
def enhanced_artists(t):
    return silver.enhanced_artists(t.artists).select("artist_id", "data_source")


@query(
    "f7_popularity_band",
    sql(
        """SELECT track_id, track_popularity FROM catalog
  WHERE track_popularity BETWEEN 60 AND 85""",
        "catalog",
    ),
)
def popularity_band(t):
    return silver.popularity_band(t.catalog, [60, 85]).select("track_id", "track_popularity")


@query(
    "f8_not_listened",
    sql(
        """SELECT track_id, source, seed_value FROM candidates
  WHERE track_id NOT IN (SELECT track_id FROM plays)""",
        "candidates",
        "plays",
    ),
)
def not_listened(t):
    fresh = silver.not_listened(t.candidates, t.plays_events)
    return fresh.select("track_id", "source", "seed_value")


@query(
    "f9_remove_empty_genres",
    sql(f"SELECT {ARTIST_SQL} FROM artists WHERE genre_count > 0", "artists"),
)
def remove_empty_genres(t):
    return joined_text(silver.remove_empty_genres(t.artists).select(*ARTIST_COLUMNS), "genres_list")


@query(
    "f10_valid_feed_rows",
    sql(
        """SELECT track_id, discovery_strategy, ingested_at FROM feed
  WHERE CAST(ingested_at AS DATE) >= DATE '2024-01-30' - 7""",
        "feed",
    ),
)
def valid_feed_rows(t):
    rows = silver.valid_feed_rows(t.feed, F.lit("2024-01-30").cast("date"))
    return rows.select("track_id", "discovery_strategy", "ingested_at")


# -- marts -------------------------------------------------------------------

DAILY = f"""
SELECT local_date, left(dayname(local_date), 3) AS day_of_week, is_weekend,
  left(monthname(local_date), 3) AS month_name, local_quarter AS quarter, local_year AS year,
  count(*) AS total_plays, count(DISTINCT track_id) AS unique_tracks,
  count(DISTINCT primary_artist_id) AS unique_artists,
  count(DISTINCT album_id) AS unique_albums, count(DISTINCT primary_genre) AS unique_genres,
  {half_up("sum(track_duration_minutes)", 2)} AS total_listening_minutes,
  {half_up("avg(track_duration_minutes)", 2)} AS average_track_length_minutes,
  {half_up("count(DISTINCT primary_genre) / count(*) * 100", 2)} AS genre_diversity_score,
  {pct("is_multi_genre_artist")} AS multi_genre_artist_percentage,
  count(DISTINCT primary_artist_id) AS new_artists_discovered,
  count(DISTINCT track_id) AS new_tracks_discovered,
  {half_up("100.0 * (count(*) - count(DISTINCT unique_play)) / count(*)", 1)}
    AS repeat_play_percentage,
  {pct("listening_source = 'playlist'")} AS playlist_play_percentage,
  {pct("listening_source = 'album'")} AS album_play_percentage,
  {pct("listening_source = 'artist'")} AS artist_play_percentage,
  {half_up("avg(track_popularity)", 1)} AS average_track_popularity,
  {half_up("avg(artist_popularity)", 1)} AS average_artist_popularity,
  {half_up("(avg(track_popularity) + avg(artist_popularity)) / 2", 1)} AS mainstream_score,
  {half_up("avg(local_hour)", 0)} AS average_listening_hour,
  count(DISTINCT date_trunc('hour', local_timestamp)) AS listening_sessions,
  max(ingested_at) AS last_updated
FROM {{silver}} GROUP BY local_date, is_weekend, local_quarter, local_year"""


def top_sql(source: str, keys: str, value: str, name: str) -> str:
    """Most frequent value per group, the smaller value on ties."""
    return f"""SELECT {keys}, {value} AS {name}, n AS {name}_plays FROM (
  SELECT {keys}, {value}, count(*) AS n,
    row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, {value}) AS rn
  FROM {source} WHERE {value} IS NOT NULL GROUP BY {keys}, {value}) WHERE rn = 1"""


def daily_sql(source: str) -> str:
    top = top_sql(source, "local_date", "primary_genre", "top_genre")
    return f"""WITH days AS ({DAILY.format(silver=source)}), best AS ({top})
SELECT days.*, top_genre FROM days LEFT JOIN best USING (local_date)"""


@query("a2_daily_summary", sql(daily_sql("silver"), "silver"))
def daily_summary(t):
    return gold.daily_summary(t.silver)


@query(
    "a2_daily_summary_min",
    sql(
        f"""WITH days AS ({DAILY.format(silver="silver_star")}),
  first_genre AS (SELECT local_date, min(primary_genre) AS top_genre FROM silver_star GROUP BY 1)
SELECT days.*, top_genre FROM days JOIN first_genre USING (local_date)""",
        "silver_star",
    ),
)
def daily_summary_min(t):
    return gold.daily_summary(t.silver_star, top="min", plays_unique=False)


@query(
    "a1_artist_summary",
    sql(
        f"""SELECT artist_id, artist_name, artist_uri, a.primary_genre,
  array_to_string(genres_list, '|') AS all_genres, a.genre_count, a.genre_count > 1
    AS is_multi_genre_artist,
  popularity AS artist_popularity, followers_total AS artist_followers, count(*) AS total_plays,
  count(DISTINCT track_id) AS unique_tracks_played,
  count(DISTINCT album_id) AS unique_albums_played,
  {half_up("sum(track_duration_minutes)", 2)} AS total_listening_minutes,
  {half_up("avg(track_popularity)", 1)} AS average_track_popularity,
  min(local_timestamp) AS first_listened, max(local_timestamp) AS last_listened,
  CAST(date_diff('day', min(local_timestamp), max(local_timestamp)) + 1 AS INTEGER)
    AS listening_streak_days,
  min(time_of_day_category) AS primary_time_of_day,
  min(left(dayname(local_timestamp), 3)) AS primary_day_of_week,
  {pct("is_weekend")} AS weekend_play_percentage, max(s.ingested_at) AS last_updated
FROM artists a LEFT JOIN silver s ON artist_id = primary_artist_id
GROUP BY artist_id, artist_name, artist_uri, a.primary_genre, genres_list, a.genre_count,
  popularity, followers_total""",
        "artists",
        "silver",
    ),
)
def artist_summary(t):
    return joined_text(gold.artist_summary(t.silver, t.artists), "all_genres")


GENRE_SQL = f"""
WITH g AS (SELECT primary_genre, count(*) AS total_plays,
  count(DISTINCT primary_artist_id) AS unique_artists, count(DISTINCT track_id) AS unique_tracks,
  {half_up("sum(track_duration_minutes)", 2)} AS total_listening_minutes,
  {half_up("avg(artist_popularity)", 1)} AS average_artist_popularity,
  {half_up("avg(artist_followers)", 0)} AS average_artist_followers,
  min(time_of_day_category) AS primary_time_of_day,
  min(left(dayname(local_timestamp), 3)) AS primary_day_of_week,
  {half_up("avg(local_hour)", 0)} AS average_listening_hour,
  min(local_timestamp) AS first_discovered, max(local_timestamp) AS last_played,
  count(DISTINCT local_date) AS days_active,
  {half_up("avg(track_duration_minutes)", 2)} AS average_track_duration_minutes,
  {half_up("avg(track_popularity)", 1)} AS average_track_popularity,
  {pct("track_explicit")} AS explicit_content_percentage, max(ingested_at) AS last_updated
  FROM silver WHERE primary_genre IS NOT NULL GROUP BY primary_genre),
best AS ({top_sql("silver", "primary_genre", "primary_artist_name", "top_artist")})
SELECT g.*, CAST(row_number() OVER (ORDER BY total_plays DESC, primary_genre) AS INTEGER)
    AS genre_rank,
  {half_up("100.0 * total_plays / sum(total_plays) OVER ()", 2)}
    AS percentage_of_total_listening, top_artist, top_artist_plays
FROM g JOIN best USING (primary_genre)"""


@query("a3_genre_analysis", sql(GENRE_SQL, "silver"))
def genre_analysis(t):
    return gold.genre_analysis(t.silver)


@query(
    "a3_genre_analysis_mode",
    sql(
        f"""WITH named AS (SELECT *, left(dayname(local_timestamp), 3) AS dn FROM silver
  WHERE primary_genre IS NOT NULL),
parts AS ({top_sql("named", "primary_genre", "time_of_day_category", "primary_time_of_day")}),
days AS ({top_sql("named", "primary_genre", "dn", "primary_day_of_week")})
SELECT primary_genre, primary_time_of_day, primary_day_of_week
FROM parts JOIN days USING (primary_genre)""",
        "silver",
    ),
)
def genre_analysis_mode(t):
    return gold.genre_analysis(t.silver, day_label="mode").select(
        "primary_genre", "primary_time_of_day", "primary_day_of_week"
    )


@query(
    "w2_top_artist_per_genre",
    sql(top_sql("silver_star", "primary_genre", "primary_artist_name", "top_artist")
        .replace("IS NOT NULL", "IS NOT NULL AND primary_genre IS NOT NULL"), "silver_star"),
)
def top_artist_per_genre(t):
    return gold.top_artist_per_genre(t.silver_star)


@query(
    "w2_top_track_per_genre",
    sql(top_sql("silver_star", "primary_genre", "track_name", "top_track")
        .replace("IS NOT NULL", "IS NOT NULL AND primary_genre IS NOT NULL"), "silver_star"),
)
def top_track_per_genre(t):
    return gold.top_track_per_genre(t.silver_star)


MONTHLY_SQL = f"""
WITH base AS (SELECT local_year, local_month, local_quarter, count(*) AS total_plays,
  {half_up("sum(track_duration_minutes) / 60", 2)} AS total_listening_hours,
  {half_up("count(*) / count(DISTINCT local_date)", 2)} AS daily_average_plays,
  count(DISTINCT primary_artist_id) AS unique_artists,
  count(DISTINCT primary_genre) AS unique_genres,
  {pct("is_weekend")} AS weekend_listening_percentage,
  min(time_of_day_category) AS primary_time_of_day,
  {half_up("avg(track_popularity)", 1)} AS average_track_popularity,
  max(ingested_at) AS last_updated FROM silver_star GROUP BY ALL),
prev AS (SELECT *, lag(total_plays) OVER (ORDER BY local_year, local_month) AS pp,
  lag(unique_artists) OVER (ORDER BY local_year, local_month) AS pa FROM base),
ta AS ({top_sql("silver_star", "local_year, local_month", "primary_artist_name", "top_artist")}),
tg AS ({top_sql("silver_star", "local_year, local_month", "primary_genre", "top_genre")}),
tt AS ({top_sql("silver_star", "local_year, local_month", "track_name", "top_track")})
SELECT local_year AS year, local_month AS month,
  left(monthname(make_date(local_year, local_month, 1)), 3) AS month_name,
  local_quarter AS quarter, total_plays, total_listening_hours, daily_average_plays,
  unique_artists, unique_genres,
  {half_up("unique_artists / total_plays * 100", 2)} AS artist_discovery_rate,
  {half_up("unique_genres / total_plays * 100", 2)} AS genre_diversity_score,
  weekend_listening_percentage, primary_time_of_day,
  {half_up("total_listening_hours * 60 / total_plays", 2)} AS average_session_length_minutes,
  average_track_popularity,
  CASE WHEN average_track_popularity > 70 THEN 'High Mainstream'
    WHEN average_track_popularity > 50 THEN 'Moderate Mainstream'
    ELSE 'Underground/Niche' END AS mainstream_tendency,
  {half_up("100.0 * (total_plays - pp) / pp", 2)} AS plays_growth_rate,
  {half_up("100.0 * (unique_artists - pa) / pa", 2)} AS artist_discovery_growth,
  top_artist, top_artist_plays, top_genre, top_genre_plays, top_track, top_track_plays,
  last_updated
FROM prev LEFT JOIN ta USING (local_year, local_month) LEFT JOIN tg USING (local_year, local_month)
LEFT JOIN tt USING (local_year, local_month)"""


@query("a4_monthly_insights", sql(MONTHLY_SQL, "silver_star"))
def monthly_insights(t):
    return gold.monthly_insights(t.silver_star)


@query(
    "a5_current_month",
    sql(
        f"""WITH months AS ({sql(MONTHLY_SQL, "silver_star")})
SELECT months.* FROM months CROSS JOIN last_day_star
WHERE year = year(as_of) AND month = month(as_of)""",
        "last_day_star",
    ),
)
def current_month(t):
    return gold.current_month(gold.monthly_insights(t.silver_star), t.as_of_star)


@query(
    "a6_recent_activity",
    sql(
        """SELECT unique_play, local_timestamp, track_name, primary_artist_name, primary_genre,
  album_name, time_of_day_category, listening_source FROM silver CROSS JOIN last_day
WHERE local_date >= as_of - 7 ORDER BY local_timestamp DESC, unique_play LIMIT 100""",
        "silver",
        "last_day",
    ),
)
def recent_activity(t):
    return gold.recent_activity(t.silver, t.as_of)


@query(
    "w9_monthly_discoveries",
    sql(
        """SELECT primary_artist_name, primary_genre, count(*) AS plays_this_month,
  min(local_timestamp) AS first_played, max(local_timestamp) AS last_played
FROM silver_star WHERE local_date >= DATE '1995-01-01' AND local_date < DATE '1995-02-01'
  AND primary_artist_id NOT IN (SELECT primary_artist_id FROM silver_star
    WHERE local_date < DATE '1995-01-01') GROUP BY ALL""",
        "silver_star",
    ),
)
def monthly_discoveries(t):
    until = t.silver_star.filter(F.col("local_date") < F.lit("1995-02-01").cast("date"))
    return gold.monthly_discoveries(until, F.lit("1995-01-31").cast("date"))


@query(
    "a7_genre_timeline",
    sql(
        f"""SELECT local_date, primary_genre, count(*) AS daily_plays,
  {half_up("100.0 * count(*) / sum(count(*)) OVER (PARTITION BY local_date)", 2)}
    AS daily_genre_percentage
FROM silver_star CROSS JOIN last_day_star
WHERE local_date >= as_of - INTERVAL 6 MONTH AND primary_genre IS NOT NULL
GROUP BY local_date, primary_genre""",
        "silver_star",
        "last_day_star",
    ),
)
def genre_timeline(t):
    return gold.genre_timeline(t.silver_star, t.as_of_star)


@query(
    "a8_raw_daily_summary",
    sql(
        f"""WITH best AS ({top_sql("plays", "played_at_date", "primary_artist_name", "top_artist")})
SELECT played_at_date, count(*) AS total_tracks, count(DISTINCT track_id) AS unique_tracks,
  count(DISTINCT primary_artist_name) AS unique_artists,
  count(DISTINCT album_id) AS unique_albums,
  {half_up("sum(track_duration_ms) / 1000 / 60", 6)} AS total_minutes_listened,
  {half_up("avg(track_duration_ms) / 1000", 6)} AS avg_track_length_seconds,
  any_value(top_artist) AS most_played_artist
FROM plays JOIN best USING (played_at_date) GROUP BY played_at_date""",
        "plays",
    ),
)
def raw_daily_summary(t):
    return rounded(gold.raw_daily_summary(t.plays_events))


@query(
    "a9_artist_stats",
    sql(
        f"""SELECT primary_artist_name, primary_artist_id, a.primary_genre,
  array_to_string(genres_list, '|') AS genres_list, a.genre_count,
  popularity AS artist_popularity, followers_total, count(*) AS total_plays,
  count(DISTINCT track_id) AS unique_tracks, count(DISTINCT album_id) AS unique_albums,
  {half_up("sum(track_duration_ms) / 1000 / 60", 6)} AS total_minutes,
  {half_up("avg(track_popularity)", 6)} AS avg_track_popularity,
  min(played_at) AS first_played, max(played_at) AS last_played
FROM plays_star LEFT JOIN artists a ON primary_artist_id = artist_id GROUP BY ALL""",
        "plays_star",
        "artists",
    ),
)
def artist_stats(t):
    return rounded(joined_text(gold.artist_stats(t.plays_star, t.artists), "genres_list"))


@query(
    "a10_genre_listening",
    sql(
        f"""SELECT primary_genre, count(DISTINCT primary_artist_id) AS unique_artists,
  count(*) AS total_plays, count(DISTINCT track_id) AS unique_tracks,
  {half_up("sum(track_duration_ms) / 1000 / 60", 6)} AS total_minutes,
  {half_up("avg(track_popularity)", 6)} AS avg_track_popularity,
  {half_up("avg(popularity)", 6)} AS avg_artist_popularity,
  {half_up("avg(followers_total)", 6)} AS avg_artist_followers
FROM plays_star JOIN artists ON primary_artist_id = artist_id
WHERE primary_genre IS NOT NULL GROUP BY primary_genre""",
        "plays_star",
        "artists",
    ),
)
def genre_listening(t):
    return rounded(gold.genre_listening(silver.with_artist(t.plays_star, t.artists, "inner")))


@query(
    "a11_hourly_patterns",
    sql(
        f"""SELECT played_at_hour, count(*) AS total_tracks,
  {half_up("avg(track_duration_ms) / 1000 / 60", 6)} AS avg_minutes_per_hour,
  count(DISTINCT played_at_date) AS days_active,
  {half_up("count(*) / count(DISTINCT played_at_date)", 2)} AS avg_tracks_per_day
FROM plays_star GROUP BY played_at_hour""",
        "plays_star",
    ),
)
def hourly_patterns(t):
    return rounded(gold.hourly_patterns(t.plays_star), "avg_minutes_per_hour")


@query(
    "a12_listening_context",
    sql(
        f"""SELECT context_type, count(*) AS total_plays,
  count(DISTINCT track_id) AS unique_tracks,
  {half_up("sum(track_duration_ms) / 1000 / 60", 6)} AS total_minutes,
  {half_up("100.0 * count(*) / sum(count(*)) OVER ()", 2)} AS percentage_of_listening
FROM plays WHERE context_type IS NOT NULL GROUP BY context_type""",
        "plays",
    ),
)
def listening_context(t):
    return rounded(gold.listening_context(t.plays_events), "total_minutes")


# -- windows over aggregates, top rows, dashboard ------------------------------


@query(
    "w1_latest_per_key",
    sql("SELECT unique_play, played_at, track_id, primary_artist_id FROM plays_star", "plays_star"),
)
def latest_per_key(t):
    return t.plays_star.select("unique_play", "played_at", "track_id", "primary_artist_id")


@query(
    "w6_counts_on_row",
    sql(
        """SELECT unique_play, count(*) OVER (PARTITION BY track_id) AS track_replay_count,
  count(*) OVER (PARTITION BY primary_genre) AS genre_popularity,
  count(*) OVER (PARTITION BY primary_artist_id) AS artist_play_count FROM silver""",
        "silver",
    ),
)
def counts_on_row(t):
    from spinledger.operators.quality import with_group_counts

    counts = {
        "track_replay_count": "track_id",
        "genre_popularity": "primary_genre",
        "artist_play_count": "primary_artist_id",
    }
    return with_group_counts(t.silver, counts).select("unique_play", *counts)


@query(
    "t1_top_plays",
    sql(
        """SELECT unique_play, local_timestamp, track_name FROM silver_star
ORDER BY local_timestamp DESC, unique_play LIMIT 10""",
        "silver_star",
    ),
)
def top_plays(t):
    order = [F.desc("local_timestamp"), F.col("unique_play")]
    return top_n(t.silver_star, order, 10).select("unique_play", "local_timestamp", "track_name")


@query(
    "u3_listened_track_ids",
    sql("SELECT DISTINCT track_id FROM plays_star WHERE track_id IS NOT NULL", "plays_star"),
)
def listened_track_ids(t):
    return t.plays_star.select("track_id").filter("track_id IS NOT NULL").distinct()


@query(
    "s13_date_range",
    sql(
        """SELECT local_date, local_timestamp, local_hour, time_of_day_category, is_weekend,
  track_name, primary_artist_name, primary_genre, album_name, track_duration_minutes,
  track_popularity, artist_popularity, listening_source FROM silver
WHERE local_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-14'""",
        "silver",
    ),
)
def date_range(t):
    return silver.date_range(t.silver, "2024-01-05", "2024-01-14")


@query(
    "a31_weekday_average",
    sql(
        f"""SELECT day_of_week, {half_up("avg(n)", 6)} AS average_plays FROM (
  SELECT left(dayname(local_date), 3) AS day_of_week, count(*) AS n FROM silver GROUP BY local_date)
GROUP BY day_of_week""".replace("GROUP BY local_date)", "GROUP BY local_date)"),
        "silver",
    ),
)
def weekday_average(t):
    return rounded(gold.weekday_average(gold.daily_summary(t.silver)))


@query(
    "a31_plays_by_day_part",
    sql(
        """SELECT time_of_day_category, listening_source, is_weekend, local_hour,
  count(*) AS plays FROM silver_star GROUP BY ALL""",
        "silver_star",
    ),
)
def plays_by_day_part(t):
    keys = ["time_of_day_category", "listening_source", "is_weekend", "local_hour"]
    return gold.plays_by(t.silver_star, *keys)


@query(
    "a31_filtered_genre_stats",
    sql(
        f"""SELECT primary_genre, count(track_name) AS total_plays,
  count(DISTINCT primary_artist_name) AS unique_artists,
  {half_up("sum(track_duration_minutes)", 2)} AS total_listening_minutes,
  {half_up("100.0 * count(track_name) / sum(count(track_name)) OVER ()", 2)}
    AS percentage_of_total_listening
FROM silver_star WHERE time_of_day_category IN ('Evening', 'Night') AND NOT is_weekend
  AND primary_genre IS NOT NULL GROUP BY primary_genre""",
        "silver_star",
    ),
)
def filtered_genre_stats(t):
    evenings = silver.sidebar_filter(
        t.silver_star, day_parts=["Evening", "Night"], weekend="weekdays"
    )
    return gold.filtered_genre_stats(evenings)


@query(
    "a28_utc_hour_offsets",
    sql(
        f"""SELECT unique_play, played_at AS utc_timestamp, {local("played_at")} AS local_timestamp,
  CAST(hour(played_at) AS INTEGER) AS utc_hour,
  CAST(hour({local("played_at")}) AS INTEGER) AS local_hour,
  CAST(hour({local("played_at")}) - hour(played_at) AS INTEGER) AS hour_offset
FROM plays ORDER BY played_at DESC, unique_play LIMIT 5""",
        "plays",
    ),
)
def utc_hour_offsets(t):
    return gold.utc_hour_offsets(t.plays_events)


@query(
    "w3_rank_over_aggregate",
    sql(
        """SELECT primary_artist_id, count(*) AS plays,
  CAST(row_number() OVER (ORDER BY count(*) DESC, primary_artist_id) AS INTEGER) AS artist_rank
FROM silver_star GROUP BY primary_artist_id QUALIFY artist_rank <= 100""",
        "silver_star",
    ),
)
def rank_over_aggregate(t):
    counted = gold.plays_by(t.silver_star, "primary_artist_id")
    return top_n(counted, [F.desc("plays"), F.col("primary_artist_id")], 100, "artist_rank")


@query(
    "w13_first_value_top_artist",
    sql(
        """SELECT DISTINCT local_date, first_value(primary_artist_name) OVER (
  PARTITION BY local_date ORDER BY n DESC, primary_artist_name) AS top_artist
FROM (SELECT local_date, primary_artist_name, count(*) AS n FROM silver_star GROUP BY ALL)""",
        "silver_star",
    ),
)
def first_value_top_artist(t):
    best = most_frequent(t.silver_star, ["local_date"], "primary_artist_name")
    return best.select("local_date", F.col("primary_artist_name").alias("top_artist"))
