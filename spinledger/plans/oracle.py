"""DuckDB building blocks of the oracle statements.

``sql(body, "silver", "artists")`` prefixes ``body`` with the named common table
expressions and whatever they need. ``half_up`` rounds like Spark does, on the decimal text
of a double.
"""

from __future__ import annotations

import re


def half_up(expr: str, digits: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(30,9)), {digits}) AS DOUBLE)"


def pct(condition: str, digits: int = 1) -> str:
    """Percentage of the group's rows that satisfy a condition."""
    return half_up(f"100.0 * count(*) FILTER (WHERE {condition}) / count(*)", digits)


def local(ts: str) -> str:
    return f"(({ts}) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Denver'"


TRACK = """
  p_name AS track_name, CAST(60000 + p_size * 9000 AS BIGINT) AS track_duration_ms,
  CAST(p_size * 2 AS INTEGER) AS track_popularity, p_brand AS album_id,
  'Album ' || p_brand AS album_name,
  CASE WHEN p_size < 10 THEN 'single' WHEN p_size > 45 THEN 'compilation' ELSE 'album' END
    AS album_type,
  CAST(1980 + p_size % 46 AS VARCHAR) || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE '-06-15' END
    AS album_release_date,
  p_size AS album_total_tracks"""

NEEDS_AND_SQL: dict[str, tuple[list[str], str]] = {
    "nart": ([], "SELECT least(40, count(*)) AS n, count(*) AS total FROM supplier"),
    "artists": (
        [],
        """
SELECT CAST(s_suppkey AS VARCHAR) AS artist_id, s_name AS artist_name,
  'artist:' || s_suppkey AS artist_uri,
  CASE WHEN s_suppkey % 10 = 9 THEN CAST([] AS VARCHAR[]) WHEN s_suppkey % 4 = 0
    THEN [n_name, r_name] ELSE [n_name] END AS genres_list,
  CASE WHEN s_suppkey % 10 <> 9 THEN n_name END AS primary_genre,
  CAST(CASE WHEN s_suppkey % 10 = 9 THEN 0 WHEN s_suppkey % 4 = 0 THEN 2 ELSE 1 END AS INTEGER)
    AS genre_count,
  CAST(s_suppkey * 37 % 101 AS INTEGER) AS popularity,
  CAST(round(greatest(s_acctbal, 0) * 1000) AS BIGINT) AS followers_total,
  TIMESTAMP '2023-10-01' + to_days(CAST(s_suppkey % 120 AS INTEGER)) AS ingested_at,
  CASE WHEN s_suppkey % 5 = 0 THEN 'artist_api_enhanced_popularity_analysis'
    ELSE 'artist_api' END AS data_source
FROM supplier JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
    ),
    "plays": (
        ["nart"],
        f"""
SELECT CAST(event_id AS VARCHAR) AS unique_play, user_id, ts AS played_at,
  CAST(k AS VARCHAR) AS track_id, p_size % 5 = 0 AS track_explicit,
  CAST(k % n AS VARCHAR) AS primary_artist_id, s_name AS primary_artist_name,
  CASE event_type WHEN 'view' THEN 'playlist' WHEN 'click' THEN 'album'
    WHEN 'purchase' THEN 'artist' WHEN 'signup' THEN 'collection' END AS context_type,
  CAST(ts AS DATE) AS played_at_date, CAST(hour(ts) AS INTEGER) AS played_at_hour,
  CAST(date_diff('second', TIMESTAMP '1970-01-01', date_trunc('second', ts)) AS BIGINT)
    AS played_at_timestamp,
  ts + INTERVAL 1 HOUR AS ingested_at, 'recently_played' AS data_source,{TRACK}
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
CROSS JOIN nart JOIN part ON p_partkey = k JOIN supplier ON s_suppkey = k % n""",
    ),
    "landed_star": (
        [],
        f"""
SELECT l_orderkey || '_' || l_linenumber AS unique_play, o_custkey AS user_id,
  l_shipdate + to_minutes(CAST((l_partkey * 37 + l_linenumber * 211) % 1440 AS INTEGER))
    AS played_at,
  CAST(l_partkey AS VARCHAR) AS track_id, l_returnflag = 'R' AS track_explicit,
  CAST(l_suppkey AS VARCHAR) AS primary_artist_id, s_name AS primary_artist_name,
  CASE left(o_orderpriority, 1) WHEN '1' THEN 'playlist' WHEN '2' THEN 'album'
    WHEN '3' THEN 'artist' WHEN '5' THEN 'collection' END AS context_type,
  CAST(played_at AS DATE) AS played_at_date, CAST(hour(played_at) AS INTEGER) AS played_at_hour,
  CAST(date_diff('second', TIMESTAMP '1970-01-01', played_at) AS BIGINT)
    AS played_at_timestamp,
  played_at + INTERVAL 1 HOUR AS ingested_at, 'recently_played' AS data_source,{TRACK}
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
JOIN orders ON l_orderkey = o_orderkey""",
    ),
    "plays_star": (
        ["landed_star"],
        """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY unique_play
  ORDER BY played_at DESC, track_id, primary_artist_id, track_explicit) AS rn
  FROM landed_star) WHERE rn = 1""",
    ),
    "catalog": (
        ["nart", "artists"],
        f"""
SELECT track_id, track_name, track_duration_ms, track_popularity, album_id, album_name,
  album_type, album_release_date, album_total_tracks, artist_id AS primary_artist_id,
  artist_name AS primary_artist_name, primary_genre
FROM (SELECT CAST(p_partkey AS VARCHAR) AS track_id,
    CAST(CASE WHEN p_partkey < 100 THEN p_partkey % n ELSE p_partkey % total END AS VARCHAR)
      AS artist, {TRACK} FROM part CROSS JOIN nart)
LEFT JOIN artists ON artist = artist_id""",
    ),
    "feed_base": (
        ["nart"],
        f"""
SELECT p_partkey AS key, p_size, CAST(p_partkey AS VARCHAR) AS track_id,
  'Artist ' || (p_partkey % total) AS primary_artist_name,
  CAST(p_partkey % total AS VARCHAR) AS primary_artist_id, n_name AS seed_genre,
  TIMESTAMP '2024-01-20' + to_hours(CAST(p_partkey % 240 AS INTEGER)) AS discovered_at,{TRACK}
FROM part CROSS JOIN nart JOIN nation ON n_nationkey = p_partkey % 25""",
    ),
    "feed": (
        ["feed_base"],
        """
SELECT track_id, track_name, primary_artist_name, primary_artist_id, album_name,
  album_release_date, track_popularity, track_duration_ms,
  CASE WHEN key % 2 = 1 THEN 'artist_based' ELSE 'genre_based' END AS discovery_strategy,
  CASE WHEN key % 2 = 1 THEN primary_artist_name END AS seed_artist,
  CASE WHEN key % 2 = 0 THEN seed_genre END AS seed_genre, (p_size % 10) / 10 AS preference_score,
  discovered_at, discovered_at + INTERVAL 1 HOUR AS ingested_at
FROM feed_base""",
    ),
    "ml_feed": (
        ["feed_base"],
        """
SELECT track_id, track_name, primary_artist_name, primary_artist_id, album_name,
  album_release_date, track_popularity, track_duration_ms, 'ml_hybrid' AS discovery_strategy,
  (p_size + copy * 3) % 50 / 50 AS ml_recommendation_score,
  'collaborative_filtering' AS ml_strategies_used,
  (p_size + copy * 3) % 50 / 50 * 0.5 AS ml_weighted_score, 'Seed ' || track_name AS seed_track,
  seed_genre, key % 11 / 10 AS genre_novelty_score, key % 9 / 10 AS artist_novelty_score,
  discovered_at + to_days(copy * 5) AS discovered_at,
  discovered_at + to_days(copy * 5) + INTERVAL 1 HOUR AS ingested_at
FROM feed_base CROSS JOIN (SELECT unnest([0, 1]) AS copy)""",
    ),
    "candidates": (
        ["feed"],
        """
SELECT track_id, track_name, primary_artist_id, primary_artist_name,
  CASE WHEN seed_genre IS NULL THEN 'artist_seed' ELSE 'genre_seed' END AS source,
  coalesce(seed_genre, seed_artist) AS seed_value,
  CASE WHEN track_popularity <> 50 THEN track_popularity END AS track_popularity,
  album_release_date, discovered_at AS fetched_at
FROM feed""",
    ),
    "name_corpus": (
        [],
        """
SELECT CAST(c_custkey AS VARCHAR) AS artist_id,
  word || CASE WHEN c_custkey % 12 >= 10 THEN '' ELSE ' ' || c_mktsegment END AS artist_name,
  CASE WHEN c_custkey % 3 = 0 THEN [lower(c_mktsegment)] ELSE CAST([] AS VARCHAR[]) END
    AS genres_list,
  CASE WHEN c_custkey % 3 = 0 THEN lower(c_mktsegment) END AS primary_genre,
  CASE WHEN c_custkey % 17 <> 0 THEN CAST(c_custkey * 37 % 101 AS INTEGER) END AS popularity,
  CAST(round(greatest(c_acctbal, 0) * 1000) AS BIGINT) AS followers_total
FROM (SELECT *, (['DJ Nova', 'Lil Drum', 'The Rock Band', 'Popsters', 'Indie Folk Country',
  'Blue Jazz', 'City Orchestra', 'Latin Soul', 'Trap House Mix', 'Quiet Person', 'Daft Punk',
  'SZA'])[c_custkey % 12 + 1] AS word FROM customer)""",
    ),
    "last_day": (["plays"], f"SELECT CAST({local('max(played_at)')} AS DATE) AS as_of FROM plays"),
    "last_day_star": (
        ["plays_star"],
        f"SELECT CAST({local('max(played_at)')} AS DATE) AS as_of FROM plays_star",
    ),
}


def silver_of(plays: str) -> str:
    return f"""
SELECT p.* EXCLUDE (played_at_date, played_at_hour),
  lt AS local_timestamp, CAST(lt AS DATE) AS local_date, CAST(hour(lt) AS INTEGER) AS local_hour,
  CAST(dayofweek(lt) AS INTEGER) AS local_day_of_week, CAST(month(lt) AS INTEGER) AS local_month,
  CAST(year(lt) AS INTEGER) AS local_year, CAST(quarter(lt) AS INTEGER) AS local_quarter,
  dayofweek(lt) IN (0, 6) AS is_weekend,
  CASE WHEN hour(lt) < 6 OR hour(lt) >= 22 THEN 'Night' WHEN hour(lt) < 12 THEN 'Morning'
    WHEN hour(lt) < 18 THEN 'Afternoon' ELSE 'Evening' END AS time_of_day_category,
  {half_up("track_duration_ms / 60000.0", 2)} AS track_duration_minutes,
  a.popularity AS artist_popularity, a.followers_total AS artist_followers, a.primary_genre,
  a.genres_list AS all_genres, a.genre_count, coalesce(a.genre_count > 1, false)
    AS is_multi_genre_artist,
  CAST(left(album_release_date, 4) AS INTEGER) AS album_release_year,
  CAST(year(lt) AS INTEGER) - CAST(left(album_release_date, 4) AS INTEGER) AS album_age_years,
  album_type = 'single' AS is_single, album_type = 'compilation' AS is_compilation,
  coalesce(context_type, 'unknown') AS listening_source
FROM (SELECT *, {local("played_at")} AS lt FROM {plays}) p
LEFT JOIN artists a ON primary_artist_id = artist_id"""


NEEDS_AND_SQL["silver"] = (["plays", "artists"], silver_of("plays"))
NEEDS_AND_SQL["silver_star"] = (["plays_star", "artists"], silver_of("plays_star"))


def define(name: str, body: str, *needs: str) -> None:
    """Add a named common table expression."""
    NEEDS_AND_SQL[name] = (list(needs), body)


def sql(body: str, *needs: str) -> str:
    """``body`` prefixed with the expressions it needs; it may start with its own ``WITH``."""
    order: list[str] = []

    def visit(name: str) -> None:
        for need in NEEDS_AND_SQL[name][0]:
            visit(need)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    parts = [f"{name} AS ({NEEDS_AND_SQL[name][1].strip()})" for name in order]
    body = body.strip()
    own = re.match(r"(?i)with\s", body)
    if own:
        return "WITH " + ",\n".join(parts) + ",\n" + body[own.end() :]
    return "WITH " + ",\n".join(parts) + "\n" + body
