"""Queries of the strategies, the hybrid list and the serving functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from spinledger.operators import features as fx
from spinledger.operators import hybrid, serving, similarity, strategies
from spinledger.plans.catalogue import joined_text, query, rounded
from spinledger.plans.features_queries import (
    artist_profile,
    genre_matrix,
    interactions,
    patterns,
    r6,
    track_features,
)
from spinledger.plans.gold_queries import LONG_LABEL, SHORT_LABEL
from spinledger.plans.oracle import define, half_up, sql

HOUR, WEEKEND = 14, False

# A list of whole genres is "liked" when above the average; this keeps both sides non-empty on
# any scale of the test tables.
define(
    "liked",
    """SELECT * FROM interactions WHERE weighted_preference > (
  SELECT avg(weighted_preference) FROM interactions)""",
    "interactions",
)


def liked_genres(t):
    rows = interactions(t)
    average = rows.agg(F.avg("weighted_preference")).scalar()
    return rows.filter(F.col("weighted_preference") > average)


TRACK = (
    "track_id, track_name, primary_artist_name, primary_genre, album_name, track_popularity"
)


def collaborative_sql(
    pref: float, near: float, support: int, per_genre: int, plays: int, tail: str = ""
) -> str:
    return f"""
SELECT {TRACK}, collaborative_score,
  collaborative_score * 0.6 + popularity_normalized * 0.25 + freshness_score * 0.15
    AS recommendation_score,
  'collaborative_filtering' AS recommendation_strategy,
  CAST(row_number() OVER (PARTITION BY primary_genre ORDER BY track_popularity DESC,
    freshness_score DESC, track_id) AS INTEGER) AS genre_track_rank
FROM features JOIN (SELECT to_genre, avg(similarity_score * weighted_preference)
    AS collaborative_score FROM matrix JOIN liked ON from_genre = primary_genre
  WHERE weighted_preference > {pref} AND similarity_score > {near}
    AND to_genre NOT IN (SELECT primary_genre FROM liked WHERE primary_genre IS NOT NULL
      AND weighted_preference > {pref})
  GROUP BY to_genre HAVING count(*) >= {support}) ON primary_genre = to_genre
WHERE user_play_count <= {plays} QUALIFY genre_track_rank <= {per_genre} {tail}"""


define("collaborative", collaborative_sql(1.0, 0.3, 2, 3, 0), "features", "matrix", "liked")
TOP50 = "ORDER BY round(recommendation_score, 9) DESC, track_id LIMIT 50"


def collaborative(t):
    return strategies.collaborative(liked_genres(t), genre_matrix(t), track_features(t))


def scored(columns: str, source: str, *extra: str) -> str:
    doubles = ["recommendation_score", *extra]
    changes = ", ".join(f"{r6(c)} AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({changes}) FROM (SELECT {columns} FROM {source})"


@query(
    "r2_collaborative",
    sql(scored("*", "collaborative", "collaborative_score"), "collaborative"),
)
def collaborative_query(t):
    return rounded(collaborative(t))


@query(
    "r2_collaborative_relaxed",
    sql(
        scored("*", f"({collaborative_sql(0.5, 0.1, 1, 5, 1, TOP50)})", "collaborative_score"),
        "features",
        "matrix",
        "liked",
    ),
)
def collaborative_relaxed(t):
    relaxed = strategies.RELAXED_COLLABORATIVE
    return rounded(
        strategies.collaborative(liked_genres(t), genre_matrix(t), track_features(t), **relaxed)
    )


# -- content ------------------------------------------------------------------------

define(
    "favourites",
    """SELECT * FROM features WHERE user_play_count >= 2
ORDER BY user_play_count DESC, freshness_score DESC, track_id LIMIT 10""",
    "features",
)


def content_sql(seeds: str, score: str, near: float, support: int, plays: int, tail: str = "") -> str:
    return f"""
SELECT {TRACK}, avg_similarity * 0.7 + max_similarity * 0.3 AS recommendation_score,
  'content_based_filtering' AS recommendation_strategy, avg_similarity, max_similarity,
  similarity_support
FROM (SELECT {TRACK}, avg(s) AS avg_similarity, max(s) AS max_similarity,
    count(*) AS similarity_support
  FROM (SELECT c.*, {score} AS s FROM features c JOIN {seeds} f ON c.track_id <> f.track_id
    WHERE c.user_play_count <= {plays})
  WHERE round(s, 9) > {near} GROUP BY ALL HAVING count(*) >= {support}) {tail}"""


def near(name: str, scale: str = "1") -> str:
    return f"(1 - abs(c.{name} - f.{name}) / {scale})"


SAME_GENRE = "CASE WHEN c.primary_genre = f.primary_genre THEN 1.0 ELSE {} END"
SAME_ERA = "CASE WHEN c.era_category = f.era_category THEN 1.0 ELSE 0.5 END"
CONTENT_SCORE = (
    f"CAST({SAME_GENRE.format('0.0')} AS DOUBLE) * 0.3 + {near('popularity_normalized')} * 0.25 + "
    f"{near('duration_normalized')} * 0.2 + {near('popularity_tier', '4')} * 0.15 + "
    f"CAST({SAME_ERA} AS DOUBLE) * 0.1"
)
RELAXED_SCORE = (
    f"CAST({SAME_GENRE.format('0.3')} AS DOUBLE) * 0.4 + {near('popularity_normalized')} * 0.3 + "
    f"{near('duration_normalized')} * 0.3"
)
define("content", content_sql("favourites", CONTENT_SCORE, 0.5, 2, 0), "features", "favourites")
CONTENT_EXTRA = ("avg_similarity", "max_similarity")


@query("r3_content_based", sql(scored("*", "content", *CONTENT_EXTRA), "content"))
def content_based(t):
    return rounded(strategies.content_based(track_features(t)))


@query(
    "r3_content_based_relaxed",
    sql(
        f"""WITH seeds AS (SELECT * FROM features WHERE user_play_count >= 1
  ORDER BY user_play_count DESC, popularity_normalized DESC, track_id LIMIT 20)
{scored("*", "(" + content_sql("seeds", RELAXED_SCORE, 0.3, 1, 1, TOP50) + ")", *CONTENT_EXTRA)}""",
        "features",
    ),
)
def content_based_relaxed(t):
    return rounded(strategies.relaxed_content_based(track_features(t)))


@query(
    "r11_similar_tracks",
    sql(
        f"""WITH s AS (SELECT c.track_id, c.track_name, c.primary_artist_name AS artist_name,
  c.primary_genre AS genre, CAST({SAME_GENRE.format('0.3')} AS DOUBLE) * 0.3
    + {near('popularity_normalized')} * 0.25 + {near('duration_normalized')} * 0.2
    + CAST({SAME_ERA} AS DOUBLE) * 0.15 + {near('popularity_tier', '4')} * 0.1 AS similarity_score,
  CASE WHEN c.primary_genre = f.primary_genre THEN 'Same genre'
    WHEN c.era_category = f.era_category THEN 'Same era'
    WHEN abs(c.popularity_normalized - f.popularity_normalized) < 0.2 THEN 'Similar popularity'
    ELSE 'Musical characteristics' END AS similarity_reason
  FROM features c JOIN features f ON c.track_id <> f.track_id
    AND c.primary_artist_id <> f.primary_artist_id
  WHERE f.track_id = (SELECT min(track_id) FROM features) AND c.user_play_count = 0)
SELECT * REPLACE ({r6('similarity_score')} AS similarity_score), CAST(row_number() OVER (
  ORDER BY round(similarity_score, 9) DESC, track_id) AS INTEGER) AS similarity_rank
FROM s WHERE round(similarity_score, 9) > 0.4 QUALIFY similarity_rank <= 10""",
        "features",
    ),
)
def similar_tracks(t):
    rows = track_features(t)
    seed = rows.agg(F.min("track_id")).scalar()
    return rounded(strategies.similar_tracks(rows, seed, 10))


# -- temporal -----------------------------------------------------------------------


def relevance_sql(near_hours: int, far_hours: int) -> str:
    kind = "is_weekend" if WEEKEND else "NOT is_weekend"
    apart = f"abs(local_hour - {HOUR})"
    return f"""CASE WHEN {apart} = 0 AND {kind} THEN 1.0 WHEN {apart} <= {near_hours} AND {kind}
  THEN 0.8 WHEN {kind} THEN 0.6 WHEN {apart} <= {far_hours} THEN 0.4 ELSE 0.2 END"""


def temporal_sql(
    near_hours: int, far_hours: int, weak: bool, per_genre: int, least: float, plays: int, tail: str = ""
) -> str:
    strong = "" if weak else "AND temporal_strength <> 'weak'"
    return f"""
SELECT {TRACK}, recommendation_score, 'temporal_patterns' AS recommendation_strategy,
  temporal_relevance, genre_temporal_rank
FROM (SELECT f.*, CAST({relevance_sql(near_hours, far_hours)} AS DOUBLE) AS temporal_relevance,
    temporal_relevance * 0.5 + hour_genre_probability * 0.3 + popularity_normalized * 0.2
      AS recommendation_score,
    CAST(row_number() OVER (PARTITION BY primary_genre ORDER BY round(recommendation_score, 9)
      DESC, track_id, local_hour, is_weekend) AS INTEGER) AS genre_temporal_rank
  FROM patterns p JOIN features f USING (primary_genre)
  WHERE user_play_count <= {plays} {strong})
WHERE genre_temporal_rank <= {per_genre} AND temporal_relevance >= {least} {tail}"""


TOP50_TEMPORAL = TOP50.replace("track_id", "track_id, genre_temporal_rank")
define("temporal", temporal_sql(1, 2, True, 2, 0.4, 0), "patterns", "features")
ALL_STRENGTHS = ("strong", "moderate", "weak")


@query("r4_temporal", sql(scored("*", "temporal"), "temporal"))
def temporal(t):
    # the test data is spread evenly over genres, so that nearly all patterns are weak
    return rounded(
        strategies.temporal(patterns(t), track_features(t), HOUR, WEEKEND, strengths=ALL_STRENGTHS)
    )


@query(
    "r4_temporal_relaxed",
    sql(
        scored("*", f"({temporal_sql(3, 4, True, 5, 0.2, 1, TOP50_TEMPORAL)})"),
        "patterns",
        "features",
    ),
)
def temporal_relaxed(t):
    relaxed = strategies.RELAXED_TEMPORAL
    return rounded(strategies.temporal(patterns(t), track_features(t), HOUR, WEEKEND, **relaxed))


@query(
    "r4_temporal_strict",
    sql(scored("*", f"({temporal_sql(1, 2, False, 2, 0.4, 0)})"), "patterns", "features"),
)
def temporal_strict(t):
    return rounded(strategies.temporal(patterns(t), track_features(t), HOUR, WEEKEND))


# -- discovery ----------------------------------------------------------------------

NOVELTY = """
  CASE WHEN primary_genre IN (SELECT primary_genre FROM {genres} WHERE primary_genre IS NOT NULL)
    THEN {known} ELSE {new} END"""
KNOWN_ARTIST = "primary_artist_id IN (SELECT primary_artist_id FROM recent)"


def gem(low: int, high: int, centre: int, scale: str) -> str:
    return f"""CASE WHEN track_popularity BETWEEN {low} AND {high}
  THEN ({high} - abs(track_popularity - {centre})) / {scale} ELSE 0.3 END"""


def number(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


define(
    "discovery",
    f"""
SELECT * FROM (SELECT {TRACK}, genre_novelty_score * 0.3 + artist_novelty_score * 0.3
    + hidden_gem_score * 0.25 + era_diversity_score * 0.15 AS recommendation_score,
  'discovery_exploration' AS recommendation_strategy, genre_novelty_score, artist_novelty_score,
  hidden_gem_score, era_diversity_score, CAST(row_number() OVER (
    ORDER BY round(recommendation_score, 9) DESC, track_id) AS INTEGER) AS discovery_rank
FROM (SELECT *, {number(NOVELTY.format(genres="liked", known="0.3", new="1.0"))}
    AS genre_novelty_score,
  {number(f"CASE WHEN {KNOWN_ARTIST} THEN 0.0 ELSE 1.0 END")} AS artist_novelty_score,
  {number(gem(30, 70, 50, "20"))} AS hidden_gem_score,
  {number('''CASE WHEN era_category IN ('current', 'recent') THEN 0.8
    WHEN era_category IN ('2010s', '2000s') THEN 1.0 ELSE 1.2 END''')} AS era_diversity_score
  FROM features WHERE user_play_count = 0 AND track_popularity > 10)
WHERE genre_novelty_score > 0.5 OR artist_novelty_score > 0.5) WHERE discovery_rank <= 20""",
    "features",
    "liked",
    "recent",
)


def discovery(t):
    known = strategies.known_genres(liked_genres(t), 0.5)
    artists = strategies.known_artists(t.silver_table, t.as_of)
    return strategies.discovery(track_features(t), known, artists)


@query(
    "r5_discovery",
    sql(scored("*", "discovery", "hidden_gem_score"), "discovery"),
)
def discovery_query(t):
    return rounded(discovery(t))


@query(
    "r5_discovery_relaxed",
    sql(
        f"""WITH s AS (SELECT {TRACK}, genre_novelty_score * 0.6 + hidden_gem_score * 0.4
    AS recommendation_score, 'discovery_exploration' AS recommendation_strategy,
  genre_novelty_score, hidden_gem_score, CAST(row_number() OVER (
    ORDER BY round(recommendation_score, 9) DESC, track_id) AS INTEGER) AS discovery_rank
FROM (SELECT *, {number(NOVELTY.format(genres="liked", known="0.2", new="0.8"))}
    AS genre_novelty_score, {number(gem(20, 70, 45, "50"))} AS hidden_gem_score FROM features
  WHERE user_play_count = 0 AND track_popularity > 5 AND track_popularity < 90))
SELECT * REPLACE ({r6("recommendation_score")} AS recommendation_score,
  {r6("hidden_gem_score")} AS hidden_gem_score) FROM s WHERE discovery_rank <= 50""",
        "features",
        "liked",
    ),
)
def discovery_relaxed(t):
    return rounded(strategies.relaxed_discovery(track_features(t), liked_genres(t)))


# -- ranker and variants --------------------------------------------------------------


@query(
    "r1_rank_candidates",
    sql(
        f"""WITH g AS (SELECT primary_genre, count(*) AS n FROM silver GROUP BY 1),
a AS (SELECT primary_artist_id, count(*) AS n FROM silver GROUP BY 1),
c AS (SELECT candidates.*, coalesce(g.n, 0) AS gn, coalesce(a.n, 0) AS an,
    coalesce(track_popularity, 0) AS pop
  FROM candidates LEFT JOIN g ON lower(seed_value) = lower(primary_genre)
  LEFT JOIN a ON a.primary_artist_id = candidates.primary_artist_id
  WHERE track_id NOT IN (SELECT track_id FROM plays)),
r AS (SELECT *, (rank() OVER (ORDER BY gn) + (count(*) OVER (PARTITION BY gn) - 1) / 2)
    / count(*) OVER () AS gr,
  (rank() OVER (ORDER BY an) + (count(*) OVER (PARTITION BY an) - 1) / 2)
    / count(*) OVER () AS ar FROM c),
s AS (SELECT *, gr * 0.5 + ar * 0.3 + pop / 100 * 0.2 AS raw FROM r)
SELECT track_id, track_name, primary_artist_id AS artist_id, primary_artist_name AS artist_name,
  source, 'Seed ' || seed_value || ' | score ' || printf('%.2f', raw) AS reason,
  {r6("raw")} AS score, CAST(row_number() OVER (ORDER BY round(raw, 9) DESC, track_id) AS INTEGER)
    AS position
FROM s QUALIFY position <= 30""",
        "candidates",
        "silver",
    ),
)
def rank_candidates(t):
    ranked = strategies.rank_candidates(
        t.candidates,
        t.plays_events,
        fx.genre_preferences(t.silver),
        fx.artist_preferences(t.silver),
    )
    return rounded(ranked)


define(
    "affinity",
    f"""
SELECT {TRACK}, greatest(weighted_preference * 0.6 + coalesce(j, 0.1) * 0.4, 0.1)
    AS recommendation_score, 'collaborative_filtering' AS recommendation_strategy,
  weighted_preference AS affinity_score, coalesce(j, 0) AS genre_similarity
FROM features JOIN interactions USING (primary_genre)
LEFT JOIN (SELECT from_genre, max(jaccard_similarity) AS j FROM matrix GROUP BY 1)
  ON from_genre = primary_genre
WHERE user_play_count <= 1 AND weighted_preference > 0.1 AND track_popularity >= 10""",
    "features",
    "interactions",
    "matrix",
)


def affinity(t):
    return strategies.affinity_collaborative(interactions(t), genre_matrix(t), track_features(t))


@query(
    "r8_affinity_collaborative",
    sql(scored("*", "affinity", "affinity_score", "genre_similarity"), "affinity"),
)
def affinity_query(t):
    return rounded(affinity(t))


define(
    "profile_content",
    f"""
WITH p AS (SELECT avg(track_popularity) AS ap, avg(track_duration_ms) AS ad,
  (SELECT era_category FROM features WHERE user_play_count >= 2 GROUP BY 1
    ORDER BY count(*) DESC, 1 LIMIT 1) AS era,
  (SELECT popularity_tier FROM features WHERE user_play_count >= 2 GROUP BY 1
    ORDER BY count(*) DESC, 1 LIMIT 1) AS tier FROM features WHERE user_play_count >= 2)
SELECT {TRACK}, greatest(2 - abs(track_popularity - ap) / 100 * 0.3
    - abs(track_duration_ms - ad) / 300000 * 0.2
    + CASE WHEN era_category = era THEN 0.3 ELSE 0.1 END
    + CASE WHEN popularity_tier = tier THEN 0.2 ELSE 0.1 END, 0.1) AS recommendation_score,
  'content_based_filtering' AS recommendation_strategy,
  abs(track_popularity - ap) AS popularity_distance
FROM features CROSS JOIN p WHERE user_play_count <= 1 AND track_popularity >= 10""",
    "features",
)


@query(
    "r8_profile_content",
    sql(scored("*", "profile_content", "popularity_distance"), "profile_content"),
)
def profile_content(t):
    return rounded(strategies.profile_content(track_features(t)))


# -- hybrid ---------------------------------------------------------------------------


def arms_sql(arms: list[tuple[str, float, float]]) -> str:
    out = [
        f"SELECT {TRACK}, recommendation_score AS s, recommendation_score * {weight} AS w, "
        f"recommendation_strategy AS name, {i} AS priority FROM {source} "
        f"WHERE round(recommendation_score, 9) > {least}"
        for i, (source, weight, least) in enumerate(arms, 1)
    ]
    return "\nUNION ALL\n".join(out)


define(
    "union_all",
    arms_sql([
        ("collaborative", 0.4, 0.3), ("content", 0.3, 0.4), ("temporal", 0.2, 0.3),
        ("discovery", 0.1, 0.5),
    ]),
    "collaborative",
    "content",
    "temporal",
    "discovery",
)
define(
    "playlist",
    f"""
SELECT * FROM (SELECT {TRACK}, sum(w) + (count(*) - 1) * 0.1 AS final_recommendation_score,
  string_agg(DISTINCT name, ',' ORDER BY name) AS recommendation_strategies,
  count(*) AS recommendation_support, CAST(row_number() OVER (ORDER BY
    round(sum(w) + (count(*) - 1) * 0.1, 9) DESC, count(*) DESC, track_popularity DESC, track_id)
    AS INTEGER) AS playlist_position
FROM union_all GROUP BY {TRACK}) WHERE playlist_position <= 30""",
    "union_all",
)
REASON = """CASE WHEN recommendation_strategies LIKE '%collaborative%content%'
    THEN 'Multiple algorithms agree this matches your taste'
  WHEN recommendation_strategies LIKE '%collaborative%'
    THEN 'People with similar taste also enjoy this'
  WHEN recommendation_strategies LIKE '%content%' THEN 'Similar to tracks you already love'
  WHEN recommendation_strategies LIKE '%temporal%' THEN 'Perfect for this time of day'
  ELSE 'Discover something new you might love' END"""
FINAL = r6("final_recommendation_score")


def four(t):
    rows = track_features(t)
    likes, hours = liked_genres(t), patterns(t)
    return {
        strategies.COLLABORATIVE: strategies.collaborative(likes, genre_matrix(t), rows),
        strategies.CONTENT: strategies.content_based(rows),
        strategies.TEMPORAL: strategies.temporal(
            hours, rows, HOUR, WEEKEND, strengths=ALL_STRENGTHS
        ),
        strategies.DISCOVERY: strategies.discovery(
            rows,
            strategies.known_genres(likes, 0.5),
            strategies.known_artists(t.silver_table, t.as_of),
        ),
    }


@query(
    "r6_hybrid",
    sql(
        f"""SELECT * REPLACE ({FINAL} AS final_recommendation_score),
  {REASON} AS recommendation_reason, {FINAL} AS confidence_score,
  'track/' || track_id AS track_url, recommendation_strategies AS strategies_used,
  recommendation_support AS support_level, {SHORT_LABEL} AS popularity_tier FROM playlist""",
        "playlist",
    ),
)
def hybrid_query(t):
    playlist = hybrid.hybrid(four(t))
    return rounded(playlist.select("*", "recommendation_metadata.*").drop("recommendation_metadata"))


def blend_sql(bonus: float, names: str, least: float) -> str:
    carried = ", ".join(f"max({c.strip()}) AS {c.strip()}" for c in TRACK.split(",")[1:])
    return f"""SELECT * FROM (SELECT track_id, {carried},
  sum(w) + (count(*) - 1) * {bonus} AS final_recommendation_score, count(*)
    AS recommendation_support, {names} AS recommendation_strategies
FROM union_all GROUP BY track_id) WHERE round(final_recommendation_score, 9) > {least}"""


COUNTED = """CASE count(*) WHEN 1 THEN max(name) WHEN 2 THEN 'hybrid_dual_strategy'
  WHEN 3 THEN 'hybrid_triple_strategy' ELSE 'hybrid_quad_strategy' END"""
SINGLE = """CASE recommendation_strategies
  WHEN 'collaborative_filtering' THEN 'Users with similar taste love this track'
  WHEN 'content_based_filtering' THEN 'Similar musical characteristics to your favorites'
  WHEN 'temporal_patterns' THEN 'Perfect timing based on your listening patterns'
  ELSE 'Algorithmic discovery - expanding your musical horizons' END"""
define("confident_rows", blend_sql(0.15, COUNTED, 0.25), "union_all")
define(
    "confident",
    f"""
SELECT *, CASE WHEN recommendation_support >= 3 THEN 'High Confidence'
  WHEN recommendation_support = 2 THEN 'Medium Confidence' ELSE 'Single Algorithm' END
    AS ml_confidence,
  CASE WHEN recommendation_support >= 3 THEN 'Multiple ML algorithms strongly recommend this track'
    WHEN recommendation_support = 2 THEN 'Two ML algorithms agree this matches your taste'
    ELSE {SINGLE} END AS recommendation_reason, {LONG_LABEL} AS popularity_tier
FROM confident_rows""",
    "confident_rows",
)


@query(
    "r7_hybrid_confident",
    sql(f"SELECT * REPLACE ({FINAL} AS final_recommendation_score) FROM confident", "confident"),
)
def hybrid_confident(t):
    return rounded(hybrid.hybrid_confident(four(t)))


@query(
    "r7_hybrid_two",
    sql(
        f"""WITH union_all AS ({arms_sql([("affinity", 0.6, 0.2), ("profile_content", 0.4, 0.3)])}),
b AS ({blend_sql(0.0, "CASE count(*) WHEN 1 THEN max(name) ELSE 'hybrid_multi_strategy' END", 0.25)})
SELECT * REPLACE ({FINAL} AS final_recommendation_score),
  CASE WHEN recommendation_support > 1 THEN 'High Confidence'
    WHEN final_recommendation_score > 0.6 THEN 'Medium Confidence' ELSE 'Single Algorithm' END
    AS ml_confidence,
  CASE WHEN recommendation_support > 1 THEN 'Multiple algorithms agree this matches your taste'
    WHEN recommendation_strategies = 'collaborative_filtering'
    THEN 'Users with similar taste love this track'
    ELSE 'Similar to tracks you already love' END AS recommendation_reason,
  {LONG_LABEL} AS popularity_tier FROM b""",
        "affinity",
        "profile_content",
    ),
)
def hybrid_two(t):
    two = hybrid.hybrid_two(affinity(t), strategies.profile_content(track_features(t)))
    return rounded(two)


@query(
    "r7_hybrid_single",
    sql(
        f"""SELECT {TRACK}, {r6("recommendation_score * 0.4")} AS final_recommendation_score,
  'collaborative_filtering' AS recommendation_strategies, CAST(1 AS BIGINT)
    AS recommendation_support, CAST(row_number() OVER (ORDER BY
    round(recommendation_score * 0.4, 9) DESC, track_id) AS INTEGER) AS playlist_position,
  'Based on similar listening patterns' AS recommendation_reason, {SHORT_LABEL} AS popularity_tier
FROM collaborative WHERE round(recommendation_score, 9) > 0.3 QUALIFY playlist_position <= 30""",
        "collaborative",
    ),
)
def hybrid_single(t):
    return rounded(hybrid.hybrid_single(collaborative(t)))


@query(
    "r7_hybrid_safe",
    sql(
        f"""WITH u AS ({arms_sql([("collaborative", 0.7, 0.3), ("content", 0.5, 0.4)])})
SELECT {TRACK}, {r6("w")} AS final_recommendation_score, name AS recommendation_strategies,
  'Single Algorithm' AS ml_confidence, CASE WHEN name LIKE 'coll%'
    THEN 'Users with similar taste love this track'
    ELSE 'Similar musical characteristics to your favorites' END AS recommendation_reason,
  {LONG_LABEL} AS popularity_tier FROM u""",
        "collaborative",
        "content",
    ),
)
def hybrid_safe(t):
    safe = hybrid.hybrid_safe(collaborative(t), strategies.content_based(track_features(t)))
    return rounded(safe)


@query("u1_strategy_union", sql(
    f"""SELECT track_id, {r6("s")} AS recommendation_score, name AS recommendation_strategy,
  {r6("w")} AS weighted_score, CAST(priority AS INTEGER) AS strategy_priority FROM union_all""",
    "union_all",
))
def strategy_union(t):
    return rounded(hybrid.weighted_union(four(t))).select(
        "track_id",
        "recommendation_score",
        "recommendation_strategy",
        "weighted_score",
        "strategy_priority",
    )


@query(
    "r26_merge_by_best",
    sql(
        f"""SELECT track_id, {r6("max(s)")} AS final_score,
  string_agg(name, ',' ORDER BY name) AS strategies, CAST(row_number() OVER (
    ORDER BY round(max(s), 9) DESC, track_id) AS INTEGER) AS final_rank
FROM union_all GROUP BY track_id QUALIFY final_rank <= 25""",
        "union_all",
    ),
)
def merge_by_best(t):
    return rounded(hybrid.merge_by_best(hybrid.weighted_union(four(t)), 25))


# -- serving functions ------------------------------------------------------------------

SHORT = "track_id, track_name, primary_artist_name AS artist_name, primary_genre AS genre"


@query(
    "r9_get_recommendations",
    sql(
        f"""WITH s AS (SELECT * EXCLUDE (playlist_position), final_recommendation_score * CASE
  WHEN recommendation_strategies LIKE '%temporal%' THEN 1.2 ELSE 1 END AS c FROM playlist
  WHERE round(final_recommendation_score, 9) >= 0.05)
SELECT {SHORT}, album_name, track_popularity, {r6("c")} AS recommendation_score,
  recommendation_strategies, CAST(row_number() OVER (ORDER BY round(c, 9) DESC, track_id)
    AS INTEGER) AS playlist_position, 'track/' || track_id AS track_url,
  {REASON} AS recommendation_reason FROM s QUALIFY playlist_position <= 20""",
        "playlist",
    ),
)
def get_recommendations(t):
    playlist = hybrid.hybrid(four(t))
    return rounded(serving.get_recommendations(playlist, 20, HOUR, min_score=0.05))


@query(
    "r10_by_strategy",
    sql(
        f"""SELECT {SHORT}, {r6("recommendation_score")} AS recommendation_score,
  CAST(row_number() OVER (ORDER BY round(recommendation_score, 9) DESC, track_id) AS INTEGER)
    AS strategy_rank
FROM content QUALIFY strategy_rank <= 20""",
        "content",
    ),
)
def by_strategy(t):
    arms = {"content_based": strategies.content_based(track_features(t))}
    return rounded(serving.by_strategy(arms, "content_based", 20))


def genre_recs_sql(condition: str, top: int, n: int) -> str:
    return f"""WITH f AS (SELECT primary_genre, weighted_preference AS w FROM interactions
  WHERE {condition} ORDER BY w DESC, primary_genre LIMIT {top}),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY primary_genre ORDER BY track_popularity DESC,
    freshness_score DESC, track_id) AS INTEGER) AS track_rank_in_genre
  FROM features JOIN f USING (primary_genre) WHERE user_play_count = 0
    AND track_popularity BETWEEN 20 AND 90)
SELECT {SHORT}, track_popularity, {r6("w")} AS genre_relevance_score, track_rank_in_genre
FROM r WHERE track_rank_in_genre <= {n} / (SELECT count(*) FROM f)
ORDER BY w DESC, genre, track_rank_in_genre LIMIT {n}"""


@query(
    "r12_genre_recommendations",
    sql(genre_recs_sql("true", 5, 15), "features", "interactions"),
)
def genre_recommendations(t):
    rows = serving.genre_recommendations(track_features(t), interactions(t), band=[20, 90])
    return rounded(rows)


@query(
    "r12_one_genre",
    sql(genre_recs_sql("primary_genre = 'NATION_7'", 1, 15), "features", "interactions"),
)
def one_genre(t):
    rows = serving.genre_recommendations(
        track_features(t), interactions(t), "NATION_7", band=[20, 90]
    )
    return rounded(rows)


@query(
    "r13_time_based",
    sql(
        f"""WITH h AS (SELECT primary_genre, local_hour, is_weekend,
  temporal_recommendation_score * {relevance_sql(2, 2)} AS ts, {relevance_sql(2, 2)} AS rel,
  CASE WHEN local_hour = {HOUR} THEN 'Perfect match' WHEN abs(local_hour - {HOUR}) <= 1
    THEN 'Close match' WHEN abs(local_hour - {HOUR}) <= 2 THEN 'Similar time'
    ELSE 'General preference' END AS hour_relevance
  FROM patterns WHERE temporal_strength <> 'weak')
SELECT {SHORT}, {r6("ts")} AS temporal_score, hour_relevance, CAST(row_number() OVER (
  ORDER BY round(ts, 9) DESC, track_popularity DESC, track_id, local_hour, is_weekend) AS INTEGER)
    AS recommendation_rank
FROM features JOIN h USING (primary_genre) WHERE user_play_count = 0 AND rel >= 0.4
QUALIFY recommendation_rank <= 20""",
        "features",
        "patterns",
    ),
)
def time_based(t):
    rows = serving.time_based_recommendations(track_features(t), patterns(t), HOUR, WEEKEND)
    return rounded(rows)


MOOD_GENRES = ["indie rock", "ambient", "hip hop", "dance", "classical", "electronic pop"]
MOOD_SQL = {
    "energetic": "CASE WHEN g IN ('indie rock', 'dance', 'electronic pop') THEN 0.9 "
    "WHEN g = 'hip hop' THEN 0.8 ELSE 0.3 END",
    "relaxed": "CASE WHEN g IN ('ambient', 'classical') THEN 0.9 WHEN g = 'indie rock' THEN 0.7 "
    "ELSE 0.4 END",
    "focused": "CASE WHEN g IN ('ambient', 'classical') THEN 0.9 WHEN g = 'electronic pop' "
    "THEN 0.7 ELSE 0.3 END",
    "nostalgic": "CASE WHEN g = 'classical' THEN 0.9 WHEN g IN ('indie rock', 'electronic pop') "
    "THEN 0.6 ELSE 0.4 END",
}


def with_mood_genre(rows):
    """Genre words in place of the nation names of the test data."""
    names = F.array(*[F.lit(g) for g in MOOD_GENRES])
    place = F.substring_index("primary_genre", "_", -1).cast("int") % len(MOOD_GENRES) + 1
    return rows.withColumn("mood_genre", F.element_at(names, place))


def register_mood(mood: str):
    statement = sql(
        f"""WITH n AS (SELECT *, ({MOOD_GENRES!r})[CAST(split_part(primary_genre, '_', 2) AS INTEGER)
  % {len(MOOD_GENRES)} + 1] AS g FROM features WHERE user_play_count = 0),
s AS (SELECT *, {number(MOOD_SQL[mood])} * 0.7 + popularity_normalized * 0.3 AS m FROM n
  WHERE {MOOD_SQL[mood]} > 0.5)
SELECT {SHORT}, {r6("m")} AS mood_relevance_score, '{serving.MOODS[mood][2]}' AS mood_reason
FROM s ORDER BY round(m, 9) DESC, track_id LIMIT 15""",
        "features",
    )

    @query(f"r14_mood_{mood}", statement)
    def mood_query(t):
        rows = with_mood_genre(track_features(t))
        return rounded(serving.mood_recommendations(rows, mood, genre="mood_genre"))


for _mood in MOOD_SQL:
    register_mood(_mood)


def register_discovery(kind: str):
    weights = serving.DISCOVERY_WEIGHTS[kind]
    score = " + ".join(f"{p} * {w}" for p, w in zip(("gn", "an", "hg", "en"), weights) if w)
    statement = sql(
        f"""WITH n AS (SELECT *, {number(NOVELTY.format(genres="liked", known="0.3", new="1.0"))} AS gn,
  {number(f"CASE WHEN {KNOWN_ARTIST} THEN 0.0 ELSE 1.0 END")} AS an,
  {number(gem(20, 70, 45, "70"))} AS hg,
  {number('''CASE WHEN era_category IN ('2000s', '90s', 'classic') THEN 1.2
    WHEN era_category = '2010s' THEN 1.0 ELSE 0.8 END''')} AS en
  FROM features WHERE user_play_count = 0 AND track_popularity BETWEEN 15 AND 70),
s AS (SELECT *, {score} AS d FROM n)
SELECT {SHORT}, {r6("d")} AS discovery_score,
  CASE WHEN gn = 1 AND an = 1 THEN 'Completely new artist and genre'
    WHEN an = 1 THEN 'New artist in familiar genre' ELSE 'New genre exploration' END
    AS discovery_reason,
  CASE WHEN gn + an >= 1.5 THEN 'High' WHEN gn + an >= 0.8 THEN 'Medium' ELSE 'Low' END
    AS novelty_level
FROM s WHERE round(d, 9) > 0.4 AND (gn > 0.5 OR an > 0.5)
ORDER BY round(d, 9) DESC, track_id LIMIT 20""",
        "features",
        "liked",
        "recent",
    )

    @query(f"r15_discovery_{kind}", statement)
    def discovery_kind(t):
        known = strategies.known_genres(liked_genres(t))
        artists = strategies.known_artists(t.silver_table, t.as_of)
        return rounded(
            serving.discovery_recommendations(track_features(t), known, artists, kind)
        )


for _kind in serving.DISCOVERY_WEIGHTS:
    register_discovery(_kind)


@query(
    "r16_explore_from_preferences",
    sql(
        f"""WITH seeds AS (SELECT primary_genre FROM interactions WHERE primary_genre IS NOT NULL
  ORDER BY weighted_preference DESC, primary_genre LIMIT 5),
x AS (SELECT f.*, similarity_score AS s, 'Genre similarity to ' || from_genre AS connection_path,
    'genre_expansion' AS exploration_type
  FROM features f JOIN matrix ON primary_genre = to_genre
  WHERE user_play_count = 0 AND round(similarity_score, 9) >= 0.3
    AND from_genre IN (FROM seeds) AND to_genre NOT IN (FROM seeds))
SELECT {SHORT}, {r6("s")} AS exploration_score, connection_path, exploration_type FROM x
ORDER BY round(s, 9) DESC, track_id, connection_path LIMIT 25""",
        "features",
        "interactions",
        "matrix",
    ),
)
def explore(t):
    rows = serving.explore_from_preferences(
        track_features(t), interactions(t), genre_matrix(t), radius=0.3
    )
    return rounded(rows)


@query(
    "r16_explore_from_artists",
    sql(
        f"""WITH x AS (SELECT f.*, b.primary_artist_name AS second,
  'Artist similarity to ' || a.primary_artist_name AS connection_path,
  0.7 / (a.genre_count + b.genre_count - 1)
    + 0.3 * (1 - abs(a.avg_popularity - b.avg_popularity) / 100) AS s
FROM artist_profile a JOIN artist_profile b ON a.primary_genre = b.primary_genre
  AND a.primary_artist_id < b.primary_artist_id
JOIN features f ON f.primary_artist_name = b.primary_artist_name
WHERE a.primary_artist_name IN ('Supplier#000000001', 'Supplier#000000002', 'Supplier#000000003')
  AND user_play_count = 0)
SELECT {SHORT}, {r6("s")} AS exploration_score, connection_path,
  'artist_expansion' AS exploration_type FROM x WHERE round(s, 9) >= 0.7
ORDER BY round(s, 9) DESC, track_id, connection_path LIMIT 25""",
        "features",
        "artist_profile",
    ),
)
def explore_from_artists(t):
    names = ["Supplier#000000001", "Supplier#000000002", "Supplier#000000003"]
    pairs = similarity.similar_to_artists(artist_profile(t), names)
    rows = serving.explore_from_preferences(
        track_features(t), interactions(t), genre_matrix(t), pairs, genres=["none of these"]
    )
    return rounded(rows)


@query(
    "r17_validate_quality",
    sql(
        f"""WITH q AS (SELECT catalog.track_id,
  CASE WHEN user_play_count > 0 THEN 0.0 WHEN f.track_popularity < 10 THEN 0.2
    WHEN f.track_popularity > 95 THEN 0.6 ELSE 1.0 END AS n,
  CASE WHEN f.primary_genre IN (SELECT primary_genre FROM liked WHERE weighted_preference > 1
      AND primary_genre IS NOT NULL) THEN 0.8
    WHEN f.primary_genre IN (SELECT to_genre FROM matrix WHERE similarity_score > 0.5) THEN 0.6
    ELSE 0.3 END AS r,
  CASE WHEN f.track_popularity BETWEEN 30 AND 80 THEN 1.0
    WHEN f.track_popularity BETWEEN 20 AND 90 THEN 0.8 ELSE 0.5 END AS p
  FROM catalog LEFT JOIN features f USING (track_id))
SELECT track_id, {r6("n * 0.4 + r * 0.4 + p * 0.2")} AS quality_score,
  concat_ws('|', CASE WHEN n = 0 THEN 'Already played' END, CASE WHEN n = 0.2 THEN 'Very obscure' END,
    CASE WHEN n = 0.6 THEN 'Very mainstream' END,
    CASE WHEN r >= 0.8 THEN 'Highly relevant to taste' END,
    CASE WHEN r >= 0.6 THEN 'Somewhat relevant to taste' END,
    CASE WHEN r = 0.3 THEN 'New genre exploration' END) AS quality_reasons,
  n * 0.4 + r * 0.4 + p * 0.2 >= 0.5 AS passes_threshold FROM q""",
        "catalog",
        "features",
        "liked",
        "matrix",
    ),
)
def validate_quality(t):
    checked = serving.validate_quality(
        t.catalog.select("track_id"), track_features(t), liked_genres(t), genre_matrix(t)
    )
    return rounded(joined_text(checked, "quality_reasons"))


@query(
    "r18_trending",
    sql(
        f"""SELECT {SHORT}, track_popularity, 'track/' || track_id AS track_url FROM features
WHERE track_popularity BETWEEN 60 AND 85 AND user_play_count = 0 AND primary_genre IN (
  SELECT primary_genre FROM interactions WHERE primary_genre IS NOT NULL
  ORDER BY weighted_preference DESC, primary_genre LIMIT 3)
ORDER BY track_popularity DESC, track_id LIMIT 5""",
        "features",
        "interactions",
    ),
)
def trending(t):
    return serving.trending(track_features(t), interactions(t))


# Plays of the star tables are few per track, so that rarely played tracks exist.
define(
    "star_library",
    """SELECT track_id, any_value(track_name) AS track_name,
  any_value(primary_genre) AS primary_genre, max(track_popularity) AS track_popularity,
  count(*) AS n, CAST(any_value(as_of) - max(local_date) AS INTEGER) AS days
FROM recent_star CROSS JOIN last_day_star GROUP BY track_id""",
    "recent_star",
)


def star_features(t):
    base = t.written("star_base", lambda: fx.track_base(t.silver_star, t.as_of_star))
    return fx.track_features(base, t.catalog, t.as_of_star, per_genre=None)


@query(
    "r19_rediscovery",
    sql(
        f"""WITH i AS (SELECT primary_genre, count(*) * exp(-avg(as_of - local_date) / 30) AS w
  FROM silver_star CROSS JOIN last_day_star WHERE local_date >= as_of - 180
  GROUP BY primary_genre HAVING count(*) >= 3),
p AS (SELECT track_id, count(*) AS n, max(local_date) AS d FROM recent_star GROUP BY track_id),
s AS (SELECT {TRACK.replace("track_id", "c.track_id")}, coalesce(w, 0.1) / n * CASE
    WHEN as_of - d > 30 THEN 1.5 ELSE 1 END * (track_popularity / 100) AS x,
  n AS user_play_count, CAST(as_of - d AS INTEGER) AS days_since_last_played
  FROM catalog c JOIN p USING (track_id) CROSS JOIN last_day_star LEFT JOIN i USING (primary_genre)
  WHERE n <= 3 AND track_popularity > 20 AND primary_genre IS NOT NULL)
SELECT * EXCLUDE (x), {r6("x")} AS rediscovery_score,
  'rediscovery_collaborative' AS recommendation_strategy,
  CAST(row_number() OVER (ORDER BY round(x, 9) DESC, track_id) AS INTEGER) AS rank
FROM s QUALIFY rank <= 50""",
        "recent_star",
        "catalog",
    ),
)
def rediscovery(t):
    likes = fx.genre_interactions(t.silver_star, t.as_of_star)
    return rounded(serving.rediscovery(star_features(t), likes))


@query(
    "r21_popularity_fallback",
    sql(
        f"""SELECT DISTINCT {TRACK}, track_popularity / 100 AS recommendation_score,
  'popularity_based' AS strategy FROM silver WHERE track_popularity > 30""",
        "silver",
    ),
)
def popularity_fallback(t):
    return hybrid.popularity_fallback(t.silver)


@query(
    "r21_safe_recommendations",
    sql(
        f"""SELECT DISTINCT {TRACK}, {number('''CASE WHEN track_popularity >= 80 THEN 0.9
  WHEN track_popularity >= 60 THEN 0.7 WHEN track_popularity >= 40 THEN 0.5 ELSE 0.3 END''')}
    AS recommendation_score FROM silver_star WHERE track_popularity > 20""",
        "silver_star",
    ),
)
def safe_recommendations(t):
    return hybrid.safe_recommendations(t.silver_star)


@query(
    "r21_user_library",
    sql(
        """SELECT track_id, track_name, primary_artist_name, primary_genre, track_popularity,
  count(*) AS play_count, track_popularity / 100 AS familiarity_score FROM silver_star
GROUP BY 1, 2, 3, 4, 5""",
        "silver_star",
    ),
)
def user_library(t):
    return hybrid.user_library(t.silver_star)


@query(
    "r21_simple_union",
    sql(
        f"""SELECT {TRACK}, {r6("s")} AS recommendation_score, CASE priority
  WHEN 1 THEN 'collaborative' WHEN 2 THEN 'content_based' ELSE 'discovery' END AS strategy,
  CAST(priority AS INTEGER) AS priority
FROM ({arms_sql([("collaborative", 1, 0.5), ("content", 1, 0.6), ("discovery", 1, 0.7)])})""",
        "collaborative",
        "content",
        "discovery",
    ),
)
def simple_union(t):
    arms = four(t)
    rows = hybrid.simple_union(
        arms[strategies.COLLABORATIVE], arms[strategies.CONTENT], arms[strategies.DISCOVERY]
    )
    return rounded(rows)


@query(
    "r22_first_non_empty",
    sql(
        f"""SELECT track_id, {r6("recommendation_score")} AS recommendation_score FROM content""",
        "content",
    ),
)
def first_non_empty(t):
    content = strategies.content_based(track_features(t)).select("track_id", "recommendation_score")
    nothing = content.filter(F.col("recommendation_score") > 10)
    fallback = hybrid.popularity_fallback(t.silver).select("track_id", "recommendation_score")
    return rounded(hybrid.first_non_empty([nothing, content, fallback]))


@query(
    "r25_temporal_lookup",
    sql(
        f"""WITH h AS (SELECT primary_genre, hour_genre_probability AS p FROM patterns
  WHERE local_hour = {HOUR} AND is_weekend = {WEEKEND} ORDER BY p DESC, primary_genre LIMIT 10),
b AS (SELECT silver.* FROM silver CROSS JOIN last_day WHERE local_date >= as_of - 30
  QUALIFY row_number() OVER (PARTITION BY primary_genre ORDER BY track_popularity DESC, track_id,
    unique_play) = 1)
SELECT {SHORT}, album_name, track_popularity AS popularity, {r6("p")} AS score
FROM b JOIN h USING (primary_genre)""",
        "patterns",
        "silver",
    ),
)
def temporal_lookup(t):
    return rounded(serving.temporal_lookup(patterns(t), t.silver_table, t.as_of, HOUR, WEEKEND))


# -- analytics ------------------------------------------------------------------------

BANDS = """count(*) FILTER (WHERE track_popularity >= 80) AS mainstream_hits,
  count(*) FILTER (WHERE track_popularity BETWEEN 60 AND 79) AS popular_tracks,
  count(*) FILTER (WHERE track_popularity BETWEEN 40 AND 59) AS rising_tracks,
  count(*) FILTER (WHERE track_popularity BETWEEN 20 AND 39) AS hidden_gems,
  count(*) FILTER (WHERE track_popularity < 20) AS deep_cuts"""


@query(
    "a20_analytics_short",
    sql(
        f"""SELECT count(*) AS total_recommendations,
  count(DISTINCT primary_genre) AS unique_genres_recommended,
  count(DISTINCT primary_artist_name) AS unique_artists_recommended,
  {r6("avg(final_recommendation_score)")} AS avg_recommendation_score,
  {r6("max(final_recommendation_score)")} AS max_recommendation_score,
  {r6("min(final_recommendation_score)")} AS min_recommendation_score,
  {r6("avg(track_popularity)")} AS avg_recommended_popularity FROM playlist""",
        "playlist",
    ),
)
def analytics_short(t):
    return rounded(hybrid.analytics_short(hybrid.hybrid(four(t))))


@query(
    "a20_analytics_full",
    sql(
        f"""SELECT count(*) AS total_recommendations,
  count(DISTINCT primary_genre) AS unique_genres_recommended,
  count(DISTINCT primary_artist_name) AS unique_artists_recommended,
  {r6("avg(final_recommendation_score)")} AS avg_recommendation_score,
  {r6("stddev_samp(final_recommendation_score)")} AS recommendation_score_variance,
  count(*) FILTER (WHERE recommendation_strategies LIKE '%collaborative%') AS collaborative_recs,
  count(*) FILTER (WHERE recommendation_strategies LIKE '%content%') AS content_recs,
  count(*) FILTER (WHERE recommendation_strategies LIKE '%temporal%') AS temporal_recs,
  count(*) FILTER (WHERE recommendation_strategies LIKE '%discovery%') AS discovery_recs,
  count(*) FILTER (WHERE recommendation_support > 1) AS multi_strategy_recs, {BANDS},
  {r6("avg(track_popularity)")} AS avg_recommended_popularity,
  {r6("max(final_recommendation_score)")} AS max_recommendation_score,
  {r6("min(final_recommendation_score)")} AS min_recommendation_score,
  {r6("count(DISTINCT primary_genre) / count(*)")} AS genre_diversity_score,
  {r6("count(DISTINCT primary_artist_name) / count(*)")} AS artist_diversity_score,
  {r6("count(*) FILTER (WHERE recommendation_support > 1) / count(*)")} AS multi_strategy_ratio,
  {r6("count(*) FILTER (WHERE track_popularity >= 60) / count(*)")} AS familiarity_ratio,
  {r6("count(*) FILTER (WHERE track_popularity < 40) / count(*)")} AS discovery_ratio
FROM playlist""",
        "playlist",
    ),
)
def analytics_full(t):
    return rounded(hybrid.analytics_full(hybrid.hybrid(four(t))))


@query(
    "a20_analytics_confidence",
    sql(
        f"""SELECT count(*) AS total_ml_recommendations,
  count(DISTINCT primary_genre) AS unique_genres_recommended,
  count(DISTINCT primary_artist_name) AS unique_artists_recommended,
  {half_up("avg(final_recommendation_score)", 3)} AS avg_ml_score,
  {half_up("max(final_recommendation_score)", 3)} AS max_ml_score,
  {half_up("min(final_recommendation_score)", 3)} AS min_ml_score,
  count(*) FILTER (WHERE recommendation_support >= 3) AS high_confidence_tracks,
  count(*) FILTER (WHERE recommendation_support = 2) AS medium_confidence_tracks,
  count(*) FILTER (WHERE recommendation_support = 1) AS single_algorithm_tracks,
  count(*) FILTER (WHERE recommendation_support > 1) AS multi_algorithm_tracks,
  {half_up("count(*) FILTER (WHERE recommendation_support > 1) * 100.0 / count(*)", 1)}
    AS multi_algorithm_percentage, {BANDS},
  {half_up("count(DISTINCT primary_genre) * 100.0 / count(*)", 1)} AS genre_diversity_percentage,
  {half_up("count(DISTINCT primary_artist_name) * 100.0 / count(*)", 1)}
    AS artist_diversity_percentage FROM confident""",
        "confident",
    ),
)
def analytics_confidence(t):
    return hybrid.analytics_confidence(hybrid.hybrid_confident(four(t)))


@query(
    "a32_score_histogram",
    sql(
        """WITH b AS (SELECT min(recommendation_score) AS lo, max(recommendation_score) AS hi
  FROM content)
SELECT CAST(least(floor(round((recommendation_score - lo) * 10 / (hi - lo), 9)), 9) + 1
    AS INTEGER) AS bin, count(*) AS tracks FROM content CROSS JOIN b GROUP BY 1""",
        "content",
    ),
)
def score_histogram(t):
    content = strategies.content_based(track_features(t))
    return hybrid.score_histogram(content, "recommendation_score")


@query(
    "a32_genre_counts",
    sql(
        """SELECT primary_genre, count(*) AS tracks FROM content GROUP BY 1
ORDER BY tracks DESC, primary_genre LIMIT 8""",
        "content",
    ),
)
def genre_counts(t):
    return hybrid.genre_counts(strategies.content_based(track_features(t)))


@query(
    "a20_system_status",
    sql(
        f"""SELECT count(*) AS recommendation_count,
  {r6("max(final_recommendation_score)")} AS max_recommendation_score,
  'ML System Ready' AS status FROM playlist""",
        "playlist",
    ),
)
def system_status(t):
    return rounded(hybrid.system_status(hybrid.hybrid(four(t))))
