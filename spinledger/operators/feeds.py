"""Discovery feeds: upserts, ranking, analytics and comparison of two feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spinledger.functions import tiers
from spinledger.functions.joins import join_dimension
from spinledger.functions.ranking import first_per_group, rank_in_group, top_n
from spinledger.functions.rounding import half_up
from spinledger.functions.timeparts import since
from spinledger.params import TRACK_LINK_PREFIX

# ---------------------------------------------------------------------------
# upserts: (target, source) -> new target


def upsert_latest(
    target: DataFrame, source: DataFrame, key: str = "track_id", order: Sequence[Column] = ()
) -> DataFrame:
    """Source rows replace target rows of the same key, other source rows are added.

    Several source rows per key are reduced to the first by ``order`` beforehand.
    """
    newest = first_per_group(source, [key], list(order) or [F.col(c) for c in source.columns])
    kept = target.join(newest.select(key), key, "left_anti")
    return kept.unionByName(newest.select(*target.columns))


def reduce_ml_source(source: DataFrame) -> DataFrame:
    """One row per track of an ML batch: earliest attributes, best scores, row count."""
    first = first_per_group(source, ["track_id"], [F.col("discovered_at"), F.col("track_name")])
    best = source.groupBy("track_id").agg(
        F.count("*").alias("_rows"),
        F.max("ml_recommendation_score").alias("_score"),
        F.max("ml_weighted_score").alias("_weighted"),
    )
    return (
        first.join(best, "track_id")
        .withColumns(
            {
                "ml_recommendation_score": F.col("_score"),
                "ml_weighted_score": F.col("_weighted"),
                "discovery_count": F.col("_rows"),
                "first_discovered_at": F.col("discovered_at"),
            }
        )
        .drop("_rows", "_score", "_weighted", "discovered_at", "ingested_at")
    )


BEST_SCORES = ("ml_recommendation_score", "ml_weighted_score")


def upsert_ml_discoveries(target: DataFrame, source: DataFrame, now: Column) -> DataFrame:
    """Counter and best-score upsert.

    A known track keeps its attributes, adds one sighting per source row and takes a better
    score; a new one is inserted. ``target`` has the columns of ``reduce_ml_source`` plus
    ``created_at`` and ``updated_at``.
    """
    fresh = reduce_ml_source(source)
    attributes = [c for c in fresh.columns if c != "track_id"]
    new = fresh.select("track_id", F.struct(*attributes).alias("_new"))
    kept = [*attributes, "created_at", "updated_at"]
    old = target.select("track_id", F.struct(*kept).alias("_old"))
    known, seen = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    out = []
    for name in attributes:
        before, after = F.col(f"_old.{name}"), F.col(f"_new.{name}")
        if name == "discovery_count":
            value = F.coalesce(before, F.lit(0)) + F.coalesce(after, F.lit(0))
        elif name in BEST_SCORES:
            value = F.greatest(before, after)
        else:
            value = F.when(known, before).otherwise(after)
        out.append(value.alias(name))
    return old.join(new, "track_id", "full").select(
        "track_id",
        *out,
        F.when(known, F.col("_old.created_at")).otherwise(now).alias("created_at"),
        F.when(seen, now).otherwise(F.col("_old.updated_at")).alias("updated_at"),
    )


FEED_COLUMNS = [
    "track_id", "track_name", "primary_artist_name", "primary_artist_id", "album_name",
    "album_release_date", "track_popularity", "track_duration_ms", "preview_url",
    "discovery_strategy", "seed_artist", "seed_genre", "preference_score", "discovered_at",
]


def upsert_discoveries(target: DataFrame, source: DataFrame, now: Column) -> DataFrame:
    """Insert-only upsert: known tracks only get a new ``updated_at``.

    ``target``: ``FEED_COLUMNS`` plus recommendation_score, created_at and updated_at.
    """
    named = source.dropna(subset=["track_id", "track_name", "primary_artist_name"])
    fresh = first_per_group(named, ["track_id"], [F.col(c) for c in FEED_COLUMNS[::-1]])
    new = fresh.select("track_id", F.struct(*FEED_COLUMNS[1:]).alias("_new"))
    old = target.select(
        "track_id",
        F.struct(*FEED_COLUMNS[1:]).alias("_old"),
        "recommendation_score",
        "created_at",
        "updated_at",
    )
    known, seen = F.col("created_at").isNotNull(), F.col("_new").isNotNull()
    row = F.coalesce("_old", "_new")
    return (
        old.join(new, "track_id", "full")
        .withColumn("_row", row)
        .select(
            "track_id",
            "_row.*",
            F.coalesce("recommendation_score", F.lit(0.0)).alias("recommendation_score"),
            F.coalesce("created_at", now).alias("created_at"),
            F.when(known & ~seen, F.col("updated_at")).otherwise(now).alias("updated_at"),
        )
    )


def first_arrival(feed: DataFrame, order: Sequence[Column], limit: int | None = None) -> DataFrame:
    """First row per track in an explicit arrival order."""
    out = first_per_group(feed, ["track_id"], list(order))
    return out if limit is None else top_n(out, [*order, F.col("track_id")], limit)


# ---------------------------------------------------------------------------
# ranking of the search feed


def artist_shares(features: DataFrame) -> DataFrame:
    """Share of the feature tracks that each artist has."""
    total = features.agg(F.count("*")).scalar()
    counted = features.groupBy("primary_artist_name").agg(F.count("*").alias("_n"))
    return counted.select(
        F.col("primary_artist_name").alias("_artist"),
        (F.col("_n") / total).alias("artist_preference_score"),
    )


def discovery_score(as_of: Column) -> Column:
    """Feed score by strategy; expects the preference columns joined on."""
    popularity = F.col("track_popularity") / 100.0
    seed = F.col("preference_score")
    age = F.datediff(as_of, F.to_date("discovered_at"))
    by_artist = (
        F.coalesce("artist_preference_score", F.lit(0.1)) * 0.5 + popularity * 0.3 + seed * 0.2
    )
    by_genre = (
        F.coalesce("weighted_preference", F.lit(0.1)) * 0.4
        + popularity * 0.3
        + seed * 0.2
        + 1.0 / (age + 1) * 0.1
    )
    return (
        F.when(F.col("discovery_strategy") == "artist_based", by_artist)
        .when(F.col("discovery_strategy") == "genre_based", by_genre)
        .otherwise(0.3)
    )


def penalty(rank: Column, steps: Sequence[tuple[int, float]], rest: float) -> Column:
    out = None
    for limit, factor in steps:
        hit = rank <= limit
        out = F.when(hit, factor) if out is None else out.when(hit, factor)
    return out.otherwise(rest)


ARTIST_STEPS = [(1, 1.0), (2, 0.7), (3, 0.4)]
GENRE_STEPS = [(3, 1.0), (5, 0.8)]


def diversity_ranks(feed: DataFrame) -> DataFrame:
    """Popularity rank of every row inside its artist and inside its seed genre."""
    popular = [F.desc_nulls_last("track_popularity"), F.col("track_id")]
    out = feed.withColumn("_genre", F.coalesce("seed_genre", F.lit("unknown")))
    out = rank_in_group(out, "primary_artist_name", popular, "artist_diversity_rank")
    return rank_in_group(out, "_genre", popular, "genre_diversity_rank").drop("_genre")


def smart_discoveries(
    feed: DataFrame,
    interactions: DataFrame,
    features: DataFrame,
    as_of: Column,
    days: int = 7,
    min_score: float = 0.2,
) -> DataFrame:
    """Recent discoveries scored by preference with artist and genre diversity penalties.

    One row per track is expected; see ``upsert_discoveries``.
    """
    likes = interactions.filter(F.col("weighted_preference") > 0.1).select(
        F.lower("primary_genre").alias("_liked"), "weighted_preference"
    )
    recent = feed.filter(since(F.to_date("discovered_at"), as_of, days))
    rows = join_dimension(recent, likes, F.lower("seed_genre") == F.col("_liked"))
    rows = join_dimension(
        rows, artist_shares(features), F.col("primary_artist_name") == F.col("_artist")
    )
    scored = diversity_ranks(rows.withColumn("_score", discovery_score(as_of)))
    final = (
        F.col("_score")
        * penalty(F.col("artist_diversity_rank"), ARTIST_STEPS, 0.2)
        * penalty(F.col("genre_diversity_rank"), GENRE_STEPS, 0.5)
    )
    return scored.filter(F.round("_score", 12) > min_score).select(
        "track_id",
        "track_name",
        "primary_artist_name",
        "primary_artist_id",
        "album_name",
        "album_release_date",
        "track_popularity",
        "track_duration_ms",
        "preview_url",
        "discovery_strategy",
        "seed_artist",
        "seed_genre",
        F.col("preference_score").alias("seed_preference_score"),
        F.round(final, 12).alias("final_recommendation_score"),
        "artist_diversity_rank",
        "genre_diversity_rank",
        "discovered_at",
    )


def top_discoveries(
    smart: DataFrame, n: int = 10, link_prefix: str = TRACK_LINK_PREFIX
) -> DataFrame:
    order = [F.desc("final_recommendation_score"), F.col("track_id")]
    return top_n(smart, order, n, "recommendation_rank").select(
        "recommendation_rank",
        "track_name",
        "primary_artist_name",
        F.coalesce("seed_genre", "seed_artist").alias("discovery_seed"),
        "discovery_strategy",
        "track_popularity",
        half_up(F.col("final_recommendation_score"), 3).alias("score"),
        "preview_url",
        tiers.track_link(F.col("track_id"), link_prefix).alias("track_url"),
    )


def discovery_analytics(smart: DataFrame) -> DataFrame:
    """One row over the ranked discoveries, with the five best as text."""
    score = F.col("final_recommendation_score")
    best = top_discoveries(smart, 5)
    item = F.struct(
        "recommendation_rank", F.concat("track_name", F.lit(" by "), "primary_artist_name")
    )
    names = F.transform(F.sort_array(F.collect_list(item)), lambda x: x["col2"])
    return smart.agg(
        F.count("*").alias("total_discoveries"),
        F.countDistinct("primary_artist_name").alias("unique_artists_discovered"),
        F.countDistinct("seed_genre").alias("genres_explored"),
        F.countDistinct("discovery_strategy").alias("strategies_used"),
        F.avg("track_popularity").alias("avg_discovery_popularity"),
        F.count_if(F.col("discovery_strategy") == "artist_based").alias("artist_based_discoveries"),
        F.count_if(F.col("discovery_strategy") == "genre_based").alias("genre_based_discoveries"),
        F.count_if(score > 0.7).alias("high_quality_discoveries"),
        F.count_if(score.between(0.4, 0.7)).alias("medium_quality_discoveries"),
        F.count_if(score < 0.4).alias("low_quality_discoveries"),
        F.max("discovered_at").alias("latest_discovery"),
        F.min("discovered_at").alias("earliest_discovery"),
    ).withColumn("top_5_recommendations", best.agg(F.array_join(names, "; ")).scalar())


def quick_test(feed: DataFrame, smart: DataFrame) -> DataFrame:
    """Four figures in long form: totals, good recent rows, top strategy, top artist."""

    def most(column: str, metric: str, value: Column) -> DataFrame:
        counted = feed.groupBy(column).agg(F.count("*").alias("n"))
        best = top_n(counted, [F.desc("n"), F.col(column)], 1)
        return best.select(
            F.lit(metric).alias("metric"),
            value.cast("long").alias("value"),
            F.col(column).alias("details"),
        )

    def count(df: DataFrame, metric: str, details: str) -> DataFrame:
        return df.agg(F.count("*").alias("value")).select(
            F.lit(metric).alias("metric"), "value", F.lit(details).alias("details")
        )

    good = smart.filter(F.col("final_recommendation_score") > 0.6)
    return (
        count(feed, "Total Discovered Tracks", "")
        .unionByName(
            count(good, "Recent High-Quality Recommendations", "Score > 0.6, Discovered in last 7 days")
        )
        .unionByName(most("discovery_strategy", "Top Discovery Strategy", F.lit(0)))
        .unionByName(most("primary_artist_name", "Most Discovered Artist", F.col("n")))
    )


# ---------------------------------------------------------------------------
# comparison of the search feed and the ML feed

SEARCH, ML = "Smart Search", "ML Hybrid"


def tagged_feeds(search: DataFrame, ml: DataFrame, at: str = "created_at") -> DataFrame:
    """Both feeds in one table with a ``pipeline`` column and one ``score``."""
    common = ["track_id", "track_name", "primary_artist_name", "seed_genre", "track_popularity",
              "discovery_strategy"]
    first = search.select(
        F.lit(SEARCH).alias("pipeline"),
        *common,
        F.coalesce("preference_score", F.lit(0.5)).alias("score"),
        F.col(at).alias("created_at"),
    )
    second = ml.select(
        F.lit(ML).alias("pipeline"),
        *common,
        F.col("ml_recommendation_score").alias("score"),
        F.col(at).alias("created_at"),
    )
    return first.unionByName(second)


def feed_totals(feeds: DataFrame) -> DataFrame:
    return feeds.groupBy("pipeline").agg(
        F.count("*").alias("total_discoveries"),
        F.avg("track_popularity").alias("avg_popularity"),
        F.countDistinct("primary_artist_name").alias("unique_artists"),
        F.countDistinct("seed_genre").alias("unique_genres"),
        F.max("created_at").alias("latest_discovery"),
    )


def feed_quality(feeds: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    return (
        feeds.filter(since(F.to_date("created_at"), as_of, days))
        .groupBy("pipeline")
        .agg(
            F.count("*").alias("total_tracks"),
            half_up(F.avg("track_popularity"), 2).alias("avg_popularity"),
            F.countDistinct("discovery_strategy").alias("strategies_used"),
            half_up(F.avg("score"), 3).alias("avg_score"),
            F.countDistinct("seed_genre").alias("genre_diversity"),
            F.min("created_at").alias("first_discovery"),
            F.max("created_at").alias("latest_discovery"),
        )
    )


def feed_diversity(feeds: DataFrame) -> DataFrame:
    popularity = F.col("track_popularity")
    return feeds.groupBy("pipeline").agg(
        F.countDistinct("seed_genre").alias("genre_diversity"),
        F.countDistinct("primary_artist_name").alias("artist_diversity"),
        half_up(F.avg(popularity), 2).alias("avg_popularity"),
        F.count_if(popularity < 30).alias("underground_tracks"),
        F.count_if(popularity > 70).alias("mainstream_tracks"),
    )


def feed_top(feeds: DataFrame, pipeline: str, n: int = 10) -> DataFrame:
    rows = feeds.filter(F.col("pipeline") == pipeline)
    return top_n(rows, [F.desc_nulls_last("score"), F.col("track_id")], n).select(
        "track_id",
        "track_name",
        "primary_artist_name",
        "seed_genre",
        "track_popularity",
        "discovery_strategy",
        half_up(F.col("score"), 3).alias("score"),
        "created_at",
    )


def feed_strategies(feeds: DataFrame) -> DataFrame:
    return feeds.groupBy("pipeline", "discovery_strategy").agg(
        F.count("*").alias("track_count"),
        half_up(F.avg("track_popularity"), 2).alias("avg_popularity"),
        half_up(F.avg("score"), 3).alias("avg_score"),
        F.countDistinct("primary_artist_name").alias("unique_artists"),
    )


def feed_genres(search: DataFrame, ml: DataFrame, n: int = 15) -> DataFrame:
    """Tracks and popularity per seed genre in either feed."""

    def side(feed: DataFrame, prefix: str, name: str) -> DataFrame:
        return (
            feed.filter(F.col("seed_genre").isNotNull())
            .groupBy(F.col("seed_genre").alias("genre"))
            .agg(
                F.count("*").alias(f"{prefix}_tracks"),
                half_up(F.avg("track_popularity"), 2).alias(f"{name}_avg_popularity"),
            )
        )

    both = side(search, "smart_search", "smart").join(
        side(ml, "ml_hybrid", "ml"), "genre", "full"
    )
    filled = both.fillna(0)
    order = [F.desc(F.col("smart_search_tracks") + F.col("ml_hybrid_tracks")), F.col("genre")]
    return top_n(filled, order, n)


def feed_timeline(feeds: DataFrame, as_of: Column, days: int = 2, n: int = 24) -> DataFrame:
    """Discoveries of either feed per hour, latest hours first."""
    hour = F.date_trunc("hour", "created_at").cast("timestamp_ntz")
    hours = (
        feeds.filter(since(F.to_date("created_at"), as_of, days))
        .groupBy(hour.alias("discovery_hour"))
        .agg(
            F.count_if(F.col("pipeline") == SEARCH).alias("smart_discoveries"),
            F.count_if(F.col("pipeline") == ML).alias("ml_discoveries"),
        )
    )
    return top_n(hours, [F.desc("discovery_hour")], n)


SCORE_BANDS = [(0.8, "Excellent (0.8+)"), (0.6, "Good (0.6-0.8)"), (0.4, "Fair (0.4-0.6)")]


def feed_score_bands(ml: DataFrame) -> DataFrame:
    band = tiers.steps(F.round("ml_recommendation_score", 12), SCORE_BANDS, "Low (<0.4)")
    return (
        ml.filter(F.col("ml_recommendation_score").isNotNull())
        .groupBy(band.alias("score_range"))
        .agg(
            F.count("*").alias("track_count"),
            half_up(F.avg("track_popularity"), 2).alias("avg_popularity"),
        )
    )
