"""Coverage, data quality, listening quality, drift and readiness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinledger.functions.joins import salted_dimension_join
from spinledger.functions.ranking import share, top_n
from spinledger.functions.rounding import half_up
from spinledger.functions.timeparts import since
from spinledger.operators.silver import has_no_genre

NO_KEY = "\x00"


def with_group_counts(df: DataFrame, counts: Mapping[str, str], spread_by: str = "unique_play") -> DataFrame:
    """Append, per entry, the number of rows that share the row's key (NULL is a key).

    Counts are aggregated and joined back instead of windowed, so that the rows of a hot key
    never gather in one task.
    """
    for name, key in counts.items():
        value = F.coalesce(F.col(key).cast("string"), F.lit(NO_KEY))
        totals = df.groupBy(value.alias("_total_key")).agg(F.count("*").alias(name))
        df = salted_dimension_join(
            df.withColumn("_row_key", value), totals, "_row_key", "_total_key", [spread_by]
        ).drop("_row_key", "_total_key")
    return df


# ---------------------------------------------------------------------------
# missing artists and genre coverage


def missing_artists(plays: DataFrame, artists: DataFrame) -> DataFrame:
    """Played artists that the dimension does not have, with their plays."""
    totals = plays.groupBy("primary_artist_id", "primary_artist_name").agg(
        F.count("*").alias("play_count"),
        F.countDistinct("local_date").alias("days_active"),
        F.min("local_timestamp").alias("first_played"),
        F.max("local_timestamp").alias("last_played"),
        F.countDistinct("track_id").alias("unique_tracks"),
    )
    known = artists.select(F.col("artist_id").alias("primary_artist_id")).dropna()
    return totals.join(known, "primary_artist_id", "left_anti")


def missing_summary(missing: DataFrame, plays: DataFrame) -> DataFrame:
    total = plays.agg(F.count("*")).scalar()
    return missing.agg(
        F.count("*").alias("total_missing_artists"),
        F.sum("play_count").alias("total_missing_plays"),
        F.max("play_count").alias("most_plays_by_missing_artist"),
        F.avg("play_count").alias("avg_plays_per_missing_artist"),
    ).withColumn("percentage_of_total_plays", share(F.col("total_missing_plays"), total))


def top_id_list(df: DataFrame, key: str, count: str, n: int = 50, fmt: str = "csv") -> DataFrame:
    """The ``n`` heaviest keys as one comma-joined or JSON text (``n`` bounds the list)."""
    best = top_n(df, [F.desc(count), F.col(key)], n)
    if fmt == "csv":
        item = F.struct((-F.col(count)).alias("o"), F.col(key).alias("k"))
        ids = F.transform(F.sort_array(F.collect_list(item)), lambda x: x["k"])
        return best.agg(F.array_join(ids, ",").alias("artist_ids_csv"))
    fields = F.struct("primary_artist_id", "primary_artist_name", "play_count")
    item = F.struct((-F.col(count)).alias("o"), F.col(key).alias("k"), fields.alias("v"))
    values = F.transform(F.sort_array(F.collect_list(item)), lambda x: x["v"])
    return best.agg(F.to_json(values).alias("json_output"))


def genre_coverage(plays: DataFrame, artists: DataFrame) -> DataFrame:
    """How many artists and plays have an artist row; plays are summed per artist first."""
    known = artists.select(F.col("artist_id").alias("_id"), F.lit(True).alias("_known")).distinct()
    per_artist = plays.groupBy("primary_artist_id").agg(F.count("*").alias("_n"))
    joined = per_artist.join(known, F.col("primary_artist_id") == F.col("_id"), "left")
    has = F.col("_known").isNotNull()
    counts = joined.agg(
        F.count("primary_artist_id").alias("total_artists"),
        F.count_if(has).alias("artists_with_genres"),
        F.sum("_n").alias("total_plays"),
        F.coalesce(F.sum(F.when(has, F.col("_n"))), F.lit(0)).alias("plays_with_genres"),
    )
    return counts.withColumns(
        {
            "missing_artists": F.col("total_artists") - F.col("artists_with_genres"),
            "artist_coverage_percentage": share(
                F.col("artists_with_genres"), F.col("total_artists")
            ),
            "plays_missing_genres": F.col("total_plays") - F.col("plays_with_genres"),
            "play_coverage_percentage": share(F.col("plays_with_genres"), F.col("total_plays")),
        }
    )


def genre_status(artists: DataFrame) -> DataFrame:
    """Counts of artists by the state of their genre list."""
    known = F.count_if(F.col("genre_count") > 0)
    return artists.agg(
        F.count("*").alias("total_artists"),
        F.count_if(F.col("genres").isNull()).alias("null_genres"),
        F.count_if(F.col("genres") == "[]").alias("empty_array_genres"),
        F.count_if(F.col("genre_count") == 0).alias("zero_genre_count"),
        known.alias("artists_with_genres"),
        share(known, F.count("*")).alias("current_coverage_percentage"),
    )


def removal_counts(artists: DataFrame) -> DataFrame:
    return artists.filter(has_no_genre()).agg(
        F.count("*").alias("artists_to_remove"),
        F.countDistinct("artist_id").alias("unique_artist_ids_to_remove"),
    )


def data_sources(artists: DataFrame) -> DataFrame:
    total = artists.agg(F.count("*")).scalar()
    return (
        artists.groupBy("data_source")
        .agg(F.count("*").alias("artist_count"))
        .withColumn("percentage", share(F.col("artist_count"), total))
    )


def empty_genre_artists(artists: DataFrame, plays: DataFrame) -> DataFrame:
    """Artists with an empty genre list and how much they are played."""
    totals = plays.groupBy(F.col("primary_artist_id").alias("artist_id")).agg(
        F.count("*").alias("_plays"),
        F.countDistinct("local_date").alias("_days"),
        F.min("local_timestamp").alias("first_played"),
        F.max("local_timestamp").alias("last_played"),
    )
    empty = artists.filter(F.col("genre_count") == 0)
    return empty.join(totals, "artist_id", "left").select(
        "artist_id",
        "artist_name",
        "popularity",
        "followers_total",
        "genre_count",
        "data_source",
        F.coalesce("_plays", F.lit(0)).alias("total_plays"),
        F.coalesce("_days", F.lit(0)).alias("days_active"),
        "first_played",
        "last_played",
    )


def empty_genre_summary(empty: DataFrame, plays: DataFrame) -> DataFrame:
    total = plays.agg(F.count("*")).scalar()
    return empty.agg(
        F.count("*").alias("total_empty_genre_artists"),
        F.sum("total_plays").alias("total_plays_affected"),
        F.avg("popularity").alias("avg_popularity"),
        F.avg("followers_total").alias("avg_followers"),
        F.max("total_plays").alias("most_plays_by_empty_genre_artist"),
    ).withColumn("percentage_of_total_plays", share(F.col("total_plays_affected"), total))


# ---------------------------------------------------------------------------
# pipeline health


def pipeline_metrics(plays: DataFrame, artists: DataFrame, now: Column) -> DataFrame:
    """Six health figures in long form, one aggregate per table."""
    hours = F.timestamp_diff("HOUR", F.date_trunc("hour", F.max("played_at")), F.date_trunc("hour", now))
    fresh = F.col("ingested_at") >= now - F.expr("INTERVAL 24 HOURS")
    known = F.col("genre_count") > 0

    def stack(row: DataFrame, metrics: Mapping[str, str]) -> DataFrame:
        arms = ", ".join(
            f"'{name}', cast({name} AS double), '{text}'" for name, text in metrics.items()
        )
        return row.selectExpr(
            f"stack({len(metrics)}, {arms}) AS (metric_name, metric_value, metric_description)"
        )

    first = plays.agg(
        F.count("*").alias("total_tracks_ingested"),
        hours.alias("data_freshness_hours"),
        F.count_if(fresh).alias("tracks_last_24h"),
    )
    second = artists.agg(
        F.count("*").alias("total_artists_processed"),
        F.count_if(known).alias("artists_with_genres"),
        F.avg(F.when(known, F.col("genre_count"))).alias("avg_genres_per_artist"),
    )
    # fixed values: metric names and descriptions
    return stack(
        first,
        {
            "total_tracks_ingested": "Total number of tracks in the database",
            "data_freshness_hours": "Hours since most recent track was played",
            "tracks_last_24h": "Number of tracks ingested in the last 24 hours",
        },
    ).unionByName(
        stack(
            second,
            {
                "total_artists_processed": "Total number of unique artists with genre data",
                "artists_with_genres": "Number of artists that have at least one genre",
                "avg_genres_per_artist": "Average number of genres per artist",
            },
        )
    )


def freshness(plays: DataFrame) -> DataFrame:
    """Row counts, span and latest ingestion of the deduplicated plays."""
    return plays.agg(
        F.count("*").alias("total_plays"),
        F.countDistinct("unique_play").alias("unique_plays"),
        F.countDistinct("primary_artist_id").alias("unique_artists"),
        F.countDistinct("track_id").alias("unique_tracks"),
        F.min("local_timestamp").alias("earliest_play"),
        F.max("local_timestamp").alias("latest_play"),
        F.max("ingested_at").alias("latest_ingestion"),
        F.datediff(F.max("local_timestamp"), F.min("local_timestamp")).alias("days_of_data"),
    )


def duplicate_check(plays: DataFrame) -> DataFrame:
    rows, keys = F.count("*"), F.countDistinct("unique_play")
    return plays.agg(
        rows.alias("total_rows"),
        keys.alias("unique_rows"),
        (rows - keys).alias("duplicate_count"),
        F.when(rows == keys, "No duplicates").otherwise("Duplicates found").alias(
            "duplicate_status"
        ),
    )


def recent_days(plays: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """Plays per day of the last hours."""
    recent = plays.filter(F.col("local_timestamp") >= now - F.expr(f"INTERVAL {hours} HOURS"))
    return recent.groupBy(F.to_date("local_timestamp").alias("play_date")).agg(
        F.count("*").alias("plays_count"),
        F.countDistinct("primary_artist_id").alias("unique_artists"),
        F.countDistinct("track_id").alias("unique_tracks"),
        F.min("local_timestamp").alias("first_play"),
        F.max("local_timestamp").alias("last_play"),
    )


def ingest_timeline(plays: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    recent = plays.filter(since(F.to_date("ingested_at"), as_of, days))
    return recent.groupBy(F.to_date("ingested_at").alias("ingestion_date")).agg(
        F.count("*").alias("plays_ingested"),
        F.countDistinct("primary_artist_id").alias("artists_ingested"),
        F.min("ingested_at").alias("first_ingestion"),
        F.max("ingested_at").alias("last_ingestion"),
    )


# ---------------------------------------------------------------------------
# listening quality and drift


def listening_quality(silver: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Diversity and engagement of recent listening.

    The rates over plays that share a track or genre come from sums per track and genre.
    """
    recent = silver.filter(since(F.col("local_date"), as_of, days))
    whole = recent.agg(
        F.countDistinct("track_id").alias("unique_tracks"),
        F.countDistinct("primary_genre").alias("unique_genres"),
        F.countDistinct("primary_artist_name").alias("unique_artists"),
        F.count("*").alias("total_plays"),
        F.avg("track_popularity").alias("avg_track_popularity"),
        F.countDistinct("local_hour").alias("listening_hour_diversity"),
        F.avg(F.col("is_weekend").cast("int")).alias("weekend_preference"),
    )
    n = F.col("n")
    per_track = recent.groupBy("track_id").agg(F.count("*").alias("n"))
    tracks = per_track.agg(
        F.struct(
            F.sum(F.when(n == 1, n)).alias("once"), F.sum(F.when(n > 3, n)).alias("often")
        )
    ).scalar()
    per_genre = recent.groupBy("primary_genre").agg(F.count("*").alias("n"))
    niche = per_genre.agg(F.sum(F.when(n <= 5, n))).scalar()
    rated = whole.withColumns({"_tracks": tracks, "_niche": niche})

    def rate(plays: str) -> Column:
        return F.try_divide(F.coalesce(F.col(plays), F.lit(0)), F.col("total_plays"))

    rated = rated.withColumns(
        {
            "discovery_rate": rate("_tracks.once"),
            "replay_rate": rate("_tracks.often"),
            "niche_genre_rate": rate("_niche"),
        }
    ).drop("_tracks", "_niche")
    return rated.withColumns(
        {
            "diversity_score": F.col("discovery_rate") * 0.4
            + F.col("listening_hour_diversity") / 24 * 0.3
            + F.col("niche_genre_rate") * 0.3,
            "engagement_score": F.col("replay_rate") * 0.6
            + (1 - F.abs(F.col("avg_track_popularity") - 50) / 50) * 0.4,
        }
    ).withColumn(
        "overall_score", F.col("diversity_score") * 0.5 + F.col("engagement_score") * 0.5
    )


# Weights of genre, popularity, temporal and weekend drift.
DRIFT_WEIGHTS_3 = (0.4, 0.3, 0.3, 0.0)
DRIFT_WEIGHTS_4 = (0.3, 0.25, 0.25, 0.2)


def drift(
    silver: DataFrame,
    as_of: Column,
    recent_days: int = 7,
    weights: Sequence[float] = DRIFT_WEIGHTS_3,
    distinct_cells: bool = False,
) -> DataFrame:
    """Change between the last ``recent_days`` days and as many before, in one aggregate.

    With ``distinct_cells`` the averages are over the distinct combinations of genre,
    popularity, hour and weekend instead of over plays.
    """
    date = F.col("local_date")
    period = F.when(since(date, as_of, recent_days), "recent").when(
        since(date, as_of, 2 * recent_days), "older"
    )
    tagged = silver.filter(since(date, as_of, 2 * recent_days)).withColumn("_period", period)

    if distinct_cells:
        cell = ["_period", "primary_genre", "track_popularity", "local_hour", "is_weekend"]
        tagged = tagged.select(*cell).distinct()

    def of(name: str, value: Column) -> Column:
        return F.when(F.col("_period") == name, value)

    columns = []
    for name in ("recent", "older"):
        columns += [
            F.countDistinct(of(name, F.col("primary_genre"))).alias(f"{name}_genres"),
            F.avg(of(name, F.col("track_popularity"))).alias(f"{name}_popularity"),
            F.avg(of(name, F.col("local_hour"))).alias(f"{name}_hour"),
            F.avg(of(name, F.col("is_weekend").cast("int"))).alias(f"{name}_weekend"),
        ]
    row = tagged.agg(*columns)

    def gap(value: str) -> Column:
        return F.abs(F.col(f"recent_{value}") - F.col(f"older_{value}"))

    parts = {
        "genre_drift": gap("genres") / F.greatest(F.col("older_genres"), F.lit(1)),
        "popularity_drift": gap("popularity") / 100.0,
        "temporal_drift": gap("hour") / 24.0,
        "weekend_drift": gap("weekend"),
    }
    score = F.lit(0.0)
    for name, weight in zip(parts, weights):
        score = score + F.col(name) * weight
    # no row when a period is empty
    complete = F.col("recent_hour").isNotNull() & F.col("older_hour").isNotNull()
    return row.filter(complete).withColumns(parts).withColumn("drift_score", score)


def data_sufficiency(silver: DataFrame, as_of: Column, days: int = 180) -> DataFrame:
    """Whether there is enough listening to train on."""
    stats = silver.filter(since(F.col("local_date"), as_of, days)).agg(
        F.count("*").alias("total_tracks"),
        F.countDistinct("primary_genre").alias("unique_genres"),
        F.countDistinct("primary_artist_id").alias("unique_artists"),
        F.countDistinct("local_date").alias("unique_days"),
        F.min("local_date").alias("earliest_date"),
        F.max("local_date").alias("latest_date"),
    )
    checks = {
        "listening_history": F.col("total_tracks") >= 50,
        "genre_diversity": F.col("unique_genres") >= 5,
        "artist_diversity": F.col("unique_artists") >= 20,
        "temporal_data": F.col("unique_days") >= 7,
    }
    enough = F.lit(True)
    for check in checks.values():
        enough = enough & check
    return stats.withColumns({**checks, "sufficient_for_ml": enough})


# The label of the first check that fails.
ROOT_CAUSES = [
    ("plays", 1, "No raw deduped data", "Check data ingestion"),
    ("silver_plays", 1, "No silver enriched data", "Refresh the silver layer"),
    ("recent_plays", 100, "Very little recent data", "Collect more listening history"),
    ("genres", 3, "Too few genres", "Collect more diverse listening"),
    ("feature_tracks", 1, "Track features missing", "Refresh the feature layer"),
    ("liked_genres", 1, "Genre interactions not calculated", "Check the interaction filters"),
    ("similar_pairs", 1, "Genre similarities not calculated", "Check the session overlap"),
    ("collaborative", 1, "Recommendation filters too restrictive", "Relax the thresholds"),
]


def root_cause(
    plays: DataFrame,
    silver: DataFrame,
    features: DataFrame,
    interactions: DataFrame,
    similarity: DataFrame,
    collaborative: DataFrame,
    as_of: Column,
) -> DataFrame:
    """Layer sizes and the first layer that is too small."""
    rows = F.count("*")
    recent = since(F.col("local_date"), as_of, 90)
    counts = silver.agg(
        rows.alias("silver_plays"),
        F.count_if(recent).alias("recent_plays"),
        F.countDistinct("primary_genre").alias("genres"),
    ).withColumns(
        {
            "plays": plays.agg(rows).scalar(),
            "feature_tracks": features.agg(rows).scalar(),
            "liked_genres": interactions.agg(rows).scalar(),
            "similar_pairs": similarity.filter("jaccard_similarity > 0").agg(rows).scalar(),
            "collaborative": collaborative.agg(rows).scalar(),
        }
    )
    cause = fix = None
    for name, least, label, advice in ROOT_CAUSES:
        low = F.col(name) < least
        cause = F.when(low, label) if cause is None else cause.when(low, label)
        fix = F.when(low, advice) if fix is None else fix.when(low, advice)
    return counts.withColumns(
        {
            "root_cause": cause.otherwise("Base data exists"),
            "recommended_fix": fix.otherwise("Check the individual recommendation queries"),
        }
    )


def table_summary(silver: DataFrame) -> DataFrame:
    """Distinct tracks and genres of the silver plays."""
    return silver.agg(
        F.countDistinct("track_id").alias("track_count"),
        F.countDistinct("primary_genre").alias("genre_count"),
    )


def round_scores(df: DataFrame, *columns: str, digits: int = 3) -> DataFrame:
    return df.withColumns({c: half_up(F.col(c), digits) for c in columns})
