"""Summary marts over the silver plays.

The daily, monthly and genre marts are finished from the states of ``marts``, which need one pass
over the plays. Other distinct counts are left to Catalyst. Both shuffle on (group, value), so
that a group holding much of the data is still spread over all tasks. The windows without a
partition run over aggregated rows only (one per genre or month).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spinledger.functions import tiers
from spinledger.functions.ranking import (
    count_if_pct,
    most_frequent,
    share,
    top_n,
)
from spinledger.functions.rounding import half_up
from spinledger.functions.timeparts import add_local_time, since
from spinledger.operators import marts


def all_rows():
    """Window over every row of an aggregated table."""
    return W.partitionBy()


def pct_ratio(part: Column, whole: Column, digits: int = 2) -> Column:
    return half_up(part / whole * 100, digits)


def hundredths() -> Column:
    """Sum of the two-digit track minutes in whole hundredths.

    Integer sums do not depend on the order in which partitions arrive.
    """
    return F.sum(F.round(F.col("track_duration_minutes") * 100).cast("long"))


def minutes_total() -> Column:
    return half_up(hundredths() / 100, 2)


def minutes_per_play() -> Column:
    """Average track minutes from summed hundredths and the number of plays that have a length."""
    return half_up(F.try_divide(F.col("hundredths"), F.col("timed") * 100), 2)


def artist_summary(silver: DataFrame, artists: DataFrame) -> DataFrame:
    """One row per artist of the dimension, unplayed artists kept.

    An unplayed artist has ``total_plays`` 1, the count of its single unmatched join row. The
    plays are summed per artist before the join, so no play crosses the join's shuffle.
    """
    played = (
        silver.filter(F.col("primary_artist_id").isNotNull())
        .groupBy("primary_artist_id")
        .agg(
            F.count("*").alias("_plays"),
            F.countDistinct("track_id").alias("_tracks"),
            F.countDistinct("album_id").alias("_albums"),
            minutes_total().alias("total_listening_minutes"),
            half_up(F.avg("track_popularity"), 1).alias("average_track_popularity"),
            F.min("local_timestamp").alias("first_listened"),
            F.max("local_timestamp").alias("last_listened"),
            F.min("time_of_day_category").alias("primary_time_of_day"),
            F.min(F.dayname("local_timestamp")).alias("primary_day_of_week"),
            count_if_pct(F.col("is_weekend")).alias("_weekend"),
            F.max("ingested_at").alias("last_updated"),
        )
    )
    days = F.datediff("last_listened", "first_listened") + 1
    known = artists.filter(F.col("artist_id").isNotNull())
    return known.join(played, known["artist_id"] == played["primary_artist_id"], "left").select(
        "artist_id",
        "artist_name",
        "artist_uri",
        "primary_genre",
        F.col("genres_list").alias("all_genres"),
        "genre_count",
        (F.coalesce(F.col("genre_count"), F.lit(0)) > 1).alias("is_multi_genre_artist"),
        F.col("popularity").alias("artist_popularity"),
        F.col("followers_total").alias("artist_followers"),
        F.coalesce("_plays", F.lit(1)).alias("total_plays"),
        F.coalesce("_tracks", F.lit(0)).alias("unique_tracks_played"),
        F.coalesce("_albums", F.lit(0)).alias("unique_albums_played"),
        "total_listening_minutes",
        "average_track_popularity",
        "first_listened",
        "last_listened",
        days.alias("listening_streak_days"),
        "primary_time_of_day",
        "primary_day_of_week",
        F.coalesce("_weekend", F.lit(0.0)).alias("weekend_play_percentage"),
        "last_updated",
    )


def daily_summary(silver: DataFrame, top: str = "mode", plays_unique: bool = True) -> DataFrame:
    """Daily listening summary, from one pass over the plays.

    ``top="mode"`` takes the most played genre of the day, ``top="min"`` the alphabetically
    first. ``new_artists_discovered`` and ``new_tracks_discovered`` repeat the day's distinct
    counts; see ``monthly_discoveries`` for first-seen artists.
    """
    mart = marts.DAY if plays_unique else marts.DAY_WITH_KEYS
    return day_rows(mart.states(silver), top, plays_unique)


def day_rows(states: DataFrame, top: str = "mode", plays_unique: bool = True) -> DataFrame:
    """Daily summary from merged states of ``marts.DAY``."""
    best = marts.most_played("genre")["value"]
    if top == "min":
        best = F.min(F.when(F.col("kind") == "genre", F.col("value")))
    keys = F.col("total_plays") if plays_unique else F.col("_keys")
    days = states.groupBy(*marts.DAY.group).agg(
        marts.all_plays().alias("total_plays"),
        marts.distinct("track").alias("unique_tracks"),
        marts.distinct("artist").alias("unique_artists"),
        marts.distinct("album").alias("unique_albums"),
        marts.distinct("genre").alias("unique_genres"),
        marts.distinct("play").alias("_keys"),
        marts.bits("all").alias("listening_sessions"),
        best.alias("top_genre"),
        *[marts.measure(name) for name in marts.DAY.measures],
    )
    track_avg, artist_avg = marts.average("track_popularity"), marts.average("artist_popularity")
    plays = F.col("total_plays")
    return days.select(
        "local_date",
        F.dayname("local_date").alias("day_of_week"),
        "is_weekend",
        F.monthname("local_date").alias("month_name"),
        F.col("local_quarter").alias("quarter"),
        F.col("local_year").alias("year"),
        "total_plays",
        "unique_tracks",
        "unique_artists",
        "unique_albums",
        "unique_genres",
        half_up(F.col("hundredths") / 100, 2).alias("total_listening_minutes"),
        minutes_per_play().alias("average_track_length_minutes"),
        "top_genre",
        pct_ratio(F.col("unique_genres"), plays).alias("genre_diversity_score"),
        share(F.col("multi_genre"), plays, 1).alias("multi_genre_artist_percentage"),
        F.col("unique_artists").alias("new_artists_discovered"),
        F.col("unique_tracks").alias("new_tracks_discovered"),
        share(plays - keys, plays, 1).alias("repeat_play_percentage"),
        share(F.col("from_playlist"), plays, 1).alias("playlist_play_percentage"),
        share(F.col("from_album"), plays, 1).alias("album_play_percentage"),
        share(F.col("from_artist"), plays, 1).alias("artist_play_percentage"),
        half_up(track_avg, 1).alias("average_track_popularity"),
        half_up(artist_avg, 1).alias("average_artist_popularity"),
        half_up((track_avg + artist_avg) / 2, 1).alias("mainstream_score"),
        half_up(marts.average("hour"), 0).alias("average_listening_hour"),
        "listening_sessions",
        "last_updated",
    )


def top_artist_per_genre(silver: DataFrame) -> DataFrame:
    plays = silver.filter(F.col("primary_genre").isNotNull())
    return most_frequent(plays, ["primary_genre"], "primary_artist_name", "top_artist_plays").select(
        "primary_genre", F.col("primary_artist_name").alias("top_artist"), "top_artist_plays"
    )


def top_track_per_genre(silver: DataFrame) -> DataFrame:
    plays = silver.filter(F.col("primary_genre").isNotNull())
    return most_frequent(plays, ["primary_genre"], "track_name", "top_track_plays").select(
        "primary_genre", F.col("track_name").alias("top_track"), "top_track_plays"
    )


def genre_analysis(silver: DataFrame, day_label: str = "min") -> DataFrame:
    """Genre totals, rank and share, with the genre's most played artist, from one pass.

    ``day_label="min"`` takes the alphabetically first day part and weekday, ``"mode"`` the
    most frequent ones.
    """
    mart = marts.GENRE if day_label == "min" else marts.GENRE_WITH_DAYS
    return ranked_genres(genre_rows(mart.states(silver), day_label))


def genre_rows(states: DataFrame, day_label: str = "min") -> DataFrame:
    """Totals and top artist of every genre from merged states of ``marts.GENRE``."""
    if day_label == "mode":
        part, weekday = (marts.most_played(k)["value"] for k in ("day_part_name", "weekday_name"))
        labels = [part.alias("primary_time_of_day"), weekday.alias("primary_day_of_week")]
    else:
        labels = [
            marts.named(marts.DAY_PARTS, marts.measure("day_part")).alias("primary_time_of_day"),
            marts.named(marts.WEEKDAYS, marts.measure("weekday")).alias("primary_day_of_week"),
        ]
    genres = states.groupBy("primary_genre").agg(
        marts.all_plays().alias("total_plays"),
        marts.distinct("artist").alias("unique_artists"),
        marts.distinct("track").alias("unique_tracks"),
        marts.bits("month").alias("days_active"),
        marts.most_played("artist_name", nulls=True).alias("_artist"),
        *labels,
        *[marts.measure(name) for name in marts.GENRE.measures],
    )
    return genres.select(
        "primary_genre",
        "total_plays",
        "unique_artists",
        "unique_tracks",
        half_up(F.col("hundredths") / 100, 2).alias("total_listening_minutes"),
        half_up(marts.average("artist_popularity"), 1).alias("average_artist_popularity"),
        half_up(marts.average("artist_followers"), 0).alias("average_artist_followers"),
        "primary_time_of_day",
        "primary_day_of_week",
        half_up(marts.average("hour"), 0).alias("average_listening_hour"),
        "first_discovered",
        "last_played",
        "days_active",
        minutes_per_play().alias("average_track_duration_minutes"),
        half_up(marts.average("track_popularity"), 1).alias("average_track_popularity"),
        share(F.col("explicit"), F.col("total_plays"), 1).alias("explicit_content_percentage"),
        "last_updated",
        F.col("_artist.value").alias("top_artist"),
        (-F.col("_artist.n")).alias("top_artist_plays"),
    )


def ranked_genres(genres: DataFrame) -> DataFrame:
    """Rank and share of every genre; a row per genre meets in one task."""
    order = W.orderBy(F.desc("total_plays"), "primary_genre")
    all_plays = F.sum("total_plays").over(all_rows())
    tops = ["top_artist", "top_artist_plays"]
    return genres.select(
        *[name for name in genres.columns if name not in tops],
        F.row_number().over(order).alias("genre_rank"),
        share(F.col("total_plays"), all_plays).alias("percentage_of_total_listening"),
        *tops,
    )


def month_rows(states: DataFrame) -> DataFrame:
    """Totals and top items of every month from merged states of ``marts.MONTH``."""
    tops = {"top_artist": ("artist_name", True), "top_genre": ("genre", False), "top_track": ("track_name", True)}
    months = states.groupBy(*marts.MONTH.group).agg(
        marts.all_plays().alias("total_plays"),
        marts.distinct("artist").alias("unique_artists"),
        marts.distinct("genre").alias("unique_genres"),
        marts.bits("all").alias("_days"),
        *[marts.most_played(kind, nulls).alias(name) for name, (kind, nulls) in tops.items()],
        *[marts.measure(name) for name in marts.MONTH.measures],
    )
    best = []
    for name in tops:
        best.append(F.col(name)["value"].alias(name))
        best.append((-F.col(name)["n"]).alias(f"{name}_plays"))
    return months.select(
        *marts.MONTH.group,
        "total_plays",
        half_up(F.col("hundredths") / 6000, 2).alias("total_listening_hours"),
        half_up(F.try_divide(F.col("total_plays"), F.col("_days")), 2).alias("daily_average_plays"),
        "unique_artists",
        "unique_genres",
        share(F.col("weekend"), F.col("total_plays"), 1).alias("weekend_listening_percentage"),
        marts.named(marts.DAY_PARTS, F.col("day_part")).alias("primary_time_of_day"),
        half_up(marts.average("track_popularity"), 1).alias("average_track_popularity"),
        "last_updated",
        *best,
    )


def growth(value: str, previous: Column) -> Column:
    return half_up(F.try_divide(F.lit(100.0) * (F.col(value) - previous), previous), 2)


def monthly_insights(silver: DataFrame) -> DataFrame:
    """Monthly totals, growth against the previous row, and the month's top items.

    ``average_session_length_minutes`` is listening time over plays. One pass over the plays.
    """
    return grown_months(month_rows(marts.MONTH.states(silver)))


def grown_months(months: DataFrame) -> DataFrame:
    """Rates and growth of every month; a row per month meets in one task."""
    by_month = W.orderBy("local_year", "local_month")
    months = months.withColumns(
        {
            "artist_discovery_rate": pct_ratio(F.col("unique_artists"), F.col("total_plays")),
            "genre_diversity_score": pct_ratio(F.col("unique_genres"), F.col("total_plays")),
            "mainstream_tendency": tiers.mainstream_tendency(F.col("average_track_popularity")),
            "average_session_length_minutes": half_up(
                F.col("total_listening_hours") * 60 / F.col("total_plays"), 2
            ),
            "plays_growth_rate": growth("total_plays", F.lag("total_plays").over(by_month)),
            "artist_discovery_growth": growth(
                "unique_artists", F.lag("unique_artists").over(by_month)
            ),
        }
    )
    return months.select(
        F.col("local_year").alias("year"),
        F.col("local_month").alias("month"),
        F.monthname(F.make_date("local_year", "local_month", F.lit(1))).alias("month_name"),
        F.col("local_quarter").alias("quarter"),
        "total_plays",
        "total_listening_hours",
        "daily_average_plays",
        "unique_artists",
        "unique_genres",
        "artist_discovery_rate",
        "genre_diversity_score",
        "weekend_listening_percentage",
        "primary_time_of_day",
        "average_session_length_minutes",
        "average_track_popularity",
        "mainstream_tendency",
        "plays_growth_rate",
        "artist_discovery_growth",
        "top_artist",
        "top_artist_plays",
        "top_genre",
        "top_genre_plays",
        "top_track",
        "top_track_plays",
        "last_updated",
    )


def current_month(monthly: DataFrame, as_of: Column) -> DataFrame:
    """The monthly row of the month of ``as_of``."""
    return monthly.filter((F.col("year") == F.year(as_of)) & (F.col("month") == F.month(as_of)))


def recent_activity(silver: DataFrame, as_of: Column, days: int = 7, n: int = 100) -> DataFrame:
    recent = silver.filter(since(F.col("local_date"), as_of, days))
    return top_n(recent, [F.desc("local_timestamp"), F.col("unique_play")], n).select(
        "unique_play",
        "local_timestamp",
        "track_name",
        "primary_artist_name",
        "primary_genre",
        "album_name",
        "time_of_day_category",
        "listening_source",
    )


def monthly_discoveries(silver: DataFrame, as_of: Column) -> DataFrame:
    """Artists first heard in the month of ``as_of``.

    An artist is new when none of its plays is older; one aggregate per artist answers that
    without joining the plays to themselves.
    """
    start = F.trunc(as_of, "month")
    this_month = F.col("local_date") >= start
    return (
        silver.filter(F.col("primary_artist_id").isNotNull())
        .groupBy("primary_artist_id", "primary_artist_name", "primary_genre")
        .agg(
            F.count_if(this_month).alias("plays_this_month"),
            F.min("local_timestamp").alias("first_played"),
            F.max("local_timestamp").alias("last_played"),
        )
        .withColumn(
            "_first", F.min("first_played").over(W.partitionBy("primary_artist_id"))
        )
        .filter((F.to_date("_first") >= start) & (F.col("plays_this_month") > 0))
        .groupBy("primary_artist_name", "primary_genre")
        .agg(
            F.sum("plays_this_month").alias("plays_this_month"),
            F.min("first_played").alias("first_played"),
            F.max("last_played").alias("last_played"),
        )
    )


def genre_timeline(silver: DataFrame, as_of: Column, months: int = 6) -> DataFrame:
    """Plays per day and genre and the genre's share of the day."""
    recent = silver.filter(
        (F.col("local_date") >= F.add_months(as_of, -months)) & F.col("primary_genre").isNotNull()
    )
    day = W.partitionBy("local_date")
    return (
        recent.groupBy("local_date", "primary_genre")
        .agg(F.count("*").alias("daily_plays"))
        .withColumn(
            "daily_genre_percentage", share(F.col("daily_plays"), F.sum("daily_plays").over(day))
        )
    )


# ---------------------------------------------------------------------------
# summaries of the raw plays, in UTC


def raw_daily_summary(plays: DataFrame) -> DataFrame:
    days = plays.groupBy("played_at_date").agg(
        F.count("*").alias("total_tracks"),
        F.countDistinct("track_id").alias("unique_tracks"),
        F.countDistinct("primary_artist_name").alias("unique_artists"),
        F.countDistinct("album_id").alias("unique_albums"),
        (F.sum("track_duration_ms") / 1000 / 60).alias("total_minutes_listened"),
        (F.avg("track_duration_ms") / 1000).alias("avg_track_length_seconds"),
    )
    named = plays.filter(F.col("primary_artist_name").isNotNull())
    best = most_frequent(named, ["played_at_date"], "primary_artist_name").select(
        "played_at_date", F.col("primary_artist_name").alias("most_played_artist")
    )
    return days.join(best, "played_at_date", "left")


def artist_stats(plays: DataFrame, artists: DataFrame) -> DataFrame:
    """Plays per artist name and id with the artist's genres; plays are summed first."""
    totals = (
        plays.filter(F.col("primary_artist_name").isNotNull())
        .groupBy("primary_artist_name", "primary_artist_id")
        .agg(
            F.count("*").alias("total_plays"),
            F.countDistinct("track_id").alias("unique_tracks"),
            F.countDistinct("album_id").alias("unique_albums"),
            (F.sum("track_duration_ms") / 1000 / 60).alias("total_minutes"),
            F.avg("track_popularity").alias("avg_track_popularity"),
            F.min("played_at").alias("first_played"),
            F.max("played_at").alias("last_played"),
        )
    )
    dim = artists.select(
        F.col("artist_id").alias("primary_artist_id"),
        "primary_genre",
        "genres_list",
        "genre_count",
        F.col("popularity").alias("artist_popularity"),
        "followers_total",
    )
    return totals.join(dim, "primary_artist_id", "left")


def genre_listening(plays_with_artist: DataFrame) -> DataFrame:
    """Genre totals of plays already joined to their artist (inner)."""
    return (
        plays_with_artist.filter(F.col("primary_genre").isNotNull())
        .groupBy("primary_genre")
        .agg(
            F.countDistinct("primary_artist_id").alias("unique_artists"),
            F.count("*").alias("total_plays"),
            F.countDistinct("track_id").alias("unique_tracks"),
            (F.sum("track_duration_ms") / 1000 / 60).alias("total_minutes"),
            F.avg("track_popularity").alias("avg_track_popularity"),
            F.avg("artist_popularity").alias("avg_artist_popularity"),
            F.avg("artist_followers").alias("avg_artist_followers"),
        )
    )


def hourly_patterns(plays: DataFrame) -> DataFrame:
    days = F.countDistinct("played_at_date")
    return plays.groupBy("played_at_hour").agg(
        F.count("*").alias("total_tracks"),
        (F.avg("track_duration_ms") / 1000 / 60).alias("avg_minutes_per_hour"),
        days.alias("days_active"),
        half_up(F.count("*") / days, 2).alias("avg_tracks_per_day"),
    )


def listening_context(plays: DataFrame) -> DataFrame:
    contexts = (
        plays.filter(F.col("context_type").isNotNull())
        .groupBy("context_type")
        .agg(
            F.count("*").alias("total_plays"),
            F.countDistinct("track_id").alias("unique_tracks"),
            (F.sum("track_duration_ms") / 1000 / 60).alias("total_minutes"),
        )
    )
    return contexts.withColumn(
        "percentage_of_listening",
        share(F.col("total_plays"), F.sum("total_plays").over(all_rows())),
    )


# ---------------------------------------------------------------------------
# dashboard group-bys


def weekday_average(daily: DataFrame) -> DataFrame:
    return daily.groupBy("day_of_week").agg(F.avg("total_plays").alias("average_plays"))


def plays_by(silver: DataFrame, *keys: str) -> DataFrame:
    return silver.groupBy(*keys).agg(F.count("*").alias("plays"))


def filtered_genre_stats(detail: DataFrame) -> DataFrame:
    """Genre stats recomputed on already filtered detail rows."""
    genres = (
        detail.filter(F.col("primary_genre").isNotNull())
        .groupBy("primary_genre")
        .agg(
            F.count("track_name").alias("total_plays"),
            F.countDistinct("primary_artist_name").alias("unique_artists"),
            minutes_total().alias("total_listening_minutes"),
        )
    )
    return genres.withColumn(
        "percentage_of_total_listening",
        share(F.col("total_plays"), F.sum("total_plays").over(all_rows())),
    )


def utc_hour_offsets(plays: DataFrame, n: int = 5) -> DataFrame:
    """Latest plays with their UTC hour, local hour and the difference."""
    latest = top_n(plays, [F.desc("played_at"), F.col("unique_play")], n)
    local = add_local_time(latest)
    return local.select(
        "unique_play",
        F.col("played_at").alias("utc_timestamp"),
        "local_timestamp",
        F.hour("played_at").alias("utc_hour"),
        "local_hour",
        (F.col("local_hour") - F.hour("played_at")).alias("hour_offset"),
    )
