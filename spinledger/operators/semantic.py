"""Named dimensions and measures over the layers, and the questions built on them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinledger.functions.joins import join_dimension, salted_dimension_join
from spinledger.functions.ranking import top_n

AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum,
    "avg": F.avg,
    "count": F.count,
    "count_distinct": F.countDistinct,
}


@dataclass(frozen=True)
class Entity:
    """A table of the model: dimension name to expression, measure name to (expression, kind)."""

    table: str
    key: Sequence[str]
    dimensions: Mapping[str, str]
    measures: Mapping[str, tuple[str, str]] = field(default_factory=dict)

    def aggregate(self, df: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
        """``measures`` of the table grouped by the named dimensions."""
        keys = [F.expr(self.dimensions[name]).alias(name) for name in by]
        values = []
        for name in measures:
            expression, kind = self.measures[name]
            values.append(AGGREGATES[kind](F.expr(expression)).alias(name))
        return df.groupBy(*keys).agg(*values)


def same(*names: str) -> dict[str, str]:
    return {name: name for name in names}


MODEL = {
    entity.table: entity
    for entity in (
        Entity(
            "silver_plays",
            ["unique_play"],
            {
                **same(
                    "unique_play", "local_date", "local_hour", "local_year", "local_month",
                    "local_quarter", "is_weekend", "time_of_day_category", "track_name",
                    "track_explicit", "track_id", "primary_artist_name", "primary_artist_id",
                    "primary_genre", "is_multi_genre_artist", "album_name", "album_type",
                    "album_release_year", "is_single", "listening_source",
                ),
                "day_of_week": "dayname(local_timestamp)",
            },
            {
                "total_plays": ("unique_play", "count"),
                "total_listening_minutes": ("track_duration_minutes", "sum"),
                "average_track_length": ("track_duration_minutes", "avg"),
                "average_track_popularity": ("track_popularity", "avg"),
                "average_artist_popularity": ("artist_popularity", "avg"),
                "mainstream_score": ("(track_popularity + artist_popularity) / 2", "avg"),
                "unique_artists": ("primary_artist_id", "count_distinct"),
                "unique_tracks": ("track_id", "count_distinct"),
                "unique_genres": ("primary_genre", "count_distinct"),
                "unique_albums": ("album_id", "count_distinct"),
                "average_artist_followers": ("artist_followers", "avg"),
            },
        ),
        Entity(
            "daily_summary",
            ["local_date"],
            same(
                "local_date", "day_of_week", "is_weekend", "month_name", "quarter", "year",
            ),
            {
                "daily_total_plays": ("total_plays", "sum"),
                "daily_unique_tracks": ("unique_tracks", "sum"),
                "daily_unique_artists": ("unique_artists", "sum"),
                "daily_listening_minutes": ("total_listening_minutes", "sum"),
                "daily_genre_diversity_score": ("genre_diversity_score", "avg"),
                "daily_mainstream_score": ("mainstream_score", "avg"),
            },
        ),
        Entity(
            "genre_analysis",
            ["primary_genre"],
            same(
                "primary_genre", "top_artist",
            ),
            {
                "genre_total_plays": ("total_plays", "sum"),
                "genre_unique_artists": ("unique_artists", "sum"),
                "genre_listening_minutes": ("total_listening_minutes", "sum"),
                "genre_percentage_of_listening": ("percentage_of_total_listening", "avg"),
                "top_artist_plays": ("top_artist_plays", "sum"),
            },
        ),
        Entity(
            "monthly_insights",
            ["year", "month"],
            same(
                "year", "month", "month_name", "quarter", "top_artist", "top_genre", "top_track",
                "mainstream_tendency",
            ),
            {
                "monthly_total_plays": ("total_plays", "sum"),
                "monthly_listening_hours": ("total_listening_hours", "sum"),
                "monthly_unique_artists": ("unique_artists", "sum"),
                "artist_discovery_rate": ("artist_discovery_rate", "avg"),
                "plays_growth_rate": ("plays_growth_rate", "avg"),
            },
        ),
        Entity(
            "artist_summary",
            ["artist_id"],
            same(
                "artist_id", "artist_name", "primary_genre", "is_multi_genre_artist",
                "first_listened", "last_listened",
            ),
            {
                "artist_total_plays": ("total_plays", "sum"),
                "artist_listening_minutes": ("total_listening_minutes", "sum"),
                "artist_unique_tracks": ("unique_tracks_played", "sum"),
                "artist_popularity": ("artist_popularity", "avg"),
            },
        ),
    )
}

# Named metrics: table and measure they stand for.
METRICS = {
    "listening_volume": ("silver_plays", "total_plays"),
    "musical_diversity": ("silver_plays", "unique_artists"),
    "mainstream_indicators": ("silver_plays", "mainstream_score"),
}


def measure(
    tables: Mapping[str, DataFrame], table: str, by: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    return MODEL[table].aggregate(tables[table], by, measures)


def metric(tables: Mapping[str, DataFrame], name: str, by: Sequence[str] = ()) -> DataFrame:
    table, value = METRICS[name]
    return MODEL[table].aggregate(tables[table], by, [value]).withColumnRenamed(value, name)


def with_daily_summary(silver: DataFrame, daily: DataFrame, *columns: str) -> DataFrame:
    """Plays with columns of their day (many to one)."""
    days = daily.select("local_date", *[F.col(c).alias(f"daily_{c}") for c in columns])
    return join_dimension(silver, days, "local_date", "left")


def with_artist_summary(silver: DataFrame, artists: DataFrame, *columns: str) -> DataFrame:
    """Plays with columns of their artist (many to one)."""
    dim = artists.select("artist_id", *[F.col(c).alias(f"artist_{c}") for c in columns])
    return salted_dimension_join(
        silver, dim, "primary_artist_id", "artist_id", ["unique_play"]
    ).drop("artist_id")


# ---------------------------------------------------------------------------
# questions with a known answer


def plays_yesterday(daily: DataFrame, as_of: Column) -> DataFrame:
    day = daily.filter(F.col("local_date") == F.date_sub(as_of, 1))
    return MODEL["daily_summary"].aggregate(day, [], ["daily_total_plays"])


def most_played_genre(genres: DataFrame) -> DataFrame:
    totals = MODEL["genre_analysis"].aggregate(genres, ["primary_genre"], ["genre_total_plays"])
    return top_n(totals, [F.desc("genre_total_plays"), F.col("primary_genre")], 1)


def top_artist_in_genre(genres: DataFrame, genre: str) -> DataFrame:
    rows = genres.filter(F.col("primary_genre") == genre)
    return MODEL["genre_analysis"].aggregate(rows, ["top_artist"], ["top_artist_plays"])


def last_months(monthly: DataFrame, as_of: Column, n: int = 3) -> DataFrame:
    rows = monthly.filter(F.col("year") == F.year(as_of))
    totals = MODEL["monthly_insights"].aggregate(
        rows, ["year", "month", "month_name"], ["monthly_total_plays", "plays_growth_rate"]
    )
    return top_n(totals, [F.desc("year"), F.desc("month")], n).drop("year", "month")
