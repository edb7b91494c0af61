"""Local-time and calendar expressions.

Weekdays are numbered 0=Sunday ... 6=Saturday, weekend is Saturday and Sunday.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinledger.params import LOCAL_TZ


def to_local(ts: Column, tz: str = LOCAL_TZ) -> Column:
    """Wall-clock time in ``tz`` of a zone-less UTC timestamp."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), ts.cast("timestamp_ntz"))


def weekday0(ts: Column) -> Column:
    return F.dayofweek(ts) - 1


def is_weekend(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7)


def day_part(hour: Column) -> Column:
    return (
        F.when(hour.between(6, 11), "Morning")
        .when(hour.between(12, 17), "Afternoon")
        .when(hour.between(18, 21), "Evening")
        .otherwise("Night")
    )


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a zone-less timestamp, independent of the session zone."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def hour_bucket(ts: Column) -> Column:
    """Number of the one-hour session bucket a zone-less timestamp falls into."""
    return F.floor(epoch_seconds(ts) / 3600)


def add_local_time(df: DataFrame, ts: str = "played_at", tz: str = LOCAL_TZ) -> DataFrame:
    """Append the local timestamp and its calendar parts."""
    local = F.col("local_timestamp")
    return df.withColumn("local_timestamp", to_local(F.col(ts), tz)).withColumns(
        {
            "local_date": F.to_date(local),
            "local_hour": F.hour(local),
            "local_day_of_week": weekday0(local),
            "local_month": F.month(local),
            "local_year": F.year(local),
            "local_quarter": F.quarter(local),
            "is_weekend": is_weekend(local),
            "time_of_day_category": day_part(F.hour(local)),
        }
    )


def release_date(text: Column) -> Column:
    """Date of ``YYYY-MM-DD`` or ``YYYY`` text; a bare year is its first of January."""
    return F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), F.try_to_date(text, "yyyy"))


def release_year(text: Column, default: int | None = 2000) -> Column:
    """Year of a release-date text, tolerant of bad input."""
    found = F.coalesce(
        F.substring(text, 1, 4).try_cast("int"), F.year(F.try_to_date(text, "yyyy-MM-dd"))
    )
    return found if default is None else F.coalesce(found, F.lit(default))


def since(date: Column, as_of: Column, days: int) -> Column:
    """Predicate: ``date`` is at most ``days`` days before ``as_of``."""
    return date >= F.date_sub(as_of, days)


def as_of_date(df: DataFrame, date: str = "local_date") -> Column:
    """Latest date in the data, as a scalar subquery."""
    return df.agg(F.max(date)).scalar()
