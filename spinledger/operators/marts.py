"""Additive states of the summary marts: exact distinct counts and top items from one pass.

A mart groups plays (by day, month or genre), counts distinct values of several kinds and sums
measures. Instead of expanding every play once per distinct count, the plays are first summed
into cells, one per group and combination of values; a track played a thousand times in a month
is one cell of that month. The far fewer cells are then dealt out into states, rows

    group, kind, value, plays, mask, measures

one per value of every kind, and one of kind ``all`` with the group's measures. Distinct counts
are counts of state rows, top items their greatest plays. Days and hours are not values but bits
of ``mask``, as a group has few of them: 24 hours of a day, 31 days of a month.

All of it adds up: plays are summed, masks OR-ed, measures summed or reduced to the least or
greatest. So the states of a batch of new plays merge into stored states, and a stream keeps
exact distinct counts without reading a play twice (``streaming.ingest``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Day parts and weekdays, in alphabetical order.
DAY_PARTS = ["Afternoon", "Evening", "Morning", "Night"]
WEEKDAYS = ["Fri", "Mon", "Sat", "Sun", "Thu", "Tue", "Wed"]

SUM, LEAST, GREATEST = F.sum, F.min, F.max
# Track minutes in whole hundredths, whose sums don't depend on their order.
HUNDREDTHS = "CAST(round(track_duration_minutes * 100) AS bigint)"

#: Measures: SQL on a play, and how values are added up.
Measures = dict[str, tuple[str, Callable]]


def number_in(names: list[str], value: str) -> str:
    """Place of a name in a fixed list, from 1: least numbers are aggregated without a sort."""
    return f"array_position(array({', '.join(map(repr, names))}), {value})"


def named(names: list[str], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), number.cast("int"))


def bit(position: str) -> str:
    return f"shiftleft(1L, {position})"


def one_if(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1L ELSE 0L END"


def total(name: str, value: str | None = None) -> Measures:
    """Sum and count of a numeric column, from which its average follows."""
    value = value or name
    return {
        f"{name}_sum": (f"CAST({value} AS bigint)", SUM),
        f"{name}_known": (one_if(f"{value} IS NOT NULL"), SUM),
    }


def average(name: str) -> Column:
    return F.try_divide(F.col(f"{name}_sum").cast("double"), F.col(f"{name}_known"))


@dataclass(frozen=True)
class Mart:
    """What a mart groups by and counts, as SQL on a play; ``masked`` is the kind with the mask.

    ``summed`` is false where a kind tells the plays apart: then cells are plays, and summing them
    first would exchange every play once more for nothing.
    """

    group: tuple[str, ...]
    kinds: dict[str, str]
    mask: str
    masked: str
    measures: Measures
    keep: str = "true"
    summed: bool = True

    def merged(self, rows: DataFrame, keys: list[str]) -> DataFrame:
        """Rows with plays, mask and measures, added up per key."""
        return rows.groupBy(*keys).agg(
            F.sum("plays").alias("plays"),
            F.bit_or("mask").alias("mask"),
            *[merge(name).alias(name) for name, (_, merge) in self.measures.items()],
        )

    def cells(self, plays: DataFrame) -> DataFrame:
        rows = plays.filter(self.keep).selectExpr(
            *self.group,
            *[f"CAST({value} AS string) AS _{kind}" for kind, value in self.kinds.items()],
            "1L AS plays",
            f"{self.mask} AS mask",
            *[f"{value} AS {name}" for name, (value, _) in self.measures.items()],
        )
        if not self.summed:
            return rows
        return self.merged(rows, [*self.group, *[f"_{kind}" for kind in self.kinds]])

    def states(self, plays: DataFrame) -> DataFrame:
        """State rows of some plays."""
        nothing = F.lit(None).cast("string")
        kinds = [F.struct(F.lit("all").alias("kind"), nothing.alias("value"))] + [
            F.struct(F.lit(kind).alias("kind"), F.col(f"_{kind}").alias("value"))
            for kind in self.kinds
        ]
        rows = self.cells(plays).withColumn("_at", F.explode(F.array(*kinds)))
        whole, at = F.col("_at.kind") == "all", F.col("_at.kind").alias("kind")
        dealt = rows.select(
            *self.group,
            at,
            F.col("_at.value").alias("value"),
            "plays",
            F.when(F.col("_at.kind") == self.masked, F.col("mask")).alias("mask"),
            *[F.when(whole, F.col(name)).alias(name) for name in self.measures],
        )
        return self.merge(dealt)

    def merge(self, states: DataFrame) -> DataFrame:
        """State rows of several sources as one of each."""
        return self.merged(states, [*self.group, "kind", "value"])


def all_plays() -> Column:
    return F.max(F.when(F.col("kind") == "all", F.col("plays")))


def measure(name: str) -> Column:
    """A measure of the group, inside an aggregate over its state rows."""
    return F.max(F.when(F.col("kind") == "all", F.col(name))).alias(name)


def distinct(kind: str) -> Column:
    return F.count_if((F.col("kind") == kind) & F.col("value").isNotNull())


def bits(kind: str) -> Column:
    """Bits in the masks of a kind's rows; its values must have no bit in common."""
    return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bit_count("mask"))), F.lit(0)).cast("long")


def most_played(kind: str, nulls: bool = False) -> Column:
    """(plays, value) of the most played value, the smaller one on ties, null last."""
    mine = F.col("kind") == kind if nulls else (F.col("kind") == kind) & F.col("value").isNotNull()
    order = F.struct((-F.col("plays")).alias("n"), F.col("value").isNull().alias("unnamed"), "value")
    return F.min(F.when(mine, order))


DAY = Mart(
    group=("local_date", "is_weekend", "local_quarter", "local_year"),
    kinds={
        "track": "track_id",
        "artist": "primary_artist_id",
        "album": "album_id",
        "genre": "primary_genre",
    },
    mask=bit("hour(local_timestamp)"),
    masked="all",
    keep="local_date IS NOT NULL",
    measures={
        "hundredths": (HUNDREDTHS, SUM),
        "timed": (one_if("track_duration_minutes IS NOT NULL"), SUM),
        "multi_genre": (one_if("is_multi_genre_artist"), SUM),
        "from_playlist": (one_if("listening_source = 'playlist'"), SUM),
        "from_album": (one_if("listening_source = 'album'"), SUM),
        "from_artist": (one_if("listening_source = 'artist'"), SUM),
        **total("track_popularity"),
        **total("artist_popularity"),
        **total("hour", "local_hour"),
        "last_updated": ("ingested_at", GREATEST),
    },
)
#: For plays whose keys may repeat.
DAY_WITH_KEYS = replace(DAY, kinds=DAY.kinds | {"play": "unique_play"}, summed=False)

MONTH = Mart(
    group=("local_year", "local_month", "local_quarter"),
    kinds={
        "artist": "primary_artist_id",
        "genre": "primary_genre",
        "artist_name": "primary_artist_name",
        "track_name": "track_name",
    },
    mask=bit("dayofmonth(local_date)"),
    masked="all",
    measures={
        "hundredths": (HUNDREDTHS, SUM),
        "weekend": (one_if("is_weekend"), SUM),
        "day_part": (number_in(DAY_PARTS, "time_of_day_category"), LEAST),
        **total("track_popularity"),
        "last_updated": ("ingested_at", GREATEST),
    },
)

GENRE = Mart(
    group=("primary_genre",),
    kinds={
        "artist": "primary_artist_id",
        "track": "track_id",
        "artist_name": "primary_artist_name",
        "month": "trunc(local_date, 'month')",
    },
    mask=bit("dayofmonth(local_date)"),
    masked="month",
    keep="primary_genre IS NOT NULL",
    measures={
        "hundredths": (HUNDREDTHS, SUM),
        "timed": (one_if("track_duration_minutes IS NOT NULL"), SUM),
        **total("artist_popularity"),
        **total("artist_followers"),
        **total("track_popularity"),
        **total("hour", "local_hour"),
        "day_part": (number_in(DAY_PARTS, "time_of_day_category"), LEAST),
        "weekday": (number_in(WEEKDAYS, "dayname(local_timestamp)"), LEAST),
        "explicit": (one_if("track_explicit"), SUM),
        "first_discovered": ("local_timestamp", LEAST),
        "last_played": ("local_timestamp", GREATEST),
        "last_updated": ("ingested_at", GREATEST),
    },
)
#: With the counts of day parts and weekdays, for their most frequent ones.
GENRE_WITH_DAYS = replace(
    GENRE,
    kinds=GENRE.kinds
    | {"day_part_name": "time_of_day_category", "weekday_name": "dayname(local_timestamp)"},
)
