"""Buckets and labels of tracks: era, popularity, duration, reasons, links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spinledger.params import TRACK_LINK_PREFIX


def steps(value: Column, bounds: list[tuple[float, object]], otherwise: object) -> Column:
    """Label of the first bound that ``value`` reaches; bounds go from high to low."""
    (first, label), rest = bounds[0], bounds[1:]
    out = F.when(value >= first, label)
    for bound, name in rest:
        out = out.when(value >= bound, name)
    return out.otherwise(otherwise)


# Lower bound and label.
ERAS = [(2020, "current"), (2015, "recent"), (2010, "2010s"), (2000, "2000s"), (1990, "90s")]
POPULARITY_TIERS = [(80, 4), (60, 3), (40, 2), (20, 1)]
DURATION_BUCKETS = [(420000, 5), (300000, 4), (240000, 3), (180000, 2), (120000, 1)]
SHORT_LABELS = [(80, "Mainstream Hit"), (60, "Popular"), (40, "Rising"), (20, "Hidden Gem")]
LONG_LABELS = [
    (80, "Mainstream Hit"),
    (60, "Popular Track"),
    (40, "Rising Track"),
    (20, "Hidden Gem"),
]
PREFERENCE_STRENGTHS = [(50, "high"), (20, "medium"), (10, "low")]
SAFE_SCORES = [(80, 0.9), (60, 0.7), (40, 0.5), (20, 0.3)]


def era(year: Column) -> Column:
    return steps(year, ERAS, "classic")


def popularity_tier(popularity: Column) -> Column:
    return steps(popularity, POPULARITY_TIERS, 0)


def duration_bucket(ms: Column) -> Column:
    # a missing duration lands in the longest bucket, as the comparison chain falls through
    return F.when(ms.isNull(), 5).otherwise(steps(ms, DURATION_BUCKETS, 0))


def popularity_label(popularity: Column, wording: str = "short") -> Column:
    if wording == "short":
        return steps(popularity, SHORT_LABELS, "Deep Cut")
    return steps(popularity, LONG_LABELS, "Deep Cut Discovery")


def preference_strength(plays: Column) -> Column:
    return steps(plays, PREFERENCE_STRENGTHS, "minimal")


def mainstream_tendency(popularity: Column) -> Column:
    return (
        F.when(popularity > 70, "High Mainstream")
        .when(popularity > 50, "Moderate Mainstream")
        .otherwise("Underground/Niche")
    )


def track_link(track_id: Column, prefix: str = TRACK_LINK_PREFIX) -> Column:
    return F.concat(F.lit(prefix), track_id)


def reason_by_strategies(strategies: Column) -> Column:
    """Human reason from the comma-joined names of the strategies that agree."""
    has = strategies.contains
    return (
        F.when(
            has("collaborative") & has("content"),
            "Multiple algorithms agree this matches your taste",
        )
        .when(has("collaborative"), "People with similar taste also enjoy this")
        .when(has("content"), "Similar to tracks you already love")
        .when(has("temporal"), "Perfect for this time of day")
        .when(has("discovery"), "Discover something new you might love")
        .otherwise("Recommended based on your listening patterns")
    )


# Reasons shown by the short and the full hybrid.
AGREED_REASON = "Multiple algorithms agree this matches your taste"
SHORT_CONTENT_REASON = "Similar to tracks you already love"
DEFAULT_REASON = "ML-powered personalized recommendation"
MANY_REASON = "Multiple ML algorithms strongly recommend this track"
TWO_REASON = "Two ML algorithms agree this matches your taste"
SINGLE_STRATEGY_REASONS = {
    "collaborative_filtering": "Users with similar taste love this track",
    "content_based_filtering": "Similar musical characteristics to your favorites",
    "temporal_patterns": "Perfect timing based on your listening patterns",
    "discovery_exploration": "Algorithmic discovery - expanding your musical horizons",
}


def reason_by_support(support: Column, strategies: Column) -> Column:
    out = F.when(support >= 3, MANY_REASON).when(support == 2, TWO_REASON)
    for name, text in SINGLE_STRATEGY_REASONS.items():
        out = out.when(strategies == name, text)
    return out.otherwise(DEFAULT_REASON)


def confidence_by_support(support: Column) -> Column:
    return (
        F.when(support >= 3, "High Confidence")
        .when(support == 2, "Medium Confidence")
        .otherwise("Single Algorithm")
    )
