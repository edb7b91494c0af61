"""Explicit schemas of every landed input; production reads never infer."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I = T.StringType(), T.LongType(), T.IntegerType()
_D, _B, _TS = T.DoubleType(), T.BooleanType(), T.TimestampNTZType()
_URLS = T.MapType(_S, _S)
_IMAGES = T.ArrayType(
    T.StructType(
        [T.StructField("url", _S), T.StructField("height", _I), T.StructField("width", _I)]
    )
)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# One nested object per play, as the player's history endpoint returns it.
RAW_PLAY = struct(
    played_at=_S,
    track=struct(
        id=_S,
        name=_S,
        duration_ms=_L,
        popularity=_I,
        explicit=_B,
        preview_url=_S,
        uri=_S,
        external_urls=_URLS,
        artists=T.ArrayType(struct(id=_S, name=_S, uri=_S, external_urls=_URLS)),
        album=struct(
            id=_S, name=_S, album_type=_S, release_date=_S, total_tracks=_I, images=_IMAGES
        ),
    ),
    context=struct(type=_S, uri=_S, external_urls=_URLS),
)

# One nested object per artist.
RAW_ARTIST = struct(
    id=_S,
    name=_S,
    uri=_S,
    genres=T.ArrayType(_S),
    popularity=_I,
    followers=struct(total=_L),
    external_urls=_URLS,
    images=_IMAGES,
)

# Flattened play row of the landing files.
PLAY = struct(
    played_at=_TS,
    played_at_timestamp=_L,
    played_at_date=T.DateType(),
    played_at_hour=_I,
    track_id=_S,
    track_name=_S,
    track_duration_ms=_L,
    track_popularity=_I,
    track_explicit=_B,
    track_preview_url=_S,
    track_external_urls=_S,
    artists=_S,
    primary_artist_id=_S,
    primary_artist_name=_S,
    album_id=_S,
    album_name=_S,
    album_type=_S,
    album_release_date=_S,
    album_total_tracks=_I,
    album_images=_S,
    context_type=_S,
    context_uri=_S,
    context_external_urls=_S,
    track_uri=_S,
    ingested_at=_TS,
    data_source=_S,
)

ARTIST = struct(
    artist_id=_S,
    artist_name=_S,
    artist_uri=_S,
    genres=_S,
    genres_list=T.ArrayType(_S),
    primary_genre=_S,
    genre_count=_I,
    popularity=_I,
    followers_total=_L,
    external_urls=_S,
    images=_S,
    ingested_at=_TS,
    data_source=_S,
)

# Landed feed rows carry text where the table wants dates and times; see sources.landing.
DISCOVERY_TEXT = struct(
    track_id=_S,
    track_name=_S,
    primary_artist_name=_S,
    primary_artist_id=_S,
    album_name=_S,
    album_release_date=_S,
    track_popularity=_S,
    track_duration_ms=_S,
    preview_url=_S,
    discovery_strategy=_S,
    seed_artist=_S,
    seed_genre=_S,
    preference_score=_S,
    discovered_at=_S,
    batch_timestamp=_S,
)

ML_DISCOVERY_TEXT = struct(
    track_id=_S,
    track_name=_S,
    primary_artist_name=_S,
    primary_artist_id=_S,
    album_name=_S,
    album_release_date=_S,
    track_popularity=_S,
    track_duration_ms=_S,
    preview_url=_S,
    discovery_strategy=_S,
    ml_recommendation_score=_S,
    ml_strategies_used=_S,
    ml_weighted_score=_S,
    seed_track=_S,
    seed_genre=_S,
    genre_novelty_score=_S,
    artist_novelty_score=_S,
    discovered_at=_S,
    batch_timestamp=_S,
)

DEPLOYMENT_LOG = struct(
    model_name=_S,
    version=_S,
    deployment_environment=_S,
    deployment_timestamp=_TS,
    deployment_status=_S,
    previous_version=_S,
    rollback_available=_B,
)

TRAINING_LOG = struct(
    model_name=_S,
    version=_S,
    training_timestamp=_TS,
    trigger_reason=_S,
    overall_performance=_D,
    training_completed=_B,
    training_duration_seconds=_L,
    error_message=_S,
)

ALERT_LOG = struct(
    alert_timestamp=_TS,
    model_name=_S,
    alert_type=_S,
    severity=_S,
    message=_S,
    performance_score=_D,
    threshold=_D,
    alert_channel=_S,
)
