"""Constants that are part of the query semantics."""

LOCAL_TZ = "America/Denver"

# look-back windows in days
GENRE_WINDOW = 180
TRACK_WINDOW = 90
FEED_WINDOW = 7
RECENT_DAYS = 30
VERY_RECENT_DAYS = 7
DECAY_DAYS = 30.0

# fixed value: how many tracks of one genre enter the feature table
TRACKS_PER_GENRE = 50

# fixed values: strategy weights, and the score a row must exceed to enter the blend
HYBRID_WEIGHTS = {
    "collaborative_filtering": 0.40,
    "content_based_filtering": 0.30,
    "temporal_patterns": 0.20,
    "discovery_exploration": 0.10,
}
HYBRID_MIN_SCORES = {
    "collaborative_filtering": 0.3,
    "content_based_filtering": 0.4,
    "temporal_patterns": 0.3,
    "discovery_exploration": 0.5,
}

# The link in front of a track id is the caller's: pass the prefix of your player.
TRACK_LINK_PREFIX = "track/"
