"""Genre co-occurrence and artist similarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spinledger.functions.joins import join_dimension
from spinledger.functions.ranking import ensure_checkpoint_dir, rank_in_group, top_per_group
from spinledger.functions.timeparts import hour_bucket, since
from spinledger.params import TRACK_WINDOW


def genre_sessions(silver: DataFrame, as_of: Column, window: int = TRACK_WINDOW) -> DataFrame:
    """Plays per session and genre; a session is a clock hour."""
    recent = silver.filter(
        since(F.col("local_date"), as_of, window) & F.col("primary_genre").isNotNull()
    )
    session = hour_bucket(F.col("local_timestamp"))
    return recent.groupBy(session.alias("session_id"), "primary_genre").agg(
        F.count("*").alias("tracks_in_session")
    )


SESSION_BLOCK = 4096


def merged_runs(runs: DataFrame, keys: list[str], gap: Column) -> DataFrame:
    """Runs (_first, _last, _n) of the same keys joined where one starts within ``gap`` of another.

    The window meets the runs of one key in one task: ``keys`` must bound how many there are.
    """
    in_order = W.partitionBy(*keys).orderBy("_first")
    fresh = F.coalesce(F.col("_first") - F.lag("_last").over(in_order) >= gap, F.lit(True))
    return (
        runs.withColumn("_fresh", fresh.cast("int"))
        .withColumn("_run", F.sum("_fresh").over(in_order))
        .groupBy(*keys, "_run")
        .agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.sum("_n").alias("_n"))
        .drop("_run")
    )


def gap_sessions(
    plays: DataFrame,
    gap: str = "60 minutes",
    user: str = "user_id",
    ts: str = "played_at",
    block: int = SESSION_BLOCK,
) -> DataFrame:
    """Start, last second and plays of every run of a user's plays paused less than ``gap``.

    ``gap`` is a number of whole seconds. Plays that share a slot of the clock as long as the gap
    lie in one run, so map tasks add up plays per user and slot, and a user's plays never meet.
    Slots are merged inside blocks of ``block`` slots; only runs that touch the border of
    their block are merged once more per user, two rows a block at most. What one task holds of a
    user therefore follows the length of the history, 1/``block`` of its slots, not the plays. Plays
    without a time are left out; plays without a user are one user's.
    """
    zero = "TIMESTAMP'1970-01-01 00:00:00'"
    length = F.expr(f"timestampdiff(SECOND, {zero}, {zero} + INTERVAL {gap})")
    at = F.unix_seconds(F.date_trunc("second", ts))
    slots = (
        plays.filter(F.col(ts).isNotNull())
        .select(F.col(user), at.alias("_at"))
        .groupBy(user, F.floor(F.col("_at") / length).alias("_slot"))
        .agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.count("*").alias("_n"))
        .withColumn("_block", F.floor(F.col("_slot") / block))
    )
    runs = merged_runs(slots, [user, "_block"], length)
    start = F.col("_block") * block * length
    at_border = (F.col("_first") < start + length) | (F.col("_last") >= start + (block - 1) * length)
    found = [user, "_first", "_last", "_n"]
    inside = runs.filter(~at_border).select(*found)
    across = merged_runs(runs.filter(at_border).select(*found), [user], length)
    return inside.unionByName(across).select(
        user,
        F.timestamp_seconds("_first").cast("timestamp_ntz").alias("session_start"),
        F.timestamp_seconds("_last").cast("timestamp_ntz").alias("last_play"),
        F.col("_n").alias("plays"),
    )


def genre_similarity(
    session_genres: DataFrame, jaccard: str = "true", min_sessions: int = 3
) -> DataFrame:
    """Symmetric genre similarity from shared sessions.

    ``jaccard="true"`` divides the shared sessions by the sessions with either genre;
    ``"reference"`` counts only shared sessions in the divisor as well, which is always 1.
    The self-join is between sums per session and genre: a session contributes at most one
    row per genre, however many plays it has, and pairs are added up before the shuffle.
    """
    left = session_genres.select(
        "session_id",
        F.col("primary_genre").alias("genre_1"),
        F.col("tracks_in_session").alias("_n1"),
    )
    right = session_genres.select(
        "session_id",
        F.col("primary_genre").alias("genre_2"),
        F.col("tracks_in_session").alias("_n2"),
    )
    pairs = (
        left.join(right, "session_id")
        .filter(F.col("genre_1") < F.col("genre_2"))
        .groupBy("genre_1", "genre_2")
        .agg(
            F.count("*").alias("sessions_together"),
            (F.sum(F.col("_n1") + F.col("_n2")) / F.count("*")).alias("avg_session_intensity"),
        )
        .filter(F.col("sessions_together") >= min_sessions)
    )
    totals = session_genres.groupBy("primary_genre").agg(
        F.count("*").alias("_sessions"), F.sum("tracks_in_session").alias("_tracks")
    )

    def total(side: str) -> DataFrame:
        return totals.select(
            F.col("primary_genre").alias(side),
            F.col("_sessions").alias(f"{side}_sessions"),
            F.col("_tracks").alias(f"{side}_total_tracks"),
        )

    shared = F.col("sessions_together")
    either = F.col("genre_1_sessions") + F.col("genre_2_sessions") - shared
    overlap = shared / F.least("genre_1_sessions", "genre_2_sessions")
    matrix = (
        pairs.join(total("genre_1"), "genre_1")
        .join(total("genre_2"), "genre_2")
        .withColumns(
            {
                "jaccard_similarity": shared / either if jaccard == "true" else F.lit(1.0),
                "overlap_ratio": overlap,
            }
        )
    )
    # every pair in both directions, from one pass over the pairs
    swap = {"genre_1": "genre_2", "genre_2": "genre_1"}
    direct, swapped = [], []
    for name in matrix.columns:
        prefix = name[:7]
        other = swap[prefix] + name[7:] if prefix in swap else name
        direct.append(F.col(name).alias(name))
        swapped.append(F.col(other).alias(name))
    both = F.explode(F.array(F.struct(*direct), F.struct(*swapped)))
    score = F.col("jaccard_similarity") * 0.6 + F.col("overlap_ratio") * 0.4
    return (
        matrix.select(both.alias("_pair"))
        .select("_pair.*")
        .withColumns(
            {
                "combined_similarity_score": score,
                "from_genre": F.col("genre_1"),
                "to_genre": F.col("genre_2"),
                "similarity_score": score,
            }
        )
    )


def artist_genre_profile(
    silver: DataFrame, as_of: Column, window: int = TRACK_WINDOW
) -> DataFrame:
    """One row per artist and genre with the artist's genre count and average popularity."""
    per_genre = (
        silver.filter(
            since(F.col("local_date"), as_of, window) & F.col("primary_artist_id").isNotNull()
        )
        .groupBy("primary_artist_id", "primary_artist_name", "primary_genre")
        .agg(
            F.sum(F.col("track_popularity").cast("long")).alias("_sum"),
            F.count("track_popularity").alias("_n"),
        )
    )
    per_artist = per_genre.groupBy("primary_artist_id").agg(
        F.countDistinct("primary_genre").alias("genre_count"),
        F.try_divide(F.sum("_sum"), F.sum("_n")).alias("avg_popularity"),
    )
    return (
        per_genre.filter(F.col("primary_genre").isNotNull())
        .select("primary_artist_id", "primary_artist_name", "primary_genre")
        .join(per_artist, "primary_artist_id")
    )


def side(profile: DataFrame, number: int, *extra: str) -> DataFrame:
    """The profile as the first or second artist of a pair."""
    return profile.select(
        *extra,
        "primary_genre",
        F.col("primary_artist_id").alias(f"artist_{number}_id"),
        F.col("primary_artist_name").alias(f"artist_{number}_name"),
        F.col("genre_count").alias(f"artist_{number}_genre_count"),
        F.col("avg_popularity").alias(f"artist_{number}_avg_popularity"),
    )


def score_artist_pairs(pairs: DataFrame) -> DataFrame:
    """Similarity of artist pairs that share ``primary_genre``."""
    either = F.col("artist_1_genre_count") + F.col("artist_2_genre_count") - 1
    apart = F.abs(F.col("artist_1_avg_popularity") - F.col("artist_2_avg_popularity"))
    popularity = 1 - apart / 100.0
    return pairs.select(
        "artist_1_id",
        "artist_1_name",
        "artist_2_id",
        "artist_2_name",
        F.array("primary_genre").alias("shared_genres"),
        F.lit(1).alias("shared_genre_count"),
        "artist_1_genre_count",
        "artist_2_genre_count",
        (1 / either).alias("genre_jaccard_similarity"),
        popularity.alias("popularity_similarity"),
        (1 / either * 0.7 + popularity * 0.3).alias("artist_similarity_score"),
    )


def artist_similarity(profile: DataFrame, min_score: float = 0.95, salts: int = 8) -> DataFrame:
    """All artist pairs of a shared genre that score at least ``min_score``.

    The score bounds how far apart two popularities may be, so each artist meets only the
    artists of its own and the two neighbouring popularity bands instead of the whole genre.
    The result is complete for the threshold; at 0.7 and below the bound is void and the
    result is every same-genre pair, which grows with the square of a genre. A band that holds
    many artists is split over ``salts`` tasks.
    """
    reach = 100.0 * (1.0 - (min_score - 0.7) / 0.3)
    if reach < 100:
        # a little wider than the bound, so that rounding at its edge drops no pair
        width = reach * 1.000001 + 1e-6
        band = F.floor(F.col("avg_popularity") / width).cast("int")
        near = F.array(*[band + step for step in (-1, 0, 1)])
    else:
        band, near = F.lit(0), F.array(F.lit(0))
    salt = F.pmod(F.xxhash64("primary_artist_id"), F.lit(salts))
    copies = F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
    left = side(profile.withColumns({"_band": band, "_salt": salt}), 1, "_band", "_salt")
    spread = profile.withColumn("_band", F.explode(near)).withColumn("_salt", F.explode(copies))
    right = side(spread, 2, "_band", "_salt")
    pairs = left.join(right, ["primary_genre", "_band", "_salt"]).filter(
        F.col("artist_1_id") < F.col("artist_2_id")
    )
    return score_artist_pairs(pairs).filter(F.col("artist_similarity_score") >= min_score)


def artist_neighbours(profile: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` most similar artists of every artist in each of its genres, without pairing all.

    Within a genre and a genre count the score falls with the distance of popularities, so the
    best of each such list are among the k before and the k after an artist in its order.
    Places are found by range-partitioned ranks: the number of list rows up to an artist is its
    rank among list rows and artists together less its rank among the artists alone. The lists
    are then read at those places by an equi-join on unique keys. The work is artists times
    genre counts times k. Ties go to the smaller artist id; artists without popularity have no
    score and take no part.
    """
    ensure_checkpoint_dir(profile)
    rows = profile.dropna(subset=["primary_genre", "avg_popularity"]).checkpoint()
    listed = rows.withColumn("_list", F.struct("primary_genre", "genre_count"))
    up, ident = F.col("avg_popularity"), F.col("primary_artist_id")
    listed = rank_in_group(listed, "_list", [up.asc(), ident.asc()], "_up")
    listed = rank_in_group(listed, "_list", [up.asc(), ident.desc()], "_down")
    counts = rows.select(F.col("primary_genre").alias("_genre"), F.col("genre_count").alias("_count"))
    asked = join_dimension(
        side(rows, 1), counts.distinct(), F.col("primary_genre") == F.col("_genre"), "inner"
    ).withColumn("_list", F.struct(F.col("primary_genre"), F.col("_count").alias("genre_count")))
    asked = asked.drop("_genre", "_count").withColumns(
        {"avg_popularity": F.col("artist_1_avg_popularity"), "primary_artist_id": F.col("artist_1_id")}
    )
    asked = rank_in_group(asked, "_list", [up.asc(), ident.asc()], "_nth")
    places = rows.select(
        F.struct("primary_genre", "genre_count").alias("_list"), up, ident, F.lit(0).alias("_asks")
    ).union(asked.select("_list", "avg_popularity", "primary_artist_id", F.lit(1)))
    places = rank_in_group(places, "_list", [up.asc(), F.col("_asks").asc(), ident.asc()], "_all")
    places = places.filter("_asks = 1").select(
        F.col("_list").alias("_l"), F.col("primary_artist_id").alias("_id"), "_all"
    )
    upto = F.col("_all") - F.col("_nth")
    asked = asked.join(
        places, (F.col("_list") == F.col("_l")) & (F.col("artist_1_id") == F.col("_id"))
    ).drop("_l", "_id", "avg_popularity", "primary_artist_id")
    near = []
    for place, first, last in (("_down", upto - k, upto), ("_up", upto + 1, upto + k)):
        other = side(listed, 2, "_list", place).drop("primary_genre")
        wanted = asked.withColumn(place, F.explode(F.sequence(first, last)))
        near.append(wanted.join(other, ["_list", place]).drop(place))
    pairs = near[0].unionByName(near[1]).filter("artist_1_id != artist_2_id")
    scored = score_artist_pairs(pairs).withColumn("_order", F.round("artist_similarity_score", 9))
    best = top_per_group(
        scored.withColumn("_genre", F.col("shared_genres")[0]),
        ["artist_1_id", "_genre"],
        [F.desc("_order"), F.col("artist_2_id")],
        k,
        "similarity_rank",
    )
    return best.drop("_order", "_genre")


def similar_to_artists(profile: DataFrame, names: list[str]) -> DataFrame:
    """Scored pairs whose first artist is one of ``names``; only those genres are met.

    Like the network, a pair is listed from the artist with the smaller id.
    """
    seeds = side(profile.filter(F.col("primary_artist_name").isin(*names)), 1)
    pairs = seeds.join(side(profile, 2), "primary_genre")
    return score_artist_pairs(pairs.filter(F.col("artist_1_id") < F.col("artist_2_id")))
