"""Scaled feature vectors with cosine neighbours."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinledger.functions.joins import salted_dimension_join
from spinledger.functions.ranking import ensure_checkpoint_dir, top_per_group
from spinledger.operators.strategies import favourite_tracks

# The features that describe a track.
FEATURE_COLUMNS = [
    "track_popularity", "popularity_tier", "duration_category", "release_year",
    "artist_genre_diversity", "artist_avg_popularity", "artist_track_count",
    "genre_avg_popularity", "genre_avg_duration", "genre_artist_count",
    "genre_popularity_variance", "user_play_count", "freshness_score",
    "popularity_vs_genre_avg", "duration_vs_genre_avg", "artist_vs_genre_popularity",
]


def track_vectors(features: DataFrame) -> DataFrame:
    """Standardised, length-1 feature arrays per track (missing values count as 0)."""
    filled = features.select(
        "track_id",
        "track_name",
        F.col("primary_artist_name").alias("artist_name"),
        F.col("primary_genre").alias("genre"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURE_COLUMNS],
    )
    scaling = Pipeline(
        stages=[
            VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="_raw"),
            StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True),
        ]
    )
    scaled = scaling.fit(filled).transform(filled)
    values = vector_to_array("_scaled")
    square = F.aggregate("_v", F.lit(0.0), lambda a, x: a + x * x)
    return (
        scaled.select("track_id", "track_name", "artist_name", "genre", values.alias("_v"))
        .withColumn("_n", F.sqrt(square))
        .select(
            "track_id",
            "track_name",
            "artist_name",
            "genre",
            F.transform("_v", lambda x: F.coalesce(F.try_divide(x, F.col("_n")), F.lit(0.0))).alias(
                "vector"
            ),
        )
    )


def similar_by_vector(vectors: DataFrame, seed_ids: DataFrame, n: int = 10) -> DataFrame:
    """Nearest tracks by cosine for a bounded set of seed tracks.

    ``seed_ids`` (a ``track_id`` column, some tens of rows) travels as one array and every
    track is scored against it in place; top-k per seed is cut in the map tasks first.
    """
    chosen = vectors.join(F.broadcast(seed_ids.select("track_id")), "track_id", "left_semi")
    seeds = chosen.agg(F.collect_list(F.struct("track_id", "vector"))).scalar()
    pairs = vectors.withColumn("_seeds", seeds).withColumn("_seed", F.explode("_seeds"))
    dot = F.aggregate(
        F.zip_with("vector", F.col("_seed.vector"), lambda a, b: a * b),
        F.lit(0.0),
        lambda a, x: a + x,
    )
    scored = pairs.filter(F.col("track_id") != F.col("_seed.track_id")).select(
        F.col("_seed.track_id").alias("seed_track_id"),
        "track_id",
        "track_name",
        "artist_name",
        "genre",
        F.round(dot, 9).alias("similarity_score"),
    )
    order = [F.desc("similarity_score"), F.col("track_id")]
    return top_per_group(scored, ["seed_track_id"], order, n, "similarity_rank")


def neighbours_of_favourites(features: DataFrame, seeds: int = 10, n: int = 10) -> DataFrame:
    vectors = track_vectors(features)
    return similar_by_vector(vectors, favourite_tracks(features, n=seeds), n)


# Neighbours of all tracks: at most this many cells, and this many vectors of a side per block.
MAX_CELLS = 1024
BLOCK = 2048
# Scores are rounded to nine digits; a bound must keep everything that may round up to it.
SCORE_DIGITS, SLACK = 9, 2e-9


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    square = (points**2).sum(1)[:, None] + (centres**2).sum(1)[None, :] - 2 * points @ centres.T
    return np.sqrt(np.maximum(square, 0))


def best_of_block(queries: pd.DataFrame, block: pd.DataFrame, k: int) -> pd.DataFrame:
    """The first ``k`` tracks of a block for every query, by rounded score and track."""
    out: list[tuple] = []
    if len(queries) and len(block):
        points, others = np.stack(queries["vector"]), np.stack(block["vector"])
        scores = np.round(points @ others.T, SCORE_DIGITS)
        least = np.full(len(points), -np.inf)
        if len(others) > k:
            least = np.partition(scores, -k, axis=1)[:, -k]
        tracks = block["ids"].to_numpy()
        for vector, row, limit in zip(queries["vector"], scores, least):
            near = [(-row[j], t) for j in np.flatnonzero(row >= limit) for t in tracks[j]]
            out += [(vector, t, -score) for score, t in sorted(near)[:k]]
    return pd.DataFrame(out, columns=["vector", "track_id", "score"])


def nearest_tracks(
    vectors: DataFrame, n: int = 10, max_cells: int = MAX_CELLS, block: int = BLOCK
) -> DataFrame:
    """The ``n`` nearest tracks by cosine of every track, exactly; ties go to the smaller track.

    Equal vectors are one class, known by its ``n + 1`` smallest tracks, the only ones that can be
    among anybody's nearest. Classes are dealt to the cells of their nearest pivots (at most
    ``max_cells`` vectors, the smallest by hash) and cells to blocks. A class first meets its own
    block; its n-th score there bounds the distance of its neighbours, and by the triangle
    inequality it then visits only the cells that reach into that distance. A visit is one matrix
    product of at most about ``block`` queries and ``block`` classes, however full a cell is; the
    best of all visits are merged per class. Pivots affect the work only: where vectors have no
    clusters, cells cannot be left out and the work nears all blocks by all blocks.

    ``vectors`` has a row per ``track_id`` with a ``vector`` of length 1 (or all zero, which is
    as near to every track). Rows without a track are left out. Fewer than ``n`` other tracks
    give fewer rows.
    """
    ensure_checkpoint_dir(vectors)
    keep = n + 1
    kept = vectors.filter(F.col("track_id").isNotNull()).select("track_id", "vector")
    members = top_per_group(kept, ["vector"], [F.col("track_id")], keep)
    classes = members.groupBy("vector").agg(F.collect_list("track_id").alias("ids")).checkpoint()
    size = classes.count()
    cells = max(1, min(max_cells, math.isqrt(size)))
    by_hash = [F.xxhash64("vector"), F.col("vector")]
    chosen = classes.select("vector").orderBy(*by_hash).limit(cells).collect()
    pivots = np.array([r.vector for r in chosen], dtype=float)

    def dealt(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                reach = distances(np.stack(frame["vector"]), pivots)
                yield frame.assign(cell=reach.argmin(1).astype("int32"), reach=reach.min(1))

    kinds = f"vector array<double>, ids array<{dict(kept.dtypes)['track_id']}>"
    celled = classes.mapInPandas(dealt, f"{kinds}, cell int, reach double")
    # one row per cell, at most max_cells
    stats = celled.groupBy("cell").agg(
        F.count("*").alias("rows"), F.min("reach").alias("low"), F.max("reach").alias("high")
    )
    stats = stats.withColumn("blocks", F.ceil(F.col("rows") / block).cast("int")).checkpoint()
    own = F.pmod(F.xxhash64("vector"), F.col("blocks")).cast("int")
    blocks = celled.join(F.broadcast(stats.select("cell", "blocks")), "cell").select(
        "cell", own.alias("part"), "vector", "ids"
    )

    def bounded(frame: pd.DataFrame) -> pd.DataFrame:
        points = np.stack(frame["vector"])
        scores = points @ points.T
        bound = np.full(len(points), np.inf)
        if len(points) >= keep:
            least = np.partition(scores, -keep, axis=1)[:, -keep]
            bound = np.sqrt(np.maximum(2 - 2 * (least - SLACK), 0)) + SLACK
        return pd.DataFrame({"vector": frame["vector"], "bound": bound})

    bounds = blocks.groupBy("cell", "part").applyInPandas(bounded, "vector array<double>, bound double")
    rings = {r.cell: (r.low, r.high) for r in stats.collect()}

    def visits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers = np.array(sorted(rings), dtype="int32")
        low, high = (np.array([rings[c][i] for c in sorted(rings)]) for i in (0, 1))
        for frame in frames:
            if len(frame):
                reach = distances(np.stack(frame["vector"]), pivots[numbers])
                least = np.maximum(reach - high, low - reach) - 1e-6
                query, cell = np.nonzero(least <= frame["bound"].to_numpy()[:, None])
                yield pd.DataFrame(
                    {"vector": frame["vector"].to_numpy()[query], "cell": numbers[cell]}
                )

    probes = bounds.mapInPandas(visits, "vector array<double>, cell int").checkpoint()
    met = probes.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("int").alias("chunks"))
    shares = F.broadcast(stats.select("cell", "blocks").join(met, "cell"))

    def numbers_below(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    chunk = F.pmod(F.xxhash64("vector", F.lit(1)), F.col("chunks")).cast("int")
    asked = probes.join(shares, "cell").select(
        "cell", chunk.alias("chunk"), "vector", numbers_below("blocks").alias("part")
    )
    copies = blocks.join(shares.drop("blocks"), "cell").select(
        "cell", "part", "vector", "ids", numbers_below("chunks").alias("chunk")
    )
    place = ["cell", "part", "chunk"]
    found = (
        asked.groupBy(*place)
        .cogroup(copies.groupBy(*place))
        .applyInPandas(
            lambda queries, others: best_of_block(queries, others, keep),
            f"vector array<double>, track_id {dict(kept.dtypes)['track_id']}, score double",
        )
    )
    order = [F.desc("score"), F.col("track_id")]
    best = (
        top_per_group(found, ["vector"], order, keep, "place")
        .groupBy(F.col("vector").alias("_class"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "track_id", "score"))).alias("_near"))
    )
    joined = salted_dimension_join(
        kept.withColumnRenamed("track_id", "seed_track_id"), best, "vector", "_class", ["seed_track_id"], "inner"
    )
    others = F.filter("_near", lambda x: x["track_id"] != F.col("seed_track_id"))
    return joined.select("seed_track_id", F.posexplode(F.slice(others, 1, n)).alias("_at", "_x")).select(
        "seed_track_id",
        F.col("_x.track_id").alias("track_id"),
        F.col("_x.score").alias("similarity_score"),
        (F.col("_at") + 1).alias("similarity_rank"),
    )
