"""Non-negative factorisation of user by genre preferences by multiplicative updates.

The preferences V are approximated by W H, which minimises

    |V - W H|^2 / 2 + l1 (|W| + |H|) + l2 (|W|^2 + |H|^2) / 2

with the l1 and l2 of each side scaled by the size of the other. Users are many, genres few: the
rows of V and W are spread over the cluster, H is one small matrix of ``rank`` by genres, which
the tasks receive and whose update needs only sums over the users. Every iteration updates W, sums
W'V and W'W in the tasks, and updates H; no update can raise the objective, which is recorded.
W is written once per iteration, so that a lost executor costs one.

The start is a hash of user or genre and factor, so results don't depend on the order of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinledger.sources.tables import materialise, remove, scratch_folder

#: Genres that the small side may have; 65,536 with 20 factors are 10 MB.
MAX_GENRES = 1 << 16
TINY = 1e-12


def first_factors(names: list[str], rank: int) -> np.ndarray:
    """Start values from 0.5 to 1.5, by name and factor."""
    digits = [[hashlib.md5(f"{name}:{f}".encode()).hexdigest()[:4] for f in range(rank)] for name in names]
    return 0.5 + np.array([[int(d, 16) for d in row] for row in digits], float).reshape(-1, rank) / 65536


@dataclass
class Factors:
    """Factor rows of users (user_id, factors) and genres (genre, factors), and the objective
    after the update of the users in every iteration."""

    users: DataFrame
    genres: DataFrame
    objective: list[float]


def factorise(
    interactions: DataFrame,
    rank: int = 20,
    iterations: int = 30,
    alpha: float = 0.1,
    l1_ratio: float = 0.5,
) -> Factors:
    """Factors of (user_id, primary_genre, weighted_preference); pairs that occur twice add up.

    Rows without user, genre or preference are left out; preferences must not be negative.
    """
    spark, folder = interactions.sparkSession, scratch_folder(interactions.sparkSession)
    pairs = (
        interactions.select(
            F.col("user_id").cast("string").alias("user_id"),
            F.col("primary_genre").alias("genre"),
            F.col("weighted_preference").cast("double").alias("liking"),
        )
        .dropna()
        .groupBy("user_id", "genre")
        .agg(F.sum("liking").alias("liking"))
    )
    pairs = materialise(pairs, folder + "/pairs")
    names = [row.genre for row in pairs.select("genre").distinct().limit(MAX_GENRES + 1).collect()]
    if len(names) > MAX_GENRES:
        raise ValueError(f"more than {MAX_GENRES} genres")
    names.sort()
    entries = F.collect_list(F.struct("genre", "liking")).alias("entries")  # at most a row per genre
    rows = pairs.groupBy("user_id").agg(entries)
    rows = materialise(rows.withColumn("factors", F.lit(None).cast("array<double>")), folder + "/w0")
    users = rows.agg(F.count("*")).first()[0]
    number = {name: i for i, name in enumerate(names)}
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)
    l1_users, l2_users, l1_genres, l2_genres = l1 * len(names), l2 * len(names), l1 * users, l2 * users
    h = first_factors(names, rank).T.copy()
    objective: list[float] = []

    def matrix(batch: pa.RecordBatch) -> np.ndarray:
        held = batch.column("entries")
        entry, sizes = held.flatten(), held.value_lengths().to_numpy(zero_copy_only=False)
        v = np.zeros((batch.num_rows, len(names)))
        columns = [number[g] for g in entry.field("genre").to_pylist()]
        v[np.repeat(np.arange(batch.num_rows), sizes), columns] = entry.field("liking").to_numpy()
        return v

    def factors_of(batch: pa.RecordBatch) -> np.ndarray:
        return np.array(batch.column("factors").to_pylist(), float).reshape(-1, rank)

    for i in range(iterations):
        handed = spark.sparkContext.broadcast(h)

        def update(batches: Iterable[pa.RecordBatch], handed=handed) -> Iterator[pa.RecordBatch]:
            h = handed.value
            for batch in batches:
                v, ids = matrix(batch), batch.column("user_id")
                start = batch.column("factors").null_count == batch.num_rows
                w = first_factors(ids.to_pylist(), rank) if start else factors_of(batch)
                w *= (v @ h.T) / np.maximum(w @ (h @ h.T) + l1_users + l2_users * w, TINY)
                yield pa.RecordBatch.from_arrays(
                    [ids, batch.column("entries"), pa.array(w.tolist(), pa.list_(pa.float64()))],
                    batch.schema.names,
                )

        def sums(batches: Iterable[pa.RecordBatch], handed=handed) -> Iterator[pa.RecordBatch]:
            h = handed.value
            wv, ww, loss = np.zeros((rank, len(names))), np.zeros((rank, rank)), 0.0
            for batch in batches:
                v, w = matrix(batch), factors_of(batch)
                wv += w.T @ v
                ww += w.T @ w
                loss += ((v - w @ h) ** 2).sum() / 2 + l1_users * w.sum() + l2_users * (w**2).sum() / 2
            values = np.concatenate([wv.ravel(), ww.ravel(), [loss]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["at", "value"])

        rows = materialise(rows.mapInArrow(update, rows.schema), f"{folder}/w{i + 1}")
        if i:
            remove(spark, f"{folder}/w{i}")
        partial = rows.mapInArrow(sums, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
        total = np.zeros(rank * (len(names) + rank) + 1)
        found = partial.toArrow()  # rank * (genres + rank) numbers
        total[found.column("at").to_numpy()] = found.column("value").to_numpy()
        wv, ww = total[: rank * len(names)].reshape(rank, -1), total[rank * len(names) : -1].reshape(rank, rank)
        objective.append(float(total[-1] + l1_genres * h.sum() + l2_genres * (h**2).sum() / 2))
        h = h * wv / np.maximum(ww @ h + l1_genres + l2_genres * h, TINY)

    held = [(name, h[:, i].tolist()) for i, name in enumerate(names)]
    genres = spark.createDataFrame(held, "genre string, factors array<double>")
    return Factors(rows.select("user_id", "factors"), genres, objective)


def best_genres(found: Factors, n: int = 10) -> DataFrame:
    """The ``n`` genres of every user with the highest scores: user_id, genre, score, rank.

    Ties go to the smaller name. The small side travels to the tasks.
    """
    rows = found.genres.orderBy("genre").collect()
    names, h = [row.genre for row in rows], np.array([row.factors for row in rows], float)
    handed = found.users.sparkSession.sparkContext.broadcast(h)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = handed.value
        for batch in batches:
            scores = np.array(batch.column("factors").to_pylist(), float).reshape(-1, h.shape[1]) @ h.T
            best = np.argsort(-scores, axis=1, kind="stable")[:, :n]
            user = np.repeat(np.arange(batch.num_rows), best.shape[1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("user_id").take(pa.array(user)),
                    pa.array(names).take(pa.array(best.ravel())),
                    pa.array(scores[user, best.ravel()]),
                    pa.array(np.tile(np.arange(1, best.shape[1] + 1, dtype=np.int32), batch.num_rows)),
                ],
                ["user_id", "genre", "score", "rank"],
            )

    if not names:
        schema = "user_id string, genre string, score double, rank int"
        return found.users.sparkSession.createDataFrame([], schema)
    found_rows = found.users.mapInArrow(score, "user_id string, genre string, score double, rank int")
    return found_rows.withColumn("recommendation_type", F.lit("collaborative_filtering"))
