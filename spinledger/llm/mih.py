"""Nearest neighbours by multi-index hashing of learned binary codes.

A bounded sample fits a rotation (principal axes, then the rotation that brings the signs closest
to the values) and a Hamming radius that holds nearly all true neighbours of the sample. Every
vector gets its code, cut into m substrings of about log2(rows) bits. By the pigeonhole principle
two codes within R bits agree within floor(R / m) bits in one substring (one bit less suffices from
the substring after R mod m), so probing those balls in every substring's index retrieves every
code within the radius. What is retrieved is ranked by exact distances. Queries that found too few
are asked again with a wider radius, up to all rows.

The index of a substring is dealt out by its leading bits (cells). A cell above its bound is sliced
by a hash of the row, and a query is sent to every slice of every cell its ball touches, in blocks
of queries; a task holds one slice and one block. Equal vectors are one entry with the k + 1
smallest ids, all that a result can show of them, so a vector with a third of all rows is one row.

Defined cases: vectors that are null, zero, of another length than most, or hold a null or
non-finite component take no part, nor do rows without id; an id that occurs twice with one vector
is queried once and finds its other row; one that occurs with several vectors is a query of its own
with each, told apart by ``query_key``, and finds its other vectors; fewer candidates than k are all returned; an empty table
gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spinledger.functions.ranking import top_per_group
from spinledger.llm.common import written

K = 10
EVERY = 100
SAMPLE = 8192
PROBED = 256
#: Share of the sample's true neighbours that the radius holds.
HELD = 0.97
ROUNDS = 40
CELL_ROWS = 8192
BLOCK_QUERIES = 4096
#: A query is an id and its vector, told by a 64-bit hash among the vectors of that id.
QUERY = ["query_id", "query_key"]
MAX_BITS = 64


@dataclass
class Codes:
    """Binary codes: signs of rotated, centred vectors."""

    mean: np.ndarray
    rotation: np.ndarray  # dimensions by bits
    radius: int

    @property
    def bits(self) -> int:
        return self.rotation.shape[1]

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        signs = (vectors - self.mean) @ self.rotation > 0
        padded = np.zeros((len(vectors), MAX_BITS), bool)
        padded[:, : self.bits] = signs
        return np.packbits(padded, axis=1, bitorder="little").view("<u8").ravel()


def fit(sample: np.ndarray, k: int = K) -> Codes:
    """Iterative quantization on the sample, and the radius of its true neighbours."""
    mean = sample.mean(0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, : min(MAX_BITS, sample.shape[1])]
    projected = centred @ axes
    rng = np.random.default_rng(7)
    turn, _ = np.linalg.qr(rng.standard_normal((axes.shape[1], axes.shape[1])))
    for _ in range(ROUNDS):
        left, _, right = np.linalg.svd(np.sign(projected @ turn).T @ projected)
        turn = (left @ right).T
    codes = Codes(mean, axes @ turn, 0)
    found = codes.encode(sample)
    apart = []
    for i in range(min(PROBED, len(sample))):
        near = ((sample - sample[i]) ** 2).sum(1)
        near[i] = np.inf
        best = np.argsort(near, kind="stable")[: min(k, len(sample) - 1)]
        apart.append(np.bitwise_count(found[best] ^ found[i]))
    distances = np.concatenate(apart) if apart else np.zeros(1)
    codes.radius = int(np.quantile(distances, HELD, method="higher")) if distances.size else 0
    return codes


@dataclass
class Layout:
    """How codes are cut: (first bit, bits, radius) of each substring, and leading cell bits."""

    parts: list[tuple[int, int, int]]
    cell_bits: int


def layout(bits: int, radius: int, rows: int) -> Layout:
    wide = min(bits, max(8, int(np.log2(max(rows, 2)))))
    m = -(-bits // wide)
    edges = [round(i * bits / m) for i in range(m + 1)]
    whole, rest = divmod(radius, m)
    parts = [
        (a, b - a, min(b - a, whole if i <= rest else whole - 1))
        for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))
    ]
    cells = max(0, int(np.ceil(np.log2(max(rows / CELL_ROWS, 1)))))
    return Layout([p for p in parts if p[2] >= 0], min(cells, *(p[1] for p in parts)))


def ball(bits: int, radius: int) -> list[int]:
    """All masks of at most ``radius`` set bits out of ``bits``."""
    return [
        sum(1 << b for b in chosen)
        for n in range(radius + 1)
        for chosen in combinations(range(bits), n)
    ]


def cell(part: tuple[int, int, int], cell_bits: int) -> Column:
    first, bits, _ = part
    return F.shiftrightunsigned("code", first + bits - cell_bits).bitwiseAND(
        F.lit((1 << cell_bits) - 1)
    )


def usable(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, v) that take part, v in double precision."""
    v = F.col("embedding").cast("array<double>")
    # NULL components make every test below NULL, so they are looked for first
    sound = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & sound & F.exists("v", lambda x: x != 0)
    )
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("v") == (usual.n if usual else 0))


def coder(codes: Codes) -> Callable[[pa.Array], pa.Array]:
    def run(vectors: pa.Array) -> pa.Array:
        flat = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
        return pa.array(codes.encode(flat).view(np.int64) if len(flat) else [], pa.int64())

    return run


def entries(rows: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: v and its k + 1 smallest ids."""
    first = top_per_group(rows, ["v"], [F.col("vec_id").asc()], k + 1)
    return first.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def search(
    parts: list[tuple[int, int, int]], own_part: int, radius: int, k: int, index: pa.Table, asked: pa.Table
) -> pa.Table:
    """Best entries of one slice for one block of queries, by probing one substring.

    An entry that an earlier substring finds as well is left to that one.
    """
    first, bits, near = parts[own_part]
    codes, vectors = index["code"].to_numpy().view(np.uint64), matrix(index["v"])
    ids = index["ids"].to_pylist()
    least = np.array([x[0] for x in ids])
    keys = (codes >> np.uint64(first)) & np.uint64((1 << bits) - 1)
    order = np.argsort(keys, kind="stable")
    values, starts = np.unique(keys[order], return_index=True)
    ends = np.r_[starts[1:], len(keys)]
    size = sum(np.prod(np.arange(bits - n + 1, bits + 1)) / np.prod(np.arange(1, n + 1)) for n in range(near + 1))
    masks = np.array(ball(bits, near), np.uint64) if size < len(values) else None
    out: dict[str, list] = {"query_id": [], "query_key": [], "score": [], "ids": []}
    own_codes, own = asked["code"].to_numpy().view(np.uint64), matrix(asked["v"])
    names = zip(asked["query_id"].to_pylist(), asked["query_key"].to_pylist(), strict=True)
    for q, (query_id, query_key) in enumerate(names):
        key = (own_codes[q] >> np.uint64(first)) & np.uint64((1 << bits) - 1)
        if masks is None:
            hit = np.nonzero(np.bitwise_count(values ^ key) <= near)[0]
        else:
            at = np.minimum(np.searchsorted(values, masks ^ key), len(values) - 1)
            hit = at[values[at] == masks ^ key]
        if not len(hit):
            continue
        held = np.concatenate([order[starts[h] : ends[h]] for h in hit])
        apart = codes[held] ^ own_codes[q]
        fresh = np.bitwise_count(apart) <= radius
        for low, width, within in parts[:own_part]:
            mask = np.uint64(((1 << width) - 1) << low)
            fresh &= np.bitwise_count(apart & mask) > within
        held = held[fresh]
        scores = np.sqrt(((vectors[held] - own[q]) ** 2).sum(1))
        best = np.lexsort((least[held], scores))[: k + 1]
        out["query_id"] += [query_id] * len(best)
        out["query_key"] += [query_key] * len(best)
        out["score"] += scores[best].tolist()
        out["ids"] += [ids[i] for i in held[best]]
    return pa.table(
        {
            "query_id": pa.array(out["query_id"], asked["query_id"].type),
            "query_key": pa.array(out["query_key"], pa.int64()),
            "score": pa.array(out["score"], pa.float64()),
            "ids": pa.array(out["ids"], pa.list_(asked["query_id"].type)),
        }
    )


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def probe(index: DataFrame, asked: DataFrame, plan: Layout, radius: int, k: int) -> DataFrame:
    """Rows (query_id, query_key, score, vec_id): the k nearest within the radius for every query."""
    each = F.explode(F.array(*[
        F.struct(F.lit(n).alias("part"), cell(p, plan.cell_bits).alias("cell"))
        for n, p in enumerate(plan.parts)
    ]))
    dealt = index.select("*", each.alias("c")).select("code", "v", "ids", "c.part", "c.cell")
    # a row per cell: at most substrings times index rows / CELL_ROWS, about
    slices = written(
        dealt.groupBy("part", "cell").agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("slices")),
        "slices",
    )
    sliced = dealt.join(slices, ["part", "cell"]).withColumn(
        "slice", F.pmod(F.xxhash64("ids"), F.col("slices")).cast("int")
    )
    touched = F.explode(F.concat(*[
        F.array(*[
            F.struct(
                F.lit(n).alias("part"),
                cell(p, plan.cell_bits).bitwiseXOR(F.lit(mask).cast("long")).alias("cell"),
            )
            for mask in ball(plan.cell_bits, min(p[2], plan.cell_bits))
        ])
        for n, p in enumerate(plan.parts)
    ]))
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    block = F.pmod(F.xxhash64("query_id", "query_key"), F.lit(blocks)).cast("int")
    sent = (
        asked.select(*QUERY, "code", "v", block.alias("block"), touched.alias("c"))
        .select(*QUERY, "code", "v", "block", "c.part", "c.cell")
        .join(slices.toDF("part", "cell", "slices"), ["part", "cell"])
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    )
    spread = sliced.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["part", "cell", "slice", "block"]
    parts, kind = plan.parts, asked.schema["query_id"].dataType.simpleString()

    def run(key: tuple, index: pa.Table, asked: pa.Table) -> pa.Table:
        return search(parts, key[0].as_py(), radius, k, index, asked)

    found = (
        spread.groupBy(*keys)
        .cogroup(sent.groupBy(*keys))
        .applyInArrow(run, f"query_id {kind}, query_key long, score double, ids array<{kind}>")
    )
    # the query's own row: one place of its id among the vectors at distance zero
    own = F.when(F.col("score") == 0, F.array_position("ids", F.col("query_id"))).otherwise(0)
    others = F.filter("ids", lambda _, i: i + 1 != F.col("own"))
    near = found.withColumn("own", own).select(
        *QUERY, "score", F.explode(others).alias("vec_id")
    )
    return top_per_group(near, QUERY, [F.col("score"), F.col("vec_id")], k)


def neighbours(vectors: DataFrame, every: int = EVERY, k: int = K) -> DataFrame:
    """Rows (query_id, rank, vec_id, score, query_key) for the ids divisible by ``every``."""
    rows = usable(vectors)
    plain = written(entries(rows, k), "entries")
    count = plain.count()
    share = F.pmod(F.xxhash64("v"), F.lit(1 << 20)) / float(1 << 20)
    sample = plain.filter(share < min(1.0, SAMPLE / max(count, 1))).select("v").limit(2 * SAMPLE).toArrow()
    query = [F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("query_key")]
    asked = rows.filter(F.col("vec_id") % every == 0).select(*query, "v").distinct()
    if not sample.num_rows:
        none = rows.select(query[0], F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score"), query[1])
        return none.filter("false")
    codes = fit(matrix(sample["v"]), k)
    code = F.arrow_udf(coder(codes), "long")
    index = written(plain.withColumn("code", code("v")), "index")
    left = written(asked.withColumn("code", code("v")), "queries")
    others = min(k, rows.limit(k + 1).count() - 1)
    radius, done = codes.radius, None
    while True:
        plan = layout(codes.bits, radius, count)
        found = written(probe(index, left, plan, radius, k), "found")
        full = found.groupBy(*QUERY).count().filter(F.col("count") >= others)
        complete = radius >= codes.bits
        kept = found if complete else found.join(full, QUERY, "left_semi")
        done = kept if done is None else done.union(kept)
        if not complete:
            left = written(left.join(full, QUERY, "left_anti"), "queries")
        if complete or left.isEmpty():
            return done.select("query_id", "rank", "vec_id", "score", "query_key")
        radius = min(codes.bits, max(radius + 2, radius * 3 // 2))
