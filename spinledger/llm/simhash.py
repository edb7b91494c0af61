"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints at most ``2 * HALF`` bits apart have a common variant at most ``HALF``
flips from each. Every distinct fingerprint emits all such variants (2,081 for two flips); what
meets on a variant is linked. To keep the exchange small a fingerprint is sent once per *prefix*
that its variants can have (1 + k + k(k-1)/2 rows for k prefix bits) with the flips it has left,
and the remaining bits are flipped where the rows of a prefix meet. k follows the number of
distinct fingerprints, so that a prefix holds a bounded number of variants on average; a crowded
prefix is cut by further bits inside its task. All fingerprints on one variant lie within the
radius of each other, so a star of links to the smallest joins them without listing pairs.

Defined cases: a null text counts as empty and has fingerprint zero; equal texts share one
fingerprint and thus one component; repeated rows are kept; a null id takes no part in the
smallest id of its component, and a component of null ids only has a null id; an empty table
gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spinledger.llm.common import text_of, written
from spinledger.llm.components import connected

BITS = 64
HALF = 2
SHINGLE = 4
SEED = 42
#: Hashes that are counted together; bounds the memory of one very long text.
CHUNK = 1 << 16
#: Variants that are sorted together in one task.
VARIANTS = 1 << 21


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of one text: bits set in over half of its shingle hashes."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for i in range(0, len(starts), CHUNK):
        spans = zip(starts[i : i + CHUNK].tolist(), ends[i : i + CHUNK].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(texts: pa.Array) -> pa.Array:
    found = [simhash(x) for x in texts.cast(pa.binary()).to_pylist()]
    return pa.array(np.array(found, np.uint64).view(np.int64))


def prefix_bits(distinct: int, variants: int = VARIANTS) -> int:
    """Bits that bring the variants of a prefix to about ``variants`` on average."""
    total = distinct * (1 + BITS + BITS * (BITS - 1) // 2)
    return min(24, max(0, (max(total, 1) // variants).bit_length()))


def flips(low: int, high: int, most: int) -> list[tuple[np.uint64, int]]:
    """Masks that flip at most ``most`` of the bits from ``low`` to below ``high``."""
    masks = []
    for n in range(most + 1):
        for bits in combinations(range(low, high), n):
            masks.append((np.uint64(sum(1 << b for b in bits)), n))
    return masks


def spread(fps, bases, left, free: int, bits: int):
    """Rows (fingerprint, base, flips left) for every value of the next ``bits`` high bits."""
    out = []
    for mask, used in flips(free - bits, free, HALF):
        keep = left >= used
        out.append((fps[keep], bases[keep] ^ mask, left[keep] - used))
    return [np.concatenate(column) for column in zip(*out, strict=True)]


def meet(fps, bases, left, free: int) -> Iterator[np.ndarray]:
    """Pairs (smallest, other) of fingerprints that share a variant in one prefix."""
    room = 1 + free + free * (free - 1) // 2
    if len(fps) * room > 4 * VARIANTS and free > 8:
        fps, bases, left = spread(fps, bases, left, free, 4)
        free -= 4
        part = (bases >> np.uint64(free)) & np.uint64(15)
        for value in range(16):
            mine = part == value
            if mine.any():
                yield from meet(fps[mine], bases[mine], left[mine], free)
        return
    variants, owners = [], []
    ids = np.arange(len(fps), dtype=np.int32)
    for n in range(HALF + 1):
        able = left >= n
        masks = np.array([m for m, used in flips(0, free, n) if used == n], np.uint64)
        if able.any() and len(masks):
            variants.append((bases[able][:, None] ^ masks[None, :]).ravel())
            owners.append(np.repeat(ids[able], len(masks)))
    variants, owners = np.concatenate(variants), np.concatenate(owners)
    ordered = np.sort(variants)
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(shared):
        return
    at = np.minimum(np.searchsorted(shared, variants), len(shared) - 1)
    hit = shared[at] == variants
    at, members = at[hit], fps[owners[hit]]
    order = np.lexsort((members, at))
    at, members = at[order], members[order]
    first = np.r_[True, at[1:] != at[:-1]]
    heads = members[first][np.cumsum(first) - 1]
    pairs = np.unique(np.stack([heads, members], 1)[heads != members], axis=0)
    close = np.bitwise_count(pairs[:, 0] ^ pairs[:, 1]) <= 2 * HALF
    yield pairs[close]


def forest(pairs: np.ndarray) -> np.ndarray:
    """As few pairs with the same components."""
    nodes, ends = np.unique(pairs, return_inverse=True)
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for i, (a, b) in enumerate(ends.reshape(-1, 2).tolist()):
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
            kept.append(i)
    return pairs[kept]


def links(distinct: DataFrame, count: int) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs within the radius."""
    bits = prefix_bits(count)
    free = BITS - bits
    masks = [(int(m.view(np.int64)), used) for m, used in flips(free, BITS, HALF)]
    options = F.array(
        *[F.struct(F.lit(m).alias("mask"), F.lit(HALF - n).alias("left")) for m, n in masks]
    )
    sent = (
        distinct.select("fp", F.explode(options).alias("o"))
        .select("fp", F.col("fp").bitwiseXOR(F.col("o.mask")).alias("base"), "o.left")
        .withColumn("prefix", F.shiftrightunsigned("base", free) if bits else F.lit(0).cast("long"))
    )

    def joined(rows: pa.Table) -> pa.Table:
        fps = rows["fp"].to_numpy().astype(np.int64).view(np.uint64)
        bases = rows["base"].to_numpy().astype(np.int64).view(np.uint64)
        left = rows["left"].to_numpy().astype(np.int8)
        found = [p for p in meet(fps, bases, left, free) if len(p)]
        pairs = forest(np.unique(np.concatenate(found), axis=0)) if found else np.empty((0, 2))
        pairs = pairs.astype(np.uint64).view(np.int64)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return sent.groupBy("prefix").applyInArrow(joined, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, a hash of the text, fingerprint and component.

    ``fp`` is the fingerprint as a signed long, ``root`` names the component by one of its
    fingerprints, ``component_id`` by the smallest id reachable by links of at most four
    differing bits (where ids repeat, components may share it).
    """
    rows = written(
        docs.select(
            F.col(id).alias("doc_id"),
            F.xxhash64(text_of(text)).alias("text_hash"),
            F.arrow_udf(fingerprints, "long")(text_of(text)).alias("fp"),
        ),
        "fingerprints",
    )
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = connected(written(links(distinct, distinct.count()), "links"))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    members = rooted.join(smallest, "root").select("fp", "root", "component_id")
    return rows.join(members, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def first_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component: the smallest id, then the smallest text hash."""
    found = near_duplicates(docs)
    place = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id"), F.col("text_hash"))
    kept = (
        found.groupBy("root")
        .agg(F.min(place).alias("p"))
        .select(F.col("p.doc_id").alias("_id"), F.col("p.text_hash").alias("_hash"))
        .distinct()
    )
    hashed = docs.withColumn("_text_hash", F.xxhash64(text_of()))
    match = hashed["doc_id"].eqNullSafe(kept["_id"]) & (hashed["_text_hash"] == kept["_hash"])
    alike = Window.partitionBy("doc_id", "_text_hash").orderBy("doc_id")
    return (
        hashed.join(kept, match, "left_semi")
        .withColumn("_copy", F.row_number().over(alike))
        .filter("_copy = 1")
        .select(*docs.columns)
    )
