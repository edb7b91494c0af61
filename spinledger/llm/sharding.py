"""Shards of near-equal bytes by histogram sort, in DataFrame operations only.

Rows are ordered by (hash of text, hash of id), which shuffles them and keeps equal texts
together. The order is cut into ranges, several per shard, whose splitters are found by counting:
exact bytes per key bucket are summed over all partitions, and only the buckets in which a
splitter's target falls are probed again, more finely, until each splitter is within tolerance.
Then the rows are exchanged once, each straight to its range. A group of equal texts is cut only
where it is too large for the tolerance, by the hash of the id.

The driver holds one splitter per range and the buckets of one probe, both bounded by
``MAX_RANGES``; ranges grow beyond ``RANGE_BYTES`` only after that.

Defined cases: a null text has no bytes and counts one byte like an empty one; null ids are ids
of their own; repeated rows get slots of their own, but those equal in id and text cannot be
parted and stay in one shard; fewer rows than shards leave shards empty; an empty table gives an
empty table; input columns named like a result (shard, slot, ...) are replaced by it.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spinledger.llm.common import text_of, written

SHARDS = 8
LAW = "bytes"
#: Shard borders come within this share of a shard's bytes of their targets, where rows allow.
TOLERANCE = 0.001
#: A border may miss by this share before a group of equal texts is cut.
GROUP_TOLERANCE = 0.005
RANGE_BYTES = 32 << 20
MAX_RANGES = 1 << 16
KEY_BITS = 63
FIRST_BITS = 12
STEP_BITS = 6
TOP = (1 << KEY_BITS) - 1


@dataclass
class Plan:
    shards: int
    per_shard: int
    borders: list[tuple[int, int]]  # (text key, id key) where a range begins, the first left out


def keyed(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds size, text_crc32, and the two keys as numbers below 2**63."""
    return docs.withColumns(
        {
            "size": F.octet_length(text_of(text)).cast("long") + 1,
            "text_crc32": F.crc32(text_of(text).cast("binary")),
            "_key": F.shiftrightunsigned(F.xxhash64(text_of(text)), 1),
            "_tie": F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(id).cast("string"), F.lit("")), F.lit("tie")), 1),
        }
    )


@dataclass
class Probe:
    """One open splitter: its target in bytes and the bucket in which it falls."""

    range: int
    target: float
    slack: float
    before: int = 0
    depth: int = 0  # bits fixed so far, of the text key and then of the id key
    prefix: int = 0


def border(prefix: int, depth: int) -> tuple[int, int]:
    """First key of a bucket; past the last bucket, a key that no row exceeds."""
    if depth <= KEY_BITS:
        key = prefix << (KEY_BITS - depth)
        return (key, 0) if key <= TOP else (TOP, TOP)
    tie_bits = depth - KEY_BITS
    key, tie = prefix >> tie_bits, (prefix & ((1 << tie_bits) - 1)) << (KEY_BITS - tie_bits)
    return key, tie


def bucket(depth: int) -> tuple[Column, Column]:
    """Text key and id key of a row cut to ``depth`` bits."""
    on_key = F.shiftright("_key", max(0, KEY_BITS - depth))
    on_tie = F.shiftright("_tie", max(0, 2 * KEY_BITS - depth)) if depth > KEY_BITS else F.lit(0).cast("long")
    return on_key, on_tie


def next_depth(depth: int, first: int) -> int:
    step = first if depth == 0 else STEP_BITS
    if depth < KEY_BITS:
        return min(depth + step, KEY_BITS)
    return min(depth + step, 2 * KEY_BITS)


def split_prefix(prefix: int, depth: int) -> tuple[int, int]:
    if depth <= KEY_BITS:
        return prefix, 0
    bits = depth - KEY_BITS
    return prefix >> bits, prefix & ((1 << bits) - 1)


Buckets = dict[int, list[tuple[int, int, int]]]


def histogram(rows: DataFrame, probes: list[Probe], depth: int, finer: int) -> Buckets:
    """(prefix, bytes, rows) of every bucket of ``finer`` bits in the probed ones of ``depth``."""
    if depth:
        wanted = sorted({split_prefix(p.prefix, depth) for p in probes})
        held = rows.sparkSession.createDataFrame(wanted, "_k long, _t long")
        key, tie = bucket(depth)
        rows = rows.join(F.broadcast(held), (key == F.col("_k")) & (tie == F.col("_t")), "left_semi")
    key, tie = bucket(finer)
    counted = rows.groupBy(key.alias("k"), tie.alias("t")).agg(
        F.sum("size").alias("n"), F.count("*").alias("rows")
    ).collect()
    found: Buckets = {}
    tie_bits = max(0, finer - KEY_BITS)
    for row in counted:
        prefix = (row.k << tie_bits) | row.t
        found.setdefault(prefix >> (finer - depth), []).append((prefix, row.n, row.rows))
    return {parent: sorted(children) for parent, children in found.items()}


def splitters(rows: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> Plan:
    """Refine probes on rows (size, _key, _tie) until every border is within tolerance."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    per_shard = max(1, min(MAX_RANGES // shards or 1, -(-total // (shards * RANGE_BYTES))))
    ranges, shard = shards * per_shard, total / shards
    first = max(FIRST_BITS, (16 * ranges).bit_length() - 1)
    borders: dict[int, tuple[int, int]] = {}
    loose = max(tolerance * shard, 0.1 * total / ranges if ranges else 0)
    probes = [
        Probe(i, total * i / ranges, tolerance * shard if i % per_shard == 0 else loose)
        for i in range(1, ranges)
    ]
    while probes and total:
        depth = probes[0].depth
        finer = next_depth(depth, first)
        children, open_probes = histogram(rows, probes, depth, finer), []
        sums = {p: [0, *accumulate(n for _, n, _ in c)] for p, c in children.items()}
        for probe in probes:
            own, upto = children[probe.prefix], sums[probe.prefix]
            at = max(0, bisect_left(upto, probe.target - probe.before) - 1)
            low, high = probe.before + upto[at], probe.before + upto[at + 1]
            prefix, _, alone = own[at]
            near = min((abs(low - probe.target), 0), (abs(high - probe.target), 1))
            slack = max(probe.slack, GROUP_TOLERANCE * shard) if finer == KEY_BITS else probe.slack
            if near[0] <= slack or alone == 1 or finer == 2 * KEY_BITS:
                borders[probe.range] = border(prefix + near[1], finer)
            else:
                open_probes.append(
                    Probe(probe.range, probe.target, probe.slack, low, finer, prefix)
                )
        probes = open_probes
    return Plan(shards, per_shard, sorted(borders.values()))


def range_of(plan: Plan) -> Column:
    """Number of borders at or below a row's keys, by binary search."""
    if not plan.borders:
        return F.lit(0)
    keys = F.array(*[F.lit(k).cast("long") for k, _ in plan.borders])
    ties = F.array(*[F.lit(t).cast("long") for _, t in plan.borders])
    count = len(plan.borders)
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(count.bit_length()))])

    def step(low: Column, width: Column) -> Column:
        at = low + width
        key, tie = F.try_element_at(keys, at), F.try_element_at(ties, at)
        passed = (key < F.col("_key")) | ((key == F.col("_key")) & (tie <= F.col("_tie")))
        return F.when((at <= count) & passed, at).otherwise(low)

    return F.aggregate(steps, F.lit(0), step)


def exchange(rows: DataFrame, counted: DataFrame, plan: Plan) -> DataFrame:
    """Adds law, shard, slot and grown_shard; ``counted`` holds the keys of the same rows."""
    held = dict(
        counted.groupBy(range_of(plan).alias("r")).agg(F.count("*").alias("n")).collect()
    )
    first_slots = []
    for start in range(0, plan.shards * plan.per_shard, plan.per_shard):
        own = [held.get(start + i, 0) for i in range(plan.per_shard)]
        first_slots += [0, *accumulate(own)][:-1]
    slots = F.array(*[F.lit(n).cast("long") for n in first_slots])
    order = Window.partitionBy("_range").orderBy("_key", "_tie")
    return (
        rows.withColumn("_range", range_of(plan))
        .withColumn("_place", F.row_number().over(order))
        .withColumns(
            {
                "law": F.lit(LAW),
                "shard": F.floor(F.col("_range") / plan.per_shard).cast("int"),
                "slot": F.element_at(slots, F.col("_range") + 1) + F.col("_place") - 1,
                "grown_shard": F.lit(None).cast("int"),
            }
        )
        .drop("_range", "_place", "_key", "_tie")
    )


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The documents with size, text_crc32, law, shard, slot and grown_shard."""
    rows = keyed(docs)
    counted = written(rows.select("size", "_key", "_tie"), "keys")
    return exchange(rows, counted, splitters(counted, shards))


def digest(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``sharded`` without the texts: one scan of them, as the narrow rows are kept."""
    rows = written(keyed(docs).select("doc_id", "size", "text_crc32", "_key", "_tie"), "keys")
    return exchange(rows, rows, splitters(rows, shards))
