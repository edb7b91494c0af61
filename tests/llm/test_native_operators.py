"""Sharding, mixing and decontamination: whole results on odd inputs, and brute force."""

import hashlib
import re
from collections import defaultdict

import pytest
from check_oracle import compare, connect

from spinledger.llm import decontam, mixing, sharding
from spinledger.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, folder, name):
    rows, _, _, problems = compare(spark, connect(folder), folder, QUERIES[name], ORACLES[name])
    assert not problems
    assert rows > 0


# -- sharding ---------------------------------------------------------------


def check_shards(rows, shards, tolerance):
    bytes_of, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        bytes_of[r.shard] += r.size
        slots[r.shard].append(r.slot)
    ideal = sum(bytes_of.values()) / shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(abs(bytes_of[n] - ideal) <= tolerance for n in range(shards))


def test_shards_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = sharding.sharded(docs).collect()
    assert len(rows) == docs.count()
    check_shards(rows, 8, max(r.size for r in rows))
    digest = {r.doc_id: (r.shard, r.slot) for r in sharding.digest(docs).collect()}
    assert digest == {r.doc_id: (r.shard, r.slot) for r in rows}


def test_a_hot_group_is_split_only_where_it_must(spark):
    same = [(i, "x" * 100) for i in range(300)]
    rows = spark.createDataFrame([*same, *[(1000 + i, f"{i}" * 40) for i in range(600)]], "doc_id long, text string")
    found = sharding.sharded(rows, 4).collect()
    check_shards(found, 4, 300)
    small = spark.createDataFrame([(i, f"text {i % 50}" * 10) for i in range(5000)], "doc_id long, text string")
    shards = defaultdict(set)
    for r in sharding.sharded(small, 2).collect():
        shards[r.text].add(r.shard)
    assert sum(len(s) > 1 for s in shards.values()) <= 1


def test_shards_of_odd_rows(odd, none, clashing):
    rows = sharding.sharded(odd).collect()
    assert len(rows) == odd.count()
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert sharding.sharded(clashing).count() == odd.count()
    assert sharding.sharded(none).count() == 0
    assert {r.size for r in rows if r.doc_id in (2, 3)} == {1}


def test_splitters_reach_their_tolerance(spark):
    rows = spark.range(20_000).selectExpr(
        "1L AS size", "shiftrightunsigned(xxhash64(id), 1) AS _key", "0L AS _tie"
    )
    before = sharding.RANGE_BYTES
    try:
        sharding.RANGE_BYTES = 500
        plan = sharding.splitters(rows, 8)
    finally:
        sharding.RANGE_BYTES = before
    assert plan.per_shard == 5 and len(plan.borders) == 39
    keys = sorted(r._key for r in rows.collect())
    for n in range(1, 8):
        key, _ = plan.borders[5 * n - 1]
        assert abs(sum(k < key for k in keys) - 2500 * n) <= 3


# -- mixing -----------------------------------------------------------------


def test_targets_by_repeated_sharing(spark):
    sizes = [("a", 10), ("b", 500), ("c", 1000), (None, 3), ("é", 40), ("z", 0)]
    rows = spark.createDataFrame(sizes, "source string, size long")
    order = ["a", "b", "c", "z", "é", None]
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(order)}
    size, total = dict(sizes), sum(n for _, n in sizes)
    capped: dict = {}
    while True:
        left = total - sum(capped.values())
        open_weight = sum(w for s, w in weight.items() if s not in capped)
        share = {s: left * w / open_weight for s, w in weight.items() if s not in capped}
        above = {s: 3.0 * size[s] for s, t in share.items() if t > 3 * size[s]}
        if not above:
            break
        capped |= above
    want = capped | share
    got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    assert got == pytest.approx(want)


def test_mix_comes_near_its_targets(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    source = {r.doc_id: r.source for r in docs.collect()}
    rows, again = mixing.decide(docs).collect(), mixing.decide(docs).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    taken, target, longest = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        taken[source[r.doc_id]] += r.size * r.copies
        target[source[r.doc_id]] = r.target
        longest[source[r.doc_id]] = max(longest[source[r.doc_id]], r.size)
        assert 0 <= r.copies <= 3
    for s, goal in target.items():
        assert abs(taken[s] - goal) <= longest[s] / 2 + 1
    kept = mixing.mixed(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.copies for r in rows)


def test_preferred_documents_are_taken_more_often(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(
        [(i, "w " * 10, "a" if i % 2 else "b") for i in range(2000)], "doc_id long, text string, source string"
    )
    wish = F.when(F.col("doc_id") % 4 < 2, 1.0).otherwise(3.0)
    rows = mixing.decide(docs, weights=(1, 1), preference=wish).collect()
    liked = sum(r.copies for r in rows if r.doc_id % 4 >= 2)
    assert sum(r.copies for r in rows) == pytest.approx(2000, abs=4)
    assert liked == pytest.approx(1500, abs=60)


def test_mix_of_odd_rows(odd, none, clashing):
    for docs in (odd, clashing):
        rows = mixing.decide(docs).collect()
        assert len(rows) == odd.count()
        mixed = mixing.mixed(docs)
        assert mixed.columns == docs.columns
        assert mixed.count() == sum(r.copies for r in rows)
    assert mixing.decide(none).count() == 0
    assert mixing.mixed(none).count() == 0


# -- decontamination --------------------------------------------------------


def brute_force(docs, items):
    def words(text):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)

    windows = defaultdict(set)
    for item, text in items:
        own = words(text)
        n = min(10, len(own))
        for i in range(len(own) - n + 1 if n else 0):
            windows[tuple(own[i : i + n])].add(item)
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(own) - n + 1):
                items_here = windows.get(tuple(own[i : i + n]))
                if items_here is not None:
                    hit.update(range(i, i + n))
                    found |= {str(x) for x in items_here if x is not None}
        ids = ",".join(sorted(found))
        sha = hashlib.sha256(ids.encode()).hexdigest()
        out.append((str(doc_id), len(own), len(hit), len(found), sha, bool(hit)))
    return sorted(out)


def test_contamination_matches_brute_force(spark, odd, clashing, none):
    long_item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    items = [
        (1, long_item), (2, "short item"), (3, "X"), (4, None), (5, ""), (6, long_item), (None, "no id here"),
        (10, "the quick brown fox jumps over the lazy dog and runs far"), (7, "ten words are just enough to be found in here"),
    ]
    texts = [
        (20, "Alpha, beta. gamma delta epsilon zeta eta theta iota kappa!"),
        (21, "alpha beta gamma delta epsilon zeta eta theta iota"),
        (22, long_item + " and " + long_item),
        (23, "a short item and another short  item; no id here"),
        (24, "short items"),
        (25, "ten words are just enough to be found in here, ten words are"),
        (26, "x"),
    ]
    planted = spark.createDataFrame(texts, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for docs in (planted, odd, clashing):
        want = brute_force([(r.doc_id, r.text) for r in docs.collect()], items)
        rows = decontam.contamination(docs, benchmark).drop("text_hash").collect()
        assert sorted((str(r[0]), *r[1:]) for r in rows) == want
        kept = decontam.clean(docs, benchmark)
        assert kept.columns == docs.columns
        assert kept.count() == sum(not w[-1] for w in want)
    assert decontam.contamination(none, benchmark).count() == 0
    assert decontam.clean(planted, benchmark.filter("false")).count() == len(texts)
