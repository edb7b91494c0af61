"""SimHash components and nearest neighbours against brute force, and the pipeline."""

import math

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from spinledger.llm import components, mih, simhash


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if counts[bit] * 2 > len(shingles))


def brute_components(ids, fps):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i in range(len(fps)):
        known = [x for x in (least.get(root(i)), ids[i]) if x is not None]
        least[root(i)] = min(known, default=None)
    return [least[root(i)] for i in range(len(fps))]


def test_near_duplicates_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id")
    rows = [tuple(r) for r in docs.collect()]
    fps = [plain_fingerprint(t) for _, t in rows]
    want = brute_components([i for i, _ in rows], fps)
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert [got[i] for i, _ in rows] == list(zip(fps, want, strict=True))
    kept = simhash.first_of_each(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want))


@pytest.mark.parametrize("bits", [0, 3, 7])
def test_links_of_random_balls(spark, bits, monkeypatch):
    rng = np.random.default_rng(bits)
    fps = set()
    for _ in range(15):
        centre = int(rng.integers(0, 1 << 63))
        for _ in range(8):
            flips = rng.choice(64, rng.integers(0, 6), replace=False)
            fps.add(centre ^ int(sum(1 << int(b) for b in flips)))
    fps = sorted(fps)
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    distinct = spark.createDataFrame([(f,) for f in signed], "fp long")
    monkeypatch.setattr(simhash, "prefix_bits", lambda *a, **k: bits)
    monkeypatch.setattr(simhash, "VARIANTS", 1 << 12)
    roots = {r.node: r.root for r in components.connected(simhash.links(distinct, len(fps))).collect()}
    want = brute_components(list(range(len(fps))), fps)
    groups = {}
    for f, c in zip(signed, want, strict=True):
        groups.setdefault(c, set()).add(roots.get(f, f))
    assert all(len(g) == 1 for g in groups.values())
    assert len({min(g) for g in groups.values()}) == len(groups)


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(5, 5)]
    found = components.connected(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.root) for r in found} == {(i, 100) for i in range(100, 141)} | {
        (i, 7) for i in (7, *range(200, 260))
    }


def test_near_duplicates_of_odd_rows(odd, none, clashing):
    for docs in (odd, clashing):
        rows = simhash.near_duplicates(docs).collect()
        assert len(rows) == odd.count()
        ids = {r.doc_id: r.component_id for r in rows}
        assert ids[6] == 1 and ids[3] == 2 and ids[4] == 2
        kept = simhash.first_of_each(docs)
        assert kept.columns == docs.columns
        names = [r.doc_id for r in kept.collect()]
        assert names.count(1) == 1 and 6 not in names and 3 not in names
        assert names.count(7) == 2  # one id, two texts
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.first_of_each(none).count() == 0


def test_neighbours_reach_recall(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in table.collect()]
    found = {}
    for r in mih.neighbours(table, every=25).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    recall = []
    for i, v in rows:
        if i % 25:
            continue
        near = sorted((math.sqrt(((v - w) ** 2).sum()), j) for j, w in rows if j != i)
        own = sorted(found[i])
        assert [n for n, _, _ in own] == list(range(1, 11))
        exact = {j: d for d, j in near}
        assert all(abs(exact[j] - s) < 1e-12 for _, j, s in own)
        assert [s for _, _, s in own] == sorted(s for _, _, s in own)
        recall.append(len({j for _, j, _ in own} & {j for _, j in near[:10]}) / 10)
    assert sum(recall) / len(recall) >= 0.9


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    base = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(1, 40)]
    rows = [
        *base, (100, [1.0, 1.0, 1.0]), (200, [1.0, 1.0, 1.0]), (200, [1.0, 1.0, 1.0]), (300, None),
        (400, [0.0, 0.0, 0.0]), (500, [nan, 1.0, 1.0]), (600, [inf, 1.0, 1.0]), (700, [1.0, None, 1.0]),
        (None, [1.0, 1.0, 1.0]), (800, [1.0, 2.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn(
        "score", F.lit("clash")
    )
    got = {}
    for r in mih.neighbours(table).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {100, 200}
    sound = [(i, np.array(v)) for i, v in [*base, *[(100, [1.0] * 3), (200, [1.0] * 3), (200, [1.0] * 3)]]]
    for q, own in got.items():
        others = list(sound)
        others.pop(next(n for n, (i, _) in enumerate(others) if i == q))
        near = sorted((math.sqrt(((v - np.ones(3)) ** 2).sum()), i) for i, v in others)[:10]
        assert [(i, s) for _, i, s in sorted(own)] == [(i, d) for d, i in near]
    assert mih.neighbours(table.filter("vec_id = 100")).count() == 0
    assert mih.neighbours(table.filter("false")).count() == 0
    assert mih.neighbours(table.filter("vec_id IN (100, 200)")).count() == 4


def test_one_id_with_several_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4).round(3).tolist()) for i in [100, 100, 100, 200, *range(1, 30)]]
    table = spark.createDataFrame([*rows, rows[0]], "vec_id long, embedding array<double>")
    got = {}
    for r in mih.neighbours(table).collect():
        got.setdefault((r.query_id, r.query_key), []).append((r["rank"], r.vec_id, round(r.score, 9)))
    want = []
    for n, (i, v) in enumerate(rows[:4]):
        others = [*rows[:n], *rows[n + 1 :], rows[0]]
        near = sorted((round(math.dist(v, w), 9), j) for j, w in others)[:10]
        want.append((i, [(k, j, d) for k, (d, j) in enumerate(near, 1)]))
    assert sorted((q, sorted(own)) for (q, _), own in got.items()) == sorted(want)


def test_pipeline_stages_take_effect(spark, folder):
    before = spark.read.parquet(f"{folder}/documents.parquet")
    columns, docs = before.columns, before
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == columns, name
        assert set(r.doc_id for r in after.collect()) <= set(r.doc_id for r in docs.collect())
        docs = corpus_pipeline.written(after, name)
    rows = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
    assert {r.shard for r in rows} <= set(range(8))
