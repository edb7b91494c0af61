import datetime as dt
import difflib
from dataclasses import replace

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from spinledger.operators import (
    feeds,
    flatten,
    genres,
    gold,
    marts,
    modellog,
    pages,
    silver,
    similarity,
    strategies,
    vectors,
)
from spinledger.sources import landing


def test_flatten_play_with_missing_parts(spark, tmp_path):
    from spinledger import schema

    lines = [
        '{"played_at": "2024-01-01T00:00:01.250Z", "track": {"id": "t", "name": "n", '
        '"artists": [], "album": {"release_date": "2015"}}, "context": null}',
        '{"played_at": "2024-01-01T05:00:00+01:00", "track": {"id": "u", '
        '"artists": [{"id": "a", "name": "A"}, {"id": "b"}]}, "context": {"type": "album"}}',
    ]
    (tmp_path / "x.json").write_text("\n".join(lines))
    raw = spark.read.schema(schema.RAW_PLAY).json(str(tmp_path))
    first, second = flatten.flatten_plays(raw).orderBy("track_id").collect()
    assert first.played_at == dt.datetime(2024, 1, 1, 0, 0, 1, 250000)
    assert first.played_at_timestamp == 1704067201
    assert (first.primary_artist_id, first.context_type, first.context_external_urls) == (
        None, None, None,
    )
    assert second.played_at == dt.datetime(2024, 1, 1, 4, 0)
    assert (second.primary_artist_id, second.context_type) == ("a", "album")
    assert second.context_external_urls == "{}"
    found = {r.id: r.name for r in flatten.unique_artists(raw).collect()}
    assert found == {"a": "A", "b": None}


def test_bad_line_skips_its_whole_file(spark, tmp_path):
    (tmp_path / "good.json").write_text('{"track_id": "1"}\n{"track_id": "2"}\n')
    (tmp_path / "bad.json").write_text('{"track_id": "3"}\nnot json\n')
    got = landing.read_plays(spark, str(tmp_path)).collect()
    assert sorted(r.track_id for r in got) == ["1", "2"]
    assert all(r.file_name.endswith("good.json") for r in got)


def test_feed_casts_are_tolerant(spark, tmp_path):
    (tmp_path / "f.json").write_text(
        '{"track_id": "1", "track_popularity": 7, "album_release_date": "bad", '
        '"preference_score": "x", "discovered_at": "2024-01-01T00:00:00"}\n'
    )
    row = landing.read_discoveries(spark, str(tmp_path)).head()
    assert (row.track_popularity, row.album_release_date, row.preference_score) == (7, None, None)
    assert row.discovered_at == dt.datetime(2024, 1, 1)


def test_genre_dictionary_keeps_the_last_line(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text("artist,genre\n a , rock \nb,pop\na,jazz\n")
    rows = landing.read_genre_dictionary(spark, str(path)).collect()
    assert {(r.artist, r.genre) for r in rows} == {("a", "jazz"), ("b", "pop")}


def test_dedupe_is_idempotent(spark):
    rows = spark.createDataFrame(
        [("k", 1, dt.datetime(2024, 1, 1)), ("k", 2, dt.datetime(2024, 1, 2)),
         ("l", 3, dt.datetime(2024, 1, 1))],
        "unique_play string, v int, ingested_at timestamp_ntz",
    ).withColumn("played_at", F.col("ingested_at"))
    once = silver.dedupe_plays(rows)
    assert sorted(r.v for r in once.collect()) == [2, 3]
    assert sorted(silver.dedupe_plays(once).collect()) == sorted(once.collect())


def test_not_listened_ignores_null_keys(spark):
    candidates = spark.createDataFrame([("a",), ("b",)], "track_id string")
    listened = spark.createDataFrame([("a",), (None,)], "track_id string")
    assert [r.track_id for r in silver.not_listened(candidates, listened).collect()] == ["b"]


@pytest.mark.parametrize(
    "name, genre",
    [("DJ_Tom", "electronic"), ("The House Band", "electronic"), ("Lil X", "hip hop"),
     ("Djx", None), ("Rapper's Pop", "hip hop"), ("Soul Blues", "jazz"), ("", None)],
)
def test_first_name_pattern_wins(spark, name, genre):
    assert spark.range(1).select(genres.genre_from_name(F.lit(name))).head()[0] == genre


@pytest.mark.parametrize(
    "name, genre",
    [("alternative rock", "rock"), ("blues", "jazz"), ("indie alternative", "indie"), ("x", None)],
)
def test_scored_patterns(spark, name, genre):
    assert spark.range(1).select(genres.scored_name_genre(F.lit(name))).head()[0] == genre


def test_later_dictionary_entries_won(spark):
    known = {r.known_name: r.known_genre for r in genres.known_artists(spark).collect()}
    assert (known["taylor swift"], known["the weeknd"]) == ("country", "r&b")


def test_clean_genre_name(spark):
    rows = spark.createDataFrame([("Hip%20Hop",), ("R&B/Soul!",), ("",), (None,)], "g string")
    got = [r[0] for r in rows.select(genres.clean_genre_name(F.col("g"))).collect()]
    assert got == ["hip-hop", "rbsoul", None, None]


def test_silver_edges(spark):
    plays = spark.createDataFrame(
        [("1", "a", None, "2015"), ("2", None, "album", "bad"), ("3", "zz", "artist", None)],
        "unique_play string, primary_artist_id string, context_type string, album_release_date string",
    ).withColumns(
        {
            "played_at": F.expr("timestamp_ntz'2024-01-01 03:00:00'"),
            **{
                c: F.lit(None).cast(kind)
                for c, kind in {
                    "played_at_timestamp": "bigint", "track_id": "string", "track_name": "string",
                    "track_duration_ms": "bigint", "track_popularity": "int",
                    "track_explicit": "boolean", "track_preview_url": "string",
                    "track_uri": "string", "primary_artist_name": "string", "album_id": "string",
                    "album_name": "string", "album_type": "string", "album_total_tracks": "int",
                    "context_uri": "string", "ingested_at": "timestamp_ntz",
                    "data_source": "string",
                }.items()
            },
        }
    )
    artists = spark.createDataFrame(
        [("a", None, 5, "rock", ["rock", "pop"], 2)],
        "artist_id string, popularity int, followers_total bigint, primary_genre string, "
        "genres_list array<string>, genre_count int",
    )
    rows = {r.unique_play: r for r in silver.enrich_plays(plays, artists).collect()}
    assert rows["1"].local_date == dt.date(2023, 12, 31)
    assert (rows["1"].listening_source, rows["1"].is_multi_genre_artist) == ("unknown", True)
    assert (rows["1"].album_age_years, rows["1"].album_release_year) == (8, 2015)
    assert (rows["2"].primary_genre, rows["2"].album_release_year) == (None, None)
    assert (rows["3"].is_multi_genre_artist, rows["3"].is_single) == (False, False)
    exact = silver.enrich_plays(plays, artists, exact_event_number=True).collect()
    assert sorted(r.listening_event_id for r in exact) == [1, 2, 3]


def test_genre_shares_add_up(tables):
    rows = gold.genre_analysis(tables.silver).collect()
    assert abs(sum(r.percentage_of_total_listening for r in rows) - 100) < 0.2
    assert sorted(r.genre_rank for r in rows) == list(range(1, len(rows) + 1))


def test_similarity_is_symmetric_and_bounded(tables):
    sessions = similarity.genre_sessions(tables.silver, tables.as_of)
    rows = similarity.genre_similarity(sessions).collect()
    score = {(r.genre_1, r.genre_2): r.similarity_score for r in rows}
    assert score and all(score[b, a] == s for (a, b), s in score.items())
    assert all(0 < s <= 1 for s in score.values())


def test_artist_bands_lose_no_pair(spark):
    rows = [(f"{i:03d}", f"n{i}", f"g{i % 3}", 1 + i % 2, float((i * 37) % 101)) for i in range(90)]
    profile = spark.createDataFrame(
        rows,
        "primary_artist_id string, primary_artist_name string, primary_genre string, "
        "genre_count bigint, avg_popularity double",
    )
    for least in (0.5, 0.8, 0.95, 1.0):
        want = set()
        for a in rows:
            for b in rows:
                if a[0] < b[0] and a[2] == b[2]:
                    s = 1 / (a[3] + b[3] - 1) * 0.7 + (1 - abs(a[4] - b[4]) / 100.0) * 0.3
                    if s >= least:
                        want.add((a[0], b[0]))
        got = similarity.artist_similarity(profile, least).collect()
        assert {(r.artist_1_id, r.artist_2_id) for r in got} == want
        assert len(got) == len(want)


def test_temporal_cut_equals_full_join(spark):
    patterns = spark.createDataFrame(
        [(f"g{i % 3}", i % 24, i % 5 == 0, (i * 7 % 40) / 100 + 0.1, "strong") for i in range(60)],
        "primary_genre string, local_hour int, is_weekend boolean, "
        "hour_genre_probability double, temporal_strength string",
    )
    features = spark.createDataFrame(
        [(f"t{i:02d}", f"g{i % 3}", i * 13 % 20 * 5, 0) for i in range(40)],
        "track_id string, primary_genre string, track_popularity int, user_play_count int",
    ).withColumns(
        {
            "popularity_normalized": F.col("track_popularity") / 100,
            "track_name": F.lit("n"), "primary_artist_name": F.lit("a"), "album_name": F.lit("b"),
        }
    )
    got = strategies.temporal(patterns, features, 10, False, per_genre=4, min_relevance=0.0)
    relevance = strategies.hour_relevance(10, False, 1, 2)
    full = patterns.join(features, "primary_genre").withColumn(
        "s",
        F.round(
            relevance * 0.5 + F.col("hour_genre_probability") * 0.3
            + F.col("popularity_normalized") * 0.2, 9,
        ),
    )
    want = {}
    for r in sorted(full.collect(), key=lambda r: (-r.s, r.track_id, r.local_hour, r.is_weekend)):
        want.setdefault(r.primary_genre, []).append((r.track_id, r.s))
    best = {}
    for r in got.orderBy("primary_genre", "genre_temporal_rank").collect():
        best.setdefault(r.primary_genre, []).append((r.track_id, round(r.recommendation_score, 9)))
    assert best == {g: rows[:4] for g, rows in want.items()}


def test_diversity_ranks_match_a_plain_window(spark):
    rows = [(f"t{i:02d}", f"a{i % 4}", f"g{i % 2}" if i % 5 else None, i * 7 % 30) for i in range(40)]
    feed = spark.createDataFrame(
        rows, "track_id string, primary_artist_name string, seed_genre string, track_popularity int"
    )
    got = {r.track_id: r for r in feeds.diversity_ranks(feed).collect()}
    for key, name in ((1, "artist_diversity_rank"), (2, "genre_diversity_rank")):
        groups = {}
        for r in sorted(rows, key=lambda r: (-r[3], r[0])):
            groups.setdefault(r[key], []).append(r[0])
        for ids in groups.values():
            assert [got[i][name] for i in ids] == [n + 1 for n in range(len(ids))]


def test_feed_upsert_twice_in_one_batch(tables):
    early = F.col("discovered_at") < F.expr("timestamp_ntz'2024-01-26 00:00:00'")
    now = F.expr("timestamp_ntz'2024-02-01 00:00:00'")
    rows = tables.ml_feed
    empty = feeds.reduce_ml_source(rows).limit(0).withColumns({"created_at": now, "updated_at": now})
    once = feeds.upsert_ml_discoveries(empty, rows, now)
    two = feeds.upsert_ml_discoveries(empty, rows.filter(early), now)
    two = feeds.upsert_ml_discoveries(two, rows.filter(~early), now)
    columns = ["track_id", "discovery_count", "ml_recommendation_score"]
    assert sorted(once.select(*columns).collect()) == sorted(two.select(*columns).collect())


def test_pages_against_brute_force(spark):
    texts = spark.createDataFrame(
        [(1, "the daft punk show by szabo"), (2, "a coldpley and coldplay night"),
         (3, "coldplaz only"), (4, "radioheadd xdaft punky")],
        "page_id bigint, body string",
    )
    names = ["daft punk", "sza", "coldplay", "radiohead", "a", "nothing here"]
    table = spark.createDataFrame([(n,) for n in names], "name string")
    bodies = {r.page_id: r.body for r in texts.collect()}
    hits = {(r.page_id, r.name) for r in pages.contained_names(texts, table).collect()}
    assert hits == {(p, n) for p, b in bodies.items() for n in names if n in b}
    fuzzy = {(r.page_id, r.name): r.similar_word for r in pages.fuzzy_names(texts, table).collect()}
    assert fuzzy == {(3, "coldplay"): "coldplaz"}


def test_long_names_across_words(spark):
    body = "we saw the quick brown fox jump over it and a b c d e, the end"
    texts = spark.createDataFrame([(1, body), (2, "the quick"), (3, "")], "page_id bigint, body string")
    names = ["aw the quick brown fo", "he quick brown fox jump ov", "the slow brown fox jump", "a b c d e",
             "the quick", "quick brown fox", "and a b c d e, the end", "b", "e en", "fox  jump"]
    table = spark.createDataFrame([(n,) for n in names], "name string")
    want = {(p, n) for p, b in [(1, body), (2, "the quick")] for n in names if n in b}
    try:
        for limit in ["1000000", "0"]:
            spark.conf.set("spinledger.broadcast.maxBytes", limit)
            hits = {(r.page_id, r.name) for r in pages.contained_names(texts, table).collect()}
            assert hits == want
    finally:
        spark.conf.unset("spinledger.broadcast.maxBytes")


def test_names_of_links_and_titles(spark):
    html = '<title>Sigur\n  Rós &amp; Co</title><a href="/Björk">x</a><a href="/東京 事変">y</a><a href="/">z</a>'
    rows = spark.createDataFrame([(1, html), (2, None)], "page_id bigint, html string")
    assert {r.name for r in pages.link_names(rows).collect()} == {"sigur rós &amp; co", "björk", "東京 事変"}


@pytest.mark.parametrize("limit", ["1000000", "0"])
def test_names_on_pages_without_id_and_common_names(spark, limit):
    bodies = [(None, "a daft punk show"), (None, "no hit"), (1, "a b a c"), (2, "banana daft")]
    texts = spark.createDataFrame(bodies, "page_id bigint, body string")
    names = ["daft punk", "a", "an", "b", "daft", "na"]
    table = spark.createDataFrame([(n,) for n in names], "name string")
    try:
        spark.conf.set("spinledger.broadcast.maxBytes", limit)
        hits = sorted(map(str, pages.contained_names(texts, table).collect()))
    finally:
        spark.conf.unset("spinledger.broadcast.maxBytes")
    want = {(p, n) for p, b in bodies for n in names if n in b}
    assert hits == sorted(str(Row(page_id=p, name=n)) for p, n in want)


def test_a_title_has_few_pieces(spark):
    title = "thshly theaoror anblest thtionnt ndedin lysh oned onerre. of"
    names = spark.createDataFrame([(title,), ("coldplay",)], "name string")
    lengths = spark.createDataFrame([(52,), (8,)], "_length int")
    rows = pages.pieces_of(names, lengths, 0.8).groupBy("name").count().collect()
    assert {r.name: r["count"] for r in rows}[title] <= 120
    assert {r.name: r["count"] for r in rows}["coldplay"] <= 8


def test_fuzzy_names_against_all_pairs(spark):
    import random

    rng = random.Random(5)

    def text(letters, low, high):
        return "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))

    words = [text("abé", 1, 12) for _ in range(200)] + [text("ab", 25, 40) for _ in range(20)]
    names = [text("abé", 1, 12) for _ in range(60)] + [text("ab", 4, 6) + " " + text("ab", 3, 6) for _ in range(30)]
    names += [w[:k] + "é" + w[k + 2 :] for k, w in enumerate(words[-20:])]
    names += [w[:2] + " " + w[2:] for w in words[:60] if len(w) > 5] + [w[1:] + w[0] for w in words[:40]]
    texts = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "page_id bigint, body string")
    table = spark.createDataFrame([(n,) for n in sorted(set(names))], "name string")

    def ratio(name, word):
        return difflib.SequenceMatcher(None, name, word).ratio()

    want = {
        (i, n, w, round(ratio(n, w), 6))
        for i, w in enumerate(words)
        for n in set(names)
        if n not in w and len(w) > 3 and ratio(n, w) > 0.8
    }
    got = {tuple(r) for r in pages.fuzzy_names(texts, table).select("page_id", "name", "similar_word", "ratio").collect()}
    assert got == want and len(want) > 100


@pytest.mark.parametrize("block", [3, 4096])
def test_gap_sessions_of_a_hot_user(spark, block):
    import random

    rng = random.Random(8)
    base, gap, plays = dt.datetime(2023, 12, 31, 22), 60, []
    for user, count in [("hot", 600), ("b", 90), (None, 60), ("lone", 1)]:
        second = 0
        for _ in range(count):
            second += rng.choice([0, 1, 7, 30, 59, 60, 61, 500])
            plays.append((user, base + dt.timedelta(seconds=second, microseconds=rng.randrange(10**6))))
    plays += [("b", None)]
    rng.shuffle(plays)
    want = set()
    for user in {u for u, _ in plays}:
        times = sorted(at.replace(microsecond=0) for u, at in plays if u == user and at)
        run = []
        for at in [*times, None]:
            if run and (at is None or (at - run[-1]).total_seconds() >= gap):
                want.add((user, run[0], run[-1], len(run)))
                run = []
            run.append(at)
    table = spark.createDataFrame(plays, "user_id string, played_at timestamp_ntz")
    got = similarity.gap_sessions(table, "60 seconds", block=block)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(want) > 50 and set(rows) == want
    assert similarity.gap_sessions(table.limit(0), "1 hour").count() == 0
    # plays are added up per user and slot in the map tasks; no operator gathers a user's plays
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_count(1)" in plan and "MergingSessions" not in plan


@pytest.mark.parametrize("block, cells", [(7, 9), (2048, 1024), (50, 1)])
def test_nearest_tracks_against_all_pairs(spark, block, cells):
    import numpy as np

    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 5))
    points = [centres[i % 6] + rng.normal(scale=0.1, size=5) for i in range(150)]
    points += [points[0]] * 80 + [np.zeros(5)] * 2
    unit = [p / (np.linalg.norm(p) or 1.0) for p in points]
    ids = [f"t{i:03}" for i in range(len(unit))]
    table = spark.createDataFrame(
        [(t, [float(x) for x in v]) for t, v in zip(ids, unit)] + [(None, [0.0] * 5)],
        "track_id string, vector array<double>",
    )
    scores = np.round(np.array(unit) @ np.array(unit).T, 9) + 0.0
    want = set()
    for i, t in enumerate(ids):
        order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-scores[i, j], ids[j]))
        want |= {(t, ids[j], scores[i, j], r) for r, j in enumerate(order[:4], 1)}
    got = vectors.nearest_tracks(table, 4, cells, block)
    assert {(a, b, c + 0.0, d) for a, b, c, d in got.collect()} == want
    assert vectors.nearest_tracks(table.limit(0)).count() == 0
    assert vectors.nearest_tracks(table.limit(3), 10).count() == 6


def test_deploy_rollback_history(spark):
    day = dt.datetime
    log = spark.createDataFrame(
        [("m", "v1", "production", day(2024, 1, 1), "active", None)],
        "model_name string, version string, deployment_environment string, "
        "deployment_timestamp timestamp_ntz, deployment_status string, previous_version string",
    ).withColumn("rollback_available", F.lit(True))
    asked = spark.createDataFrame(
        [("m", "v2", "production", day(2024, 1, 2))],
        "model_name string, version string, deployment_environment string, "
        "deployment_timestamp timestamp_ntz",
    )
    log = log.unionByName(modellog.deploy(log, asked))
    back = asked.drop("version").withColumn(
        "deployment_timestamp", F.expr("timestamp_ntz'2024-01-03 00:00:00'")
    )
    log = log.unionByName(modellog.rollback(log, back))
    active = modellog.active_versions(log).head()
    assert (active.version, active.previous_version) == ("v1", "v2")
    states = [r.current_status for r in modellog.deployment_history(log).orderBy("deployment_timestamp").collect()]
    assert states == ["replaced", "rolled_back", "active_rollback"]
    other = back.withColumn("model_name", F.lit("unknown"))
    assert modellog.rollback(log, other).count() == 0


def test_marts_scan_the_plays_once_and_expand_nothing(spark, tables):
    from spinledger.operators import gold

    plays = tables.silver_table
    for mart in (gold.daily_summary, gold.genre_analysis):
        rows = mart(spark.createDataFrame([], tables.silver.schema).unionByName(plays, allowMissingColumns=True))
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and plan.count("FileScan parquet") == 1


def test_factorisation_follows_the_updates_and_falls(spark):
    import numpy as np

    from spinledger.operators import factors

    rng = np.random.default_rng(2)
    v = rng.gamma(1.0, 5.0, (60, 7)) * (rng.random((60, 7)) < 0.5)
    v[0] = 0
    v[0, 6] = 1.0
    rows = [(str(u), f"g{g}", float(v[u, g])) for u in range(60) for g in range(7) if v[u, g] > 0]
    rows += [(None, "g1", 1.0), ("1", None, 1.0), ("2", "g1", None)]
    schema = "user_id string, primary_genre string, weighted_preference double"
    likes = spark.createDataFrame(rows, schema)
    found = factors.factorise(likes, rank=4, iterations=6)
    users = sorted({u for u, g, x in rows if u and g and x})
    v = v[[int(u) for u in users]]
    names = [f"g{g}" for g in range(7)]
    w, h = factors.first_factors(users, 4), factors.first_factors(names, 4).T
    lw, lh, objective = 0.05 * 7, 0.05 * len(users), []
    for _ in range(6):
        w = w * (v @ h.T) / (w @ h @ h.T + lw + lw * w)
        loss = ((v - w @ h) ** 2).sum() / 2
        objective.append(loss + lw * (w.sum() + (w**2).sum() / 2) + lh * (h.sum() + (h**2).sum() / 2))
        h = h * (w.T @ v) / (w.T @ w @ h + lh + lh * h)
    assert np.allclose(found.objective, objective, rtol=1e-6)
    assert all(b < a for a, b in zip(found.objective, found.objective[1:]))
    got = {r.user_id: r.factors for r in found.users.collect()}
    assert sorted(got) == users and np.allclose([got[u] for u in users], w)
    best = factors.best_genres(found, 3).filter("user_id = '0'").orderBy("rank").collect()
    order = np.argsort(-(w[users.index("0")] @ h), kind="stable")[:3]
    assert [r.genre for r in best] == [names[i] for i in order]
    empty = factors.factorise(spark.createDataFrame([], schema), 2, 2)
    assert factors.best_genres(empty).count() == 0


def test_daily_states_with_play_keys_exchange_each_play_once(spark):
    """Plays told apart by their key are not summed into cells first; repeated keys count once."""
    plays = spark.sql(
        """SELECT date'2024-01-01' + int(id % 3) AS local_date, false AS is_weekend, 1 AS local_quarter,
  2024 AS local_year, string(id % 7) AS track_id, string(id % 5) AS primary_artist_id, 'a' AS album_id,
  CASE WHEN id % 2 = 0 THEN 'pop' END AS primary_genre, string(id % 30) AS unique_play,
  timestamp_ntz'2024-01-01 10:00:00' AS local_timestamp, 10 AS local_hour, 1.5D AS track_duration_minutes,
  false AS is_multi_genre_artist, 'album' AS listening_source, 50 AS track_popularity,
  40 AS artist_popularity, timestamp_ntz'2024-01-02 00:00:00' AS ingested_at FROM range(60)"""
    )
    states = marts.DAY_WITH_KEYS.states(plays)
    plan = states._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    summed = replace(marts.DAY_WITH_KEYS, summed=True).states(plays)
    assert sorted(map(str, states.collect())) == sorted(map(str, summed.collect()))
    for row in gold.daily_summary(plays, top="min", plays_unique=False).collect():
        assert (row.total_plays, row.repeat_play_percentage, row.top_genre) == (20, 50.0, "pop")
