import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from spinledger.operators import gold
from spinledger.plans import incremental_queries
from spinledger.plans.incremental_queries import nested_plays
from spinledger.sources import tables as stored
from spinledger.sources.driver_tables import Tables
from spinledger.streaming import ingest


@pytest.mark.parametrize("files", [2])
def test_stream_equals_batch(spark, tables, tmp_path, files):
    raw, silver, daily = (str(tmp_path / n) for n in ("raw", "silver", "gold"))
    plays = nested_plays(tables)
    plays.repartition(3).write.json(raw)
    plays.repartition(3, "track.id").write.mode("append").json(raw)  # every play once more
    lines = ingest.stream_lines(spark, raw, files_per_batch=files)
    step = ingest.silver_and_gold(silver, daily, tables.artists)
    ingest.start(lines, str(tmp_path / "c"), step, "s").awaitTermination()

    written = spark.read.parquet(silver)
    assert written.count() == tables.silver.count()
    assert written.select("unique_play").distinct().count() == written.count()
    got = ingest.open_marts(spark, daily)
    want = {
        "daily_summary": gold.daily_summary(tables.silver),
        "genre_analysis": gold.genre_analysis(tables.silver),
        "monthly_insights": gold.monthly_insights(tables.silver),
    }
    for name, rows in want.items():
        # ingested_at is the time of landing here
        columns = [c for c in rows.columns if c != "last_updated"]
        pairs = (sorted(map(str, df.select(*columns).collect())) for df in (got[name], rows))
        assert next(pairs) == next(pairs), name

    # nothing new: a second run adds no row
    ingest.start(lines, str(tmp_path / "c"), step, "s").awaitTermination()
    assert spark.read.parquet(silver).count() == tables.silver.count()


def test_stream_skips_files_with_a_bad_line(spark, tables, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    nested_plays(tables).limit(20).coalesce(1).write.json(str(raw))
    good = next(raw.glob("part-*")).read_text().splitlines()
    (raw / "part-bad.json").write_text("{broken\n" + good[0].replace("2024", "2023") + "\n")
    step = ingest.append_plays(out, tables.artists)
    lines = ingest.stream_lines(spark, str(raw), files_per_batch=1)
    ingest.start(lines, str(tmp_path / "c"), step, "b").awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.count() == 20
    assert rows.filter("unique_play IS NULL").count() == 0


def test_silver_is_written_once_and_a_batch_of_known_plays_touches_no_mart(spark, tables, tmp_path, monkeypatch):
    """Silver rows are not put aside before they are appended; without new plays the marts rest."""
    raw, silver, daily = str(tmp_path / "raw"), str(tmp_path / "silver"), str(tmp_path / "daily")
    aside, merged = [], []
    put, merge = ingest.materialise, ingest.merge_partitions
    monkeypatch.setattr(ingest, "materialise", lambda df, path, *a: aside.append(path) or put(df, path, *a))
    monkeypatch.setattr(ingest, "merge_partitions", lambda d, p, *a: merged.append(p) or merge(d, p, *a))
    step = ingest.silver_and_gold(silver, daily, tables.artists)
    plays = nested_plays(tables).limit(40).localCheckpoint()
    for number in range(2):
        plays.coalesce(1).write.mode("append").json(raw)
        lines = ingest.stream_lines(spark, raw)
        ingest.start(lines, str(tmp_path / "c"), step, f"once{number}").awaitTermination()
    assert aside == []
    assert sorted(p.rsplit("/", 1)[1] for p in merged) == ["day", "genre", "month"]
    rows = spark.read.parquet(silver)
    assert (rows.count(), {r.batch for r in rows.select("batch").distinct().collect()}) == (40, {0})


def test_files_of_a_batch_follow_the_plays(spark, folder, monkeypatch):
    tables = Tables(spark, folder)
    plays = tables.read("events").count()
    assert incremental_queries.files_a_batch(tables) == 1
    monkeypatch.setattr(incremental_queries, "PLAYS_A_FILE", 100)
    assert incremental_queries.files_a_batch(tables) == -(-plays // 300)
    monkeypatch.setattr(incremental_queries, "PLAYS_A_FILE", plays // 6)
    got = incremental_queries.stream_to_silver(tables)
    assert len(list(Path(tables.scratch, "raw").glob("part-*"))) > 7
    assert got.count() == tables.silver.count()


def test_upsert_touches_few_partitions_and_repeats_nothing(spark, tables, tmp_path):
    path = tmp_path / "t"
    step = ingest.upsert_ml(str(path), F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz"))
    rows = tables.ml_feed.drop("ingested_at").withColumn("batch_timestamp", F.lit("x"))
    step(rows, 0)
    before = {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}
    assert len({p.parent for p in before}) > 30
    few = rows.filter("track_id IN ('1', '2')")
    step(few, 1)
    after = {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}
    kept = {p for p in before if after.get(p) == before[p]}
    assert 0 < len({p.parent for p in after if p not in kept}) <= 2
    first = sorted(map(str, spark.read.parquet(str(path)).collect()))
    step(few, 1)
    step(rows, 0)
    assert sorted(map(str, spark.read.parquet(str(path)).collect())) == first
    counts = {r.track_id: r.discovery_count for r in spark.read.parquet(str(path)).collect()}
    assert (counts["1"], counts["3"]) == (4, 2)


def test_marts_survive_a_batch_that_broke_off(spark, tables, tmp_path):
    """A repeated batch adds nothing to partitions that it had reached before."""
    plays = tables.silver.withColumn("ingested_at", F.lit(None).cast("timestamp_ntz"))
    first, second = plays.filter("local_hour < 12"), plays.filter("local_hour >= 12")
    states, out = str(tmp_path / "states"), str(tmp_path / "gold")
    step = ingest.refresh_marts(states, out)
    step(first, 0)
    # half of batch 1 arrives: the daily states, not the others
    mart, _ = ingest.MARTS["day"]
    ingest.merge_partitions(
        mart.states(second).withColumn("part", F.col("local_date")), states + "/day", "part", 1,
        lambda old, new: mart.merge(old.unionByName(new).drop("part")).withColumn("part", F.col("local_date")),
    )
    step(second, 1)
    step(second, 1)
    got = ingest.open_marts(spark, out)
    for name, rows in (
        ("daily_summary", gold.daily_summary(plays)),
        ("genre_analysis", gold.genre_analysis(plays)),
        ("monthly_insights", gold.monthly_insights(plays)),
    ):
        pairs = (sorted(map(str, df.select(*rows.columns).collect())) for df in (got[name], rows))
        assert next(pairs) == next(pairs), name


def test_new_checkpoint_over_old_batches_is_refused(spark, tables, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    nested_plays(tables).limit(5).coalesce(1).write.json(raw)
    lines = ingest.stream_lines(spark, raw)
    step = ingest.append_plays(out, tables.artists)
    ingest.start(lines, str(tmp_path / "c1"), step, "n1", target=out).awaitTermination()
    ingest.start(lines, str(tmp_path / "c1"), step, "n2", target=out).awaitTermination()
    with pytest.raises(ValueError):
        ingest.start(lines, str(tmp_path / "c2"), step, "n3", target=out)


def test_listening_cycle_retries_quarantines_and_compacts(spark, tables, tmp_path):
    raw, silver, files = tmp_path / "raw", str(tmp_path / "silver"), str(tmp_path / "quarantine")
    nested_plays(tables).limit(60).repartition(4).write.json(str(raw))
    broken = raw / "part-00000-broken.json"
    good = next(raw.glob("part-0*")).read_text()
    broken.write_text(good.replace("2024", "2023") + "{half a line")
    step, seen = ingest.append_plays(silver, tables.artists, files), []

    def flaky(batch, number):
        step(batch, number)
        seen.append(number)
        if seen.count(number) == 1 and number == 2:
            raise RuntimeError("lost after writing")

    lines = ingest.stream_lines(spark, str(raw), files_per_batch=1)
    checkpoint = str(tmp_path / "c")
    assert ingest.run_cycle(lines, checkpoint, flaky, "cycle", target=silver) == 1
    assert seen.count(2) == 2
    assert ingest.live_plays(spark, silver).count() == 60
    row = ingest.quarantined(spark, files).first()
    assert row.attempts >= 1 and not row.recovered and "half a line" in row.reason
    # the file is mended; the next batch reads it again while it has an attempt left
    attempts = row.attempts
    broken.write_text(good.replace("2024", "2023"))
    (raw / "part-last.json").write_text(good)
    ingest.run_cycle(lines, checkpoint, step, "cycle", target=silver)
    added = len(good.splitlines()) if attempts < ingest.MAX_ATTEMPTS else 0
    want = sorted(r.unique_play for r in ingest.live_plays(spark, silver).collect())
    assert len(want) == len(set(want)) == 60 + added
    assert ingest.quarantined(spark, files).first().recovered == bool(added)
    # compaction changes no row and leaves fewer folders
    folders = len(list((tmp_path / "silver").glob("batch=*/*")))
    ingest.compact(spark, silver)
    assert sorted(r.unique_play for r in ingest.live_plays(spark, silver).collect()) == want
    ingest.vacuum(spark, silver)
    assert sorted(r.unique_play for r in ingest.live_plays(spark, silver).collect()) == want
    assert len(list((tmp_path / "silver").glob("batch=*/*"))) < folders
    step(spark.read.text(str(raw / "part-last.json")).withColumn("file_name", F.lit("again")), 9)
    assert ingest.live_plays(spark, silver).count() == len(want)


def test_processed_artists_are_skipped(spark, tmp_path):
    seen = []
    step = ingest.process_new_artists(
        str(tmp_path / "p"), lambda b, n: seen.append(sorted(r.artist_id for r in b.collect()))
    )

    def batch(ids):
        return spark.createDataFrame([(i,) for i in ids], "artist_id string")

    step(batch(["a", "b", "a"]), 0)
    step(batch(["b", "c"]), 1)
    step(batch(["b", "c"]), 1)
    assert seen == [["a", "b"], ["c"], ["c"]]


def test_partition_replacement_keeps_other_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "d string, v int")
    stored.materialise(rows, path, ["d"])
    stored.replace_partitions(spark.createDataFrame([("b", 3)], "d string, v int"), path, ["d"])
    assert sorted((r.d, r.v) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 3)]
    stored.backup(spark, path, str(tmp_path / "copy"))
    assert spark.read.parquet(str(tmp_path / "copy")).count() == 2


def test_refresh_writes_all_layers_and_views(spark, tables, tmp_path):
    from spinledger.plans.refresh import refresh_layers, register_views

    marks = dict.fromkeys(("plays", "artists", "catalog"), "1")
    layers = refresh_layers(
        tables.landed_star, tables.artists, tables.catalog, str(tmp_path), marks=marks
    )
    assert layers["silver_plays"].count() == tables.plays_star.count()
    register_views(layers, local_prefix="home", prefix="v_")
    total = spark.sql("SELECT sum(total_plays) FROM v_daily_summary").head()[0]
    dates = spark.sql("SELECT count(DISTINCT home_date) FROM v_silver_plays").head()[0]
    assert (total, dates) == (layers["silver_plays"].count(), layers["daily_summary"].count())
    scan = spark.sql("SELECT track_id FROM v_silver_plays WHERE home_date = DATE'1997-01-05'")
    assert "PartitionFilters: [isnotnull(local_date" in scan._jdf.queryExecution().executedPlan().toString()


def test_refresh_rewrites_what_changed(spark, tmp_path):
    from spinledger.plans.refresh import Layer, content_mark, refresh, remove_versions

    graph = {
        "doubled": Layer(("plays",), lambda df: df.selectExpr("id * 2 AS id")),
        "small": Layer(("catalog",), lambda df: df.filter("id < 3")),
        "both": Layer(("doubled", "small"), lambda a, b: a.join(b, "id")),
    }
    few, many = spark.range(5), spark.range(9)
    assert content_mark(many) == content_mark(many.orderBy(-many.id)) != content_mark(few)
    path = str(tmp_path)
    first = refresh({"plays": many, "catalog": few}, path, graph=graph)
    assert first.rewritten == ["doubled", "small", "both"]
    assert refresh({"plays": many, "catalog": few}, path, graph=graph).rewritten == []
    other = refresh({"plays": many, "catalog": many}, path, graph=graph)
    assert other.rewritten == ["small", "both"]
    remove_versions(other, path)
    assert sorted(r.id for r in other.tables["both"].collect()) == [0, 2]
    assert [len(list((tmp_path / n).iterdir())) for n in graph] == [1, 1, 1]
