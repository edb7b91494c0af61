"""Queries of the landing sources, the cursor, the streaming steps and the ML operators."""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from spinledger.operators import factors, feeds, flatten, silver, vectors
from spinledger.operators.features import genre_interactions
from spinledger.plans import refresh
from spinledger.plans.catalogue import joined_text, query, rounded
from spinledger.plans.features_queries import track_features
from spinledger.plans.oracle import half_up, sql
from spinledger.plans.recommend_queries import FINAL, HOUR, WEEKEND
from spinledger.sources import landing, tables
from spinledger.streaming import ingest


NESTED_PLAY = """struct(track_id AS id, track_name AS name, track_duration_ms AS duration_ms,
  track_popularity AS popularity, track_explicit AS explicit, track_preview_url AS preview_url,
  track_uri AS uri, CAST(NULL AS map<string, string>) AS external_urls,
  array(struct(primary_artist_id AS id, primary_artist_name AS name, CAST(NULL AS string) AS uri,
    CAST(NULL AS map<string, string>) AS external_urls)) AS artists,
  struct(album_id AS id, album_name AS name, album_type, album_release_date AS release_date,
    album_total_tracks AS total_tracks,
    CAST(NULL AS array<struct<url: string, height: int, width: int>>) AS images) AS album) AS track"""


def nested_plays(t):
    """The plays in the nested shape of the history endpoint."""
    return t.plays_events.selectExpr(
        "date_format(played_at, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\") AS played_at",
        NESTED_PLAY,
        "CASE WHEN context_type IS NOT NULL THEN struct(context_type AS type, context_uri AS uri, "
        "CAST(NULL AS map<string, string>) AS external_urls) END AS context",
    )


#: Plays to a landed file, about 100 MB, so that many tasks write and read a large batch.
PLAYS_A_FILE = 1 << 18


def files_a_batch(t, batches: int = 3) -> int:
    """Files of a batch where all plays land in so many batches; one file for small tables."""
    return max(1, math.ceil(t.read("events").count() / (batches * PLAYS_A_FILE)))


FLAT_SQL = """SELECT played_at, played_at_timestamp, played_at_date, played_at_hour, track_id,
  track_name, track_duration_ms, track_popularity, track_explicit, primary_artist_id,
  primary_artist_name, album_id, album_name, album_type, album_release_date, album_total_tracks,
  context_type, context_type || ':' || track_id AS context_uri, 'track:' || track_id AS track_uri
FROM plays"""
FLAT_COLUMNS = [
    "played_at", "played_at_timestamp", "played_at_date", "played_at_hour", "track_id",
    "track_name", "track_duration_ms", "track_popularity", "track_explicit", "primary_artist_id",
    "primary_artist_name", "album_id", "album_name", "album_type", "album_release_date",
    "album_total_tracks", "context_type", "context_uri", "track_uri",
]


@query("p1_flatten_plays", sql(FLAT_SQL, "plays"))
def flatten_plays(t):
    return flatten.flatten_plays(nested_plays(t)).select(*FLAT_COLUMNS)


@query(
    "p2_flatten_artists",
    sql(
        """SELECT artist_id, artist_name, array_to_string(genres_list, '|') AS genres_list,
  primary_genre, genre_count, popularity, followers_total FROM artists""",
        "artists",
    ),
)
def flatten_artists(t):
    nested = t.artists.selectExpr(
        "artist_id AS id",
        "artist_name AS name",
        "artist_uri AS uri",
        "genres_list AS genres",
        "popularity",
        "struct(followers_total AS total) AS followers",
        "CAST(NULL AS map<string, string>) AS external_urls",
        "CAST(NULL AS array<string>) AS images",
    )
    rows = flatten.flatten_artists(nested, enhance=False)
    return joined_text(rows, "genres_list").select(
        "artist_id",
        "artist_name",
        "genres_list",
        "primary_genre",
        "genre_count",
        "popularity",
        "followers_total",
    )


@query("s1_landing_round_trip", sql(FLAT_SQL, "plays"))
def landing_round_trip(t):
    """Plays written as dated gzipped JSON and read back."""
    path = t.scratch + "/plays"
    landing.write_plays(flatten.flatten_plays(nested_plays(t)), path)
    return landing.read_plays(t.spark, path).select(*FLAT_COLUMNS)


@query(
    "s4_feed_round_trip",
    sql(
        """SELECT track_id, CAST(track_popularity AS INTEGER) AS track_popularity,
  make_date(CAST(left(album_release_date, 4) AS INTEGER),
    CASE WHEN length(album_release_date) = 4 THEN 1 ELSE 6 END,
    CASE WHEN length(album_release_date) = 4 THEN 1 ELSE 15 END) AS album_release_date,
  ml_recommendation_score, discovered_at FROM ml_feed""",
        "ml_feed",
    ),
)
def feed_round_trip(t):
    path = t.scratch + "/feed"
    landing.write_feed(t.ml_feed, path, "20240131")
    rows = landing.read_ml_discoveries(t.spark, path)
    return rows.select(
        "track_id", "track_popularity", "album_release_date", "ml_recommendation_score",
        "discovered_at",
    )


@query(
    "s8_file_inventory",
    sql(
        """SELECT count(*) AS rows_read, true AS all_files_listed, true AS all_bytes_counted
FROM feed""",
        "feed",
    ),
)
def file_inventory(t):
    """The inventory against the files that the landed rows were read from."""
    path = t.scratch + "/inventory"
    landing.write_feed(t.feed, path, "20240131")
    totals = landing.file_totals(landing.recent_files(t.spark, path, F.current_date(), 1))
    read = (
        t.spark.read.option("recursiveFileLookup", "true")
        .text(path)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.count("*").alias("rows"), F.max("_metadata.file_size").alias("size"))
        .agg(
            F.sum("rows").alias("rows_read"),
            F.count("*").alias("read_files"),
            F.sum("size").alias("read_bytes"),
        )
    )
    return read.select(
        "rows_read",
        (F.col("read_files") == totals.select("files").scalar()).alias("all_files_listed"),
        (F.col("read_bytes") == totals.select("bytes").scalar()).alias("all_bytes_counted"),
    )


@query(
    "s9_after_cursor",
    sql(
        """SELECT unique_play, played_at FROM plays
WHERE played_at > (SELECT max(played_at) FROM plays WHERE played_at < TIMESTAMP '2024-01-25')""",
        "plays",
    ),
)
def after_cursor(t):
    before = F.lit("2024-01-25").cast("timestamp_ntz")
    plays = t.plays_events
    nothing = plays.filter("false").select(F.col("played_at").alias("last_played_at"))
    cursor = landing.next_cursor(plays.filter(F.col("played_at") < before), nothing)
    return landing.after_cursor(plays, cursor, before).select("unique_play", "played_at")


@query(
    "s9_backfill_window",
    sql(
        """SELECT unique_play, played_at FROM plays
WHERE played_at > TIMESTAMP '2024-03-01' - INTERVAL 90 DAY""",
        "plays",
    ),
)
def backfill_window(t):
    now = F.lit("2024-03-01").cast("timestamp_ntz")
    return landing.backfill_window(t.plays_events, now, 90).select("unique_play", "played_at")


@query(
    "st7_not_processed",
    sql(
        """SELECT artist_id FROM artists WHERE artist_id NOT IN (
  SELECT primary_artist_id FROM plays)""",
        "artists",
        "plays",
    ),
)
def not_processed(t):
    done = t.plays_events.select(F.col("primary_artist_id").alias("artist_id"))
    return landing.not_processed(t.artists, done).select("artist_id")


@query(
    "st3_stream_to_silver",
    sql(
        """SELECT strftime(played_at, '%Y%m%d_%H%M%S_') || track_id AS unique_play,
  min(local_date) AS local_date, min(primary_genre) AS primary_genre FROM silver GROUP BY 1""",
        "silver",
    ),
)
def stream_to_silver(t):
    """Nested JSON files through a stream, one file per batch (more for large tables); then read back.

    Every file mixes all dates, every play comes twice in different files, and one more file
    with a bad line is skipped whole.
    """
    folder, files = t.scratch, files_a_batch(t)
    plays = nested_plays(t)
    plays.repartition(4 * files).write.json(folder + "/raw")
    plays.repartition(2 * files).write.mode("append").json(folder + "/raw")
    good = plays.limit(1).select(F.to_json(F.struct(F.struct("track.*").alias("track"))).alias("value"))
    bad = t.spark.createDataFrame([("{\"played_at\": ",)], "value string")
    good.union(bad).coalesce(1).write.mode("append").text(folder + "/raw")
    lines = ingest.stream_lines(t.spark, folder + "/raw", files_per_batch=files)
    step = ingest.append_plays(folder + "/silver", t.artists)
    ingest.start(lines, folder + "/checkpoint", step, "silver").awaitTermination()
    rows = t.spark.read.parquet(folder + "/silver")
    return rows.select("unique_play", "local_date", "primary_genre")


@query("r23_cosine_neighbours")
def cosine_neighbours(t):
    return vectors.neighbours_of_favourites(track_features(t))


def scaled_columns() -> str:
    """The features as a list of standard scores; a constant feature counts as 0."""
    scores = [
        f"coalesce((x{i} - avg(x{i}) OVER ()) / nullif(stddev_samp(x{i}) OVER (), 0), 0)"
        for i in range(len(vectors.FEATURE_COLUMNS))
    ]
    return "[" + ", ".join(scores) + "]"


@query(
    "r23_all_neighbours",
    sql(
        f"""WITH filled AS (SELECT track_id, {", ".join(
            f"coalesce(CAST({c} AS DOUBLE), 0) AS x{i}" for i, c in enumerate(vectors.FEATURE_COLUMNS)
        )} FROM features),
scaled AS (SELECT track_id, {scaled_columns()} AS z FROM filled),
unit AS MATERIALIZED (SELECT track_id, sqrt(list_dot_product(z, z)) AS size, z FROM scaled)
SELECT a.track_id AS seed_track_id, b.track_id,
  round(CASE WHEN a.size * b.size = 0 THEN 0 ELSE list_dot_product(a.z, b.z) / (a.size * b.size) END, 9)
    AS similarity_score,
  CAST(row_number() OVER (PARTITION BY a.track_id ORDER BY similarity_score DESC, b.track_id) AS INTEGER)
    AS similarity_rank
FROM unit a JOIN unit b ON a.track_id <> b.track_id QUALIFY similarity_rank <= 10""",
        "features",
    ),
)
def all_neighbours(t):
    return vectors.nearest_tracks(vectors.track_vectors(track_features(t)))


RANK, UPDATES = 3, 4


def likings(t):
    from spinledger.functions.timeparts import add_local_time

    plays = add_local_time(silver.with_artist(t.plays_events, t.artists))
    return genre_interactions(plays, t.as_of, user="user_id", min_plays=1)


def updates_sql() -> str:
    """The multiplicative updates as relations: w and h with a number from the iteration."""
    start = "0.5 + CAST('0x' || left(md5({} || ':' || f), 4) AS INTEGER) / 65536.0"
    parts = [
        f"fs AS (SELECT unnest(range({RANK})) AS f)",
        """v AS MATERIALIZED (SELECT CAST(user_id AS VARCHAR) AS u, primary_genre AS g,
  count(*) * exp(-avg(date_diff('day', local_date, as_of)) / 30.0) AS x
  FROM silver CROSS JOIN last_day WHERE primary_genre IS NOT NULL AND user_id IS NOT NULL
    AND local_date >= as_of - 180 GROUP BY ALL)""",
        """sizes AS (SELECT count(DISTINCT g) * 0.05 AS lw, count(DISTINCT u) * 0.05 AS lh FROM v)""",
        f"w0 AS (SELECT u, f, {start.format('u')} AS x FROM (SELECT DISTINCT u FROM v), fs)",
        f"h0 AS (SELECT g, f, {start.format('g')} AS x FROM (SELECT DISTINCT g FROM v), fs)",
    ]
    for i in range(UPDATES):
        parts += [
            f"hh{i} AS (SELECT a.f AS f, b.f AS e, sum(a.x * b.x) AS x FROM h{i} a JOIN h{i} b USING (g) GROUP BY ALL)",
            f"""w{i + 1} AS MATERIALIZED (SELECT w.u, w.f, w.x * n.x / (d.x + lw + lw * w.x) AS x
  FROM w{i} w CROSS JOIN sizes
  JOIN (SELECT u, f, sum(v.x * h.x) AS x FROM v JOIN h{i} h USING (g) GROUP BY ALL) n USING (u, f)
  JOIN (SELECT u, hh.e AS f, sum(w.x * hh.x) AS x FROM w{i} w JOIN hh{i} hh USING (f) GROUP BY ALL) d
    USING (u, f))""",
            f"ww{i} AS (SELECT a.f AS f, b.f AS e, sum(a.x * b.x) AS x FROM w{i + 1} a JOIN w{i + 1} b USING (u) GROUP BY ALL)",
            f"""h{i + 1} AS MATERIALIZED (SELECT h.g, h.f, h.x * n.x / (d.x + lh + lh * h.x) AS x
  FROM h{i} h CROSS JOIN sizes
  JOIN (SELECT g, f, sum(v.x * w.x) AS x FROM v JOIN w{i + 1} w USING (u) GROUP BY ALL) n USING (g, f)
  JOIN (SELECT g, ww.e AS f, sum(h.x * ww.x) AS x FROM h{i} h JOIN ww{i} ww USING (f) GROUP BY ALL) d
    USING (g, f))""",
        ]
    return "WITH " + ",\n".join(parts) + "\n"


@query(
    "r24_factor_rows",
    sql(
        updates_sql()
        + f"""SELECT 'user' AS side, u AS name, CAST(f AS INTEGER) AS factor, {half_up("x", 6)} AS value
FROM w{UPDATES} UNION ALL SELECT 'genre', g, CAST(f AS INTEGER), {half_up("x", 6)} FROM h{UPDATES}""",
        "silver",
        "last_day",
    ),
)
def factor_rows(t):
    """Factors of all users and genres after a few updates from the fixed start."""
    found = factors.factorise(likings(t), RANK, UPDATES)
    sides = [
        rows.select(F.lit(side).alias("side"), F.col(name).alias("name"), F.posexplode("factors").alias("factor", "value"))
        for side, name, rows in (("user", "user_id", found.users), ("genre", "genre", found.genres))
    ]
    return rounded(sides[0].union(sides[1]), "value")


@query(
    "r24_genre_factors",
    sql(
        """SELECT count(DISTINCT user_id) AS users,
  count(DISTINCT user_id) * least(5, count(DISTINCT primary_genre)) AS recommended,
  CAST(0 AS BIGINT) AS lost_pairs, CAST(0 AS BIGINT) AS negative_scores, true AS objective_falls
FROM silver CROSS JOIN last_day WHERE primary_genre IS NOT NULL AND user_id IS NOT NULL
  AND local_date >= as_of - 180""",
        "silver",
        "last_day",
    ),
)
def genre_factors(t):
    """Facts of a longer factorisation.

    A lost pair is a user and a genre listened to of which one has no factors.
    """
    liked = likings(t).select("user_id", "primary_genre", "weighted_preference")
    found = factors.factorise(liked, rank=8, iterations=10)
    best = factors.best_genres(found, n=5)
    pairs = liked.dropna().select(F.col("user_id").cast("string").alias("user_id"), F.col("primary_genre").alias("genre"))
    kept = pairs.join(found.users, "user_id").join(found.genres, "genre").select("user_id", "genre")
    falls = all(b <= a for a, b in zip(found.objective, found.objective[1:]))
    lost = pairs.join(kept, ["user_id", "genre"], "left_anti").agg(F.count("*")).scalar()
    return best.agg(
        F.count_distinct("user_id").alias("users"),
        F.count("*").alias("recommended"),
        F.max(lost).alias("lost_pairs"),
        F.count_if(F.col("score") < 0).alias("negative_scores"),
        F.lit(falls).alias("objective_falls"),
    )


@query(
    "u2_known_keys",
    sql(
        """SELECT primary_genre AS known FROM silver WHERE primary_genre IS NOT NULL
UNION SELECT primary_artist_id FROM silver""",
        "silver",
    ),
)
def known_keys(t):
    genres = t.silver.select(F.col("primary_genre").alias("known")).dropna()
    artists = t.silver.select(F.col("primary_artist_id").alias("known"))
    return genres.union(artists).distinct()


@query(
    "st4_batch_upsert",
    sql(
        """SELECT track_id, count(*) + 2 * (track_id IN ('1', '2'))::INTEGER AS discovery_count,
  max(ml_recommendation_score) AS ml_recommendation_score FROM ml_feed GROUP BY 1""",
        "ml_feed",
    ),
)
def batch_upsert(t):
    """Batches through the step of the upsert stream: two halves, two tracks again, a repeat."""
    path = t.scratch + "/upsert"
    now = F.lit("2024-02-01").cast("timestamp_ntz")
    step = ingest.upsert_ml(path, now)
    split = F.col("discovered_at") < F.lit("2024-01-26").cast("timestamp_ntz")
    rows = t.ml_feed.drop("ingested_at").withColumn("batch_timestamp", F.lit("x"))
    for number, batch in enumerate((split, ~split, F.col("track_id").isin("1", "2"))):
        step(rows.filter(batch), number)
    step(rows.filter(~split), 1)
    table = t.spark.read.parquet(path)
    return table.select("track_id", "discovery_count", "ml_recommendation_score")


@query(
    "st4_partial_upsert",
    sql(
        """SELECT count(DISTINCT track_id) AS tracks, true AS few_partitions_rewritten,
  true AS others_untouched FROM ml_feed""",
        "ml_feed",
    ),
)
def partial_upsert(t):
    """A batch of two tracks rewrites the partitions of these two and no other."""
    path = t.scratch + "/partial"
    step = ingest.upsert_ml(path, F.lit("2024-02-01").cast("timestamp_ntz"))
    rows = t.ml_feed.drop("ingested_at").withColumn("batch_timestamp", F.lit("x"))
    step(rows, 0)
    few = F.col("track_id").isin("1", "2")
    step(rows.filter(few), 1)
    table = t.spark.read.parquet(path)
    return table.agg(
        F.count("*").alias("tracks"),
        (F.count_distinct(F.when(F.col("batch") == 1, F.col("part"))) <= 2).alias(
            "few_partitions_rewritten"
        ),
        (F.count_distinct(F.when(F.col("batch") == 0, F.col("part"))) > 2).alias("others_untouched"),
    )


MART_SQL = f"""
WITH plays_once AS (SELECT * FROM silver QUALIFY row_number() OVER (
    PARTITION BY strftime(played_at, '%Y%m%d_%H%M%S_') || track_id ORDER BY unique_play) = 1),
tops AS (
  SELECT * FROM (
    SELECT 'day' AS mart, CAST(local_date AS VARCHAR) AS part, primary_genre AS top, count(*) AS n
    FROM plays_once WHERE primary_genre IS NOT NULL GROUP BY ALL
    UNION ALL SELECT 'genre', primary_genre, primary_artist_name, count(*)
    FROM plays_once WHERE primary_genre IS NOT NULL GROUP BY ALL
    UNION ALL SELECT 'month', local_year || '-' || local_month, track_name, count(*)
    FROM plays_once GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY mart, part ORDER BY n DESC, top) = 1),
sums AS (
  SELECT 'day' AS mart, CAST(local_date AS VARCHAR) AS part, count(*) AS total_plays,
    count(DISTINCT primary_artist_id) AS artists, count(DISTINCT track_id) AS others,
    count(DISTINCT date_trunc('hour', local_timestamp))::DOUBLE AS span,
    {half_up("avg(track_popularity)", 1)} AS popularity
  FROM plays_once GROUP BY ALL
  UNION ALL SELECT 'genre', primary_genre, count(*), count(DISTINCT primary_artist_id),
    count(DISTINCT track_id), count(DISTINCT local_date)::DOUBLE,
    {half_up("avg(track_popularity)", 1)}
  FROM plays_once WHERE primary_genre IS NOT NULL GROUP BY ALL
  UNION ALL SELECT 'month', local_year || '-' || local_month, count(*),
    count(DISTINCT primary_artist_id), count(DISTINCT primary_genre),
    {half_up("count(*) / count(DISTINCT local_date)", 2)}, {half_up("avg(track_popularity)", 1)}
  FROM plays_once GROUP BY ALL)
SELECT sums.*, top FROM sums LEFT JOIN tops USING (mart, part)"""


def streamed_plays(t, folder: str, files: int) -> None:
    """Nested JSON files, three times ``files``, and as many in which every play comes again."""
    plays = nested_plays(t)
    plays.repartition(3 * files).write.json(folder)
    # with more files, a track is dealt over them, or it would be one task's
    spread = [F.pmod(F.xxhash64("played_at"), F.lit(files))] if files > 1 else []
    plays.repartition(3 * files, "track.id", *spread).write.mode("append").json(folder)


@query("st5_incremental_marts", sql(MART_SQL, "silver"))
def incremental_marts(t):
    """Six batches through the listening cycle; the daily, genre and monthly marts it keeps."""
    folder = t.scratch
    files = files_a_batch(t)
    streamed_plays(t, folder + "/marts_raw", files)
    lines = ingest.stream_lines(t.spark, folder + "/marts_raw", files_per_batch=files)
    step = ingest.silver_and_gold(folder + "/marts_silver", folder + "/marts", t.artists)
    ingest.start(lines, folder + "/marts_checkpoint", step, "marts").awaitTermination()
    tables = ingest.open_marts(t.spark, folder + "/marts")
    days = tables["daily_summary"].selectExpr(
        "'day' AS mart", "string(local_date) AS part", "total_plays", "unique_artists AS artists",
        "unique_tracks AS others", "double(listening_sessions) AS span",
        "average_track_popularity AS popularity", "top_genre AS top",
    )
    genres = tables["genre_analysis"].selectExpr(
        "'genre' AS mart", "primary_genre AS part", "total_plays", "unique_artists AS artists",
        "unique_tracks AS others", "double(days_active) AS span",
        "average_track_popularity AS popularity", "top_artist AS top",
    )
    months = tables["monthly_insights"].selectExpr(
        "'month' AS mart", "year || '-' || month AS part", "total_plays",
        "unique_artists AS artists", "unique_genres AS others", "daily_average_plays AS span",
        "average_track_popularity AS popularity", "top_track AS top",
    )
    return days.unionByName(genres).unionByName(months)


@query(
    "st8_listening_cycle",
    sql(
        """SELECT strftime(played_at, '%Y%m%d_%H%M%S_') || track_id AS unique_play,
  min(local_date) AS local_date, min(primary_genre) AS primary_genre,
  CAST(1 AS BIGINT) AS failed_batches, CAST(1 AS BIGINT) AS quarantined_files,
  CAST(3 AS BIGINT) AS attempts FROM silver GROUP BY 1""",
        "silver",
    ),
)
def listening_cycle(t):
    """A cycle of files with a broken one and a batch that fails once, then compacted.

    The broken file comes first and is tried with three batches.
    """
    folder = t.scratch + "/cycle"
    raw, silver_path, files = folder + "/raw", folder + "/silver", folder + "/quarantine"
    share = files_a_batch(t)
    bad = t.spark.createDataFrame([('{"played_at": ',)], "value string")
    bad.coalesce(1).write.text(raw)
    lines = ingest.stream_lines(t.spark, raw, files_per_batch=share)
    step, failed = ingest.append_plays(silver_path, t.artists, files), []

    def once_failing(batch, number):
        step(batch, number)
        if number == 2 and not failed:
            failed.append(number)
            raise RuntimeError("the batch is lost after it was written")

    ingest.run_cycle(lines, folder + "/checkpoint", once_failing, "cycle", target=silver_path)
    plays = nested_plays(t)
    plays.repartition(3 * share).write.mode("append").json(raw)
    ingest.run_cycle(lines, folder + "/checkpoint", once_failing, "cycle", target=silver_path)
    ingest.compact(t.spark, silver_path)
    ingest.vacuum(t.spark, silver_path)
    kept = ingest.quarantined(t.spark, files).agg(
        F.count("*").alias("quarantined_files"), F.max("attempts").alias("attempts")
    )
    rows = ingest.live_plays(t.spark, silver_path)
    return rows.select(
        "unique_play",
        "local_date",
        "primary_genre",
        F.lit(len(failed)).cast("long").alias("failed_batches"),
        kept.select("quarantined_files").scalar().alias("quarantined_files"),
        kept.select("attempts").scalar().alias("attempts"),
    )


def liked_above_average(plays, day):
    rows = genre_interactions(plays, day)
    return rows.filter(F.col("weighted_preference") > rows.agg(F.avg("weighted_preference")).scalar())


@query(
    "s11_refresh_changed_only",
    sql(
        f"""SELECT track_id, playlist_position, {FINAL} AS final_recommendation_score,
  recommendation_strategies, 19 AS built_first, '' AS built_again,
  'track_features,rec_collaborative,rec_content,rec_temporal,rec_discovery,playlist,playlist_analytics'
    AS built_after_catalog, 'playlist' AS built_after_loss FROM playlist""",
        "playlist",
    ),
)
def refresh_changed_only(t):
    """The playlist of a refresh, after others that changed the catalog and lost a table."""
    path = t.scratch + "/layers"
    sources = {"plays": t.plays_events, "artists": t.artists, "catalog": t.catalog}
    graph = refresh.layers(hour=HOUR, weekend=WEEKEND)
    graph["genre_interactions"] = refresh.Layer(("silver_plays",), liked_above_average, dated=True)

    def run(**changed):
        marks = {"plays": "1", "artists": "1"}  # known to their writer; the catalog is read
        return refresh.refresh({**sources, **changed}, path, marks, graph=graph)

    first, again = run(), run()
    fewer = run(catalog=t.catalog.filter("track_popularity < 50"))
    # a write that broke off leaves no mark of success
    for file in first.tables["playlist"].inputFiles()[:1]:
        tables.remove(t.spark, file.rsplit("/", 1)[0])
    last = run()
    built = {
        "built_first": F.lit(len(first.rewritten)),
        "built_again": F.lit(",".join(again.rewritten)),
        "built_after_catalog": F.lit(",".join(fewer.rewritten)),
        "built_after_loss": F.lit(",".join(last.rewritten)),
    }
    columns = ["track_id", "playlist_position", "final_recommendation_score", "recommendation_strategies"]
    return rounded(last.tables["playlist"].select(*columns).withColumns(built))


@query(
    "s12_backup",
    sql(
        """SELECT artist_id, primary_genre, false AS changed, true AS second_refused FROM artists""",
        "artists",
    ),
)
def backup_and_read_back(t):
    """A table is backed up, overwritten, and read back from its backup, which stays as it was."""
    path, copy = t.scratch + "/live", t.scratch + "/backup"
    tables.materialise(t.artists.select("artist_id", "primary_genre"), path)
    tables.backup(t.spark, path, copy)
    tables.materialise(t.artists.select("artist_id", F.lit("changed").alias("primary_genre")), path)
    try:
        tables.backup(t.spark, path, copy)
        refused = False
    except AnalysisException:
        refused = True
    rows = t.spark.read.parquet(copy)
    changed = F.coalesce(F.col("primary_genre") == "changed", F.lit(False))
    return rows.withColumns({"changed": changed, "second_refused": F.lit(refused)})


@query(
    "s2_artist_landing",
    sql(
        """SELECT artist_id, primary_genre, followers_total, ingested_at FROM artists""",
        "artists",
    ),
)
def artist_landing(t):
    path = t.scratch + "/artists"
    landing.write_artists(t.artists, path)
    rows = silver.latest_artists(landing.read_artists(t.spark, path))
    return rows.select("artist_id", "primary_genre", "followers_total", "ingested_at")


@query(
    "s3_discovery_landing",
    sql(
        "SELECT track_id, discovery_strategy, preference_score, discovered_at FROM feed", "feed"
    ),
)
def discovery_landing(t):
    path = t.scratch + "/discoveries"
    landing.write_feed(t.feed, path, "20240131")
    rows = feeds.first_arrival(landing.read_discoveries(t.spark, path), [F.col("discovered_at")])
    return rows.select("track_id", "discovery_strategy", "preference_score", "discovered_at")


@query(
    "s10_genre_dictionary",
    sql(
        """SELECT artist_name, primary_genre AS genre FROM artists
QUALIFY row_number() OVER (PARTITION BY artist_name ORDER BY artist_id DESC) = 1""",
        "artists",
    ),
)
def genre_dictionary(t):
    """Two CSV files in which every artist stands twice; the later line counts."""
    path = t.scratch + "/dictionary"
    rows = t.artists.select(
        F.concat(F.lit(" "), "artist_name").alias("artist_name"), F.col("primary_genre").alias("genre"), "artist_id"
    )
    first = rows.withColumn("genre", F.lit("outdated")).orderBy("artist_id").drop("artist_id")
    first.coalesce(1).write.csv(path + "/a", header=True)
    rows.orderBy("artist_id").drop("artist_id").coalesce(1).write.csv(path + "/b", header=True)
    return landing.read_genre_dictionary(t.spark, path + "/*")
