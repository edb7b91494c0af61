"""Play, artist, catalog and feed tables derived from the TPC-H-like test tables.

``Tables(spark, folder)`` offers each as a lazy DataFrame in the shape of ``schema``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spinledger.functions.joins import join_dimension, salted_dimension_join
from spinledger.functions.timeparts import to_local
from spinledger.operators.silver import dedupe_plays, enrich_plays
from spinledger.params import LOCAL_TZ
from spinledger.sources.tables import materialise, scratch_folder

# Explicit schemas, so that opening a table starts no job.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "pages": "page_id bigint, url string, html string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}

NAME_WORDS = [
    "DJ Nova", "Lil Drum", "The Rock Band", "Popsters", "Indie Folk Country", "Blue Jazz",
    "City Orchestra", "Latin Soul", "Trap House Mix", "Quiet Person", "Daft Punk", "SZA",
]

# Track and album attributes from the columns of ``part``.
TRACK = [
    "p_name AS track_name",
    "60000L + p_size * 9000 AS track_duration_ms",
    "p_size * 2 AS track_popularity",
    "p_brand AS album_id",
    "'Album ' || p_brand AS album_name",
    "CASE WHEN p_size < 10 THEN 'single' WHEN p_size > 45 THEN 'compilation' ELSE 'album' END "
    "AS album_type",
    "string(1980 + p_size % 46) || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE '-06-15' END "
    "AS album_release_date",
    "p_size AS album_total_tracks",
]

# The remaining columns of a play, from its time, track and context.
PLAY = [
    "unique_play",
    "user_id",
    "played_at",
    "timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', played_at) AS played_at_timestamp",
    "to_date(played_at) AS played_at_date",
    "hour(played_at) AS played_at_hour",
    "track_id",
    "track_explicit",
    "CAST(NULL AS string) AS track_preview_url",
    "CAST(NULL AS string) AS track_external_urls",
    "'track:' || track_id AS track_uri",
    "primary_artist_id",
    "s_name AS primary_artist_name",
    "context_type",
    "context_type || ':' || track_id AS context_uri",
    "CAST(NULL AS string) AS context_external_urls",
    "played_at + INTERVAL 1 HOUR AS ingested_at",
    "'recently_played' AS data_source",
]


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.opened: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self.opened:
            reader = self.spark.read.schema(SCHEMAS[name])
            self.opened[name] = reader.parquet(f"{self.folder}/{name}.parquet")
        return self.opened[name]

    # -- tables written for one run -------------------------------------------

    @cached_property
    def scratch(self) -> str:
        """A new folder for this run's tables, inside the cluster's checkpoint folder."""
        return scratch_folder(self.spark)

    def written(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A layer table that several later steps read, written once per run."""
        if name not in self.opened:
            self.opened[name] = materialise(build(), f"{self.scratch}/{name}")
        return self.opened[name]

    # -- artists ----------------------------------------------------------

    @cached_property
    def homes(self) -> Column:
        """Nation key to nation and region name, a map over the fixed 25 nations."""
        named = self.read("nation").join(
            F.broadcast(self.read("region")), F.expr("n_regionkey = r_regionkey")
        )
        pairs = "map_from_entries(collect_list(struct(n_nationkey, struct(n_name, r_name))))"
        return named.agg(F.expr(pairs)).scalar()

    @cached_property
    def suppliers(self) -> Column:
        return self.read("supplier").agg(F.count("*")).scalar()

    @cached_property
    def artists(self) -> DataFrame:
        home = F.element_at(self.homes, F.col("s_nationkey"))
        genres = """CASE WHEN s_suppkey % 10 = 9 THEN CAST(array() AS array<string>)
          WHEN s_suppkey % 4 = 0 THEN array(_home.n_name, _home.r_name)
          ELSE array(_home.n_name) END AS genres_list"""
        return (
            self.read("supplier")
            .withColumn("_home", home)
            .selectExpr("s_suppkey", "s_name", "s_acctbal", genres)
            .selectExpr(
                "string(s_suppkey) AS artist_id",
                "s_name AS artist_name",
                "'artist:' || s_suppkey AS artist_uri",
                "to_json(genres_list) AS genres",
                "genres_list",
                "get(genres_list, 0) AS primary_genre",
                "size(genres_list) AS genre_count",
                "int(s_suppkey * 37 % 101) AS popularity",
                "bigint(round(greatest(s_acctbal, 0) * 1000)) AS followers_total",
                "timestamp_ntz'2023-10-01 00:00:00' + make_dt_interval(int(s_suppkey % 120)) "
                "AS ingested_at",
                "CASE WHEN s_suppkey % 5 = 0 THEN 'artist_api_enhanced_popularity_analysis' "
                "ELSE 'artist_api' END AS data_source",
            )
        )

    @cached_property
    def name_corpus(self) -> DataFrame:
        """Artists named by customer key and a word list, a third of them with a genre."""
        words = ", ".join(f"'{w}'" for w in NAME_WORDS)
        return (
            self.read("customer")
            .selectExpr(
                "*",
                f"element_at(array({words}), int(c_custkey % {len(NAME_WORDS)} + 1)) AS word",
                "CASE WHEN c_custkey % 3 = 0 THEN array(lower(c_mktsegment)) "
                "ELSE CAST(array() AS array<string>) END AS genres_list",
            )
            .selectExpr(
                "string(c_custkey) AS artist_id",
                "word || CASE WHEN c_custkey % 12 >= 10 THEN '' ELSE ' ' || c_mktsegment END "
                "AS artist_name",
                "to_json(genres_list) AS genres",
                "genres_list",
                "get(genres_list, 0) AS primary_genre",
                "size(genres_list) AS genre_count",
                "CASE WHEN c_custkey % 17 <> 0 THEN int(c_custkey * 37 % 101) END AS popularity",
                "bigint(round(greatest(c_acctbal, 0) * 1000)) AS followers_total",
                "'artist_api' AS data_source",
            )
        )

    # -- plays ------------------------------------------------------------

    def part(self) -> DataFrame:
        return self.read("part").select("p_partkey", "p_name", "p_size", "p_brand")

    def supplier_names(self) -> DataFrame:
        return self.read("supplier").select("s_suppkey", "s_name")

    @cached_property
    def plays_events(self) -> DataFrame:
        """Deduplicated plays with spread-out times of day, from ``events``."""
        events = self.read("events").selectExpr(
            "string(event_id) AS unique_play",
            "user_id",
            "ts AS played_at",
            "bigint(get_json_object(props, '$.k')) AS _k",
            "CASE event_type WHEN 'view' THEN 'playlist' WHEN 'click' THEN 'album' "
            "WHEN 'purchase' THEN 'artist' WHEN 'signup' THEN 'collection' END AS context_type",
        )
        spread = ["unique_play"]
        joined = salted_dimension_join(events, self.part(), "_k", "p_partkey", spread, "inner")
        artist = F.col("p_partkey") % F.least(F.lit(40), self.suppliers)
        joined = salted_dimension_join(
            joined.withColumn("_artist", artist),
            self.supplier_names(),
            "_artist",
            "s_suppkey",
            spread,
            "inner",
        )
        return joined.selectExpr(
            "*",
            "string(p_partkey) AS track_id",
            "string(s_suppkey) AS primary_artist_id",
            "p_size % 5 = 0 AS track_explicit",
        ).selectExpr(*PLAY, *TRACK)

    @cached_property
    def landed_lines(self) -> DataFrame:
        """The columns of ``lineitem`` that make a play."""
        minutes = "int((l_partkey * 37 + l_linenumber * 211) % 1440)"
        return self.read("lineitem").selectExpr(
            "l_orderkey || '_' || l_linenumber AS unique_play",
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            f"l_shipdate + make_dt_interval(0, 0, {minutes}) AS played_at",
            "l_returnflag = 'R' AS track_explicit",
        )

    def star(self, lines: DataFrame) -> DataFrame:
        orders = self.read("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        joined = join_dimension(lines, self.part(), F.expr("l_partkey = p_partkey"), "inner")
        joined = join_dimension(
            joined, self.supplier_names(), F.expr("l_suppkey = s_suppkey"), "inner"
        )
        joined = join_dimension(joined, orders, F.expr("l_orderkey = o_orderkey"), "inner")
        return joined.selectExpr(
            "*",
            "o_custkey AS user_id",
            "string(l_partkey) AS track_id",
            "string(l_suppkey) AS primary_artist_id",
            "CASE left(o_orderpriority, 1) WHEN '1' THEN 'playlist' WHEN '2' THEN 'album' "
            "WHEN '3' THEN 'artist' WHEN '5' THEN 'collection' END AS context_type",
        ).selectExpr(*PLAY, *TRACK)

    @cached_property
    def landed_star(self) -> DataFrame:
        """Plays with repeated keys over 83 months, from ``lineitem``, ``part``, ``orders``."""
        return self.star(self.landed_lines)

    @cached_property
    def plays_star(self) -> DataFrame:
        """One play per key; the narrow lines are deduplicated before they are joined."""
        order = ["string(l_partkey)", "string(l_suppkey)", "track_explicit"]
        latest = [F.desc("played_at"), *[F.expr(e) for e in order]]
        return self.star(dedupe_plays(self.landed_lines, order=latest))

    @cached_property
    def silver(self) -> DataFrame:
        return enrich_plays(self.plays_events, self.artists)

    # the columns that the feature, pattern and similarity operators read
    ML_COLUMNS = [
        "unique_play", "local_timestamp", "local_date", "local_hour", "is_weekend", "track_id",
        "track_name", "track_duration_ms", "track_popularity", "primary_artist_id",
        "primary_artist_name", "primary_genre", "album_name", "album_type",
        "album_release_date", "album_release_year",
    ]

    @property
    def silver_table(self) -> DataFrame:
        """The silver plays as a written table, as the ML layer reads them."""
        return self.written("silver", lambda: self.silver.select(*self.ML_COLUMNS))

    @cached_property
    def silver_star(self) -> DataFrame:
        return enrich_plays(self.plays_star, self.artists)

    # -- catalog, feeds, dates ---------------------------------------------

    @cached_property
    def catalog(self) -> DataFrame:
        """All tracks with their artist and genre, played or not."""
        key = F.col("p_partkey")
        artist = F.when(key < 100, key % F.least(F.lit(40), self.suppliers)).otherwise(
            key % self.suppliers
        )
        tracks = (
            self.read("part")
            .withColumn("_artist", artist.cast("string"))
            .selectExpr("string(p_partkey) AS track_id", "_artist", *TRACK)
        )
        dim = self.artists.select(
            F.col("artist_id").alias("primary_artist_id"),
            F.col("artist_name").alias("primary_artist_name"),
            "primary_genre",
        )
        return salted_dimension_join(
            tracks, dim, "_artist", "primary_artist_id", ["track_id"]
        ).drop("_artist")

    @cached_property
    def feed_base(self) -> DataFrame:
        return (
            self.read("part")
            .withColumns({"_artist": F.col("p_partkey") % self.suppliers, "_homes": self.homes})
            .selectExpr(
                "p_partkey AS _key",
                "p_size",
                "string(p_partkey) AS track_id",
                "'Artist ' || _artist AS primary_artist_name",
                "string(_artist) AS primary_artist_id",
                "CAST(NULL AS string) AS preview_url",
                "element_at(_homes, int(p_partkey % 25)).n_name AS seed_genre",
                "timestamp_ntz'2024-01-20 00:00:00' + make_dt_interval(0, int(p_partkey % 240)) "
                "AS discovered_at",
                *TRACK,
            )
        )

    FEED = [
        "track_id", "track_name", "primary_artist_name", "primary_artist_id", "album_name",
        "album_release_date", "track_popularity", "track_duration_ms", "preview_url",
    ]

    @cached_property
    def feed(self) -> DataFrame:
        """Search-feed discoveries."""
        return self.feed_base.selectExpr(
            *self.FEED,
            "CASE WHEN _key % 2 = 1 THEN 'artist_based' ELSE 'genre_based' END "
            "AS discovery_strategy",
            "CASE WHEN _key % 2 = 1 THEN primary_artist_name END AS seed_artist",
            "CASE WHEN _key % 2 = 0 THEN seed_genre END AS seed_genre",
            "(p_size % 10) / 10 AS preference_score",
            "discovered_at",
            "discovered_at + INTERVAL 1 HOUR AS ingested_at",
        )

    @cached_property
    def ml_feed(self) -> DataFrame:
        """ML-feed discoveries, every track landed twice with different scores."""
        copies = self.feed_base.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1))))
        score = "(p_size + _copy * 3) % 50 / 50"
        later = "discovered_at + make_dt_interval(_copy * 5)"
        return copies.selectExpr(
            *self.FEED,
            "'ml_hybrid' AS discovery_strategy",
            f"{score} AS ml_recommendation_score",
            "'collaborative_filtering' AS ml_strategies_used",
            f"{score} * 0.5D AS ml_weighted_score",
            "'Seed ' || track_name AS seed_track",
            "seed_genre",
            "_key % 11 / 10 AS genre_novelty_score",
            "_key % 9 / 10 AS artist_novelty_score",
            f"{later} AS discovered_at",
            f"{later} + INTERVAL 1 HOUR AS ingested_at",
        )

    @cached_property
    def candidates(self) -> DataFrame:
        """Candidate tracks of the ranker, some without a popularity."""
        return self.feed.selectExpr(
            "track_id",
            "track_name",
            "primary_artist_id",
            "primary_artist_name",
            "CASE WHEN seed_genre IS NULL THEN 'artist_seed' ELSE 'genre_seed' END AS source",
            "coalesce(seed_genre, seed_artist) AS seed_value",
            "nullif(track_popularity, 50) AS track_popularity",
            "album_release_date",
            "discovered_at AS fetched_at",
        )

    @cached_property
    def as_of(self) -> Column:
        """Latest local date of ``events``; local time never runs ahead of a later instant."""
        return self.last_date(self.read("events"), "ts")

    @cached_property
    def as_of_star(self) -> Column:
        """Latest local date of the star plays; a key's latest row is never dropped."""
        return self.last_date(self.landed_lines, "played_at")

    @staticmethod
    def last_date(df: DataFrame, ts: str) -> Column:
        return df.agg(F.to_date(to_local(F.max(ts), LOCAL_TZ))).scalar()
