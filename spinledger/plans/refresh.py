"""Refresh of all layers in dependency order, up to the playlist, and named views on them.

Every layer names its inputs: sources or other layers. A layer's mark is a hash of its name, the
parameters and the marks of its inputs, and its table lies in a folder of that mark. A refresh
therefore rewrites the layers whose inputs changed and no others, a refresh that broke off goes on
where it stopped, and readers of the tables before it are not disturbed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinledger.operators import features, gold, hybrid, silver, similarity, strategies
from spinledger.params import LOCAL_TZ
from spinledger.sources.tables import exists, materialise, remove, stored

# Partitioning and in-file order of the larger tables; the others are small.
LAYOUT = {
    "silver_plays": (["local_date"], ["primary_artist_id"]),
    "artist_summary": ([], ["primary_genre"]),
}


@dataclass(frozen=True)
class Layer:
    """A table built from its inputs, in their order; ``dated`` ones also get the day.

    ``settings`` name the parameters that ``build`` holds, as they are part of the mark.
    """

    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    dated: bool = False
    settings: str = ""


@dataclass(frozen=True)
class Refreshed:
    tables: dict[str, DataFrame]
    rewritten: list[str]


def layers(tz: str = LOCAL_TZ, hour: int = 20, weekend: bool = False) -> dict[str, Layer]:
    """Bronze to playlist, each after its inputs. ``hour`` and ``weekend`` are the playlist's."""

    def silver_plays(plays, artists):
        return silver.enrich_plays(silver.dedupe_plays(plays), artists, tz)

    def temporal(patterns, tracks):
        strengths = ("strong", "moderate", "weak")
        return strategies.temporal(patterns, tracks, hour, weekend, strengths=strengths)

    def discovery(tracks, likes, plays, day):
        genres = strategies.known_genres(likes, 0.5)
        return strategies.discovery(tracks, genres, strategies.known_artists(plays, day))

    def genre_similarity(plays, day):
        return similarity.genre_similarity(similarity.genre_sessions(plays, day))

    def playlist(*four):
        names = (strategies.COLLABORATIVE, strategies.CONTENT, strategies.TEMPORAL, strategies.DISCOVERY)
        return hybrid.hybrid(dict(zip(names, four, strict=True)))

    plays = ("silver_plays",)
    return {
        "bronze_artists": Layer(("artists",), silver.latest_artists),
        "silver_plays": Layer(("plays", "bronze_artists"), silver_plays, settings=tz),
        "artist_summary": Layer(("silver_plays", "bronze_artists"), gold.artist_summary),
        "daily_summary": Layer(plays, gold.daily_summary),
        "genre_analysis": Layer(plays, gold.genre_analysis),
        "monthly_insights": Layer(plays, gold.monthly_insights),
        "genre_preferences": Layer(plays, features.genre_preferences),
        "artist_preferences": Layer(plays, features.artist_preferences),
        "genre_interactions": Layer(plays, features.genre_interactions, dated=True),
        "track_base": Layer(plays, features.track_base, dated=True),
        "track_features": Layer(("track_base", "catalog"), features.track_features, dated=True),
        "temporal_patterns": Layer(plays, features.temporal_patterns, dated=True),
        "genre_similarity": Layer(plays, genre_similarity, dated=True),
        "rec_collaborative": Layer(
            ("genre_interactions", "genre_similarity", "track_features"), strategies.collaborative
        ),
        "rec_content": Layer(("track_features",), strategies.content_based),
        "rec_temporal": Layer(
            ("temporal_patterns", "track_features"), temporal, settings=f"{hour} {weekend}"
        ),
        "rec_discovery": Layer(
            ("track_features", "genre_interactions", "silver_plays"), discovery, dated=True
        ),
        "playlist": Layer(
            ("rec_collaborative", "rec_content", "rec_temporal", "rec_discovery"), playlist
        ),
        "playlist_analytics": Layer(("playlist",), hybrid.analytics_full),
    }


def content_mark(df: DataFrame) -> str:
    """Rows and sum of row hashes, in one pass; the order of rows does not matter."""
    total = F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))
    return "|".join(map(str, df.agg(F.count("*"), total).head()))


def refresh(
    sources: Mapping[str, DataFrame],
    path: str,
    marks: Mapping[str, str] | None = None,
    as_of: Column | None = None,
    graph: Mapping[str, Layer] | None = None,
) -> Refreshed:
    """Bring every layer under ``path`` up to date with plays, artists and catalog.

    ``graph`` holds the layers, all of ``layers()`` by default.

    ``plays`` are landed plays with a ``unique_play`` key. ``marks`` tell the versions of sources
    whose writer knows them (a batch number, a file inventory); the others are read once for their
    content. Every table is computed from written tables only, so no step carries the plan of the
    steps before it.
    """
    given, spark = dict(marks or {}), sources["plays"].sparkSession
    known = {name: given.get(name) or content_mark(df) for name, df in sources.items()}
    tables, rewritten = dict(sources), []
    for name, layer in (graph or layers()).items():
        own = [name, layer.build.__qualname__, layer.settings, str(as_of if layer.dated else None)]
        read = [*layer.inputs, *(["silver_plays"] if layer.dated and as_of is None else [])]
        known[name] = sha256("\n".join([*own, *(known[i] for i in read)]).encode()).hexdigest()
        folder = f"{path}/{name}/{known[name][:16]}"
        table = stored(spark, folder) if exists(spark, f"{folder}/_SUCCESS") else None
        if table is None:
            inputs: list[DataFrame | Column] = [tables[i] for i in layer.inputs]
            if layer.dated:
                day = tables["silver_plays"].agg(F.max("local_date")).scalar()
                inputs.append(day if as_of is None else as_of)
            table = materialise(layer.build(*inputs), folder, *LAYOUT.get(name, ([], [])))
            rewritten.append(name)
        tables[name] = table
    return Refreshed({name: df for name, df in tables.items() if name not in sources}, rewritten)


def remove_versions(refreshed: Refreshed, path: str) -> None:
    """Delete the tables of earlier refreshes, once nobody reads them."""
    for name, df in refreshed.tables.items():
        spark = df.sparkSession
        parent = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        store = parent.getFileSystem(spark._jsc.hadoopConfiguration())
        held = {file.rsplit(f"/{name}/", 1)[1].split("/", 1)[0] for file in df.inputFiles()}
        for version in store.listStatus(parent):
            if held and version.getPath().getName() not in held:
                remove(spark, version.getPath().toString())


def refresh_layers(
    plays: DataFrame,
    artists: DataFrame,
    catalog: DataFrame,
    path: str,
    as_of: Column | None = None,
    tz: str = LOCAL_TZ,
    marks: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """The tables of all layers under ``path``, up to date."""
    sources = {"plays": plays, "artists": artists, "catalog": catalog}
    return refresh(sources, path, marks, as_of, layers(tz)).tables


def register_views(
    tables: dict[str, DataFrame], local_prefix: str = "local", prefix: str = ""
) -> None:
    """Temporary views on the tables for SQL users.

    ``local_prefix`` renames the ``local_*`` columns, for example after a city.
    """
    for name, df in tables.items():
        renamed = df.withColumnsRenamed(
            {c: local_prefix + c[5:] for c in df.columns if c.startswith("local_")}
        )
        renamed.createOrReplaceTempView(prefix + name)
