"""Queries of the genre inference rules and of the page matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from spinledger.operators import genres, pages, quality, silver
from spinledger.plans.catalogue import joined_text, query
from spinledger.plans.oracle import define, sql


def case_of(patterns: dict[str, list[str]]) -> str:
    arms = " ".join(
        "WHEN " + " OR ".join(f"contains(ln, '{w}')" for w in words) + f" THEN '{genre}'"
        for genre, words in patterns.items()
    )
    return f"CASE {arms} END"


BY_NAME = case_of(genres.NAME_PATTERNS)
BY_POPULARITY = """CASE WHEN popularity >= 80 THEN 'mainstream pop' WHEN popularity >= 60 THEN 'pop'
  WHEN popularity >= 40 THEN 'alternative' WHEN popularity >= 20 THEN 'indie'
  WHEN popularity IS NOT NULL THEN 'underground' END"""
define(
    "named",
    "SELECT *, lower(artist_name) AS ln FROM name_corpus",
    "name_corpus",
)


@query(
    "g1_genre_from_name",
    sql(f"SELECT artist_id, artist_name, {BY_NAME} AS genre FROM named", "named"),
)
def genre_from_name(t):
    genre = genres.genre_from_name(F.col("artist_name"))
    return t.name_corpus.select("artist_id", "artist_name", genre.alias("genre"))


@query(
    "g2_genre_from_popularity",
    sql(f"SELECT artist_id, popularity, {BY_POPULARITY} AS genre FROM named", "named"),
)
def genre_from_popularity(t):
    genre = genres.genre_from_popularity(F.col("popularity"))
    return t.name_corpus.select("artist_id", "popularity", genre.alias("genre"))


@query(
    "g3_enhance_empty_genres",
    sql(
        f"""WITH x AS (SELECT *, {BY_NAME} AS gn, {BY_POPULARITY} AS gp FROM named),
y AS (SELECT *, CASE WHEN len(genres_list) > 0 THEN array_to_string(genres_list, '|')
    WHEN gn IS NULL AND gp IS NULL THEN 'unclassified'
    WHEN gn = gp THEN gn ELSE concat_ws('|', gn, gp) END AS g,
  CASE WHEN len(genres_list) > 0 THEN NULL WHEN gn IS NULL AND gp IS NULL THEN 'fallback'
    ELSE concat_ws('+', CASE WHEN gn IS NOT NULL THEN 'name_pattern' END,
      CASE WHEN gp IS NOT NULL AND gp IS DISTINCT FROM gn THEN 'popularity_analysis' END) END AS m
  FROM x)
SELECT artist_id, g AS genres_list, split_part(g, '|', 1) AS primary_genre,
  CAST(len(string_split(g, '|')) AS INTEGER) AS genre_count,
  coalesce('artist_api_enhanced_' || m, 'artist_api') AS data_source,
  m IS NOT NULL AS original_genres_empty, m AS genre_inference_methods FROM y""",
        "named",
    ),
)
def enhance_empty_genres(t):
    rows = genres.enhance_empty_genres(t.name_corpus)
    return joined_text(rows, "genres_list").drop(
        "artist_name", "genres", "popularity", "followers_total"
    )


def known_sql() -> str:
    rows = [f"('{name}', '{genre}')" for name, genre in genres.KNOWN_ARTISTS.items()]
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") AS k(kn, kg)"


define("known", known_sql())


@query(
    "g4_known_artists",
    sql(
        """SELECT artist_id, artist_name, kg AS known_genre FROM named
LEFT JOIN known ON trim(ln) = kn""",
        "named",
        "known",
    ),
)
def known_artists(t):
    rows = genres.lookup_known_artists(t.name_corpus)
    return rows.select("artist_id", "artist_name", "known_genre")


def score_of(words: list[str]) -> str:
    return " + ".join(
        f"CASE WHEN contains(ln, '{w}') THEN {len(w)} ELSE 0 END" for w in words
    )


# one row per artist and genre, the best score first, earlier genres winning ties
BEST_SCORED = " UNION ALL ".join(
    f"SELECT artist_id, {i} AS o, '{genre}' AS g, {score_of(words)} AS s FROM named"
    for i, (genre, words) in enumerate(genres.SCORED_PATTERNS.items())
)
define(
    "by_score",
    f"""SELECT artist_id, g FROM ({BEST_SCORED}) WHERE s > 0
QUALIFY row_number() OVER (PARTITION BY artist_id ORDER BY s DESC, o) = 1""",
    "named",
)


@query(
    "g5_scored_name_genre",
    sql(
        """SELECT artist_id, artist_name, g AS genre FROM named LEFT JOIN by_score
USING (artist_id)""",
        "named",
        "by_score",
    ),
)
def scored_name_genre(t):
    genre = genres.scored_name_genre(F.col("artist_name"))
    return t.name_corpus.select("artist_id", "artist_name", genre.alias("genre"))


BY_REACH = """CASE WHEN popularity >= 85 THEN 'mainstream pop'
  WHEN popularity >= 70 THEN CASE WHEN followers_total > 5000000 THEN 'pop' ELSE 'alternative' END
  WHEN popularity >= 50 THEN CASE WHEN followers_total > 1000000 THEN 'alternative'
    ELSE 'indie' END
  WHEN popularity >= 30 THEN 'indie' WHEN popularity IS NOT NULL THEN 'underground' END"""
BY_CONTEXT = """CASE WHEN followers_total > 10000000 AND coalesce(popularity, 0) > 80 THEN 'pop'
  WHEN followers_total > 1000000 AND coalesce(popularity, 0) > 60 THEN CASE
    WHEN contains(ln, 'the ') OR contains(ln, 'band') OR contains(ln, 'group') THEN 'rock'
    ELSE 'pop' END
  WHEN followers_total < 100000 AND coalesce(popularity, 0) < 40 THEN 'indie' END"""
BY_TIER = """CASE WHEN popularity >= 60 THEN 'pop' WHEN popularity >= 40 THEN 'alternative'
  WHEN popularity >= 20 THEN 'indie' ELSE 'unclassified' END"""


@query(
    "g6_reach_context_fallback",
    sql(
        f"""SELECT artist_id, {BY_REACH} AS by_reach, {BY_CONTEXT} AS by_context,
  {BY_TIER} AS by_tier FROM named""",
        "named",
    ),
)
def reach_context_fallback(t):
    name, popularity = F.col("artist_name"), F.col("popularity")
    followers = F.col("followers_total")
    return t.name_corpus.select(
        "artist_id",
        genres.genre_from_reach(popularity, followers).alias("by_reach"),
        genres.genre_from_context(name, popularity, followers).alias("by_context"),
        genres.genre_fallback(popularity).alias("by_tier"),
    )


@query(
    "g7_classify_artists",
    sql(
        f"""SELECT artist_id, coalesce(primary_genre, kg, g, {BY_REACH}, {BY_CONTEXT}, {BY_TIER})
    AS classified_genre,
  CASE WHEN primary_genre IS NOT NULL THEN 'original' WHEN kg IS NOT NULL THEN 'direct_mapping'
    WHEN g IS NOT NULL THEN 'enhanced_name_pattern'
    WHEN popularity IS NOT NULL THEN 'popularity_analysis'
    WHEN {BY_CONTEXT} IS NOT NULL THEN 'contextual_inference'
    ELSE 'fallback_classification' END AS classification_method
FROM named LEFT JOIN known ON trim(ln) = kn LEFT JOIN by_score USING (artist_id)""",
        "named",
        "known",
        "by_score",
    ),
)
def classify_artists(t):
    rows = genres.classify_artists(t.name_corpus)
    return rows.select("artist_id", "classified_genre", "classification_method")


# Genre spellings derived from the artist words of the corpus.
define(
    "spellings",
    """SELECT artist_id, CASE CAST(artist_id AS BIGINT) % 4 WHEN 0 THEN 'Indie%20Rock'
  WHEN 1 THEN 'hip+hop' WHEN 2 THEN 'Rhythm and  Blues!' ELSE artist_name END AS genre
FROM name_corpus""",
    "name_corpus",
)


def spellings(t):
    return t.name_corpus.selectExpr(
        "artist_id",
        """CASE bigint(artist_id) % 4 WHEN 0 THEN 'Indie%20Rock' WHEN 1 THEN 'hip+hop'
        WHEN 2 THEN 'Rhythm and  Blues!' ELSE artist_name END AS genre""",
    )


@query(
    "g8_clean_genre_name",
    sql(
        """WITH x AS (SELECT *, lower(trim(regexp_replace(regexp_replace(replace(replace(genre,
  '%20', ' '), '+', ' '), '[^\\w\\s-]', '', 'g'), '\\s+', ' ', 'g'))) AS c FROM spellings)
SELECT artist_id, CASE c WHEN 'indie rock' THEN 'indie' WHEN 'hip hop' THEN 'hip-hop'
  WHEN 'rhythm and blues' THEN 'r-b' ELSE c END AS genre FROM x""",
        "spellings",
    ),
)
def clean_genre_name(t):
    return spellings(t).select("artist_id", genres.clean_genre_name(F.col("genre")).alias("genre"))


@query(
    "g9_genre_seeds",
    sql(
        """SELECT artist_id, CASE artist_id::BIGINT % 4 WHEN 0 THEN 'rock' WHEN 1 THEN 'r-n-b'
  ELSE 'world-music' END AS seed_name FROM name_corpus WHERE artist_id::BIGINT % 4 <> 3""",
        "name_corpus",
    ),
)
def genre_seeds(t):
    tagged = t.name_corpus.selectExpr(
        "artist_id",
        "element_at(array('Rock', 'R&B', 'Native American Music', 'polka'), "
        "int(bigint(artist_id) % 4 + 1)) AS primary_genre",
    )
    return genres.with_genre_seeds(tagged).select("artist_id", "seed_name")


@query(
    "g10_candidate_genres",
    sql(
        """SELECT artist_id, CASE
  WHEN contains(ln, 'dj ') OR contains(ln, 'dj_') OR contains(ln, 'electronic')
    THEN 'electronic|house|techno|edm|dance'
  WHEN contains(ln, 'lil ') OR contains(ln, 'young ') OR contains(ln, 'big ') OR contains(ln, 'mc ')
    THEN 'hip hop|rap|trap|hip-hop'
  WHEN contains(ln, 'band') OR contains(ln, 'rock')
    THEN 'rock|indie rock|alternative rock|pop rock'
  WHEN contains(ln, 'pop') THEN 'pop|indie pop|electropop'
  ELSE 'pop|indie|alternative|rock|electronic' END AS candidates FROM named""",
        "named",
    ),
)
def candidate_genres(t):
    found = genres.candidate_genres(F.col("artist_name"))
    return joined_text(t.name_corpus.select("artist_id", found.alias("candidates")), "candidates")


@query(
    "g11_suggest_genres",
    sql(
        f"""SELECT artist_id, {case_of(genres.SUGGESTION_PATTERNS)} AS suggested_by_name,
  {BY_POPULARITY} AS suggested_by_popularity,
  (SELECT count(*) FROM silver s WHERE s.primary_artist_id = named.artist_id) AS total_plays
FROM named WHERE len(genres_list) = 0""",
        "named",
        "silver",
    ),
)
def suggest_genres(t):
    empty = quality.empty_genre_artists(t.name_corpus, t.silver)
    return genres.suggest_genres(empty).select(
        "artist_id", "suggested_by_name", "suggested_by_popularity", "total_plays"
    )


@query(
    "g12_manual_genres",
    sql(
        """SELECT artist_id, CASE WHEN genre_count = 0 AND popularity >= 50 THEN 'manual pop|pop'
    ELSE array_to_string(genres_list, '|') END AS genres_list,
  CASE WHEN genre_count = 0 AND popularity >= 50 THEN 'manual pop' ELSE primary_genre END
    AS primary_genre,
  CAST(CASE WHEN genre_count = 0 AND popularity >= 50 THEN 2 ELSE genre_count END AS INTEGER)
    AS genre_count,
  CASE WHEN genre_count = 0 AND popularity >= 50 THEN 'manual_assignment_popular_artist'
    ELSE data_source END AS data_source FROM artists""",
        "artists",
    ),
)
def manual_genres(t):
    assignments = t.artists.filter("popularity >= 50").select(
        "artist_id",
        F.array(F.lit("manual pop"), F.lit("pop")).alias("assigned_genres"),
        F.lit("manual pop").alias("primary_genre"),
        F.lit("popular_artist").alias("assignment_reason"),
    )
    rows = genres.apply_manual_genres(t.artists, assignments)
    return joined_text(
        rows.select("artist_id", "genres_list", "primary_genre", "genre_count", "data_source"),
        "genres_list",
    )


@query(
    "g14_popularity_and_followers",
    sql(
        f"""WITH x AS (SELECT *, {BY_POPULARITY} AS tier FROM named)
SELECT artist_id, CASE WHEN followers_total > 1000000 AND tier = 'alternative' THEN 'pop'
  WHEN followers_total > 1000000 AND tier = 'indie' THEN 'alternative' ELSE tier END AS genre
FROM x""",
        "named",
    ),
)
def popularity_and_followers(t):
    genre = genres.genre_from_popularity_and_followers(F.col("popularity"), F.col("followers_total"))
    return t.name_corpus.select("artist_id", genre.alias("genre"))


@query(
    "g13_unique_artists",
    sql(
        """SELECT DISTINCT primary_artist_id AS artist_id, primary_artist_name AS artist_name
FROM plays""",
        "plays",
    ),
)
def unique_artists(t):
    from spinledger.operators.flatten import unique_artists as distinct_artists

    nested = t.plays_events.selectExpr(
        "date_format(played_at, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\") AS played_at",
        """struct(array(struct(primary_artist_id AS id, primary_artist_name AS name,
        CAST(NULL AS string) AS uri, CAST(NULL AS map<string, string>) AS external_urls))
        AS artists) AS track""",
    )
    return distinct_artists(nested).selectExpr("id AS artist_id", "name AS artist_name")


# -- pages ------------------------------------------------------------------------------

define(
    "page_texts",
    """SELECT page_id, lower(trim(regexp_replace(regexp_replace(regexp_replace(html,
  '(?s)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')))
  AS body FROM pages""",
)
define(
    "page_names",
    """SELECT DISTINCT name FROM (SELECT lower(trim(regexp_replace(unnest(list_concat(
  regexp_extract_all(html, '<a href="/([^"]+)"', 1),
  regexp_extract_all(html, '<title>([^<]+)', 1))), '\\s+', ' ', 'g'))) AS name FROM pages)
WHERE name <> ''""",
)


def texts_and_names(t):
    """Texts and names of the pages, written once as several steps read them."""
    texts = t.written("page_texts", lambda: pages.page_texts(t.read("pages")))
    return texts, t.written("page_names", lambda: pages.link_names(t.read("pages")))


@query(
    "j20_page_membership",
    sql(
        """SELECT page_id, name FROM page_texts JOIN page_names ON contains(body, name)""",
        "page_texts",
        "page_names",
    ),
)
def page_membership(t):
    return pages.contained_names(*texts_and_names(t)).select("page_id", "name")


# SQL has no ratio of matching blocks; checked against brute force in the tests.
@query("j20_page_fuzzy_names")
def page_fuzzy_names(t):
    return pages.fuzzy_names(*texts_and_names(t))


@query(
    "f9_artists_after_cleanup",
    sql(
        """SELECT data_source, count(*) AS artists FROM artists WHERE genre_count > 0
GROUP BY data_source""",
        "artists",
    ),
)
def artists_after_cleanup(t):
    kept = silver.remove_empty_genres(t.artists)
    return kept.groupBy("data_source").agg(F.count("*").alias("artists"))
