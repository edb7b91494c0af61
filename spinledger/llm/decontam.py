"""Benchmark decontamination by winnowing, in DataFrame operations only.

A document is contaminated where it holds ten consecutive words of a benchmark item (all words of
a shorter item). Fingerprints are the least 5-gram hash of every six consecutive 5-grams, which is
what ten words hold: two texts that share ten words share one of them. Documents are joined with
the benchmark on fingerprints, which leaves few candidates; only these are read again, and their
ten-word windows are joined with the items' windows by a 128-bit hash, which extends every hit to
all words it covers. For items of fewer words, whole runs of their length are the fingerprints.

The benchmark side is broadcast only below the library's size limit; beyond it both joins are
shuffled, and a passage that many documents share is split by the adaptive skew join.

Defined cases: null or empty texts have no words and are never hit; equal rows (id and text) are
worked on once and returned as often as they occur; null ids are ids of their own; an item
without words has no window; windows of an item without id mark words but list no item; an
empty benchmark leaves every document clean; other columns are not read by ``contamination`` and
pass through ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinledger.functions.joins import join_dimension
from spinledger.llm.common import SEPARATORS, ascii_lower, text_of, written

WINDOW = 10
GRAM = 5


def with_words(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds word hashes: two independent 64-bit hashes per word, and their number."""
    words = F.array_remove(F.split(ascii_lower(text_of(text)), SEPARATORS), "")
    hashed = df.withColumn("_hashes", F.transform(words, lambda w: F.xxhash64(w)))
    return hashed.withColumn("n_words", F.size("_hashes").cast("long"))


def grams(hashes: str, length: int, *salt: str) -> Column:
    """Hash of every run of ``length`` words; empty for a shorter text."""
    words = F.col(hashes)

    def run(i: Column) -> Column:
        return F.xxhash64(*map(F.lit, salt), *[F.get(words, i + k) for k in range(length)])

    starts = F.sequence(F.lit(0), F.size(words) - length)
    return F.when(F.size(words) >= length, F.transform(starts, run)).otherwise(
        F.array().cast("array<bigint>")
    )


def winnowed(gram_hashes: str) -> Column:
    """The least hash of every window of consecutive grams."""
    held, width = F.col(gram_hashes), WINDOW - GRAM + 1
    least = F.transform(
        F.sequence(F.lit(0), F.size(held) - width),
        lambda i: F.least(*[F.get(held, i + k) for k in range(width)]),
    )
    return F.when(F.size(held) >= width, least).otherwise(F.array().cast("array<bigint>"))


def fingerprints(df: DataFrame, short: list[int]) -> DataFrame:
    """Adds _prints: winnowed fingerprints, and runs of every shorter item length in use."""
    runs = [grams("_hashes", n, f"run of {n}") for n in short]
    return df.withColumn("_grams", grams("_hashes", GRAM)).withColumn(
        "_prints", F.array_distinct(F.concat(winnowed("_grams"), *runs))
    )


def windows(lengths: list[int]) -> Column:
    """(length, start, two hashes) of every window of each length."""

    def of(n: int) -> Column:
        pairs = F.arrays_zip(
            grams("_hashes", n, "first").alias("g1"), grams("_hashes", n, "second").alias("g2")
        )

        def placed(pair: Column, i: Column) -> Column:
            return F.struct(
                F.lit(n).alias("length"), i.alias("start"), pair["g1"].alias("g1"), pair["g2"].alias("g2")
            )

        return F.transform(pairs, placed)

    return F.concat(*map(of, lengths))


def item_windows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame, list[int]]:
    """Items' windows, their fingerprints, and the lengths of items below the window."""
    items = written(
        with_words(benchmark.select(F.col("item_id"), "text")).filter("n_words > 0").drop("text"),
        "items",
    )
    short = sorted(
        row[0] for row in items.filter(F.col("n_words") < WINDOW).select("n_words").distinct().collect()
    )
    own = F.least("n_words", F.lit(WINDOW))
    held = written(
        items.select("item_id", own.alias("own"), F.explode(windows([*short, WINDOW])).alias("w"))
        .filter("w.length = own")
        .select("item_id", "w.length", "w.g1", "w.g2")
        .distinct(),
        "windows",
    )
    long_items = fingerprints(items.filter(F.col("n_words") >= WINDOW), [])
    prints = long_items.select(F.explode("_prints").alias("print"))
    for n in short:
        runs = items.filter(F.col("n_words") == n).select(grams("_hashes", n, f"run of {n}").alias("p"))
        prints = prints.union(runs.select(F.explode("p")))
    return held, written(prints.distinct(), "prints"), short


def counted(docs: DataFrame, prints: DataFrame, short: list[int]) -> DataFrame:
    """Rows (doc_id, text_hash, n_words, copies, candidate), one per distinct id and text."""
    rows = with_words(
        docs.select("doc_id", F.xxhash64(text_of()).alias("text_hash"), F.col("text"))
    ).drop("text")
    spread = fingerprints(rows, short).select(
        "doc_id", "text_hash", "n_words", F.posexplode_outer("_prints").alias("at", "print")
    )
    known = prints.withColumn("known", F.lit(True))
    return join_dimension(spread, known, "print").groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"),
        F.count_if(F.coalesce("at", F.lit(0)) == 0).alias("copies"),
        F.coalesce(F.bool_or("known"), F.lit(False)).alias("candidate"),
    )


def same_document() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))


def covered(spans: Column) -> Column:
    """Words under (start, length) spans, each counted once."""
    empty = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("words"))

    def add(done: Column, span: Column) -> Column:
        end = span["start"] + span["length"]
        fresh = F.greatest(F.lit(0), end - F.greatest(span["start"], done["upto"]))
        return F.struct(
            F.greatest(end, done["upto"]).alias("upto"), (done["words"] + fresh).alias("words")
        )

    return F.aggregate(F.array_sort(spans), empty, add, lambda done: done["words"])


def hits(docs: DataFrame, candidates: DataFrame, held: DataFrame, short: list[int]) -> DataFrame:
    """Hit words and items of the candidates: (_id, _hash, n_hit, items)."""
    keys = written(
        candidates.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")), "candidates"
    )
    hashed = docs.select("doc_id", F.xxhash64(text_of()).alias("text_hash"), "text")
    found = with_words(join_dimension(hashed, keys, same_document(), "left_semi")).drop("text")
    runs = found.select("doc_id", "text_hash", F.explode(windows([*short, WINDOW])).alias("w")).select(
        "doc_id", "text_hash", "w.*"
    )
    met = join_dimension(runs, held, ["length", "g1", "g2"], "inner")
    return met.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        covered(F.collect_set(F.struct("start", "length"))).alias("n_hit"),
        F.collect_set(F.col("item_id").cast("string")).alias("items"),
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated."""
    held, prints, short = item_windows(benchmark)
    rows = written(counted(docs, prints, short), "counted")
    found = hits(docs, rows.filter("candidate"), held, short)
    items = F.coalesce("items", F.array().cast("array<string>"))
    return (
        rows.join(found, same_document(), "left")
        .select(
            "doc_id",
            "text_hash",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size(items).cast("long").alias("n_items"),
            F.sha2(F.array_join(F.array_sort(items), ",").cast("binary"), 256).alias("items_sha256"),
            F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
        )
        .withColumn("contaminated", F.col("n_hit") > 0)
        .drop("copy")
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no window of the benchmark."""
    held, prints, short = item_windows(benchmark)
    rows = written(counted(docs, prints, short), "counted")
    found = written(
        hits(docs, rows.filter("candidate"), held, short).select("_id", "_hash"), "contaminated"
    )
    hashed = docs.withColumn("_text_hash", F.xxhash64(text_of()))
    match = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash"))
    return join_dimension(hashed, found, match, "left_anti").select(*docs.columns)


ORACLE = r"""
WITH letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper, lower('ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS lower),
docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(
    translate(text, upper, lower), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
  FROM documents, letters),
items AS (
  SELECT item_id, regexp_extract_all(
    translate(text, upper, lower), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words,
    least(10, len(words)) AS width
  FROM benchmark, letters),
item_windows AS (
  SELECT DISTINCT item_id, width, array_to_string(list_slice(words, pos, pos + width - 1), ' ') AS w
  FROM items, LATERAL (SELECT unnest(range(1, len(words) - width + 2)) AS pos) WHERE width > 0),
doc_windows AS (
  SELECT rid, width, pos, array_to_string(list_slice(words, pos, pos + width - 1), ' ') AS w
  FROM docs, (SELECT DISTINCT width FROM item_windows),
    LATERAL (SELECT unnest(range(1, len(words) - width + 2)) AS pos)),
met AS (SELECT rid, pos, width, item_id FROM doc_windows JOIN item_windows USING (width, w)),
hit_words AS (
  SELECT rid, count(DISTINCT n) AS n_hit
  FROM met, LATERAL (SELECT unnest(range(pos, pos + width)) AS n) GROUP BY rid),
hit_items AS (
  SELECT rid, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM met GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)
"""
