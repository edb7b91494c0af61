"""Phrase collocations by Toivonen's sampling method.

A phrase of two to four words is a candidate if it occurs ``MIN_COUNT`` times in its language.
A sample of the documents proposes phrases, level by level. One pass over all documents then
counts every proposed phrase and the negative border: phrases that were not proposed although
both phrases of one word less inside them were (all words are proposed or border). A border
phrase that turns out frequent is a failure; it may have longer frequent phrases that nobody
counted. Failures join the proposals, and further passes count what is new inside the wider
border, until no failure is left. Then every frequent phrase has been counted, whatever the
sample was; a bad sample costs passes (four at most, one per length), never results.

Nearly all of the border is rare, so these passes count 64-bit hashes of phrases. Phrases that
share a hash can only seem more frequent. A last pass counts the texts of all phrases whose hash
is frequent, and these counts, per language and text, are the result: exact for any hash.

The tasks must know the proposals, whose number grows with the corpus. They get a Bloom filter of
at most ``FILTER_BITS`` bits. A false positive only makes a task count a phrase more than it had
to. The border is never listed: a task counts an occurrence where the two shorter phrases pass
the filter. The filter only gains bits from pass to pass, so that a pass knows which phrases
earlier ones have counted.

Batches are counted with numpy inside the tasks, then summed by Spark per hash or (language,
phrase), which spreads a hot language; candidates meet the counts of their parts in joins that
adaptive execution may split.

Defined cases: a null language is ``und``; null and empty texts have no words; equal rows count
as often as they occur; ties in a cut's score go to the shorter first part, in rank to the
phrase; an empty table gives no rows; columns other than doc_id (which only deals the sample),
text and language are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinledger.functions.ranking import top_per_group
from spinledger.llm.common import small_batches, text_of, written
from spinledger.llm.words import Words, byte_class, byte_hashes, column, cut, gathered

MIN_COUNT = 30
LONGEST = 4
CONTAINED_PERCENT = 80
TOP = 2000
#: One document in so many is in the sample; a phrase seen twice there is proposed.
SAMPLE_OF = 8
SAMPLE_COUNT = 2
FILTER_BITS = 1 << 28
BITS_PER_PHRASE = 24
#: Bytes of text that a task counts at once.
RUN_BYTES = 8 << 20

BREAKS = byte_class(*[(ord(c), ord(c)) for c in ".,;:!?"], (0x0A, 0x0D))
BLANKS = byte_class((0x20, 0x20), (0x09, 0x09))
HASHED = "h long, n long"
COUNTED = "lang string, phrase string, words int, n long"


# ---------------------------------------------------------------------------
# filter of proposed phrases


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; a bijection."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def levelled(h: np.ndarray, level: int) -> np.ndarray:
    """Hashes that hold the number of words, less one, in their last two bits."""
    return (h & ~np.uint64(3)) | np.uint64(level - 1)


def word_hashes(words: pa.Array, lang: str) -> np.ndarray:
    return levelled(mixed(byte_hashes(words, zlib.crc32(lang.encode()))), 1)


def longer(shorter: np.ndarray, word: np.ndarray, level: int) -> np.ndarray:
    """Hashes of phrases of ``level`` words, from those of one word less and the last word."""
    return levelled(mixed(shorter * np.uint64(3) + word), level)


class Filter:
    """Bloom filter over phrase hashes with three probes."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 8 - 1)

    @staticmethod
    def places(hashes: np.ndarray, mask: np.uint64) -> Iterator[np.ndarray]:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        for i in range(3):
            yield (hashes + np.uint64(i) * step) & mask

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), dtype=bool)
        for place in self.places(hashes, self.mask):
            byte = self.bits[(place >> np.uint64(3)).astype(np.int64)]
            found &= (byte >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def filter_of(hashes: DataFrame, bits: int, before: Filter | None) -> Filter:
    """Filter of the hashes (h) and of all that an earlier filter holds.

    The tasks OR the bits of their hashes; at most ``bits / 64`` words reach the driver.
    """
    mask = np.uint64(bits - 1)

    def set_bits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("h").to_numpy().view(np.uint64)
            places = np.unique(np.concatenate([*Filter.places(h, mask)]))
            word = (places >> np.uint64(6)).astype(np.int64)
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])[: len(word)]
            held = np.bitwise_or.reduceat(np.uint64(1) << (places & np.uint64(63)), first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(word[first]), pa.array(held.view(np.int64))], ["word", "held"]
            )

    rows = hashes.select("h").mapInArrow(set_bits, "word long, held long")
    found = rows.groupBy("word").agg(F.bit_or("held").alias("held")).toArrow()
    words = np.zeros(bits // 64, np.uint64) if before is None else before.bits.view(np.uint64).copy()
    words[found.column("word").to_numpy()] |= found.column("held").to_numpy().view(np.uint64)
    return Filter(words.view(np.uint8))


# ---------------------------------------------------------------------------
# counting


def told_apart(words: list[np.ndarray], distinct: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Different rows of equally long columns of word numbers, and how often each occurs."""
    if len(words) == 4:
        pairs = np.concatenate([words[0] * distinct + words[1], words[2] * distinct + words[3]])
        known, pairs = np.unique(pairs, return_inverse=True)
        half = len(words[0])
        codes, counts = np.unique(pairs[:half] * len(known) + pairs[half:], return_counts=True)
        first, last = known[codes // len(known)], known[codes % len(known)]
        return [first // distinct, first % distinct, last // distinct, last % distinct], counts
    if len(words) == 3 and distinct >= 1 << 21:  # three numbers don't fit one
        known, pairs = np.unique(words[0] * distinct + words[1], return_inverse=True)
        codes, counts = np.unique(pairs * distinct + words[2], return_counts=True)
        pair = known[codes // distinct]
        return [pair // distinct, pair % distinct, codes % distinct], counts
    codes = words[0]
    for word in words[1:]:
        codes = codes * distinct + word
    codes, counts = np.unique(codes, return_counts=True)
    out = []
    for _ in words:
        out.append(codes % distinct)
        codes = codes // distinct
    return out[::-1], counts


def rows_of(lang: str, phrases: pa.Array, words: int, counts: np.ndarray) -> pa.RecordBatch:
    n = len(phrases)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang]).take(pa.array(np.zeros(n, np.int64))),
            phrases.cast(pa.string()),
            pa.array(np.full(n, words, np.int32)),
            pa.array(counts.astype(np.int64)),
        ],
        ["lang", "phrase", "words", "n"],
    )


def places_of(
    words: Words, hashes: np.ndarray, known: Filter, before: Filter | None, last: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words, places, hashes) of the phrases of two to ``last`` words to count.

    A phrase of k words counts where both phrases of k - 1 words inside it pass ``known`` and not
    both passed ``before``.
    """
    inside, single = known.holds(hashes)[words.ids], hashes[words.ids]
    earlier = np.zeros(len(inside), bool) if before is None else before.holds(hashes)[words.ids]
    held = single
    for k in range(2, last + 1):
        inside[:-1] &= inside[1:] & words.joined[:-1]
        earlier[:-1] &= earlier[1:] & words.joined[:-1]
        inside[-1] = earlier[-1] = False
        places = np.flatnonzero(inside)
        now = np.zeros(len(inside), np.uint64)
        now[places] = longer(held[places], single[places + k - 1], k)
        held, new = now, places[~earlier[places]]
        yield k, new, held[new]
        if k < last:
            inside[places] = known.holds(held[places])
            if before is not None:
                old = np.flatnonzero(earlier)
                earlier[old] = before.holds(held[old])


def hashed_counts(
    texts: pa.Array, lang: str, known: Filter | None, before: Filter | None, levels: tuple[int, ...]
) -> Iterator[pa.RecordBatch]:
    """Rows (h, n) of the phrases of one language in some texts."""
    words = cut(texts, BREAKS | BLANKS, BREAKS)
    if not len(words.ids):
        return
    hashes = word_hashes(words.distinct, lang)
    if 1 in levels:
        counts = np.bincount(words.ids, minlength=len(hashes))
        yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], ["h", "n"])
    if known is None:
        return
    for k, _, own in places_of(words, hashes, known, before, max(levels)):
        if k in levels and len(own):
            h, counts = np.unique(own, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(counts)], ["h", "n"])


def text_counts(texts: pa.Array, lang: str, frequent: Filter) -> Iterator[pa.RecordBatch]:
    """Rows (lang, phrase, words, n) of the phrases whose hash passes, and of all words as zero
    words."""
    words = cut(texts, BREAKS | BLANKS, BREAKS)
    yield rows_of(lang, pa.array([""]), 0, np.array([len(words.ids)]))
    if not len(words.ids):
        return
    hashes, distinct = word_hashes(words.distinct, lang), len(words.distinct)
    known, counts = np.flatnonzero(frequent.holds(hashes)), np.bincount(words.ids, minlength=distinct)
    yield rows_of(lang, words.distinct.take(pa.array(known)), 1, counts[known])
    for k, places, own in places_of(words, hashes, frequent, None, LONGEST):
        places = places[frequent.holds(own)]
        if len(places):
            found, counts = told_apart([words.ids[places + i] for i in range(k)], distinct)
            parts = [words.distinct.take(pa.array(ids)) for ids in found]
            joined = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
            yield rows_of(lang, joined, k, counts)


def by_language(table: pa.Table) -> Iterator[tuple[str, pa.Array]]:
    langs = column(table, "lang")
    for lang in langs.unique().to_pylist():
        yield lang, column(table.filter(pc.equal(langs, lang)).combine_chunks(), "text")


def count_hashes(
    docs: DataFrame,
    known: Filter | None,
    before: Filter | None,
    levels: tuple[int, ...],
    least: int,
    name: str,
) -> DataFrame:
    """Written rows (h, n) of the phrases that occur ``least`` times."""
    spark = docs.sparkSession
    filters = spark.sparkContext.broadcast((known, before))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, before = filters.value
        for table in gathered(batches, "text", RUN_BYTES):
            for lang, texts in by_language(table):
                yield from hashed_counts(texts, lang, known, before, levels)

    with small_batches(spark, 1000):
        sums = docs.mapInArrow(count, HASHED).groupBy("h").agg(F.sum("n").alias("n"))
        return written(sums.filter(F.col("n") >= least), name)


def count_texts(docs: DataFrame, frequent: Filter, least: int) -> DataFrame:
    """Written rows (lang, phrase, words, n) of phrases that occur ``least`` times, and of zero
    words."""
    spark = docs.sparkSession
    handed = spark.sparkContext.broadcast(frequent)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = handed.value
        for table in gathered(batches, "text", RUN_BYTES):
            for lang, texts in by_language(table):
                yield from text_counts(texts, lang, frequent)

    with small_batches(spark, 1000):
        rows = docs.mapInArrow(count, COUNTED)
        sums = rows.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))
        return written(sums.filter((F.col("n") >= least) | (F.col("words") == 0)), "frequent")


def frequent_phrases(
    docs: DataFrame, least: int = MIN_COUNT, sample_of: int = SAMPLE_OF, passes: list | None = None
) -> DataFrame:
    """All phrases (lang, phrase, words, n) of one to four words that occur ``least`` times, with
    a row of zero words per language for all its words.

    ``passes``, if given, receives the number of border failures after each full pass.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    rows = docs.select(lang, text_of().alias("text"))
    chosen = F.pmod(F.xxhash64("doc_id", "text"), F.lit(sample_of)) == 0
    sample = docs.filter(chosen).select(lang, text_of().alias("text"))
    lowered = max(SAMPLE_COUNT, least // (2 * sample_of))

    proposed, known, bits = None, None, 1 << 16
    for level in range(1, LONGEST):  # phrases of LONGEST words are counted, never extended
        found = count_hashes(sample, known, None, (level,), lowered, f"proposed{level}")
        proposed = found if proposed is None else proposed.union(found)
        if level == 1:
            # room for the longer phrases and for failures; the size stays for all passes
            size = min(FILTER_BITS, 8 * BITS_PER_PHRASE * found.count())
            while bits < size:
                bits *= 2
        known = filter_of(found, bits, known)

    everything = tuple(range(1, LONGEST + 1))
    counted = news = count_hashes(rows, known, None, everything, least, "pass1")
    done = proposed.select("h")
    while True:
        shorter = news.filter(F.col("h").bitwiseAND(F.lit(3)) < LONGEST - 1)
        failures = written(shorter.join(done, "h", "left_anti"), "failures")
        missed = failures.count()
        if passes is not None:
            passes.append(missed)
        if not missed:
            break
        wider = filter_of(failures, bits, known)
        news = count_hashes(rows, wider, known, everything[1:], least, "more")
        known, done, counted = wider, done.union(failures.select("h")), counted.union(news)
    return count_texts(rows, filter_of(counted, bits, None), least)


# ---------------------------------------------------------------------------
# scores


def scored(frequent: DataFrame) -> DataFrame:
    """Candidates (lang, phrase, words, a, l, r, score) with their lowest-scoring cut."""
    counts = frequent.filter("words > 0").select("lang", "phrase", "n")
    candidates = frequent.filter("words > 1").withColumnRenamed("n", "a")
    parts = F.split("phrase", " ")
    cuts = candidates.withColumn("k", F.explode(F.expr("sequence(1, words - 1)"))).withColumns(
        {
            "left": F.array_join(F.slice(parts, F.lit(1), F.col("k")), " "),
            "right": F.array_join(F.slice(parts, F.col("k") + 1, F.col("words") - F.col("k")), " "),
        }
    )
    lefts = counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    rights = counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    met = cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"])
    wide = "CAST({} AS DECIMAL(19, 0))".format
    score = F.expr(f"(CAST(2000000 AS DECIMAL(7, 0)) * {wide('a')}) div ({wide('l')} + {wide('r')})")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return met.groupBy("lang", "phrase", "words", "a").agg(best).select(
        "lang", "phrase", "words", "a", "best.l", "best.r", "best.score"
    )


def not_contained(candidates: DataFrame, percent: int = CONTAINED_PERCENT) -> DataFrame:
    """Candidates without those that mostly occur inside one longer candidate."""
    parts = F.split("phrase", " ")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.col("words") - size + 1),
                lambda start: F.array_join(F.slice(parts, start, size), " "),
            ),
        )
    )
    around = (
        candidates.filter("words > 2")
        .select("lang", F.col("a").alias("_around"), F.explode(inner).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("_around").alias("_around"))
    )
    wide = "CAST({} AS DECIMAL(19, 0))".format
    swallowed = F.expr(f"100 * {wide('_around')} >= {percent} * {wide('a')}")
    return (
        candidates.join(around, ["lang", "phrase"], "left")
        .filter(~F.coalesce(swallowed, F.lit(False)))
        .drop("_around")
    )


def collocations(docs: DataFrame, least: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """The best phrases of every language: lang, rank, phrase, a, l, r, n, score."""
    frequent = frequent_phrases(docs, least)
    kept = not_contained(written(scored(frequent), "scored"))
    best = top_per_group(kept, ["lang"], [F.desc("score"), F.desc("a"), F.col("phrase")], top)
    totals = frequent.filter("words = 0").select("lang", F.col("n").alias("n"))
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


ORACLE = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    lower('ABCDEFGHIJKLMNOPQRSTUVWXYZ')) AS text
  FROM documents),
pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words
  FROM texts, LATERAL (SELECT unnest(regexp_extract_all(text, '[^.,;:!?\x0A-\x0D]+')) AS piece)),
totals AS (SELECT lang, sum(len(words)) AS n FROM pieces GROUP BY lang),
runs AS (
  SELECT lang, size, array_to_string(list_slice(words, pos, pos + size - 1), ' ') AS phrase
  FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS size),
    LATERAL (SELECT unnest(range(1, len(words) - size + 2)) AS pos)),
frequent AS (SELECT lang, size, phrase, count(*) AS n FROM runs GROUP BY ALL HAVING count(*) >= 30),
candidates AS (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS words
  FROM frequent WHERE size > 1),
cuts AS (
  SELECT lang, size, phrase, a, words, k, array_to_string(list_slice(words, 1, k), ' ') AS first,
    array_to_string(list_slice(words, k + 1, size), ' ') AS rest
  FROM candidates, LATERAL (SELECT unnest(range(1, size)) AS k)),
scores AS (
  SELECT c.lang, c.size, c.phrase, a, words, k, f.n AS l, g.n AS r,
    (2000000::HUGEINT * a) // (f.n::HUGEINT + g.n) AS score
  FROM cuts c JOIN frequent f ON f.lang = c.lang AND f.phrase = first
  JOIN frequent g ON g.lang = c.lang AND g.phrase = rest),
best AS (SELECT * FROM scores
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, a, array_to_string(list_slice(words, pos, pos + w - 1), ' ') AS phrase
  FROM candidates, LATERAL (SELECT unnest(range(2, size)) AS w),
    LATERAL (SELECT unnest(range(1, size - w + 2)) AS pos) WHERE size > 2),
around AS (SELECT lang, phrase, max(a) AS most FROM inner_phrases GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN around USING (lang, phrase)
  WHERE NOT coalesce(100::HUGEINT * most >= 80::HUGEINT * a, false))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, totals.n::BIGINT AS n, score::BIGINT AS score
FROM kept JOIN totals USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""
