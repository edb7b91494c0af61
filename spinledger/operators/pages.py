"""Which names occur on which text pages: exact containment, else a similar word."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from spinledger.functions.joins import BROADCAST_MAX_BYTES, BROADCAST_SETTING
from spinledger.sources.tables import materialise, scratch_folder

MIN_RATIO = 0.8
MIN_FUZZY_LENGTH = 4
#: Of a 64-bit key in a broadcast table.
KEY_BYTES = 32
#: Sizes of pieces that words of a length are expected to be cut into.
SIZES = 8


def page_texts(pages: DataFrame) -> DataFrame:
    """Visible text of the pages, lower-cased, blanks collapsed."""
    html = F.col("html")
    no_code = F.regexp_replace(html, r"(?s)<(script|style)[^>]*>.*?</(script|style)>", " ")
    text = F.regexp_replace(F.regexp_replace(no_code, r"<[^>]*>", " "), r"\s+", " ")
    return pages.select("page_id", F.lower(F.trim(text)).alias("body"))


def link_names(pages: DataFrame) -> DataFrame:
    """Names to look for, lower-cased with blanks collapsed: whole link targets and page titles."""
    links = F.regexp_extract_all("html", F.lit('<a href="/([^"]+)"'), F.lit(1))
    titles = F.regexp_extract_all("html", F.lit("<title>([^<]+)"), F.lit(1))
    found = pages.select(F.explode(F.concat(links, titles)).alias("name"))
    name = F.lower(F.trim(F.regexp_replace("name", r"\s+", " ")))
    return found.select(name.alias("name")).filter(F.col("name") != "").distinct()


def vocabulary(texts: DataFrame) -> DataFrame:
    """Distinct page-word pairs."""
    words = F.array_distinct(F.split("body", " "))
    return texts.select("page_id", F.explode(words).alias("word"))


def counted_words(texts: DataFrame) -> DataFrame:
    """Distinct words with the number of pages that hold them, written once."""
    counted = vocabulary(texts).groupBy("word").agg(F.count("*").alias("_pages"))
    return materialise(counted, scratch_folder(texts.sparkSession) + "/words")


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes of rows sent to all tasks at once; a quarter, as a query holds several such tables."""
    return int(spark.conf.get(BROADCAST_SETTING, str(BROADCAST_MAX_BYTES))) // 4


def contained_names(texts: DataFrame, names: DataFrame, size: int = 4) -> DataFrame:
    """Page and name wherever the lower-cased name is a substring of the page's text.

    A name without a blank can only lie inside one word: distinct words and names meet through
    the name's first letters (up to ``size``). A name with a blank lies across a word border:
    the letters around its first blank are looked up among the borders of the page, or, where it
    has five words or more, its second to fourth word among the page's runs of three words. The
    candidates are then checked against the whole text. A name without a blank that lies in
    more pairs of a page and a word than there are pages is looked for in the texts themselves,
    where it is soon found; the others meet the pages through the words that hold them.
    Each page (``page_id``) is one row of ``texts``.
    """
    lone = names.filter(~F.col("name").contains(" ") & (F.col("name") != ""))
    spaced = names.filter(F.col("name").contains(" "))
    return within_words(texts, lone, size).unionByName(across_words(texts, spaced)).distinct()


def words_with(vocabulary: DataFrame, names: DataFrame, size: int) -> DataFrame:
    """Each word of a vocabulary with each name that it holds, once: taken at its first place."""
    length = F.least(F.length("name"), F.lit(size))
    keyed = names.select("name", length.alias("_size")).withColumn(
        "_gram", F.substring("name", F.lit(1), F.col("_size"))
    )
    last = F.length("word") - F.col("_size") + 1
    probes = (
        vocabulary.withColumn("_size", F.explode(F.sequence(F.lit(1), F.lit(size))))
        .join(F.broadcast(keyed.select("_size").distinct()), "_size", "left_semi")
        .filter(last >= 1)
        .withColumn("_at", F.explode(F.sequence(F.lit(1), last)))
        .withColumn("_gram", F.substring("word", F.col("_at"), F.col("_size")))
    )
    held = probes.join(small(keyed), ["_size", "_gram"])
    return held.filter(F.position(F.col("name"), F.col("word")) == F.col("_at")).select(
        "word", "_pages", "name"
    )


def with_keys(rows: DataFrame, keys: DataFrame, key: Column) -> DataFrame:
    """Rows whose 64-bit key is among ``keys`` where these can be broadcast, else all rows."""
    keys = keys.select(key.alias("_wanted")).distinct()
    if keys.count() * KEY_BYTES > broadcast_limit(rows.sparkSession):
        return rows
    kept = rows.withColumn("_found", key).join(F.broadcast(keys), F.col("_found") == F.col("_wanted"), "left_semi")
    return kept.drop("_found")


def within_words(texts: DataFrame, names: DataFrame, size: int) -> DataFrame:
    """Pages of names without a blank."""
    folder, counted = scratch_folder(texts.sparkSession), counted_words(texts)
    pages = texts.agg(F.count("*").alias("_all"))
    # at most as many names as a page has pairs of a word and a name on average
    common = (
        words_with(counted, names, size)
        .groupBy("name")
        .agg(F.sum("_pages").alias("_pairs"))
        .join(F.broadcast(pages), F.col("_pairs") > F.col("_all"), "left_semi")
        .select("name")
    )
    common = F.broadcast(materialise(common, folder + "/common"))
    often = texts.join(common, F.col("body").contains(F.col("name"))).select("page_id", "name")
    rare = names.join(common, "name", "left_anti")
    held = materialise(words_with(counted, rare, size).select("word", "name"), folder + "/held")
    words = with_keys(vocabulary(texts), held, F.xxhash64("word"))
    return often.unionByName(words.join(held, "word").select("page_id", "name"))


BORDER = 3
INNER = 3
#: Letters of each side of a border.
BORDERS = [(1, 1), (1, BORDER), (BORDER, 1), (BORDER, BORDER)]


def tasks_of(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def fits(rows: DataFrame) -> bool:
    """Whether the measured size of names allows to broadcast them."""
    size = rows.agg(F.sum(F.octet_length("name") + 64)).first()[0] or 0
    return size <= broadcast_limit(rows.sparkSession)


def small(names: DataFrame) -> DataFrame:
    """Names to broadcast where their measured size allows it, else to be exchanged."""
    return F.broadcast(names) if fits(names) else names


def border_of(left: Column, right: Column, before: Column, after: Column) -> Column:
    return F.xxhash64(F.right(left, before), F.left(right, after))


def run_of(*words: Column) -> Column:
    return F.xxhash64(F.concat_ws(" ", *words))


def across_words(texts: DataFrame, names: DataFrame) -> DataFrame:
    """Keys are hashes; a collision is one more candidate. Only kinds of keys in use are made.

    A border takes ``BORDER`` letters of each side, or one where the name has fewer.
    """
    parts = F.split("name", " ")

    def letters(part: Column) -> Column:
        return F.when(F.length(part) >= BORDER, F.lit(BORDER)).otherwise(F.least(F.length(part), F.lit(1)))

    before, after = letters(parts[0]), letters(parts[1])
    around = border_of(parts[0], parts[1], before, after)
    long = F.size(parts) >= INNER + 2
    keyed = names.select(
        "name",
        F.when(long, run_of(*[F.get(parts, F.lit(k)) for k in range(1, INNER + 1)])).otherwise(around).alias("_key"),
        F.when(long, F.lit(0)).otherwise(before).alias("_before"),
        F.when(long, F.lit(0)).otherwise(after).alias("_after"),
        parts[0].alias("_first"),
        parts[1].alias("_second"),
        (F.size(parts) > 2).alias("_more"),
    )
    used = {tuple(row) for row in keyed.select("_before", "_after").distinct().collect()}  # five at most
    # each word with those after it; missing ones are null
    shifted = [F.slice("_w", k + 1, F.size("_w")) for k in range(INNER + 1)]
    here, following = F.col("_z.w0"), F.col("_z.w1")
    run = run_of(*[F.col(f"_z.w{k}") for k in range(1, INNER + 1)])
    keys = [run] if (0, 0) in used else []
    keys += [border_of(here, following, F.lit(k), F.lit(n)) for k, n in BORDERS if (k, n) in used]
    probes = (
        texts.withColumn("_w", F.split("body", " "))
        .withColumn("_z", F.explode(F.arrays_zip(*[w.alias(f"w{k}") for k, w in enumerate(shifted)])))
        .filter(F.col("_z.w1").isNotNull())
        .withColumn("_key", F.explode(F.array(*keys or [F.lit(None).cast("long")])))
    )
    keyed = keyed.drop("_before", "_after")
    held = F.col("body").contains(F.col("name"))
    # the words of the place first, as a text is long
    second = F.when(F.col("_more"), F.col("_w1") == F.col("_second")).otherwise(F.col("_w1").startswith(F.col("_second")))
    there = F.when(F.col("_w0").endswith(F.col("_first")) & second, held).otherwise(False)
    if fits(keyed):
        placed = probes.select("page_id", "body", "_key", here.alias("_w0"), following.alias("_w1"))
        return placed.join(F.broadcast(keyed), "_key").filter(there).select("page_id", "name")
    keyed = keyed.select("name", "_key")
    candidates = probes.select("page_id", "_key").join(keyed, "_key").select("page_id", "name").distinct()
    same = candidates["page_id"].eqNullSafe(texts["page_id"])
    return candidates.join(texts, same).filter(held).select(candidates["page_id"], "name")


@F.pandas_udf(DoubleType())
def matching_ratio(names: pd.Series, words: pd.Series) -> pd.Series:
    """Twice the letters in matching blocks over the letters of both texts."""
    ratios = [difflib.SequenceMatcher(None, a, b).ratio() for a, b in zip(names, words)]
    return pd.Series(ratios, dtype="float64")


def fuzzy_names(texts: DataFrame, names: DataFrame, min_ratio: float = MIN_RATIO) -> DataFrame:
    """Page, name and closest word where no exact hit exists but a similar word does.

    A word of at least ``MIN_FUZZY_LENGTH`` letters is similar if its ``matching_ratio`` is above
    ``min_ratio``; ties go to the greatest word. Matching blocks are a common subsequence, so
    less than ``(1 - min_ratio)`` of the letters of both stay unmatched: letters left out of the name
    (all its blanks are, and go first) and letters put in. Cutting the name into more pieces than
    there can be such letters leaves one piece whole in the word, with no more of them before it
    than pieces before it and no more after it than pieces after it, which bounds how far it moved;
    name and word meet in an equi-join on a hash of the word's length and the piece and its
    place. Pairs beyond that number of edits go before the ratio is taken, once per distinct word
    and name. Only pages and names with a similar word are looked at for an exact hit.
    """
    distinct = counted_words(texts).filter(F.length("word") >= MIN_FUZZY_LENGTH).select("word")
    near = materialise(similar(distinct, names, min_ratio), scratch_folder(texts.sparkSession) + "/near")
    best = F.max_by("word", F.struct("ratio", "word"))
    exact = (F.col("page_id") == F.col("_page")) & F.col("body").contains(F.col("name"))
    return (
        with_keys(vocabulary(texts), near, F.xxhash64("word"))
        .join(near, "word")
        .groupBy("page_id", "name")
        .agg(best.alias("similar_word"), F.round(F.max("ratio"), 6).alias("ratio"))
        .join(texts.withColumnRenamed("page_id", "_page"), exact, "left_anti")
    )


def pairs_of(names: DataFrame, lengths: DataFrame, min_ratio: float) -> DataFrame:
    """Names with the lengths of words that may be similar, edits (out and in) and size of pieces."""
    n, m = F.length("name"), F.col("_length")
    widest = (2 - min_ratio) / min_ratio
    low, high = F.ceil(n / widest).cast("int"), F.floor(n * widest).cast("int")
    most = F.floor((1 - min_ratio) * (n + m) + 1e-9).cast("int")
    unmatched = most - F.when((n + m - most) / (n + m) > min_ratio, 0).otherwise(1)
    plain = F.replace("name", F.lit(" "), F.lit(""))
    blanks = n - F.length("_plain")
    left_out = F.floor((F.col("_unmatched") + n - m) / 2).cast("int") - blanks
    put_in = F.floor((F.col("_unmatched") - n + m) / 2).cast("int")
    return (
        names.filter(n > 0)
        .withColumn("_plain", plain)
        .withColumn("_length", F.explode(F.sequence(low, high)))
        .join(F.broadcast(lengths), "_length", "left_semi")
        .withColumn("_unmatched", unmatched)
        .withColumns({"_out": left_out, "_in": put_in})
        .filter((F.col("_out") >= 0) & (F.col("_in") >= 0))
        .withColumn("_edits", F.col("_out") + F.col("_in"))
        .withColumn("_size", F.greatest(F.lit(1), F.floor(F.length("_plain") / (F.col("_edits") + 1)).cast("int")))
    )


def pieces_of(names: DataFrame, lengths: DataFrame, min_ratio: float) -> DataFrame:
    """Places (_length, _size, _at, _part) where pieces of a name lie in similar words."""
    pairs = pairs_of(names, lengths, min_ratio).drop("_unmatched")
    pairs = pairs.repartition(tasks_of(names.sparkSession), "name", "_length")  # few rows, made many
    m, count = F.col("_length"), F.col("_edits") + 1
    move, i = F.col("_move"), F.col("_i")
    enough = F.length("_plain") >= count
    near = (F.abs(move) <= i) & (F.abs(m - F.length("_plain") - move) <= F.col("_edits") - i)
    start = i * F.col("_size") + 1
    return (
        pairs.withColumn("_i", F.explode(F.sequence(F.lit(0), F.least(count, F.length("_plain")) - 1)))
        .withColumn("_move", F.explode(F.sequence(-F.col("_out"), F.col("_in"))))
        .filter(~enough | near)
        .withColumns({"_at": start + move, "_part": F.substring("_plain", start, F.col("_size"))})
        .filter((F.col("_at") >= 1) & (F.col("_at") + F.col("_size") - 1 <= m))
        .select("name", "_plain", "_edits", "_length", "_size", "_at", "_part")
    )


def similar(distinct: DataFrame, names: DataFrame, min_ratio: float) -> DataFrame:
    """Distinct words and names whose ``matching_ratio`` is above ``min_ratio``."""
    spark = distinct.sparkSession
    folder, m = scratch_folder(spark), F.length("word")
    # as many rows as the longest word has letters
    counts = distinct.groupBy(m.alias("_length")).agg(F.count("*").alias("_words"))
    upto = F.sum(F.col("_words") * F.col("_length")).over(W.orderBy("_words", "_length"))
    few = (upto * KEY_BYTES * SIZES <= broadcast_limit(spark)).alias("_few")
    lengths = materialise(counts.select("_length", few), folder + "/lengths")
    sizes = materialise(  # bounded by the square of the longest name
        pairs_of(names, lengths, min_ratio).select("_length", "_size").distinct().join(lengths, "_length"),
        folder + "/sizes",
    )
    place = F.xxhash64("_length", "_size", "_at", "_part").alias("_key")
    last = F.col("_length") - F.col("_size") + 1
    probes = (
        distinct.withColumn("_length", m)
        .join(F.broadcast(sizes), "_length")
        .withColumn("_at", F.explode(F.sequence(F.lit(1), last)))
        .withColumn("_part", F.substring("word", F.col("_at"), F.col("_size")))
        .select("word", place, "_few")
    )
    rare, common = (lengths.filter(x) for x in (F.col("_few"), ~F.col("_few")))

    def keyed_of(some: DataFrame) -> DataFrame:
        return pieces_of(names, some, min_ratio).select("name", "_plain", "_edits", place)

    # where words of a length are few, their places choose the pieces of names; else the other way
    keyed = with_keys(keyed_of(rare), probes.filter("_few"), F.col("_key")).unionByName(keyed_of(common))
    keyed = materialise(keyed.distinct(), folder + "/keyed")
    return (
        with_keys(probes, keyed, F.col("_key"))
        .join(keyed, "_key")
        .filter(F.levenshtein("word", "_plain") <= F.col("_edits"))
        .select("word", "name")
        .distinct()
        .withColumn("ratio", matching_ratio("name", "word"))
        .filter(F.col("ratio") > min_ratio)
    )
