"""Mixing sources to target weights by Pareto order sampling.

Targets: sources in code point order (null last) weigh ``weights`` in turn and share all words; a
target stops at ``cap`` times its source's words and the excess is shared again by weight until
no target is above. Documents: a document is due ``m = rate * preference`` copies (at most
``cap``); its whole copies floor(m) are certain, and the rest p = m - floor(m) is the inclusion
probability of one more. Documents are ranked by random odds over inclusion odds,
(u / (1 - u)) / (p / (1 - p)), with u a hash of id and size, and taken in that order as long as
they fit into the words that the certain copies leave. One further document, the one closest in
size to the words still open, closes the gap where that brings the source nearer to its target.

No source is sorted whole: words are summed per source and bucket of the rank, and only the
bucket in which the target falls is ordered, so a source with a third of all rows is spread.

Defined cases: a null text has size 0 and is due copies like any other; a null source is a source
of its own, last in order; null ids are empty ids; repeated rows are rows of their own, equal
ones being exchangeable; an empty table gives an empty table; a source without words has target
0; other columns pass through ``mixed`` and are not read by ``decide``. The result is a function
of the rows and the seed: reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spinledger.functions.joins import join_dimension
from spinledger.functions.ranking import exact_row_number
from spinledger.llm.common import SPACES, text_of, written

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix"
BUCKETS = 4096
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"


def word_count(text: Column) -> Column:
    inner = F.trim(text, F.lit(WHITE))
    return F.when(inner == "", 0).otherwise(F.size(F.split(inner, SPACES))).cast("long")


def uniform(id: Column, size: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 from the leading 52 bits of an MD5."""
    key = F.concat_ws(":", F.coalesce(id.cast("string"), F.lit("")), size.cast("string"), F.lit(seed))
    leading = F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double")
    return (leading + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Rows (source, source_size, target) from rows (source, size)."""
    summed = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = exact_row_number(
        summed.withColumn("last", F.col("source").isNull()), ["last", "source"], "place"
    )
    turn = F.element_at(
        F.array(*map(F.lit, weights)), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")
    )
    sources = written(placed.select("source", "source_size", turn.alias("weight")), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, None
    while True:
        full = F.lit(level) * F.col("weight") > F.lit(cap) * F.col("source_size")
        count, held, open_weight = sources.agg(
            F.count_if(full),
            F.sum(F.when(full, F.lit(cap) * F.col("source_size")).otherwise(0)),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))),
        ).first()
        if count == stopped or not open_weight:
            break
        level, stopped = (total - held) / open_weight, count
    return sources.select(
        "source",
        "source_size",
        F.least(
            F.lit(level) * F.col("weight"), F.lit(float(cap)) * F.col("source_size")
        ).alias("target"),
    )


def rates(rows: DataFrame, targets: DataFrame, cap: int, equal: bool) -> DataFrame:
    """Copies due per unit of preference in each source, so that sizes times copies meet the target."""
    due = F.col("rate") * F.col("preference")
    found = targets.withColumn("rate", F.try_divide("target", F.col("source_size").cast("double")))
    if equal:
        return found.fillna(0.0, ["rate"])
    found, before = targets.withColumn("rate", F.lit(0.0)), None
    while True:
        joined = join_dimension(rows, found.withColumnRenamed("source", "_source"), same_source(), "inner")
        full = due > cap
        sums = joined.groupBy("_source").agg(
            F.sum(F.when(full, F.col("size") * cap).otherwise(0)).alias("held"),
            F.sum(F.when(full, 0.0).otherwise(F.col("size") * F.col("preference"))).alias("open"),
            F.count_if(full).alias("full"),
        )
        found = written(
            targets.join(sums, F.col("source").eqNullSafe(F.col("_source")), "left").select(
                *targets.columns,
                F.coalesce(F.try_divide(F.col("target") - F.col("held"), "open"), F.lit(cap + 0.0)).alias("rate"),
                F.coalesce("full", F.lit(0)).alias("full"),
            ),
            "rates",
        )
        state = found.agg(F.sum("full")).first()[0]
        found = found.drop("full")
        if state == before or not state:
            return found
        before = state


def same_source() -> Column:
    return F.col("source").eqNullSafe(F.col("_source"))


def decide(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    cap: int = CAP,
    preference: Column | None = None,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: doc_id, text_hash, size, source_size, target, copies.

    ``preference`` (positive, default equal) makes documents of a source unequally likely.
    """
    wish = F.lit(1.0) if preference is None else preference.cast("double")
    size = word_count(text_of())
    rows = written(
        docs.select(
            "doc_id",
            F.col("source").cast("string").alias("source"),
            F.xxhash64(text_of()).alias("text_hash"),
            size.alias("size"),
            wish.alias("preference"),
        ),
        "sizes",
    )
    targets = source_targets(rows, weights, cap)
    rated = rates(rows, targets, cap, preference is None).withColumnRenamed("source", "_source")
    due = F.least(F.col("rate") * F.col("preference"), F.lit(float(cap)))
    u, p = F.col("u"), F.col("p")
    ranked = (
        join_dimension(rows, rated, same_source(), "inner")
        .withColumn("due", due)
        .withColumn("whole", F.floor("due"))
        .withColumn("p", F.col("due") - F.col("whole"))
        .withColumn("u", uniform(F.col("doc_id"), F.col("size"), seed))
        # odds / (1 + odds) of the rank, so that it fits into buckets
        .withColumn("q", u * (1 - p) / (u * (1 - p) + (1 - u) * p))
        .withColumn("bucket", F.when(p > 0, F.floor(F.col("q") * BUCKETS)))
        .withColumn("row", F.monotonically_increasing_id())
        .select(
            "row", "doc_id", "source", "text_hash", "size", "source_size", "target", "whole", "q", "bucket"
        )
    )
    ranked = written(ranked, "ranked")
    cut, picked = cuts(ranked)
    first = F.col("bucket") < F.coalesce("cut", F.lit(BUCKETS))
    return (
        join_dimension(ranked, cut.withColumnRenamed("source", "_source"), same_source(), "left")
        .join(picked.withColumn("picked", F.lit(True)), "row", "left")
        .withColumn("more", (F.coalesce(first, F.lit(False)) | F.col("picked").isNotNull()).cast("long"))
        .select(
            "doc_id", "text_hash", "size", "source_size", "target", (F.col("whole") + F.col("more")).alias("copies")
        )
    )


def cuts(ranked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per source the bucket in which its target falls; the rows taken in or after it."""
    certain = F.sum(F.col("whole") * F.col("size"))
    upto = Window.partitionBy("source").orderBy("bucket")
    # at most BUCKETS rows and one for the certain copies meet per source
    sums = ranked.groupBy("source", "bucket").agg(
        F.sum("size").alias("words"), certain.alias("certain"), F.max("target").alias("target")
    )
    sums = (
        sums.withColumn("left", F.col("target") - F.sum("certain").over(Window.partitionBy("source")))
        .filter("bucket IS NOT NULL")
        .withColumn("upto", F.sum("words").over(upto))
        .withColumn("before", F.col("upto") - F.col("words"))
    )
    cut = written(
        sums.groupBy("source").agg(
            F.max("left").alias("left"),
            F.min(F.when(F.col("upto") > F.col("left"), F.struct("bucket", "before"))).alias("at"),
        ).select("source", "left", F.col("at.bucket").alias("cut"), F.col("at.before").alias("before")),
        "cuts",
    )
    keyed = cut.withColumnRenamed("source", "_source")
    beyond = join_dimension(
        ranked.filter("bucket IS NOT NULL"), keyed, same_source() & (F.col("bucket") >= F.col("cut")), "inner"
    )
    order = Window.partitionBy("source").orderBy("q", "doc_id", "size", "text_hash", "row")
    inside = written(
        beyond.filter("bucket = cut")
        .withColumn("reach", F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .filter("reach <= left")
        .select("row", "source", "size", "before"),
        "inside",
    )
    gaps = (
        inside.groupBy("source")
        .agg(F.sum("size").alias("filled"))
        .withColumnRenamed("source", "_filled_source")
    )
    gaps = keyed.filter("cut IS NOT NULL").join(
        gaps, F.col("_source").eqNullSafe(F.col("_filled_source")), "left"
    ).select("_source", (F.col("left") - F.col("before") - F.coalesce("filled", F.lit(0))).alias("gap"))
    open_rows = beyond.drop("_source").join(inside.select("row"), "row", "left_anti")
    off = F.abs(F.col("size") - F.col("gap"))
    closing = (
        join_dimension(open_rows, gaps, same_source(), "inner")
        .filter(off < F.col("gap"))
        .groupBy("source")
        .agg(F.min(F.struct(off.alias("off"), "q", "doc_id", "size", "text_hash", "row")).alias("best"))
        .select(F.col("best.row").alias("row"))
    )
    return cut.select("source", "cut"), inside.select("row").union(closing)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its columns."""
    totals = (
        decide(docs, **options)
        .groupBy("doc_id", "text_hash")
        .agg(F.sum("copies").alias("_copies"), F.count("*").alias("_alike"))
        .filter("_copies > 0")
        .withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    )
    hashed = docs.withColumn("_text_hash", F.xxhash64(text_of()))
    match = hashed["doc_id"].eqNullSafe(totals["_id"]) & (hashed["_text_hash"] == totals["_hash"])
    place = F.row_number().over(Window.partitionBy("_id", "_hash").orderBy("_hash"))
    share = F.floor(F.col("_copies") / F.col("_alike")) + (
        F.col("_place") <= F.col("_copies") % F.col("_alike")
    ).cast("long")
    return (
        hashed.join(totals, match)
        .withColumn("_place", place)
        .withColumn("_times", F.explode(F.array_repeat(F.lit(1), share.cast("int"))))
        .select(*docs.columns)
    )


#: The same rules for one machine: no buckets, one window per source.
ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
placed AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::INT] AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, sum(source_size) OVER () AS total, count(*) OVER w AS capped,
    coalesce(sum(3 * source_size) OVER w, 0) AS held,
    sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS open_weight
  FROM placed
  WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT arg_min((total - held)::DOUBLE / open_weight::DOUBLE, capped) FILTER (
    (total - held)::DOUBLE / open_weight::DOUBLE * weight <= 3 * source_size) AS level FROM levels),
targets AS (
  SELECT source, source_size, least(level * weight, 3.0::DOUBLE * source_size) AS target
  FROM placed, level),
ranked AS (
  SELECT doc_id, size, source_size, target, s.source,
    floor(CASE WHEN source_size = 0 THEN 0 ELSE target / source_size::DOUBLE END) AS whole,
    CASE WHEN source_size = 0 THEN 0 ELSE target / source_size::DOUBLE END - whole AS p,
    (('0x' || substr(md5(concat_ws(':', coalesce(doc_id::VARCHAR, ''), size::VARCHAR, 'mix')), 1, 13))::BIGINT
      + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u,
    u * (1 - p) / (u * (1 - p) + (1 - u) * p) AS q,
    row_number() OVER () AS rid
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
reach AS (
  SELECT *, target - whole * source_size AS open,
    CASE WHEN p > 0 THEN sum(size) OVER (PARTITION BY source, p > 0 ORDER BY q, doc_id, size, rid
      ROWS UNBOUNDED PRECEDING) END AS reach
  FROM ranked),
gaps AS (
  SELECT *, reach IS NOT NULL AND reach <= open AS taken_too,
    open - coalesce(max(reach) FILTER (reach <= open) OVER (PARTITION BY source), 0) AS gap
  FROM reach),
closing AS (
  SELECT *, CASE WHEN p > 0 AND NOT taken_too AND abs(size - gap) < gap THEN row_number() OVER (
    PARTITION BY source, p > 0 AND NOT taken_too AND abs(size - gap) < gap
    ORDER BY abs(size - gap), q, doc_id, size, rid) END AS nth
  FROM gaps)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (size * (whole + CASE WHEN taken_too OR nth = 1 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM closing
"""
