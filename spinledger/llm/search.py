"""Ranked lexical search for many queries at once, sharing their common subexpressions.

A document's score for an item is a sum over the item's terms, so two items that share terms share
a partial sum. The shared sets are mined among the items: in each round, the two items (or sets)
with the most terms in common give them to a new set, of which both are then sums; sets take part
in later rounds, and an item may use several. The result is a directed acyclic graph whose leaves
are the terms left over. A task evaluates it over a block of documents: the accumulator of every
shared set is filled once, later sets first, and added into all sets and items that use it. The
best ``k`` documents of every item leave the task; Spark merges them.

Items are numbered in the order of their least term hash, so that items with a term in common lie
together. The sets are mined on the cluster in groups of ``GROUP_ITEMS``, and ``BLOCK_GROUPS``
groups are searched together. Only one block's graph is handed to the tasks at a time: a row per
distinct term of its items, whatever the number of items and documents. Every block reads all
documents once for their terms (the postings of the block's terms are written) and the postings
once for the scores.

All arithmetic but the logarithm is in 64-bit integers.

Defined cases: documents without terms (null, empty, signs only) count nowhere and are never
returned; every row is a document of its own, so that equal rows and ids rank one after the other,
null ids after all others of their score; items without terms have no result; items of equal
terms share one evaluation, and equal item rows repeat its result; empty tables give no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinledger.functions.joins import join_dimension
from spinledger.functions.ranking import exact_row_number, top_per_group
from spinledger.llm.common import SEPARATORS, ascii_lower, small_batches, text_of, written
from spinledger.llm.words import byte_class, column, cut, gathered

TOP = 20
GROUP_ITEMS = 128
BLOCK_GROUPS = 8
#: Bytes of text cut at once, and documents scored at once.
RUN_BYTES = 16 << 20
RUN_DOCS = 4096
GAPS = byte_class((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


# ---------------------------------------------------------------------------
# items and their shared sets


def numbered_terms(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written rows (item_id, q) of the items with terms, and (q, term, copies) of each number."""
    listed = F.array_sort(F.array_remove(F.split(ascii_lower(text_of()), SEPARATORS), ""))
    rows = items.select("item_id", listed.alias("terms")).filter(F.size("terms") > 0)
    least = F.array_min(F.transform("terms", lambda t: F.xxhash64(t)))
    different = rows.select(least.alias("least"), "terms").distinct()
    numbers = written(exact_row_number(different, ["least", "terms"], "q"), "numbers")
    of_item = join_dimension(rows, numbers.select("terms", "q"), "terms", "inner")
    terms = numbers.select("q", F.explode("terms").alias("term"))
    return (
        written(of_item.select("item_id", "q"), "items"),
        written(terms.groupBy("q", "term").agg(F.count("*").alias("copies")), "terms"),
    )


def shared_sets(held: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
    """Split rows of columns (a boolean matrix) into shared sets.

    Returns what is left in every row, old and new, and the later rows that each row is also a
    sum of. A set is made where two rows share columns of weight two or more together.
    """
    uses: list[list[int]] = [[] for _ in held]
    while True:
        several = held.sum(axis=0) > 1
        dense = held[:, several].astype(np.float64)
        common = np.triu((dense * weights[several]) @ dense.T, 1)
        first, second = np.nonzero(common >= 2)
        order = np.lexsort((second, first, -common[first, second]))
        taken, new = np.zeros(len(held), bool), []
        for i, j in zip(first[order].tolist(), second[order].tolist(), strict=True):
            if taken[i] or taken[j]:
                continue
            taken[i] = taken[j] = True
            both = held[i] & held[j]
            held[i] &= ~both
            held[j] &= ~both
            uses[i].append(len(held) + len(new))
            uses[j].append(len(held) + len(new))
            new.append(both)
        if not new:
            return held, uses
        held = np.concatenate([held, new])
        uses += [[] for _ in new]


GRAPH = "part long, node int, q long, used int, term string, copies long"


def graph(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """The graph of a group's items: a row per node and set it uses, or term left in it.

    Copies of a term are units of their own; units that occur in the same items are one column.
    """
    numbers, row = np.unique(frame["q"], return_inverse=True)
    frame = frame.assign(row=row)
    signatures: dict[bytes, int] = {}
    columns, members = [], []
    for term, own in frame.groupby("term", sort=True):
        rows, copies = own["row"].to_numpy(), own["copies"].to_numpy()
        below = 0
        for level in np.unique(copies):
            support = np.zeros(len(numbers), bool)
            support[rows[copies >= level]] = True
            at = signatures.setdefault(support.tobytes(), len(columns))
            if at == len(columns):
                columns.append(support)
                members.append([])
            members[at].append((term, int(level - below)))
            below = level
    weights = np.array([len(m) for m in members], np.float64)
    left, uses = shared_sets(np.array(columns).T.copy(), weights)
    out = []
    for node, used in enumerate(uses):
        q = int(numbers[node]) if node < len(numbers) else None
        out += [(node, q, other, None, None) for other in used]
        copies: dict[str, int] = {}
        for at in np.flatnonzero(left[node]):
            for term, count in members[at]:
                copies[term] = copies.get(term, 0) + count
        out += [(node, q, None, term, count) for term, count in copies.items()]
        if q is not None and not used and not copies:
            raise AssertionError("an item without terms")
    made = pd.DataFrame(out, columns=["node", "q", "used", "term", "copies"])
    made.insert(0, "part", int(key[0]))
    return made.astype({"q": "Int64", "used": "Int32", "copies": "Int64"})


@dataclass
class Part:
    """One group's graph, over numbered terms."""

    items: list[tuple[int, int]] = field(default_factory=list)  # (node, q)
    uses: dict[int, list[int]] = field(default_factory=dict)
    terms: dict[int, list[tuple[int, int]]] = field(default_factory=dict)  # (term, copies)
    nodes: int = 0


def loaded(rows: pa.Table, term_numbers: dict[str, int]) -> list[Part]:
    """A block's graphs from its rows."""
    parts: dict[int, Part] = {}
    for row in rows.to_pylist():
        part, node = parts.setdefault(row["part"], Part()), row["node"]
        part.nodes = max(part.nodes, node + 1)
        if row["q"] is not None and (node, row["q"]) not in part.items[-1:]:
            part.items.append((node, row["q"]))
        if row["used"] is not None:
            part.uses.setdefault(node, []).append(row["used"])
        else:
            part.terms.setdefault(node, []).append((term_numbers[row["term"]], row["copies"]))
    return list(parts.values())


# ---------------------------------------------------------------------------
# postings


POSTINGS = "doc_id long, n long, terms array<int>, counts array<long>"


def postings(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """Written rows of the documents with terms: their length, and the vocabulary's terms in them."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)

    def post(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for table in gathered(batches, "text", RUN_BYTES):
            words = cut(column(table, "text"), GAPS)
            lengths = np.bincount(words.row, minlength=table.num_rows)
            known = pc.index_in(words.distinct, wanted).fill_null(-1).to_numpy().astype(np.int64)
            term = known[words.ids] if len(words.ids) else words.ids
            inside = term >= 0
            pair, counts = np.unique(
                words.row[inside] * max(1, len(wanted)) + term[inside], return_counts=True
            )
            row, term = pair // max(1, len(wanted)), pair % max(1, len(wanted))
            ends = np.searchsorted(row, np.arange(table.num_rows + 1))
            batch = pa.RecordBatch.from_arrays(
                [
                    column(table, "doc_id"),
                    pa.array(lengths.astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(term, pa.int32())),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(counts, pa.int64())),
                ],
                ["doc_id", "n", "terms", "counts"],
            )
            yield batch.filter(pc.greater(batch.column("n"), 0))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    with small_batches(spark, 1000):
        return written(rows.mapInArrow(post, POSTINGS), "postings")


# ---------------------------------------------------------------------------
# scores


@dataclass
class Best:
    """The best documents of an item so far: scores falling, then ids rising, those without last."""

    k: int
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    nameless: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    def meet(self, scores: np.ndarray, ids: np.ndarray, nameless: np.ndarray) -> None:
        least = 1
        if len(scores) > self.k:
            least = max(1, np.partition(scores, -self.k)[-self.k])
        if len(self.scores) == self.k:
            least = max(least, self.scores[-1])
        place = np.flatnonzero(scores >= least)
        if not len(place):
            return
        scores = np.concatenate([self.scores, scores[place]])
        ids = np.concatenate([self.ids, ids[place]])
        nameless = np.concatenate([self.nameless, nameless[place]])
        order = np.lexsort((ids, nameless, -scores))[: self.k]
        self.scores, self.ids, self.nameless = scores[order], ids[order], nameless[order]


def gains(batch: pa.RecordBatch, weights: np.ndarray, docs: int, terms: int) -> tuple[np.ndarray, ...]:
    """(term, document, contribution) of a batch of postings, by term."""
    n = batch.column("n").to_numpy(zero_copy_only=False)
    listed, counted = batch.column("terms"), batch.column("counts")
    row = np.repeat(np.arange(len(n)), pc.list_value_length(listed).to_numpy(zero_copy_only=False))
    term = listed.flatten().to_numpy(zero_copy_only=False)
    tf = counted.flatten().to_numpy(zero_copy_only=False)
    m = 100 - 25 + (25 * n * docs) // terms
    gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[row]))
    order = np.argsort(term, kind="stable")
    return term[order], row[order], gain[order]


def evaluate(
    part: Part, by_term: dict[int, tuple[np.ndarray, np.ndarray]], docs: int
) -> Iterator[tuple[int, np.ndarray]]:
    """(q, scores of all documents) of a group's items; shared sets are filled once."""
    held = np.zeros((part.nodes, docs), np.int64)
    for node in range(part.nodes - 1, -1, -1):
        for used in part.uses.get(node, ()):
            held[node] += held[used]
        for term, copies in part.terms.get(node, ()):
            if term in by_term:
                row, gain = by_term[term]
                held[node][row] += copies * gain
    for node, q in part.items:
        yield q, held[node]


def block_best(docs: DataFrame, rows: pa.Table, k: int) -> DataFrame:
    """Rows (q, doc_id, score): every task's best documents for the items of one block."""
    spark = docs.sparkSession
    terms = sorted(set(rows.column("term").to_pylist()) - {None})
    vocabulary = pa.array(terms, pa.large_string())
    index = postings(docs, vocabulary)
    totals = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_docs, n_terms = int(totals[0]), int(totals[1])
    found = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    table = found.select("term", weight.alias("w")).toArrow()  # a row per term of the block
    weights = np.zeros(max(1, len(vocabulary)), np.int64)
    weights[table.column("term").to_numpy()] = table.column("w").to_numpy()
    numbers = {term: i for i, term in enumerate(terms)}
    handed = spark.sparkContext.broadcast((loaded(rows, numbers), weights))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, weights = handed.value
        best: dict[int, Best] = {}
        for batch in batches:
            term, row, gain = gains(batch, weights, n_docs, n_terms)
            first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else term
            last = np.r_[first[1:], len(term)] if len(term) else term
            by_term = {
                int(term[i]): (row[i:j], gain[i:j]) for i, j in zip(first, last, strict=True)
            }
            nameless = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            for part in parts:
                for q, scores in evaluate(part, by_term, batch.num_rows):
                    best.setdefault(q, Best(k)).meet(scores, ids, nameless)
        for q, own in best.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(own.ids), q)),
                    pa.array(own.ids, mask=own.nameless),
                    pa.array(own.scores),
                ],
                ["q", "doc_id", "score"],
            )

    with small_batches(spark, RUN_DOCS):
        return written(index.mapInArrow(score, "q long, doc_id long, score long"), "best")


def ranked(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP,
    group_items: int = GROUP_ITEMS,
    block_groups: int = BLOCK_GROUPS,
) -> DataFrame:
    """The ``k`` best documents of every item: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    of_item, terms = numbered_terms(items)
    part = F.floor((F.col("q") - 1) / group_items)
    groups = terms.withColumn("part", part).groupBy("part").applyInPandas(graph, GRAPH)
    graphs = written(groups, "graph")
    last = graphs.agg(F.max("part")).first()[0]
    found = None
    for first in [] if last is None else range(0, last + 1, block_groups):
        inside = F.col("part").between(first, first + block_groups - 1)
        rows = graphs.filter(inside).orderBy("part", "node").toArrow()
        block = block_best(docs, rows, k)
        found = block if found is None else found.unionByName(block)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    best = top_per_group(found, ["q"], order, k)
    return join_dimension(of_item, best, "q", "inner").select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper, lower('ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS lower),
docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), upper, lower),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents, letters),
totals AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs WHERE len(terms) > 0),
items AS (
  SELECT item_id, term, count(*) AS copies
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), upper, lower),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark, letters) GROUP BY ALL),
counts AS (
  SELECT rid, doc_id, len(terms) AS n, term, count(*) AS tf
  FROM docs, LATERAL (SELECT unnest(terms) AS term)
  WHERE term IN (SELECT term FROM items) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts, totals GROUP BY term),
gains AS (
  SELECT rid, doc_id, term,
    w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))) AS gain
  FROM counts JOIN weights USING (term), totals),
scores AS (
  SELECT item_id, rid, doc_id, sum(copies * gain)::BIGINT AS score
  FROM items JOIN gains USING (term) GROUP BY ALL HAVING sum(copies * gain) > 0)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
  doc_id, score
FROM scores
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""
