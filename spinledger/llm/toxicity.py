"""Toxicity by a lexicon trie met with Levenshtein automata, and context windows.

Learning takes a bounded sample of labelled rows (``MAX_LABELLED``, chosen by a hash of the id, all
of them where there are fewer). They give the lexicon: words, and stems that begin several words,
whose document frequency among toxic rows is far above that among others; it is bounded by this
evidence in the sample alone. A small logistic
regression is fitted on what a lexicon finds in whole texts, each half of the rows read with the
lexicon of the other half, so that words that are rare by chance earn no trust.

Matching: the trie of all terms, read with up to one or two edits anywhere in a word (a letter
more, less or another, or two neighbours swapped; none in terms below four letters), is a
nondeterministic automaton, the intersection of the word's Levenshtein automaton with the trie. Its
state sets are made deterministic as they are met and remembered by the worker from task to task.
It reads only words that may share a string with a term after as many deletions as the term allows
edits, which all words near a term do; these are found for whole batches of new words at once, by
hashes of all their shortened forms. A false hit only costs the automaton's reading. An edit in a term of four letters counts ``SHORT`` of one in a longer term. Every hit is weighed
by its window: quotation marks around it and words of reporting near it speak for quotation,
direct address speaks for abuse.

Defined cases: a null text is an empty one and scores as a text without hits; null ids and labels
do not train; repeated rows score alike; with no toxic or no other labelled row every score is the
share of toxic labels (0 without labels); an empty table gives an empty table; other columns pass
through ``accepted`` and are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinledger.functions.joins import join_dimension
from spinledger.llm.common import crc_remainder, runs, text_of, written

FOLDS = 5
MAX_LABELLED = 20_000
MIN_ROWS = 3
MIN_SHARE = 0.002
MIN_LOG_ODDS = math.log(6)
STEM_LENGTHS = range(4, 9)
#: A stem must occur in this many times the rows of any one word that it begins.
SEVERAL = 1.3
WINDOW = 5
QUOTED = 0.3
ADDRESSED = 1.2
SHORT = 0.5
CACHE = 400_000
#: Places of the table of shortened terms, and shortest words with two edits from a term of nine.
PLACES = 22
TWICE = 7
#: Bytes of text whose words are looked up together.
RUN = 1 << 20
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
QUOTES = "\"“”„«»‹›"
REPORTING = frozenset(
    "said says say called calls wrote writes quote quoted quoting word term slur "
    "dit écrit appelé mot sagte sagt schrieb nannte wort dijo dice escribió llamó palabra".split()
)
ADDRESS = frozenset("you your yourself u ur tu toi vous votre du dich ihr euch tú usted ustedes".split())
FEATURES = 8


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


# -- lexicon ----------------------------------------------------------------


def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial document frequencies of words and stems among toxic and other rows."""
    counts: dict[tuple[str, bool], list[int]] = {}
    for batch in batches:
        for text, toxic in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
            words = set(words_of(text))
            stems = {w[:n] for w in words for n in STEM_LENGTHS if len(w) > n}
            for keys, stem in ((words, False), (stems, True)):
                for key in keys:
                    counts.setdefault((key, stem), [0, 0])[toxic] += 1
        if len(counts) > CACHE:
            yield flushed(counts)
            counts = {}
    yield flushed(counts)


def flushed(counts: dict[tuple[str, bool], list[int]]) -> pa.RecordBatch:
    columns = [
        pa.array([k[0] for k in counts], pa.string()),
        pa.array([k[1] for k in counts], pa.bool_()),
        pa.array([v[0] for v in counts.values()], pa.int64()),
        pa.array([v[1] for v in counts.values()], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["term", "stem", "clean", "toxic"])


def lexicon(sample: DataFrame, toxic: int, clean: int) -> list[tuple[str, bool, float]]:
    """Terms (text, is a stem, weight) from rows (text, toxic).

    A stem that a single word accounts for is no term. Every term needs its rows in the bounded
    sample, which bounds their number.
    """
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    least = max(MIN_ROWS, math.ceil(MIN_SHARE * toxic))
    terms = written(
        sample.mapInArrow(frequencies, "term string, stem boolean, clean long, toxic long")
        .groupBy("term", "stem")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter(F.col("toxic") >= least)
        .withColumn("weight", odds)
        .filter(F.col("weight") >= MIN_LOG_ODDS),
        "terms",
    )
    begun = F.explode(F.array(*[F.substring("term", 1, n) for n in STEM_LENGTHS])).alias("term")
    lone = terms.filter("NOT stem").select(begun, "toxic").groupBy("term").agg(F.max("toxic").alias("_lone"))
    several = F.col("toxic") >= SEVERAL * F.coalesce("_lone", F.lit(0))
    kept = terms.join(lone, "term", "left").filter(~F.col("stem") | several)
    order = [F.desc(F.col("weight") * F.sqrt("toxic")), "term", "stem"]
    return [(row.term, row.stem, row.weight) for row in kept.orderBy(*order).collect()]


def shortened(words: list[str], most: int) -> Iterator[np.ndarray]:
    """Hashes of words of one length less up to ``most`` letters, a row per choice of letters.

    Equal strings have equal hashes: with P ** k at the k-th letter kept, what follows a letter
    left out moves down by one power, which three prefix sums per word give for every choice.
    """
    size = len(words[0])
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    letters = letters.reshape(len(words), size).T.astype(np.uint64) + np.uint64(1)
    powers = np.cumprod(np.full(size + 3, 0x9E3779B97F4A7C15, np.uint64))[:, None]
    kept = []
    for moved in range(3):
        sums = np.zeros((size + 1, len(words)), np.uint64)
        np.cumsum(letters * powers[2 - moved : 2 - moved + size], axis=0, out=sums[1:])
        kept.append(sums)
    whole, once, twice = kept
    yield whole[size]
    if most:
        for i in range(size):
            yield whole[i] + once[size] - once[i + 1]
    if most > 1:
        for i in range(size - 1):
            before = whole[i] - once[i + 1] + twice[size]
            for j in range(i + 1, size):
                yield before + once[j] - twice[j + 1]


def places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two places of the table for each hash."""
    spread = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    second = (spread >> np.uint64(64 - 2 * PLACES)) & np.uint64((1 << PLACES) - 1)
    return (spread >> np.uint64(64 - PLACES)).astype(np.int64), second.astype(np.int64)


def by_length(words: list[str]) -> dict[int, list[str]]:
    out: dict[int, list[str]] = {}
    for word in words:
        out.setdefault(len(word), []).append(word)
    return out


@dataclass
class Automaton:
    """The lexicon's trie read with edits; deterministic states are made when first met."""

    terms: list[tuple[str, bool, float]]
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    reach: list[int] = field(default_factory=lambda: [0])  # edits allowed below a node
    whole: dict[int, tuple[float, int]] = field(default_factory=dict)
    stems: dict[int, float] = field(default_factory=dict)
    short: set[int] = field(default_factory=set)  # ends of terms of four letters

    def __post_init__(self):
        for term, stem, weight in self.terms:
            node, edits = 0, 0 if stem else allowed(term)
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.reach.append(0)
                node = self.children[node][letter]
                self.reach[node] = max(self.reach[node], edits)
            if stem:
                self.stems[node] = weight
            else:
                self.whole[node] = (weight, edits)
                if len(term) == 4:
                    self.short.add(node)
                self.reach[0] = max(self.reach[0], edits)
        terms = [t for t, stem, _ in self.terms if not stem]
        self.longest = max(map(len, terms), default=0) + 2
        self.tables = [np.zeros(1 << PLACES, bool) for _ in range(2)]  # of one edit at most, of two
        for group in by_length(terms).values():
            edits = allowed(group[0])
            for hashes in shortened(group, edits):
                for at in places(hashes):
                    self.tables[edits > 1][at] = True
        self.words: dict[str, tuple[float, int] | None] = {}
        self.forget()

    def forget(self) -> None:
        """Start again with the first state; what is known of words stays."""
        start: dict[tuple[int, str], int] = {(0, ""): 0}
        for child in self.children[0].values():
            self.add(start, child, 1)
        self.states = [tuple(sorted(start.items()))]
        self.items = len(start)
        self.numbers = {self.states[0]: 0}
        self.steps: list[dict[str, int]] = [{}]

    def add(self, best: dict[tuple[int, str], int], node: int, edits: int) -> None:
        most = self.reach[node]
        if edits <= most and edits < best.get((node, ""), 9):
            best[node, ""] = edits
            if edits < most:  # no more edits are allowed below a node than at it
                for child in self.children[node].values():  # a letter left out
                    if edits < self.reach[child]:
                        self.add(best, child, edits + 1)

    def step(self, state: int, letter: str) -> int:
        """States hold (node, letter to come): edits; the letter is the second of a swapped pair."""
        best: dict[tuple[int, str], int] = {}
        for (node, due), edits in self.states[state]:
            if due:
                if due == letter:
                    self.add(best, node, edits)
                continue
            if letter in self.children[node]:
                child = self.children[node][letter]
                most = self.reach[child]
                if edits == 0 or edits <= most:
                    best[child, ""] = min(edits, best.get((child, ""), 9))
                    if edits < most:
                        for below in self.children[child].values():
                            if edits < self.reach[below]:
                                self.add(best, below, edits + 1)
            if edits >= self.reach[node]:
                continue
            self.add(best, node, edits + 1)  # a letter too many
            for first, child in self.children[node].items():  # another letter
                if edits >= self.reach[child]:
                    continue
                self.add(best, child, edits + 1)
                swapped = self.children[child].get(letter)
                if swapped and edits < self.reach[swapped]:
                    best[swapped, first] = min(edits + 1, best.get((swapped, first), 9))
        key = tuple(sorted(best.items()))
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(key)
            self.items += len(key)
            self.steps.append({})
        return self.numbers[key]

    def may_be_near(self, words: list[str]) -> np.ndarray:
        """For words of one length, whether any may be near a term; never false for one that is."""
        size, found = len(words[0]), np.zeros(len(words), bool)
        if size > self.longest:
            return found
        for table, most in zip(self.tables, (1, 2 if size >= TWICE else -1), strict=True):
            for hashes in shortened(words, most) if most > 0 else ():
                first, second = places(hashes)
                found |= table[first] & table[second]
        return found

    def meet(self, words: set[str]) -> None:
        """Match all new words of a run of texts."""
        if len(self.words) > CACHE:
            self.words.clear()
        if self.items > CACHE:
            self.forget()
        for group in by_length(sorted(words - self.words.keys())).values():
            for word, near in zip(group, self.may_be_near(group).tolist(), strict=True):
                self.match(word, near)

    def match(self, word: str, near: bool = True) -> tuple[float, int] | None:
        """(weight, kind) of the best term near a word; kind: edits, 3 for a stem, 4 for a short term."""
        found = stem = None
        node = 0
        for letter in word if self.stems else "":
            node = self.children[node].get(letter)
            if node is None:
                break
            if node in self.stems:
                stem = (self.stems[node], 3)
        if near and len(word) <= self.longest:
            state = 0
            for letter in word:
                after = self.steps[state].get(letter)
                if after is None:
                    after = self.steps[state][letter] = self.step(state, letter)
                state = after
                if not self.states[state]:
                    break
            ends = []
            for (node, due), edits in self.states[state]:
                if not due and node in self.whole and edits <= self.whole[node][1]:
                    low = edits > 0 and node in self.short
                    ends.append((edits, -self.whole[node][0] * (SHORT if low else 1), 4 if low else edits))
            best = min(ends, default=None)
            found = (-best[1], best[2]) if best else None
        if stem and (found is None or found[1]):
            found = stem
        self.words[word] = found
        return found

    def find(self, words: list[str]) -> list[tuple[int, tuple[float, int]]]:
        known, hits = self.words, []
        for i, word in enumerate(words):
            hit = known[word] if word in known else self.match(word)
            if hit:
                hits.append((i, hit))
        return hits


def allowed(term: str) -> int:
    return 0 if len(term) < 4 else 1 if len(term) < 9 else 2


#: The automata of this worker by their terms; jobs of one query have three of them.
KEPT: dict[tuple, Automaton] = {}


def automaton_of(terms: list[tuple[str, bool, float]]) -> Automaton:
    """The automaton of some terms, kept by the worker with all that it has met."""
    key = tuple(terms)
    if key not in KEPT:
        if len(KEPT) > 2:
            KEPT.clear()
        KEPT[key] = Automaton(terms)
    return KEPT[key]


# -- scores -----------------------------------------------------------------


def quoted_words(text: str) -> set[int]:
    """Numbers of the words that stand between two quotation marks of one line."""
    inside: set[int] = set()
    at = 0
    for line in text.lower().split("\n"):
        pieces = re.split(f"[{QUOTES}]", line)
        for k, piece in enumerate(pieces):
            n = len(WORD.findall(piece))
            if k % 2 and k < len(pieces) - 1:
                inside.update(range(at, at + n))
            at += n
    return inside


def features_of(texts: list[str], automaton: Automaton) -> list[list[float]]:
    out = []
    for start, end in runs([len(t) for t in texts], RUN):
        listed = [words_of(t) for t in texts[start:end]]
        automaton.meet(set().union(*listed))
        out += [features(t, words, automaton) for t, words in zip(texts[start:end], listed, strict=True)]
    return out


def features(text: str, words: list[str], automaton: Automaton) -> list[float]:
    hits = automaton.find(words)
    if not hits:
        return [0.0] * (FEATURES - 1) + [math.log1p(len(words))]
    quoted = quoted_words(text) if any(q in text for q in QUOTES) else ()
    weights, kinds = [], Counter()
    for i, (weight, kind) in hits:
        near = words[max(0, i - WINDOW) : i] + words[i + 1 : i + 1 + WINDOW]
        context = 1.0
        if i in quoted or not REPORTING.isdisjoint(near):
            context = QUOTED
        elif not ADDRESS.isdisjoint(near):
            context = ADDRESSED
        weights.append(weight * context)
        name = "exact" if kind == 0 else "stem" if kind == 3 else "near"
        kinds[name] += context * (SHORT if kind == 4 else 1)
    return [
        math.log1p(sum(weights)),
        max(weights),
        math.log1p(kinds["exact"]),
        math.log1p(kinds["near"]),
        math.log1p(kinds["stem"]),
        kinds["exact"] / len(words),
        (kinds["stem"] + kinds["near"]) / len(words),
        math.log1p(len(words)),
    ]


@dataclass
class Model:
    terms: list[tuple[str, bool, float]]
    weights: list[float]  # of the features, then the constant

    def scores(self, rows: np.ndarray) -> np.ndarray:
        z = rows @ np.array(self.weights[:-1]) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(rows: np.ndarray, labels: np.ndarray, ridge: float = 1.0) -> list[float]:
    """Logistic regression by Newton steps on standardised features."""
    mean, spread = rows.mean(0), rows.std(0)
    spread[spread == 0] = 1
    x = np.c_[(rows - mean) / spread, np.ones(len(rows))]
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-3])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(
            (x.T * (p * (1 - p))) @ x + penalty, x.T @ (labels - p) - penalty @ w
        )
        w += step
        if np.abs(step).max() < 1e-8:
            break
    plain = w[:-1] / spread
    return [*plain.tolist(), float(w[-1] - plain @ mean)]


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Lexicon and weights from labelled rows outside the held-out fold."""
    usable = labels.filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (crc_remainder("doc_id", FOLDS) != 0)
    ).groupBy("doc_id").agg(F.max("toxic").cast("boolean").alias("toxic"))
    total = usable.count()
    share = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) / float(1 << 20)
    chosen = usable.filter(share < min(1.0, MAX_LABELLED / max(total, 1)))
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))
    sample = written(
        join_dimension(docs.select("doc_id", text_of().alias("text")), chosen, "doc_id", "inner").select(
            "text", "toxic", half.alias("half")
        ),
        "labelled",
    )
    counts = {(h, t): n for h, t, n in sample.groupBy("half", "toxic").count().collect()}
    toxic, clean = (sum(counts.get((h, t), 0) for h in (0, 1)) for t in (True, False))
    prior = toxic / (toxic + clean) if toxic + clean else 0.0
    if not toxic or not clean:
        odds = math.log((prior + 1e-6) / (1 - prior + 1e-6))
        return Model([], [0.0] * FEATURES + [odds])
    pairs, found = sample.select("text", "toxic"), []
    for own, other in ((0, 1), (1, 0)):
        apart = lexicon(
            sample.filter(F.col("half") == other).select("text", "toxic"),
            counts.get((other, True), 0),
            counts.get((other, False), 0),
        )
        rows = sample.filter(F.col("half") == own).select("text", "toxic")
        # at most MAX_LABELLED rows of a few numbers in all
        found += rows.mapInArrow(extractor(apart), "features array<double>, toxic boolean").collect()
    x, y = np.array([row.features for row in found]), np.array([row.toxic for row in found], float)
    return Model(lexicon(pairs, toxic, clean), fit(x, y))


def extractor(terms: list[tuple[str, bool, float]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = automaton_of(terms)
        for batch in batches:
            rows = features_of(batch[0].to_pylist(), automaton)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.list_(pa.float64())), batch[1]], ["features", "toxic"]
            )

    return run


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with _score, the probability of the toxic label."""
    def run(texts: pa.Array) -> pa.Array:
        automaton = automaton_of(model.terms)
        rows = np.array(features_of(texts.to_pylist(), automaton))
        return pa.array(model.scores(rows.reshape(-1, FEATURES)))

    return docs.withColumn("_score", F.arrow_udf(run, "double")(text_of()))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted)."""
    found = scored(docs.select("doc_id", "text"), learn(docs, labels))
    return found.select(
        "doc_id",
        (crc_remainder("doc_id", FOLDS) == 0).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that do not score as toxic."""
    return scored(docs, learn(docs, labels)).filter("_score < 0.5").select(*docs.columns)
