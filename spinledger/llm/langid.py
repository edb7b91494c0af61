"""Language of mixed texts: script ranges, n-gram scores per word, Viterbi over the words.

Learning counts hashed letter n-grams, whole words and letters per script for every language over
all labelled documents outside the held-out fold. A prediction scores every word (a run of
letters) against each language; languages that do not use the word's script are ruled out unless
none does. The best sequence of languages with a penalty for every switch labels the words, and
adjoining words of one language form a span. The document's language is the one with most letters
and its score their share.

The model has a fixed number of buckets per language. Documents are worked on in runs of bounded
length, all documents of a run taking their next word together.

Defined cases: a null text or one without letters is ``und`` with score 0, as is every text where
no language could be learned; ties go to the smaller language name; null languages do not train;
repeated rows are predicted again; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinledger.llm.common import crc_remainder, runs, text_of

FOLDS, HELD_OUT = 4, 2
BUCKETS = 1 << 17
WORDS_AT, SCRIPTS_AT = BUCKETS, 2 * BUCKETS
SMOOTHING = 0.5
GRAM_WEIGHT, WORD_WEIGHT = 0.5, 1.0
#: Log probability that a switch of language costs.
SWITCH = 12.0
#: One word speaks for a language at most this much.
MOST = 8.0
RULED_OUT = 50.0
SCRIPT_SHARE = 0.01
PIECE = 1 << 20
RUN = 6 << 20
TABLE = 0x20000
MIX = np.uint64(0x9E3779B97F4A7C15)
#: First code points of the letters of scripts, as in the Unicode blocks.
SCRIPTS = {
    "latin": [0x41, 0xAA, 0x1E00, 0x2C60, 0xA720, 0xAB30, 0xFB00, 0xFF21],
    "greek": [0x370, 0x1F00],
    "cyrillic": [0x400, 0x1C80, 0x2DE0, 0xA640],
    "armenian": [0x530],
    "hebrew": [0x590, 0xFB1D],
    "arabic": [0x600, 0x750, 0x8A0, 0xFB50, 0xFE70],
    "devanagari": [0x900],
    "bengali": [0x980],
    "gurmukhi": [0xA00],
    "gujarati": [0xA80],
    "tamil": [0xB80],
    "telugu": [0xC00],
    "kannada": [0xC80],
    "malayalam": [0xD00],
    "thai": [0xE00],
    "georgian": [0x10A0],
    "hangul": [0x1100, 0x3130, 0xA960, 0xAC00],
    "kana": [0x3040, 0x31F0, 0xFF66],
    "han": [0x2E80, 0x3400, 0x4E00, 0xF900, 0x20000],
    "other": [0x0, 0x700, 0x780, 0xB00, 0xD80, 0xE80, 0x1200, 0x2000, 0x3100, 0xA000, 0xA700, 0xA800, 0xD7B0],
}


@cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point: is it a letter, its lower case, the number of its script."""
    letters = np.array([chr(i).isalpha() for i in range(TABLE)])
    lower = np.array([ord(x) if len(x := chr(i).lower()) == 1 else i for i in range(TABLE)], np.uint32)
    starts = sorted((start, n) for n, held in enumerate(SCRIPTS.values()) for start in held)
    at = np.searchsorted([s for s, _ in starts], np.arange(TABLE), side="right") - 1
    return letters, lower, np.array([n for _, n in starts], np.uint8)[at]


@dataclass
class Words:
    """The words of one text piece: where they begin and end, scripts, hashed features."""

    starts: np.ndarray
    ends: np.ndarray
    scripts: np.ndarray
    grams: list[np.ndarray]  # per order a bucket for each letter
    hashes: np.ndarray
    letter_word: np.ndarray  # word of every letter


def words_of(text: str) -> Words:
    letters, lower, scripts = tables()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    near = np.minimum(points, TABLE - 1)
    is_letter = letters[near]
    if (high := points >= TABLE).any():
        some, inverse = np.unique(points[high], return_inverse=True)
        is_letter[high] = np.array([chr(p).isalpha() for p in some])[inverse]
    folded = np.where(is_letter, np.where(points < TABLE, lower[near], points), 0).astype(np.uint64)
    padded = np.r_[np.zeros(1, np.uint64), folded, np.zeros(3, np.uint64)]
    at = np.nonzero(is_letter)[0]
    fresh = np.r_[True, at[1:] != at[:-1] + 1] if len(at) else np.empty(0, bool)
    starts = at[fresh]
    word = np.cumsum(fresh) - 1
    ends = np.r_[at[1:][fresh[1:]], 0]
    if len(at):
        last = np.r_[np.nonzero(fresh)[0][1:] - 1, len(at) - 1]
        ends = at[last] + 1
    before, here, after, next_ = (padded[at + k] for k in range(4))
    pair = mixed(here * MIX + after)
    three = mixed(pair * MIX + before)
    grams = [mixed(here + np.uint64(7)), pair, three, mixed(three * MIX + next_)]
    place = np.minimum(at - starts[word], 63) if len(at) else at
    powers = MIX ** np.arange(64, dtype=np.uint64)
    hashes = np.add.reduceat(here * powers[place], np.nonzero(fresh)[0]) if len(at) else here
    return Words(
        starts,
        ends[: len(starts)],
        scripts[np.minimum(points[starts], TABLE - 1)],
        [(g >> np.uint64(47)).astype(np.int64) % BUCKETS for g in grams],
        WORDS_AT + (mixed(hashes) >> np.uint64(47)).astype(np.int64) % BUCKETS,
        word,
    )


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(32))) * MIX


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts (lang, bucket, n) of the features of labelled texts."""
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        texts: dict[str, list[str]] = {}
        for text, lang in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
            texts.setdefault(lang, []).append(text)
        for lang, own in texts.items():
            sums = held.setdefault(lang, np.zeros(SCRIPTS_AT + len(SCRIPTS), np.int64))
            for low, high in runs([len(t) for t in own], PIECE):
                w = words_of("\n".join(own[low:high]))
                for buckets in (*w.grams, w.hashes, SCRIPTS_AT + w.scripts[w.letter_word].astype(np.int64)):
                    found, n = np.unique(buckets, return_counts=True)
                    sums[found] += n
        if len(held) > 32:
            yield from flushed(held)
            held = {}
    yield from flushed(held)


def flushed(held: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for lang, sums in held.items():
        at = np.nonzero(sums)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(sums[at])],
            ["lang", "bucket", "n"],
        )


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # feature bucket by language, centred log probabilities
    scripts: np.ndarray  # script by language: can the language use it


def learn(docs: DataFrame) -> Model:
    usable = docs.filter(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & (crc_remainder("doc_id", FOLDS) != HELD_OUT)
    ).select("text", F.col("lang").cast("string"))
    sums = usable.mapInArrow(counted, "lang string, bucket int, n long").groupBy("lang", "bucket")
    rows = sums.agg(F.sum("n").alias("n")).toArrow()  # a fixed number of buckets per language
    langs = sorted(set(rows["lang"].to_pylist()))
    counts = np.zeros((SCRIPTS_AT + len(SCRIPTS), len(langs)))
    lang_at = {lang: i for i, lang in enumerate(langs)}
    columns = np.array([lang_at[x] for x in rows["lang"].to_pylist()], int)
    counts[rows["bucket"].to_numpy(), columns] = rows["n"].to_numpy()
    parts = []
    for low, high, weight in ((0, WORDS_AT, GRAM_WEIGHT), (WORDS_AT, SCRIPTS_AT, WORD_WEIGHT)):
        part = counts[low:high]
        logs = np.log((part + SMOOTHING) / (part.sum(0) + SMOOTHING * (high - low)))
        logs[part.sum(1) == 0] = 0
        parts.append(weight * (logs - logs.mean(1, keepdims=True)) if langs else logs)
    letters = counts[SCRIPTS_AT:]
    uses = letters >= SCRIPT_SHARE * np.maximum(letters.sum(0), 1)
    uses[~uses.any(1)] = True
    return Model(langs, np.concatenate(parts).astype(np.float32), uses)


def word_scores(words: Words, model: Model) -> np.ndarray:
    if not len(words.starts):
        return np.empty((0, len(model.langs)), np.float32)
    first = np.r_[0, np.nonzero(np.diff(words.letter_word))[0] + 1]
    sums = sum(np.add.reduceat(model.weights[g], first, axis=0) for g in words.grams)
    sums = np.clip(sums / 2 + model.weights[words.hashes], -MOST, MOST)
    return sums - RULED_OUT * ~model.scripts[words.scripts]


def viterbi(scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Best language of every word; texts are rows of ``lengths`` words, taken in step."""
    labels = np.zeros(len(scores), np.int16)
    order = np.argsort(-lengths, kind="stable")
    sizes, starts = lengths[order], (np.cumsum(lengths) - lengths)[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")
    moved = np.zeros(scores.shape, bool)
    source = np.zeros(len(scores), np.int16)
    value = np.zeros((len(sizes), scores.shape[1]))
    for t in range(longest):
        k = active[t]
        at, own = starts[:k] + t, value[:k]
        if t:
            best = own.argmax(1)
            switch = own[np.arange(k), best] - SWITCH
            jump = own < switch[:, None]
            moved[at], source[at] = jump, best
            own = np.maximum(own, switch[:, None])
        value[:k] = own + scores[at]
    state = np.zeros(len(sizes), np.int16)
    for t in range(longest - 1, -1, -1):
        k = active[t]
        at = starts[:k] + t
        begins = sizes[:k] == t + 1
        state[:k][begins] = value[:k][begins].argmax(1)
        labels[at] = state[:k]
        if t:
            state[:k] = np.where(moved[at, state[:k]], source[at], state[:k])
    return labels


def predict(texts: list[str], model: Model) -> list[tuple[str, float, list[dict]]]:
    """(language, score, spans) of every text; spans hold lang, start and end in characters."""
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    starts, ends, owners, scores = [], [], [], []
    for low, high in runs([len(t) for t in texts], PIECE):
        words = words_of("\n".join(texts[low:high]))
        begin = words.starts + offsets[low]
        starts.append(begin)
        ends.append(words.ends + offsets[low])
        owners.append(np.searchsorted(offsets, begin, side="right") - 1)
        scores.append(word_scores(words, model))
    starts, ends, owners = np.concatenate(starts), np.concatenate(ends), np.concatenate(owners)
    lengths = np.bincount(owners, minlength=len(texts))
    labels = viterbi(np.concatenate(scores), lengths)
    letters = np.zeros((len(texts), len(model.langs)))
    np.add.at(letters, (owners, labels), ends - starts)
    edge = np.r_[True, (labels[1:] != labels[:-1]) | (owners[1:] != owners[:-1])] if len(labels) else []
    first = np.nonzero(edge)[0]
    last = np.r_[first[1:] - 1, len(labels) - 1] if len(first) else first
    spans: list[list[dict]] = [[] for _ in texts]
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        n = owners[a]
        spans[n].append(
            {"lang": model.langs[labels[a]], "start": int(starts[a] - offsets[n]), "end": int(ends[b] - offsets[n])}
        )
    out = []
    for n, row in enumerate(letters):
        total = row.sum()
        best = int(row.argmax()) if total else 0
        out.append((model.langs[best], float(row[best] / total), spans[n]) if total else ("und", 0.0, []))
    return out


def languages(docs: DataFrame, model: Model) -> DataFrame:
    """Rows (doc_id, lang_pred, score, spans)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            for low, high in runs([len(t) for t in texts], RUN):
                if held.value.langs:
                    found = predict(texts[low:high], held.value)
                else:
                    found = [("und", 0.0, [])] * (high - low)
                lang, score, spans = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(low, high - low),
                        pa.array(lang, pa.string()),
                        pa.array(score, pa.float64()),
                        pa.array(spans, span),
                    ],
                    ["doc_id", "lang_pred", "score", "spans"],
                )

    schema = (
        f"doc_id {kind}, lang_pred string, score double, "
        "spans array<struct<lang: string, start: bigint, end: bigint>>"
    )
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, schema)


def identified(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score, spans), learned on the documents themselves."""
    found = languages(docs, learn(docs))
    return found.withColumn("held_out", crc_remainder("doc_id", FOLDS) == HELD_OUT).select(
        "doc_id", "held_out", "lang_pred", "score", "spans"
    )
