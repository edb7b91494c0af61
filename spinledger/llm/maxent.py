"""Language-model scores from a hashed maximum-entropy model with class-factored softmax.

The probability of a token is that of its class given the history, times its own in the class.
Classes are the end, each of the most frequent words, and endings of two bytes. A class has the
probability of its group given the history times its own in the group: two small softmaxes, so that a
token costs the logits of all groups and of one group's classes (neighbours in frequency) instead of
those of all classes. Both have hashed features of the history: word and class n-grams and skips.
A word is found in its class by a tree of small softmaxes (``Tree``), which start from the words'
shares of the class by counts and have features of the history too: the last class and the last word. Its leaves are the class's words among the ``HOT`` most
frequent that training met twice or more, and one for all its others. These, and words that training
has not seen, share that leaf by training counts with absolute discounting.

Word counts cover all training texts. The weights are trained by distributed gradient updates: in
each round every partition runs AdaGrad steps from the current weights over its own slice of the
training texts, and the partitions' weights are averaged, each feature by how often it was met;
every text trains in one round. Partial weights are summed in two steps, in streams of small rows.
The hashed rows follow the vocabulary (``WORDS_A_ROW``) up to the 2 ** 16 of a 16-bit row number, so
that the model has a bounded size. Scoring works on runs of texts; counts of the ``HOT`` most frequent
words are at hand in every task, all other words are joined with the whole vocabulary.

Defined cases: a null text is an empty one, with the end alone; null ids count as empty text for
the fold; repeated rows train and are scored again; with no training text the scores are 0 like
the base; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import InitVar, dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinledger.llm.common import crc_remainder, small_batches, text_of, written
from spinledger.llm.words import byte_class, byte_hashes, column, cut, gathered

FOLDS, HELD_OUT = 7, 2
HOT = 150_000
SINGLES = 63
ENDINGS = 64
CLASSES = 1 + SINGLES + ENDINGS
GROUPS = 16  # the first softmax is over groups, the second over the classes of one
MEMBERS = CLASSES // GROUPS
WIDTH = GROUPS + CLASSES  # of a hashed row: logits of the groups, then of each group's classes
BEGIN = CLASSES  # history before the first token
LEAST_BITS, MOST_BITS = 13, 16  # of the number of hashed rows
WORDS_A_ROW = 64
FEATURES = 6
FAN = 16  # of a node of the words of a class
NODE_FEATURES = 2
NODE_BITS = 16  # of the number of hashed rows of a feature of the nodes
NODE_STEP = 8192
ROUNDS = 3
STEP = 4096
BLOCK = 4096  # rows whose logits stay in a core's cache
RATE = 0.15
RUN = 1 << 20
SLICES = 256
FAN_IN = 16
TASK_TOKENS = 1 << 24  # training tokens of all rounds to a task; each task sends one model
COUNT_RUN = 1 << 22
MIX = np.uint64(0x9E3779B97F4A7C15)
HASH_SEED = 1
BLANKS = byte_class((0x09, 0x0D), (0x20, 0x20))


# -- counts -----------------------------------------------------------------


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the words of every run of texts."""
    for table in gathered(batches, "_text", COUNT_RUN):
        words = cut(column(table, "_text"), BLANKS)
        counts = np.bincount(words.ids, minlength=len(words.distinct))
        yield pa.RecordBatch.from_arrays(
            [words.distinct.cast(pa.large_binary()).cast(pa.binary()), pa.array(counts, pa.int64())], ["word", "c"]
        )


def ending_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per ending of two bytes: tokens, words, words met once and twice."""
    held: dict[bytes, list[int]] = {}
    for batch in batches:
        for word, c in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
            sums = held.setdefault(word[-2:], [0, 0, 0, 0])
            sums[0] += c
            sums[1] += 1
            sums[2] += c == 1
            sums[3] += c == 2
    columns = [pa.array([v[i] for v in held.values()], pa.int64()) for i in range(4)]
    yield pa.RecordBatch.from_arrays(
        [pa.array(held.keys(), pa.binary()), *columns], ["ending", "tokens", "words", "once", "twice"]
    )


@dataclass
class Tree:
    """Ways to the items (the leaves) of each class, by Huffman's rule with ``FAN`` children a node.

    A node is a softmax of its children; frequent words are near the root of their class.
    """

    depth: np.ndarray  # per item
    nodes: np.ndarray  # by level and item
    children: np.ndarray
    shares: np.ndarray  # per node: log shares of its children

    @classmethod
    def of(cls, classes: np.ndarray, shares: np.ndarray) -> Tree:
        """``classes`` must be in order, and ``shares`` rise within one."""
        borders = np.flatnonzero(np.diff(classes, prepend=-1, append=-1))
        depth, logs, ways = np.zeros(len(classes), np.int64), [], []
        for low, high in zip(borders[:-1], borders[1:], strict=True):
            members, sums = merged(shares[low:high])
            size, first = high - low, len(logs)
            way: dict[int, list[tuple[int, int]]] = {size + len(members) - 1: []}
            for n in range(len(members) - 1, -1, -1):  # a node comes after all below it
                own = np.full(FAN, -100.0, np.float32)  # children that a node does not have
                own[: len(members[n])] = np.log([max(sums[m] / sums[size + n], 1e-12) for m in members[n]])
                logs.append(own)
                begun = way.pop(size + n)
                for child, m in enumerate(members[n]):
                    way[m] = [*begun, (first + len(members) - 1 - n, child)]
            for m in range(size):
                ways.append(way.get(m, []))
                depth[low + m] = len(ways[-1])
        nodes = np.zeros((depth.max(initial=0), len(classes)), np.int32)
        children = np.zeros(nodes.shape, np.int8)
        level = places_in(depth)
        item = np.repeat(np.arange(len(depth)), depth)
        nodes[level, item], children[level, item] = np.array([x for way in ways for x in way], np.int64).reshape(-1, 2).T
        return cls(depth, nodes, children, np.array(logs, np.float32).reshape(-1, FAN))


def merged(shares: np.ndarray) -> tuple[list[list[int]], list[float]]:
    """Members of every node, its items or earlier nodes (numbered after the items), and all sums.

    The ``FAN`` least of what is left are joined until one is left, the first time so many that
    all later nodes are full. ``shares`` rise, and so do the sums of the nodes.
    """
    size, members, sums = len(shares), [], shares.tolist()
    leaf, node = 0, size
    take = (size - 2) % (FAN - 1) + 2
    while len(sums) - leaf - (node - size) > 1 and size > 1:
        own = []
        for _ in range(take):
            if leaf < size and (node >= len(sums) or sums[leaf] <= sums[node]):
                own.append(leaf)
                leaf += 1
            else:
                own.append(node)
                node += 1
        members.append(own)
        sums.append(sum(sums[m] for m in own))
        take = FAN
    return members, sums


@dataclass
class Vocabulary:
    """Counts of the hot words, classes, and each class's tokens, words and discount."""

    total: int  # tokens, ends included
    distinct: int
    hot: InitVar[Iterable[bytes]]
    hot_counts: np.ndarray
    endings: dict[bytes, int]
    tokens: np.ndarray  # per class
    words: np.ndarray
    discount: np.ndarray
    hot_class: np.ndarray = field(init=False)
    hot_bucket: np.ndarray = field(init=False)
    hot_words: pa.Array = field(init=False)
    hot_hashes: np.ndarray = field(init=False)  # in order, with the hot word of each
    hot_order: np.ndarray = field(init=False)
    of_endings: np.ndarray = field(init=False)  # class by ``ending_codes``
    slots: np.ndarray = field(init=False)  # per class: its group times MEMBERS plus its place there
    bits: int = field(init=False)  # of the number of hashed rows
    tree: Tree = field(init=False)
    hot_item: np.ndarray = field(init=False)  # leaf per hot word, that of its class's others for a rare one
    other_item: np.ndarray = field(init=False)  # per class, -1 for a class of one word
    hot_rare: np.ndarray = field(init=False)
    rare_tokens: np.ndarray = field(init=False)  # per class, of words without a leaf
    rare_words: np.ndarray = field(init=False)

    def __post_init__(self, hot):
        wanted = (max(self.distinct, 1) // WORDS_A_ROW).bit_length()
        self.bits = min(max(wanted, LEAST_BITS), MOST_BITS)
        words = list(hot)
        tail = [self.tail_class(w) for w in words[SINGLES:]]
        self.hot_class = np.array([*range(1, 1 + min(SINGLES, len(words))), *tail], np.int64)
        self.hot_bucket = np.array([zlib.crc32(w) for w in words], np.int64)
        self.hot_words = pa.array(words, pa.large_binary())
        hashes = byte_hashes(self.hot_words.view(pa.large_string()), HASH_SEED)
        self.hot_order = np.argsort(hashes, kind="stable")
        self.hot_hashes = hashes[self.hot_order]
        self.of_endings = np.full(257 * 256, CLASSES - 1)
        self.of_endings[ending_codes(pa.array(list(self.endings), pa.large_binary()))] = list(self.endings.values())
        self.slots = np.empty(CLASSES, np.int64)
        self.slots[np.argsort(-self.tokens, kind="stable")] = np.arange(CLASSES)
        self.plant()

    def plant(self) -> None:
        """The tree of the words of each class."""
        known = np.flatnonzero((self.hot_counts > 1) & (np.arange(len(self.hot_counts)) >= SINGLES))
        own = self.hot_class[known]
        others = np.arange(1 + SINGLES, CLASSES)
        taken = np.bincount(own, self.hot_counts[known], CLASSES)
        self.rare_tokens = np.maximum(self.tokens - taken, 0)
        self.rare_words = np.maximum(self.words - np.bincount(own, minlength=CLASSES), 0)
        shares = 10 ** self.share_logs(self.hot_counts[known], own)
        rest = np.maximum(1 - np.bincount(own, shares, CLASSES), 1e-6)[others]
        classes, shares = np.r_[own, others], np.r_[shares, rest]
        order = np.lexsort((shares, classes))
        item = np.empty(len(order), np.int64)
        item[order] = np.arange(len(order))
        self.tree = Tree.of(classes[order], shares[order])
        self.other_item = np.full(CLASSES, -1)
        self.other_item[others] = item[len(known) :]
        self.hot_item = self.other_item[self.hot_class]
        self.hot_item[known] = item[: len(known)]
        self.hot_rare = np.arange(len(self.hot_item)) >= SINGLES
        self.hot_rare[known] = False

    def numbers(self, words: pa.LargeBinaryArray) -> np.ndarray:
        """Number of each hot word, -1 for others; found by hash, compared by their bytes."""
        if not len(self.hot_words) or not len(words):
            return np.full(len(words), -1)
        if (self.hot_hashes[1:] == self.hot_hashes[:-1]).any():
            return pc.fill_null(pc.index_in(words, value_set=self.hot_words), -1).to_numpy().astype(np.int64)
        at = np.searchsorted(self.hot_hashes, byte_hashes(words.view(pa.large_string()), HASH_SEED))
        found = self.hot_order[np.minimum(at, len(self.hot_order) - 1)]
        same = pc.equal(words, self.hot_words.take(pa.array(found))).to_numpy(zero_copy_only=False)
        return np.where(same, found, -1)

    def tail_class(self, word: bytes) -> int:
        return self.endings.get(word[-2:], CLASSES - 1)

    def share_logs(self, counts: np.ndarray, classes: np.ndarray, rare: bool = False) -> np.ndarray:
        """log10 of a word's share of its class by counts, or of the leaf of its words without one.

        A count of 0 gets what was discounted. Shares of the class are where the tree starts.
        """
        all_tokens, words = (self.rare_tokens, self.rare_words) if rare else (self.tokens, self.words)
        tokens = np.maximum(all_tokens[classes], 1)
        cut = self.discount[classes]
        unseen = np.where(all_tokens[classes] > 0, cut * words[classes] / tokens, 1.0)
        return np.log10(np.where(counts > 0, (counts - cut) / tokens, np.maximum(unseen, 1e-12)))


def vocabulary(words: DataFrame, ends: int) -> Vocabulary:
    """From the word counts of all training texts and their number."""
    total, distinct = words.agg(F.sum("c"), F.count("*")).first()
    top = words.orderBy(F.desc("c"), "word").limit(HOT).toArrow()
    hot, counts = top["word"].to_pylist(), top["c"].to_numpy().astype(np.int64)
    schema = "ending binary, tokens long, words long, once long, twice long"
    sums = (
        words.select("word", "c")
        .mapInArrow(ending_counts, schema)
        .groupBy("ending")
        .agg(*[F.sum(n).alias(n) for n in ("tokens", "words", "once", "twice")])
        .collect()  # at most 65,792 endings
    )
    held = {bytes(r.ending): np.array([r.tokens, r.words, r.once, r.twice]) for r in sums}
    for word, c in zip(hot[:SINGLES], counts[:SINGLES].tolist(), strict=True):
        held[word[-2:]] = held[word[-2:]] - [c, 1, c == 1, c == 2]
    ranked = sorted(held, key=lambda e: (-held[e][0], e))[: ENDINGS - 1]
    endings = {e: 1 + SINGLES + n for n, e in enumerate(ranked)}
    stats = np.zeros((CLASSES, 4))
    stats[0] = [ends, 1, 0, 0]
    for n, c in enumerate(counts[:SINGLES].tolist()):
        stats[1 + n] = [c, 1, 0, 0]
    for ending, row in held.items():
        stats[endings.get(ending, CLASSES - 1)] += row
    once, twice = stats[:, 2], stats[:, 3]
    cut = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.9)
    cut[: 1 + SINGLES] = 0
    return Vocabulary(
        (total or 0) + ends,
        distinct + (ends > 0),
        hot,
        counts,
        endings,
        stats[:, 0],
        stats[:, 1],
        cut,
    )


# -- tokens and features ----------------------------------------------------


@dataclass
class Tokens:
    """Tokens of a run of texts, ends included."""

    lengths: np.ndarray
    classes: np.ndarray
    slots: np.ndarray
    hot: np.ndarray  # number of a hot word, -1 for others and ends
    features: np.ndarray  # row per token and feature
    tails: pa.Array  # words that are not hot
    tail_classes: np.ndarray
    tail_lengths: np.ndarray  # per text
    items: np.ndarray | None = None  # leaf in the tree of the class, -1 for a class of one word
    before: tuple[np.ndarray, np.ndarray] | None = None  # last class and last word


def ending_codes(words: pa.LargeBinaryArray) -> np.ndarray:
    """The last two bytes of words as a number; a single byte stands above the pairs."""
    if not len(words):
        return np.zeros(0, np.int64)
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    raw = np.frombuffer(data, np.uint8).astype(np.int64)
    before = np.where(np.diff(offsets) > 1, raw[offsets[1:] - 2], 256)
    return before * 256 + raw[offsets[1:] - 1]


def tokens_of(texts: pa.Array, vocab: Vocabulary) -> Tokens:
    words = cut(texts, BLANKS)
    distinct = words.distinct.cast(pa.large_binary())
    number = vocab.numbers(distinct)
    kinds, crcs = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
    known, tail = number >= 0, np.flatnonzero(number < 0)
    kinds[known], crcs[known] = vocab.hot_class[number[known]], vocab.hot_bucket[number[known]]
    rare = distinct.take(pa.array(tail))
    kinds[tail] = vocab.of_endings[ending_codes(rare)]
    crcs[tail] = np.fromiter(map(zlib.crc32, rare.to_numpy(zero_copy_only=False)), np.int64, len(rare))
    lengths = np.bincount(words.row, minlength=len(texts)) + 1
    at = np.arange(len(words.ids)) + words.row  # every text before has an end
    size = len(words.ids) + len(texts)
    classes, buckets, hot = np.zeros(size, np.int64), np.zeros(size, np.int64), np.full(size, -1)
    classes[at], buckets[at], hot[at] = kinds[words.ids], crcs[words.ids], number[words.ids]
    far = np.flatnonzero(~known[words.ids])
    items = vocab.other_item[kinds]
    items[known] = vocab.hot_item[number[known]]
    leaves = np.full(size, -1)
    leaves[at] = items[words.ids]
    place = places_in(lengths)
    return Tokens(
        lengths,
        classes,
        vocab.slots[classes],
        hot,
        features(classes, buckets, lengths, vocab.bits),
        distinct.cast(pa.binary()).take(pa.array(words.ids[far])),
        kinds[words.ids[far]],
        np.bincount(words.row[far], minlength=len(texts)),
        leaves,
        (back(classes, 1, BEGIN, place), back(buckets, 1, NO_WORD, place)),
    )


def places_in(lengths: np.ndarray) -> np.ndarray:
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


NO_WORD = 1 << 33


def back(values: np.ndarray, n: int, start: int, place: np.ndarray) -> np.ndarray:
    """The value ``n`` tokens before in the text, ``start`` where there is none."""
    out = np.full(len(values), start, np.int64)
    out[n:] = values[:-n]
    out[place < n] = start
    return out


def features(classes: np.ndarray, buckets: np.ndarray, lengths: np.ndarray, bits: int) -> np.ndarray:
    """Hashed rows: constant, last class, last word, last two classes, and two skips."""
    place = places_in(lengths)
    one, two, three = (back(classes, n, BEGIN, place) for n in (1, 2, 3))
    word = back(buckets, 1, NO_WORD, place)
    values = [np.zeros_like(one), one, word, one * (CLASSES + 1) + two, two, three]
    out = np.empty((len(classes), FEATURES), np.uint16)
    for n, value in enumerate(values):
        mixed = (value.astype(np.uint64) * np.uint64(FEATURES) + np.uint64(n)) * MIX
        out[:, n] = ((mixed ^ (mixed >> np.uint64(29))) * MIX) >> np.uint64(64 - bits)
    return out


#: The same row for any number of bits.
CONSTANT = features(np.zeros(1, np.int64), np.zeros(1, np.int64), np.ones(1, np.int64), LEAST_BITS)[0, 0]


def places(rows: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per feature and token: where the groups' weights lie, and those of the classes of its group."""
    at = rows.T.astype(np.int64)
    at *= WIDTH // MEMBERS
    return at // (GROUPS // MEMBERS), at + (GROUPS // MEMBERS + groups)


def logits_of(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    logits = table.take(at[0], axis=0)
    held = np.empty_like(logits)
    for own in at[1:]:
        logits += table.take(own, axis=0, out=held, mode="clip")
    logits -= greatest(logits)
    return logits


def greatest(values: np.ndarray) -> np.ndarray:
    """Per row; the columns are a power of two, and halves are compared whole."""
    while (half := values.shape[1] // 2):
        values = np.maximum(values[:, :half], values[:, half:])
    return values


def sums_of(values: np.ndarray) -> np.ndarray:
    return values @ np.ones(values.shape[1], np.float32)


def softmax(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    logits = logits_of(table, at)
    out = np.exp(logits, out=logits)
    out /= sums_of(out)[:, None]
    return out


def log_probabilities(weights: np.ndarray, rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Natural log of the probability of each row's wanted slot: of its group, and of it in the group."""
    groups, members = np.divmod(wanted, MEMBERS)
    total = np.zeros(len(rows))
    for at, own in zip(places(rows, groups), (groups, members), strict=True):
        logits = logits_of(weights.reshape(-1, GROUPS if own is groups else MEMBERS), at)
        total += logits[np.arange(len(rows)), own]
        total -= np.log(sums_of(np.exp(logits, out=logits)))
    return total


# -- words of a class -------------------------------------------------------


def first_node_weights() -> np.ndarray:
    return np.zeros((NODE_FEATURES << NODE_BITS, FAN), np.float32)


def visits(tokens: Tokens, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every node on the way to every token's leaf: the token, node, row of each feature, and child."""
    tree = vocab.tree
    depth = np.where(tokens.items >= 0, tree.depth[tokens.items], 0)
    token = np.repeat(np.arange(len(depth)), depth)
    level, item = places_in(depth), tokens.items[token]
    node = tree.nodes[level, item]
    rows = np.empty((NODE_FEATURES, len(token)), np.uint16)
    for n, values in enumerate(tokens.before):
        mixed = (values.astype(np.uint64) * np.uint64(NODE_FEATURES) + np.uint64(n)) * MIX
        mixed = ((mixed ^ (mixed >> np.uint64(29)))[token] + node.astype(np.uint64)) * MIX
        rows[n] = ((mixed ^ (mixed >> np.uint64(32))) * MIX) >> np.uint64(64 - NODE_BITS)
    return token, node, rows, tree.children[level, item]


def node_logits(weights: np.ndarray, vocab: Vocabulary, node: np.ndarray, rows: np.ndarray) -> np.ndarray:
    logits = vocab.tree.shares.take(node, axis=0)
    held = np.empty_like(logits)
    for n, own in enumerate(rows):
        logits += weights[n << NODE_BITS : (n + 1) << NODE_BITS].take(own, axis=0, out=held, mode="clip")
    logits -= greatest(logits)
    return logits


def node_steps(weights: np.ndarray, squares: np.ndarray, met: np.ndarray, tokens: Tokens, vocab: Vocabulary) -> None:
    """AdaGrad over minibatches of the nodes on the tokens' ways, in place."""
    _, node, rows, children = visits(tokens, vocab)
    for low in range(0, len(node), NODE_STEP):
        part = slice(low, low + NODE_STEP)
        errors = node_logits(weights, vocab, node[part], rows[:, part])
        np.exp(errors, out=errors)
        errors /= sums_of(errors)[:, None]
        errors[np.arange(len(errors)), children[part]] -= 1
        for n in range(NODE_FEATURES):
            order = np.argsort(rows[n, part], kind="stable")  # by radix, as the rows are 16 bits
            ordered = rows[n, part][order]
            first = starts(ordered)
            own = ordered[first].astype(np.int64) + (n << NODE_BITS)
            met[own] += np.diff(first, append=len(ordered))
            descended(weights, squares, own, errors, order, first)


def word_logs(weights: np.ndarray, tokens: Tokens, vocab: Vocabulary) -> np.ndarray:
    """Natural log of the probability of every token's leaf in its class."""
    token, node, rows, children = visits(tokens, vocab)
    logs = np.empty(len(token))
    for low in range(0, len(token), BLOCK):
        part = slice(low, low + BLOCK)
        logits = node_logits(weights, vocab, node[part], rows[:, part])
        logs[part] = logits[np.arange(len(logits)), children[part]]
        logs[part] -= np.log(sums_of(np.exp(logits, out=logits)))
    return np.bincount(token, logs, len(tokens.items))


# -- training ---------------------------------------------------------------


def first_weights(vocab: Vocabulary) -> np.ndarray:
    weights = np.zeros((1 << vocab.bits, WIDTH), np.float32)
    tokens = np.empty(CLASSES)
    tokens[vocab.slots] = vocab.tokens + 1
    of_groups = tokens.reshape(GROUPS, MEMBERS).sum(1)
    weights[CONSTANT, :GROUPS] = np.log(of_groups / tokens.sum())
    weights[CONSTANT, GROUPS:] = np.log(tokens / np.repeat(of_groups, MEMBERS))
    return weights


def descended(
    weights: np.ndarray, squares: np.ndarray, at: np.ndarray, errors: np.ndarray, order: np.ndarray, first: np.ndarray
) -> None:
    """One AdaGrad step of the distinct rows ``at``, each by its sum of the ordered errors."""
    pairs = errors.view(np.complex64).take(order, axis=0)  # two floats are added at a time
    sums = np.add.reduceat(pairs, first, axis=0).view(np.float32)
    held = squares.take(at, axis=0)
    held += sums * sums
    put(squares, at, held)
    held += 1e-6
    sums *= RATE
    sums /= np.sqrt(held, out=held)
    put(weights, at, np.subtract(weights.take(at, axis=0, out=held, mode="clip"), sums, out=held))


def put(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Assign whole rows, as one value each."""
    row = np.dtype((np.void, table.itemsize * table.shape[1]))
    table.view(row)[at, 0] = rows.view(row)[:, 0]


def gradient_steps(weights: np.ndarray, squares: np.ndarray, met: np.ndarray, tokens: Tokens) -> None:
    """AdaGrad over minibatches of the tokens, in place."""
    tables = [(weights.reshape(-1, n), squares.reshape(-1, n)) for n in (GROUPS, MEMBERS)]
    for low in range(0, len(tokens.slots), STEP):
        slots = tokens.slots[low : low + STEP]
        by_group = np.argsort((slots // MEMBERS).astype(np.uint16), kind="stable")
        rows = tokens.features[low : low + STEP][by_group]
        groups, members = np.divmod(slots[by_group], MEMBERS)
        each, at = np.arange(len(rows)), places(rows, groups)
        errors = [softmax(table, own) for (table, _), own in zip(tables, at, strict=True)]
        errors[0][each, groups] -= 1
        errors[1][each, members] -= 1
        for n in range(FEATURES):
            order = np.argsort(rows[:, n], kind="stable")  # by radix, as the rows are 16 bits
            own = rows[order, n]
            first = starts(own)
            met[own[first]] += np.diff(first, append=len(own))
            for (table, held), places_of, error in zip(tables, at, errors, strict=True):
                own = places_of[n][order]
                first = starts(own)
                descended(table, held, own[first], error, order, first)


def starts(ordered: np.ndarray) -> np.ndarray:
    """Where a value of an ordered array comes first."""
    new = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return np.flatnonzero(new)


def trainer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, *begun = shared.value
        of_classes, of_nodes = ((w.copy(), np.zeros_like(w), np.zeros(len(w))) for w in begun)
        for table in gathered(batches, "_text", RUN):
            tokens = tokens_of(column(table, "_text"), vocab)
            gradient_steps(*of_classes, tokens)
            node_steps(*of_nodes, tokens, vocab)
        if of_classes[2].any():
            for n, (weights, _, met) in enumerate((of_classes, of_nodes)):
                weights *= met[:, None].astype(np.float32)
                yield from sliced(weights, met, n * SLICES)

    return run


def sliced(sums: np.ndarray, met: np.ndarray, above: int) -> Iterator[pa.RecordBatch]:
    """Rows (slice, sums, met) of a part of the weights each."""
    size = len(sums) // SLICES
    for n in range(SLICES):
        part, count = sums[n * size : (n + 1) * size], met[n * size : (n + 1) * size]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([above + n], pa.int32()),
                pa.array([part.astype(np.float32).tobytes()], pa.binary()),
                pa.array([count.tobytes()], pa.binary()),
            ],
            ["slice", "sums", "met"],
        )


def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the rows of every slice of a partition as they stream by."""
    held: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for n, sums, met in zip(*(batch[c].to_pylist() for c in ("slice", "sums", "met")), strict=True):
            met = np.frombuffer(met, np.float64)
            sums = np.frombuffer(sums, np.float32).reshape(len(met), -1)
            own = held.setdefault(n, [np.zeros(sums.shape), np.zeros(len(met))])
            own[0] += sums
            own[1] += met
    for n, (sums, met) in held.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([n], pa.int32()),
                pa.array([sums.astype(np.float32).tobytes()], pa.binary()),
                pa.array([met.tobytes()], pa.binary()),
            ],
            ["slice", "sums", "met"],
        )


def trained(docs: DataFrame, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Weights after ``ROUNDS`` rounds over disjoint slices of the training texts (_text).

    Those of the classes, and those of the nodes of their words.
    """
    spark, weights = docs.sparkSession, (first_weights(vocab), first_node_weights())
    part = F.pmod(F.xxhash64("doc_id", F.lit("round")), F.lit(ROUNDS))
    schema = "slice int, sums binary, met binary"
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(vocab.total / TASK_TOKENS))
    for n in range(ROUNDS):
        shared = spark.sparkContext.broadcast((vocab, *weights))
        partial = docs.filter(part == n).select("_text").coalesce(tasks).mapInArrow(trainer(shared), schema)
        spread = partial.withColumn("way", F.pmod(F.spark_partition_id(), F.lit(FAN_IN)))
        with small_batches(spark, 64):
            if tasks > FAN_IN:  # else a way is one task and has nothing to add
                partial = spread.repartition("slice", "way").select("slice", "sums", "met").mapInArrow(added, schema)
            # SLICES rows of each table of the bounded model, a partition at a time
            for row in partial.repartition("slice").mapInArrow(added, schema).toLocalIterator():
                met = np.frombuffer(row.met, np.float64)
                seen = met > 0
                mean = np.frombuffer(row.sums, np.float32).reshape(len(met), -1)[seen] / met[seen][:, None]
                low = row.slice % SLICES * len(met)
                weights[row.slice // SLICES][low : low + len(met)][seen] = mean
        shared.destroy()
    return weights


# -- scoring ----------------------------------------------------------------


def scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, weights, nodes = shared.value
        for table in gathered(batches, "_text", RUN):
            t = tokens_of(column(table, "_text"), vocab)
            logs = np.empty(len(t.classes))
            for at in range(0, len(logs), BLOCK):
                part = slice(at, at + BLOCK)
                logs[part] = log_probabilities(weights, t.features[part], t.slots[part])
            logs += word_logs(nodes, t, vocab)
            logs /= math.log(10)
            counts = np.where(t.hot >= 0, vocab.hot_counts[t.hot] if len(vocab.hot_counts) else 0, 0)
            ends = np.cumsum(t.lengths) - 1
            counts[ends] = int(vocab.tokens[0])
            near = counts > 0
            rare = np.flatnonzero(t.hot >= 0)
            rare = rare[vocab.hot_rare[t.hot[rare]]]
            logs[rare] += vocab.share_logs(counts[rare], t.classes[rare], rare=True)
            firsts = np.cumsum(t.lengths) - t.lengths
            base = np.where(near, np.log10(counts + 1), 0)
            tails = pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(t.tail_lengths)], pa.int32()),
                pa.StructArray.from_arrays([t.tails, pa.array(t.tail_classes, pa.int16())], ["word", "class"]),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    column(table, "doc_id"),
                    pa.array(t.lengths),
                    pa.array(np.add.reduceat(near, firsts, dtype=np.int64)),
                    pa.array(np.add.reduceat(base, firsts)),
                    pa.array(np.add.reduceat(logs, firsts)),
                    tails,
                ],
                ["doc_id", "n_tokens", "n_known", "base", "score", "tail"],
            )

    return run


def scores(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    texts = docs.select("doc_id", text_of().alias("_text"))
    training = texts.filter(crc_remainder("doc_id", FOLDS) != HELD_OUT)
    counted = training.select("_text").mapInArrow(word_counts, "word binary, c long")
    words = written(counted.groupBy("word").agg(F.sum("c").alias("c")), "vocabulary")
    vocab = vocabulary(words, training.select("doc_id").count())
    weights = trained(training, vocab)
    shared = docs.sparkSession.sparkContext.broadcast((vocab, *weights))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_tokens long, n_known long, base double, score double, "
        "tail array<struct<word: binary, class: smallint>>"
    )
    near = texts.mapInArrow(scorer(shared), schema).withColumn(
        "row", F.monotonically_increasing_id()
    )
    near = written(near, "near")
    shared.destroy()
    of = F.col("class") + 1
    tokens, types, cut = (
        F.element_at(F.array(*[F.lit(float(x)) for x in values]), of.cast("int"))
        for values in (vocab.rare_tokens, vocab.rare_words, vocab.discount)
    )
    unseen = F.when(tokens > 0, F.greatest(cut * types / tokens, F.lit(1e-12))).otherwise(1.0)
    far = (
        near.select("row", F.explode("tail").alias("t"))
        .select("row", F.col("t.word").alias("word"), F.col("t.class").alias("class"))
        .join(words, "word", "left")
        .groupBy("row")
        .agg(
            F.count("c").alias("far_known"),
            F.sum(F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("far_base"),
            F.sum(F.log10(F.when(F.col("c") > 0, (F.col("c") - cut) / tokens).otherwise(unseen))).alias(
                "far_score"
            ),
        )
    )
    size = math.log10(vocab.total + vocab.distinct + 1)
    nothing = vocab.total == 0
    return near.drop("tail").join(far, "row", "left").select(
        "doc_id",
        (crc_remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("far_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("far_base", F.lit(0.0)) - F.col("n_tokens") * size).alias("base_score"),
        (F.lit(0.0) if nothing else F.col("score") + F.coalesce("far_score", F.lit(0.0))).alias("score"),
    )
