"""Token ids of every document in a Simple-8b word-aligned binary format.

File format. A table of Parquet files, one folder ``shard=N`` per range of ids, rows in ascending
(doc_id, text) order; each row is one document: doc_id, n_tokens, first (ids before it in its
shard) and ``payload``, little-endian:

    header      u32 ids, u32 words, u32 escapes, u32 blocks
    block table u32 first word, u32 first escape of every block of BLOCK ids
    words       u64 each: 4 bits selector, then SLOTS[selector] lanes of LANES[selector] bits
    escapes     u32 each

Every word packs as many ids as fit at one width. An id that does not fit below the widest regular
lane is stored as the lane's largest value and taken from the escapes in order. Blocks can be
decoded alone; a batch of documents is decoded at once, selector by selector.

Documents are range-partitioned by id, so that the ids of a shard are one stream and only one
total per shard is needed to place it. Within a task the tokenizers library encodes what stands
between single spaces once per distinct piece; a text with any other spacing around a space is
encoded whole.

Defined cases: a null text is an empty one, with the end id alone; null ids come first; equal ids
are ordered by text; repeated rows are stored again; an empty table gives an empty table; other
columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spinledger.llm.common import runs, shared_folder, small_batches, text_of

END = 2
BLOCK = 512
#: Ids per word and bits per lane, by selector: 60 bits are shared out.
SLOTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
LANES = 60 // SLOTS
#: Ids at or above this value are escapes in 15-bit lanes: four to a word, never fewer.
ESCAPE_SLOTS = 4
ESCAPE = (1 << (60 // ESCAPE_SLOTS)) - 1
WIDTHS = np.array([max(n.bit_length(), 1) for n in range(ESCAPE + 1)], np.uint8)
TEXT_RUN = 1 << 20
SEGMENT = 1 << 19
CUT = re.compile(r"\S(?= \S)")
#: White space of any script inside a piece.
BLANK = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
#: An encoder's memory begins anew beyond so many pieces or signs of them.
PIECES_HELD, SIGNS_HELD = 1 << 20, 1 << 24
#: Entry of the line feed among lines, of a piece not met before, and of a dependent piece.
NEWLINE, UNKNOWN, ODD = 0, -1, -2
ROWS = 1000


# -- Simple-8b --------------------------------------------------------------


def packed(ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """Payloads of consecutive documents of ``lengths`` ids each."""
    starts = np.cumsum(lengths) - lengths
    blocks = -(-lengths // BLOCK)
    owner = np.repeat(np.arange(len(lengths)), blocks)
    nth = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = starts[owner] + nth * BLOCK
    end = np.minimum(begin + BLOCK, (starts + lengths)[owner])
    escape = ids >= ESCAPE
    lanes = np.where(escape, ESCAPE, ids).astype(np.uint64)
    bits = WIDTHS[lanes]
    fits = selectors(bits)
    at, words, counts = begin.copy(), [], []
    order, active = [], np.arange(len(begin))
    while len(active):  # every block takes its next word
        here, left = at[active], end[active] - at[active]
        chosen = np.maximum(fits[here], np.searchsorted(-SLOTS, -left, side="left"))
        took = SLOTS[chosen]
        words.append(gathered(lanes, here, chosen))
        counts.append(took)
        order.append(active)
        at[active] += took
        active = active[at[active] < end[active]]
    flat, block_of = np.concatenate(words), np.concatenate(order)
    turn = np.argsort(block_of, kind="stable")
    flat, per_block = flat[turn], np.bincount(block_of, minlength=len(begin))
    escaped = np.r_[0, np.cumsum(escape)]
    return framed(flat, per_block, ids[escape].astype("<u4"), escaped, begin, starts, lengths, blocks)


def selectors(bits: np.ndarray) -> np.ndarray:
    """Per position the densest selector whose ids from there on all fit."""
    best = np.full(len(bits), len(SLOTS) - 1, np.int8)
    for s in range(len(SLOTS) - 1, -1, -1):
        n, wide = int(SLOTS[s]), bits > LANES[s]
        if len(bits) - np.count_nonzero(wide) < n:
            continue
        misfits = np.concatenate([[0], np.cumsum(wide, dtype=np.int32)])
        full = max(len(bits) - n, 0)
        np.putmask(best[:full], misfits[n : n + full] == misfits[:full], s)
        np.putmask(best[full:], misfits[full:-1] == misfits[-1], s)
    return best


def gathered(lanes: np.ndarray, here: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    out = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen):
        mine = chosen == s
        at = here[mine][:, None] + np.arange(SLOTS[s])
        shifts = (np.arange(SLOTS[s]) * LANES[s]).astype(np.uint64)
        out[mine] |= np.bitwise_or.reduce(lanes[at] << shifts, axis=1)
    return out


def framed(flat, per_block, escapes, escaped, begin, starts, lengths, blocks) -> list[bytes]:
    word_at = np.r_[0, np.cumsum(per_block)]
    block_at = np.r_[0, np.cumsum(blocks)]
    flat, out = flat.astype("<u8"), []
    for d, (start, n) in enumerate(zip(starts.tolist(), lengths.tolist(), strict=True)):
        low, high = block_at[d], block_at[d + 1]
        first, last = word_at[low], word_at[high]
        e0, e1 = escaped[start], escaped[start + n]
        table = np.stack([word_at[low:high] - first, escaped[begin[low:high]] - e0], 1)
        header = np.array([n, last - first, e1 - e0, high - low], "<u4")
        parts = (header, table.astype("<u4"), flat[first:last], escapes[e0:e1])
        out.append(b"".join(p.tobytes() for p in parts))
    return out


def unpacked(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All ids of many documents, and the number of ids of each."""
    heads = np.array([np.frombuffer(p, "<u4", 4) for p in payloads]).reshape(-1, 4).astype(int)
    words, escapes = [], []
    for p, (_, n_words, n_escapes, n_blocks) in zip(payloads, heads.tolist(), strict=True):
        at = 16 + 8 * n_blocks
        words.append(np.frombuffer(p, "<u8", n_words, at))
        escapes.append(np.frombuffer(p, "<u4", n_escapes, at + 8 * n_words))
    return decoded(joined(words, np.uint64), joined(escapes, np.uint32)), heads[:, 0]


def joined(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts).astype(kind) if parts else np.empty(0, kind)


def decoded(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = SLOTS[chosen]
    at = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.uint32)
    for s in np.unique(chosen):
        mine = chosen == s
        shifts = (np.arange(SLOTS[s]) * LANES[s]).astype(np.uint64)
        mask = np.uint64((1 << int(LANES[s])) - 1)
        values = (words[mine][:, None] >> shifts) & mask
        if SLOTS[s] <= ESCAPE_SLOTS:
            values = np.where(values == ESCAPE, np.uint64(1 << 32) - np.uint64(1), values)
        out[at[mine][:, None] + np.arange(SLOTS[s])] = values.astype(np.uint32)
    out[out == (1 << 32) - 1] = escapes
    return out


def block(payload: bytes, number: int) -> np.ndarray:
    """The ids of one block, without decoding those before it."""
    _, n_words, n_escapes, n_blocks = np.frombuffer(payload, "<u4", 4).tolist()
    places = np.frombuffer(payload, "<u4", 2 * n_blocks, 16).reshape(-1, 2)
    places = np.vstack([places, [[n_words, n_escapes]]]).astype(int)
    (w0, e0), (w1, e1) = places[number], places[number + 1]
    at = 16 + 8 * n_blocks
    words = np.frombuffer(payload, "<u8", n_words, at)[w0:w1].astype(np.uint64)
    return decoded(words, np.frombuffer(payload, "<u4", n_escapes, at + 8 * n_words)[e0:e1])


# -- tokenizing -------------------------------------------------------------


class Memory:
    """Ids of pieces by their text: those that begin a text, and those behind a space."""

    def __init__(self):
        # an empty beginning stands before a leading space
        self.entries: tuple[dict[str, int], dict[str, int]] = ({"": 0}, {})
        self.signs = 0
        self.ids, self.starts = np.empty(0, np.uint32), np.zeros(2, np.int64)

    def full(self) -> bool:
        return self.signs > SIGNS_HELD or sum(map(len, self.entries)) > PIECES_HELD

    def keep(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Store the ids of new pieces; their entries."""
        first = len(self.starts) - 1
        self.ids = np.concatenate([self.ids, ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        return np.arange(first, first + len(lengths))


def gathered_ids(ids: np.ndarray, starts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first, counts = starts[at], starts[at + 1] - starts[at]
    ends = np.cumsum(counts)
    flat = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - counts), counts)
    return ids[flat], counts


class Encoder:
    """The tokenizers library with a bounded memory of pieces between single spaces.

    A single space between two other signs always begins a pre-token of this tokenizer, so such
    pieces are independent, and so are the lines of a piece. Unknown ones are encoded together,
    one to a line. White space at an end of one shows that a text is spaced in another way; such
    a text is encoded whole. Long texts are cut into segments at such spaces.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        (self.newline,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.memory = Memory()

    def plain(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for low, high in runs([len(t) for t in texts], TEXT_RUN):
            found = self.tokenizer.encode_batch_fast(texts[low:high], add_special_tokens=False)
            out += [np.array(e.ids, np.uint32) for e in found]
        return out

    def learn(self, pieces: list[str], lead: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and lengths of unknown pieces behind ``lead``, and which are not independent."""
        lines: dict[str, int] = {}
        at, counts = [], []
        for piece in pieces:
            own = piece.split("\n")
            if any(map(uneven, own)):
                counts.append(0)
                continue
            own[0] = lead + own[0]
            for n, line in enumerate(own):
                if n:
                    at.append(NEWLINE)
                at.append(1 + lines.setdefault(line, len(lines)))
            counts.append(2 * len(own) - 1)
        ids, lengths = self.lines_of(list(lines))
        store = np.concatenate([[self.newline], ids]).astype(np.uint32)
        starts = np.concatenate([[0, 1], 1 + np.cumsum(lengths)])
        flat, sizes = gathered_ids(store, starts, np.array(at, np.int64))
        upto, counts = np.concatenate([[0], np.cumsum(sizes)]), np.array(counts, np.int64)
        ends = np.cumsum(counts)
        return flat, upto[ends] - upto[ends - counts], counts == 0

    def lines_of(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not lines:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        (ids,) = self.plain(["\n".join(lines)])
        breaks = np.nonzero(ids == self.newline)[0]
        if len(breaks) == len(lines) - 1:
            return np.delete(ids, breaks), np.diff(breaks, prepend=-1, append=len(ids)) - 1
        found = self.plain(lines)
        return np.concatenate(found), np.array([len(f) for f in found])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts, owners = [], []
        for n, text in enumerate(texts):
            own = segments(text)
            parts += own
            owners += [n] * len(own)
        found: list[np.ndarray] = []
        for low, high in runs([len(p) for p in parts], TEXT_RUN):
            found += self.encode_parts(parts[low:high])
        if len(parts) == len(texts):
            return found
        by_text: list[list[np.ndarray]] = [[] for _ in texts]
        for n, ids in zip(owners, found, strict=True):
            by_text[n].append(ids)
        return [np.concatenate(own) for own in by_text]

    def entries_of(self, pieces: pa.StringArray, lead: str) -> np.ndarray:
        """The memory's entry of every piece behind ``lead``; unknown pieces are learned."""
        found = pieces.dictionary_encode()
        texts, held = found.dictionary.to_numpy(zero_copy_only=False), self.memory.entries[len(lead)]
        entries = np.fromiter(map(held.get, texts, repeat(UNKNOWN)), np.int64, len(texts))
        fresh = np.nonzero(entries == UNKNOWN)[0]
        if len(fresh):
            new = found.dictionary.take(pa.array(fresh))
            blank = pc.or_(pc.match_substring_regex(new, BLANK), pc.equal(new, ""))
            blank = blank.to_numpy(zero_copy_only=False)
            one = fresh[~blank]  # one line each
            ids, lengths = self.lines_of([lead + t for t in texts[one]])
            entries[one] = self.memory.keep(ids, lengths)
            several = fresh[blank]
            ids, lengths, odd = self.learn(texts[several].tolist(), lead)
            entries[several] = np.where(odd, ODD, self.memory.keep(ids, lengths))
            held.update(zip(texts[fresh], entries[fresh].tolist(), strict=True))
            self.memory.signs += pc.sum(pc.utf8_length(new)).as_py()
        return entries[found.indices.to_numpy()]

    def encode_parts(self, texts: list[str]) -> list[np.ndarray]:
        if self.memory.full():
            self.memory = Memory()
        split = pc.split_pattern(pa.array(texts, pa.string()), " ")
        bounds, pieces = split.offsets.to_numpy(), split.values
        begins = np.zeros(len(pieces), bool)
        begins[bounds[:-1]] = True
        per_piece = np.empty(len(pieces), np.int64)
        for lead, here in (("", begins), (" ", ~begins)):
            per_piece[here] = self.entries_of(pieces.filter(pa.array(here)), lead)
        ids, counts = gathered_ids(self.memory.ids, self.memory.starts, np.maximum(per_piece, 0))
        upto = np.concatenate([[0], np.cumsum(counts)])
        out = np.split(ids, upto[bounds[1:-1]])
        odd = np.searchsorted(bounds, np.nonzero(per_piece == ODD)[0], side="right") - 1
        special = [n for n, t in enumerate(texts) if any(s in t for s in self.special)]
        whole = sorted({*odd.tolist(), *special})
        for n, own in zip(whole, self.plain([texts[n] for n in whole]), strict=True):
            out[n] = own
        return out


def segments(text: str) -> list[str]:
    """Cut a long text at single spaces between other signs."""
    out, low = [], 0
    while len(text) - low > SEGMENT:
        cut = CUT.search(text, low + SEGMENT)
        if cut is None:
            break
        out.append(text[low : cut.end()])
        low = cut.end()
    return [*out, text[low:]]


def uneven(line: str) -> bool:
    return not line or line[0].isspace() or line[-1].isspace()


@cache
def encoder_of(path: str) -> Encoder:
    """One encoder per worker process, kept from task to task."""
    return Encoder(path)


def encoding(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = encoder_of(path), 0
        for batch in batches:
            texts = batch["text"].to_pylist()
            for low, high in runs([len(t) for t in texts], TEXT_RUN):
                found = encoder.encode(texts[low:high])
                ids = np.concatenate([part for f in found for part in (f, [END])]).astype(np.uint32)
                lengths = np.fromiter((len(f) + 1 for f in found), np.int64, len(found))
                first = before + np.cumsum(lengths) - lengths
                before += int(lengths.sum())
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["shard"],
                        part["doc_id"],
                        pa.array(lengths),
                        pa.array(first),
                        pa.array(packed(ids, lengths), pa.binary()),
                    ],
                    ["shard", "doc_id", "n_tokens", "first", "payload"],
                )

    return run


def write_tokens(docs: DataFrame, tokenizer: str, path: str) -> None:
    """Encode all texts and write the files of the format described above."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    ordered = (
        docs.select("doc_id", text_of().alias("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
        .select(F.spark_partition_id().alias("shard"), "doc_id", "text")
    )
    schema = f"shard int, doc_id {kind}, n_tokens long, first long, payload binary"
    with small_batches(docs.sparkSession, ROWS):
        ordered.mapInArrow(encoding(tokenizer), schema).write.partitionBy("shard").parquet(path)


def read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, sums = [], []
        payloads = batch["payload"].to_pylist()
        for low, high in runs([len(p) for p in payloads], TEXT_RUN):
            ids, lengths = unpacked(payloads[low:high])
            data, at = memoryview(ids.astype("<u4")).cast("B"), 0
            for n in lengths.tolist():
                sums.append(zlib.crc32(data[at : at + 4 * n]))
                counts.append(n)
                at += 4 * n
        yield pa.RecordBatch.from_arrays(
            [
                batch["shard"],
                batch["doc_id"],
                batch["first"],
                pa.array(counts, pa.int64()),
                pa.array(sums, pa.int64()),
            ],
            ["shard", "doc_id", "first", "n_tokens", "ids_crc32"],
        )


def read_tokens(files: DataFrame) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32), from the decoded ids of the files."""
    kind = files.schema["doc_id"].dataType.simpleString()
    schema = f"shard int, doc_id {kind}, first long, n_tokens long, ids_crc32 long"
    found = files.select("shard", "doc_id", "first", "payload").mapInArrow(read_back, schema)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # one row per shard: bounded by the number of shuffle partitions
    shards = (
        files.groupBy("shard")
        .agg(F.sum("n_tokens").alias("held"))
        .select("shard", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"))
    )
    return found.join(F.broadcast(shards), "shard").select(
        "doc_id", (F.col("offset") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_table(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the token files to the shared folder and read them back."""
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/tokens"
    write_tokens(docs, tokenizer, path)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, first long, payload binary, shard int"
    return read_tokens(spark.read.schema(schema).parquet(path))
