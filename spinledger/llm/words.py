"""Words of whole texts as numpy and Arrow arrays, cut at classes of bytes.

Separators are ASCII, so cutting the UTF-8 bytes cuts the characters. A batch is cut as a whole:
its bytes are lower-cased (A-Z only) and classified by table look-up, and the words are numbered
by Arrow's dictionary encoding, which compares the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from spinledger.llm.common import runs

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of the bytes in any of the ranges, ends included."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


@dataclass
class Words:
    """Every word in order: its number in ``distinct``, its text, and whether the next word
    follows in the same piece."""

    ids: np.ndarray
    distinct: pa.Array
    row: np.ndarray
    joined: np.ndarray


def cut(texts: pa.Array, separators: np.ndarray, breaks: np.ndarray | None = None) -> Words:
    """Words of an Arrow string array; ``breaks`` are separators that also end a piece.

    Null texts are empty. A text's end always ends a piece.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(texts) == 0 or offsets[0] == offsets[-1]:
        none = np.zeros(0, dtype=np.int64)
        return Words(none, pa.array([], pa.large_string()), none, none.astype(bool))
    raw = LOWER[np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    inside = ~separators[raw]
    edges = np.zeros(len(raw) + 1, dtype=bool)  # a text begins or ends before this byte
    edges[offsets] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | edges[1:-1]
    ends[:-1] &= ~inside[1:] | edges[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    kept = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=kept[1:])
    array = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(kept), pa.py_buffer(raw[inside])
    )
    encoded = array.dictionary_encode()
    firsts = np.searchsorted(starts, offsets)
    row = np.repeat(np.arange(len(texts)), np.diff(firsts))
    joined = np.ones(len(starts) + 1, dtype=bool)
    joined[firsts] = False  # no word follows in the same piece where another text begins
    if breaks is not None:
        joined[np.searchsorted(starts, np.flatnonzero(breaks[raw]))] = False
    joined = joined[1:].copy()
    joined[-1:] = False
    return Words(encoded.indices.to_numpy().astype(np.int64), encoded.dictionary, row, joined)


def byte_hashes(words: pa.Array, seed: int) -> np.ndarray:
    """A polynomial 64-bit hash of each non-empty word, for uses that survive collisions."""
    _, offsets, data = words.cast(pa.large_string()).buffers()
    if not len(words):
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64)
    sizes = np.diff(offsets)
    place = np.arange(len(raw)) - np.repeat(offsets[:-1] - offsets[0], sizes)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(sizes.max(), 0x9E3779B97F4A7C15, np.uint64))
        sums = np.add.reduceat((raw + np.uint64(seed)) * powers[place], offsets[:-1] - offsets[0])
    return sums


def gathered(
    batches: Iterable[pa.RecordBatch], column: str, limit: int
) -> Iterator[pa.Table]:
    """The rows of a task's batches as tables of about ``limit`` bytes of text each."""
    held, total = [], 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for start, end in runs(sizes, limit):
            size = sum(sizes[start:end])
            if held and total + size > limit:
                yield pa.Table.from_batches(held).combine_chunks()
                held, total = [], 0
            held.append(batch.slice(start, end - start))
            total += size
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def column(table: pa.Table, name: str) -> pa.Array:
    """A combined table's column as one array."""
    chunks = table.column(name).chunks
    return chunks[0] if len(chunks) == 1 else pa.concat_arrays(chunks) if chunks else pa.array(
        [], table.schema.field(name).type
    )
