"""Words and word shingles of many texts at once, as numpy arrays over the joined UTF-8 bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of text that one step works on; a longer text is a step of its own
STEP_BYTES = 2 << 20
#: multiplier of the polynomial word hash and its inverse modulo 2^64
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
#: everything in ASCII but digits and letters
PUNCTUATION = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse; the tables grow to the longest step seen in this process."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, STEP_BYTES + 1)
        made = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        _powers = (made[0], made[1])
    return _powers[0][:n], _powers[1][:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None and len(offsets) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def steps(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``limit`` bytes of text (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True, between: np.ndarray = _BLANK) -> tuple[
        np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, first word of each text with the total at the end, start byte, end byte) of the words between the bytes that
    ``between`` marks (white space)."""
    b = _LOWER[data] if lower else data
    inside = ~between[b]
    first, last = inside.copy(), inside.copy()
    if len(b):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        full = offsets[1:] > offsets[:-1]
        heads, tails = offsets[:-1][full], offsets[1:][full] - 1
        first[heads] = inside[heads]  # a text's edge ends a word
        last[tails] = inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = powers(len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[b] * up[:-1], out=total[1:])
    hashes = mixed((total[ends] - total[starts]) * down[starts])
    return hashes, np.searchsorted(starts, offsets), starts, ends


def prefix_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(words, hashes): the first ``length`` bytes, A-Z lower-cased, of the words that have more than that."""
    words = np.flatnonzero(ends - starts > length)
    at = starts[words]
    out = np.full(len(words), length, np.uint64)
    for j in range(length):
        out = out * _BASE + _BYTE_CODES[_LOWER[data[at + j]]]
    return words, mixed(out)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the hashes of all runs of ``size`` words, text by text. A text with fewer words has one run of all
    its words; one without words has none."""
    words, at, _, _ = word_hashes(data, offsets)
    counts = np.diff(at)
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    bounds = np.concatenate([[0], np.cumsum(n)])
    first = np.repeat(at[:-1] - bounds[:-1], n) + np.arange(bounds[-1])  # first word of each run
    length = np.repeat(np.minimum(counts, size), n)
    out = mixed(length.astype(np.uint64) + _BASE)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    for j in range(size):
        out = np.where(length > j, mixed(out * _BASE + padded[first + j]), out)
    return out, bounds
