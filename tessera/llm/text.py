"""Byte-level text helpers shared by the operators (numpy over Arrow batches).

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; lower-casing touches
A-Z only. Null texts count as empty. All helpers see whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_MULT = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values (bijective, so distinct inputs stay distinct)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: One odd-mixed 64-bit value per byte; ``LOWER`` maps A-Z onto a-z first.
EXACT = mix(np.arange(1, 257, dtype=U64) * _MULT)
LOWER = EXACT.copy()
LOWER[65:91] = EXACT[97:123]

_BASE = 0x2545F4914F6CDD1D  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 20), base, dtype=U64)
        steps[0] = 1
        have = _POWERS[base] = np.cumprod(steps, dtype=U64)
    return have[:n]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of length rows + 1) of a string column."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def by_bytes(batches, column: str = "text", limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of about ``limit`` text bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_buffer(batch.column(column))
        low = 0
        while low < batch.num_rows:
            high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
            high = min(max(high, low + 1), batch.num_rows)
            yield batch.slice(low, high - low)
            low = high


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document index) of every word; words never cross documents."""
    if not len(buf):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~((buf == 32) | ((buf >= 9) & (buf <= 13)))
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(buf), bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(buf), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = LOWER) -> np.ndarray:
    """64-bit hash of each word from prefix sums of byte values times powers."""
    if not len(starts):
        return np.zeros(0, U64)
    total = np.zeros(len(buf) + 1, dtype=U64)
    np.cumsum(table[buf] * _powers(_BASE, len(buf)), out=total[1:])
    value = (total[ends] - total[starts]) * _powers(_INVERSE, len(buf))[starts]
    return mix(value ^ (ends - starts).astype(U64) * _MULT)


def shingle_hashes(hashes: np.ndarray, docs: np.ndarray, n_docs: int, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document index) of every ``size``-word shingle in document order; a
    shorter document's whole word sequence is its one shingle, no words give none."""
    lead = mix(np.arange(1, size + 1, dtype=U64) * U64(0xD6E8FEB86659FD93)) | U64(1)
    n = len(hashes)
    counts = np.bincount(docs, minlength=n_docs) if n else np.zeros(n_docs, np.int64)
    out, owner = np.zeros(0, U64), np.zeros(0, np.int64)
    if n >= size:
        value = np.zeros(n - size + 1, U64)
        for k in range(size):
            value += hashes[k:n - size + 1 + k] * lead[k]
        whole = docs[:n - size + 1] == docs[size - 1:]
        out, owner = mix(value[whole]), docs[:n - size + 1][whole]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        first = np.cumsum(counts) - counts
        extra = np.zeros(len(short), U64)
        for k in range(size - 1):
            has = counts[short] > k
            extra[has] += hashes[first[short[has]] + k] * lead[k]
        extra = mix(mix(extra) ^ counts[short].astype(U64) * _MULT)
        out, owner = np.concatenate([out, extra]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        out, owner = out[order], owner[order]
    return out, owner


def run_lengths(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of each run of equal values in a sorted array."""
    if not len(sorted_values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
    return start, np.diff(np.append(start, len(sorted_values)))


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every (start, length) run, concatenated."""
    ends = np.cumsum(lengths)
    if not len(ends):
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)


def pack(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document index) of every maximal run of marked bytes; runs never
    cross documents."""
    if not len(inside):
        none = np.zeros(0, np.int64)
        return none, none, none
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    same = inside[:-1] & inside[1:] & ~edge[1:-1]
    starts = np.flatnonzero(inside & np.concatenate([[True], ~same]))
    ends = np.flatnonzero(inside & np.concatenate([~same, [True]])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1
