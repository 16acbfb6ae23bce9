"""Vectorised word handling on the bytes of an Arrow text column.

A word is a run of bytes other than ASCII blank (space and \\t \\n \\v \\f \\r); UTF-8 sequences hold no such byte,
so this equals splitting on those characters. Words are held as 64-bit hashes with their document and byte range.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
#: Separators where words are runs of ASCII letters, digits and all other characters from U+0080 on.
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[:128] = True
PUNCTUATION[48:58] = PUNCTUATION[65:91] = PUNCTUATION[97:123] = False
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: Longer words are hashed one by one.
_LONG = 256
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


@dataclass
class Text:
    """The bytes of a column: ``data`` and, for each row, where it begins and ends."""

    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    @classmethod
    def of(cls, column: pa.Array) -> Text:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pc.fill_null(column.cast(pa.large_string()), "")
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = column.buffers()[2]
        first, last = int(offsets[0]), int(offsets[-1])
        held = np.frombuffer(data, np.uint8)[first:last] if data is not None else np.zeros(0, np.uint8)
        return cls(held, offsets - first)


@dataclass
class Words:
    """All words of a batch in order: hash, row, first byte and the byte after the last."""

    text: Text
    hash: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @cached_property
    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.text.rows)

    @cached_property
    def first(self) -> np.ndarray:
        """Index of each row's first word, and the number of words at the end."""
        return np.concatenate([[0], np.cumsum(self.counts)])


def spans(text: Text, separators: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end, inside) of all words; inside marks the bytes that belong to words."""
    inside = ~separators[text.data]
    n = len(inside)
    before = np.zeros(n, bool)
    if n:
        before[1:] = inside[:-1]
    begins = text.offsets[:-1]
    before[begins[begins < n]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.ones(n, bool)
    if n:
        after[:-1] = ~inside[1:]
    ends = text.offsets[1:]
    after[ends[ends > 0] - 1] = True
    end = np.flatnonzero(inside & after) + 1
    row = np.repeat(np.arange(text.rows), np.diff(np.searchsorted(start, text.offsets)))
    return row, start, end, inside


def characters(text: Text) -> tuple[np.ndarray, np.ndarray]:
    """(bytes as a number, row) of every character (code point)."""
    start = np.flatnonzero((text.data & 0xC0) != 0x80)
    length = np.diff(np.append(start, len(text.data)))
    value = text.data[start].astype(np.uint32)
    for k in range(1, 4):
        longer = np.flatnonzero(length > k)
        value[longer] |= text.data[start[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    row = np.repeat(np.arange(text.rows, dtype=np.int32), np.diff(np.searchsorted(start, text.offsets)))
    return value, row


def hashed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range, read eight bytes at a time."""
    out = np.full(len(start), 0x632BE59BD9B4E019, np.uint64)
    if not len(start):
        return out
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(data) + 1,), (1,))
    length = end - start
    out += length.astype(np.uint64)
    at, left, still = start, length, None
    for k in range(_LONG // 8):
        value = eight[at] & _MASKS[np.minimum(left, 8)]
        if still is None:
            out = mix(out ^ value)
        else:
            out[still] = mix(out[still] * _U(0x9E3779B97F4A7C15) + value)
        more = left > 8
        if not more.any():
            break
        still = np.flatnonzero(more) if still is None else still[more]
        at, left = at[more] + 8, left[more] - 8
    for i in np.flatnonzero(length > _LONG):
        out[i] = xxhash.xxh3_64_intdigest(data[start[i] : end[i]].tobytes())
    return out


def words(column: pa.Array, fold: bool = True, separators: np.ndarray = _BLANK) -> Words:
    """All words of a text column; ``fold`` lower-cases A-Z before hashing."""
    text = Text.of(column)
    row, start, end, _ = spans(text, separators)
    data = _FOLD[text.data] if fold else text.data
    return Words(text, hashed(data, start, end), row, start, end)


def folded(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z lower-cased."""
    return _FOLD[data]


def hash_words(values: list[str], fold: bool = True) -> np.ndarray:
    """Hashes of single words, as ``words`` would give them."""
    return words(pa.array(values, pa.string()), fold).hash if values else np.zeros(0, np.uint64)


def shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every window of ``n`` words."""
    total = len(w.hash) - n + 1
    if total <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, w.row.dtype)
    rolled = np.zeros(total, np.uint64)
    for k in range(n):
        rolled = rolled * _U(0x9E3779B97F4A7C15) + w.hash[k : k + total]
        rolled ^= rolled >> _U(29)
    whole = w.row[:total] == w.row[n - 1 :]
    return mix(rolled[whole]), w.row[:total][whole]


def sets(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row, ascending by (row, hash); rows with 1 to n-1 words give one for all of them."""
    hashes, rows = [], []
    for size in range(1, n + 1):
        if size < n:
            short = np.flatnonzero(w.counts == size)
            if not len(short):
                continue
            at = w.first[short]
            rolled = np.full(len(short), size, np.uint64)
            for k in range(size):
                rolled = rolled * _U(0x9E3779B97F4A7C15) + w.hash[at + k]
                rolled ^= rolled >> _U(29)
            hashes.append(mix(rolled))
            rows.append(short)
        else:
            h, r = shingles(w, n)
            hashes.append(h)
            rows.append(r)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h, r = np.concatenate(hashes), np.concatenate(rows)
    if len(hashes) > 1:
        order = np.argsort(r, kind="stable")
        h, r = h[order], r[order]
    edges = np.searchsorted(r, np.arange(w.text.rows + 1))
    for begin, stop in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if stop - begin > 1:
            h[begin:stop].sort()
    if len(h):
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
        h, r = h[fresh], r[fresh]
    return h, r


def lists(values: np.ndarray, row: np.ndarray, rows: int, kind: pa.DataType) -> pa.Array:
    """Values sorted by row as one list for each row."""
    offsets = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def windows(w: Words, size: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every window of ``size`` words, hashed as ``sets(w, n)`` hashes a row of that many words."""
    if size >= n:
        return shingles(w, size)
    total = len(w.hash) - size + 1
    if total <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, w.row.dtype)
    rolled = np.full(total, size, np.uint64)
    for k in range(size):
        rolled = rolled * _U(0x9E3779B97F4A7C15) + w.hash[k : k + total]
        rolled ^= rolled >> _U(29)
    whole = w.row[:total] == w.row[size - 1 :]
    return mix(rolled[whole]), w.row[:total][whole]
