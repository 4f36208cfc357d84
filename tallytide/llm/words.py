"""Hashed words and shingles of Arrow text columns, computed over whole batches of bytes.

Both word definitions used here cut UTF-8 text at ASCII bytes only, so words can be found on
bytes: a code point outside ASCII has no byte below 128. A word becomes a 64-bit polynomial
hash of its bytes with A-Z lowered, run through a finaliser.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SEGMENT = 1 << 20  # bytes hashed at a time; a longer word widens its segment
_BASE = U(0x9E3779B97F4A7C15)
_SHINGLE = np.array([3, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], U)


def _table(is_word: np.ndarray) -> np.ndarray:
    """Byte -> 0 outside words, else lowered byte plus one."""
    values = np.arange(256, dtype=U)
    values[65:91] += U(32)
    return np.where(is_word, values + U(1), U(0))


def _spaced() -> np.ndarray:
    mask = np.ones(256, bool)
    mask[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
    return mask


def _alphanumeric() -> np.ndarray:
    mask = np.zeros(256, bool)
    for low, high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
        mask[low : high + 1] = True
    return mask


SPACED = _table(_spaced())  # words [^\x20\x09-\x0D]+
ALNUM = _table(_alphanumeric())  # words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lowered text


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    return data, offsets


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.empty(0, U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = U(pow(int(_BASE), -1, 1 << 64))
            up, down = np.full(n, _BASE, U), np.full(n, inverse, U)
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up, self.down


_POWERS = _Powers()


def _segments(data: np.ndarray, first: int, last: int, table: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut [first, last) behind bytes that are in no word."""
    while first < last:
        end = min(first + SEGMENT, last)
        while end < last and table[data[end - 1]]:
            gap = np.flatnonzero(table[data[end : min(end + SEGMENT, last)]] == 0)
            end = end + int(gap[0]) + 1 if len(gap) else min(end + SEGMENT, last)
        yield first, end
        first = end


def hash_words(column: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, offsets): the words of row i are ``hashes[offsets[i]:offsets[i + 1]]``."""
    hashes, offsets, _, _ = place_words(column, table)
    return hashes, offsets


def place_words(column: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, offsets, first bytes, last bytes): as ``hash_words``, with places in the bytes of ``text_bytes``."""
    data, offsets = text_bytes(column)
    hashes, starts, ends = [], [], []
    for a, b in _segments(data, int(offsets[0]), int(offsets[-1]), table):
        values = table[data[a:b]]
        inside = values != 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        edges = offsets[np.searchsorted(offsets, a) : np.searchsorted(offsets, b)] - a
        first[edges] = inside[edges]
        begin = np.flatnonzero(first)
        if not len(begin):
            continue
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        edges = edges[edges > 0]
        last[edges - 1] = inside[edges - 1]
        end = np.flatnonzero(last)
        up, down = _POWERS.get(max(SEGMENT, b - a))
        values *= up[: b - a]
        np.cumsum(values, out=values)
        before = np.where(begin > 0, values[begin - 1], U(0))
        raw = (values[end] - before) * down[begin]
        hashes.append(mix(raw + (end - begin + 1).astype(U) * U(0xD6E8FEB86659FD93)))
        starts.append(begin + a)
        ends.append(end + a)
    if not hashes:
        return np.empty(0, U), np.zeros(len(offsets), np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    where = np.concatenate(starts)
    return np.concatenate(hashes), np.searchsorted(where, offsets).astype(np.int64), where, np.concatenate(ends)


def shingle_sets(hashes: np.ndarray, offsets: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of the word n-grams of each row.

    A row with fewer words, but not none, has one shingle: its whole sequence.
    """
    n = len(hashes) - size + 1
    grams = np.zeros(max(n, 0), U)
    for k in range(size if n > 0 else 0):
        grams += hashes[k : k + n] * (_SHINGLE[k % 5] + U(2 * (k // 5)))
    grams = mix(grams)
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= size:
            row = np.sort(grams[a : b - size + 1])
            keep = np.ones(len(row), bool)
            np.not_equal(row[1:], row[:-1], out=keep[1:])
            out.append(row[keep])
        elif b > a:
            value = np.array([b - a], U)
            for word in hashes[a:b]:
                value = mix(value * U(31) + word)
            out.append(value)
        else:
            out.append(np.empty(0, U))
    return out


def digest_pair(values: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set of hashes, as two signed integers."""
    if not len(values):
        return 0, 0
    low = np.add.reduce(mix(values ^ U(0xA5A5A5A5A5A5A5A5)))
    high = np.add.reduce(mix(values * U(0xC2B2AE3D27D4EB4F) + U(len(values))))
    return int(np.int64(low)), int(np.int64(high))
