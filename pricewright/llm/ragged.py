"""Numpy kernels over many texts at once: one byte array plus offsets.

Memory is proportional to one chunk (about half a megabyte of text, or a single
longer text), never to a partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 (or binary) column as (bytes, offsets); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not wide:
        column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_large_binary(column.type) else "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(data: np.ndarray, offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``size`` bytes: (first, last, bytes, offsets)."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def _word_tables() -> tuple[np.ndarray, np.ndarray]:
    member = np.zeros(256, bool)
    member[128:] = True
    for low, high in ((48, 58), (65, 91), (97, 123)):
        member[low:high] = True
    lowered = np.arange(256)
    lowered[65:91] += 32
    value = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    value = value[lowered]
    value[~member] = 0
    return member, value


WORD_BYTE, WORD_VALUE = _word_tables()
ALL_VALUE = np.random.default_rng(20240301).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and of its inverse."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, base in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h = h * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


def span_hashes(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hashes of the value runs that begin at ``starts`` (each ends where the next begins)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(values) + 1)
    sums = np.add.reduceat(values * up[: len(values)], starts)
    return mixed(sums * down[starts])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of every text, A-Z lower-cased: (hash, text index, start, end).

    A word is a run of digits, ASCII letters and bytes above 127; it never
    crosses texts.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    member = WORD_BYTE[data]
    opens = member.copy()
    opens[1:] &= ~member[:-1]
    closes = member.copy()
    closes[:-1] &= ~member[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] = member[edges]
    closes[edges - 1] = member[edges - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    hashes = span_hashes(WORD_VALUE[data], starts)
    return hashes, np.searchsorted(offsets, starts, side="right") - 1, starts, ends


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n consecutive values."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(_ODD) + hashes[k : k + len(out)]
    return mixed(out)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = 5) -> list[np.ndarray]:
    """Sorted distinct n-word shingle hashes of each text.

    A text of fewer than n words, but not none, has one shingle: all its words.
    """
    hashes, _, starts, _ = words(data, offsets)
    first = np.searchsorted(starts, offsets[:-1])
    last = np.searchsorted(starts, offsets[1:])
    grams = gram_hashes(hashes, n)
    out = []
    for a, b in zip(first.tolist(), last.tolist()):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            out.append(gram_hashes(hashes[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


class SpanBook(dict):
    """Numbers byte strings in the order in which they are first seen; equal numbers mean equal bytes.

    The owner empties it when ``full()``: at most ``most`` strings and ``most_bytes``
    bytes stay, beside those of one chunk of text.
    """

    def __init__(self, most: int, most_bytes: int = 1 << 26):
        super().__init__()
        self.most, self.most_bytes, self.n_bytes, self.fresh = most, most_bytes, 0, []

    def __missing__(self, key: bytes) -> int:
        self[key] = number = len(self)
        self.fresh.append(key)
        self.n_bytes += len(key)
        return number

    def numbers(self, keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))

    def take_fresh(self) -> list[bytes]:
        """Strings numbered since the last call, in order."""
        fresh, self.fresh = self.fresh, []
        return fresh

    def full(self) -> bool:
        return len(self) > self.most or self.n_bytes > self.most_bytes


def span_strings(data: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """The byte strings that begin at ``starts``, each up to the next."""
    raw, at = data.tobytes(), starts.tolist()
    return [raw[a:b] for a, b in zip(at, [*at[1:], len(raw)])]
